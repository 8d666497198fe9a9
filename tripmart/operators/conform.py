"""Bringing one month's batch into the raw table's shape."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions import ns_to_ntz

# Columns never loaded, and the control columns of every batch.
DENIED_COLUMNS = (
    "EHAIL_FEE",
    "TRIP_TYPE",
    "ACCESS_A_RIDE_FLAG",
    "SHARED_REQUEST_FLAG",
    "SHARED_MATCH_FLAG",
)
CONTROL_COLUMNS = ("LOAD_YEAR", "LOAD_MONTH", "LOAD_SERVICE_TYPE")


def normalise_name(name: str) -> str:
    """Upper case, with everything but digits, A-Z and underscore replaced by underscore."""
    return re.sub("[^0-9A-Z_]", "_", name.upper())


def normalise_columns(df: DataFrame) -> DataFrame:
    """Normalised names; of equal names the first column stays, blank names go."""
    places: dict[str, int] = {}
    for place, column in enumerate(df.columns):
        places.setdefault(normalise_name(column), place)
    # Positional renaming first: names may clash, and Spark ignores their case.
    numbered = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return numbered.select(
        *[F.col(f"_{place}").alias(name) for name, place in places.items() if name.strip()]
    )


def keep_known_columns(df: DataFrame, target: Iterable[str] | None) -> DataFrame:
    """Only the columns the target table has (or control columns); all if it is unknown."""
    known = {c.upper() for c in target or ()}
    if not known:
        return df
    return df.select(*[c for c in df.columns if c.upper() in known | set(CONTROL_COLUMNS)])


# Texts of a date and time besides ISO, as older files have them.
DATE_PATTERNS = ("MM/dd/yyyy hh:mm:ss a", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm", "MM/dd/yyyy")


def read_datetime(text: Column) -> Column:
    """A zone-less timestamp from ISO text or one of ``DATE_PATTERNS``; NULL if none fits."""
    parsed = [
        F.to_timestamp_ntz(F.when(text.rlike(_shape(p)), text), F.lit(p)) for p in DATE_PATTERNS
    ]
    return F.coalesce(text.try_cast("timestamp_ntz"), *parsed)


def _shape(pattern: str) -> str:
    """A regular expression of valid texts, so that parsing never meets anything else."""
    parts = {
        "MM": "(0[1-9]|1[0-2])",
        "dd": "(0[1-9]|1[0-9]|2[0-8])",
        "yyyy": "[0-9]{4}",
        "HH": "([01][0-9]|2[0-3])",
        "hh": "(0[1-9]|1[0-2])",
        "mm": "[0-5][0-9]",
        "ss": "[0-5][0-9]",
        "a": "(AM|PM)",
    }
    # Days 29 to 31 only in months that have them; 29 February is left to leap years.
    late = "((0[13-9]|1[0-2])/(29|30)|(0[13578]|1[02])/31)"
    tail = re.sub("yyyy|HH|hh|mm|ss|a", lambda m: parts[m[0]], pattern[len("MM/dd") :])
    leap = "02/29/([0-9]{2}(0[48]|[2468][048]|[13579][26])|([02468][048]|[13579][26])00)"
    rest = tail.replace("/[0-9]{4}", "", 1)
    return f"^(({parts['MM']}/{parts['dd']}|{late}){tail}|{leap}{rest})$"


def coerce_datetime_columns(df: DataFrame) -> DataFrame:
    """Turn columns with DATE in their name into zone-less timestamps, each all or nothing.

    Texts are ISO or one of ``DATE_PATTERNS``. A text column with one unreadable value stays text;
    all text candidates are tested in a single aggregate over the data. Numbers are epoch
    nanoseconds.
    """
    candidates = [f for f in df.schema if "DATE" in f.name.upper()]
    texts = [f.name for f in candidates if isinstance(f.dataType, T.StringType)]
    readable = set()
    if texts:
        unread = df.agg(
            *[
                F.count_if(F.col(c).isNotNull() & read_datetime(F.col(c)).isNull())
                .alias(c)
                for c in texts
            ]
        ).first()
        readable = {c for c in texts if unread[c] == 0}
    changed = {}
    for field in candidates:
        column = F.col(field.name)
        if field.name in readable:
            changed[field.name] = read_datetime(column)
        elif isinstance(field.dataType, T.NumericType):
            changed[field.name] = ns_to_ntz(column)
        elif isinstance(field.dataType, T.DateType):
            changed[field.name] = column.cast("timestamp_ntz")
    return df.withColumns(changed) if changed else df


def add_control_columns(df: DataFrame, service: str, year: int, month: int) -> DataFrame:
    return df.withColumns(
        {
            "LOAD_YEAR": F.lit(year),
            "LOAD_MONTH": F.lit(month),
            "LOAD_SERVICE_TYPE": F.lit(service),
        }
    )


def backfill_control_columns(df: DataFrame, service: str, year: int, month: int) -> DataFrame:
    """Add missing control columns; fill all three where the load year is NULL."""
    values = {"LOAD_YEAR": year, "LOAD_MONTH": month, "LOAD_SERVICE_TYPE": service}
    present = {c.upper() for c in df.columns}
    unset = F.col("LOAD_YEAR").isNull() if "LOAD_YEAR" in present else F.lit(True)
    return df.withColumns(
        {
            name: F.when(unset, F.lit(value)).otherwise(
                F.col(name) if name in present else F.lit(None)
            )
            for name, value in values.items()
        }
    )


def conform_batch(
    df: DataFrame,
    target: Sequence[str] | None = None,
    denied: Sequence[str] = DENIED_COLUMNS,
) -> DataFrame:
    """Normalise names, drop denied and unknown columns, read date columns."""
    named = normalise_columns(df).drop(*denied)
    return coerce_datetime_columns(keep_known_columns(named, target))


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types; absent ones become typed NULLs.

    A fractional number, or a text, becomes an integral one by rounding half away from zero;
    Spark's own cast would cut the fraction off.
    """
    present = {f.name.upper(): f.dataType for f in df.schema}

    def fitted(field: T.StructField) -> Column:
        kind = present.get(field.name.upper())
        if kind is None:
            return F.lit(None).cast(field.dataType)
        column = F.col(field.name)
        whole = isinstance(field.dataType, T.IntegralType)
        if whole and isinstance(kind, T.FloatType | T.DoubleType | T.DecimalType):
            column = F.round(column)
        elif whole and isinstance(kind, T.StringType):
            # Decimal digits survive where a double would lose them.
            column = F.round(column.try_cast("decimal(38,10)"))
        return column.try_cast(field.dataType) if whole else column.cast(field.dataType)

    return df.select(*[fitted(f).alias(f.name) for f in schema])


def common_type(one: T.DataType, other: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; text if nothing else does."""
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if isinstance(one, whole) and isinstance(other, whole):
        return max(one, other, key=lambda t: whole.index(type(t)))
    if isinstance(one, T.NumericType) and isinstance(other, T.NumericType):
        return T.DoubleType()
    times = T.DateType | T.TimestampType | T.TimestampNTZType
    if isinstance(one, times) and isinstance(other, times):
        return T.TimestampNTZType()
    return T.StringType()


def united_schema(schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns of several batches, in the order of their first appearance, widened."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema:
            name = field.name.upper()
            kind = common_type(fields[name].dataType, field.dataType) if name in fields else field.dataType
            fields[name] = T.StructField(fields[name].name if name in fields else field.name, kind)
    return T.StructType(list(fields.values()))
