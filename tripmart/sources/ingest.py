"""Monthly files into the partitioned raw layer, with a coverage log."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions import round_to_int
from tripmart.operators.conform import (
    add_control_columns,
    align_to_schema,
    conform_batch,
    normalise_columns,
    united_schema,
)
from tripmart.session import open_files, path_exists, remove_path

# Fixed value: name of a month's file below the source folder.
MONTH_FILE = "{service}_tripdata_{year}-{month:02d}.parquet"

# Fixed value: where a month's file name holds service, year and month.
MONTH_NAME = r"([a-z]+)_tripdata_(\d{4})-(\d{2})"

MONTH_PARTITIONS = ["LOAD_SERVICE_TYPE", "LOAD_YEAR", "LOAD_MONTH"]

# Texts that mean "missing" in the zone file.
MISSING_TEXTS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

ZONE_FILE_SCHEMA = "LocationID string, Borough string, Zone string, service_zone string"


class Month(NamedTuple):
    service: str
    year: int
    month: int


class Outcome(NamedTuple):
    """One coverage log row; ``rows`` are those loaded."""

    month: Month
    file_exists: bool
    load_status: str
    error: str | None = None
    rows: int | None = None


def months_between(service: str, first: tuple[int, int], last: tuple[int, int]) -> list[Month]:
    start, end = first[0] * 12 + first[1] - 1, last[0] * 12 + last[1] - 1
    return [Month(service, m // 12, m % 12 + 1) for m in range(start, end + 1)]


def month_path(source: str, month: Month, template: str = MONTH_FILE) -> str:
    return f"{source}/" + template.format(**month._asdict())


def named_months(files: DataFrame) -> list[Month]:
    """Months that the files' names (column ``path``) hold: one per calendar month at most."""
    path = F.col("path")
    named = files.select(
        F.regexp_extract(path, MONTH_NAME, 1).alias("service"),
        F.regexp_extract(path, MONTH_NAME, 2).alias("year"),
        F.regexp_extract(path, MONTH_NAME, 3).alias("month"),
    ).distinct()
    return sorted(Month(s, int(y), int(m)) for s, y, m in named.collect() if s)


def months_present(spark: SparkSession, source: str) -> list[Month]:
    """Months with a file below ``source``; lists the files without reading them."""
    if not path_exists(spark, source):
        return []
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return named_months(listing.load(source).select("path"))


def ingest_months(
    spark: SparkSession,
    source: str,
    months: Sequence[Month],
    schema: T.StructType,
    target: Sequence[str] | None = None,
    template: str = MONTH_FILE,
) -> DataFrame:
    """Files of one service and one schema, conformed, with control columns from their names.

    ``target`` lists the raw table's columns once that is frozen.
    """
    paths = [month_path(source, month, template) for month in months]
    found = spark.read.schema(schema).parquet(*paths)
    # Plain string search; a pattern match per row would cost more.
    stamp = F.substring_index("_metadata.file_path", "_tripdata_", -1)
    batch = found.withColumns(
        {
            "LOAD_YEAR": F.substring(stamp, 1, 4).cast("int"),
            "LOAD_MONTH": F.substring(stamp, 6, 2).cast("int"),
            "LOAD_SERVICE_TYPE": F.lit(months[0].service),
        }
    )
    return conform_batch(batch, target)


def ingest_month(
    spark: SparkSession,
    source: str,
    month: Month,
    target: Sequence[str] | None = None,
    template: str = MONTH_FILE,
) -> DataFrame:
    """One month's file, conformed and with its control columns."""
    batch = spark.read.parquet(month_path(source, month, template))
    return add_control_columns(conform_batch(batch, target), *month)


def ingest_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone lookup CSV: normalised names, integer ids, missing-value texts as NULL."""
    texts = spark.read.option("header", True).schema(ZONE_FILE_SCHEMA).csv(path)
    named = normalise_columns(texts)
    known = named.select(
        *[F.when(~F.col(c).isin(*MISSING_TEXTS), F.col(c)).alias(c) for c in named.columns]
    )
    return known.withColumn("LOCATIONID", round_to_int("LOCATIONID", T.StringType()))


# The raw table's schema lies in this folder below it; Spark passes over such names.
SCHEMA_FOLDER = "_schema"


def _data_fields(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema if f.name.upper() not in MONTH_PARTITIONS]


def stored_schema(spark: SparkSession, target: str) -> T.StructType | None:
    """Columns of the raw table without its partition columns; None if there is no table."""
    folder = f"{target}/{SCHEMA_FOLDER}"
    if not path_exists(spark, folder):
        return None
    rows = spark.read.text(folder, wholetext=True).collect()
    return T.StructType.fromJson(json.loads(rows[0].value)) if rows else None


def store_schema(spark: SparkSession, target: str, schema: T.StructType) -> None:
    text = T.StructType(_data_fields(schema)).json()
    rows = spark.createDataFrame([(text,)], "value string").coalesce(1)
    rows.write.mode("overwrite").text(f"{target}/{SCHEMA_FOLDER}")


def read_raw(spark: SparkSession, target: str) -> DataFrame:
    """The raw table with all columns it was created with, whatever each month's files hold."""
    schema = stored_schema(spark, target)
    if schema is None:
        raise ValueError(f"no raw table at {target}")
    control = "LOAD_SERVICE_TYPE string, LOAD_YEAR int, LOAD_MONTH int"
    fields = [*_data_fields(schema), *T._parse_datatype_string(control)]
    return spark.read.schema(T.StructType(fields)).parquet(target)


def _partition_path(target: str, month: Month) -> str:
    values = (month.service, month.year, month.month)
    return "/".join([target, *[f"{c}={v}" for c, v in zip(MONTH_PARTITIONS, values, strict=True)]])


def _replace_months(
    batch: DataFrame, target: str, schema: T.StructType, months: Sequence[Month]
) -> dict[Month, int]:
    """Write a batch over its months, leaving all other months alone; rows of each month.

    Rows are counted from the files' footers. A month without rows loses its old ones, which the
    write alone would leave.
    """
    spark = batch.sparkSession
    found = batch.groupBy("LOAD_YEAR", "LOAD_MONTH").count().collect()
    rows = {(r["LOAD_YEAR"], r["LOAD_MONTH"]): r["count"] for r in found}
    control = [f for f in batch.schema if f.name in MONTH_PARTITIONS]
    fitted = align_to_schema(batch, T.StructType([*_data_fields(schema), *control]))
    (
        fitted.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*MONTH_PARTITIONS)
        .parquet(target)
    )
    counted = {m: rows.get((m.year, m.month), 0) for m in months}
    for month, n in counted.items():
        if not n:
            remove_path(spark, _partition_path(target, month))
    return counted


def _needs_own_job(schema: T.StructType) -> bool:
    """Whether a text date column has to be judged month by month."""
    return any(isinstance(f.dataType, T.StringType) and "DATE" in f.name.upper() for f in schema)


def backfill_months(
    spark: SparkSession,
    source: str,
    months: Iterable[Month],
    target: str,
    schema: T.StructType | None = None,
    per_job: int = 24,
    at_once: int = 4,
    template: str = MONTH_FILE,
) -> list[Outcome]:
    """Load months into the raw layer; a repeated month replaces its earlier rows.

    The raw table has one schema, kept beside it: that of the table if there is one, else
    ``schema``, else the columns of all these months, each wide enough for all of them. Batches are
    fitted to it: unknown columns are dropped, absent ones are NULL. Read it with ``read_raw``.

    Months of one service whose files have the same schema share a job, up to ``per_job`` of
    them. If a job fails, each half of its months is loaded again, down to the broken file, which
    spoils only its own month. Rows go from the file to their partition without a shuffle or a sort.
    """
    months = sorted(set(months))
    present = set(months_present(spark, source))

    def shape(month: Month) -> tuple[Month, T.StructType | str]:
        try:
            return month, spark.read.parquet(month_path(source, month, template)).schema
        except Exception as error:  # an unreadable file is logged
            return month, str(error)

    def batch_of(kind: T.StructType, members: list[Month], known: list[str] | None) -> DataFrame:
        if len(members) == 1:
            return ingest_month(spark, source, members[0], known, template)
        return ingest_months(spark, source, members, kind, known, template)

    def conformed(job: tuple[T.StructType, list[Month]]) -> T.StructType | None:
        try:
            return batch_of(*job, None).schema
        except Exception:  # a broken file; its load will say so
            return None

    def load_job(job: tuple[T.StructType, list[Month]]) -> list[Outcome]:
        kind, members = job
        try:
            batch = batch_of(kind, members, frozen.names)
            rows = _replace_months(batch, target, frozen, members)
            return [Outcome(month, True, "OK", rows=rows[month]) for month in members]
        except Exception as error:  # the others go on
            if len(members) == 1:
                return [Outcome(members[0], True, "ERROR", str(error))]
            half = len(members) // 2
            return load_job((kind, members[:half])) + load_job((kind, members[half:]))

    with open_files(spark, per_job), ThreadPoolExecutor(at_once) as pool:
        outcomes = [Outcome(m, False, "ERROR", "no file") for m in months if m not in present]
        groups: dict[tuple[str, str], tuple[T.StructType, list[Month]]] = {}
        for month, kind in pool.map(shape, [m for m in months if m in present]):
            if isinstance(kind, str):
                outcomes.append(Outcome(month, True, "ERROR", kind))
            else:
                groups.setdefault((month.service, kind.json()), (kind, []))[1].append(month)
        jobs = [
            (kind, members[i : i + step])
            for kind, members in groups.values()
            for step in [1 if _needs_own_job(kind) else per_job]
            for i in range(0, len(members), step)
        ]
        frozen = stored_schema(spark, target) or schema
        if frozen is None and jobs:
            found = [s for s in pool.map(conformed, jobs) if s is not None]
            frozen = T.StructType(_data_fields(united_schema(found))) if found else None
        if frozen is not None:
            store_schema(spark, target, frozen)
            for done in pool.map(load_job, jobs):
                outcomes.extend(done)
        else:
            outcomes.extend(Outcome(m, True, "ERROR", "unreadable") for _, ms in jobs for m in ms)
    return sorted(outcomes, key=lambda o: o.month)


# ---------------------------------------------------------------- coverage

COVERAGE_SCHEMA = (
    "LOAD_SERVICE_TYPE string, LOAD_YEAR int, LOAD_MONTH int, FILE_EXISTS boolean, "
    "LOAD_STATUS string, LOADED_ROWS bigint"
)


def coverage_rows(spark: SparkSession, outcomes: Sequence[Outcome]) -> DataFrame:
    """Log rows of one batch, stamped with the time of logging."""
    rows = [(*o.month, o.file_exists, o.load_status, o.rows) for o in outcomes]
    return spark.createDataFrame(rows, COVERAGE_SCHEMA).withColumn(
        "LOGGED_AT", F.current_timestamp()
    )


def log_coverage(spark: SparkSession, outcomes: Sequence[Outcome], path: str) -> None:
    """Append a batch's outcomes to the coverage log."""
    coverage_rows(spark, outcomes).coalesce(1).write.mode("append").parquet(path)


def latest_outcomes(log: DataFrame) -> DataFrame:
    """Latest log row per service, year and month."""
    kept = ["FILE_EXISTS", "LOAD_STATUS", "LOADED_ROWS"]
    latest = F.max_by(F.struct(*kept), "LOGGED_AT").alias("latest")
    return (
        log.groupBy("LOAD_SERVICE_TYPE", "LOAD_YEAR", "LOAD_MONTH")
        .agg(latest)
        .select("LOAD_SERVICE_TYPE", "LOAD_YEAR", "LOAD_MONTH", "latest.*")
    )


def coverage_matrix(log: DataFrame) -> DataFrame:
    """Latest outcome per service, year and month."""
    months = ["LOAD_SERVICE_TYPE", "LOAD_YEAR", "LOAD_MONTH"]
    return latest_outcomes(log).select(*months, "FILE_EXISTS", "LOAD_STATUS").orderBy(*months)


def coverage_runs(matrix: DataFrame) -> DataFrame:
    """Runs of consecutive months that are loaded, or missing, per service.

    A month that was never asked for ends a run. The windows run over months.
    """
    number = F.col("LOAD_YEAR") * 12 + F.col("LOAD_MONTH") - 1
    loaded = F.coalesce(F.col("LOAD_STATUS") == "OK", F.lit(False))
    alike = Window.partitionBy("LOAD_SERVICE_TYPE", "LOADED").orderBy("NUMBER")

    def label(month: Column) -> Column:
        year = F.floor(month / 12)
        return F.format_string("%04d-%02d", year.cast("int"), (month - year * 12 + 1).cast("int"))

    return (
        matrix.select("LOAD_SERVICE_TYPE", loaded.alias("LOADED"), number.alias("NUMBER"))
        .withColumn("RUN", F.col("NUMBER") - F.row_number().over(alike))
        .groupBy("LOAD_SERVICE_TYPE", "LOADED", "RUN")
        .agg(
            F.min("NUMBER").alias("FIRST"),
            F.max("NUMBER").alias("LAST"),
            F.count(F.lit(1)).alias("N_MONTHS"),
        )
        .select(
            "LOAD_SERVICE_TYPE",
            "LOADED",
            label(F.col("FIRST")).alias("FIRST_MONTH"),
            label(F.col("LAST")).alias("LAST_MONTH"),
            "N_MONTHS",
        )
        .orderBy("LOAD_SERVICE_TYPE", "FIRST_MONTH")
    )


def failed_months(spark: SparkSession, log: str) -> list[Month]:
    """Months with a file whose latest load failed; none without a log."""
    try:
        rows = spark.read.parquet(log)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return []
        raise
    failed = latest_outcomes(rows).where("FILE_EXISTS AND LOAD_STATUS = 'ERROR'")
    months = failed.select("LOAD_SERVICE_TYPE", "LOAD_YEAR", "LOAD_MONTH").collect()
    return sorted(Month(*r) for r in months)
