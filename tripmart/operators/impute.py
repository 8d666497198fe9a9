"""Filling NULLs with the upper median of each column."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators.row_id import PART, range_sorted
from tripmart.session import keep


def _common(kind: T.DataType) -> str:
    """The type in which a column's values are compared, without loss."""
    if isinstance(kind, T.IntegralType):
        return "bigint"
    return kind.simpleString() if isinstance(kind, T.DecimalType) else "double"


def upper_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, Any]:
    """``sorted(non-null values)[floor(n / 2)]`` of each numeric column.

    Exact, and no task sees a whole column: equal values are counted first, in one scan for all
    columns, the counts are range-sorted, and a running sum is taken only in the one partition per
    column that holds the middle row. Every type has a field of its own, so that no value passes
    through a type that cannot hold it. A column without values is left out.
    """
    if not columns:
        return {}
    kinds = {c: _common(df.schema[c].dataType) for c in columns}
    fields = {kind: f"value{i}" for i, kind in enumerate(dict.fromkeys(kinds.values()))}

    def cell(column: str) -> Column:
        own = kinds[column]
        values = [
            (F.col(column) if kind == own else F.lit(None)).cast(kind).alias(name)
            for kind, name in fields.items()
        ]
        return F.when(F.col(column).isNotNull(), F.struct(F.lit(column).alias("column"), *values))

    names = list(fields.values())
    counts = (
        df.select(F.inline(F.array_compact(F.array(*[cell(c) for c in columns]))))
        .groupBy("column", *names)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # The counts come out of a shuffle, so they are written before positions are taken.
    placed = keep(range_sorted(keep(counts, "value-counts").df, ["column", *names]), "values").df

    whole = Window.partitionBy("column")
    upto = whole.orderBy(PART).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.floor(F.sum("n").over(whole) / 2)
    parts = (
        placed.groupBy("column", PART)
        .agg(F.sum("n").alias("n"))
        .select("column", PART, "n", F.sum("n").over(upto).alias("end"), middle.alias("middle"))
        .where((F.col("end") - F.col("n") <= F.col("middle")) & (F.col("middle") < F.col("end")))
        .select("column", PART, (F.col("middle") - (F.col("end") - F.col("n"))).alias("rank"))
    )
    running = Window.partitionBy("column").orderBy(*names).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    found = (
        placed.join(F.broadcast(parts), ["column", PART])  # one row per column
        .withColumn("end", F.sum("n").over(running))
        .where((F.col("end") - F.col("n") <= F.col("rank")) & (F.col("rank") < F.col("end")))
        .select("column", *names)
    )
    return {r["column"]: r[fields[kinds[r["column"]]]] for r in found.collect()}  # one row a column


def impute_upper_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace the NULLs of each column by its upper median; an all-NULL column stays NULL."""
    medians = upper_medians(df, columns)
    filled = {
        c: F.coalesce(F.col(c), F.lit(medians[c]).cast(df.schema[c].dataType))
        for c in columns
        if c in medians
    }
    return df.withColumns(filled) if filled else df
