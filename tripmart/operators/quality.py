"""Data checks: one row (check, table, column, n_failing, status) each.

``n_failing`` is the number of rows of the matching ``failing_*`` frame, which can be stored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------- failing rows


def failing_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def failing_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count; keys with a NULL don't count."""
    return (
        df.dropna(subset=list(key))
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
    )


def failing_relationships(
    df: DataFrame, column: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Rows whose non-NULL ``column`` has no partner in ``parent``."""
    keys = parent.select(F.col(parent_key).alias("__parent"))
    return df.where(F.col(column).isNotNull()).join(
        keys, F.col(column) == F.col("__parent"), "left_anti"
    )


def failing_accepted_values(df: DataFrame, column: str, accepted: Sequence[Any]) -> DataFrame:
    """Unexpected non-NULL values, with their row count."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(*accepted))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def failing_range(df: DataFrame, violation: Column) -> DataFrame:
    return df.where(violation)


def store_failures(failing: DataFrame, folder: str, name: str) -> str:
    """Write a check's failing rows; returns their path."""
    path = f"{folder}/{name}"
    failing.write.mode("overwrite").parquet(path)
    return path


# ---------------------------------------------------------------- results


def _result(counts: DataFrame, check: str, table: str) -> DataFrame:
    """Turn (column, n_failing) rows into check results."""
    n = F.coalesce(F.col("n_failing"), F.lit(0)).cast("bigint")
    return counts.select(
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        F.col("column"),
        n.alias("n_failing"),
        F.when(n == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"),
    )


def check_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """All columns of a table in one pass."""
    columns = list(columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _result(counts.unpivot([], columns, "column", "n_failing"), "not_null", table)


def check_unique(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    counts = failing_unique(df, key).agg(F.count(F.lit(1)).alias("n_failing"))
    label = F.lit(", ".join(key)).alias("column")
    return _result(counts.select(label, "n_failing"), "unique", table)


def check_relationships(
    df: DataFrame, table: str, parents: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """All foreign keys of a table in one pass: ``{column: (parent frame, parent key)}``.

    The child rows are first reduced to one row per distinct key value, so that only key
    values meet the parents, however many rows one value holds.
    """
    columns = list(parents)
    values = (
        df.select(*[F.col(c).cast("bigint").alias(c) for c in columns])
        .unpivot([], columns, "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = None
    for column, (parent, key) in parents.items():
        one = parent.select(
            F.lit(column).alias("column"), F.col(key).cast("bigint").alias("value")
        ).distinct()
        known = one if known is None else known.unionByName(one)
    orphans = values.join(known, ["column", "value"], "left_anti").select("column", "n")
    # A zero per column, so that columns without orphans are reported as well.
    zeros = df.sparkSession.createDataFrame([(c, 0) for c in columns], "column string, n bigint")
    counts = orphans.unionByName(zeros).groupBy("column").agg(F.sum("n").alias("n_failing"))
    return _result(counts, "relationships", table)


def check_accepted_values(
    df: DataFrame, table: str, accepted: Mapping[str, Sequence[Any]]
) -> DataFrame:
    """All listed columns of a table in one pass: ``{column: accepted values}``.

    Counts the unexpected values, not their rows; values are compared as texts.
    """
    columns = list(accepted)
    fine = F.lit(False)
    for column, values in accepted.items():
        known = [str(v) for v in values]
        fine = fine | ((F.col("column") == column) & F.col("value").isin(*known))
    counts = (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], columns, "column", "value")
        .where(F.col("value").isNotNull() & ~fine)
        .distinct()
        .select("column", F.lit(1).cast("bigint").alias("n"))
    )
    zeros = df.sparkSession.createDataFrame([(c, 0) for c in columns], "column string, n bigint")
    found = counts.unionByName(zeros).groupBy("column").agg(F.sum("n").alias("n_failing"))
    return _result(found, "accepted_values", table)


def check_range(df: DataFrame, table: str, label: str, violation: Column) -> DataFrame:
    counts = df.agg(F.count_if(violation).alias("n_failing"))
    return _result(counts.select(F.lit(label).alias("column"), "n_failing"), "range", table)


def check_not_empty(df: DataFrame, table: str) -> DataFrame:
    """Fails, with one missing row, if the table has none; reads one row only."""
    counts = df.limit(1).agg((1 - F.count(F.lit(1))).alias("n_failing"))
    return _result(counts.select(F.lit("*").alias("column"), "n_failing"), "not_empty", table)


def union_results(results: Sequence[DataFrame]) -> DataFrame:
    out = results[0]
    for result in results[1:]:
        out = out.unionByName(result)
    return out
