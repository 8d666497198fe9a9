"""Consecutive row numbers over a whole table, without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.session import keep, small_side

PART, SLOT = "__part", "__slot"
_COPY = "__copy"

# monotonically_increasing_id keeps the row's position in the low 33 bits.
_SLOT_MASK = 2**33 - 1


def range_sorted(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` in global key order, with each row's partition and position as columns.

    The row's position in the input is the last key, so that a large group of rows equal in
    all ``keys`` spreads over several partitions. The input must be repeatable: a scan, or
    a written table, with projections and filters on top.
    """
    placed = df.withColumn(_COPY, F.monotonically_increasing_id())
    order = [F.col(k) for k in [*keys, _COPY]]
    n = [] if partitions is None else [partitions]
    return (
        placed.repartitionByRange(*n, *order)
        .sortWithinPartitions(*order)
        .drop(_COPY)
        .withColumn(PART, F.spark_partition_id())
        .withColumn(SLOT, F.monotonically_increasing_id().bitwiseAND(F.lit(_SLOT_MASK)))
    )


def assign_row_id(
    df: DataFrame,
    name: str,
    order_by: Sequence[str],
    within: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Add ``name``: 1, 2, 3 … in the order of ``order_by`` (NULLs first) per ``within`` group.

    One range shuffle of the data, written once to the shared folder; then only the sizes of
    the partitions are summed up. Rows equal in all of ``order_by`` get distinct ids in any
    order: give enough columns to make the numbering deterministic.
    """
    within = list(within)
    placed = keep(range_sorted(df, [*within, *order_by], partitions), name).df

    # A group's rows form one run in each partition they reach: its length and first slot.
    runs = placed.groupBy(PART, *within).agg(
        F.count(F.lit(1)).alias("__n"), F.min(SLOT).alias("__first")
    )
    earlier = Window.partitionBy(*within).orderBy(PART).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = keep(
        runs.select(
            F.col(PART).alias("__p"),
            *[F.col(c).alias(f"__w_{c}") for c in within],
            (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__off"),
        ),
        f"{name}-offsets",
    )
    match = F.col(PART) == F.col("__p")
    for column in within:
        match = match & F.col(column).eqNullSafe(F.col(f"__w_{column}"))
    return placed.join(small_side(offsets), match).select(
        *df.columns, (F.col(SLOT) + F.col("__off") + 1).cast("bigint").alias(name)
    )
