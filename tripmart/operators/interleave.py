"""A sort key that serves filters on any of several columns: ranks with interleaved bits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 8


def rank_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """At most ``2**bits - 1`` bounds per column between parts of about equally many rows.

    One aggregate for all columns. A value that holds many rows is one bound, not several.
    """
    shares = [k / 2**bits for k in range(1, 2**bits)]
    found = df.agg(
        *[F.percentile_approx(c, shares, 100 * 2**bits).alias(c) for c in columns]
    ).first()  # the bounds alone reach the driver
    return {c: sorted(set(found[c] or [])) for c in columns}


def _rank(column: str, bounds: Sequence) -> Column:
    """Number of bounds a value reaches, by a balanced tree of comparisons; NULL is 0."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(column) < F.lit(bounds[middle]), between(low, middle)).otherwise(
            between(middle + 1, high)
        )

    return F.when(F.col(column).isNull(), F.lit(0)).otherwise(between(0, len(bounds)))


def interleaved(bounds: dict[str, list], bits: int = BITS) -> Column:
    """The columns' ranks with their bits dealt out in turn, the highest first, as a long.

    Rows near in the key are near in every column, each on the scale of its own ranks.
    """
    if bits * len(bounds) > 62:
        raise ValueError("the key holds 62 bits")
    ranks = [_rank(c, b).cast("bigint") for c, b in bounds.items()]
    key = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, rank in enumerate(reversed(ranks)):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(ranks) + place))
    return key


def file_ranges(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of every file of a table, and the range of each column in it, as its footer has them."""
    ends = [end for c in columns for end in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))]
    return table.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"), *ends
    )


def read_for(ranges: DataFrame, wanted: dict[str, tuple]) -> DataFrame:
    """Files and rows that statistics cannot spare a reader of the wanted ranges (low, high)."""
    touched = F.lit(True)
    for column, (low, high) in wanted.items():
        touched = touched & (F.col(f"max_{column}") >= low) & (F.col(f"min_{column}") <= high)
    return ranges.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("n_rows").alias("rows"),
        F.count_if(touched).alias("files_read"),
        F.coalesce(F.sum(F.when(touched, F.col("n_rows"))), F.lit(0)).alias("rows_read"),
    )
