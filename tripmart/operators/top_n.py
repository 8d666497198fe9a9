"""Top rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    """The first ``n`` rows of every group; ``order`` should be total to be deterministic.

    Spark applies the limit before the shuffle as well, so a hot group sends at most ``n``
    rows per task.
    """
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")
