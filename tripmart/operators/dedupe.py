"""One surviving row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first_per_key(
    df: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Keep, per ``key``, the row that is least by ``order_by`` and then by all other columns.

    One aggregate, no window: the input is read once, and a key that holds many rows shrinks to
    one row per task before the only shuffle. Rows equal in everything are interchangeable, so the
    result is deterministic. NULL keys form one group, as in GROUP BY; NULLs sort first.
    """
    key = list(key)
    first = [c for c in order_by if c not in key]
    rest = [c for c in df.columns if c not in key and c not in first]
    if not first and not rest:
        return df.distinct()
    least = F.min(F.struct(*first, *rest)).alias("__least")
    return (
        df.groupBy(*key)
        .agg(least)
        .select(*[c if c in key else F.col("__least")[c].alias(c) for c in df.columns])
    )
