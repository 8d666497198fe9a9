"""Exact percentiles of any numbers per group, by distributed selection.

A percentile lies between two ranks. For every wanted rank an interval of values is kept that holds
it, first the whole range of its group. Each round counts the rows in ``BINS`` equal parts of every
interval, which shrinks a group of any size to that many rows per task, and goes on with the part
that holds the rank, between the least and the greatest value found in it. A rank is found when
both are equal. So no task sees a group, nothing is sorted, and heavy ties end early.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.session import keep, small_side

BINS = 1024


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Part of an interval a value falls into; never falls as the value rises. The ends are always
    apart, so that every round gets on. Halves keep the differences finite."""
    share = F.try_divide(value / 2 - low / 2, high / 2 - low / 2)
    inner = F.least(F.greatest(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(0)), F.lit(bins - 1))
    return F.when(value == high, F.lit(bins - 1)).when(value == low, F.lit(0)).otherwise(inner).cast("int")


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    match = F.lit(True)
    for a, b in zip(left, right, strict=True):
        match = match & F.col(a).eqNullSafe(F.col(b))
    return match


def exact_percentiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    shares: Sequence[float],
    bins: int = BINS,
) -> DataFrame:
    """(group, share, percentile) for every group and share, interpolated between the two ranks
    next to ``share * (n - 1)``. NULL, NaN and infinite values are left out; NULL is a group."""
    group = [*group]
    keys = [f"__g{i}" for i in range(len(group))]
    number = F.col(value).cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))
    rows = keep(
        df.where(finite).select(*[F.col(c).alias(k) for c, k in zip(group, keys, strict=True)], number.alias("v")),
        "selection-values",
    ).df
    sizes = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    wanted = sizes.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    place = F.col("share") * (F.col("n") - 1)
    wanted = keep(wanted.withColumn("place", place), "selection-wanted")
    ranks = F.array_distinct(F.array(F.floor("place"), F.ceil("place")))
    targets = keep(
        wanted.df.withColumn("rank", F.explode(ranks))
        .select(*keys, "rank", "low", "high", F.lit(0).cast("bigint").alias("below"))
        .distinct(),
        "selection-targets",
    )
    found = None
    while targets.rows:
        done = targets.df.where("low = high").select(*keys, "rank", F.col("low").alias("value"))
        found = done if found is None else found.unionByName(done)
        still = keep(targets.df.where("low < high"), "selection-open")
        if not still.rows:
            break
        intervals = still._replace(
            df=still.df.select(*[F.col(k).alias(f"i{k}") for k in keys], "low", "high").distinct()
        )
        inside = _same(keys, [f"i{k}" for k in keys]) & F.col("v").between(F.col("low"), F.col("high"))
        near = keep(rows.join(small_side(intervals), inside).select(*keys, "v", "low", "high"), "selection-near")
        parts = (
            near.df.groupBy(*keys, "low", "high", _bin(F.col("v"), F.col("low"), F.col("high"), bins).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
        )
        upto = Window.partitionBy(*keys, "low", "high").orderBy("bin")  # BINS rows at most
        parts = parts.withColumn("upto", F.sum("n").over(upto)).select(
            *[F.col(k).alias(f"p{k}") for k in keys],
            F.col("low").alias("p_low"),
            F.col("high").alias("p_high"),
            "least",
            "most",
            (F.col("upto") - F.col("n")).alias("before"),
            "upto",
        )
        inner = F.col("rank") - F.col("below")
        holds = (
            _same([*keys, "low", "high"], [*[f"p{k}" for k in keys], "p_low", "p_high"])
            & (F.col("before") <= inner)
            & (inner < F.col("upto"))
        )
        narrowed = still.df.join(parts, holds).select(
            *keys,
            "rank",
            F.col("least").alias("low"),
            F.col("most").alias("high"),
            (F.col("below") + F.col("before")).alias("below"),
        )
        targets = keep(narrowed, "selection-targets")
        rows = near.df.select(*keys, "v")
    if found is None:
        found = targets.df.select(*keys, "rank", F.col("low").alias("value"))
    values = keep(found, "selection-found").df

    def at(name: str) -> DataFrame:
        return values.select(
            *[F.col(k).alias(f"{name}{k}") for k in keys],
            F.col("rank").alias(f"{name}_rank"),
            F.col("value").alias(name),
        )

    out = wanted.df
    for name, rank in (("lower", F.floor("place")), ("upper", F.ceil("place"))):
        match = _same(keys, [f"{name}{k}" for k in keys]) & (rank == F.col(f"{name}_rank"))
        out = out.join(at(name), match)
    part = F.col("place") - F.floor("place")
    between = F.col("lower") * (1 - part) + F.col("upper") * part
    return out.select(
        *[F.col(k).alias(c) for k, c in zip(keys, group, strict=True)],
        "share",
        F.when(F.col("lower") == F.col("upper"), F.col("lower")).otherwise(between).alias("percentile"),
    )
