"""The five questions as states of single months that add up.

A state holds, for every load month, the least that its question needs: counts, parts of exact sums
(``functions.exact``), and counts per minute value for percentiles. A month that is loaded again
replaces its own part, and nothing else is read. Merging is a sum over months, so the answers are
the same, bit for bit, however the months were built; the finishing steps are those of the marts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions import iso_weekday, month_label, percent_of, speed_mph
from tripmart.functions.exact import merged_parts, sum_parts, total
from tripmart.plans import marts
from tripmart.plans.gold import Star
from tripmart.plans.increments import (
    MONTH,
    Refresh,
    months_in,
    partition_path,
    read_fact,
    staged_months,
)
from tripmart.session import remove_path, small_side
from tripmart.sources.ingest import Month


class State(NamedTuple):
    """Keys of a state, columns that are counted up, and columns that are summed exactly."""

    keys: tuple[str, ...]
    counts: tuple[str, ...]
    sums: tuple[str, ...] = ()

    def _columns(self) -> list[str]:
        return list(dict.fromkeys([*MONTH, *self.keys]))

    def of(self, rows: DataFrame) -> DataFrame:
        """One row per load month and key, from rows with the keys, counts and values."""
        counted = [F.sum(c).alias(c) for c in self.counts]
        summed = [part for name in self.sums for part in sum_parts(F.col(name), name)]
        return rows.groupBy(*self._columns()).agg(*counted, *summed)

    def merged(self, states: DataFrame) -> DataFrame:
        """One row per key over all load months given."""
        counted = [F.sum(c).alias(c) for c in self.counts]
        summed = [part for name in self.sums for part in merged_parts(name)]
        return states.groupBy(*self.keys).agg(*counted, *summed)


STATES = {
    "zone_trips": State(("end", "year_month", "zone_name", "service_type"), ("num_trips",)),
    "borough_revenue": State(
        ("year_month", "borough", "service_type"), ("n_pct",), ("total_amount", "tip_pct")
    ),
    "borough_speed": State(("trip_year", "trip_month", "borough", "service_type"), ("n",), ("mph",)),
    "zone_minutes": State(
        ("trip_year", "trip_month", "pickup_zone", "service_type", "trip_duration_min"), ("n",)
    ),
    "hourly_trips": State(("pickup_date", "pickup_hour", "at_midnight", "service_type"), ("n",)),
}


# ---------------------------------------------------------------- rows of each state


def _zone_trips(fact: DataFrame, star: Star) -> DataFrame:
    """Each trip at both of its ends, from one scan."""
    ends = F.array(
        *[
            F.struct(
                F.lit(end).alias("end"),
                F.col(f"{end}_date_sk").alias("at_date_sk"),
                F.col(f"{end}_zone_sk").alias("at_zone_sk"),
            )
            for end in ("pickup", "dropoff")
        ]
    )
    both = fact.select(*MONTH, F.explode(ends).alias("at")).select(*MONTH, "at.*")
    dates, zones = small_side(star.dim_date), small_side(star.dim_zone)
    return (
        both.join(dates, F.col("at_date_sk") == F.col("date_sk"))
        .join(zones, F.col("at_zone_sk") == F.col("zone_sk"), "left")
        .withColumns({"year_month": month_label(F.col("date_value")), "num_trips": F.lit(1)})
    )


def _borough_revenue(fact: DataFrame, star: Star) -> DataFrame:
    share = percent_of(F.col("tip_amount"), F.col("fare_amount"))
    return (
        marts.starred(fact, star)
        .where(F.col("date_value").isNotNull() & marts.known_borough())
        .withColumns(
            {
                "year_month": month_label(F.col("date_value")),
                "tip_pct": share,
                "n_pct": share.isNotNull().cast("int"),
            }
        )
    )


def _borough_speed(fact: DataFrame, star: Star) -> DataFrame:
    mph = speed_mph(F.col("trip_distance"), F.col("trip_duration_min"))
    return (
        marts.starred(fact, star)
        .where(marts.plausible_speed(mph))
        .withColumns(
            {"trip_year": F.col("year"), "trip_month": F.col("month"), "mph": mph, "n": F.lit(1)}
        )
    )


def _zone_minutes(fact: DataFrame, star: Star) -> DataFrame:
    return (
        marts.starred(fact, star)
        .where(marts.plausible_minutes())
        .withColumns(
            {
                "trip_year": F.col("year"),
                "trip_month": F.col("month"),
                "pickup_zone": F.col("zone_name"),
                "n": F.lit(1),
            }
        )
    )


def hourly_rows(trips: DataFrame) -> DataFrame:
    """Staged trips by day and hour; those at midnight apart, as a bound may count only them."""
    at = F.col("pickup_datetime")
    return trips.withColumns(
        {
            "pickup_hour": F.hour(at),
            "at_midnight": at == F.col("pickup_date").cast("timestamp_ntz"),
            "n": F.lit(1),
        }
    )


FACT_ROWS: dict[str, Callable[[DataFrame, Star], DataFrame]] = {
    "zone_trips": _zone_trips,
    "borough_revenue": _borough_revenue,
    "borough_speed": _borough_speed,
    "zone_minutes": _zone_minutes,
}


# ---------------------------------------------------------------- keeping states


def write_states(fact: DataFrame, star: Star, trips: DataFrame, folder: str) -> None:
    """Write the states of the load months in ``fact`` and ``trips`` over those kept of them."""
    rows = {name: make(fact, star) for name, make in FACT_ROWS.items()}
    rows["hourly_trips"] = hourly_rows(trips)
    for name, state in STATES.items():
        (
            state.of(rows[name])
            .repartition(*MONTH)  # states are small; a month's goes to one file
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*MONTH)
            .parquet(f"{folder}/states/{name}")
        )


def refresh_states(
    spark: SparkSession, target: str, folder: str, done: Refresh
) -> None:
    """Bring the states below the gold ``folder`` up to a refresh of its fact.

    Reads the rebuilt months of the fact and of the raw layer at ``target``, and nothing else.
    """
    for name in STATES:
        for month in [*done.removed, *done.rebuilt]:
            remove_path(spark, partition_path(f"{folder}/states/{name}", month, MONTH))
    if done.rebuilt:
        fact = read_fact(spark, folder).where(months_in(done.rebuilt, MONTH))
        write_states(fact, done.star, staged_months(spark, target, done.rebuilt, ()), folder)


def read_state(
    spark: SparkSession, folder: str, name: str, months: Iterable[Month] | None = None
) -> DataFrame:
    """A question's state over all load months, or over some; then only their files are read."""
    kept = spark.read.parquet(f"{folder}/states/{name}")
    if months is not None:
        kept = kept.where(months_in(list(months), MONTH))
    return STATES[name].merged(kept)


# ---------------------------------------------------------------- answers


def top_zones_by_month(state: DataFrame, end: str = "pickup", n: int = 10) -> DataFrame:
    return marts.top_zones_of(state.where(F.col("end") == end).drop("end"), n)


def revenue_tips_by_borough(state: DataFrame) -> DataFrame:
    """Question 2 with sums that no order of rows or months changes."""
    return state.select(
        "year_month",
        "borough",
        "service_type",
        total("total_amount").alias("total_revenue"),
        F.try_divide(total("tip_pct"), F.col("n_pct")).alias("avg_tip_pct"),
    ).orderBy("year_month", F.desc_nulls_first("total_revenue"))


def exact_revenue_tips(fact: DataFrame, star: Star) -> DataFrame:
    """The same without kept states."""
    state = STATES["borough_revenue"]
    rows = _borough_revenue(fact, star)
    summed = [part for name in state.sums for part in sum_parts(F.col(name), name)]
    return revenue_tips_by_borough(
        rows.groupBy(*state.keys).agg(F.sum("n_pct").alias("n_pct"), *summed)
    )


def average_speed(state: DataFrame) -> DataFrame:
    keys: Sequence[str] = STATES["borough_speed"].keys
    order: list[Column] = [F.asc_nulls_last(k) for k in keys]
    return state.select(*keys, (total("mph") / F.col("n")).alias("avg_mph")).orderBy(*order)


def duration_percentiles(state: DataFrame, limit: int | None = 50) -> DataFrame:
    return marts.percentiles_of(state, limit)


def temporal_demand(state: DataFrame, first: str = "2019-01-01", last: str = "2019-01-31") -> DataFrame:
    """Question 5 between two days; of the last one only midnight counts."""
    day = F.col("pickup_date")
    until = F.lit(last).cast("date")
    names = F.create_map(*[F.lit(x) for pair in marts.WEEKDAYS.items() for x in pair])
    return (
        state.where(
            (day >= F.lit(first).cast("date")) & ((day < until) | ((day == until) & F.col("at_midnight")))
        )
        .groupBy(
            "pickup_date", iso_weekday(day).alias("day_number"), "pickup_hour", "service_type"
        )
        .agg(F.sum("n").alias("num_trips"))
        .withColumn("day_name", names[F.col("day_number")])
        .orderBy("pickup_date", "pickup_hour", "service_type")
    )
