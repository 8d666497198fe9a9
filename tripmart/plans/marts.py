"""The five business questions on the star, and the aggregates behind their charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions import iso_weekday, month_label, percent_of, speed_mph
from tripmart.operators.top_n import top_n_per_group
from tripmart.plans.gold import Star
from tripmart.session import small_side

# Weekday names by ISO number, and borough values that mean "not known".
WEEKDAYS = {
    1: "MONDAY",
    2: "TUESDAY",
    3: "WEDNESDAY",
    4: "THURSDAY",
    5: "FRIDAY",
    6: "SATURDAY",
    7: "SUNDAY",
}
NO_BOROUGH = ("Unknown", "None", "")


def starred(fact: DataFrame, star: Star, end: str = "pickup") -> DataFrame:
    """The fact with the calendar and zone attributes of its ``end`` (pickup or dropoff)."""
    dates = small_side(star.dim_date)
    zones = small_side(star.dim_zone)
    return fact.join(dates, F.col(f"{end}_date_sk") == F.col("date_sk"), "left").join(
        zones, F.col(f"{end}_zone_sk") == F.col("zone_sk"), "left"
    )


def plausible_minutes() -> Column:
    return F.col("trip_duration_min").between(1, 180)


def known_borough() -> Column:
    return F.col("borough").isNotNull() & ~F.col("borough").isin(*NO_BOROUGH)


def plausible_speed(mph: Column, max_mph: float = 80.0) -> Column:
    """Trips that count for the mean speed; their borough must be known, but may be empty."""
    named = F.col("borough").isNotNull() & ~F.col("borough").isin("Unknown", "None")
    return (F.col("trip_distance") > 0) & plausible_minutes() & (mph < max_mph) & named


# ---------------------------------------------------------------- question 1


def top_zones_by_month(fact: DataFrame, star: Star, end: str = "pickup", n: int = 10) -> DataFrame:
    """The ``n`` zones with most trips per month and service; ties by zone name.

    A trip id is never NULL, so trips are counted as rows.
    """
    monthly = (
        starred(fact, star, end)
        .where(F.col("date_value").isNotNull())
        .groupBy(month_label(F.col("date_value")).alias("year_month"), "zone_name", "service_type")
        .agg(F.count(F.lit(1)).alias("num_trips"))
    )
    return top_zones_of(monthly, n)


def top_zones_of(monthly: DataFrame, n: int = 10) -> DataFrame:
    """The first zones of each month and service, from counted trips (``num_trips``)."""
    order = [F.desc("num_trips"), F.asc_nulls_last("zone_name")]
    return top_n_per_group(monthly, ["year_month", "service_type"], order, n).orderBy(
        F.desc("year_month"), F.asc_nulls_last("service_type"), *order
    )


# ---------------------------------------------------------------- question 2


def revenue_tips_by_borough(fact: DataFrame, star: Star) -> DataFrame:
    """Revenue and mean tip share by month, known borough and service."""
    return (
        starred(fact, star)
        .where(F.col("date_value").isNotNull() & known_borough())
        .groupBy(month_label(F.col("date_value")).alias("year_month"), "borough", "service_type")
        .agg(
            F.sum("total_amount").alias("total_revenue"),
            F.avg(percent_of(F.col("tip_amount"), F.col("fare_amount"))).alias("avg_tip_pct"),
        )
        .orderBy("year_month", F.desc_nulls_first("total_revenue"))
    )


# ---------------------------------------------------------------- question 3


def average_speed(
    fact: DataFrame, star: Star, max_mph: float = 80.0, by_day_part: bool = False
) -> DataFrame:
    """Mean speed by year, month, borough and service over plausible trips.

    ``by_day_part`` splits by day and night as well; the fact then needs its pickup time key.
    """
    trips = starred(fact, star)
    extra = []
    if by_day_part:
        times = small_side(star.dim_time).select("time_sk", "day_part")
        trips = trips.join(times, F.col("pickup_time_sk") == F.col("time_sk"), "left")
        extra = ["day_part"]
    mph = speed_mph(F.col("trip_distance"), F.col("trip_duration_min"))
    return (
        trips.where(plausible_speed(mph, max_mph))
        .groupBy(
            F.col("year").alias("trip_year"),
            F.col("month").alias("trip_month"),
            "borough",
            "service_type",
            *extra,
        )
        .agg(F.avg(mph).alias("avg_mph"))
        .orderBy(
            F.asc_nulls_last("trip_year"),
            F.asc_nulls_last("trip_month"),
            "borough",
            F.asc_nulls_last("service_type"),
            *extra,
        )
    )


# ---------------------------------------------------------------- question 4


def duration_percentiles(fact: DataFrame, star: Star, limit: int | None = 50) -> DataFrame:
    """Exact median and 90th percentile of the minutes by month, pickup zone and service.

    Trips are first counted per minute value, at most 180 rows per group, so a hot group is
    reduced before the shuffle. The first ``limit`` rows by month, longest p90 first.
    """
    minutes = (
        starred(fact, star)
        .where(plausible_minutes())
        .groupBy(
            F.col("year").alias("trip_year"),
            F.col("month").alias("trip_month"),
            F.col("zone_name").alias("pickup_zone"),
            "service_type",
            "trip_duration_min",
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return percentiles_of(minutes, limit)


def percentiles_of(minutes: DataFrame, limit: int | None = 50) -> DataFrame:
    """Percentiles from trips counted (``n``) per group and minute value."""
    group = ["trip_year", "trip_month", "pickup_zone", "service_type"]
    both = F.percentile("trip_duration_min", F.array(F.lit(0.5), F.lit(0.9)), F.col("n"))
    ranked = (
        minutes.groupBy(*group)
        .agg(both.alias("p"))
        .select(
            *group,
            F.col("p")[0].alias("p50_duration"),
            F.col("p")[1].alias("p90_duration"),
        )
        .orderBy(
            F.asc_nulls_last("trip_year"),
            F.asc_nulls_last("trip_month"),
            F.desc_nulls_first("p90_duration"),
            F.asc_nulls_last("pickup_zone"),
            F.asc_nulls_last("service_type"),
        )
    )
    return ranked if limit is None else ranked.limit(limit)


def duration_zone_summary(percentiles: DataFrame, n: int = 15) -> DataFrame:
    """Mean percentiles by zone and service over the given rows, the ``n`` longest p90."""
    return (
        percentiles.dropna(subset=["pickup_zone", "service_type"])
        .groupBy("pickup_zone", "service_type")
        .agg(F.avg("p50_duration").alias("p50_duration"), F.avg("p90_duration").alias("p90_duration"))
        .orderBy(F.desc("p90_duration"), "pickup_zone", "service_type")
        .limit(n)
    )


def duration_long(summary: DataFrame) -> DataFrame:
    """The summary with one row per percentile."""
    named = summary.select(
        "pickup_zone",
        "service_type",
        F.col("p50_duration").alias("P50_DURATION"),
        F.col("p90_duration").alias("P90_DURATION"),
    )
    return named.unpivot(
        ["pickup_zone", "service_type"],
        ["P50_DURATION", "P90_DURATION"],
        "percentile",
        "duration_min",
    )


# ---------------------------------------------------------------- question 5


def temporal_demand(
    trips: DataFrame, first: str = "2019-01-01", last: str = "2019-01-31"
) -> DataFrame:
    """Trips by day, ISO weekday, hour and service, between two points in time.

    Both bounds are instants: by default the last day counts at midnight only.
    """
    at = F.col("pickup_datetime")
    bounds = [F.lit(b).cast("timestamp_ntz") for b in (first, last)]
    names = F.create_map(*[F.lit(x) for pair in WEEKDAYS.items() for x in pair])
    return (
        trips.where(at.between(*bounds))
        .groupBy(
            "pickup_date",
            iso_weekday(F.col("pickup_date")).alias("day_number"),
            F.hour(at).alias("pickup_hour"),
            "service_type",
        )
        .agg(F.count(F.lit(1)).alias("num_trips"))
        .withColumn("day_name", names[F.col("day_number")])
        .orderBy("pickup_date", "pickup_hour", "service_type")
    )


def weekday_hour_heatmap(demand: DataFrame) -> DataFrame:
    """Trips by hour (rows) and weekday (columns, Monday first)."""
    return (
        demand.groupBy("pickup_hour")
        .pivot("day_name", list(WEEKDAYS.values()))
        .agg(F.sum("num_trips"))
        .orderBy("pickup_hour")
    )


def hourly_curve(demand: DataFrame) -> DataFrame:
    return (
        demand.groupBy("pickup_hour", "service_type")
        .agg(F.sum("num_trips").alias("num_trips"))
        .orderBy("pickup_hour", "service_type")
    )


# ---------------------------------------------------------------- chart data


def chart_means(rows: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """What a bar or line chart draws: the unweighted mean of ``values`` per ``by``.

    Rows with a missing axis value are not drawn.
    """
    return (
        rows.dropna(subset=list(by))
        .groupBy(*by)
        .agg(*[F.avg(v).alias(v) for v in values])
        .orderBy(*by)
    )


# ---------------------------------------------------------------- load report


def load_counts(bronze: DataFrame) -> DataFrame:
    """Rows loaded per service, year and month."""
    return (
        bronze.groupBy("load_service_type", "load_year", "load_month")
        .agg(F.count(F.lit(1)).alias("total_rows"))
        .orderBy("load_year", "load_month", "load_service_type")
    )
