"""Staging: typed trips of both services, zones, and the documented cleaning rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions import (
    as_date,
    as_epoch_minute,
    as_ntz,
    initcap_words,
    minute_diff,
    round_to_int,
    speed_mph,
)
from tripmart.operators.dedupe import keep_first_per_key
from tripmart.operators.history import KeyHistory
from tripmart.operators.row_id import assign_row_id
from tripmart.session import Kept, small_side
from tripmart.sources.tables import TIME_PREFIX

# Staged name and raw name of the copied columns.
WHOLE_NUMBERS = {
    "passenger_count": "passenger_count",
    "ratecode_id": "ratecodeid",
    "pickup_location_id": "pulocationid",
    "dropoff_location_id": "dolocationid",
    "payment_type": "payment_type",
    "load_year": "load_year",
    "load_month": "load_month",
}
MEASURES = (
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
)
MONEY = tuple(c for c in MEASURES if c != "trip_distance")

# Fixed order of the staged columns; the trip id goes before them.
STAGED_COLUMNS = (
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_date",
    "dropoff_date",
    "passenger_count",
    "trip_distance",
    "ratecode_id",
    "store_and_fwd_flag",
    "pickup_location_id",
    "dropoff_location_id",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
    "load_year",
    "load_month",
    "load_service_type",
    "service_type",
)


# Further staged columns, on demand. Durations and minutes are plain integer arithmetic here,
# and so stay cheap where a filter on them is pushed down and evaluated again.
VENDOR, DURATION = "vendor_id", "trip_duration_min"
MINUTES = ("pickup_minute", "dropoff_minute")


def stage_trips(
    bronze: DataFrame, service: str, money: str = "double", extras: Sequence[str] = ()
) -> DataFrame:
    """One service's typed trips, without id; rows lacking a pickup or dropoff time go.

    Columns the raw table lacks (a green airport fee) are typed NULLs. ``money="decimal"``
    gives NUMERIC(10,2) amounts. ``extras`` may name the vendor id, the duration in minute
    boundaries, and the pickup and dropoff minute of the day.
    """
    types = {f.name.lower(): f.dataType for f in bronze.schema}
    money_type = "decimal(10,2)" if money == "decimal" else "double"
    prefix = TIME_PREFIX[service]
    times = {end: f"{prefix}_{end}_datetime" for end in ("pickup", "dropoff")}

    def measure(name: str) -> Column:
        kind = money_type if name in MONEY else "double"
        return F.expr(f"cast({name if name in types else 'NULL'} AS {kind})")

    staged = {name: round_to_int(raw, types[raw]) for name, raw in WHOLE_NUMBERS.items()}
    staged |= {name: measure(name) for name in MEASURES}
    staged["service_type"] = F.lit(service)
    minute = {}
    for end, raw in times.items():
        staged[f"{end}_datetime"] = as_ntz(raw, types[raw])
        staged[f"{end}_date"] = as_date(raw, types[raw])
        if extras:
            minute[end] = as_epoch_minute(raw, types[raw])
            staged[f"{end}_minute"] = F.pmod(minute[end], F.lit(1440)).cast("int")
    if VENDOR in extras:
        staged[VENDOR] = round_to_int("vendorid", types["vendorid"])
    if DURATION in extras:
        staged[DURATION] = minute["dropoff"] - minute["pickup"]
    known = bronze.where(" AND ".join(f"{raw} IS NOT NULL" for raw in times.values()))
    columns = (*STAGED_COLUMNS, *extras)
    return known.select(*[staged[c].alias(c) if c in staged else c for c in columns])


def trip_minutes(trips: DataFrame) -> Column:
    """Duration of staged trips in minute boundaries."""
    if DURATION in trips.columns:
        return F.col(DURATION)
    return minute_diff(F.col("pickup_datetime"), F.col("dropoff_datetime"))


def all_trips(yellow: DataFrame, green: DataFrame) -> DataFrame:
    return yellow.unionByName(green)


def with_trip_id(trips: DataFrame) -> DataFrame:
    """Number the trips of each service by pickup time, from 1.

    The remaining columns break ties, so only rows equal in every column are arbitrary. The
    id is unique together with ``service_type``.
    """
    implied = {"service_type", "pickup_date", "dropoff_date", DURATION, *MINUTES}
    order = [c for c in trips.columns if c not in implied]
    numbered = assign_row_id(trips, "trip_id", order, within=["service_type"])
    return numbered.select("trip_id", *trips.columns)


def stage_zones(bronze: DataFrame) -> DataFrame:
    """Zone lookup in title case, without duplicates or missing ids."""
    return (
        bronze.where(F.col("locationid").isNotNull())
        .select(
            round_to_int("locationid", bronze.schema["locationid"].dataType).alias("location_id"),
            initcap_words(F.col("borough")).alias("borough"),
            initcap_words(F.col("zone")).alias("zone"),
            initcap_words(F.col("service_zone")).alias("service_zone"),
        )
        .distinct()
    )


def _violations(
    minutes: Column, max_minutes: int = 180, max_mph: float = 80.0
) -> dict[str, Column]:
    broken = {
        "trip_distance": F.col("trip_distance") <= 0,
        "fare_amount": F.col("fare_amount") < 0,
        "duration": ~minutes.between(1, max_minutes),
        "speed": speed_mph(F.col("trip_distance"), minutes) > max_mph,
    }
    return {rule: F.coalesce(test, F.lit(False)) for rule, test in broken.items()}


def clean_trips(trips: DataFrame) -> DataFrame:
    """Drop trips without distance, with a negative fare, of odd duration or speed.

    A missing value breaks no rule.
    """
    kept = F.lit(True)
    for broken in _violations(trip_minutes(trips)).values():
        kept = kept & ~broken
    return trips.where(kept)


def clean_report(trips: DataFrame) -> DataFrame:
    """Rows each cleaning rule rejects, and rows kept, in one pass."""
    rules = _violations(trip_minutes(trips))
    kept = F.lit(True)
    for broken in rules.values():
        kept = kept & ~broken
    counts = trips.agg(
        *[F.count_if(broken).alias(rule) for rule, broken in rules.items()],
        F.count_if(kept).alias("kept"),
    )
    return counts.unpivot([], [*rules, "kept"], "rule", "n_trips")


TRIP_KEY = ("service_type", "pickup_datetime", "dropoff_datetime", "vendor_id")


def trip_history(spark: SparkSession, **options) -> KeyHistory:
    """Trips met in earlier loads, by month of pickup."""
    at = F.col("pickup_datetime")
    return KeyHistory(spark, TRIP_KEY, F.year(at) * 12 + F.month(at), **options)


def dedupe_trips(trips: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """One trip per service, pickup, dropoff and vendor: the least by all other columns."""
    return keep_first_per_key(trips, key or TRIP_KEY)


def zone_conformance(
    trips: DataFrame, dim_zone: Kept, column: str = "pickup_location_id", rejects: bool = False
) -> DataFrame:
    """Trips whose zone is in the zone dimension; with ``rejects`` the others."""
    match = F.col(column) == F.col("zone_sk")
    zones = small_side(dim_zone).select("zone_sk")
    return trips.join(zones, match, "left_anti" if rejects else "left_semi")
