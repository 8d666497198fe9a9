"""Star schema: one trip fact and its date, zone, payment, rate-code, vendor, time dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.functions import minute_of_day
from tripmart.operators.interleave import interleaved, rank_bounds
from tripmart.plans.silver import stage_zones, trip_minutes, with_trip_id
from tripmart.session import BROADCAST_ROWS, Kept, keep, small_side

# First and last calendar day, labels of codes, vendors.
FIRST_DAY, LAST_DAY = "2015-01-01", "2025-12-31"
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
OTHER_PAYMENT = "Other"
RATECODE_LABELS = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}
OTHER_RATECODE = "Unknown"
VENDORS = {
    1: "Creative Mobile Technologies (CMT)",
    2: "VeriFone Inc.",
    0: "Unknown",
}

# Own choice: trips from 06:00 to 17:59 count as day trips.
DAY_HOURS = (6, 17)

FACT_KEYS = (
    "pickup_date",
    "dropoff_date",
    "pickup_zone",
    "dropoff_zone",
    "payment_type",
    "ratecode",
    "vendor",
)
TIME_KEYS = ("pickup_time", "dropoff_time")
FACT_MEASURES = (
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
)
DOCUMENTED_MEASURES = (
    "congestion_surcharge",
    "extra",
    "tolls_amount",
    "load_year",
    "load_month",
)


# ---------------------------------------------------------------- dimensions


def _minute(trips: DataFrame, end: str) -> Column:
    """Minute of the day of a trip's pickup or dropoff."""
    staged = f"{end}_minute"
    return F.col(staged) if staged in trips.columns else minute_of_day(F.col(f"{end}_datetime"))


def observed_members(
    trips: DataFrame, roles: Sequence[str] = ("date", "payment_type", "ratecode"),
    source: str = "yellow",
) -> DataFrame:
    """Distinct (role, member) pairs that occur in the trips, found in one scan.

    Dates, payment types and rate codes come from ``source`` (a service, or ``"all"``);
    minutes of the day from every trip. Members are ints: a date is its epoch day.
    """
    every = source == "all"
    if not every and "time" not in roles:
        trips, every = trips.where(F.col("service_type") == source), True
    counted = F.lit(True) if every else F.col("service_type") == source

    def day(name: str) -> Column:
        in_calendar = F.col(name).between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date"))
        return F.when(counted & in_calendar, F.unix_date(name))

    found = {
        "date": [day("pickup_date"), day("dropoff_date")],
        "payment_type": [F.when(counted, F.col("payment_type"))],
        "ratecode": [F.when(counted, F.col("ratecode_id"))],
        "time": [_minute(trips, "pickup"), _minute(trips, "dropoff")],
    }
    pairs = [
        F.struct(F.lit(role).alias("role"), member.cast("int").alias("member"))
        for role in roles
        for member in found[role]
    ]
    return (
        trips.select(F.explode(F.array(*pairs)).alias("pair"))
        .select("pair.role", "pair.member")
        .where(F.col("member").isNotNull())
        .distinct()
    )


def _members(members: DataFrame, role: str) -> DataFrame:
    return members.where(F.col("role") == role).select("member")


def dim_date(members: DataFrame) -> DataFrame:
    """Calendar of the dates that occur, numbered from 1.

    The window runs over at most 4,018 dates, the days of the calendar.
    """
    dates = _members(members, "date").select(F.date_from_unix_date("member").alias("date_value"))
    return calendar(
        dates.withColumn("date_sk", F.row_number().over(Window.orderBy("date_value")))
    )


def calendar(numbered: DataFrame) -> DataFrame:
    """The attributes of numbered dates (date_value, date_sk)."""
    date = F.col("date_value")
    return numbered.select(
        F.col("date_sk").cast("int").alias("date_sk"),
        "date_value",
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
        F.date_format(date, "MMM").alias("month_name"),
        F.date_format(date, "EEEE").alias("day_name"),
    )


def _label(code: Column, labels: Mapping[int, str], other: str) -> Column:
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.lit(other))


def dim_payment_type(members: DataFrame) -> DataFrame:
    code = F.col("member")
    return _members(members, "payment_type").select(
        code.alias("payment_type_sk"),
        _label(code, PAYMENT_LABELS, OTHER_PAYMENT).alias("payment_type_desc"),
    )


def dim_ratecode(members: DataFrame) -> DataFrame:
    code = F.col("member")
    return _members(members, "ratecode").select(
        code.alias("ratecode_sk"),
        _label(code, RATECODE_LABELS, OTHER_RATECODE).alias("ratecode_desc"),
    )


def dim_time(members: DataFrame) -> DataFrame:
    """Minutes of the day that occur (at most 1,440), with hour and day or night."""
    hour = F.floor(F.col("member") / 60).cast("int")
    return _members(members, "time").select(
        F.col("member").alias("time_sk"),
        hour.alias("hour"),
        (F.col("member") % 60).alias("minute"),
        F.when(hour.between(*DAY_HOURS), "day").otherwise("night").alias("day_part"),
    )


def dim_zone(zones: DataFrame) -> DataFrame:
    return zones.select(
        F.col("location_id").alias("zone_sk"),
        F.col("zone").alias("zone_name"),
        "borough",
        "service_zone",
    )


def dim_vendor(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(VENDORS.items()), "vendor_sk int, vendor_name string")


class Star(NamedTuple):
    """The dimensions, each with (a bound of) its row count."""

    dim_date: Kept
    dim_zone: Kept
    dim_payment_type: Kept | None = None
    dim_ratecode: Kept | None = None
    dim_time: Kept | None = None


def build_star(
    trips: DataFrame,
    bronze_zones: DataFrame,
    roles: Sequence[str] = ("date", "payment_type", "ratecode"),
    source: str = "yellow",
) -> Star:
    """The dimensions named in ``roles``, and the zones; the trips are scanned once.

    The members found and the zones are written, by two jobs at once; the other dimensions
    are views on the members.
    """
    with ThreadPoolExecutor(2) as pool:
        zones = pool.submit(lambda: keep(dim_zone(stage_zones(bronze_zones)), "dim_zone"))
        members = keep(observed_members(trips, roles, source), "members")
    # All members together bound each dimension; only if they are many is each role counted.
    rows = dict.fromkeys(roles, members.rows)
    if members.rows > BROADCAST_ROWS:
        counted = members.df.groupBy("role").agg(F.count(F.lit(1)).alias("n"))
        rows |= {row["role"]: row["n"] for row in counted.collect()}  # one row per role
    makers = {
        "date": dim_date,
        "payment_type": dim_payment_type,
        "ratecode": dim_ratecode,
        "time": dim_time,
    }
    made = {
        f"dim_{role}": Kept(makers[role](members.df), rows[role], members.path)
        for role in roles
    }
    return Star(dim_zone=zones.result(), **made)


# ---------------------------------------------------------------- fact


def _attach(trips: DataFrame, dim: Kept, natural: str, sk: str, on: str, key: str) -> DataFrame:
    """Left join one dimension's surrogate key as ``<key>_sk``."""
    side = small_side(dim).select(F.col(natural).alias(f"__{key}"), F.col(sk).alias(f"{key}_sk"))
    return trips.join(side, F.col(on) == F.col(f"__{key}"), "left")


def fct_trips(
    trips: DataFrame,
    star: Star,
    keys: Sequence[str] = FACT_KEYS,
    measures: Sequence[str] = FACT_MEASURES,
    vendor_fanout: bool = False,
) -> DataFrame:
    """The trip fact: ``trips`` with the surrogate keys named in ``keys``, and the duration.

    ``trips`` may lack ``trip_id``, which no mart needs. By default a trip meets its own
    vendor; ``vendor_fanout`` pairs each trip with every vendor, which triples all counts
    and sums.
    """
    computed = {"trip_duration_min": trip_minutes(trips)}
    if set(TIME_KEYS) & set(keys):
        computed |= {f"{end}_minute": _minute(trips, end) for end in ("pickup", "dropoff")}
    fact = trips.withColumns(computed)
    lookups = {
        "pickup_date": (star.dim_date, "date_value", "date_sk", "pickup_date"),
        "dropoff_date": (star.dim_date, "date_value", "date_sk", "dropoff_date"),
        "pickup_zone": (star.dim_zone, "zone_sk", "zone_sk", "pickup_location_id"),
        "dropoff_zone": (star.dim_zone, "zone_sk", "zone_sk", "dropoff_location_id"),
        "payment_type": (star.dim_payment_type, "payment_type_sk", "payment_type_sk", "payment_type"),
        "ratecode": (star.dim_ratecode, "ratecode_sk", "ratecode_sk", "ratecode_id"),
        "pickup_time": (star.dim_time, "time_sk", "time_sk", "pickup_minute"),
        "dropoff_time": (star.dim_time, "time_sk", "time_sk", "dropoff_minute"),
    }
    for key in keys:
        if key in lookups:
            dim, natural, sk, on = lookups[key]
            fact = _attach(fact, dim, natural, sk, on, key)
    if "vendor" in keys:
        if vendor_fanout:
            every = F.array(*[F.lit(v) for v in VENDORS])
            fact = fact.withColumn("vendor_sk", F.explode(every))
        else:
            vendors = F.broadcast(dim_vendor(trips.sparkSession).select("vendor_sk"))
            fact = fact.join(vendors, F.col("vendor_id") == F.col("vendor_sk"), "left")
    return fact.select(
        *(["trip_id"] if "trip_id" in trips.columns else []),
        *[f"{key}_sk" for key in keys],
        *measures,
        F.col("load_service_type").alias("service_type"),
        "trip_duration_min",
    )


CLUSTER_KEYS = ("service_type", "pickup_date_sk", "pickup_zone_sk", "trip_id")


def cluster_fact(fact: DataFrame, path: str, partitions: int | None = None) -> DataFrame:
    """Write the fact sorted by date and zone within each service, and read it back.

    The trip id, last of the range keys, lets a hot (date, zone) span several files. Parquet
    statistics then skip files and row groups for filters on date or zone.
    """
    n = [] if partitions is None else [partitions]
    (
        fact.repartitionByRange(*n, *CLUSTER_KEYS)
        .sortWithinPartitions(*CLUSTER_KEYS)
        .write.mode("overwrite")
        .partitionBy("service_type")
        .parquet(path)
    )
    # Partition columns come last on disk.
    return fact.sparkSession.read.schema(fact.schema).parquet(path).select(*fact.columns)


INTERLEAVED_KEYS = ("pickup_date_sk", "pickup_zone_sk")


def interleave_fact(
    fact: DataFrame,
    path: str,
    partitions: int | None = None,
    keys: Sequence[str] = INTERLEAVED_KEYS,
) -> DataFrame:
    """Write the fact so that filters on any one of ``keys`` skip files, and read it back.

    ``cluster_fact`` serves its first key best; this layout serves each key alike, a little less.
    """
    key = interleaved(rank_bounds(fact, keys))
    order = ["service_type", "__key", "trip_id"]
    n = [] if partitions is None else [partitions]
    (
        fact.withColumn("__key", key)
        .repartitionByRange(*n, *order)
        .sortWithinPartitions(*order)
        .drop("__key")
        .write.mode("overwrite")
        .partitionBy("service_type")
        .parquet(path)
    )
    return fact.sparkSession.read.schema(fact.schema).parquet(path).select(*fact.columns)


def build_gold(
    trips: DataFrame, bronze_zones: DataFrame, folder: str, source: str = "yellow"
) -> tuple[DataFrame, Star]:
    """Write the whole gold layer below ``folder``: the clustered fact and all five dimensions.

    ``trips`` are the staged trips of all services, without ids. The fact is joined with the
    written dimensions. Returns the tables read back; ``read_gold`` opens them later.
    """
    star = build_star(trips, bronze_zones, source=source)
    made = {
        name: keep(dim.df, name, f"{folder}/{name}")
        for name, dim in star._asdict().items()
        if dim is not None
    }
    keep(dim_vendor(trips.sparkSession), "dim_vendor", f"{folder}/dim_vendor")
    written = Star(**made)
    fact = fct_trips(with_trip_id(trips), written)
    return cluster_fact(fact, f"{folder}/fct_trips"), written


def read_gold(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables that ``build_gold`` has written, by name."""
    names = ("fct_trips", "dim_date", "dim_zone", "dim_payment_type", "dim_ratecode", "dim_vendor")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}
