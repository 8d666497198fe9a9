"""Every job of the engine as a query over the given tables.

Each entry takes (spark, folder) and returns a frame whose DuckDB twin stands in
``registry/oracle.py``. Dates are returned as ISO text and inexact numbers rounded, so that
results of two engines can be compared.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions import minute_of_day, ns_to_ntz, speed_mph
from tripmart.functions.sql import register_sql_functions
from tripmart.operators import conform, quality, row_checks
from tripmart.operators.impute import impute_upper_median
from tripmart.operators.row_id import assign_row_id
from tripmart.operators.selection import exact_percentiles
from tripmart.operators.top_n import top_n_per_group
from tripmart.plans import gold, increments, marts, silver, states
from tripmart.plans.suite import declared_checks, fact_rules, range_violation, staged_rules
from tripmart.session import Kept, file_states, keep, new_path, open_files
from tripmart.sources import ingest, sinks
from tripmart.sources.tables import (
    TIME_PREFIX,
    bronze_trips,
    bronze_zones,
    read_table,
    service_bronze,
)
from tripmart.streaming import trips as trips_stream
from tripmart.streaming.months import stream_backfill

Query = Callable[[SparkSession, str], DataFrame]

ALL_ROLES = ("date", "payment_type", "ratecode")


# ---------------------------------------------------------------- presentation


def plain(df: DataFrame) -> DataFrame:
    """Dates as ISO text."""
    dates = [f.name for f in df.schema if isinstance(f.dataType, T.DateType)]
    return df.withColumns({c: F.col(c).cast("string") for c in dates}) if dates else df


def rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


# ---------------------------------------------------------------- shared inputs

# Rows of a raw file at most.
RAW_FILE_ROWS = 1_000_000

# Paths of prepared inputs by session, folder and the state of its files.
_raw_paths: dict[tuple, str] = {}
_source_paths: dict[tuple, str] = {}
_gold_paths: dict[tuple, tuple[DataFrame, gold.Star]] = {}


def _input_key(spark: SparkSession, folder: str) -> tuple:
    """Changes when a table that the trips come from does."""
    tables = ("lineitem", "supplier", "nation", "region")
    files = [f for table in tables for f in file_states(spark, f"{folder}/{table}.parquet")]
    return (spark.sparkContext.applicationId, folder, *files)


def raw_trips(spark: SparkSession, folder: str) -> DataFrame:
    """The raw trip layer: a written table, as in production, made once per session and input.

    Files hold at most ``RAW_FILE_ROWS`` rows. Queries then read single columns of it, and skip
    the other service's files.
    """
    key = _input_key(spark, folder)
    bronze = bronze_trips(spark, folder)
    if key not in _raw_paths:
        path = new_path(spark, "raw-trips")
        sinks.write_chunked(bronze, path, RAW_FILE_ROWS, ["load_service_type"])
        _raw_paths[key] = path
    return spark.read.schema(bronze.schema).parquet(_raw_paths[key])


def _trips(spark: SparkSession, folder: str, *extras: str) -> DataFrame:
    bronze = raw_trips(spark, folder)
    return silver.all_trips(
        *[
            silver.stage_trips(service_bronze(bronze, service), service, extras=extras)
            for service in ("yellow", "green")
        ]
    )


def _fact_and_star(
    spark: SparkSession, folder: str, *keys: str, roles: tuple[str, ...] = ("date",)
) -> tuple[DataFrame, gold.Star]:
    """The part of the fact that a mart reads (no trip id), and its dimensions."""
    trips = _trips(spark, folder, silver.DURATION, *silver.MINUTES)
    star = gold.build_star(trips, bronze_zones(spark, folder), roles)
    return gold.fct_trips(trips, star, keys), star


def _full_fact(
    spark: SparkSession, folder: str, **options
) -> tuple[DataFrame, gold.Star, DataFrame]:
    """The whole fact with trip ids, its dimensions and the staged trips."""
    unnumbered = _trips(spark, folder, silver.VENDOR, silver.DURATION, *silver.MINUTES)
    roles = options.pop("roles", ALL_ROLES)
    star = gold.build_star(unnumbered, bronze_zones(spark, folder), roles)
    trips = silver.with_trip_id(unnumbered)
    return gold.fct_trips(trips, star, **options), star, trips


# ---------------------------------------------------------------- silver


def stage_trips(spark: SparkSession, folder: str) -> DataFrame:
    yellow = service_bronze(raw_trips(spark, folder), "yellow")
    return plain(silver.with_trip_id(silver.stage_trips(yellow, "yellow")))


def stage_green_trips(spark: SparkSession, folder: str) -> DataFrame:
    green = service_bronze(raw_trips(spark, folder), "green")
    return plain(silver.with_trip_id(silver.stage_trips(green, "green")))


def all_trips(spark: SparkSession, folder: str) -> DataFrame:
    return plain(silver.with_trip_id(_trips(spark, folder)))


def assign_trip_id(spark: SparkSession, folder: str) -> DataFrame:
    """One numbering over all trips, with the sales keys as tie-breakers."""
    items = read_table(spark, folder, "lineitem")
    keys = ["l_shipdate", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    return assign_row_id(items.select(*keys), "trip_id", keys)


def stage_zones_dim_zone(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_zone(silver.stage_zones(bronze_zones(spark, folder)))


def clean_trips(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = silver.clean_trips(_trips(spark, folder, silver.DURATION))
    return plain(cleaned.drop(silver.DURATION))


def clean_report(spark: SparkSession, folder: str) -> DataFrame:
    return silver.clean_report(_trips(spark, folder, silver.DURATION))


def dedupe_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Every trip stands twice in the input, the second time with another total."""
    trips = _trips(spark, folder, silver.VENDOR)
    copies = trips.withColumn("total_amount", F.col("total_amount") + 1)
    return plain(silver.dedupe_trips(trips.unionByName(copies)))


def by_year(trips: DataFrame) -> DataFrame:
    """Staged trips as a written table of one folder a load year, so that a year reads its own files."""
    spark, path = trips.sparkSession, new_path(trips.sparkSession, "yearly-trips")
    with open_files(spark):
        trips.write.partitionBy("load_year").parquet(path)
    return spark.read.schema(trips.schema).parquet(path).select(*trips.columns)


def dedupe_across_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Each year's load brings the trips of the year before once more, dearer by one."""
    trips = by_year(_trips(spark, folder, silver.VENDOR))
    years = sorted(r[0] for r in trips.select("load_year").distinct().collect())
    history = silver.trip_history(spark)
    kept = None
    try:
        for year in [*years, years[-1] + 1]:
            late = trips.where(F.col("load_year") == year - 1).withColumn(
                "total_amount", F.col("total_amount") + 1
            )
            fresh = history.add(trips.where(F.col("load_year") == year).unionByName(late))
            kept = fresh if kept is None else kept.unionByName(fresh)
    finally:
        history.drop()
    return plain(kept)


def _zone_dimension(spark: SparkSession, folder: str) -> Kept:
    return keep(gold.dim_zone(silver.stage_zones(bronze_zones(spark, folder))), "dim_zone")


def zone_conformance(spark: SparkSession, folder: str) -> DataFrame:
    zones = _zone_dimension(spark, folder)
    return plain(silver.zone_conformance(_trips(spark, folder), zones, "dropoff_location_id"))


def zone_conformance_rejects(spark: SparkSession, folder: str) -> DataFrame:
    zones = _zone_dimension(spark, folder)
    return plain(
        silver.zone_conformance(_trips(spark, folder), zones, "dropoff_location_id", rejects=True)
    )


# ---------------------------------------------------------------- gold


def _dimension(make: Callable[[DataFrame], DataFrame], role: str, source: str = "yellow") -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        trips = _trips(spark, folder, *silver.MINUTES)
        return plain(make(gold.observed_members(trips, [role], source)))

    return query


def fct_trips(spark: SparkSession, folder: str) -> DataFrame:
    return _full_fact(spark, folder)[0]


def fct_trips_vendor_fanout(spark: SparkSession, folder: str) -> DataFrame:
    return _full_fact(spark, folder, vendor_fanout=True)[0]


def fct_trips_documented(spark: SparkSession, folder: str) -> DataFrame:
    return _full_fact(
        spark,
        folder,
        roles=(*ALL_ROLES, "time"),
        keys=(*gold.FACT_KEYS, *gold.TIME_KEYS),
        measures=(*gold.FACT_MEASURES, *gold.DOCUMENTED_MEASURES),
    )[0]


def gold_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, gold.Star]:
    """The gold layer as written tables, made once per session and input."""
    key = _input_key(spark, folder)
    if key not in _gold_paths:
        trips = _trips(spark, folder, silver.VENDOR, silver.DURATION, *silver.MINUTES)
        _gold_paths[key] = gold.build_gold(
            trips, bronze_zones(spark, folder), new_path(spark, "gold")
        )
    return _gold_paths[key]


def cluster_fact(spark: SparkSession, folder: str) -> DataFrame:
    return gold_tables(spark, folder)[0]


def interleave_fact(spark: SparkSession, folder: str) -> DataFrame:
    fact, _ = gold_tables(spark, folder)
    return gold.interleave_fact(fact, new_path(spark, "interleaved"))


# ---------------------------------------------------------------- marts


def q1_pickup_top_zones(spark: SparkSession, folder: str) -> DataFrame:
    fact, star = _fact_and_star(spark, folder, "pickup_date", "pickup_zone")
    return marts.top_zones_by_month(fact, star)


def q1_dropoff_top_zones(spark: SparkSession, folder: str) -> DataFrame:
    fact, star = _fact_and_star(spark, folder, "dropoff_date", "dropoff_zone")
    return marts.top_zones_by_month(fact, star, "dropoff")


def q2_revenue_tips(spark: SparkSession, folder: str) -> DataFrame:
    fact, star = _fact_and_star(spark, folder, "pickup_date", "pickup_zone")
    revenue = marts.revenue_tips_by_borough(fact, star)
    return rounded(revenue, {"total_revenue": 2, "avg_tip_pct": 6})


def q2_revenue_tips_vendor_fanout(spark: SparkSession, folder: str) -> DataFrame:
    trips = _trips(spark, folder, silver.VENDOR, silver.DURATION)
    star = gold.build_star(trips, bronze_zones(spark, folder), ["date"])
    keys = ("pickup_date", "pickup_zone", "vendor")
    fact = gold.fct_trips(trips, star, keys, vendor_fanout=True)
    revenue = marts.revenue_tips_by_borough(fact, star)
    return rounded(revenue, {"total_revenue": 2, "avg_tip_pct": 6})


def q3_speed(spark: SparkSession, folder: str) -> DataFrame:
    fact, star = _fact_and_star(spark, folder, "pickup_date", "pickup_zone")
    return rounded(marts.average_speed(fact, star), {"avg_mph": 6})


def q3_speed_hour_band(spark: SparkSession, folder: str) -> DataFrame:
    fact, star = _fact_and_star(
        spark, folder, "pickup_date", "pickup_zone", "pickup_time", roles=("date", "time")
    )
    return rounded(marts.average_speed(fact, star, by_day_part=True), {"avg_mph": 6})


def _percentiles(spark: SparkSession, folder: str, limit: int | None = 50) -> DataFrame:
    fact, star = _fact_and_star(spark, folder, "pickup_date", "pickup_zone")
    return marts.duration_percentiles(fact, star, limit)


PERCENTILE_DIGITS = {"p50_duration": 6, "p90_duration": 6}


def q4_duration_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_percentiles(spark, folder), PERCENTILE_DIGITS)


def q4_duration_percentiles_all(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_percentiles(spark, folder, None), PERCENTILE_DIGITS)


def duration_zone_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(marts.duration_zone_summary(_percentiles(spark, folder)), PERCENTILE_DIGITS)


def duration_long(spark: SparkSession, folder: str) -> DataFrame:
    summary = marts.duration_zone_summary(_percentiles(spark, folder))
    return rounded(marts.duration_long(summary), {"duration_min": 6})


def duration_zone_summary_all(spark: SparkSession, folder: str) -> DataFrame:
    """The same over all rows of the percentiles."""
    every = _percentiles(spark, folder, None)
    return rounded(marts.duration_zone_summary(every), PERCENTILE_DIGITS)


def duration_long_all(spark: SparkSession, folder: str) -> DataFrame:
    summary = marts.duration_zone_summary(_percentiles(spark, folder, None))
    return rounded(marts.duration_long(summary), {"duration_min": 6})


def q5_temporal_demand(spark: SparkSession, folder: str) -> DataFrame:
    return plain(marts.temporal_demand(_trips(spark, folder)))


def q5_temporal_demand_all(spark: SparkSession, folder: str) -> DataFrame:
    return plain(marts.temporal_demand(_trips(spark, folder), "2014-01-01", "2026-01-01"))


def weekday_hour_heatmap(spark: SparkSession, folder: str) -> DataFrame:
    return marts.weekday_hour_heatmap(marts.temporal_demand(_trips(spark, folder)))


def hourly_curve(spark: SparkSession, folder: str) -> DataFrame:
    return marts.hourly_curve(marts.temporal_demand(_trips(spark, folder)))


# ---------------------------------------------------------------- chart data


def _chart_q1(end: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        fact, star = _fact_and_star(spark, folder, f"{end}_date", f"{end}_zone")
        top = marts.top_zones_by_month(fact, star, end)
        means = marts.chart_means(top, ["zone_name", "service_type"], ["num_trips"])
        return rounded(means, {"num_trips": 6})

    return query


def chart_q2(spark: SparkSession, folder: str) -> DataFrame:
    fact, star = _fact_and_star(spark, folder, "pickup_date", "pickup_zone")
    revenue = marts.revenue_tips_by_borough(fact, star)
    means = marts.chart_means(
        revenue, ["borough", "service_type"], ["total_revenue", "avg_tip_pct"]
    )
    return rounded(means, {"total_revenue": 4, "avg_tip_pct": 6})


def chart_q3(spark: SparkSession, folder: str) -> DataFrame:
    fact, star = _fact_and_star(spark, folder, "pickup_date", "pickup_zone")
    speed = marts.average_speed(fact, star)
    means = marts.chart_means(speed, ["trip_year", "borough", "service_type"], ["avg_mph"])
    return rounded(means, {"avg_mph": 6})


def _chart_q4(limit: int | None) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        summary = marts.duration_zone_summary(_percentiles(spark, folder, limit))
        long = marts.duration_long(summary)
        means = marts.chart_means(long, ["pickup_zone", "percentile"], ["duration_min"])
        return rounded(means, {"duration_min": 6})

    return query


# ---------------------------------------------------------------- generic operators


def top_trips_per_zone(spark: SparkSession, folder: str) -> DataFrame:
    """The three dearest trips of every pickup zone and service."""
    trips = _trips(spark, folder).select(
        "service_type",
        "pickup_location_id",
        "total_amount",
        "pickup_datetime",
        "dropoff_datetime",
    )
    order = [F.desc("total_amount"), F.asc("pickup_datetime"), F.asc("dropoff_datetime")]
    return top_n_per_group(trips, ["service_type", "pickup_location_id"], order, 3)


NUMERIC_SAMPLE = (
    "passenger_count",
    "ratecodeid",
    "congestion_surcharge",
    "fare_amount",
    "payment_type",
    "trip_distance",
)


def impute_medians(spark: SparkSession, folder: str) -> DataFrame:
    sample = raw_trips(spark, folder).select(*NUMERIC_SAMPLE)
    return impute_upper_median(sample, NUMERIC_SAMPLE)


def impute_sample_csv(spark: SparkSession, folder: str) -> DataFrame:
    """CSV in, numeric columns imputed, CSV out; the file is read back."""
    raw, clean = new_path(spark, "sample-csv"), new_path(spark, "sample-clean-csv")
    sinks.export_csv(raw_trips(spark, folder).drop("pickup_ns", "dropoff_ns"), raw)
    reader = spark.read.option("header", True)
    sample = reader.option("inferSchema", True).csv(raw).select(*NUMERIC_SAMPLE)
    sinks.export_csv(impute_upper_median(sample, NUMERIC_SAMPLE), clean)
    return reader.schema(", ".join(f"{c} double" for c in NUMERIC_SAMPLE)).csv(clean)


# ---------------------------------------------------------------- checks


def check_not_null(spark: SparkSession, folder: str) -> DataFrame:
    fact, _ = gold_tables(spark, folder)
    return quality.check_not_null(
        fact, "fct_trips", ["trip_id", "pickup_date_sk", "passenger_count", "ratecode_sk"]
    )


def check_unique(spark: SparkSession, folder: str) -> DataFrame:
    fact, _ = gold_tables(spark, folder)
    keys = (["trip_id"], ["service_type", "trip_id"], ["pickup_zone_sk"])
    return quality.union_results([quality.check_unique(fact, "fct_trips", key) for key in keys])


def check_relationships(spark: SparkSession, folder: str) -> DataFrame:
    """Foreign keys of the fact, and the staged ids they were taken from."""
    fact, star = gold_tables(spark, folder)
    trips = _trips(spark, folder)
    zones = (star.dim_zone.df, "zone_sk")
    payments = (star.dim_payment_type.df, "payment_type_sk")
    rates = (star.dim_ratecode.df, "ratecode_sk")
    dates = (star.dim_date.df, "date_sk")
    on_fact = {
        "pickup_date_sk": dates,
        "dropoff_date_sk": dates,
        "pickup_zone_sk": zones,
        "dropoff_zone_sk": zones,
        "payment_type_sk": payments,
        "ratecode_sk": rates,
    }
    staged = {
        "pickup_location_id": zones,
        "dropoff_location_id": zones,
        "payment_type": payments,
        "ratecode_id": rates,
    }
    return quality.union_results(
        [
            quality.check_relationships(fact, "fct_trips", on_fact),
            quality.check_relationships(trips, "stg_all_trips", staged),
        ]
    )


def check_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    trips = _trips(spark, folder)
    accepted = {
        "service_type": ["yellow", "green"],
        "payment_type": list(gold.PAYMENT_LABELS),
        "ratecode_id": list(gold.RATECODE_LABELS),
    }
    return quality.check_accepted_values(trips, "stg_all_trips", accepted)


def fare_speed_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles of fare and speed over all trips, per service: few groups, of any size."""
    trips = _trips(spark, folder, silver.DURATION)
    measures = F.array(
        F.struct(F.lit("fare_amount").alias("measure"), F.col("fare_amount").alias("value")),
        F.struct(
            F.lit("speed_mph").alias("measure"),
            speed_mph(F.col("trip_distance"), F.col(silver.DURATION)).alias("value"),
        ),
    )
    values = trips.select("service_type", F.inline(measures))
    found = exact_percentiles(values, ["service_type", "measure"], "value", (0.1, 0.5, 0.9, 0.99))
    return rounded(found, {"percentile": 6})


def check_range(spark: SparkSession, folder: str) -> DataFrame:
    fact, _ = _fact_and_star(spark, folder, "pickup_date")
    return quality.check_range(fact, "fct_trips", "trip", range_violation())


def check_not_empty(spark: SparkSession, folder: str) -> DataFrame:
    trips = _trips(spark, folder)
    return quality.union_results(
        [
            quality.check_not_empty(trips, "stg_all_trips"),
            quality.check_not_empty(trips.where("load_year < 2000"), "trips_before_2000"),
        ]
    )


def check_suite(spark: SparkSession, folder: str) -> DataFrame:
    fact, star = gold_tables(spark, folder)
    return declared_checks(fact, star)


def store_failures(spark: SparkSession, folder: str) -> DataFrame:
    """Failing rows of the range check, written and read back."""
    fact, _ = _fact_and_star(spark, folder, "pickup_date", "pickup_zone")
    failing = quality.failing_range(fact, range_violation())
    path = quality.store_failures(failing, new_path(spark, "failures"), "range_fct_trips")
    return spark.read.schema(failing.schema).parquet(path)


def _row_checks(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Results of all checks of single rows, and the failing rows of the staged trips."""
    fact, star = gold_tables(spark, folder)
    trips = _trips(spark, folder)
    on_fact, on_staged = new_path(spark, "failures"), new_path(spark, "failures")
    results = quality.union_results(
        [
            row_checks.check_rows(fact, "fct_trips", fact_rules(star), on_fact),
            row_checks.check_rows(trips, "stg_all_trips", staged_rules(star), on_staged),
        ]
    )
    stored = row_checks.stored_failures(fact, on_fact).select(
        "service_type", "trip_id", row_checks.CHECK
    )
    staged = row_checks.stored_failures(trips, on_staged).select(
        "service_type", F.lit(None).cast("bigint").alias("trip_id"), row_checks.CHECK
    )
    return results, stored.unionByName(staged)


def check_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One scan of the fact and one of the staged trips, one result row per check."""
    return _row_checks(spark, folder)[0]


def stored_failures(spark: SparkSession, folder: str) -> DataFrame:
    """The failing rows of all those checks, as stored by the same scans."""
    return _row_checks(spark, folder)[1]


# ---------------------------------------------------------------- ingest

# The months are written as partitions of this column, so each is one folder.
FOLDER_PER_MONTH = "file=" + ingest.MONTH_FILE


def month_files(spark: SparkSession, folder: str) -> str:
    """Monthly files of both services, as their publisher names and shapes them.

    Like the raw layer, they are made once per session and folder.
    """
    key = _input_key(spark, folder)
    if key in _source_paths:
        return _source_paths[key]
    source = new_path(spark, "source")
    bronze = raw_trips(spark, folder)
    for service in ("yellow", "green"):
        raw = service_bronze(bronze, service)
        times = [c for c in raw.columns if c.endswith("_datetime")]
        file = F.format_string(
            f"{service}_tripdata_%04d-%02d.parquet", F.col("load_year"), F.col("load_month")
        )
        own = {"VendorID": "vendorid", "RatecodeID": "ratecodeid", "PULocationID": "pulocationid"}
        shaped = (
            raw.withColumns({c: ns_to_ntz(F.col(c)) for c in times})
            .withColumn("file", file)
            .drop("load_service_type", "load_year", "load_month")
            .withColumnsRenamed({low: name for name, low in own.items()})
        )
        if service == "green":
            shaped = shaped.withColumns({"ehail_fee": F.lit(0.0), "trip_type": F.lit(1)})
        # Rebalancing gathers a month's rows, and still splits a month that is too large.
        shaped.hint("rebalance", "file").write.mode("append").partitionBy("file").parquet(source)
    _source_paths[key] = source
    return source


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


_INT, _NTZ, _DOUBLE, _TEXT = T.IntegerType(), T.TimestampNTZType(), T.DoubleType(), T.StringType()

# The raw layer holds both services, so it has both services' time columns.
BRONZE_SCHEMA = _schema(
    ("VENDORID", _INT),
    ("TPEP_PICKUP_DATETIME", _NTZ),
    ("TPEP_DROPOFF_DATETIME", _NTZ),
    ("LPEP_PICKUP_DATETIME", _NTZ),
    ("LPEP_DROPOFF_DATETIME", _NTZ),
    ("PASSENGER_COUNT", _DOUBLE),
    ("TRIP_DISTANCE", _DOUBLE),
    ("RATECODEID", _INT),
    ("STORE_AND_FWD_FLAG", _TEXT),
    ("PULOCATIONID", _INT),
    ("DOLOCATIONID", _INT),
    ("PAYMENT_TYPE", _INT),
    ("FARE_AMOUNT", _DOUBLE),
    ("EXTRA", _DOUBLE),
    ("MTA_TAX", _DOUBLE),
    ("TIP_AMOUNT", _DOUBLE),
    ("TOLLS_AMOUNT", _DOUBLE),
    ("IMPROVEMENT_SURCHARGE", _DOUBLE),
    ("TOTAL_AMOUNT", _DOUBLE),
    ("CONGESTION_SURCHARGE", _DOUBLE),
    ("AIRPORT_FEE", _DOUBLE),
)
RAW_LAYER_SCHEMA = T.StructType(
    [
        *BRONZE_SCHEMA,
        *_schema(("LOAD_SERVICE_TYPE", _TEXT), ("LOAD_YEAR", _INT), ("LOAD_MONTH", _INT)),
    ]
)


def ingest_months(spark: SparkSession, folder: str) -> DataFrame:
    """Both services' conformed batches, before any write."""
    source = month_files(spark, folder)
    groups: dict[tuple[str, str], list[ingest.Month]] = {}
    for month in ingest.months_present(spark, source):
        kind = spark.read.parquet(ingest.month_path(source, month, FOLDER_PER_MONTH)).schema
        groups.setdefault((month.service, kind.json()), []).append(month)
    out = None
    for (_, kind), months in groups.items():
        schema = T.StructType.fromJson(json.loads(kind))
        batch = ingest.ingest_months(spark, source, months, schema, template=FOLDER_PER_MONTH)
        out = batch if out is None else out.unionByName(batch, allowMissingColumns=True)
    return lower_names(out)


LATEST_COLUMNS = ("load_service_type", "load_year", "load_month", "payment_type", "total_amount")


def ingest_latest_month(spark: SparkSession, folder: str) -> DataFrame:
    """The file of each service's newest month, loaded by itself."""
    source = month_files(spark, folder)
    present = ingest.months_present(spark, source)
    out = None
    for service in TIME_PREFIX:
        newest = max(m for m in present if m.service == service)
        batch = ingest.ingest_month(spark, source, newest, template=FOLDER_PER_MONTH)
        batch = lower_names(batch).select(*LATEST_COLUMNS)
        out = batch if out is None else out.unionByName(batch)
    return out


def backfilled(
    spark: SparkSession, source: str, months: list[ingest.Month]
) -> tuple[DataFrame, list[ingest.Outcome]]:
    target = new_path(spark, "bronze")
    outcomes = ingest.backfill_months(
        spark, source, months, target, BRONZE_SCHEMA, template=FOLDER_PER_MONTH
    )
    return spark.read.schema(RAW_LAYER_SCHEMA).parquet(target), outcomes


def all_months(spark: SparkSession, source: str) -> list[ingest.Month]:
    """All months of the files found and one more on each side, which have none, per service."""
    found = ingest.months_present(spark, source)
    number = [m.year * 12 + m.month - 1 for m in found]
    low, high = min(number) - 1, max(number) + 1
    return [
        month
        for service in sorted({m.service for m in found})
        for month in ingest.months_between(
            service, (low // 12, low % 12 + 1), (high // 12, high % 12 + 1)
        )
    ]


def backfill_months(spark: SparkSession, folder: str) -> DataFrame:
    source = month_files(spark, folder)
    loaded, _ = backfilled(spark, source, all_months(spark, source))
    return lower_names(loaded)


def drifting_files(spark: SparkSession, folder: str) -> str:
    """Monthly files whose columns and types differ between even and odd months."""
    source, files = month_files(spark, folder), new_path(spark, "drifting")
    for parity in (0, 1):
        months = [m for m in ingest.months_present(spark, source) if m.month % 2 == parity]
        for service in sorted({m.service for m in months}):
            own = [m for m in months if m.service == service]
            paths = [ingest.month_path(source, m, FOLDER_PER_MONTH) for m in own]
            raw = spark.read.parquet(*paths).withColumn(
                "file", F.regexp_extract("_metadata.file_path", "file=([^/]+)", 1)
            )
            raw = (
                raw.drop("congestion_surcharge")
                if parity
                else raw.withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
            )
            raw.hint("rebalance", "file").write.mode("append").partitionBy("file").parquet(files)
    return files


def backfill_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Months that differ in columns and types, into a raw table whose schema nobody gave."""
    source, target = drifting_files(spark, folder), new_path(spark, "bronze")
    months = ingest.months_present(spark, source)
    ingest.backfill_months(spark, source, months, target, template=FOLDER_PER_MONTH)
    return lower_names(ingest.read_raw(spark, target))


def reload_empty_month(spark: SparkSession, folder: str) -> DataFrame:
    """Each service's first month comes again without rows, and so goes from the raw table."""
    source, target = month_files(spark, folder), new_path(spark, "bronze")
    months = ingest.months_present(spark, source)
    ingest.backfill_months(spark, source, months, target, BRONZE_SCHEMA, template=FOLDER_PER_MONTH)
    again = new_path(spark, "empty-months")
    firsts = [min(m for m in months if m.service == s) for s in {m.service for m in months}]
    for month in firsts:
        old = spark.read.parquet(ingest.month_path(source, month, FOLDER_PER_MONTH))
        old.limit(0).write.parquet(ingest.month_path(again, month, FOLDER_PER_MONTH))
    ingest.backfill_months(spark, again, firsts, target, template=FOLDER_PER_MONTH)
    return lower_names(ingest.read_raw(spark, target))


def stage_loaded_trips(spark: SparkSession, folder: str) -> DataFrame:
    """From monthly files to staged trips: load, then stage what was loaded."""
    source = month_files(spark, folder)
    loaded, _ = backfilled(spark, source, all_months(spark, source))
    staged = [
        silver.stage_trips(loaded.where(F.col("LOAD_SERVICE_TYPE") == service), service)
        for service in ("yellow", "green")
    ]
    return plain(silver.all_trips(*staged))


def _coverage_log(spark: SparkSession, folder: str) -> DataFrame:
    source = month_files(spark, folder)
    _, outcomes = backfilled(spark, source, all_months(spark, source))
    log = new_path(spark, "coverage")
    ingest.log_coverage(spark, outcomes, log)
    return spark.read.parquet(log)


def coverage_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return lower_names(ingest.coverage_matrix(_coverage_log(spark, folder)))


def coverage_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of loaded and missing months, where every fifth month's file is not there."""
    source, nothing = month_files(spark, folder), new_path(spark, "no-files")
    asked = all_months(spark, source)
    log = new_path(spark, "coverage")
    for place, fifth in ((source, False), (nothing, True)):
        own = [m for m in asked if (m.month % 5 == 0) == fifth]
        ingest.log_coverage(spark, backfilled(spark, place, own)[1], log)
    return lower_names(ingest.coverage_runs(ingest.coverage_matrix(spark.read.parquet(log))))


def loaded_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each month's latest load, as logged."""
    latest = ingest.latest_outcomes(_coverage_log(spark, folder))
    return lower_names(latest.drop("FILE_EXISTS", "LOAD_STATUS"))


def stream_months(spark: SparkSession, folder: str) -> DataFrame:
    """The backfill driven by newly found files."""
    target, log = new_path(spark, "bronze"), new_path(spark, "coverage")
    query = stream_backfill(
        spark,
        month_files(spark, folder),
        target,
        log,
        new_path(spark, "stream"),
        glob="file=*",
        schema=BRONZE_SCHEMA,
        template=FOLDER_PER_MONTH,
    )
    query.awaitTermination()
    return lower_names(spark.read.schema(RAW_LAYER_SCHEMA).parquet(target))


def stream_first_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Trips arrive year by year, each year with a copy of the year before; one of each stays."""
    trips = _trips(spark, folder, silver.VENDOR).select(
        "service_type", "vendor_id", "load_year",
        F.col("dropoff_datetime").alias("dropoff"),
        F.col("pickup_datetime").cast("timestamp").alias("pickup_at"),
    )
    staged, source, target = (new_path(spark, n) for n in ("trip-keys", "trip-files", "first-trips"))
    with open_files(spark):  # a folder a year
        trips.write.partitionBy("load_year").parquet(staged)
    keys = spark.read.schema(trips.schema).parquet(staged)
    for year in sorted(r[0] for r in keys.select("load_year").distinct().collect()):
        arrived = keys.where(F.col("load_year").between(year - 1, year)).drop("load_year")
        arrived.write.mode("append").parquet(source)
    schema = keys.drop("load_year").schema
    rows = trips_stream.stream_files(spark, source, schema, 8)
    first = trips_stream.first_rows(rows, rows.columns, "pickup_at", "800 days")
    trips_stream.write_first_rows(first, target, new_path(spark, "stream")).awaitTermination()
    return spark.read.schema(schema).parquet(target).select(
        "service_type", "vendor_id", F.col("pickup_at").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("dropoff").alias("dropoff_datetime"),
    )


def load_counts(spark: SparkSession, folder: str) -> DataFrame:
    return marts.load_counts(raw_trips(spark, folder))


def ingest_zones(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "zones-csv")
    zones = bronze_zones(spark, folder)
    shown = zones.fillna("N/A", ["borough"]).toDF("LocationID", "Borough", "Zone", "service_zone")
    sinks.export_csv(shown, path)
    return lower_names(ingest.ingest_zones(spark, path))


def _messy_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events under names that clash, are denied or need normalising."""
    return read_table(spark, folder, "events").select(
        F.col("event_id").alias("event id"),
        F.col("ts").cast("string").alias("event datetime"),
        F.concat(F.lit("day "), F.col("event_id")).alias("Odd-Date"),
        F.col("user_id").alias("USER_ID"),
        F.col("value").alias("user-id"),
        F.col("event_type").alias("trip_type"),
        F.col("value").alias("value (usd)"),
        F.col("props").alias("ehail_fee"),
        F.col("event_type").alias("Event.Type"),
    )


def conform_batch(spark: SparkSession, folder: str) -> DataFrame:
    target = ["EVENT_ID", "EVENT_DATETIME", "ODD_DATE", "USER_ID", "EVENT_TYPE"]
    return conform.conform_batch(_messy_events(spark, folder), target)


def coerce_datetime_columns(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    seconds = F.unix_date(F.to_date(ts)).cast("bigint") * 86400 + minute_of_day(ts) * 60
    micros = seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    events = read_table(spark, folder, "events").select(
        "event_id",
        ts.cast("string").alias("text_date"),
        (micros * 1000).alias("ns_date"),
        F.when(F.col("event_id") == 7, F.lit("not a day"))
        .otherwise(F.to_date(ts).cast("string"))
        .alias("broken_date"),
        F.to_date("ts").alias("plain_date"),
        F.col("event_type").alias("kind"),
    )
    return conform.coerce_datetime_columns(events)


def drop_blank_names(spark: SparkSession, folder: str) -> DataFrame:
    """Columns without a name go; of names that become equal the first one stays."""
    events = read_table(spark, folder, "events").select(
        "event_id", "user_id", "event_type", F.col("value").alias("second"), "value"
    )
    return lower_names(conform.normalise_columns(events.toDF("event id", "", "kind", "KIND", "Value")))


def starter_models(spark: SparkSession, folder: str) -> DataFrame:
    """A first model whose key may be NULL and so fails its check, and a second one of its id 1."""
    nation = F.col("s_nationkey")
    first = read_table(spark, folder, "supplier").select(
        F.when(nation != 0, nation).cast("int").alias("id")
    )
    second = first.where("id = 1")
    results = [
        check
        for name, model in (("first_model", first), ("second_model", second))
        for check in (
            quality.check_not_null(model, name, ["id"]),
            quality.check_unique(model, name, ["id"]),
        )
    ]
    return quality.union_results(results)


def backfill_control_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Load columns present on some rows only; the rest are filled."""
    known = F.col("user_id") % 3 != 0
    events = read_table(spark, folder, "events").select(
        "event_id",
        F.when(known, F.year("ts")).alias("LOAD_YEAR"),
        F.when(F.col("user_id") % 2 != 0, F.month("ts")).alias("LOAD_MONTH"),
    )
    return lower_names(conform.backfill_control_columns(events, "green", 2019, 1))


# ---------------------------------------------------------------- month by month


def grow_dim_date(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar grown in three batches: the earliest month comes second, the last one third."""
    trips = _trips(spark, folder)
    number = F.col("load_year") * 12 + F.col("load_month")
    ends = trips.agg(F.min(number).alias("low"), F.max(number).alias("high")).first()
    batches = [
        trips.where((number > ends["low"]) & (number < ends["high"])),
        trips.where(number == ends["low"]),
        trips,
    ]
    keys = increments.date_keys(spark, new_path(spark, "gold"))
    for place, batch in enumerate(batches):
        members = gold.observed_members(batch, ["date"]).select(
            F.date_from_unix_date("member").alias("date_value")
        )
        keys.grow(members, place)
    return plain(gold.calendar(keys.read()))


class Grown(NamedTuple):
    """A raw layer, the gold layer built from it, and the files of what changed since."""

    raw: str
    gold: str


def _changing_months(spark: SparkSession, folder: str) -> Grown:
    """All months but each service's first are loaded and built. Then the firsts are loaded, and
    the third ones come again, without the trips of unknown passengers and dearer by one."""
    source, raw, target = (
        month_files(spark, folder), new_path(spark, "bronze"), new_path(spark, "gold")
    )
    months = ingest.months_present(spark, source)
    own = {s: [m for m in months if m.service == s] for s in ("yellow", "green")}
    late = [m for ms in own.values() for m in ms[1:]]
    zones = bronze_zones(spark, folder)
    load = {"schema": BRONZE_SCHEMA, "template": FOLDER_PER_MONTH}
    increments.load_months(spark, source, late, raw, **load)
    increments.refresh_gold(spark, raw, zones, target)
    again = new_path(spark, "changed-months")
    thirds = [ms[2] for ms in own.values() if len(ms) > 2]
    for month in thirds:
        old = spark.read.parquet(ingest.month_path(source, month, FOLDER_PER_MONTH))
        changed = old.dropna(subset=["passenger_count"]).withColumn(
            "total_amount", F.col("total_amount") + 1
        )
        changed.write.parquet(ingest.month_path(again, month, FOLDER_PER_MONTH))
    increments.load_months(spark, again, thirds, raw, **load)
    increments.load_months(spark, source, [ms[0] for ms in own.values() if ms], raw, **load)
    return Grown(raw, target)


def changed_months(spark: SparkSession, folder: str) -> DataFrame:
    """Which months differ from the last build."""
    grown = _changing_months(spark, folder)
    return increments.changed_months(
        increments.read_prints(spark, grown.raw), increments.read_ledger(spark, grown.gold)
    )


def refresh_gold(spark: SparkSession, folder: str) -> DataFrame:
    """The fact after a first build and a refresh of the changed months alone."""
    grown = _changing_months(spark, folder)
    increments.refresh_gold(spark, grown.raw, bronze_zones(spark, folder), grown.gold)
    return increments.read_fact(spark, grown.gold)


_state_paths: dict[tuple, str] = {}


def month_states(spark: SparkSession, folder: str) -> str:
    """States of all months, written in two turns; months of the first come again in the second."""
    key = _input_key(spark, folder)
    if key not in _state_paths:
        path = new_path(spark, "states")
        trips = _trips(spark, folder, silver.DURATION, *silver.MINUTES)
        star = gold.build_star(trips, bronze_zones(spark, folder), ["date"])
        keys = ("pickup_date", "dropoff_date", "pickup_zone", "dropoff_zone")
        measures = (*gold.FACT_MEASURES, "load_year", "load_month")
        turns = [F.col("load_month") <= 6, F.col("load_month") >= 5]
        for turn in turns:
            fact = gold.fct_trips(trips.where(turn), star, keys, measures)
            states.write_states(fact, star, trips.where(turn), path)
        _state_paths[key] = path
    return _state_paths[key]


def _state(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return states.read_state(spark, month_states(spark, folder), name)


def q1_from_states(spark: SparkSession, folder: str) -> DataFrame:
    return states.top_zones_by_month(_state(spark, folder, "zone_trips"))


def q1_dropoff_from_states(spark: SparkSession, folder: str) -> DataFrame:
    return states.top_zones_by_month(_state(spark, folder, "zone_trips"), "dropoff")


def q2_from_states(spark: SparkSession, folder: str) -> DataFrame:
    """Not rounded: the sums are exact, so both engines find the same doubles."""
    return states.revenue_tips_by_borough(_state(spark, folder, "borough_revenue"))


def q2_revenue_tips_exact(spark: SparkSession, folder: str) -> DataFrame:
    fact, star = _fact_and_star(spark, folder, "pickup_date", "pickup_zone")
    return states.exact_revenue_tips(fact, star)


def q3_from_states(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(states.average_speed(_state(spark, folder, "borough_speed")), {"avg_mph": 6})


def q4_from_states(spark: SparkSession, folder: str) -> DataFrame:
    minutes = _state(spark, folder, "zone_minutes")
    return rounded(states.duration_percentiles(minutes, None), PERCENTILE_DIGITS)


def q5_from_states(spark: SparkSession, folder: str) -> DataFrame:
    demand = states.temporal_demand(_state(spark, folder, "hourly_trips"), "2014-01-01", "2026-01-01")
    return plain(demand)


# ---------------------------------------------------------------- tables by name


def _published(spark: SparkSession, folder: str) -> str:
    """The star as tables of a database of its own; returns the database's name."""
    fact, star = _fact_and_star(spark, folder, "pickup_date", "pickup_zone")
    path = new_path(spark, "gold")
    database = "gold_" + path.rsplit("-", 1)[1]
    tables = {"fct_trips": fact, "dim_date": star.dim_date.df, "dim_zone": star.dim_zone.df}
    sinks.publish(tables, database, path)
    return database


def run_sql_zone_year(spark: SparkSession, folder: str) -> DataFrame:
    """A question in SQL text over the published tables."""
    database = _published(spark, folder)
    return spark.sql(
        f"""
        WITH days AS (SELECT date_sk AS pickup_date_sk, year(date_value) AS trip_year
                      FROM {database}.dim_date),
             zones AS (SELECT zone_sk AS pickup_zone_sk, borough FROM {database}.dim_zone)
        SELECT trip_year, borough, count(*) AS num_trips,
               round(percentile_cont(0.5) WITHIN GROUP (ORDER BY trip_duration_min), 6)
                 AS median_minutes
        FROM {database}.fct_trips
        LEFT JOIN days USING (pickup_date_sk)
        LEFT JOIN zones USING (pickup_zone_sk)
        GROUP BY trip_year, borough
        """
    )


def run_sql_weekday(spark: SparkSession, folder: str) -> DataFrame:
    """SQL text over the published staging table, with the ISO weekday function."""
    path = new_path(spark, "silver")
    database = "silver_" + path.rsplit("-", 1)[1]
    trips = _trips(spark, folder).select("pickup_datetime", "service_type")
    sinks.publish({"stg_all_trips": trips}, database, path)
    register_sql_functions(spark)
    return spark.sql(
        f"""
        SELECT dayofweekiso(pickup_datetime) AS day_number,
               extract(HOUR FROM pickup_datetime) AS pickup_hour,
               count_if(service_type = 'yellow') AS yellow_trips, count(*) AS num_trips
        FROM {database}.stg_all_trips
        GROUP BY 1, 2
        """
    )


# Staging as views over the raw tables; only what a query asks for is computed.
STAGING_VIEWS = {
    f"stg_{service}_trips": f"""
        SELECT timestampadd(MICROSECOND, {prefix}_pickup_datetime div 1000,
                            timestamp_ntz'1970-01-01 00:00:00') AS pickup_datetime,
               cast(payment_type AS int) AS payment_type, total_amount,
               '{service}' AS service_type
        FROM {{db}}.{service}_trips
        WHERE {prefix}_pickup_datetime IS NOT NULL AND {prefix}_dropoff_datetime IS NOT NULL"""
    for service, prefix in TIME_PREFIX.items()
} | {
    "stg_all_trips": "SELECT * FROM {db}.stg_yellow_trips UNION ALL SELECT * FROM {db}.stg_green_trips"
}


def run_sql_view(spark: SparkSession, folder: str) -> DataFrame:
    """A question through views: staging is defined, not stored."""
    path = new_path(spark, "bronze-tables")
    database = "bronze_" + path.rsplit("-", 1)[1]
    bronze = raw_trips(spark, folder)
    raw = {f"{s}_trips": service_bronze(bronze, s) for s in TIME_PREFIX}
    sinks.publish(raw, database, path)
    sinks.publish_views(spark, database, STAGING_VIEWS)
    return spark.sql(
        f"""
        SELECT service_type, year(pickup_datetime) AS trip_year, payment_type,
               count(*) AS num_trips, max(total_amount) AS dearest
        FROM {database}.stg_all_trips
        GROUP BY service_type, year(pickup_datetime), payment_type
        """
    )


def append_existing(spark: SparkSession, folder: str) -> DataFrame:
    """Yellow trips make the table; green ones are cut to its columns and appended."""
    bronze = raw_trips(spark, folder)
    path = new_path(spark, "raw")
    database = "raw_" + path.rsplit("-", 1)[1]
    yellow = service_bronze(bronze, "yellow").drop("tpep_pickup_datetime", "tpep_dropoff_datetime")
    sinks.publish({"trips": yellow}, database, path)
    sinks.append_existing(service_bronze(bronze, "green"), f"{database}.trips")
    return spark.table(f"{database}.trips")


def _created_database(spark: SparkSession, name: str) -> str:
    path = new_path(spark, name)
    database = f"{name}_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}'")
    return database


LOADED_COLUMNS = ("load_service_type", "load_year", "load_month", "payment_type", "total_amount")


def append_table(spark: SparkSession, folder: str) -> DataFrame:
    """The first service's load creates the table, the second one's adds to it."""
    table = f"{_created_database(spark, 'appended')}.trips"
    for service in TIME_PREFIX:
        own = service_bronze(raw_trips(spark, folder), service)
        sinks.append_table(own.select(*LOADED_COLUMNS), table)
    return spark.table(table)


def replace_table(spark: SparkSession, folder: str) -> DataFrame:
    """Each service's load replaces the table, so the last one is left."""
    table = f"{_created_database(spark, 'replaced')}.trips"
    for service in TIME_PREFIX:
        own = service_bronze(raw_trips(spark, folder), service)
        sinks.replace_table(own.select(*LOADED_COLUMNS), table)
    return spark.table(table)


def write_chunked(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "chunks")
    sinks.write_chunked(raw_trips(spark, folder), path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- registry

QUERIES: dict[str, Query] = {
    "stage_trips": stage_trips,
    "stage_green_trips": stage_green_trips,
    "all_trips": all_trips,
    "assign_trip_id": assign_trip_id,
    "stage_zones_dim_zone": stage_zones_dim_zone,
    "clean_trips": clean_trips,
    "clean_report": clean_report,
    "dedupe_trips": dedupe_trips,
    "zone_conformance": zone_conformance,
    "zone_conformance_rejects": zone_conformance_rejects,
    "dim_date": _dimension(gold.dim_date, "date"),
    "dim_date_all_services": _dimension(gold.dim_date, "date", "all"),
    "dim_payment_type": _dimension(gold.dim_payment_type, "payment_type"),
    "dim_ratecode": _dimension(gold.dim_ratecode, "ratecode"),
    "dim_time": _dimension(gold.dim_time, "time"),
    "fct_trips": fct_trips,
    "fct_trips_vendor_fanout": fct_trips_vendor_fanout,
    "fct_trips_documented": fct_trips_documented,
    "cluster_fact": cluster_fact,
    "q1_pickup_top_zones": q1_pickup_top_zones,
    "q1_dropoff_top_zones": q1_dropoff_top_zones,
    "q2_revenue_tips": q2_revenue_tips,
    "q2_revenue_tips_vendor_fanout": q2_revenue_tips_vendor_fanout,
    "q3_speed": q3_speed,
    "q3_speed_hour_band": q3_speed_hour_band,
    "q4_duration_percentiles": q4_duration_percentiles,
    "q4_duration_percentiles_all": q4_duration_percentiles_all,
    "duration_zone_summary": duration_zone_summary,
    "duration_long": duration_long,
    "duration_zone_summary_all": duration_zone_summary_all,
    "duration_long_all": duration_long_all,
    "q5_temporal_demand": q5_temporal_demand,
    "q5_temporal_demand_all": q5_temporal_demand_all,
    "weekday_hour_heatmap": weekday_hour_heatmap,
    "hourly_curve": hourly_curve,
    "chart_q1_pickup": _chart_q1("pickup"),
    "chart_q1_dropoff": _chart_q1("dropoff"),
    "chart_q2": chart_q2,
    "chart_q3": chart_q3,
    "chart_q4": _chart_q4(50),
    "chart_q4_all": _chart_q4(None),
    "top_n_per_group": top_trips_per_zone,
    "impute_upper_median": impute_medians,
    "impute_sample_csv": impute_sample_csv,
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_relationships": check_relationships,
    "check_accepted_values": check_accepted_values,
    "check_range": check_range,
    "check_not_empty": check_not_empty,
    "check_suite": check_suite,
    "store_failures": store_failures,
    "ingest_month": ingest_months,
    "backfill_months": backfill_months,
    "backfill_drift": backfill_drift,
    "reload_empty_month": reload_empty_month,
    "loaded_rows": loaded_rows,
    "stage_loaded_trips": stage_loaded_trips,
    "coverage_matrix": coverage_matrix,
    "stream_backfill": stream_months,
    "grow_dim_date": grow_dim_date,
    "changed_months": changed_months,
    "refresh_gold": refresh_gold,
    "q1_from_states": q1_from_states,
    "q1_dropoff_from_states": q1_dropoff_from_states,
    "q2_from_states": q2_from_states,
    "q2_revenue_tips_exact": q2_revenue_tips_exact,
    "q3_from_states": q3_from_states,
    "q4_from_states": q4_from_states,
    "q5_from_states": q5_from_states,
    "check_rows": check_rows,
    "stored_failures": stored_failures,
    "dedupe_across_loads": dedupe_across_loads,
    "fare_speed_percentiles": fare_speed_percentiles,
    "interleave_fact": interleave_fact,
    "coverage_runs": coverage_runs,
    "run_sql_view": run_sql_view,
    "stream_first_trips": stream_first_trips,
    "load_counts": load_counts,
    "ingest_zones": ingest_zones,
    "ingest_latest_month": ingest_latest_month,
    "conform_batch": conform_batch,
    "drop_blank_names": drop_blank_names,
    "starter_models": starter_models,
    "coerce_datetime_columns": coerce_datetime_columns,
    "backfill_control_columns": backfill_control_columns,
    "run_sql": run_sql_zone_year,
    "run_sql_weekday": run_sql_weekday,
    "append_existing": append_existing,
    "append_table": append_table,
    "replace_table": replace_table,
    "write_chunked": write_chunked,
}
