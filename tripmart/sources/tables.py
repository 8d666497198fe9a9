"""Raw (bronze) trip and zone tables derived from the given sales tables.

The same mapping stands in DuckDB SQL in ``registry/oracle.py``. It plants NULLs, zero
distances, negative fares, unknown codes and durations outside 1-180 minutes on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SERVICES = ("yellow", "green")

# Name prefix of the pickup and dropoff columns in each service's files.
TIME_PREFIX = {"yellow": "tpep", "green": "lpep"}


# Declared schemas spare a job that reads the file's footer.
TABLE_SCHEMAS = {
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _trip_base(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with a pickup time in epoch microseconds and a fare in whole cents."""
    return read_table(spark, folder, "lineitem").selectExpr(
        "*",
        """datediff(to_date(l_shipdate), date'1970-01-01') * 86400000000
           + (((l_partkey * 7 + l_linenumber * 131) % 1440) * 60
              + (l_suppkey * 17) % 60) * 1000000
           + 7300 * 86400000000 AS pu_us""",
        "cast(round(l_extendedprice * 100) AS bigint) div 1000 - 200 AS fare_c",
        "cast(round(l_discount * 100) AS bigint) AS tip_pct",
    )


def bronze_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Both services' raw trips, with ``pickup_ns`` / ``dropoff_ns`` in epoch nanoseconds."""
    return _trip_base(spark, folder).selectExpr(
        "pu_us * 1000 AS pickup_ns",
        """CASE WHEN l_partkey % 37 = 0 THEN NULL
                ELSE (pu_us + ((cast(l_quantity AS bigint) * 211 + l_partkey * 13) % 12000
                               - 300) * 1000000) * 1000 END AS dropoff_ns""",
        "CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE cast(l_linenumber AS double) END"
        " AS passenger_count",
        "CASE WHEN l_partkey % 31 = 0 THEN 0e0 ELSE l_quantity * 0.4e0 END AS trip_distance",
        """CASE WHEN l_linenumber = 7 THEN 99 WHEN l_partkey % 41 = 0 THEN NULL
                ELSE l_linenumber END AS ratecodeid""",
        "l_returnflag AS store_and_fwd_flag",
        "cast(l_suppkey AS int) AS pulocationid",
        "cast(l_suppkey + l_linenumber AS int) AS dolocationid",
        "cast(l_partkey % 7 AS int) AS payment_type",
        "cast(l_orderkey % 3 AS int) AS vendorid",
        "fare_c / 100e0 AS fare_amount",
        "(l_linenumber % 3) * 50 / 100e0 AS extra",
        "CASE WHEN l_partkey % 19 = 0 THEN 0e0 ELSE 0.5e0 END AS mta_tax",
        "(greatest(fare_c, 0) * tip_pct div 100) / 100e0 AS tip_amount",
        "CASE WHEN l_suppkey % 11 = 0 THEN 6.55e0 ELSE 0e0 END AS tolls_amount",
        "CASE WHEN l_linenumber = 1 THEN 1e0 ELSE 0.3e0 END AS improvement_surcharge",
        "(fare_c + greatest(fare_c, 0) * tip_pct div 100 + l_linenumber * 10) / 100e0"
        " AS total_amount",
        "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE 2.5e0 END AS congestion_surcharge",
        "CASE WHEN l_suppkey % 10 = 1 THEN 1.25e0 ELSE 0e0 END AS airport_fee",
        "CASE WHEN l_linestatus = 'O' THEN 'yellow' ELSE 'green' END AS load_service_type",
        "year(date_from_unix_date(cast(pu_us div 86400000000 AS int))) AS load_year",
        "month(date_from_unix_date(cast(pu_us div 86400000000 AS int))) AS load_month",
    )


def service_bronze(trips: DataFrame, service: str) -> DataFrame:
    """One service's raw table, in the column names of that service's files."""
    prefix = TIME_PREFIX[service]
    one = trips.where(F.col("load_service_type") == service).withColumnsRenamed(
        {
            "pickup_ns": f"{prefix}_pickup_datetime",
            "dropoff_ns": f"{prefix}_dropoff_datetime",
        }
    )
    return one if service == "yellow" else one.drop("airport_fee")


def bronze_zones(spark: SparkSession, folder: str) -> DataFrame:
    """Zone lookup: one location per supplier, boroughs partly unknown or missing."""
    supplier = read_table(spark, folder, "supplier")
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .selectExpr(
            "cast(s_suppkey AS int) AS locationid",
            """CASE WHEN s_suppkey % 25 = 24 THEN 'Unknown' WHEN s_suppkey % 25 = 23 THEN NULL
                    ELSE r_name END AS borough""",
            "concat(n_name, '/', s_name) AS zone",
            "r_name AS service_zone",
        )
    )
