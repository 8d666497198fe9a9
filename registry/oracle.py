"""DuckDB SQL for the queries in ``registry/queries.py``, over the given tables."""

from __future__ import annotations

from tripmart.plans.silver import STAGED_COLUMNS

# ---------------------------------------------------------------- common table expressions

BASE = """
base AS (
  SELECT *,
    epoch_us(l_shipdate)
      + (((l_partkey * 7 + l_linenumber * 131) % 1440) * 60 + (l_suppkey * 17) % 60) * 1000000
      + 7300 * 86400000000 AS pu_us,
    CAST(round(l_extendedprice * 100) AS BIGINT) // 1000 - 200 AS fare_c,
    CAST(round(l_discount * 100) AS BIGINT) AS tip_pct
  FROM lineitem
),
bronze AS (
  SELECT pu_us * 1000 AS pickup_ns,
    CASE WHEN l_partkey % 37 = 0 THEN NULL
         ELSE (pu_us + ((CAST(l_quantity AS BIGINT) * 211 + l_partkey * 13) % 12000 - 300)
               * 1000000) * 1000 END AS dropoff_ns,
    CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END
      AS passenger_count,
    CASE WHEN l_partkey % 31 = 0 THEN 0e0 ELSE l_quantity * 0.4e0 END AS trip_distance,
    CASE WHEN l_linenumber = 7 THEN 99 WHEN l_partkey % 41 = 0 THEN NULL
         ELSE l_linenumber END AS ratecodeid,
    l_returnflag AS store_and_fwd_flag,
    CAST(l_suppkey AS INT) AS pulocationid,
    CAST(l_suppkey + l_linenumber AS INT) AS dolocationid,
    CAST(l_partkey % 7 AS INT) AS payment_type,
    CAST(l_orderkey % 3 AS INT) AS vendorid,
    fare_c / 100e0 AS fare_amount,
    (l_linenumber % 3) * 50 / 100e0 AS extra,
    CASE WHEN l_partkey % 19 = 0 THEN 0e0 ELSE 0.5e0 END AS mta_tax,
    (greatest(fare_c, 0) * tip_pct // 100) / 100e0 AS tip_amount,
    CASE WHEN l_suppkey % 11 = 0 THEN 6.55e0 ELSE 0e0 END AS tolls_amount,
    CASE WHEN l_linenumber = 1 THEN 1e0 ELSE 0.3e0 END AS improvement_surcharge,
    (fare_c + greatest(fare_c, 0) * tip_pct // 100 + l_linenumber * 10) / 100e0
      AS total_amount,
    CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE 2.5e0 END AS congestion_surcharge,
    CASE WHEN l_suppkey % 10 = 1 THEN 1.25e0 ELSE 0e0 END AS airport_fee,
    CASE WHEN l_linestatus = 'O' THEN 'yellow' ELSE 'green' END AS load_service_type,
    CAST(year(make_timestamp(pu_us)) AS INT) AS load_year,
    CAST(month(make_timestamp(pu_us)) AS INT) AS load_month
  FROM base
)"""

SILVER = (
    BASE
    + """,
silver AS (
  SELECT make_timestamp(pickup_ns // 1000) AS pickup_datetime,
    make_timestamp(dropoff_ns // 1000) AS dropoff_datetime,
    CAST(make_timestamp(pickup_ns // 1000) AS DATE) AS pickup_date,
    CAST(make_timestamp(dropoff_ns // 1000) AS DATE) AS dropoff_date,
    CAST(round(passenger_count) AS INT) AS passenger_count,
    trip_distance,
    CAST(ratecodeid AS INT) AS ratecode_id,
    store_and_fwd_flag,
    pulocationid AS pickup_location_id,
    dolocationid AS dropoff_location_id,
    payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
    improvement_surcharge, total_amount, congestion_surcharge,
    CASE WHEN load_service_type = 'yellow' THEN airport_fee END AS airport_fee,
    load_year, load_month, load_service_type, load_service_type AS service_type,
    vendorid AS vendor_id,
    date_diff('minute', make_timestamp(pickup_ns // 1000), make_timestamp(dropoff_ns // 1000))
      AS minutes
  FROM bronze
  WHERE pickup_ns IS NOT NULL AND dropoff_ns IS NOT NULL
)"""
)

ZONES = """
bronze_zones AS (
  SELECT CAST(s_suppkey AS INT) AS locationid,
    CASE WHEN s_suppkey % 25 = 24 THEN 'Unknown' WHEN s_suppkey % 25 = 23 THEN NULL
         ELSE r_name END AS borough,
    n_name, s_name, r_name AS service_zone
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
zones AS (
  SELECT DISTINCT locationid AS zone_sk,
    replace(n_name, 'NATION', 'Nation') || '/' || s_name AS zone_name,
    CASE borough WHEN 'MIDDLE EAST' THEN 'Middle East'
      ELSE upper(borough[1]) || lower(borough[2:]) END AS borough,
    CASE service_zone WHEN 'MIDDLE EAST' THEN 'Middle East'
      ELSE upper(service_zone[1]) || lower(service_zone[2:]) END AS service_zone
  FROM bronze_zones WHERE locationid IS NOT NULL
)"""


def _calendar(where: str) -> str:
    return f"""
dates AS (
  SELECT CAST(row_number() OVER (ORDER BY date_value) AS INT) AS date_sk, date_value,
    CAST(year(date_value) AS INT) AS year, CAST(month(date_value) AS INT) AS month,
    CAST(day(date_value) AS INT) AS day,
    strftime(date_value, '%b') AS month_name, strftime(date_value, '%A') AS day_name
  FROM (SELECT pickup_date AS date_value FROM silver WHERE {where}
        UNION SELECT dropoff_date FROM silver WHERE {where}) d
  WHERE date_value BETWEEN DATE '2015-01-01' AND DATE '2025-12-31'
)"""


DATES = _calendar("service_type = 'yellow'")

CODES = """
payments AS (
  SELECT DISTINCT payment_type AS payment_type_sk,
    CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'
      WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip' ELSE 'Other' END
      AS payment_type_desc
  FROM silver WHERE service_type = 'yellow' AND payment_type IS NOT NULL
),
rates AS (
  SELECT DISTINCT ratecode_id AS ratecode_sk,
    CASE ratecode_id WHEN 1 THEN 'Standard rate' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark'
      WHEN 4 THEN 'Nassau or Westchester' WHEN 5 THEN 'Negotiated fare'
      WHEN 6 THEN 'Group ride' ELSE 'Unknown' END AS ratecode_desc
  FROM silver WHERE service_type = 'yellow' AND ratecode_id IS NOT NULL
)"""

TIMES = """
times AS (
  SELECT DISTINCT CAST(time_sk AS INT) AS time_sk, CAST(time_sk // 60 AS INT) AS hour,
    CAST(time_sk % 60 AS INT) AS minute,
    CASE WHEN time_sk // 60 BETWEEN 6 AND 17 THEN 'day' ELSE 'night' END AS day_part
  FROM (SELECT hour(pickup_datetime) * 60 + minute(pickup_datetime) AS time_sk FROM silver
        UNION SELECT hour(dropoff_datetime) * 60 + minute(dropoff_datetime) FROM silver) t
)"""

STAR = ",".join([SILVER, ZONES, DATES, CODES])

_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in STAGED_COLUMNS if c != "service_type")


def _numbered(extra_order: str = "") -> str:
    return f"""
numbered AS (
  SELECT row_number() OVER (PARTITION BY service_type ORDER BY {_ORDER}{extra_order})
      AS trip_id, *
  FROM silver
)"""


NUMBERED = _numbered()
# The fact's trips carry the vendor id as well, which takes part in the order.
NUMBERED_WITH_VENDOR = _numbered(", vendor_id ASC NULLS FIRST")

STAGED_LIST = ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" if c in ("pickup_date", "dropoff_date") else c
    for c in STAGED_COLUMNS
)

# One row per trip with everything a mart reads. The calendar holds yellow days only.
FACT = (
    STAR
    + ","
    + NUMBERED_WITH_VENDOR
    + """,
fact AS (
  SELECT t.trip_id, d1.date_sk AS pickup_date_sk, d2.date_sk AS dropoff_date_sk,
    z1.zone_sk AS pickup_zone_sk, z2.zone_sk AS dropoff_zone_sk,
    p.payment_type_sk, r.ratecode_sk,
    CASE WHEN t.vendor_id IN (0, 1, 2) THEN t.vendor_id END AS vendor_sk,
    t.passenger_count, t.trip_distance, t.fare_amount, t.tip_amount, t.total_amount,
    t.load_service_type AS service_type, t.minutes AS trip_duration_min,
    t.congestion_surcharge, t.extra, t.tolls_amount, t.load_year, t.load_month,
    CAST(hour(t.pickup_datetime) * 60 + minute(t.pickup_datetime) AS INT) AS pickup_time_sk,
    CAST(hour(t.dropoff_datetime) * 60 + minute(t.dropoff_datetime) AS INT)
      AS dropoff_time_sk,
    d1.date_value AS pickup_day, d2.date_value AS dropoff_day, d1.year AS trip_year,
    d1.month AS trip_month, z1.zone_name AS pickup_zone, z2.zone_name AS dropoff_zone,
    z1.borough
  FROM numbered t
  LEFT JOIN dates d1 ON t.pickup_date = d1.date_value
  LEFT JOIN dates d2 ON t.dropoff_date = d2.date_value
  LEFT JOIN zones z1 ON t.pickup_location_id = z1.zone_sk
  LEFT JOIN zones z2 ON t.dropoff_location_id = z2.zone_sk
  LEFT JOIN payments p ON t.payment_type = p.payment_type_sk
  LEFT JOIN rates r ON t.ratecode_id = r.ratecode_sk
)"""
)

FACT_COLUMNS = """trip_id, pickup_date_sk, dropoff_date_sk, pickup_zone_sk, dropoff_zone_sk,
  payment_type_sk, ratecode_sk, vendor_sk, passenger_count, trip_distance, fare_amount,
  tip_amount, total_amount, service_type, trip_duration_min"""

# ---------------------------------------------------------------- month by month

# Months in their order per service; the third one comes again changed, the first one comes late.
MONTHS = """
months AS (
  SELECT *, row_number() OVER (PARTITION BY load_service_type ORDER BY load_year, load_month) AS k
  FROM (SELECT DISTINCT load_service_type, load_year, load_month FROM bronze) m
)"""

_BATCHED_DATES = """
SELECT CAST(row_number() OVER (ORDER BY batch, date_value) AS INT) AS date_sk, date_value,
  CAST(year(date_value) AS INT) AS year, CAST(month(date_value) AS INT) AS month,
  CAST(day(date_value) AS INT) AS day,
  strftime(date_value, '%b') AS month_name, strftime(date_value, '%A') AS day_name
FROM (SELECT date_value, min(batch) AS batch FROM (
    SELECT pickup_date AS date_value, batch FROM batched
    UNION ALL SELECT dropoff_date, batch FROM batched) e
  WHERE date_value BETWEEN DATE '2015-01-01' AND DATE '2025-12-31' GROUP BY 1) d"""

GROWN_DATES = (
    SILVER
    + """,
ends AS (SELECT min(load_year * 12 + load_month) AS low, max(load_year * 12 + load_month) AS high
  FROM silver),
batched AS (
  SELECT pickup_date, dropoff_date, CASE load_year * 12 + load_month WHEN low THEN 1
    WHEN high THEN 2 ELSE 0 END AS batch
  FROM silver, ends WHERE service_type = 'yellow'
)"""
)

GROWN_FACT = ",".join(
    [
        SILVER,
        ZONES,
        CODES,
        MONTHS,
        f"""
counted AS (
  SELECT service_type, k, count(*) AS n FROM silver s JOIN months m ON
    s.service_type = m.load_service_type AND s.load_year = m.load_year
    AND s.load_month = m.load_month
  GROUP BY ALL),
offsets AS (
  SELECT service_type, k, coalesce(sum(CASE WHEN k > 1 THEN n END) OVER (
      PARTITION BY service_type ORDER BY CASE WHEN k > 1 THEN k ELSE 1000000 END
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_id
  FROM counted),
batched AS (
  SELECT pickup_date, dropoff_date, CASE WHEN k = 1 THEN 1 ELSE 0 END AS batch
  FROM silver s JOIN months m ON s.service_type = m.load_service_type
    AND s.load_year = m.load_year AND s.load_month = m.load_month
  WHERE s.service_type = 'yellow'),
dates AS ({_BATCHED_DATES}),
latest AS (
  SELECT s.* REPLACE (CASE WHEN k = 3 THEN total_amount + 1 ELSE total_amount END AS total_amount),
    k
  FROM silver s JOIN months m ON s.service_type = m.load_service_type
    AND s.load_year = m.load_year AND s.load_month = m.load_month
  WHERE k <> 3 OR passenger_count IS NOT NULL),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY service_type, k
    ORDER BY {_ORDER}, vendor_id ASC NULLS FIRST) AS place FROM latest),
grown AS (
  SELECT CAST(first_id + place AS BIGINT) AS trip_id, d1.date_sk AS pickup_date_sk,
    d2.date_sk AS dropoff_date_sk, z1.zone_sk AS pickup_zone_sk, z2.zone_sk AS dropoff_zone_sk,
    p.payment_type_sk, r.ratecode_sk,
    CASE WHEN t.vendor_id IN (0, 1, 2) THEN t.vendor_id END AS vendor_sk,
    t.passenger_count, t.trip_distance, t.fare_amount, t.tip_amount, t.total_amount,
    t.service_type, t.minutes AS trip_duration_min, t.load_year, t.load_month
  FROM placed t JOIN offsets o ON t.service_type = o.service_type AND t.k = o.k
  LEFT JOIN dates d1 ON t.pickup_date = d1.date_value
  LEFT JOIN dates d2 ON t.dropoff_date = d2.date_value
  LEFT JOIN zones z1 ON t.pickup_location_id = z1.zone_sk
  LEFT JOIN zones z2 ON t.dropoff_location_id = z2.zone_sk
  LEFT JOIN payments p ON t.payment_type = p.payment_type_sk
  LEFT JOIN rates r ON t.ratecode_id = r.ratecode_sk
)""",
    ]
)

# ---------------------------------------------------------------- marts


def _top_zones(end: str) -> str:
    return (
        FACT
        + f""",
monthly AS (
  SELECT strftime({end}_day, '%Y-%m') AS year_month, {end}_zone AS zone_name, service_type,
    count(*) AS num_trips
  FROM fact WHERE {end}_day IS NOT NULL GROUP BY 1, 2, 3
),
top AS (
  SELECT year_month, zone_name, service_type, num_trips FROM (
    SELECT *, row_number() OVER (PARTITION BY year_month, service_type
      ORDER BY num_trips DESC, zone_name ASC NULLS LAST) AS rn FROM monthly) m
  WHERE rn <= 10
)"""
    )


def _revenue(times: int = 1) -> str:
    return (
        FACT
        + f""",
revenue AS (
  SELECT strftime(pickup_day, '%Y-%m') AS year_month, borough, service_type,
    sum(total_amount) * {times} AS total_revenue,
    avg(CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100 END) AS avg_tip_pct
  FROM fact
  WHERE pickup_day IS NOT NULL AND borough IS NOT NULL
    AND borough NOT IN ('Unknown', 'None', '')
  GROUP BY 1, 2, 3
)"""
    )


def _speed(extra: str = "") -> str:
    return (
        FACT
        + f""",
speed AS (
  SELECT trip_year, trip_month, borough, service_type{extra},
    avg(trip_distance * 60e0 / nullif(trip_duration_min, 0)) AS avg_mph
  FROM fact
  WHERE trip_distance > 0 AND trip_duration_min BETWEEN 1 AND 180
    AND trip_distance * 60e0 / nullif(trip_duration_min, 0) < 80
    AND borough IS NOT NULL AND borough NOT IN ('Unknown', 'None')
  GROUP BY ALL
)"""
    )


_PERCENTILES = (
    FACT
    + """,
every AS (
  SELECT trip_year, trip_month, pickup_zone, service_type,
    percentile_cont(0.5) WITHIN GROUP (ORDER BY trip_duration_min) AS p50_duration,
    percentile_cont(0.9) WITHIN GROUP (ORDER BY trip_duration_min) AS p90_duration
  FROM fact WHERE trip_duration_min BETWEEN 1 AND 180
  GROUP BY 1, 2, 3, 4
),
first50 AS (
  SELECT * FROM every
  ORDER BY trip_year ASC NULLS LAST, trip_month ASC NULLS LAST,
    p90_duration DESC NULLS FIRST, pickup_zone ASC NULLS LAST, service_type ASC NULLS LAST
  {limit}
),
summary AS (
  SELECT pickup_zone, service_type, avg(p50_duration) AS p50_duration,
    avg(p90_duration) AS p90_duration
  FROM first50 WHERE pickup_zone IS NOT NULL AND service_type IS NOT NULL
  GROUP BY 1, 2
  ORDER BY p90_duration DESC, pickup_zone, service_type
  LIMIT 15
),
long AS (
  SELECT pickup_zone, service_type, 'P50_DURATION' AS percentile, p50_duration AS duration_min
  FROM summary
  UNION ALL
  SELECT pickup_zone, service_type, 'P90_DURATION', p90_duration FROM summary
)"""
)

PERCENTILES = _PERCENTILES.replace("{limit}", "LIMIT 50")
ALL_PERCENTILES = _PERCENTILES.replace("{limit}", "")

ROUND_PERCENTILES = "round(p50_duration, 6) AS p50_duration, round(p90_duration, 6) AS p90_duration"


def _demand(first: str, last: str) -> str:
    return (
        SILVER
        + f""",
demand AS (
  SELECT CAST(CAST(pickup_datetime AS DATE) AS VARCHAR) AS pickup_date,
    CAST(isodow(pickup_datetime) AS INT) AS day_number,
    CAST(hour(pickup_datetime) AS INT) AS pickup_hour, service_type,
    count(*) AS num_trips, upper(dayname(pickup_datetime)) AS day_name
  FROM silver
  WHERE pickup_datetime BETWEEN TIMESTAMP '{first}' AND TIMESTAMP '{last}'
  GROUP BY ALL
)"""
    )


JANUARY = _demand("2019-01-01", "2019-01-31")

_WEEKDAYS = ("MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY")

# ---------------------------------------------------------------- checks


def _results(rows: list[tuple[str, str, str, str]]) -> str:
    """Check results from (check, table, column, SQL expression counting failures) rows."""
    parts = [
        f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", '{column}' AS \"column\","
        f" CAST(({count}) AS BIGINT) AS n_failing"
        for check, table, column, count in rows
    ]
    union = "\nUNION ALL ".join(parts)
    return f"""SELECT *, CASE WHEN n_failing = 0 THEN 'pass' ELSE 'fail' END AS status
FROM ({union}) r"""


def _nulls(table: str, column: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {column} IS NULL"


def _duplicates(table: str, key: str) -> str:
    present = " AND ".join(f"{c} IS NOT NULL" for c in key.split(", "))
    return (
        f"SELECT count(*) FROM (SELECT {key} FROM {table} WHERE {present}"
        f" GROUP BY {key} HAVING count(*) > 1) k"
    )


def _orphans(table: str, column: str, parent: str, key: str) -> str:
    return (
        f"SELECT count(*) FROM {table} c WHERE c.{column} IS NOT NULL"
        f" AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column})"
    )


def _unexpected(column: str, accepted: str) -> str:
    return (
        f"SELECT count(DISTINCT {column}) FROM silver"
        f" WHERE {column} IS NOT NULL AND {column} NOT IN ({accepted})"
    )


RANGE = """(trip_duration_min NOT BETWEEN 1 AND 180 OR trip_distance <= 0 OR total_amount < 0)"""

VENDORS = """
vendors AS (SELECT * FROM (VALUES (1), (2), (0)) v(vendor_sk))"""

DIM_KEYS = {
    "dim_date": ("dates", "date_sk"),
    "dim_zone": ("zones", "zone_sk"),
    "dim_payment_type": ("payments", "payment_type_sk"),
    "dim_ratecode": ("rates", "ratecode_sk"),
}

FOREIGN_KEYS = {
    "pickup_date_sk": ("dates", "date_sk"),
    "dropoff_date_sk": ("dates", "date_sk"),
    "pickup_zone_sk": ("zones", "zone_sk"),
    "dropoff_zone_sk": ("zones", "zone_sk"),
    "payment_type_sk": ("payments", "payment_type_sk"),
    "ratecode_sk": ("rates", "ratecode_sk"),
}

STAGED_KEYS = {
    "pickup_location_id": ("zones", "zone_sk"),
    "dropoff_location_id": ("zones", "zone_sk"),
    "payment_type": ("payments", "payment_type_sk"),
    "ratecode_id": ("rates", "ratecode_sk"),
}

FACT_FOREIGN = [
    ("relationships", "fct_trips", column, _orphans("fact", column, *parent))
    for column, parent in FOREIGN_KEYS.items()
]

SUITE = [
    *[
        ("not_null", "fct_trips", c, _nulls("fact", c))
        for c in ("trip_id", "pickup_date_sk", "passenger_count")
    ],
    *[("not_null", name, key, _nulls(t, key)) for name, (t, key) in DIM_KEYS.items()],
    ("unique", "fct_trips", "trip_id", _duplicates("fact", "trip_id")),
    *[("unique", name, key, _duplicates(t, key)) for name, (t, key) in DIM_KEYS.items()],
    ("unique", "dim_vendor", "vendor_sk", _duplicates("vendors", "vendor_sk")),
    *FACT_FOREIGN,
]

# ---------------------------------------------------------------- ingest

_BATCH = """vendorid,
  CASE WHEN load_service_type = 'yellow' THEN make_timestamp(pickup_ns // 1000) END
    AS tpep_pickup_datetime,
  CASE WHEN load_service_type = 'yellow' THEN make_timestamp(dropoff_ns // 1000) END
    AS tpep_dropoff_datetime,
  CASE WHEN load_service_type = 'green' THEN make_timestamp(pickup_ns // 1000) END
    AS lpep_pickup_datetime,
  CASE WHEN load_service_type = 'green' THEN make_timestamp(dropoff_ns // 1000) END
    AS lpep_dropoff_datetime,
  passenger_count, trip_distance, CAST(ratecodeid AS INT) AS ratecodeid, store_and_fwd_flag,
  pulocationid, dolocationid, payment_type, fare_amount, extra, mta_tax, tip_amount,
  tolls_amount, improvement_surcharge, total_amount, congestion_surcharge,
  CASE WHEN load_service_type = 'yellow' THEN airport_fee END AS airport_fee,
  load_service_type, load_year, load_month"""

LOADED = f"WITH {BASE} SELECT {_BATCH} FROM bronze"

SAMPLE = (
    "passenger_count",
    "ratecodeid",
    "congestion_surcharge",
    "fare_amount",
    "payment_type",
    "trip_distance",
)


def _imputed(kind: str | None = None) -> str:
    def shown(column: str) -> str:
        filled = (
            f"coalesce({column}, (SELECT percentile_disc(0.5) WITHIN GROUP"
            f" (ORDER BY {column} DESC) FROM bronze))"
        )
        return f"CAST({filled} AS {kind}) AS {column}" if kind else f"{filled} AS {column}"

    return f"WITH {BASE} SELECT {', '.join(shown(c) for c in SAMPLE)} FROM bronze"


# ---------------------------------------------------------------- the queries

ORACLE: dict[str, str] = {
    "stage_trips": f"""WITH {SILVER}, {NUMBERED}
SELECT trip_id, {STAGED_LIST} FROM numbered WHERE service_type = 'yellow'""",
    "stage_green_trips": f"""WITH {SILVER}, {NUMBERED}
SELECT trip_id, {STAGED_LIST} FROM numbered WHERE service_type = 'green'""",
    "all_trips": f"WITH {SILVER}, {NUMBERED} SELECT trip_id, {STAGED_LIST} FROM numbered",
    "assign_trip_id": """
SELECT l_shipdate, l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice,
  row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_partkey, l_linenumber, l_quantity,
    l_extendedprice) AS trip_id
FROM lineitem""",
    "stage_zones_dim_zone": f"WITH {ZONES} SELECT zone_sk, zone_name, borough, service_zone FROM zones",
    "clean_trips": f"""WITH {SILVER} SELECT {STAGED_LIST} FROM silver
WHERE trip_distance > 0 AND fare_amount >= 0 AND minutes BETWEEN 1 AND 180
  AND trip_distance * 60e0 / nullif(minutes, 0) <= 80""",
    "clean_report": f"""WITH {SILVER}, flagged AS (
  SELECT trip_distance <= 0 AS d, fare_amount < 0 AS f, minutes NOT BETWEEN 1 AND 180 AS m,
    coalesce(minutes > 0 AND trip_distance * 60e0 / nullif(minutes, 0) > 80, false) AS s
  FROM silver)
SELECT 'trip_distance' AS rule, count(*) FILTER (WHERE d) AS n_trips FROM flagged
UNION ALL SELECT 'fare_amount', count(*) FILTER (WHERE f) FROM flagged
UNION ALL SELECT 'duration', count(*) FILTER (WHERE m) FROM flagged
UNION ALL SELECT 'speed', count(*) FILTER (WHERE s) FROM flagged
UNION ALL SELECT 'kept', count(*) FILTER (WHERE NOT (d OR f OR m OR s)) FROM flagged""",
    "dedupe_trips": f"""WITH {SILVER}
SELECT {STAGED_LIST}, vendor_id FROM (
  SELECT *, row_number() OVER (
      PARTITION BY service_type, pickup_datetime, dropoff_datetime, vendor_id
      ORDER BY {_ORDER}) AS rn
  FROM (SELECT * FROM silver
        UNION ALL SELECT * REPLACE (total_amount + 1 AS total_amount) FROM silver) t) s
WHERE rn = 1""",
    "zone_conformance": f"""WITH {SILVER}, {ZONES} SELECT {STAGED_LIST} FROM silver
WHERE dropoff_location_id IN (SELECT zone_sk FROM zones)""",
    "zone_conformance_rejects": f"""WITH {SILVER}, {ZONES} SELECT {STAGED_LIST} FROM silver
WHERE dropoff_location_id IS NULL
  OR dropoff_location_id NOT IN (SELECT zone_sk FROM zones)""",
    "dim_date": f"""WITH {SILVER}, {DATES}
SELECT * REPLACE (CAST(date_value AS VARCHAR) AS date_value) FROM dates""",
    "dim_date_all_services": f"""WITH {SILVER}, {_calendar("true")}
SELECT * REPLACE (CAST(date_value AS VARCHAR) AS date_value) FROM dates""",
    "dim_payment_type": f"WITH {SILVER}, {CODES} SELECT * FROM payments",
    "dim_ratecode": f"WITH {SILVER}, {CODES} SELECT * FROM rates",
    "dim_time": f"WITH {SILVER}, {TIMES} SELECT * FROM times",
    "fct_trips": f"WITH {FACT} SELECT {FACT_COLUMNS} FROM fact",
    "fct_trips_vendor_fanout": f"""WITH {FACT}, {VENDORS}
SELECT {FACT_COLUMNS.replace("vendor_sk", "v.vendor_sk")}
FROM fact LEFT JOIN vendors v ON 1 = 1""",
    "fct_trips_documented": f"""WITH {FACT}
SELECT {FACT_COLUMNS}, pickup_time_sk, dropoff_time_sk, congestion_surcharge, extra,
  tolls_amount, load_year, load_month FROM fact""",
    "cluster_fact": f"WITH {FACT} SELECT {FACT_COLUMNS} FROM fact",
    "q1_pickup_top_zones": f"WITH {_top_zones('pickup')} SELECT * FROM top",
    "q1_dropoff_top_zones": f"WITH {_top_zones('dropoff')} SELECT * FROM top",
    "q2_revenue_tips": f"""WITH {_revenue()} SELECT year_month, borough, service_type,
  round(total_revenue, 2) AS total_revenue, round(avg_tip_pct, 6) AS avg_tip_pct
FROM revenue""",
    "q2_revenue_tips_vendor_fanout": f"""WITH {_revenue(3)}
SELECT year_month, borough, service_type, round(total_revenue, 2) AS total_revenue,
  round(avg_tip_pct, 6) AS avg_tip_pct
FROM revenue""",
    "q3_speed": f"""WITH {_speed()} SELECT trip_year, trip_month, borough, service_type,
  round(avg_mph, 6) AS avg_mph FROM speed""",
    "q3_speed_hour_band": f"""WITH {_speed(
        ", CASE WHEN pickup_time_sk // 60 BETWEEN 6 AND 17 THEN 'day' ELSE 'night' END"
        " AS day_part"
    )} SELECT trip_year, trip_month, borough, service_type, day_part,
  round(avg_mph, 6) AS avg_mph FROM speed""",
    "q4_duration_percentiles": f"""WITH {PERCENTILES} SELECT trip_year, trip_month,
  pickup_zone, service_type, {ROUND_PERCENTILES} FROM first50""",
    "q4_duration_percentiles_all": f"""WITH {PERCENTILES} SELECT trip_year, trip_month,
  pickup_zone, service_type, {ROUND_PERCENTILES} FROM every""",
    "duration_zone_summary": f"""WITH {PERCENTILES} SELECT pickup_zone, service_type,
  {ROUND_PERCENTILES} FROM summary""",
    "duration_long": f"""WITH {PERCENTILES} SELECT pickup_zone, service_type, percentile,
  round(duration_min, 6) AS duration_min FROM long""",
    "duration_zone_summary_all": f"""WITH {ALL_PERCENTILES} SELECT pickup_zone, service_type,
  {ROUND_PERCENTILES} FROM summary""",
    "duration_long_all": f"""WITH {ALL_PERCENTILES} SELECT pickup_zone, service_type, percentile,
  round(duration_min, 6) AS duration_min FROM long""",
    "q5_temporal_demand": f"WITH {JANUARY} SELECT * FROM demand",
    "q5_temporal_demand_all": f"WITH {_demand('2014-01-01', '2026-01-01')} SELECT * FROM demand",
    "weekday_hour_heatmap": f"""WITH {JANUARY} SELECT pickup_hour, {", ".join(
        f"CAST(sum(num_trips) FILTER (WHERE day_name = '{d}') AS BIGINT) AS \"{d}\""
        for d in _WEEKDAYS
    )} FROM demand GROUP BY 1""",
    "hourly_curve": f"""WITH {JANUARY} SELECT pickup_hour, service_type,
  CAST(sum(num_trips) AS BIGINT) AS num_trips FROM demand GROUP BY 1, 2""",
    "chart_q1_pickup": f"""WITH {_top_zones('pickup')} SELECT zone_name, service_type,
  round(avg(num_trips), 6) AS num_trips FROM top
WHERE zone_name IS NOT NULL AND service_type IS NOT NULL GROUP BY 1, 2""",
    "chart_q1_dropoff": f"""WITH {_top_zones('dropoff')} SELECT zone_name, service_type,
  round(avg(num_trips), 6) AS num_trips FROM top
WHERE zone_name IS NOT NULL AND service_type IS NOT NULL GROUP BY 1, 2""",
    "chart_q2": f"""WITH {_revenue()} SELECT borough, service_type,
  round(avg(total_revenue), 4) AS total_revenue, round(avg(avg_tip_pct), 6) AS avg_tip_pct
FROM revenue GROUP BY 1, 2""",
    "chart_q3": f"""WITH {_speed()} SELECT trip_year, borough, service_type,
  round(avg(avg_mph), 6) AS avg_mph
FROM speed WHERE trip_year IS NOT NULL GROUP BY 1, 2, 3""",
    "chart_q4": f"""WITH {PERCENTILES} SELECT pickup_zone, percentile,
  round(avg(duration_min), 6) AS duration_min FROM long GROUP BY 1, 2""",
    "chart_q4_all": f"""WITH {ALL_PERCENTILES} SELECT pickup_zone, percentile,
  round(avg(duration_min), 6) AS duration_min FROM long GROUP BY 1, 2""",
    "top_n_per_group": f"""WITH {SILVER}
SELECT service_type, pickup_location_id, total_amount, pickup_datetime, dropoff_datetime
FROM (SELECT *, row_number() OVER (PARTITION BY service_type, pickup_location_id
        ORDER BY total_amount DESC, pickup_datetime, dropoff_datetime) AS rn FROM silver) s
WHERE rn <= 3""",
    "impute_upper_median": _imputed(),
    "impute_sample_csv": _imputed("DOUBLE"),
    "check_not_null": f"WITH {FACT} "
    + _results(
        [
            ("not_null", "fct_trips", c, _nulls("fact", c))
            for c in ("trip_id", "pickup_date_sk", "passenger_count", "ratecode_sk")
        ]
    ),
    "check_unique": f"WITH {FACT} "
    + _results(
        [
            ("unique", "fct_trips", key, _duplicates("fact", key))
            for key in ("trip_id", "service_type, trip_id", "pickup_zone_sk")
        ]
    ),
    "check_relationships": f"WITH {FACT} "
    + _results(
        FACT_FOREIGN
        + [
            ("relationships", "stg_all_trips", column, _orphans("silver", column, *parent))
            for column, parent in STAGED_KEYS.items()
        ]
    ),
    "check_accepted_values": f"WITH {SILVER} "
    + _results(
        [
            ("accepted_values", "stg_all_trips", column, _unexpected(column, accepted))
            for column, accepted in {
                "service_type": "'yellow', 'green'",
                "payment_type": "1, 2, 3, 4, 5, 6",
                "ratecode_id": "1, 2, 3, 4, 5, 6",
            }.items()
        ]
    ),
    "check_range": f"WITH {FACT} "
    + _results([("range", "fct_trips", "trip", f"SELECT count(*) FROM fact WHERE {RANGE}")]),
    "check_not_empty": f"WITH {SILVER} "
    + _results(
        [
            ("not_empty", name, "*", f"SELECT count(*) = 0 FROM silver WHERE {kept}")
            for name, kept in {
                "stg_all_trips": "true",
                "trips_before_2000": "load_year < 2000",
            }.items()
        ]
    ),
    "check_suite": f"WITH {FACT}, {VENDORS} " + _results(SUITE),
    "store_failures": f"""WITH {FACT} SELECT pickup_date_sk, pickup_zone_sk, passenger_count,
  trip_distance, fare_amount, tip_amount, total_amount, service_type, trip_duration_min
FROM fact WHERE {RANGE}""",
    "ingest_month": LOADED,
    "backfill_months": LOADED,
    "backfill_drift": f"""WITH {BASE} SELECT * REPLACE (
  CASE WHEN load_month % 2 = 0 THEN congestion_surcharge END AS congestion_surcharge)
FROM ({LOADED[len(f"WITH {BASE} ") :]}) b""",
    "reload_empty_month": f"""WITH {BASE}, loaded AS ({LOADED[len(f"WITH {BASE} ") :]})
SELECT * FROM loaded l WHERE (load_year, load_month) <> (
  SELECT (load_year, load_month) FROM loaded f WHERE f.load_service_type = l.load_service_type
  ORDER BY load_year, load_month LIMIT 1)""",
    "loaded_rows": f"""WITH {BASE}, asked AS (
  SELECT s.load_service_type, CAST(m // 12 AS INT) AS load_year,
    CAST(m % 12 + 1 AS INT) AS load_month
  FROM (VALUES ('yellow'), ('green')) s(load_service_type),
    generate_series((SELECT min(load_year * 12 + load_month) - 2 FROM bronze),
                    (SELECT max(load_year * 12 + load_month) FROM bronze)) g(m)),
found AS (SELECT load_service_type, load_year, load_month, count(*) AS n FROM bronze GROUP BY ALL)
SELECT a.load_service_type, a.load_year, a.load_month, n AS loaded_rows
FROM asked a LEFT JOIN found USING (load_service_type, load_year, load_month)""",
    "stage_loaded_trips": f"WITH {SILVER} SELECT {STAGED_LIST} FROM silver",
    "stream_backfill": LOADED,
    "coverage_matrix": f"""WITH {BASE}, present AS (
  SELECT DISTINCT load_service_type, load_year, load_month FROM bronze),
asked AS (
  SELECT s.load_service_type, CAST(m // 12 AS INT) AS load_year,
    CAST(m % 12 + 1 AS INT) AS load_month
  FROM (VALUES ('yellow'), ('green')) s(load_service_type),
    generate_series((SELECT min(load_year * 12 + load_month) - 2 FROM bronze),
                    (SELECT max(load_year * 12 + load_month) FROM bronze)) g(m))
SELECT a.load_service_type, a.load_year, a.load_month, p.load_year IS NOT NULL AS file_exists,
  CASE WHEN p.load_year IS NULL THEN 'ERROR' ELSE 'OK' END AS load_status
FROM asked a LEFT JOIN present p USING (load_service_type, load_year, load_month)""",
    "grow_dim_date": f"WITH {GROWN_DATES} SELECT * REPLACE (CAST(date_value AS VARCHAR) AS date_value)"
    f" FROM ({_BATCHED_DATES}) b",
    "changed_months": f"""WITH {BASE}, {MONTHS}
SELECT load_service_type AS service_type, load_year, load_month,
  CASE k WHEN 1 THEN 'new' WHEN 3 THEN 'changed' ELSE 'same' END AS change FROM months""",
    "refresh_gold": f"WITH {GROWN_FACT} SELECT * FROM grown",
    "load_counts": f"""WITH {BASE} SELECT load_service_type, load_year, load_month,
  count(*) AS total_rows FROM bronze GROUP BY 1, 2, 3""",
    "ingest_zones": f"""WITH {ZONES} SELECT locationid, borough, n_name || '/' || s_name AS zone,
  service_zone FROM bronze_zones""",
    "conform_batch": """SELECT event_id AS "EVENT_ID", ts AS "EVENT_DATETIME",
  'day ' || event_id AS "ODD_DATE", user_id AS "USER_ID", event_type AS "EVENT_TYPE"
FROM events""",
    "coerce_datetime_columns": """SELECT event_id, ts AS text_date, ts AS ns_date,
  CASE WHEN event_id = 7 THEN 'not a day' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END
    AS broken_date,
  CAST(CAST(ts AS DATE) AS TIMESTAMP) AS plain_date, event_type AS kind
FROM events""",
    "backfill_control_columns": """SELECT event_id,
  CAST(CASE WHEN user_id % 3 = 0 THEN 2019 ELSE year(ts) END AS INT) AS load_year,
  CAST(CASE WHEN user_id % 3 = 0 THEN 1 WHEN user_id % 2 <> 0 THEN month(ts) END AS INT)
    AS load_month,
  CASE WHEN user_id % 3 = 0 THEN 'green' END AS load_service_type
FROM events""",
    "run_sql": f"""WITH {FACT} SELECT trip_year, borough, count(*) AS num_trips,
  round(percentile_cont(0.5) WITHIN GROUP (ORDER BY trip_duration_min), 6)
    AS median_minutes
FROM fact GROUP BY 1, 2""",
    "run_sql_weekday": f"""WITH {SILVER} SELECT CAST(isodow(pickup_datetime) AS INT) AS day_number,
  CAST(hour(pickup_datetime) AS INT) AS pickup_hour,
  count(*) FILTER (WHERE service_type = 'yellow') AS yellow_trips, count(*) AS num_trips
FROM silver GROUP BY 1, 2""",
    "append_existing": f"""WITH {BASE} SELECT * EXCLUDE (pickup_ns, dropoff_ns)
  REPLACE (CASE WHEN load_service_type = 'yellow' THEN airport_fee END AS airport_fee)
FROM bronze""",
    "write_chunked": f"WITH {BASE} SELECT * FROM bronze",
}

# Sums in whole units of 2**-40, which no order changes, turned into doubles once.
_UNITS = "CAST(floor({0}) AS HUGEINT) * 1099511627776 + CAST(floor(({0} - floor({0})) * 1099511627776e0 + 0.5e0) AS HUGEINT)"
_EXACT = "CAST(sum({0}) AS DOUBLE) / 1099511627776e0"

EXACT_REVENUE = f"""WITH {FACT}, shares AS (
  SELECT *, CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100 END AS tip_pct FROM fact
  WHERE pickup_day IS NOT NULL AND borough IS NOT NULL AND borough NOT IN ('Unknown', 'None', ''))
SELECT strftime(pickup_day, '%Y-%m') AS year_month, borough, service_type,
  {_EXACT.format(_UNITS.format("total_amount"))} AS total_revenue,
  {_EXACT.format(_UNITS.format("tip_pct"))} / count(tip_pct) AS avg_tip_pct
FROM shares GROUP BY 1, 2, 3"""

ORACLE |= {
    "q1_from_states": ORACLE["q1_pickup_top_zones"],
    "q1_dropoff_from_states": ORACLE["q1_dropoff_top_zones"],
    "q2_from_states": EXACT_REVENUE,
    "q2_revenue_tips_exact": EXACT_REVENUE,
    "q3_from_states": ORACLE["q3_speed"],
    "q4_from_states": ORACLE["q4_duration_percentiles_all"],
    "q5_from_states": ORACLE["q5_temporal_demand_all"],
}

# ---------------------------------------------------------------- whole tables in one pass

_ROW_CHECKS = [
    *[("not_null", "fct_trips", c, f"{c} IS NULL") for c in ("trip_id", "pickup_date_sk", "passenger_count")],
    *[
        ("relationships", "fct_trips", c, f"{c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {t})")
        for c, (t, k) in FOREIGN_KEYS.items()
    ],
    ("range", "fct_trips", "trip", RANGE),
    *[
        ("relationships", "stg_all_trips", c, f"{c} NOT IN (SELECT zone_sk FROM zones)")
        for c in ("pickup_location_id", "dropoff_location_id")
    ],
    *[
        ("accepted_values", "stg_all_trips", c, f"{c} NOT IN (1, 2, 3, 4, 5, 6)")
        for c in ("payment_type", "ratecode_id")
    ],
    ("not_null", "stg_all_trips", "passenger_count", "passenger_count IS NULL"),
]
_CHECKED = {"fct_trips": ("fact", "trip_id"), "stg_all_trips": ("silver", "CAST(NULL AS BIGINT)")}

_BY_LOAD = ", ".join(
    f"{c} ASC NULLS FIRST" for c in STAGED_COLUMNS if c not in ("service_type", "pickup_datetime")
)

ORACLE |= {
    "check_rows": f"WITH {FACT} "
    + _results(
        [
            (check, table, column, f"SELECT count(*) FROM {_CHECKED[table][0]} WHERE {broken}")
            for check, table, column, broken in _ROW_CHECKS
        ]
    ),
    "stored_failures": f"WITH {FACT} "
    + " UNION ALL ".join(
        f"SELECT service_type, {_CHECKED[table][1]} AS trip_id, '{check}_{column}' AS check_name"
        f" FROM {_CHECKED[table][0]} WHERE {broken}"
        for check, table, column, broken in _ROW_CHECKS
    ),
    "dedupe_across_loads": f"""WITH {SILVER}
SELECT {STAGED_LIST}, vendor_id FROM (
  SELECT *, row_number() OVER (
      PARTITION BY service_type, pickup_datetime, dropoff_datetime, vendor_id
      ORDER BY batch, {_BY_LOAD}) AS rn
  FROM (SELECT *, load_year AS batch FROM silver
        UNION ALL SELECT * REPLACE (total_amount + 1 AS total_amount), load_year + 1 FROM silver) t) s
WHERE rn = 1""",
    "fare_speed_percentiles": f"""WITH {SILVER}, valued AS (
  SELECT service_type, 'fare_amount' AS measure, fare_amount AS value FROM silver
  UNION ALL
  SELECT service_type, 'speed_mph', CASE WHEN minutes > 0 THEN trip_distance * 60e0 / minutes END
  FROM silver)
SELECT service_type, measure, share, round(percentile, 6) AS percentile FROM (
  SELECT service_type, measure, unnest([0.1e0, 0.5e0, 0.9e0, 0.99e0]) AS share,
    unnest(quantile_cont(value, [0.1, 0.5, 0.9, 0.99])) AS percentile
  FROM valued GROUP BY service_type, measure) q""",
    "interleave_fact": ORACLE["cluster_fact"],
    "coverage_runs": f"""WITH {BASE}, asked AS (
  SELECT s.load_service_type, m, m IN (SELECT load_year * 12 + load_month - 1 FROM bronze b
      WHERE b.load_service_type = s.load_service_type) AND (m % 12 + 1) % 5 <> 0 AS loaded
  FROM (VALUES ('yellow'), ('green')) s(load_service_type),
    generate_series((SELECT min(load_year * 12 + load_month) - 2 FROM bronze),
                    (SELECT max(load_year * 12 + load_month) FROM bronze)) g(m)),
runs AS (
  SELECT *, m - row_number() OVER (PARTITION BY load_service_type, loaded ORDER BY m) AS run FROM asked)
SELECT load_service_type, loaded, printf('%04d-%02d', min(m) // 12, min(m) % 12 + 1) AS first_month,
  printf('%04d-%02d', max(m) // 12, max(m) % 12 + 1) AS last_month, count(*) AS n_months
FROM runs GROUP BY load_service_type, loaded, run""",
    "append_table": f"""WITH {BASE} SELECT load_service_type, load_year, load_month, payment_type,
  total_amount FROM bronze""",
    "replace_table": f"""WITH {BASE} SELECT load_service_type, load_year, load_month, payment_type,
  total_amount FROM bronze WHERE load_service_type = 'green'""",
    "ingest_latest_month": f"""WITH {BASE} SELECT load_service_type, load_year, load_month,
  payment_type, total_amount FROM bronze
QUALIFY rank() OVER (PARTITION BY load_service_type ORDER BY load_year DESC, load_month DESC) = 1""",
    "drop_blank_names": """SELECT event_id, event_type AS kind, "value" FROM events""",
    "starter_models": """WITH first_model AS (
  SELECT CAST(nullif(s_nationkey, 0) AS INT) AS id FROM supplier),
second_model AS (SELECT id FROM first_model WHERE id = 1),
both_models AS (SELECT 'first_model' AS "table", id FROM first_model
  UNION ALL SELECT 'second_model', id FROM second_model),
names AS (FROM (VALUES ('first_model'), ('second_model')) v("table")),
per_id AS (SELECT "table", id, count(*) AS n FROM both_models GROUP BY ALL),
counted AS (
  SELECT 'not_null' AS "check", "table", count(*) FILTER (n IS NOT NULL AND id IS NULL) AS n_failing
  FROM names LEFT JOIN (SELECT *, 1 AS n FROM both_models) USING ("table") GROUP BY ALL
  UNION ALL SELECT 'unique', "table", count(*) FILTER (id IS NOT NULL AND n > 1)
  FROM names LEFT JOIN per_id USING ("table") GROUP BY ALL)
SELECT "check", "table", 'id' AS "column", n_failing,
  CASE WHEN n_failing = 0 THEN 'pass' ELSE 'fail' END AS status
FROM counted""",
    "stream_first_trips": f"""WITH {SILVER} SELECT DISTINCT service_type, vendor_id, pickup_datetime,
  dropoff_datetime FROM silver""",
    "run_sql_view": f"""WITH {SILVER} SELECT service_type, CAST(year(pickup_datetime) AS INT) AS trip_year,
  payment_type, count(*) AS num_trips, max(total_amount) AS dearest
FROM silver GROUP BY ALL""",
}
