"""Gold month by month: keys that stay, fingerprints, changed months only, states that add up."""

import math
import random
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.exact import merged_parts, sum_parts, total
from tripmart.operators.key_map import KeyMap
from tripmart.plans import increments, marts, states
from tripmart.session import file_states, new_path, remove_path
from tripmart.sources import ingest
from tripmart.sources.ingest import Month

TEXT_KEY = T.StructType([T.StructField("name", T.StringType())])


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "name string")


# ---------------------------------------------------------------- key map


def test_keys_once_given_stay(spark):
    keys = KeyMap(spark, new_path(spark, "test-keys"), TEXT_KEY)
    assert rows(keys.read()) == []
    keys.grow(names(spark, "m", "t", "m", None), 1)
    grown = keys.grow(names(spark, "a", "t", "z"), 2)
    assert rows(grown) == [("a", 3, 2), ("m", 1, 1), ("t", 2, 1), ("z", 4, 2)]
    assert rows(keys.grow(names(spark, "a", None), 3)) == rows(grown)
    assert keys.batches() == [1, 2]


def test_a_batch_may_be_repeated_but_not_one_before_the_last(spark):
    keys = KeyMap(spark, new_path(spark, "test-keys"), TEXT_KEY)
    keys.grow(names(spark, "b"), 1)
    keys.grow(names(spark, "a", "x"), 2)  # a run that fails later, and comes again with less
    assert rows(keys.grow(names(spark, "x"), 2)) == [("b", 1, 1), ("x", 2, 2)]
    assert rows(keys.grow(names(spark), 2)) == [("b", 1, 1)]
    keys.grow(names(spark, "c"), 3)
    with pytest.raises(ValueError, match="older"):
        keys.grow(names(spark, "d"), 2)


def test_lookup_leaves_unknown_members_without_a_key(spark):
    keys = KeyMap(spark, new_path(spark, "test-keys"), TEXT_KEY)
    keys.grow(names(spark, "a", "b"), 1)
    found = keys.lookup(names(spark, "b", "q", None), ["name"], "name_sk")
    assert rows(found) == [("b", 2), ("q", None), (None, None)]


# ---------------------------------------------------------------- fingerprints


def raw_rows(spark, data):
    schema = "a int, b string, c string, LOAD_SERVICE_TYPE string, LOAD_YEAR int, LOAD_MONTH int"
    return spark.createDataFrame([(*d, "yellow", 2019, 1) for d in data], schema)


def test_fingerprints_ignore_order_but_no_value(spark):
    data = [(1, "x", None), (2, None, "x"), (2, None, "x"), (None, None, None)]

    def mark(data, n=1):
        return rows(increments.month_prints(raw_rows(spark, data).repartition(n)))

    assert mark(data) == mark(data[::-1], 4)
    for other in (
        data[:-1],
        [*data, data[-1]],
        [(1, None, "x"), *data[1:]],
        [(1, "x", None), (1, "x", None), (2, None, "x"), (None, None, None)],
    ):
        assert mark(other) != mark(data)
    columns = raw_rows(spark, data)
    turned = columns.select(*columns.columns[::-1])
    assert rows(increments.month_prints(turned)) == mark(data)


# ---------------------------------------------------------------- refresh

JAN, FEB, MAR = (Month("yellow", 2019, m) for m in (1, 2, 3))


def trip(day, minute, zone=4, total=10.0, passengers=1.0):
    start = datetime(2019, day[0], day[1], 10, minute)
    end = datetime(2019, day[0], day[1], 10, minute + 20)
    return (1, start, end, passengers, 5.0, 1, "N", zone, 5, 1, 8.0, 0.0, 0.5, 2.0, 0.0, 0.3, total, 2.5, 0.0)


SCHEMA = (
    "VENDORID int, TPEP_PICKUP_DATETIME timestamp_ntz, TPEP_DROPOFF_DATETIME timestamp_ntz, "
    "PASSENGER_COUNT double, TRIP_DISTANCE double, RATECODEID int, STORE_AND_FWD_FLAG string, "
    "PULOCATIONID int, DOLOCATIONID int, PAYMENT_TYPE int, FARE_AMOUNT double, EXTRA double, "
    "MTA_TAX double, TIP_AMOUNT double, TOLLS_AMOUNT double, IMPROVEMENT_SURCHARGE double, "
    "TOTAL_AMOUNT double, CONGESTION_SURCHARGE double, AIRPORT_FEE double"
)


class Layers:
    """A raw and a gold layer, and a source whose months are put there by hand."""

    def __init__(self, spark):
        self.spark = spark
        self.source, self.raw, self.gold = (new_path(spark, f"test-{n}") for n in ("src", "raw", "gold"))
        zones = [(4, "Queens", "Astoria", "Boro"), (5, "Bronx", "Hill", "Boro")]
        self.zones = spark.createDataFrame(zones, "locationid int, borough string, zone string, service_zone string")

    def load(self, month, trips):
        path = ingest.month_path(self.source, month)
        df = self.spark.createDataFrame(trips, SCHEMA)
        df.coalesce(1).write.mode("overwrite").parquet(path)
        increments.load_months(self.spark, self.source, [month], self.raw)

    def refresh(self):
        return increments.refresh_gold(self.spark, self.raw, self.zones, self.gold)

    def fact(self):
        return increments.read_fact(self.spark, self.gold)

    def ids(self):
        found = self.fact().select("load_month", "trip_id", "pickup_date_sk")
        return rows(found)

    def files(self, month):
        path = increments.partition_path(f"{self.gold}/fct_trips", month, increments.MONTH)
        return file_states(self.spark, path)


@pytest.fixture(scope="module")
def spark_layers(spark):
    layers = Layers(spark)
    layers.load(FEB, [trip((2, 3), 1), trip((2, 1), 2)])
    layers.load(MAR, [trip((3, 9), 3)])
    layers.refresh()
    return layers


def test_refreshes_touch_changed_months_only(spark, spark_layers):
    """One history: an earlier month, a smaller one, a larger one, one that goes, nothing at all."""
    layers = spark_layers
    assert layers.ids() == [(2, 1, 1), (2, 2, 2), (3, 3, 3)]
    march = layers.files(MAR)

    layers.load(JAN, [trip((1, 5), 1)])
    assert layers.refresh()[1:3] == ([JAN], [])
    assert layers.ids() == [(1, 4, 4), (2, 1, 1), (2, 2, 2), (3, 3, 3)]

    layers.load(FEB, [trip((2, 1), 2)])  # fewer trips: the month keeps its ids
    assert layers.refresh()[1:3] == ([FEB], [])
    assert layers.ids() == [(1, 4, 4), (2, 1, 1), (3, 3, 3)]

    layers.load(FEB, [trip((2, 1), m) for m in (5, 6, 7)])  # more than it holds: new ids
    assert layers.refresh()[1:3] == ([FEB], [])
    assert layers.ids() == [(1, 4, 4), (2, 5, 1), (2, 6, 1), (2, 7, 1), (3, 3, 3)]

    done = layers.refresh()
    assert (done.build, done.rebuilt, done.removed, done.star) == (4, [], [], None)
    layers.load(FEB, [trip((2, 1), m) for m in (7, 5, 6)])  # the same rows, in another order
    assert layers.refresh().build == 4

    layers.load(JAN, [])
    assert layers.refresh()[1:3] == ([], [JAN])
    assert {r[0] for r in layers.ids()} == {2, 3}
    assert layers.files(MAR) == march


def test_only_the_files_of_a_changed_month_are_read(spark, spark_layers):
    trips = increments.staged_months(spark, spark_layers.raw, [MAR], ())
    plan = trips._jdf.queryExecution().executedPlan().toString()
    [filters] = [line for line in plan.splitlines() if "PartitionFilters" in line]
    filters = filters.split("PartitionFilters: [")[1].split("]")[0]
    assert all(f"LOAD_{c}" in filters for c in ("SERVICE_TYPE", "YEAR", "MONTH"))
    raw = increments.read_raw(spark, spark_layers.raw).where(
        increments.months_in([MAR], ingest.MONTH_PARTITIONS)
    )
    files = raw.select("_metadata.file_path").distinct().collect()
    assert {f.file_path.split("LOAD_MONTH=")[1].split("/")[0] for f in files} == {"3"}


def test_a_refresh_that_failed_before_its_ledger_is_done_again_alike(spark):
    layers = Layers(spark)
    layers.load(FEB, [trip((2, 3), 1), trip((2, 1), 2)])
    layers.refresh()
    before = layers.ids()
    remove_path(spark, f"{layers.gold}/ledger/build=1/_SUCCESS")
    assert layers.refresh().build == 1
    assert layers.ids() == before


# ---------------------------------------------------------------- states


def test_states_of_refreshed_months_give_the_direct_answers(spark):
    layers = Layers(spark)
    layers.load(JAN, [trip((1, 5), m, total=0.1 * m) for m in range(9)])
    layers.load(FEB, [trip((2, 3), 1, total=0.3), trip((2, 3), 2, zone=9)])
    states.refresh_states(spark, layers.raw, layers.gold, layers.refresh())
    layers.load(FEB, [trip((2, 3), m, total=0.7 * m) for m in range(5)])
    states.refresh_states(spark, layers.raw, layers.gold, layers.refresh())
    fact, star = layers.fact(), increments.read_star(spark, layers.gold, layers.zones)

    def kept(name, months=None):
        return states.read_state(spark, layers.gold, name, months)

    revenue = rows(states.revenue_tips_by_borough(kept("borough_revenue")))
    assert revenue == rows(states.exact_revenue_tips(fact.repartition(7), star))
    direct = {r[:3]: r[3] for r in rows(marts.revenue_tips_by_borough(fact, star))}
    assert {r[:3]: pytest.approx(r[3]) for r in revenue} == direct
    assert rows(states.top_zones_by_month(kept("zone_trips"))) == rows(marts.top_zones_by_month(fact, star))
    assert rows(states.duration_percentiles(kept("zone_minutes"))) == rows(
        marts.duration_percentiles(fact, star)
    )
    january = states.top_zones_by_month(kept("zone_trips", [JAN]))
    assert [r.num_trips for r in january.collect()] == [9]


def test_a_bound_counts_midnight_of_the_last_day_only(spark):
    times = [datetime(2019, 1, 30, 23, 5), datetime(2019, 1, 31), datetime(2019, 1, 31, 0, 0, 1)]
    trips = spark.createDataFrame(
        [(t, t.date(), "yellow", "yellow", 2019, 1) for t in times],
        "pickup_datetime timestamp_ntz, pickup_date date, service_type string, "
        "load_service_type string, load_year int, load_month int",
    )
    state = states.STATES["hourly_trips"]
    merged = state.merged(state.of(states.hourly_rows(trips)))
    assert rows(states.temporal_demand(merged)) == rows(marts.temporal_demand(trips))
    assert rows(states.temporal_demand(merged).select("pickup_date", "num_trips")) == [
        (date(2019, 1, 30), 1),
        (date(2019, 1, 31), 1),
    ]


# ---------------------------------------------------------------- exact sums


def exact(df, name="v"):
    return df.agg(*sum_parts(F.col(name), name)).select(total(name).alias("t")).first()["t"]


def test_exact_sums_do_not_depend_on_order(spark):
    draw = random.Random(5)
    values = [draw.uniform(-1e6, 1e6) for _ in range(3000)] + [1e15, -1e15, 0.1, None, -0.0]
    sums = set()
    for n in (1, 3, 8):
        draw.shuffle(values)
        sums.add(exact(spark.createDataFrame([(v,) for v in values], "v double").repartition(n)))
    assert len(sums) == 1
    assert sums.pop() == pytest.approx(math.fsum(v for v in values if v is not None), abs=1e-8)


@pytest.mark.parametrize(
    ("values", "want"),
    [
        ([], None),
        ([None], None),
        ([0.1] * 10, 1.0),
        ([-0.5, 0.25], -0.25),
        ([1.0, float("inf")], float("inf")),
        ([1e300, 1.0], float("inf")),
        ([-1e300], float("-inf")),
        ([2.0**61] * 8, None),
        ([2.0**60, 1.0], 2.0**60),
    ],
)
def test_exact_sums_of_odd_values(spark, values, want):
    got = exact(spark.createDataFrame([(v,) for v in values], "v double"))
    assert got == (pytest.approx(want, abs=1e-11) if want is not None else None)


def test_parts_add_up(spark):
    df = spark.createDataFrame([(i % 3, i / 7) for i in range(100)], "k int, v double")
    parts = df.groupBy("k").agg(*sum_parts(F.col("v"), "v"))
    merged = parts.agg(*merged_parts("v")).select(total("v").alias("t")).first()["t"]
    assert merged == exact(df)
