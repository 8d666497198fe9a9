from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from registry import queries as q
from tripmart.operators import quality
from tripmart.plans import gold, marts, silver
from tripmart.plans.suite import declared_checks
from tripmart.plans import suite
from tripmart.session import Kept, keep, new_path
from tripmart.sources.tables import service_bronze

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def bronze_row(spark, **values):
    """One yellow raw row; times as ISO texts."""
    row = {
        "tpep_pickup_datetime": "2019-01-05 10:00:00",
        "tpep_dropoff_datetime": "2019-01-05 10:30:00",
        "passenger_count": 1.0,
        "trip_distance": 5.0,
        "ratecodeid": 1.0,
        "store_and_fwd_flag": "N",
        "pulocationid": 4,
        "dolocationid": 5,
        "payment_type": 1,
        "vendorid": 2,
        "fare_amount": 10.0,
        "extra": 0.0,
        "mta_tax": 0.5,
        "tip_amount": 2.0,
        "tolls_amount": 0.0,
        "improvement_surcharge": 0.3,
        "total_amount": 12.8,
        "congestion_surcharge": 2.5,
        "airport_fee": 0.0,
        "load_year": 2019,
        "load_month": 1,
        "load_service_type": "yellow",
    } | values
    kinds = {"store_and_fwd_flag": "string", "load_service_type": "string"}
    kinds |= dict.fromkeys(
        ["pulocationid", "dolocationid", "payment_type", "vendorid", "load_year", "load_month"],
        "bigint",
    )
    kinds |= {c: "string" for c in row if c.endswith("_datetime")}
    schema = ", ".join(f"{c} {kinds.get(c, 'double')}" for c in row)
    df = spark.createDataFrame([tuple(row.values())], schema)
    return df.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in df.columns if c.endswith("_datetime")}
    )


def staged(spark, *changes, **options):
    parts = [silver.stage_trips(bronze_row(spark, **c), "yellow", **options) for c in changes]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# ---------------------------------------------------------------- silver


def test_staging_types_and_order(spark):
    trips = staged(spark, {"passenger_count": 2.7})
    assert tuple(trips.columns) == silver.STAGED_COLUMNS
    row = trips.first()
    assert row.passenger_count == 3 and row.service_type == "yellow"
    assert row.pickup_datetime == datetime(2019, 1, 5, 10, 0)
    money = silver.stage_trips(bronze_row(spark), "yellow", money="decimal")
    assert money.schema["total_amount"].dataType.simpleString() == "decimal(10,2)"
    assert money.schema["trip_distance"].dataType.simpleString() == "double"


def test_staging_drops_rows_without_times(spark):
    trips = staged(spark, {"tpep_dropoff_datetime": None}, {"tpep_pickup_datetime": None}, {})
    assert trips.count() == 1


def test_green_has_a_typed_null_airport_fee(spark):
    green = service_bronze(q.raw_trips(spark, FOLDER), "green")
    assert "airport_fee" not in green.columns
    trips = silver.stage_trips(green, "green")
    assert trips.schema["airport_fee"].dataType.simpleString() == "double"
    assert trips.where("airport_fee IS NOT NULL").count() == 0


def test_staging_is_zone_free(spark, zone):
    trips = silver.stage_trips(
        service_bronze(q.raw_trips(spark, FOLDER), "yellow"),
        "yellow",
        extras=(silver.DURATION, *silver.MINUTES),
    )
    parts = "hour(pickup_datetime) * 60 + minute(pickup_datetime)"
    wrong = trips.where(
        f"pickup_date <> to_date(pickup_datetime) OR pickup_minute <> {parts}"
        " OR pickup_minute NOT BETWEEN 0 AND 1439"
    )
    assert wrong.count() == 0
    again = silver.minute_diff(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    assert trips.where(F.col(silver.DURATION) != again).count() == 0


def test_cleaning_rejects_broken_rules_only(spark):
    trips = staged(
        spark,
        {},
        {"trip_distance": 0.0},
        {"fare_amount": -1.0},
        {"tpep_dropoff_datetime": "2019-01-05 10:00:30"},  # no minute boundary
        {"tpep_dropoff_datetime": "2019-01-05 13:01:00"},  # 181 minutes
        {"trip_distance": 50.0},  # 100 mph
        {"trip_distance": None},
    )
    assert silver.clean_trips(trips).count() == 2
    assert dict(rows(silver.clean_report(trips))) == {
        "trip_distance": 1,
        "fare_amount": 1,
        "duration": 2,
        "speed": 1,
        "kept": 2,
    }


def test_dedupe_keeps_one_trip_per_vendor_and_times(spark):
    trips = staged(
        spark, {}, {"fare_amount": 9.0}, {"vendorid": 1}, {"vendorid": None}, extras=["vendor_id"]
    )
    left = silver.dedupe_trips(trips)
    assert sorted(r.vendor_id or 0 for r in left.collect()) == [0, 1, 2]
    assert left.where("vendor_id = 2").first().fare_amount == 9.0


def test_zones_are_distinct_and_keyed(spark):
    bronze = spark.createDataFrame(
        [(1, "EWR", "newark airport", "ewr"), (1, "EWR", "newark airport", "ewr"),
         (None, "x", "y", "z"), (264, None, "n/a", "N/A")],
        "locationid bigint, borough string, zone string, service_zone string",
    )
    assert rows(silver.stage_zones(bronze)) == sorted(
        [(1, "Ewr", "Newark Airport", "Ewr"), (264, None, "N/A", "N/A")], key=repr
    )


# ---------------------------------------------------------------- gold


def test_dates_outside_the_calendar_have_no_key(spark):
    trips = staged(
        spark,
        {},
        {"tpep_pickup_datetime": "2014-12-31 23:59:00", "tpep_dropoff_datetime": "2015-01-01 00:05:00"},
        {"tpep_pickup_datetime": "2088-01-01 00:00:00", "tpep_dropoff_datetime": "2088-01-01 00:05:00"},
    )
    zones = spark.createDataFrame(
        [(4, "a", "b", "c")], "locationid int, borough string, zone string, service_zone string"
    )
    star = gold.build_star(trips, zones)
    assert [str(r.date_value) for r in star.dim_date.df.orderBy("date_sk").collect()] == [
        "2015-01-01",
        "2019-01-05",
    ]
    fact = gold.fct_trips(trips, star, keys=["pickup_date", "dropoff_date", "pickup_zone", "dropoff_zone"])
    got = sorted((r.pickup_date_sk, r.dropoff_date_sk) for r in fact.where("pickup_date_sk = 2").collect())
    assert got == [(2, 2)]
    assert fact.where("pickup_date_sk IS NULL AND dropoff_date_sk = 1").count() == 1
    assert fact.where("dropoff_zone_sk IS NULL").count() == 3  # zone 5 is unknown
    assert fact.where("trip_duration_min = 6").count() == 1


def test_code_labels(spark):
    members = spark.createDataFrame(
        [("payment_type", c) for c in (0, 1, 6, 7)] + [("ratecode", c) for c in (1, 6, 99)],
        "role string, member int",
    )
    assert dict(rows(gold.dim_payment_type(members))) == {
        0: "Other", 1: "Credit card", 6: "Voided trip", 7: "Other"
    }
    assert dict(rows(gold.dim_ratecode(members))) == {
        1: "Standard rate", 6: "Group ride", 99: "Unknown"
    }


def test_fact_joins_broadcast_checked_dimensions_only(spark):
    fact, star = q._fact_and_star(spark, FOLDER, "pickup_date", "pickup_zone")
    plan = plan_of(fact)
    assert plan.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan
    trips = q._trips(spark, FOLDER, silver.DURATION)
    big = star._replace(dim_zone=Kept(star.dim_zone.df, 10**9, star.dim_zone.path))
    unhinted = gold.fct_trips(trips, big, ["pickup_zone"])._jdf.queryExecution().optimizedPlan()
    assert "strategy=broadcast" not in unhinted.toString()


def test_marts_never_gather_trips_in_one_task(spark):
    fact, star = q._fact_and_star(spark, FOLDER, "pickup_date", "pickup_zone")
    fact = keep(fact, "test-fact").df
    plain = star._replace(dim_date=keep(star.dim_date.df, "test-dates"))
    for mart in (
        marts.top_zones_by_month(fact, plain),
        marts.revenue_tips_by_borough(fact, plain),
        marts.average_speed(fact, plain),
        marts.duration_percentiles(fact, plain, None),
    ):
        assert "SinglePartition" not in plan_of(mart)


def files_with(df, condition):
    """Files of a table that hold rows of a condition."""
    return df.where(condition).select(F.col("_metadata.file_path")).distinct().count()


def test_clustering_gathers_a_day_in_few_files(spark):
    """Fails on a table in the order of arrival, as the second half shows."""
    fact, _, _ = q._full_fact(spark, "/root/testdata/sf0.01")
    fact = keep(fact, "test-fact").df.where("service_type = 'green'")
    dated = fact.where("pickup_date_sk IS NOT NULL")
    day = dated.groupBy("pickup_date_sk").count().orderBy(F.desc("count")).first()[0]
    path = new_path(spark, "test-clustered")
    gold.cluster_fact(fact, path, 8)
    clustered = spark.read.parquet(path)
    plain = new_path(spark, "test-unclustered")
    fact.repartition(8).write.parquet(plain)
    arrival = spark.read.parquet(plain)
    where = F.col("pickup_date_sk") == day
    assert clustered.count() == arrival.count()
    assert files_with(clustered, where) <= 2 < files_with(arrival, where)
    plan = plan_of(clustered.where(where))
    assert "EqualTo(pickup_date_sk," in plan


# ---------------------------------------------------------------- marts


def star_of(spark, dates=(), zones=()):
    return gold.Star(
        dim_date=keep(spark.createDataFrame(
            list(dates), "date_sk int, date_value date, year int, month int"), "test-dates"),
        dim_zone=keep(spark.createDataFrame(
            list(zones), "zone_sk int, zone_name string, borough string"), "test-zones"),
    )


FACT = """pickup_date_sk int, pickup_zone_sk int, service_type string, trip_duration_min bigint,
trip_distance double, fare_amount double, tip_amount double, total_amount double"""


def test_percentiles_interpolate_and_sort_unknown_months_last(spark):
    star = star_of(spark, [(1, date(2019, 1, 1), 2019, 1)], [(1, "A", "X"), (2, "B", "X")])
    minutes = [(1, 1, m) for m in (1, 2, 3, 10, 180)] + [(1, 1, 0), (1, 1, 181)]
    minutes += [(None, 2, 50), (1, None, 7)]
    fact = spark.createDataFrame(
        [(d, z, "yellow", m, 1.0, 1.0, 0.0, 1.0) for d, z, m in minutes], FACT
    )
    got = [tuple(r) for r in marts.duration_percentiles(fact, star).collect()]
    assert got == [
        (2019, 1, "A", "yellow", 3.0, pytest.approx(112.0)),
        (2019, 1, None, "yellow", 7.0, 7.0),
        (None, None, "B", "yellow", 50.0, 50.0),
    ]
    summary = marts.duration_zone_summary(marts.duration_percentiles(fact, star))
    assert [r.pickup_zone for r in summary.collect()] == ["A", "B"]
    assert marts.duration_long(summary).count() == 4


def test_demand_ends_at_midnight_of_the_last_day(spark):
    trips = staged(
        spark,
        {"tpep_pickup_datetime": "2019-01-31 00:00:00"},
        {"tpep_pickup_datetime": "2019-01-31 10:00:00"},
        {"tpep_pickup_datetime": "2019-01-07 10:00:00"},
    )
    demand = marts.temporal_demand(trips)
    assert sorted((str(r.pickup_date), r.day_number, r.day_name) for r in demand.collect()) == [
        ("2019-01-07", 1, "MONDAY"),
        ("2019-01-31", 4, "THURSDAY"),
    ]
    heat = marts.weekday_hour_heatmap(demand)
    assert heat.columns == ["pickup_hour", *marts.WEEKDAYS.values()]
    assert heat.where("pickup_hour = 10").first()["MONDAY"] == 1


def test_vendor_fanout_triples_sums_but_not_shares(spark):
    once = {r[:3]: r[3:] for r in rows(q.q2_revenue_tips(spark, FOLDER))}
    thrice = {r[:3]: r[3:] for r in rows(q.q2_revenue_tips_vendor_fanout(spark, FOLDER))}
    assert once.keys() == thrice.keys()
    for key, (revenue, tips) in once.items():
        assert thrice[key] == (pytest.approx(3 * revenue), pytest.approx(tips, abs=2e-6))


# ---------------------------------------------------------------- checks


def test_checks_find_what_is_wrong(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (1, 6), (2, None)], "id int, fk int")
    parent = spark.createDataFrame([(5,)], "k int")
    found = quality.union_results(
        [
            quality.check_not_null(df, "t", ["id", "fk"]),
            quality.check_unique(df, "t", ["id"]),
            quality.check_unique(df, "t", ["id", "fk"]),
            quality.check_relationships(df, "t", {"fk": (parent, "k")}),
            quality.check_accepted_values(df, "t", {"fk": [5]}),
            quality.check_accepted_values(df, "t", {"fk": [5, 6]}),
            quality.check_range(df, "t", "fk", F.col("fk") > 5),
        ]
    )
    assert [(r["check"], r["column"], r.n_failing, r.status) for r in found.collect()] == [
        ("not_null", "id", 1, "fail"),
        ("not_null", "fk", 1, "fail"),
        ("unique", "id", 1, "fail"),
        ("unique", "id, fk", 0, "pass"),
        ("relationships", "fk", 1, "fail"),
        ("accepted_values", "fk", 1, "fail"),
        ("accepted_values", "fk", 0, "pass"),
        ("range", "fk", 1, "fail"),
    ]


def test_counts_equal_the_failing_rows(spark):
    fact, star, trips = q._full_fact(spark, FOLDER)
    assert quality.failing_unique(fact, ["trip_id"]).count() == (
        quality.check_unique(fact, "f", ["trip_id"]).first().n_failing
    )
    zones = star.dim_zone.df
    orphans = quality.failing_relationships(trips, "dropoff_location_id", zones, "zone_sk")
    counted = quality.check_relationships(
        trips, "t", {"dropoff_location_id": (zones, "zone_sk")}
    ).first()
    assert 0 < orphans.count() == counted.n_failing
    assert quality.failing_not_null(fact, "pickup_date_sk").count() > 0
    assert quality.failing_accepted_values(trips, "payment_type", [1, 2]).count() == 5


def test_declared_suite_has_nineteen_checks(spark):
    fact, star, _ = q._full_fact(spark, FOLDER)
    by_kind = declared_checks(fact, star).groupBy("check").count()
    assert dict(rows(by_kind)) == {"not_null": 7, "unique": 6, "relationships": 6}


def test_gold_tables_and_checks_on_them(spark):
    fact, star = q.gold_tables(spark, FOLDER)
    assert q.gold_tables(spark, FOLDER)[0] is fact
    folder = fact.inputFiles()[0].split("/fct_trips/")[0]
    tables = gold.read_gold(spark, folder)
    assert tables["fct_trips"].count() == fact.count() > 0
    assert rows(tables["dim_vendor"]) == rows(gold.dim_vendor(spark))
    for name in ("dim_date", "dim_zone", "dim_payment_type", "dim_ratecode"):
        assert tables[name].count() == getattr(star, name).df.count() > 0
    plan = plan_of(quality.check_unique(fact, "fct_trips", ["trip_id"]))
    assert "Join" not in plan
    plan = plan_of(q.check_accepted_values(spark, FOLDER))
    assert plan.count("FileScan parquet") <= 2  # one for each service


def test_failing_rows_of_every_check_are_stored(spark):
    fact, star = q.gold_tables(spark, FOLDER)
    paths = suite.store_failures(fact, star, new_path(spark, "failures"))
    assert len(paths) == 20
    stored = {name: spark.read.parquet(path).count() for name, path in paths.items()}
    wanted = {
        f"{r['check']}_{r['table']}_{r['column']}": r.n_failing
        for r in declared_checks(fact, star).collect()
    }
    assert wanted == {k: v for k, v in stored.items() if k != "range_fct_trips"}
    assert stored["range_fct_trips"] == fact.where(suite.range_violation()).count() > 0


def test_release_removes_what_was_kept(spark):
    from tripmart.session import release, remove_path

    path = keep(spark.range(3).toDF("id"), "test-release").path
    assert spark.read.parquet(path).count() == 3
    assert remove_path(spark, path) and not remove_path(spark, path)
    assert callable(release)


def test_trips_of_two_services_are_no_copies(spark):
    yellow = staged(spark, {}, {}, extras=["vendor_id"])
    green = yellow.withColumn("service_type", F.lit("green"))
    assert silver.dedupe_trips(yellow.unionByName(green)).count() == 2


def test_starter_rows_fail_not_null_by_design(spark):
    rows_ = spark.createDataFrame([(1,), (None,)], "id int")
    assert quality.check_not_null(rows_, "starter", ["id"]).first().status == "fail"
    assert quality.check_not_null(rows_.where("id = 1"), "starter", ["id"]).first().status == "pass"
