"""Operators over whole tables: row checks, key history, percentiles by selection, layout, coverage."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import queries as q
from tripmart.operators import interleave, row_checks
from tripmart.operators.history import KeyHistory
from tripmart.operators.selection import exact_percentiles
from tripmart.plans import gold, suite
from tripmart.session import keep, new_path
from tripmart.sources import ingest, sinks
from tripmart.sources.ingest import Month, Outcome

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- row checks


def test_every_broken_rule_is_counted_and_stored(spark):
    df = spark.createDataFrame(
        [(1, "a", 5.0), (None, "b", -1.0), (7, None, None), (None, "z", -2.0)],
        "k int, code string, amount double",
    )
    parent = keep(spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int"), "test-parent")
    rules = [
        row_checks.not_null("k"),
        row_checks.related("k", parent, "id"),
        row_checks.accepted("code", ["a", "b"]),
        row_checks.in_range("amount", F.col("amount") < 0),
        row_checks.not_null("code"),
    ]
    path = new_path(spark, "test-failures")
    got = row_checks.check_rows(df, "t", rules, path)
    assert [tuple(r) for r in got.collect()] == [
        ("not_null", "t", "k", 2, "fail"),
        ("relationships", "t", "k", 1, "fail"),
        ("accepted_values", "t", "code", 1, "fail"),
        ("range", "t", "amount", 2, "fail"),
        ("not_null", "t", "code", 1, "fail"),
    ]
    stored = row_checks.stored_failures(df, path)
    assert rows(stored.groupBy("check_name").count()) == [
        ("accepted_values_code", 1),
        ("not_null_code", 1),
        ("not_null_k", 2),
        ("range_amount", 2),
        ("relationships_k", 1),
    ]
    assert rows(stored.where("check_name = 'relationships_k'").drop("check_name")) == [(7, None, None)]


def test_nothing_broken_stores_nothing(spark):
    df = spark.createDataFrame([(1,)], "k int")
    path = new_path(spark, "test-failures")
    [row] = row_checks.check_rows(df, "t", [row_checks.not_null("k")], path).collect()
    assert (row.n_failing, row.status) == (0, "pass")
    assert row_checks.stored_failures(df, path).count() == 0
    [row] = row_checks.check_rows(df.limit(0), "t", [row_checks.not_null("k")], path).collect()
    assert row.n_failing == 0


def test_all_checks_scan_the_fact_once_and_shuffle_no_row_of_it(spark):
    fact, star = q.gold_tables(spark, FOLDER)
    plan = plan_of(row_checks.marked(fact, suite.fact_rules(star)).where("__broken <> 0"))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert sum("trip_duration_min" in line for line in scans) == 1
    # Shuffles serve the keys of the dimensions alone: all joins broadcast, no row of the fact moves.
    assert plan.count("BroadcastHashJoin") == 6
    assert "SortMergeJoin" not in plan


# ---------------------------------------------------------------- key history

SLICED = "k int, code string, day int, v int"


def history(spark):
    return KeyHistory(spark, ["k", "code", "day"], F.floor(F.col("day") / 10).cast("int"), buckets=4)


def test_a_copy_in_a_later_load_goes(spark):
    past = history(spark)
    try:
        one = past.add(spark.createDataFrame([(1, "a", 5, 2), (1, "a", 5, 1), (2, None, 5, 7)], SLICED))
        two = past.add(
            spark.createDataFrame(
                [(1, "a", 5, 0), (2, None, 5, 0), (None, "2", 5, 3), (1, "a", 15, 0), (3, "c", None, 1)],
                SLICED,
            )
        )
        three = past.add(spark.createDataFrame([(3, "c", None, 9), (1, "a", 15, 9), (None, "2", 5, 9)], SLICED))
        assert rows(one) == [(1, "a", 5, 1), (2, None, 5, 7)]
        assert rows(two) == [(1, "a", 15, 0), (3, "c", None, 1), (None, "2", 5, 3)]
        assert rows(three) == []
        assert rows(past.add(spark.createDataFrame([], SLICED))) == []
    finally:
        past.drop()


def test_history_is_read_in_place_and_by_slice(spark):
    """No Exchange lies over the history's scan, and slices the batch doesn't need are pruned."""
    past = history(spark)
    try:
        past.add(spark.createDataFrame([(i, "a", i, 0) for i in range(40)], SLICED))
        batch = keep(past._hashed(spark.createDataFrame([(1, "a", 5, 0)], SLICED)), "test-batch").df
        before = spark.conf.get("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            lines = plan_of(past.unseen(batch)).splitlines()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", before)
        [scan] = [i for i, line in enumerate(lines) if past.table in line]
        join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
        right = [
            line
            for i, line in enumerate(lines[join + 1 : scan + 1])
            if line.index("- " if "- " in line else line.strip()[0]) >= 0
        ]
        exchanges = [line for line in right if "Exchange" in line]
        assert len(exchanges) == 1  # the batch's
        assert "Bucketed: true" in lines[scan]
        assert "__slice" in lines[scan].split("PartitionFilters")[1]
    finally:
        past.drop()


# ---------------------------------------------------------------- percentiles by selection


def by_definition(values, share):
    known = sorted(v for v in values if v is not None and v == v and abs(v) != float("inf"))
    place = share * (len(known) - 1)
    low, high = known[int(place)], known[-int(-place // 1) if place % 1 else int(place)]
    return low if low == high else low * (1 - place % 1) + high * (place % 1)


def check_percentiles(spark, data, bins, shares=(0.0, 0.1, 0.5, 0.9, 1.0), n=4):
    df = spark.createDataFrame(data, "g string, v double").repartition(n)
    got = {(r.g, r.share): r.percentile for r in exact_percentiles(df, ["g"], "v", shares, bins).collect()}
    groups = {}
    for g, v in data:
        if v is not None and v == v and abs(v) != float("inf"):
            groups.setdefault(g, []).append(v)
    want = {(g, s): by_definition(vs, s) for g, vs in groups.items() for s in shares}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-12, abs=1e-12) for k in want)


def test_percentiles_of_a_hot_group_and_odd_values(spark):
    draw = random.Random(2)
    data = [("hot", draw.gauss(0, 1e3)) for _ in range(2000)]
    data += [("tied", 5.0)] * 300 + [("tied", 7.0)] * 301
    data += [(None, 1.5), (None, 2.5), ("one", -3.0), ("none", None), ("none", float("nan"))]
    data += [("wide", v) for v in (-1.7e308, 1.7e308, 0.0, 5e-324, 1e-300, float("inf"), None)]
    check_percentiles(spark, data, 16)


def test_percentiles_of_skewed_values_end(spark):
    check_percentiles(spark, [("g", 2.0**-i) for i in range(0, 1000, 9)], 4, (0.25, 0.5))


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert exact_percentiles(df, ["g"], "v", (0.5,)).collect() == []


# ---------------------------------------------------------------- layout


def test_bits_are_dealt_out_in_turn(spark):
    df = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)] + [(None, None)], "a int, b int")
    bounds = {"a": [1, 2, 3], "b": [1, 2, 3]}
    got = {(r.a, r.b): r.key for r in df.withColumn("key", interleave.interleaved(bounds, 2)).collect()}
    assert got.pop((None, None)) == 0
    for (a, b), key in got.items():
        assert key == (a >> 1 & 1) << 3 | (b >> 1 & 1) << 2 | (a & 1) << 1 | b & 1


def test_ranks_follow_the_rows_not_the_values(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 500, 7).otherwise(F.col("id") ** 3).cast("long").alias("x"))
    bounds = interleave.rank_bounds(df, ["x"], 3)
    counts = df.groupBy(interleave.interleaved(bounds, 3).alias("r")).count().collect()
    assert max(r["count"] for r in counts) < 700  # the hot value, and one part beside it
    assert len(counts) >= 4
    assert interleave.rank_bounds(df.limit(0), ["x"], 3) == {"x": []}


def test_interleaving_skips_files_for_every_key(spark):
    """Date order reads most files for a zone; the interleaved layout reads few for either key."""
    fact, _ = q.gold_tables(spark, "/root/testdata/sf0.01")
    fact = fact.where("service_type = 'green' AND pickup_date_sk IS NOT NULL")
    keys = list(gold.INTERLEAVED_KEYS)
    sorted_by_date = gold.cluster_fact(fact, new_path(spark, "test-clustered"), 64)
    woven = gold.interleave_fact(fact, new_path(spark, "test-interleaved"), 64)
    assert rows(woven.select("trip_id")) == rows(fact.select("trip_id"))
    day, zone = {"pickup_date_sk": (700, 710)}, {"pickup_zone_sk": (40, 41)}
    read = {
        (name, tuple(wanted)): interleave.read_for(interleave.file_ranges(table, keys), wanted).first()
        for name, table in (("sorted", sorted_by_date), ("woven", woven))
        for wanted in (day, zone, day | zone)
    }
    files = {k: r.files_read / r.files for k, r in read.items()}
    assert files["sorted", ("pickup_date_sk",)] < 0.1
    assert files["woven", ("pickup_zone_sk",)] < 0.5 < 0.9 < files["sorted", ("pickup_zone_sk",)]
    assert files["woven", ("pickup_date_sk",)] < 0.35
    assert files["woven", ("pickup_date_sk", "pickup_zone_sk")] < 0.1


# ---------------------------------------------------------------- coverage, views


def test_runs_of_months(spark):
    def months(service, *numbers):
        return [Month(service, 2018 + (n - 1) // 12, (n - 1) % 12 + 1) for n in numbers]

    outcomes = [Outcome(m, True, "OK", rows=1) for m in months("yellow", 11, 12, 13, 16)]
    outcomes += [Outcome(m, False, "ERROR") for m in months("yellow", 14, 15)]
    outcomes += [Outcome(m, True, "OK", rows=0) for m in months("green", 3, 5)]
    path = new_path(spark, "test-coverage")
    ingest.log_coverage(spark, outcomes, path)
    runs = ingest.coverage_runs(ingest.coverage_matrix(spark.read.parquet(path)))
    assert [tuple(r) for r in runs.collect()] == [
        ("green", True, "2018-03", "2018-03", 1),
        ("green", True, "2018-05", "2018-05", 1),
        ("yellow", True, "2018-11", "2019-01", 3),
        ("yellow", False, "2019-02", "2019-03", 2),
        ("yellow", True, "2019-04", "2019-04", 1),
    ]


def test_a_view_computes_only_what_is_asked(spark):
    path = new_path(spark, "test-views")
    database = "views_" + path.rsplit("-", 1)[1]
    df = spark.createDataFrame([(1, "a"), (2, "b")], T._parse_datatype_string("k int, s string"))
    sinks.publish({"raw": df}, database, path)
    sinks.publish_views(
        spark, database, {"doubled": "SELECT k * 2 AS k, s FROM {db}.raw", "big": "SELECT k FROM {db}.doubled WHERE k > 2"}
    )
    found = spark.table(f"{database}.big")
    assert rows(found) == [(4,)]
    assert "ReadSchema: struct<k:int>" in plan_of(found)
    spark.sql(f"DROP DATABASE {database} CASCADE")
