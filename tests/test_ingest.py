import os
from urllib.parse import urlparse

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators import conform
from tripmart.session import new_path
from tripmart.sources import ingest, sinks
from tripmart.sources.ingest import Month
from tripmart.streaming.months import stream_backfill


def put_month(spark, source, month, data, schema="VendorID int, `airport fee` double"):
    df = spark.createDataFrame(data, schema)
    df.coalesce(1).write.mode("overwrite").parquet(ingest.month_path(source, month))


JAN, FEB, MAR = (Month("yellow", 2019, m) for m in (1, 2, 3))


def test_names_are_normalised_and_the_first_of_equals_stays(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["Pick-up", "pick_up", "Ehail_Fee", "x"])
    named = conform.normalise_columns(df)
    assert named.columns == ["PICK_UP", "EHAIL_FEE", "X"]
    assert named.first()[0] == 1
    same_case = df.toDF("a", "A", "", "b.c")
    assert conform.normalise_columns(same_case).columns == ["A", "B_C"]
    assert conform.conform_batch(df).columns == ["PICK_UP", "X"]
    assert conform.conform_batch(df, target=["x"]).columns == ["X"]


def test_date_columns_convert_all_or_nothing(spark, zone):
    df = spark.createDataFrame(
        [("2019-03-10 02:30:00", "2019-01-01", 1_552_185_005_000_000_000, "2019-01-01", True),
         (None, "soon", None, "x", False)],
        "good_date string, bad_date string, ns_datetime bigint, other string, update_flag boolean",
    )
    out = conform.coerce_datetime_columns(df)
    assert [f.dataType.simpleString() for f in out.schema] == [
        "timestamp_ntz", "string", "timestamp_ntz", "string", "boolean"
    ]
    first = out.first()
    assert str(first.good_date) == "2019-03-10 02:30:00"
    assert str(first.ns_datetime) == "2019-03-10 02:30:05"


def test_control_columns_are_filled_where_the_year_is_missing(spark):
    df = spark.createDataFrame([(1, 2018, 5), (2, None, 6), (3, None, None)],
                               "id int, LOAD_YEAR int, LOAD_MONTH int")
    out = conform.backfill_control_columns(df, "green", 2019, 1)
    assert rows(out) == [(1, 2018, 5, None), (2, 2019, 1, "green"), (3, 2019, 1, "green")]
    bare = conform.backfill_control_columns(df.select("id"), "green", 2019, 1)
    assert rows(bare)[0] == (1, 2019, 1, "green")


@pytest.fixture
def loaded(spark):
    """Three months: January fine, February missing, March unreadable."""
    source, target = new_path(spark, "test-source"), new_path(spark, "test-bronze")
    put_month(spark, source, JAN, [(1, 0.5), (2, None)])
    path = ingest.month_path(source, MAR)
    spark.createDataFrame([("not parquet",)], "v string").coalesce(1).write.text(path)
    outcomes = ingest.backfill_months(spark, source, [JAN, FEB, MAR], target)
    return source, target, outcomes


def test_a_broken_month_spoils_no_other(spark, loaded):
    source, target, outcomes = loaded
    assert [(o.month, o.file_exists, o.load_status) for o in outcomes] == [
        (JAN, True, "OK"), (FEB, False, "ERROR"), (MAR, True, "ERROR"),
    ]
    assert rows(spark.read.parquet(target)) == [
        (1, 0.5, "yellow", 2019, 1), (2, None, "yellow", 2019, 1)
    ]


def test_a_missing_source_is_logged(spark):
    source, target = new_path(spark, "test-source"), new_path(spark, "test-bronze")
    [outcome] = ingest.backfill_months(spark, source, [JAN], target)
    assert (outcome.file_exists, outcome.load_status) == (False, "ERROR")


def test_loading_again_replaces_a_month(spark, loaded):
    source, target, _ = loaded
    put_month(spark, source, FEB, [(9, 9.0)])
    ingest.backfill_months(spark, source, [JAN, FEB], target)
    ingest.backfill_months(spark, source, [FEB, JAN, FEB], target)
    put_month(spark, source, JAN, [(7, 7.0)])
    ingest.backfill_months(spark, source, [JAN], target)
    assert rows(spark.read.parquet(target).select("VENDORID", "LOAD_MONTH")) == [(7, 1), (9, 2)]


def test_a_failing_job_is_retried_month_by_month(spark):
    """Both files claim one schema, but February's data file is damaged."""
    source, target = new_path(spark, "test-source"), new_path(spark, "test-bronze")
    schema = "id int, code string"
    put_month(spark, source, JAN, [(1, "a")], schema)
    put_month(spark, source, FEB, [(i, str(i)) for i in range(5000)], schema)
    folder = urlparse(ingest.month_path(source, FEB)).path  # the shared folder is a URI
    [name] = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    with open(f"{folder}/{name}", "r+b") as file:
        file.seek(4)
        file.write(b"\xff" * 4000)
    os.remove(f"{folder}/.{name}.crc")
    outcomes = ingest.backfill_months(spark, source, [JAN, FEB], target)
    assert [(o.month, o.load_status) for o in outcomes] == [(JAN, "OK"), (FEB, "ERROR")]
    assert rows(spark.read.parquet(target).select("ID", "LOAD_MONTH")) == [(1, 1)]


def test_months_of_several_schemas_and_a_frozen_table(spark):
    source, target = new_path(spark, "test-source"), new_path(spark, "test-bronze")
    put_month(spark, source, JAN, [(1, 0.5)])
    put_month(spark, source, FEB, [(2, 1)], "vendorid bigint, cbd_congestion_fee int")
    schema = T.StructType(
        [T.StructField("VENDORID", T.IntegerType()), T.StructField("AIRPORT_FEE", T.DoubleType())]
    )
    outcomes = ingest.backfill_months(spark, source, [JAN, FEB], target, schema)
    assert {o.load_status for o in outcomes} == {"OK"}
    back = spark.read.parquet(target)
    assert back.columns == ["VENDORID", "AIRPORT_FEE", *ingest.MONTH_PARTITIONS]
    assert rows(back) == [(1, 0.5, "yellow", 2019, 1), (2, None, "yellow", 2019, 2)]


def test_loading_needs_no_shuffle(spark):
    source = new_path(spark, "test-source")
    put_month(spark, source, JAN, [(1, 0.5)])
    schema = spark.read.parquet(ingest.month_path(source, JAN)).schema
    batch = ingest.ingest_months(spark, source, [JAN], schema)
    assert "Exchange" not in batch._jdf.queryExecution().executedPlan().toString()
    assert rows(batch) == rows(ingest.ingest_month(spark, source, JAN).select(*batch.columns))


def test_coverage_shows_the_latest_attempt(spark, loaded):
    source, target, outcomes = loaded
    log = new_path(spark, "test-log")
    ingest.log_coverage(spark, outcomes, log)
    put_month(spark, source, FEB, [(9, 9.0)])
    ingest.log_coverage(spark, ingest.backfill_months(spark, source, [FEB], target), log)
    matrix = ingest.coverage_matrix(spark.read.parquet(log))
    assert [tuple(r)[2:] for r in matrix.collect()] == [
        (1, True, "OK"), (2, True, "OK"), (3, True, "ERROR")
    ]
    assert spark.read.parquet(log).count() == 4


def test_zone_file_missing_texts(spark):
    path = new_path(spark, "test-zones")
    lines = ["LocationID,Borough,Zone,service_zone", "1,EWR,Newark Airport,EWR",
             "264,Unknown,N/A,N/A", "265,,Out of Town,None"]
    spark.createDataFrame([("\n".join(lines),)], "v string").coalesce(1).write.text(path)
    assert rows(ingest.ingest_zones(spark, path)) == [
        (1, "EWR", "Newark Airport", "EWR"),
        (264, "Unknown", None, None),
        (265, None, "Out of Town", None),
    ]


def test_appending_to_a_table_that_must_exist(spark):
    database = "test_" + new_path(spark, "x").rsplit("-", 1)[1]
    df = spark.createDataFrame([(1, "a")], "id int, t string")
    with pytest.raises(ValueError, match="does not exist"):
        sinks.append_existing(df, f"{database}_missing")
    assert sinks.table_columns(spark, f"{database}_missing") == []
    sinks.publish({"t": df}, database, new_path(spark, "test-db"))
    other = spark.createDataFrame([(2.0, 5)], "ID double, extra int")
    sinks.append_existing(other, f"{database}.t")
    assert sinks.table_columns(spark, f"{database}.t") == ["ID", "T"]
    assert rows(spark.table(f"{database}.t")) == [(1, "a"), (2, None)]


def test_chunks_hold_at_most_so_many_rows(spark):
    path = new_path(spark, "test-chunks")
    sinks.write_chunked(spark.range(0, 1000, 1, 2), path, rows=300)
    sizes = (
        spark.read.parquet(path).groupBy(F.input_file_name()).count().select("count").collect()
    )
    assert sum(r[0] for r in sizes) == 1000 and max(r[0] for r in sizes) <= 300


def test_stream_loads_new_months_only_and_whole(spark):
    source, target, log, state = (new_path(spark, f"test-{x}") for x in ("s", "t", "l", "c"))

    def run():
        stream_backfill(spark, source, target, log, state).awaitTermination()

    put_month(spark, source, JAN, [(1, 0.5)])
    run()
    put_month(spark, source, FEB, [(2, 1.0)])
    run()
    run()
    assert spark.read.parquet(log).count() == 2
    # January grows by a second file: the month is loaded whole again.
    more = spark.createDataFrame([(3, 3.0)], "VendorID int, `airport fee` double")
    more.coalesce(1).write.mode("append").parquet(ingest.month_path(source, JAN))
    run()
    assert rows(spark.read.parquet(target).select("VENDORID", "LOAD_MONTH")) == [
        (1, 1), (2, 2), (3, 1)
    ]


def test_months_that_differ_make_one_readable_table(spark):
    source, target = new_path(spark, "test-source"), new_path(spark, "test-bronze")
    put_month(spark, source, JAN, [(1, 2)], "VendorID int, passenger_count bigint")
    put_month(spark, source, FEB, [(2, 2.7, 1.5)],
              "VendorID bigint, passenger_count double, airport_fee double")
    outcomes = ingest.backfill_months(spark, source, [JAN, FEB], target)
    assert [(o.load_status, o.rows) for o in outcomes] == [("OK", 1), ("OK", 1)]
    back = ingest.read_raw(spark, target)
    assert back.columns[:3] == ["VENDORID", "PASSENGER_COUNT", "AIRPORT_FEE"]
    assert rows(back.select(*back.columns[:3], "LOAD_MONTH")) == [
        (1, 2.0, None, 1), (2, 2.7, 1.5, 2)
    ]
    # The table is there now: later months are fitted to it.
    put_month(spark, source, MAR, [(3.5, "x")], "VendorID double, later string")
    [outcome] = ingest.backfill_months(spark, source, [MAR], target)
    assert outcome.load_status == "OK"
    again = ingest.read_raw(spark, target)
    assert again.columns == back.columns
    assert rows(again.where("LOAD_MONTH = 3").select("VENDORID", "PASSENGER_COUNT")) == [(4, None)]


def test_a_month_reloaded_empty_loses_its_rows(spark, loaded):
    source, target, _ = loaded
    put_month(spark, source, FEB, [(9, 9.0)])
    ingest.backfill_months(spark, source, [FEB], target)
    put_month(spark, source, JAN, [])
    outcomes = ingest.backfill_months(spark, source, [JAN, FEB], target)
    assert [(o.load_status, o.rows) for o in outcomes] == [("OK", 0), ("OK", 1)]
    assert rows(ingest.read_raw(spark, target).select("VENDORID", "LOAD_MONTH")) == [(9, 2)]


def test_the_log_holds_row_counts(spark, loaded):
    _, _, outcomes = loaded
    log = new_path(spark, "test-log")
    ingest.log_coverage(spark, outcomes, log)
    assert rows(spark.read.parquet(log).select("LOAD_MONTH", "LOADED_ROWS")) == [
        (1, 2), (2, None), (3, None)
    ]


def test_fractions_round_into_whole_columns(spark):
    df = spark.createDataFrame([(2.7, "2.5", "9007199254740993"), (-2.5, "x", None)],
                               "a double, b string, c string")
    kind = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()),
                         T.StructField("c", T.LongType()), T.StructField("d", T.DateType())])
    assert rows(conform.align_to_schema(df, kind)) == [
        (-3, None, None, None), (3, 3, 9007199254740993, None)
    ]


def test_dates_of_other_shapes(spark, zone):
    texts = ["01/15/2019 10:00:00 AM", "12/31/2019 12:05:09 PM", "03/10/2019 02:30:00",
             "02/29/2020 23:59", "07/04/2021", "2019-01-01 00:00:00", None]
    good = spark.createDataFrame([(t,) for t in texts], "pickup_date string")
    assert [str(r[0]) for r in conform.coerce_datetime_columns(good).collect()] == [
        "2019-01-15 10:00:00", "2019-12-31 12:05:09", "2019-03-10 02:30:00",
        "2020-02-29 23:59:00", "2021-07-04 00:00:00", "2019-01-01 00:00:00", "None",
    ]
    for odd in ("02/30/2020", "02/29/2019", "13/01/2020", "04/31/2020", "01/15/2019 13:00:00 AM"):
        bad = spark.createDataFrame([(odd,)], "pickup_date string")
        assert conform.coerce_datetime_columns(bad).first()[0] == odd


def test_stream_tries_failed_months_again_and_sees_empty_files(spark):
    source, target, log, state = (new_path(spark, f"test-{x}") for x in ("s", "t", "l", "c"))

    def run():
        stream_backfill(spark, source, target, log, state).awaitTermination()

    put_month(spark, source, JAN, [(1, 0.5)])
    path = ingest.month_path(source, FEB)
    spark.createDataFrame([("not parquet",)], "v string").coalesce(1).write.text(path)
    put_month(spark, source, MAR, [])
    run()
    latest = ingest.latest_outcomes(spark.read.parquet(log))
    assert rows(latest.select("LOAD_MONTH", "LOAD_STATUS", "LOADED_ROWS")) == [
        (1, "OK", 1), (2, "ERROR", None), (3, "OK", 0)
    ]
    put_month(spark, source, FEB, [(2, 1.0)])
    run()
    assert ingest.failed_months(spark, log) == []
    assert rows(ingest.read_raw(spark, target).select("VENDORID", "LOAD_MONTH")) == [(1, 1), (2, 2)]


def test_the_stream_tries_again_without_new_files(spark, monkeypatch):
    source, target, log, state = (new_path(spark, f"test-{x}") for x in ("s", "t", "l", "c"))
    put_month(spark, source, JAN, [(1, 0.5)])
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "_replace_months", lambda *a: 1 / 0)
        stream_backfill(spark, source, target, log, state).awaitTermination()
    assert ingest.failed_months(spark, log) == [JAN]
    stream_backfill(spark, source, target, log, state).awaitTermination()
    assert ingest.failed_months(spark, log) == []
    assert rows(ingest.read_raw(spark, target).select("VENDORID")) == [(1,)]


def test_tables_are_made_extended_and_replaced(spark):
    name = "test_sink_" + new_path(spark, "x").rsplit("-", 1)[1]
    df = spark.createDataFrame([(1, "a")], "id int, t string")
    sinks.append_table(df, name)
    sinks.append_table(df, name)
    assert rows(spark.table(name)) == [(1, "a"), (1, "a")]
    sinks.replace_table(df, name)
    assert rows(spark.table(name)) == [(1, "a")]
    spark.sql(f"DROP TABLE {name}")
