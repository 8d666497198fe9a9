"""Streamed trips: repeated and late rows over several batches."""

import time

from conftest import rows

from tripmart.session import new_path
from tripmart.streaming import trips as trips_stream


def test_repeated_and_late_rows_go(spark):
    source, target, checkpoint = (new_path(spark, f"test-{n}") for n in ("in", "out", "check"))
    batches = [
        [("a", "2019-01-01 10:00:00"), ("a", "2019-01-01 10:00:00"), (None, "2019-01-01 11:00:00")],
        [("a", "2019-01-01 10:00:00"), (None, "2019-01-01 11:00:00"), ("b", "2019-01-05 00:00:00")],
        [("late", "2019-01-02 00:00:00"), ("slow", "2019-01-04 12:00:00"), ("b", "2019-01-05 00:00:00")],
    ]
    schema = spark.createDataFrame([], "k string, at timestamp").schema
    for batch in batches:
        df = spark.createDataFrame(batch, "k string, at string").selectExpr("k", "cast(at AS timestamp) AS at")
        df.coalesce(1).write.mode("append").parquet(source)
        time.sleep(1.1)  # files are taken in the order of their times
        stream = trips_stream.stream_files(spark, source, schema, 1)
        first = trips_stream.first_rows(stream, ["k", "at"], "at", "1 day")
        trips_stream.write_first_rows(first, target, checkpoint).awaitTermination()
    got = rows(spark.read.schema(schema).parquet(target).select("k"))
    assert got == [("a",), ("b",), ("slow",), (None,)]


def test_state_is_not_kept_on_the_heap(spark):
    source, target, checkpoint = (new_path(spark, f"test-{n}") for n in ("in", "out", "check"))
    spark.range(100).selectExpr("id % 40 AS k", "timestamp'2019-01-01' AS at").write.parquet(source)
    before = {key: spark.conf.get(key, None) for key in trips_stream.STATE}
    stream = trips_stream.stream_files(spark, source, spark.read.parquet(source).schema)
    query = trips_stream.write_first_rows(trips_stream.first_rows(stream, ["k"], "at", "1 day"), target, checkpoint)
    query.awaitTermination()
    assert spark.read.parquet(target).count() == 40
    state = query.recentProgress[0].stateOperators[0]
    assert state.customMetrics["rocksdbGetCount"] >= 40
    assert {key: spark.conf.get(key, None) for key in trips_stream.STATE} == before
