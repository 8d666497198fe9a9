"""Partitioned writes that neither sort a task's rows first nor write or scan them twice."""

import threading

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from registry import queries as q
from tripmart import session
from tripmart.operators import row_checks
from tripmart.plans import increments
from tripmart.session import new_path, open_files
from tripmart.sources import ingest, sinks
from tripmart.sources.ingest import Month

KEY = session._OPEN_FILES_KEY
FOLDER = "/root/testdata/sf0.001"


def spread(spark, partitions=1):
    """Rows whose part changes from row to row; the last part is NULL."""
    part = F.when(F.col("id") % 5 != 4, (F.col("id") % 5).cast("int"))
    return spark.range(0, 1000, 1, partitions).select("id", part.alias("part"))


@pytest.fixture
def writes(spark, monkeypatch):
    """Path and number of open files of every Parquet write."""
    seen, write = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **kwargs):
        seen.append((path, int(spark.conf.get(KEY, "0"))))
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return seen


def test_open_files_spare_the_sort_by_partition(spark):
    table = f"open_files_{threading.get_ident()}"
    path = new_path(spark, "open-files")
    spark.sql(
        f"CREATE TABLE {table} (id bigint, part int) USING parquet PARTITIONED BY (part) LOCATION '{path}'"
    )
    spread(spark).createOrReplaceTempView("spread_rows")
    insert = f"EXPLAIN INSERT INTO {table} SELECT id, part FROM spread_rows"
    try:
        assert "Sort [" in spark.sql(insert).first()[0]
        with open_files(spark):
            assert "Sort [" not in spark.sql(insert).first()[0]
        assert "Sort [" in spark.sql(insert).first()[0]
    finally:
        spark.sql(f"DROP TABLE {table}")


def test_open_files_leave_the_setting_as_it_was(spark):
    before = spark.conf.get(KEY, None)
    with pytest.raises(ValueError), open_files(spark, 3):
        assert spark.conf.get(KEY) == "3"
        with open_files(spark, 5):
            assert spark.conf.get(KEY) == "5"
        assert spark.conf.get(KEY) == "3"
        raise ValueError
    assert spark.conf.get(KEY, None) == before


@pytest.mark.parametrize("n", [2, 64])
def test_more_partitions_than_open_files_lose_no_row(spark, n):
    path = new_path(spark, "open-files")
    with open_files(spark, n):
        spread(spark).write.partitionBy("part").parquet(path)
    got = spark.read.schema("id bigint, part int").parquet(path).collect()
    assert sorted(tuple(r) for r in got) == [(i, i % 5 if i % 5 != 4 else None) for i in range(1000)]


def test_chunked_partitions_are_written_unsorted(spark, writes):
    path = new_path(spark, "chunks")
    sinks.write_chunked(spread(spark), path, 60, ["part"])
    assert writes == [(path, session.OPEN_FILES)]
    sizes = spark.read.parquet(path).groupBy("part", F.input_file_name()).count().collect()
    assert max(r["count"] for r in sizes) <= 60 and sum(r["count"] for r in sizes) == 1000


def test_months_are_loaded_unsorted(spark, writes):
    source, target = new_path(spark, "source"), new_path(spark, "bronze")
    months = [Month("yellow", 2020, m) for m in (1, 2, 3)]
    for month in months:
        data = spark.range(month.month).select(F.col("id").cast("int").alias("VendorID"))
        data.write.parquet(ingest.month_path(source, month))
    writes.clear()
    outcomes = ingest.backfill_months(spark, source, months, target)
    assert [o.rows for o in outcomes] == [1, 2, 3]
    assert [n for path, n in writes if path == target] == [24]
    assert ingest.read_raw(spark, target).count() == 6


def test_failing_rows_are_stored_unsorted(spark, writes):
    path = new_path(spark, "failures")
    rules = [row_checks.not_null("part"), row_checks.in_range("id", F.col("id") < 10)]
    got = row_checks.check_rows(spread(spark), "t", rules, path).collect()
    assert [r.n_failing for r in got] == [200, 10]
    assert writes == [(path, session.OPEN_FILES)]
    stored = row_checks.stored_failures(spread(spark), path).groupBy(row_checks.CHECK).count()
    assert sorted(r["count"] for r in stored.collect()) == [10, 200]


def test_a_year_reads_its_own_files(spark):
    trips = q._trips(spark, FOLDER, "vendor_id")
    yearly = q.by_year(trips)
    assert yearly.schema.names == trips.schema.names
    assert yearly.exceptAll(trips).isEmpty() and trips.exceptAll(yearly).isEmpty()
    files = yearly.where("load_year = 2018").select(F.input_file_name()).distinct().collect()
    assert files and all("load_year=2018" in r[0] for r in files)
    plan = yearly.where("load_year = 2018")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_year" in plan


def test_a_refresh_writes_the_numbered_trips_once(spark, writes):
    grown = q._changing_months(spark, FOLDER)
    writes.clear()
    increments.refresh_gold(spark, grown.raw, q.bronze_zones(spark, FOLDER), grown.gold)
    names = [path.rsplit("/", 1)[1].rsplit("-", 1)[0] for path, _ in writes]
    assert names.count("place") == 1 and "numbered" not in names
    schemas = [spark.read.parquet(path).columns for path, _ in writes if "/tripmart/month-counts" in path]
    assert schemas == [[*increments.MONTH, "n"]]
