import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tripmart.operators.dedupe import keep_first_per_key
from tripmart.operators.impute import impute_upper_median, upper_medians
from tripmart.operators.row_id import PART, assign_row_id, range_sorted
from tripmart.operators.top_n import top_n_per_group
from tripmart.session import BROADCAST_ROWS, Kept, keep, new_path, small_side


@pytest.fixture(scope="module")
def skewed(spark):
    """9,000 rows on disk; a third of them share one key, and a third are copies of one row."""
    random.seed(3)
    data = [("hot", i, "x") for i in range(3000)]
    data += [("copy", 5, "y")] * 3000
    data += [(random.choice("abc"), random.randrange(50), None) for _ in range(3000)]
    random.shuffle(data)
    path = new_path(spark, "test-skewed")
    spark.createDataFrame(data, "g string, v int, t string").repartition(4).write.parquet(path)
    return spark.read.parquet(path), data


def test_row_ids_number_the_whole_table(skewed):
    df, data = skewed
    got = assign_row_id(df, "id", ["g", "v", "t"]).orderBy("id").collect()
    assert [r.id for r in got] == list(range(1, len(data) + 1))
    nulls_first = sorted(data, key=lambda r: (r[0], r[1], r[2] is not None, r[2] or ""))
    assert [(r.g, r.v, r.t) for r in got] == nulls_first


def test_row_ids_restart_in_each_group(skewed):
    df, data = skewed
    got = assign_row_id(df, "id", ["v"], within=["g"], partitions=16).collect()
    sizes = Counter(r[0] for r in data)
    for group, size in sizes.items():
        mine = sorted((r.id, r.v) for r in got if r.g == group)
        assert [i for i, _ in mine] == list(range(1, size + 1))
        assert [v for _, v in mine] == sorted(v for _, v in mine)


def test_row_ids_with_a_null_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 1)], "g string, v int")
    path = new_path(spark, "test-nulls")
    df.write.parquet(path)
    got = rows(assign_row_id(spark.read.parquet(path), "id", ["v"], within=["g"]))
    assert got == sorted([(None, 1, 1), (None, 2, 2), ("a", 1, 1)], key=repr)


def test_copies_spread_over_partitions(skewed):
    df, data = skewed
    placed = range_sorted(df, ["g", "v", "t"], partitions=9)
    sizes = [r["count"] for r in placed.groupBy(PART).count().collect()]
    assert sum(sizes) == len(data)
    assert max(sizes) < 2 * len(data) / 9


def test_row_ids_need_no_single_task(skewed):
    df, _ = skewed
    plan = range_sorted(df, ["g", "v", "t"])._jdf.queryExecution().toString()
    assert "rangepartitioning" in plan and "SinglePartition" not in plan


def test_first_per_key(spark):
    data = [(1, "b", None), (1, "a", 2), (1, "a", None), (None, "z", 1), (None, "y", 1), (2, "q", 0)]
    df = spark.createDataFrame(data, "k int, o string, x int")
    assert rows(keep_first_per_key(df, ["k"], ["o"])) == sorted(
        [(1, "a", None), (None, "y", 1), (2, "q", 0)], key=repr
    )
    twice = df.unionByName(df)
    assert rows(keep_first_per_key(twice, df.columns)) == rows(df)


def test_first_per_key_matches_brute_force(skewed):
    df, data = skewed
    got = rows(keep_first_per_key(df, ["g"]))
    least = {}
    for g, v, t in data:
        order = (v, t is not None, t or "")
        if g not in least or order < least[g][0]:
            least[g] = (order, (g, v, t))
    assert got == sorted((row for _, row in least.values()), key=repr)


def test_top_n_limits_before_the_shuffle(skewed):
    df, data = skewed
    top = top_n_per_group(df, ["g"], [F.desc("v"), F.asc("t")], 2)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    expected = []
    for g in {r[0] for r in data}:
        mine = sorted((r for r in data if r[0] == g), key=lambda r: -r[1])
        expected += mine[:2]
    assert rows(top) == sorted(expected, key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 1000])
def test_upper_median(spark, n):
    random.seed(n)
    ints = [random.randrange(20) for _ in range(n)]
    data = [(i, random.random(), None) for i in ints] + [(None, None, None)]
    df = spark.createDataFrame(data, "a int, b double, c double")
    medians = upper_medians(df, ["a", "b", "c"])
    assert medians == {
        "a": sorted(ints)[n // 2],
        "b": sorted(r[1] for r in data[:-1])[n // 2],
    }


def test_imputing_keeps_types_and_leaves_empty_columns(spark):
    df = spark.createDataFrame([(1, None), (None, None), (4, None)], "a int, c double")
    filled = impute_upper_median(df, ["a", "c"])
    assert filled.schema.simpleString() == "struct<a:int,c:double>"
    assert rows(filled) == sorted([(1, None), (4, None), (4, None)], key=repr)


def test_broadcast_depends_on_the_counted_size(spark):
    kept = keep(spark.range(10), "test-kept")
    assert kept.rows == 10 and kept.df.count() == 10
    big = Kept(kept.df, BROADCAST_ROWS + 1, kept.path)
    hinted, plain = (
        spark.range(5).join(side, "id")._jdf.queryExecution().optimizedPlan().toString()
        for side in (small_side(kept), small_side(big))
    )
    assert "strategy=broadcast" in hinted and "strategy=broadcast" not in plain


def test_medians_of_large_whole_numbers_and_decimals(spark):
    big = 9_007_199_254_740_993
    df = spark.createDataFrame(
        [(big, "0.10"), (None, None), (big, "12345678901234567890.12")], "n bigint, d string"
    ).withColumn("d", F.col("d").cast("decimal(24,2)"))
    filled = impute_upper_median(df, ["n", "d"])
    assert filled.dtypes == df.dtypes
    assert rows(filled.where("n = 9007199254740993 AND d > 1")) and filled.where("n IS NULL").isEmpty()
    assert {r.n for r in filled.collect()} == {big}
    assert str(max(r.d for r in filled.collect())) == "12345678901234567890.12"


def test_deduplication_reads_once_and_shuffles_once(skewed):
    """A hot key is reduced below the only shuffle."""
    df, _ = skewed
    plan = keep_first_per_key(df, ["g", "v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == plan.count("Exchange") == 1
    above, below = plan.split("Exchange")
    assert "functions=[min(" in above and "partial_min(" in below
    assert "Window" not in plan and "Join" not in plan
