"""Line de-duplication across documents with levelled sorted runs of line hashes; DataFrames only.

A line's key is the line without ASCII white space at both ends, in lower case for A-Z. A key of
at least ``MIN_CHARS`` characters stays in the document with the smallest id that holds it, and
all its lines go from the others.

Documents come in batches of ascending id. The keys of all earlier batches lie in runs: tables of
128-bit key hashes, bucketed and sorted by the hash, so that a batch is merged with a run bucket by
bucket. Each batch anti-joins the runs, adds its new keys as a run of level 0, and when ``FAN``
runs of a level have gathered they are compacted to one of the next level. A key found in a run
belongs to an earlier document; of the others, the smallest id in the batch is the owner.

A frequent line costs one row per task before the shuffle that finds its owner, and the join that
tells its documents is one whose skewed partitions Spark splits. Texts move once, with the numbers
of the lines to drop.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.session import freed_shuffles, new_path, remove_path, scratch

MIN_CHARS = 10
BATCHES = 4
FAN = 2

_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = " \t\n\x0b\x0c\r"
_LAST = (1 << 63) - 1


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_SPACE)), _UPPER, _SMALL)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, id, body, place): keys of all lines long enough, by the place of the line.

    ``id`` is the document's, nulls last; ``body`` tells rows of the same id apart.
    """
    return (
        docs.select(
            F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("id"),
            F.xxhash64("text").alias("body"),
            F.posexplode(_lines(F.col("text"))).alias("place", "line"),
        )
        .where(F.length("line") >= min_chars)
        .withColumn("key", line_key(F.col("line")))
        .where(F.length("key") >= min_chars)
        .select(
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(1), "key").alias("h2"),
            "id",
            "body",
            "place",
        )
    )


class Runs:
    """Sorted runs of key hashes, by level."""

    def __init__(self, spark, buckets: int, fan: int):
        self.spark, self.buckets, self.fan = spark, buckets, fan
        self.levels: list[list[str]] = [[]]
        self.paths: dict[str, str] = {}

    def _write(self, keys: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = new_path(self.spark, name)
        (
            keys.select("h1", "h2")
            .repartition(self.buckets, "h1", "h2")
            .write.bucketBy(self.buckets, "h1", "h2")
            .sortBy("h1", "h2")
            .option("path", self.paths[name])
            .saveAsTable(name)
        )
        return name

    def __iter__(self):
        for level in self.levels:
            for name in level:
                yield self.spark.table(name)

    def _drop(self, level: list[str]) -> None:
        for name in level:
            self.spark.sql(f"DROP TABLE {name}")
            remove_path(self.spark, self.paths.pop(name))
        level.clear()

    def add(self, keys: DataFrame) -> None:
        """One more run of keys that no run holds yet; full levels are compacted."""
        self.levels[0].append(self._write(keys))
        for depth, level in enumerate(self.levels):
            if len(level) < self.fan:
                break
            merged = self.spark.table(level[0])
            for name in level[1:]:
                merged = merged.union(self.spark.table(name))
            if depth + 1 == len(self.levels):
                self.levels.append([])
            self.levels[depth + 1].append(self._write(merged))
            self._drop(level)

    def drop(self) -> None:
        for level in self.levels:
            self._drop(level)


def _bounds(docs: DataFrame, batches: int) -> list[int]:
    """Ids that part the documents into batches of about equal size; only they are collected."""
    shares = [k / batches for k in range(1, batches)]
    found = docs.select(F.percentile_approx(F.col("doc_id").cast("bigint"), shares, 1000)).first()
    return sorted(set(found[0] or []))


def repeated_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES, fan: int = FAN
) -> DataFrame:
    """(id, body, places): the lines to drop from each document row that loses any."""
    spark = docs.sparkSession
    bounds = _bounds(docs, batches)
    number = F.lit(0)
    for bound in bounds:
        number = number + (F.col("id") > bound).cast("int")
    path = new_path(spark, "line-keys")
    drops_path = new_path(spark, "line-drops")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = Runs(spark, buckets, fan)
    with freed_shuffles(spark):
        _keys(docs, min_chars).withColumn("batch", number).write.partitionBy("batch").parquet(path)
        keys = spark.read.schema("h1 bigint, h2 bigint, id bigint, body bigint, place int, batch int")
        keys = keys.parquet(path)
        for k in range(len(bounds) + 1):
            own = keys.where(F.col("batch") == k).drop("batch")
            owners = own.groupBy("h1", "h2").agg(F.min("id").alias("owner"))
            fresh = owners
            for run in runs:
                fresh = fresh.join(run.hint("merge"), ["h1", "h2"], "left_anti")
            with scratch(spark) as kept:
                fresh = kept(fresh, "line-owners").df
                (
                    own.join(fresh.hint("merge"), ["h1", "h2"], "left")
                    .where(F.col("owner").isNull() | (F.col("owner") < F.col("id")))
                    .select("id", "body", "place")
                    .write.mode("append")
                    .parquet(drops_path)
                )
                if k < len(bounds):
                    runs.add(fresh)
        runs.drop()
        remove_path(spark, path)
    drops = spark.read.schema("id bigint, body bigint, place int").parquet(drops_path)
    return drops.groupBy("id", "body").agg(F.collect_set("place").alias("places"))


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES, fan: int = FAN
) -> DataFrame:
    """``docs`` (doc_id, text, and any others, kept) with ``text`` without its repeated lines.

    Two more columns tell the lines: ``line_dedup_lines`` before, ``line_dedup_dropped`` of them.
    A null or empty text is one empty line and becomes empty. Null ids come last, all as one
    document; so are rows of an equal id, which never cost each other a line. Repeated rows stay
    as often as they occur.
    """
    drops = repeated_lines(docs, min_chars, batches, fan).select(
        F.col("id").alias("line_dedup_id"),
        F.col("body").alias("line_dedup_body"),
        F.col("places").alias("line_dedup_places"),
    )
    rows = docs.withColumns(
        {
            "line_dedup_row": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)),
            "line_dedup_text": F.xxhash64("text"),
        }
    )
    joined = rows.join(
        drops,
        (F.col("line_dedup_row") == F.col("line_dedup_id"))
        & (F.col("line_dedup_text") == F.col("line_dedup_body")),
        "left",
    )
    lines = _lines(F.col("text"))
    places = F.col("line_dedup_places")
    kept = F.when(places.isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(F.filter(lines, lambda _, k: ~F.array_contains(places, k)), "\n")
    )
    dropped = F.coalesce(F.size(places), F.lit(0))
    return joined.select(
        *[kept.alias(c) if c == "text" else F.col(c) for c in docs.columns],
        F.size(lines).cast("bigint").alias("line_dedup_lines"),
        F.when(places.isNull(), F.lit(0)).otherwise(dropped).cast("bigint").alias("line_dedup_dropped"),
    )


#: The same in one window per key, for DuckDB.
ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
owned AS (
  SELECT *, length(key) >= 10 AND min(doc_id) OVER (PARTITION BY key) < doc_id AS dropped FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM owned GROUP BY doc_id
"""
