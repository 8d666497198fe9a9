"""De-duplication across loads against a bucketed history of keys.

The history is a table of key hashes, partitioned by a slice of time and bucketed by hash. A new
batch is shuffled once, to the buckets; the history is read where it lies, bucket by bucket, and
only the slices that the batch's keys fall into. A key's slice must follow from the key.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.dedupe import keep_first_per_key
from tripmart.session import keep, new_path

_HASHES = ("__h1", "__h2")
_SLICE = "__slice"


class KeyHistory:
    """Keys met in earlier loads. The first row of a key wins, in this load or an earlier one."""

    def __init__(
        self,
        spark: SparkSession,
        key: Sequence[str],
        time_slice: Column,
        buckets: int | None = None,
        table: str | None = None,
        path: str | None = None,
    ):
        """``time_slice`` is an int computed from the key columns; ``table`` and ``path`` name a
        history that lasts, else it is this object's own."""
        self.spark, self.key, self.time_slice = spark, list(key), time_slice
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = table or f"key_history_{uuid.uuid4().hex}"
        self.path = path or new_path(spark, self.table)

    def _hashed(self, df: DataFrame) -> DataFrame:
        """Two hashes tell keys apart; NULLs take part by their places."""
        columns = [F.col(c) for c in self.key]
        nulls = F.array(*[c.isNull() for c in columns])
        one, two = F.xxhash64(nulls, *columns), F.xxhash64(F.lit(1), nulls, *columns)
        return df.withColumns(dict(zip(_HASHES, (one, two), strict=True)) | {_SLICE: self.time_slice})

    def known(self, slices: Sequence[int]) -> DataFrame:
        """Hashes of the keys in some slices; NULL slices are always read."""
        held = self.spark.table(self.table)
        near = F.col(_SLICE).isNull()
        return held.where(near | F.col(_SLICE).isin(*slices) if slices else near)

    def unseen(self, rows: DataFrame) -> DataFrame:
        """Hashed rows whose key no earlier load held."""
        if not self.spark.catalog.tableExists(self.table):
            return rows
        found = rows.select(_SLICE).where(F.col(_SLICE).isNotNull()).distinct().collect()
        old = self.known([r[0] for r in found]).select(*_HASHES)  # one row a slice of time
        return rows.join(old.hint("merge"), list(_HASHES), "left_anti")

    def add(self, batch: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
        """The rows of ``batch`` that stay, written; their keys join the history.

        Within the batch the least row of a key stays, as in ``keep_first_per_key``.
        """
        first = keep(keep_first_per_key(batch, self.key, order_by), "first-rows").df
        fresh = keep(self.unseen(self._hashed(first)), "fresh-rows").df
        (
            fresh.select(*_HASHES, _SLICE)
            .repartition(self.buckets, *_HASHES)
            .write.mode("append")
            .partitionBy(_SLICE)
            .bucketBy(self.buckets, *_HASHES)
            .sortBy(*_HASHES)
            .option("path", self.path)
            .saveAsTable(self.table)
        )
        return fresh.drop(*_HASHES, _SLICE)

    def drop(self) -> None:
        """Forget the table; its files stay where they are."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
