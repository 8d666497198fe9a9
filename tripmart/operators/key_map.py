"""Surrogate keys that stay: a stored map from natural keys, to which new members are added."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators.row_id import assign_row_id
from tripmart.session import folder_names, keep, remove_path, small_side

BATCH = "batch"


class KeyMap:
    """Numbers given once and for all to the members of a dimension.

    The map is one folder per batch of new members. Numbers go on above the largest one given
    before, in the order of the natural key within a batch. ``grow`` is safe to repeat: the rows of
    its own batch, as a failed run may have left them, are written anew, and those of earlier
    batches never change.
    """

    def __init__(self, spark: SparkSession, path: str, natural: T.StructType, key: str = "sk"):
        self.spark, self.path, self.natural, self.key = spark, path, natural, key
        self.schema = T.StructType([*natural, T.StructField(key, T.LongType())])

    def batches(self) -> list[int]:
        """Batches stored so far, in order."""
        names = folder_names(self.spark, self.path)
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BATCH}="))

    def read(self, upto: int | None = None) -> DataFrame:
        """The map (natural key, number, batch), without batches after ``upto``."""
        stored = [b for b in self.batches() if upto is None or b <= upto]
        schema = T.StructType([*self.schema, T.StructField(BATCH, T.IntegerType())])
        if not stored:
            return self.spark.createDataFrame([], schema)
        parts = [f"{self.path}/{BATCH}={b}" for b in stored]
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*parts)

    def grow(self, members: DataFrame, batch: int) -> DataFrame:
        """Add the members (natural key columns, repeats and NULLs allowed) the map lacks.

        NULL keys get no number. Only distinct members meet the map, by an anti-join, and only new
        ones are sorted; nothing of either reaches the driver but the largest number given so far.
        """
        if any(b > batch for b in self.batches()):
            raise ValueError(f"batch {batch} is older than the map at {self.path}")
        names: Sequence[str] = self.natural.names
        earlier = self.read(batch - 1)
        distinct = members.select(*names).dropna().distinct()
        new = keep(distinct.join(earlier.select(*names), list(names), "left_anti"), "new-members")
        if not new.rows:
            remove_path(self.spark, f"{self.path}/{BATCH}={batch}")  # of a failed run
            return self.read()
        top = earlier.agg(F.coalesce(F.max(self.key), F.lit(0)).alias("top")).first()["top"]
        numbered = assign_row_id(new.df, self.key, names)
        (
            numbered.withColumn(self.key, F.col(self.key) + F.lit(top))
            .write.mode("overwrite")
            .parquet(f"{self.path}/{BATCH}={batch}")
        )
        return self.read()

    def lookup(self, rows: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
        """``rows`` with the number of the member in ``columns`` as ``name``; NULL if there is none."""
        own = [f"__{c}" for c in self.natural.names]
        side = keep(self.read().select(*self.schema.names), "key-map")
        renamed = small_side(side).toDF(*own, name)
        match = [F.col(c) == F.col(o) for c, o in zip(columns, own, strict=True)]
        return rows.join(renamed, match, "left").drop(*own)
