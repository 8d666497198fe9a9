"""Lloyd's clustering with vectors and centroids split by dimension.

Vectors of whole numbers are cut into chunks of rows, and each chunk into blocks of columns, one
record of bytes each, written once and bucketed by chunk. A column block's tasks hold a slice of
every centroid, of the same columns, and no other. Each round

1. every column block computes the exact partial squared distances of its chunks to its slices,
2. the partial distances of a chunk are summed by key, and the nearest centroid is taken,
3. the labels, a few bytes a vector, go back to the column blocks by a join on the chunk, which
   moves no vector; each block sums its columns by label, and replaces its own slices.

All arithmetic is on integers: products run through floating point only where every intermediate
result is below 2**53. So the result depends on neither partitioning nor order. No task needs more
than a chunk with its distances (``CELLS``), and no vector passes through the driver. Labels and
slices of each round are written to the shared folder, so a lost executor costs one step.

Vectors of another length than ``dims`` are left out, as are those ``whole_vectors`` drops. Fewer
vectors than centroids give as many centroids; an empty table gives no rows. Components beyond
2**27 count as 2**27, so that distances fit a long. Rows of one id count each; a null id hashes as
no digits; equal hashes are ordered by their vectors. Inertia beyond a long is null.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.vectors import matrix
from tripmart.session import keep, new_path

CLUSTERS = 40
ROUNDS = 5
DIMS = 64
BLOCK_DIMS = 16
SALT = "2:"
#: Partial distances, over all blocks, that the task of one chunk holds.
CELLS = 2**20
LARGEST = 2**27

_EXACT = 2**53


def squared_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to those of ``c``, as longs."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * top * top * max(x.shape[1], 1) < _EXACT:
        x, c = x.astype(np.float64), c.astype(np.float64)
        near = (x * x).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * (x @ c.T)
        return near.astype(np.int64)
    x, c = x.astype(np.int64), c.astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in c], axis=1)


# ---------------------------------------------------------------- chunks of column blocks

_CHUNK_SCHEMA = "chunk bigint, block int, ids array<bigint>, data binary"


def _chunked(dims: int, width: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            whole = np.clip(matrix(batch.column("x"), dims), -LARGEST, LARGEST).astype("<i4")
            for start in range(0, len(whole), rows):
                part = whole[start : start + rows]
                ids = batch.column("id").slice(start, rows).to_pylist()
                blocks = range(0, dims, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * len(blocks), pa.int64()),
                        pa.array(range(len(blocks)), pa.int32()),
                        # The ids of a chunk stand beside its first block only.
                        pa.array([ids] + [None] * (len(blocks) - 1), pa.list_(pa.int64())),
                        pa.array(
                            [np.ascontiguousarray(part[:, b : b + width]).tobytes() for b in blocks],
                            pa.binary(),
                        ),
                    ],
                    names=["chunk", "block", "ids", "data"],
                )
                number += 1

    return run


class Blocks:
    """The written chunks; ``block(b)`` scans one column block. Drop it after use."""

    def __init__(self, vectors: DataFrame, dims: int, width: int, clusters: int):
        self.spark = vectors.sparkSession
        self.dims, self.width, self.count = dims, width, -(-dims // width)
        rows = max(1, min(1024, CELLS // (clusters * self.count)))
        self.name = f"lloyd_blocks_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        (
            vectors.mapInArrow(_chunked(dims, width, rows), _CHUNK_SCHEMA)
            .repartition(buckets, "chunk")
            .write.partitionBy("block")
            .bucketBy(buckets, "chunk")
            .sortBy("chunk")
            .option("path", new_path(self.spark, "lloyd-blocks"))
            .saveAsTable(self.name)
        )

    def block(self, number: int) -> DataFrame:
        return self.spark.table(self.name).where(F.col("block") == number)

    def columns(self, number: int) -> int:
        return min(self.width, self.dims - number * self.width)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE {self.name}")


# ---------------------------------------------------------------- one round


def _slice(slices: DataFrame, block: int) -> DataFrame:
    """One row: the slices of all centroids in one column block, in order of their numbers."""
    own = F.array_sort(F.collect_list(F.struct("cluster", "c")))
    return (
        slices.where(F.col("block") == block)
        .groupBy("block")
        .agg(F.transform(own, lambda s: s["c"]).alias("slices"))
    )


def _partial(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                c = matrix(batch.column("slices")[row].values, width)
                x = np.frombuffer(batch.column("data")[row].as_py(), "<i4").reshape(-1, width)
                near = squared_distances(x, c)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("chunk").slice(row, 1),
                        pa.array([len(c)], pa.int32()),
                        pa.array([near.astype("<i8").tobytes()], pa.binary()),
                    ],
                    names=["chunk", "clusters", "near"],
                )

    return run


def _nearest(parts: pa.Table) -> pa.Table:
    """Sum the column blocks of a chunk; each vector's nearest centroid, the smallest of equals."""
    clusters = parts.column("clusters")[0].as_py()
    near = sum(np.frombuffer(b.as_py(), "<i8") for b in parts.column("near")).reshape(-1, clusters)
    labels = near.argmin(1)
    return pa.table(
        {
            "chunk": parts.column("chunk").slice(0, 1),
            "labels": pa.array([labels.astype(np.int32)], pa.list_(pa.int32())),
            "distances": pa.array([near[np.arange(len(near)), labels]], pa.list_(pa.int64())),
        }
    )


def assigned(blocks: Blocks, slices: DataFrame) -> DataFrame:
    """(chunk, labels, distances): the nearest centroid of every vector; written."""
    parts = [
        blocks.block(b)
        .join(F.broadcast(_slice(slices, b)), "block")  # one row: a slice of each centroid
        .select("chunk", "data", "slices")
        .mapInArrow(_partial(blocks.columns(b)), "chunk bigint, clusters int, near binary")
        for b in range(blocks.count)
    ]
    summed = (
        reduce(DataFrame.unionAll, parts)
        .groupBy("chunk")
        .applyInArrow(_nearest, "chunk bigint, labels array<int>, distances array<bigint>")
    )
    return keep(summed, "lloyd-labels").df


def _member_sums(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in range(len(batch)):
                x = np.frombuffer(batch.column("data")[row].as_py(), "<i4").reshape(-1, width)
                labels = batch.column("labels")[row].values.to_numpy()
                for cluster in np.unique(labels):
                    own = x[labels == cluster].astype(np.int64)
                    line = np.append(own.sum(0), len(own))
                    sums[int(cluster)] = sums.get(int(cluster), 0) + line
        if sums:
            lines = np.stack(list(sums.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), *[pa.array(c) for c in lines.T]],
                names=["cluster", *[f"s{i}" for i in range(width)], "n"],
            )

    return run


def _floor_mean(total: str) -> Column:
    return F.expr(f"({total} - pmod({total}, n)) div n")


def updated(blocks: Blocks, slices: DataFrame, labels: DataFrame) -> DataFrame:
    """(block, cluster, c): the slices after one round; that of an empty cluster stays. Written."""
    of_chunk = labels.select("chunk", "labels")
    new = []
    for b in range(blocks.count):
        width = blocks.columns(b)
        sums = [f"s{i}" for i in range(width)]
        schema = ", ".join(["cluster int", *[f"{s} bigint" for s in sums], "n bigint"])
        new.append(
            blocks.block(b)
            .join(of_chunk, "chunk")
            .select("data", "labels")
            .mapInArrow(_member_sums(width), schema)
            .groupBy("cluster")
            .agg(*[F.sum(c).alias(c) for c in [*sums, "n"]])
            .select(
                F.lit(b).alias("block"),
                "cluster",
                F.array(*[_floor_mean(s) for s in sums]).alias("moved"),
            )
        )
    moved = reduce(DataFrame.unionAll, new)
    after = slices.join(moved, ["block", "cluster"], "left").select(
        "block", "cluster", F.coalesce("moved", "c").alias("c")
    )
    return keep(after, "lloyd-slices").df


# ---------------------------------------------------------------- the whole


def first_slices(vectors: DataFrame, clusters: int, salt: str, dims: int, width: int) -> DataFrame:
    """The vectors with the smallest salted id hashes, in that order, as slices of centroids."""
    hashed = vectors.select(
        F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256).alias(
            "hash"
        ),
        F.transform("x", lambda c: F.greatest(F.least(c, F.lit(LARGEST)), F.lit(-LARGEST))).alias("x"),
    )
    first = hashed.orderBy("hash", "x").limit(clusters)
    numbered = first.select(
        (F.row_number().over(Window.orderBy("hash", "x")) - 1).alias("cluster"), "x"
    )
    cuts = F.array(
        *[
            F.struct(F.lit(b).alias("block"), F.slice("x", start + 1, width).alias("c"))
            for b, start in enumerate(range(0, dims, width))
        ]
    )
    slices = numbered.select("cluster", F.explode(cuts).alias("cut"))
    return keep(slices.select("cut.block", "cluster", "cut.c"), "lloyd-slices").df


def clustered(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    block_dims: int = BLOCK_DIMS,
    salt: str = SALT,
) -> tuple[DataFrame, DataFrame]:
    """Cluster (id, x) vectors of ``dims`` whole numbers.

    Returns (id, cluster, distance) of every vector after the last assignment, and the centroids
    (cluster, centroid). ``clusters * dims`` longs are all that a task needs besides its chunk.
    """
    vectors = vectors.where(F.size("x") == dims)
    slices = first_slices(vectors, clusters, salt, dims, block_dims)
    blocks = Blocks(vectors, dims, block_dims, clusters)
    try:
        for _ in range(rounds):
            slices = updated(blocks, slices, assigned(blocks, slices))
        ids = blocks.block(0).select("chunk", "ids")
        pairs = ids.join(assigned(blocks, slices), "chunk").select(
            F.inline(F.arrays_zip("ids", "labels", "distances")).alias("id", "cluster", "distance")
        )
        members = keep(pairs, "lloyd-members").df
    finally:
        blocks.drop()
    ordered = F.array_sort(F.collect_list(F.struct("block", "c")))
    centroids = slices.groupBy("cluster").agg(
        F.flatten(F.transform(ordered, lambda s: s["c"])).alias("centroid")
    )
    return members, centroids


def digests(members: DataFrame, centroids: DataFrame) -> DataFrame:
    """Every vector with its cluster's inertia, that of all, and its centroid's hash."""
    inertia = members.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    text = F.concat_ws(",", F.transform("centroid", lambda c: c.cast("string")))
    each = keep(
        inertia.join(centroids, "cluster").select(
            "cluster", "cluster_inertia", F.sha2(text, 256).alias("centroid_sha256")
        ),
        "lloyd-inertia",
    ).df
    whole = each.agg(
        F.when(F.count("cluster_inertia") == F.count(F.lit(1)), F.try_sum("cluster_inertia")).alias(
            "inertia"
        )
    ).first()  # one row
    return members.join(F.broadcast(each), "cluster").select(  # one row a cluster
        F.col("id").alias("vec_id"),
        "cluster",
        "distance",
        "cluster_inertia",
        F.lit(whole["inertia"]).cast("bigint").alias("inertia"),
        "centroid_sha256",
    )


def oracle_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS) -> str:
    """The digests of the ``embeddings`` table in DuckDB, one pair of steps a round."""

    def near(k: int) -> str:
        square = "list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))"
        return f"""a{k} AS (
  SELECT vec_id, any_value(x) AS x, min(list_sum({square}) * {clusters} + cluster) AS least
  FROM v, c{k} GROUP BY vec_id)"""

    def moved(k: int) -> str:
        return f"""m{k} AS (
  SELECT cluster, list(CAST(floor(total / n) AS BIGINT) ORDER BY i) AS c
  FROM (SELECT least % {clusters} AS cluster, i, sum(x[i]) AS total, count(*) AS n
        FROM a{k}, range(1, {dims + 1}) g(i) GROUP BY ALL) s GROUP BY cluster),
c{k + 1} AS (
  SELECT c{k}.cluster, coalesce(m{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN m{k} USING (cluster))"""

    steps = [step for k in range(rounds) for step in (near(k), moved(k))]
    return f"""WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {dims}
    AND list_bool_and(list_transform(embedding, lambda e: e IS NOT NULL AND isfinite(e)))),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('{SALT}' || vec_id)) - 1 AS cluster, x AS c
  FROM v QUALIFY cluster < {clusters}),
{", ".join(steps)}, {near(rounds)},
members AS (
  SELECT vec_id, CAST(least % {clusters} AS INT) AS cluster,
    CAST(least // {clusters} AS BIGINT) AS distance FROM a{rounds})
SELECT vec_id, members.cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY members.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM members JOIN c{rounds} ON members.cluster = c{rounds}.cluster"""
