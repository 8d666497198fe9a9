"""Token ids in fixed-width bits: blocks that numpy unpacks at once, with offsets for random access.

Every id takes the bits that the largest id of the vocabulary needs. 64 ids fill ``bits`` words of
64 bits, so a block of any size is packed and unpacked by at most 128 array operations. A block
row holds its documents' ids and lengths, and its place among the ids of its part, so a reader
finds any document without unpacking what lies before it. It also holds its smallest and largest
document id (null if all are), whose statistics let a reader skip files, row groups and pages.
Blocks are Parquet rows: Spark commits them, and any store that Spark reaches can hold them.

Documents are in ascending id order (nulls first; equal ids in the order of their texts' hashes).
A null text is an empty one. Repeated rows stay. No document means no block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm import words
from tripmart.llm.tokens import encoder

#: Ids after which a block ends (with its last document).
BLOCK_IDS = 1 << 18
#: Bytes of text worked on at once.
TEXT_BYTES = 4 << 20

BLOCK_SCHEMA = (
    "part int, block int, start long, n_ids long, bits int, low long, high long, "
    "doc_ids array<bigint>, lengths array<bigint>, payload binary"
)
READ_SCHEMA = "doc_id bigint, part int, local_start long, n_tokens long, ids_crc32 long"


def bits_for(vocabulary: int) -> int:
    """Bits of the largest id of a vocabulary of this size."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids``, each in ``bits`` bits, in whole groups of 64."""
    groups = -(-len(ids) // 64)
    padded = np.zeros(groups * 64, dtype=np.uint64)
    padded[: len(ids)] = ids
    rows = np.ascontiguousarray(padded.reshape(groups, 64).T)
    out = np.zeros((bits, groups), dtype=np.uint64)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        out[word] |= rows[k] << np.uint64(shift)
        if shift + bits > 64:
            out[word + 1] |= rows[k] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).astype("<u8").tobytes()


def unpack(payload: bytes, bits: int, start: int, count: int) -> np.ndarray:
    """Ids ``start`` to ``start + count``; only the groups that hold them are read."""
    low, high = start // 64, -(-(start + count) // 64)
    rows = np.frombuffer(payload, "<u8")[low * bits : high * bits].reshape(-1, bits).T
    out = np.empty((64, high - low), dtype=np.uint64)
    mask = np.uint64((1 << bits) - 1)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        value = rows[word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (rows[word + 1] << np.uint64(64 - shift))
        out[k] = value & mask
    flat = out.T.reshape(-1)
    return flat[start - low * 64 : start - low * 64 + count].astype(np.uint32)


def _blocks(name: str, spaces: bool, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(name, spaces)
        bits = bits_for(code.size)
        part = TaskContext.get().partitionId()
        state = {"block": 0, "start": 0, "held": 0}
        docs: list = []
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            flat, known = np.concatenate(ids), [x for x in docs if x is not None]
            row = {
                "part": part,
                "block": state["block"],
                "start": state["start"],
                "n_ids": len(flat),
                "bits": bits,
                "low": min(known, default=None),
                "high": max(known, default=None),
                "doc_ids": list(docs),
                "lengths": np.concatenate(lengths).tolist(),
                "payload": pack(flat, bits),
            }
            state["block"] += 1
            state["start"] += len(flat)
            state["held"] = 0
            docs.clear(), lengths.clear(), ids.clear()
            return pa.RecordBatch.from_pylist([row], schema=ARROW)

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for first, texts in words.slices(words.texts_of(batch.column("text")), TEXT_BYTES):
                flat, starts = with_end(*code.encode(texts), end_id)
                docs.extend(names[first : first + len(texts)])
                lengths.append(np.diff(starts))
                ids.append(flat)
                state["held"] += len(flat)
                if state["held"] >= BLOCK_IDS:
                    yield block()
        if docs:
            yield block()

    return run


def with_end(ids: np.ndarray, first: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each text, and where each text begins."""
    rows = len(first) - 1
    out = np.full(len(ids) + rows, end_id, dtype=np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(rows), np.diff(first))] = ids
    return out, first + np.arange(rows + 1)


ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("start", pa.int64()),
        ("n_ids", pa.int64()),
        ("bits", pa.int32()),
        ("low", pa.int64()),
        ("high", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)


def write_tokens(docs: DataFrame, path: str, name: str, spaces: bool, end_id: int) -> None:
    """Encode ``docs`` (doc_id, text) and write the blocks; one range shuffle of the texts.

    A frequent id (nulls, say) spreads over parts by the hash of its text and the row's place.
    """
    keys = [F.col("doc_id"), F.xxhash64("text"), F.col("place")]
    (
        docs.select("doc_id", "text")
        .withColumn("place", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("doc_id", "text")
        .mapInArrow(_blocks(name, spaces, end_id), BLOCK_SCHEMA)
        .write.parquet(path)
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(row["payload"], row["bits"], 0, row["n_ids"])
            count = np.array(row["lengths"], dtype=np.int64)
            start = np.cumsum(count) - count
            crc = [
                zlib.crc32(ids[a:b])
                for a, b in zip(start.tolist(), (start + count).tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(np.full(len(count), row["part"], np.int32)),
                    pa.array(start + row["start"]),
                    pa.array(count),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "part", "local_start", "n_tokens", "ids_crc32"],
            )


def part_starts(blocks: DataFrame) -> DataFrame:
    """Ids before each part; one row per part, however many blocks or documents there are."""
    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("part_start"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files: its place among all ids, its length and checksum."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    rows = blocks.select("part", "start", "n_ids", "bits", "doc_ids", "lengths", "payload")
    return (
        rows.mapInArrow(_rows, READ_SCHEMA)
        .join(F.broadcast(part_starts(blocks)), "part")
        .select(
            "doc_id",
            (F.col("part_start") + F.col("local_start")).alias("start"),
            "n_tokens",
            "ids_crc32",
        )
    )


def blocks_of(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """The blocks that hold a document of that id; others are skipped by their bounds."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    inside = (F.col("low") <= doc_id) & (F.col("high") >= doc_id)
    return blocks.where(inside & F.array_contains("doc_ids", doc_id))


def document_ids(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """Random access: the ids of each document of that id, unpacking only their groups."""
    found = []
    for row in blocks_of(spark, path, doc_id).orderBy("part", "block").collect():
        start = np.concatenate([[0], np.cumsum(row.lengths)])
        for k, one in enumerate(row.doc_ids):
            if one == doc_id:
                ids = unpack(row.payload, row.bits, int(start[k]), int(row.lengths[k]))
                found.append(ids)
    return found
