"""Bounded-space online best-fit packing of token pieces into sequences.

Each task packs the pieces it meets into at most ``OPEN`` open bins. The free spaces of the open
bins are bits of one integer, so the tightest bin that fits is the lowest set bit at or above a
piece's length. When one bin too many is open, the fullest closes. Of each ``OPEN`` pieces that
arrive, the longest come first.

The bins still open at the end of a task are packed again, as items of their own, by a sixteenth
of the tasks, and so on until one task is left; it meets at most 16 * ``OPEN`` bins, whatever the
input. No piece passes through the driver, and only a bin's fill and number move between rounds.

A document is cut only if it is longer than a sequence; then its first piece may be shorter. A
null text is an empty one, of the end id alone. Rows with equal or null ids are packed each.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm import words
from tripmart.llm.binary import TEXT_BYTES, with_end
from tripmart.llm.tokens import encoder
from tripmart.session import keep

CAPACITY = 2048
OPEN = 4096
FAN_IN = 16

PIECE_SCHEMA = "doc_id bigint, piece int, start long, length long, ids_crc32 long"


class BestFit:
    """Online packer. ``add`` returns the bin and the offset of an item; closed bins never reopen."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.by_space: dict[int, list[int]] = defaultdict(list)  # open bins of each free space
        self.spaces = 0  # bit s: some open bin has s free
        self.open = self.count = 0

    def _take(self, space: int) -> int:
        bins = self.by_space[space]
        one = bins.pop()
        if not bins:
            self.spaces ^= 1 << space
        self.open -= 1
        return one

    def add(self, length: int) -> tuple[int, int]:
        fitting = self.spaces >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            one = self._take(space)
        else:
            space, one = self.capacity, self.count
            self.count += 1
        left = space - length
        if left:
            if self.open == self.most:
                fullest = (self.spaces & -self.spaces).bit_length() - 1
                if left <= fullest:
                    return one, self.capacity - space
                self._take(fullest)
            self.by_space[left].append(one)
            self.spaces |= 1 << left
            self.open += 1
        return one, self.capacity - space

    def left_open(self) -> dict[int, int]:
        """Fill of each open bin."""
        return {b: self.capacity - s for s, bins in self.by_space.items() for b in bins}


def _pieces(name: str, spaces: bool, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(name, spaces)
        for batch in batches:
            names = batch.column("doc_id")
            for row, texts in words.slices(words.texts_of(batch.column("text")), TEXT_BYTES):
                flat, first = with_end(*code.encode(texts), end_id)
                total = np.diff(first)
                pieces = -(-total // capacity)
                doc = np.repeat(np.arange(len(texts)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                short = (total - 1) % capacity + 1  # length of the first piece
                length = np.where(piece == 0, short[doc], capacity)
                start = np.where(piece == 0, 0, short[doc] + (piece - 1) * capacity)
                at = first[doc] + start
                crc = [
                    zlib.crc32(flat[a:b])
                    for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        names.slice(row, len(texts)).take(pa.array(doc)),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def pieces_of(
    docs: DataFrame, name: str, spaces: bool, end_id: int, capacity: int = CAPACITY
) -> DataFrame:
    """Pieces of all documents (doc_id, text): place, length and checksum of their ids."""
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        _pieces(name, spaces, end_id, capacity), PIECE_SCHEMA
    )


def _packed(capacity: int, most: int, fields: list[str], round_no: int):
    """Adds to each row: bin (unique over tasks and rounds), place in it, and whether the bin was
    open at the end, with its fill, on the row that is the first of its bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = BestFit(capacity, most)
        base = (round_no << 56) + (TaskContext.get().partitionId() << 32)
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            # Longest first among ``most`` rows: so many open bins can take, none closes early.
            order = np.lexsort((-lengths, np.arange(len(lengths)) // most))
            placed = np.empty((2, len(lengths)), dtype=np.int64)
            for k in order.tolist():
                placed[:, k] = packer.add(int(lengths[k]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(f) for f in fields]
                + [pa.array(placed[0] + base), pa.array(placed[1]), pa.nulls(len(lengths), pa.int64())],
                names=[*fields, "bin", "offset", "fill"],
            )
        rest = packer.left_open()
        if rest:
            bins = pa.array(np.fromiter(rest, np.int64, len(rest)) + base)
            fill = pa.array(np.fromiter(rest.values(), np.int64, len(rest)))
            none = [pa.nulls(len(rest), batch.schema.field(f).type) for f in fields]
            yield pa.RecordBatch.from_arrays(
                [*none, bins, pa.nulls(len(rest), pa.int64()), fill],
                names=[*fields, "bin", "offset", "fill"],
            )

    return run


def _round(items: DataFrame, capacity: int, most: int, round_no: int) -> tuple[DataFrame, DataFrame]:
    """Packed items, and the bins left open (bin, length)."""
    fields = items.columns
    schema = ", ".join(f"{n} {t}" for n, t in items.dtypes) + ", bin bigint, offset bigint, fill bigint"
    out = keep(items.mapInArrow(_packed(capacity, most, fields, round_no), schema), "packed").df
    return (
        out.where(F.col("fill").isNull()).drop("fill"),
        out.where(F.col("fill").isNotNull()).select("bin", F.col("fill").alias("length")),
    )


def pack(items: DataFrame, capacity: int = CAPACITY, most: int = OPEN) -> DataFrame:
    """``items`` (any columns, ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    ``items`` must give the same rows in the same order each time it is read: a written table.
    Columns of ``items`` named bin, offset, fill or sequence_id are not carried.
    """
    own = [c for c in items.columns if c not in ("bin", "offset", "fill", "sequence_id")]
    packed, rest = _round(items.select(*own), capacity, most, 0)
    moved, round_no = None, 0  # where a bin of the first round ended: bin, sequence_id, base
    while True:
        tasks, round_no = max(1, -(-rest.count() // (FAN_IN * most))), round_no + 1
        again, rest = _round(
            rest.withColumnRenamed("bin", "item").coalesce(tasks), capacity, most, round_no
        )
        step = again.select("item", F.col("bin").alias("to"), F.col("offset").alias("shift"))
        if moved is None:
            moved = step.select(
                F.col("item").alias("bin"), F.col("to").alias("sequence_id"), F.col("shift").alias("base")
            )
        else:
            moved = moved.join(step, F.col("sequence_id") == F.col("item"), "left").select(
                "bin",
                F.coalesce("to", "sequence_id").alias("sequence_id"),
                (F.col("base") + F.coalesce("shift", F.lit(0))).alias("base"),
            )
        if tasks == 1:
            break
    return packed.join(moved, "bin", "left").select(
        *own,
        F.coalesce("sequence_id", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"),
    )


def pack_documents(
    docs: DataFrame, name: str, spaces: bool, end_id: int, capacity: int = CAPACITY
) -> DataFrame:
    """Sequences for all documents: tokens once, then packing of their lengths."""
    pieces = keep(pieces_of(docs, name, spaces, end_id, capacity), "pieces").df
    return pack(pieces, capacity)
