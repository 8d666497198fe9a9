"""Benchmark decontamination by SimHash over windows as long as the items.

Words are runs of letters, digits and characters outside ASCII, in lower case for A-Z. Each item
has a 64-bit SimHash of its five-word shingles, weighted by their counts, and each window of a
document that is as long as an item (the whole document, if that is shorter) has one too. A window
without any shingle of an item of its length cannot be similar to one and gets no fingerprint.

Two fingerprints within ``RADIUS`` bits agree up to ``RADIUS // 4`` bits in one of four 16-bit
blocks. For each block, the index lists the items near each of the 65,536 values, so the look-up
finds every item within the radius. Then fingerprints are compared in full, and at last the
weighted Jaccard similarity of the shingle counts is computed exactly and must reach
``SIMILARITY``. At a similarity of 0.8, a bit differs with a probability of 0.15, so the radius of
19 loses one window in some thousands at the very threshold and practically none above it.

The item table is sent to the tasks in blocks of at most ``ITEMS`` rows and ``ITEM_CHARS``
characters, one pass over the documents for each. Documents are neither shuffled nor collected.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm import words
from tripmart.llm.binary import TEXT_BYTES

SIMILARITY = 0.8
RADIUS = 19
BLOCKS, BLOCK_BITS = 4, 16
#: Items of one index.
ITEMS = 1000
#: Characters of their texts beyond which no further item goes into an index.
ITEM_CHARS = 16 << 20
#: Windows fingerprinted at once.
WINDOWS = 1 << 15

_BITS = np.arange(64, dtype=np.uint64)


def _signs(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each hash."""
    return ((hashes[:, None] >> _BITS) & np.uint64(1)).astype(np.int32) * 2 - 1


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(np.uint64) << _BITS).sum(axis=1, dtype=np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """Fingerprint of shingle hashes; repeats weigh as often as they occur."""
    return int(_fingerprints(_signs(hashes).sum(axis=0, keepdims=True))[0])


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the smaller over sum of the larger counts of each shingle."""
    both, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    left = np.bincount(inverse[: len(a)], minlength=len(both))
    right = np.bincount(inverse[len(a) :], minlength=len(both))
    return float(np.minimum(left, right).sum() / np.maximum(left, right).sum())


class Index(NamedTuple):
    """Items of one block of the item table; all that a task needs."""

    names: np.ndarray
    known: np.ndarray  # which names are not null
    length: np.ndarray  # words
    shingles: list[np.ndarray]
    fingerprint: np.ndarray
    tokens: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # by shingle length
    first: np.ndarray  # (block, value) -> where its items begin in ``near``
    near: np.ndarray


def _masks(bits: int, most: int) -> np.ndarray:
    """All numbers of ``bits`` bits with at most ``most`` of them set."""
    return np.array(
        [
            sum(1 << b for b in some)
            for k in range(most + 1)
            for some in itertools.combinations(range(bits), k)
        ],
        dtype=np.int64,
    )


def build_index(names: list[int | None], texts: list[str | None]) -> Index:
    """Index of items; items without a word are left out, as nothing can hold them."""
    found = words.words_of(words.texts_of(pa.array(texts, pa.string())), True, words.PUNCTUATION)
    each = [found.hashes[a:b] for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
    rows = [k for k, w in enumerate(each) if len(w)]
    shingles = [words.shingles(each[k]) for k in rows]
    length = np.array([len(each[k]) for k in rows], dtype=np.int64)
    prints = np.array([simhash(s) for s in shingles], dtype=np.uint64)
    tokens = {}
    for size in np.unique(np.minimum(length, words.SHINGLE)).tolist():
        own = [k for k in range(len(rows)) if min(length[k], words.SHINGLE) == size]
        flat = np.concatenate([np.unique(shingles[k]) for k in own])
        item = np.repeat(own, [len(np.unique(shingles[k])) for k in own])
        order = np.argsort(flat, kind="stable")
        low = np.zeros(1 << 16, dtype=bool)
        low[(flat & np.uint64(0xFFFF)).astype(np.int64)] = True
        tokens[size] = (flat[order], item[order], low)
    masks = _masks(BLOCK_BITS, RADIUS // BLOCKS)
    number = np.int16 if len(rows) < 1 << 15 else np.int32
    first, near = [np.zeros(1, np.int64)], []
    for block in range(BLOCKS):
        value = (prints >> np.uint64(block * BLOCK_BITS)).astype(np.int64) & 0xFFFF
        close = (value[:, None] ^ masks).reshape(-1)
        order = np.argsort(close, kind="stable")
        near.append(np.repeat(np.arange(len(rows), dtype=number), len(masks))[order])
        ends = np.searchsorted(close[order], np.arange(1 << BLOCK_BITS), "right")
        first.append(ends + first[-1][-1])
    return Index(
        np.array([names[k] or 0 for k in rows], dtype=np.int64),
        np.array([names[k] is not None for k in rows], dtype=bool),
        length,
        shingles,
        prints,
        tokens,
        np.concatenate(first),
        np.concatenate(near),
    )


def _near(index: Index, prints: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, item) for all items of that length within the radius of a window."""
    windows, items = [], []
    for block in range(BLOCKS):
        value = (prints >> np.uint64(block * BLOCK_BITS)).astype(np.int64) & 0xFFFF
        at = index.first[(block << BLOCK_BITS) + value]
        count = index.first[(block << BLOCK_BITS) + value + 1] - at
        row = np.repeat(np.arange(len(prints)), count)
        place = np.repeat(at - (np.cumsum(count) - count), count) + np.arange(count.sum())
        item = index.near[place].astype(np.int64)
        own = index.length[item] == length
        windows.append(row[own])
        items.append(item[own])
    pairs = np.unique(np.concatenate(windows) * len(index.length) + np.concatenate(items))
    row, item = np.divmod(pairs, len(index.length))
    differ = np.bitwise_count(prints[row] ^ index.fingerprint[item])
    close = differ <= RADIUS
    return row[close], item[close]


class Leak(NamedTuple):
    row: int
    item: int
    similarity: float
    first_word: int
    n_words: int


def _in_document(index: Index, size: int, hashes: np.ndarray, hit: np.ndarray, hits) -> Iterator:
    """(item, similarity, first word, words) of each similar window of one document.

    ``hashes``: its shingles of ``size`` words; ``hit``: places of those that items have, with the
    items at the same places of ``hits``.
    """
    for length in np.unique(index.length[hits]).tolist():
        if min(length, words.SHINGLE) != size:
            continue
        count = min(length - size + 1, len(hashes))
        own = np.unique(hit[index.length[hits] == length])
        marks = np.zeros(len(hashes) + 1, dtype=np.int64)
        marks[own + 1] = 1
        marks = np.cumsum(marks)
        starts = np.flatnonzero(marks[count:] - marks[: len(marks) - count] > 0)
        for k in range(0, len(starts), WINDOWS):
            some = starts[k : k + WINDOWS]
            for part in np.split(some, np.flatnonzero(np.diff(some) > count) + 1):
                low = part[0]
                signs = _signs(hashes[low : part[-1] + count])
                sums = np.zeros((len(signs) + 1, 64), dtype=np.int32)
                np.cumsum(signs, axis=0, out=sums[1:])
                prints = _fingerprints(sums[part - low + count] - sums[part - low])
                for w, item in zip(*_near(index, prints, length), strict=True):
                    start = int(part[w])
                    like = weighted_jaccard(hashes[start : start + count], index.shingles[item])
                    if like >= SIMILARITY:
                        yield int(item), like, start, count + size - 1


def find_leaks(index: Index, column: pa.Array) -> list[Leak]:
    """The best window of each (text, item) that are similar; the first one among equals."""
    best: dict[tuple[int, int], Leak] = {}
    for row, texts in words.slices(words.texts_of(column), TEXT_BYTES):
        found = words.words_of(texts, True, words.PUNCTUATION)
        for size, (tokens, items, low) in index.tokens.items():
            hashes = words.windows(found.hashes, size)
            at = np.flatnonzero(low[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
            doc = np.searchsorted(found.first, at, "right") - 1
            begin = np.searchsorted(tokens, hashes[at], "left")
            many = np.searchsorted(tokens, hashes[at], "right") - begin
            many[at + size > found.first[doc + 1]] = 0  # reaches into the next text
            place = np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(many.sum())
            at, doc, item = np.repeat(at, many), np.repeat(doc, many), items[place]
            cut = np.flatnonzero(np.diff(doc)) + 1
            for d, hit, hits in zip(
                doc[np.append(0, cut)] if len(doc) else [],
                np.split(at, cut),
                np.split(item, cut),
                strict=False,
            ):
                lo, hi = found.first[d], found.first[d + 1] - size + 1
                for one, like, start, n in _in_document(index, size, hashes[lo:hi], hit - lo, hits):
                    key = (row + int(d), one)
                    if key not in best or like > best[key].similarity:
                        best[key] = Leak(row + int(d), one, like, start, n)
    return [best[k] for k in sorted(best)]


def _indexes(benchmark: DataFrame, most: int, chars: int = ITEM_CHARS) -> list:
    """Broadcast indexes of the distinct items: at most ``most`` each, and ``chars`` of text.

    Items come to the driver by hash, about one index at a time; an item longer than ``chars`` has an
    index of its own.
    """
    context = benchmark.sparkSession.sparkContext
    items = benchmark.select(F.col("item_id").cast("bigint"), "text").distinct()
    size = F.coalesce(F.sum(F.length("text")), F.lit(0))
    count, total = items.agg(F.count(F.lit(1)), size).first()
    blocks = max(-(-count // most), -(-total // chars)) * 2 - 1  # room for uneven hashes
    out = []

    def send(rows: list) -> None:
        index = build_index([r.item_id for r in rows], [r.text for r in rows])
        if len(index.length):
            out.append(context.broadcast(index))

    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        some, held = [], 0
        for row in own.orderBy("item_id", "text").collect():
            more = len(row.text or "")
            if some and (len(some) == most or held + more > chars):
                send(some)
                some, held = [], 0
            some.append(row)
            held += more
        send(some)
    return out


LEAK_SCHEMA = "doc_id bigint, item_id bigint, similarity double, first_word bigint, n_words bigint"


def leaks(docs: DataFrame, benchmark: DataFrame, items: int = ITEMS) -> DataFrame:
    """A row for each document row and item that are similar: the best window, the first of equals.

    ``docs`` (doc_id, text) and ``benchmark`` (item_id, text); other columns are ignored, ids may
    be null and are then null in the result, repeated documents are reported each, repeated items
    once. Null, empty and wordless texts match nothing; an item of fewer than five words is one
    shingle.
    """

    def run(shared):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                found = find_leaks(index, batch.column("text"))
                which = np.array([x.item for x in found], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array([x.row for x in found], pa.int64())),
                        pa.array(index.names[which], mask=~index.known[which]),
                        pa.array([x.similarity for x in found], pa.float64()),
                        pa.array([x.first_word for x in found], pa.int64()),
                        pa.array([x.n_words for x in found], pa.int64()),
                    ],
                    names=["doc_id", "item_id", "similarity", "first_word", "n_words"],
                )

        return search

    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    out = docs.sparkSession.createDataFrame([], LEAK_SCHEMA)
    for shared in _indexes(benchmark, items):
        out = out.union(texts.mapInArrow(run(shared), LEAK_SCHEMA))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, items: int = ITEMS) -> DataFrame:
    """``docs`` with all its columns, without the rows whose text holds an item.

    Nothing is shuffled or joined: each task drops the rows in which it finds an item.
    """

    def run(shared):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                found = find_leaks(shared.value, batch.column(batch.schema.names.index("text")))
                clean[[x.row for x in found]] = False
                yield batch.filter(pa.array(clean))

        return search

    for shared in _indexes(benchmark, items):
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema])
        docs = docs.mapInArrow(run(shared), schema)
    return docs
