"""A gated recurrent language model with a class-factored softmax, trained in numpy on Spark.

Tokens are words in lower case for A-Z, and one end per document. The commonest words have symbols
of their own; the others share ``BUCKETS`` symbols by their last letters, and within a bucket a
word has its smoothed share of the training counts. A tenth of every probability is the word's
share among all tokens. Symbols, by frequency, fall into classes: the
network predicts the class, then the symbol within it.

Training covers all training documents. A start is fitted to a bounded sample; then every task
trains a replica on all its documents by truncated backpropagation through time, and the replicas
are averaged by their tokens. Documents run in lanes: a lane's state is carried from window to
window and reset where a document begins. Scoring does the same without gradients, so a score is
the log-likelihood of the whole document, however long.

Counts cover all training tokens. The ``KNOWN`` commonest words go to every task; the tokens of
rarer words are joined with their counts by a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm import words
from tripmart.session import keep

CLASSES, PER_CLASS = 64, 64
BUCKETS = 96
SYMBOLS = CLASSES * PER_CLASS
#: Words whose counts are sent to every task.
KNOWN = 1 << 19
HIDDEN = 24
#: Steps of a window, after which gradients are cut, and lanes side by side.
STEPS, LANES = 32, 256
#: The same where nothing is learnt and only speed depends on them: as many tokens in a window.
SCORE_STEPS, SCORE_LANES = 16, 512
#: Rows of the output layer worked on at once.
CACHED = 1 << 10
#: A score is no larger than the weights behind it together, as states are within -1 and 1; beyond
#: this sum, exponentials of scores could leave the range of a float.
STEEP = 60.0
#: Bytes of text made into tokens at once, few enough for the cache; counted at once, and in the
#: lanes at once: many, so that the longest document does not run alone for long.
TEXT_BYTES, COUNT_BYTES, LANE_BYTES = 1 << 18, 4 << 20, 32 << 20
#: Bits of a hash by which the known words are found.
SLOT_BITS = 20
RATE = 0.1
#: Weight of plain word shares in the model's probability, for texts unlike all in training.
SHARES = 0.1
#: Documents of the start, how often it sees them, and its lanes: fewer, for more updates.
START_DOCS, START_ROUNDS, START_LANES = 2000, 3, 128
#: Numbers in one row of a replica on its way to the average, and replicas averaged at once.
CHUNK, FAN_IN = 1 << 14, 64

END = 1  # the end token's hash

#: Bucket of a word by its last letter and, as the higher byte, the one before.
BUCKET_OF = (words.mix(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(BUCKETS)).astype(np.int8)


class Vocabulary(NamedTuple):
    """Counts of the commonest words and what the symbols stand for."""

    hashes: np.ndarray  # sorted
    slots: np.ndarray  # leading bits of a hash -> where such hashes begin
    counts: np.ndarray
    symbols: np.ndarray  # -1: shares its bucket's
    of_bucket: np.ndarray  # symbol of each bucket
    bucket_total: np.ndarray  # smoothed total of a bucket's training tokens
    share: np.ndarray  # of each symbol among training tokens
    total: int
    distinct: int


class Tokens(NamedTuple):
    """Token hashes and buckets of some texts, ends included; ``first`` as for words."""

    hashes: np.ndarray
    buckets: np.ndarray
    first: np.ndarray


def tokens_of(texts: words.Texts) -> Tokens:
    found = words.words_of(texts)
    last = found.ends - 1
    point = words.PUNCTUATION[texts.data[last]] & (last > found.starts)
    last -= point
    letters = words.LOWER[texts.data[last]].astype(np.uint16)
    before = words.LOWER[texts.data[np.maximum(last - 1, 0)]].astype(np.uint16)
    letters |= np.where(last > found.starts, before << np.uint16(8), np.uint16(0))
    rows = len(texts)
    first = found.first + np.arange(rows + 1)
    word = np.ones(len(found.hashes) + rows, dtype=bool)
    word[first[1:] - 1] = False
    hashes = np.full(len(word), END, dtype=np.uint64)
    hashes[word] = found.hashes
    buckets = np.full(len(word), -1, dtype=np.int8)
    buckets[word] = BUCKET_OF[letters]
    return Tokens(hashes, buckets, first)


def is_held_out(doc_id: int | None) -> bool:
    """Whether a document is left out of training; a null id is the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


def _held(batch: pa.RecordBatch) -> np.ndarray:
    return np.array([is_held_out(x) for x in batch.column("doc_id").to_pylist()], dtype=bool)


# Counts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each training word of a batch."""
    for batch in batches:
        held = _held(batch)
        for row, texts in words.slices(words.texts_of(batch.column("text")), COUNT_BYTES):
            found = tokens_of(texts)
            learn = np.repeat(~held[row : row + len(texts)], np.diff(found.first))
            hashes, buckets = found.hashes[learn], found.buckets[learn]
            order = np.argsort(hashes)  # need not be stable: a word has one bucket
            hashes = hashes[order]
            starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes[starts].view(np.int64)),
                    pa.array(buckets[order[starts]].astype(np.int64)),
                    pa.array(np.diff(starts, append=len(hashes))),
                ],
                names=["hash", "bucket", "n"],
            )


def count_words(docs: DataFrame) -> DataFrame:
    """(hash, bucket, n) of all training tokens of ``docs`` (doc_id, text)."""
    found = docs.mapInArrow(_counted, "hash bigint, bucket bigint, n bigint")
    return found.groupBy("hash", "bucket").agg(F.sum("n").alias("n"))


def commonest(counts: DataFrame, most: int) -> DataFrame:
    """The ``most`` commonest words of ``counts``, the smaller hash first among equals.

    Counts are counted first: only words above the cut-off count, and of those at it the ones with
    hashes small enough, are put in order, so no task reads more than about ``most`` rows.
    """
    kinds = counts.groupBy("n").agg(F.count("*").alias("words"))
    above = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("words").over(above), F.lit(0))
    edge = kinds.withColumn("before", before).where(F.col("before") < most).orderBy("n").first()
    if edge is None:
        return counts.limit(0)
    at_edge = F.col("n") == edge.n
    if edge.before + edge.words > most:  # twice as many as wanted and a few, in the order of hashes
        share = min(1.0, (2 * (most - edge.before) + 1000) / edge.words)
        at_edge &= F.col("hash") <= int(-(2**63) + share * (2**64 - 2**12))
    chosen = counts.where((F.col("n") > edge.n) | at_edge)
    return chosen.orderBy(F.desc("n"), "hash").limit(most)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The commonest words, and what is left for the buckets."""
    top = commonest(counts, KNOWN).toArrow()
    hashes, bucket, n = (top[c].to_numpy() for c in ("hash", "bucket", "n"))
    hashes = hashes.view(np.uint64)
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    sums = counts.where("bucket >= 0").groupBy("bucket").agg(F.sum("n"), F.count("*")).collect()
    mass, kinds = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for b, tokens, distinct in sums:
        mass[b], kinds[b] = tokens, distinct
    own = np.zeros(len(hashes), dtype=bool)
    own[: SYMBOLS - BUCKETS - 1] = True  # in the order of counts
    own |= hashes == END
    inside = own & (bucket >= 0)
    mass -= np.bincount(bucket[inside], n[inside], BUCKETS)
    kinds -= np.bincount(bucket[inside], minlength=BUCKETS)
    weight = np.concatenate([n[own], mass, np.zeros(SYMBOLS - BUCKETS - int(own.sum()))])
    rank = np.empty(SYMBOLS, dtype=np.int64)
    rank[np.argsort(-weight, kind="stable")] = np.arange(SYMBOLS)
    symbols = np.full(len(hashes), -1, dtype=np.int64)
    symbols[own] = rank[: int(own.sum())]
    share = np.empty(SYMBOLS)
    share[rank] = (weight + 0.5) / (weight.sum() + 0.5 * SYMBOLS)
    order = np.argsort(hashes)
    return Vocabulary(
        hashes[order],
        slots_of(hashes[order]),
        n[order],
        symbols[order],
        rank[int(own.sum()) : int(own.sum()) + BUCKETS],
        mass + 0.5 * (kinds + 1),
        share,
        int(whole[0]),
        int(whole[1]),
    )


def slots_of(hashes: np.ndarray) -> np.ndarray:
    """Where the sorted ``hashes`` with each of the possible leading bits begin, and their end."""
    leading = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    return np.searchsorted(leading, np.arange((1 << SLOT_BITS) + 1))


def look_up(known: Vocabulary, found: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Symbol of each token, and its training count, or -1 where a task does not know it."""
    symbol = known.of_bucket.take(np.maximum(found.buckets, 0))
    if not len(known.hashes):
        return symbol.astype(np.uint16), np.full(len(symbol), -1, dtype=np.int64)
    slot = (found.hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    at = known.slots.take(slot)
    hit = known.hashes.take(at, mode="clip") == found.hashes
    left = np.flatnonzero(~hit)
    while len(left):  # as often as the fullest slot has words
        at[left] += 1
        left = left[at[left] < known.slots[slot[left] + 1]]
        same = known.hashes[at[left]] == found.hashes[left]
        hit[left[same]] = True
        left = left[~same]
    own = known.symbols.take(at, mode="clip")
    symbol = np.where(hit & (own >= 0), own, symbol)
    return symbol.astype(np.uint16), np.where(hit, known.counts.take(at, mode="clip"), -1)


# The network. Symbol s is number s % PER_CLASS of class s // PER_CLASS.


class Network:
    """Gated recurrent unit: update and reset gates and a candidate state, all of ``HIDDEN``.

    ``x`` has planes for candidate, update and reset, ``u`` for update, reset and candidate: so the
    gradients of the gates stand between those of a step's input and of its state. The last row
    of ``wc`` and of each class's ``ww`` is the bias.
    """

    SHAPES = (
        ("x", (3, SYMBOLS, HIDDEN)),
        ("u", (3, HIDDEN, HIDDEN)),
        ("wc", (HIDDEN + 1, CLASSES)),
        ("ww", (CLASSES, HIDDEN + 1, PER_CLASS)),
    )
    SIZE = sum(int(np.prod(s)) for _, s in SHAPES)

    def __init__(self, flat: np.ndarray):
        self.flat, at = flat, 0
        for name, shape in self.SHAPES:
            size = int(np.prod(shape))
            setattr(self, name, flat[at : at + size].reshape(shape))
            at += size

    @classmethod
    def fresh(cls, share: np.ndarray) -> Network:
        """Small random weights; the output begins at the symbols' shares."""
        rng = np.random.default_rng(7)
        net = cls(np.empty(cls.SIZE, dtype=np.float32))
        by_gate = rng.normal(0, 0.1, (SYMBOLS + HIDDEN, 3, HIDDEN)).transpose(1, 0, 2)
        net.x[:], net.u[:] = by_gate[[2, 0, 1], :SYMBOLS], by_gate[:, SYMBOLS:]
        net.wc[:] = rng.normal(0, 0.1, net.wc.shape)
        net.ww[:, :HIDDEN] = rng.normal(0, 0.1, (CLASSES, HIDDEN, PER_CLASS))
        by_class = share.reshape(CLASSES, PER_CLASS)
        net.wc[HIDDEN] = np.log(by_class.sum(axis=1))
        net.ww[:, HIDDEN] = np.log(by_class / by_class.sum(axis=1, keepdims=True))
        return net

    def step(self, symbols: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """New state, and what a gradient needs: gates with the candidate's recurrent part, and
        the candidate."""
        out = np.empty((3, *h.shape), np.float32), np.empty_like(h), np.empty_like(h)
        self.move(self.x[:, symbols], h, *out)
        return out[::-1]

    def move(self, x: np.ndarray, h: np.ndarray, part: np.ndarray, n: np.ndarray, new: np.ndarray):
        """A step by the planes of the symbols: fills update, reset and recurrent part, candidate
        and new state."""
        np.matmul(h, self.u, out=part)
        gates = part[:2]
        gates += x[1:]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        np.multiply(part[1], part[2], out=n)
        n += x[0]
        np.tanh(n, out=n)
        np.subtract(h, n, out=new)
        new *= part[0]
        new += n

    def outputs(self, h: np.ndarray, target: np.ndarray, grads: Network | None = None):
        """Log-probability of each target; with ``grads``, also the gradient of their negative
        sum by the states, while those of the output weights are added to ``grads``.

        Rows are put in the order of their class, so that a class is a slice of them, and worked
        on in blocks that stay in the cache.
        """
        order = np.argsort((target // PER_CLASS).astype(np.uint8), kind="stable")
        target = target.take(order).astype(np.int64)
        cls, place = target // PER_CLASS, target % PER_CLASS
        states = np.ones((len(h), HIDDEN + 1), dtype=np.float32)
        states[:, :HIDDEN] = h.take(order, axis=0)
        steep = [np.abs(w).sum(axis=-2).max() > STEEP for w in (self.wc, self.ww)]
        likely, by_row = np.empty(len(h), dtype=np.float32), np.empty_like(h)
        for k in range(0, len(h), CACHED):
            rows = slice(k, k + CACHED)
            some, dh = states[rows], by_row[rows]
            ends = np.searchsorted(cls[rows], np.arange(CLASSES + 1)).tolist()
            held = [(c, slice(*x)) for c, x in enumerate(pairwise(ends)) if x[0] < x[1]]
            p = some @ self.wc
            q = np.empty_like(p)
            for c, own in held:
                np.matmul(some[own], self.ww[c], out=q[own])
            likely[rows] = _log_softmax(p, cls[rows], steep[0], grads is not None)
            likely[rows] += _log_softmax(q, place[rows], steep[1], grads is not None)
            if grads is None:
                continue
            grads.wc += some.T @ p
            np.matmul(p, self.wc[:HIDDEN].T, out=dh)
            for c, own in held:
                grads.ww[c] += some[own].T @ q[own]
                dh[own] += q[own] @ self.ww[c, :HIDDEN].T
        out, dh = np.empty_like(likely), np.empty_like(by_row)
        out[order] = likely
        if grads is None:
            return out, None
        dh[order] = by_row
        return out, dh


def _log_softmax(scores: np.ndarray, goal: np.ndarray, steep: bool, gradient: bool) -> np.ndarray:
    """Log-probability of each row's goal. ``scores`` is used up: with ``gradient``, it becomes
    the gradient of their negative sum. If ``steep``, exponentials are taken below a row's largest.
    """
    width = scores.shape[1]
    if steep:
        scores -= scores.max(axis=1, keepdims=True)
    at, flat = np.arange(0, scores.size, width) + goal, scores.reshape(-1)
    value = flat.take(at)
    np.exp(scores, out=scores)
    total = scores @ np.ones(width, dtype=scores.dtype)
    if gradient:
        scores *= (1 / total)[:, None]
        flat[at] -= 1
    return value - np.log(total)


class Lanes(NamedTuple):
    """Tokens of some documents, dealt out to lanes; longest lane first."""

    place: list[np.ndarray]  # lane -> where its tokens stand in the input
    begins: np.ndarray  # for each token of the input: first of its document
    active: np.ndarray  # lanes that have a token, by step


def lanes_of(first: np.ndarray, most: int = LANES) -> Lanes:
    sizes = np.diff(first)
    total = int(first[-1] - first[0])
    count = max(1, min(most, len(sizes)))
    lanes: list[list[int]] = [[] for _ in range(count)]
    held = np.zeros(count, dtype=np.int64)
    for doc in np.argsort(-sizes, kind="stable").tolist():
        k = int(held.argmin())
        lanes[k].append(doc)
        held[k] += sizes[doc]
    begins = np.zeros(total, dtype=bool)
    begins[first[:-1]] = True
    order = np.argsort(-held, kind="stable")
    place = [
        np.concatenate([np.arange(first[d], first[d + 1]) for d in lanes[k]]) if lanes[k] else
        np.empty(0, np.int64)
        for k in order.tolist()
    ]
    lengths = held[order]
    active = np.searchsorted(-lengths, -np.arange(lengths[0] if count else 0), "left")
    return Lanes(place, begins, active)


def _windows(lanes: Lanes, steps: int) -> Iterator[np.ndarray]:
    """(steps, lanes) places of the tokens of one window after the other; -1: none."""
    longest = len(lanes.active)
    for start in range(0, longest, steps):
        width = int(lanes.active[start])
        out = np.full((min(steps, longest - start), width), -1, dtype=np.int64)
        for k in range(width):
            some = lanes.place[k][start : start + steps]
            out[: len(some), k] = some
        yield out


def score_tokens(net: Network, symbols: np.ndarray, first: np.ndarray, end: int) -> np.ndarray:
    """Log-probability of each symbol, given all before it in its document."""
    out = np.zeros(len(symbols), dtype=np.float32)
    if not len(symbols):
        return out
    lanes = lanes_of(first, SCORE_LANES)
    before = np.roll(symbols, 1)
    before[lanes.begins] = end
    h = np.zeros((len(lanes.place), HIDDEN), dtype=np.float32)
    for window in _windows(lanes, SCORE_STEPS):
        h, real = h[: window.shape[1]], _real(window)
        states = np.empty((*window.shape, HIDDEN), dtype=np.float32)
        starts, prior = _starts(lanes, window), before[window]
        part, n = np.empty((3, *h.shape), dtype=np.float32), np.empty_like(h)
        for t in range(len(window)):
            h[starts[t]] = 0
            net.move(net.x.take(prior[t], axis=1), h, part, n, states[t])
            h = states[t].copy()
        places = window.reshape(-1)[real]
        out[places] = net.outputs(states.reshape(-1, HIDDEN)[real], symbols[places])[0]
    return out


def _real(window: np.ndarray) -> slice | np.ndarray:
    """Where a window's places are of tokens: all, if its last, shortest lane has one at the end."""
    return slice(None) if window[-1, -1] >= 0 else np.flatnonzero(window.reshape(-1) >= 0)


def _starts(lanes: Lanes, window: np.ndarray) -> list[np.ndarray]:
    """For each step, the lanes where a document begins and the state before it must go."""
    begins = lanes.begins[window]
    return [np.flatnonzero(row) for row in begins]


def _sums_of_rows(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of ``rows`` and, in each plane, the sum of the values of each."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    rows = rows[order]
    starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    pairs = values.take(order, axis=1).view(np.complex64)  # two numbers are added at once
    return rows[starts], np.add.reduceat(pairs, starts, axis=1).view(np.float32)


def _adagrad(weights: np.ndarray, sums: np.ndarray, grad: np.ndarray, rows=slice(None)) -> None:
    """One step of ``rows``; a row without a gradient would not move, and is best left out."""
    whole = isinstance(rows, slice)
    seen = grad * grad
    seen += sums if whole else sums.take(rows, axis=0)
    sums[rows] = seen
    seen += np.float32(1e-6)
    np.sqrt(seen, out=seen)
    np.divide(grad, seen, out=seen)
    seen *= np.float32(RATE)
    weights[rows] = np.subtract(weights if whole else weights.take(rows, axis=0), seen, out=seen)


def train_tokens(
    net: Network,
    sums: np.ndarray,
    symbols: np.ndarray,
    first: np.ndarray,
    end: int,
    most: int = LANES,
) -> None:
    """One pass of truncated backpropagation; ``sums`` are the squared gradients of Adagrad."""
    if not len(symbols):
        return
    lanes = lanes_of(first, most)
    before = np.roll(symbols, 1)
    before[lanes.begins] = end
    h = np.zeros((len(lanes.place), HIDDEN), dtype=np.float32)
    grads, squares = Network(np.zeros(Network.SIZE, dtype=np.float32)), Network(sums)
    for window in _windows(lanes, STEPS):
        h, real = h[: window.shape[1]], _real(window)
        for name in ("wc", "ww"):
            getattr(grads, name).fill(0)
        shape, starts, prior = (*window.shape, HIDDEN), _starts(lanes, window), before[window]
        states, old, n = (np.empty(shape, dtype=np.float32) for _ in range(3))
        parts = np.empty((len(window), 3, *h.shape), dtype=np.float32)
        for t in range(len(window)):
            old[t] = h
            old[t, starts[t]] = 0
            net.move(net.x.take(prior[t], axis=1), old[t], parts[t], n[t], states[t])
            h = states[t]
        targets, by_state = symbols[window.reshape(-1)[real]], np.zeros_like(states)
        _, by_row = net.outputs(states.reshape(-1, HIDDEN)[real], targets, grads)
        by_state.reshape(-1, HIDDEN)[real] = by_row
        # Gradients by the candidate's input, the two gates and the candidate's recurrent part.
        by_part = np.empty((4, *shape), dtype=np.float32)
        back, some, by_h = np.zeros_like(h), np.empty_like(h), np.empty((3, *h.shape), np.float32)
        across = net.u.transpose(0, 2, 1)
        for t in range(len(window) - 1, -1, -1):  # past a lane's end, all is 0
            (z, r, un), (dn, dz, dr, du), d = parts[t], by_part[:, t], by_state[t]
            d += back
            np.subtract(1, z, out=some)
            np.multiply(d, some, out=dn)
            np.subtract(old[t], n[t], out=dz)
            dz *= z
            dz *= dn
            np.multiply(n[t], n[t], out=some)
            np.subtract(1, some, out=some)
            dn *= some
            np.multiply(dn, r, out=du)
            np.subtract(1, r, out=dr)
            dr *= un
            dr *= du
            np.matmul(by_part[1:, t], across, out=by_h)
            np.multiply(d, z, out=back)
            for plane in by_h:
                back += plane
            back[starts[t]] = 0
        by_part = by_part.reshape(4, -1, HIDDEN)
        np.matmul(old.reshape(-1, HIDDEN).T, by_part[1:], out=grads.u)
        scale = np.float32(len(targets) ** -0.5)
        rows, by_row = _sums_of_rows(prior.reshape(-1), by_part[:3])
        by_row *= scale
        for plane in range(3):
            _adagrad(net.x[plane], squares.x[plane], by_row[plane], rows)
        for name in ("u", "wc"):
            _adagrad(getattr(net, name), getattr(squares, name), getattr(grads, name) * scale)
        held = np.flatnonzero(np.bincount(targets // PER_CLASS, minlength=CLASSES))
        rows = slice(None) if len(held) == CLASSES else held
        _adagrad(net.ww, squares.ww, grads.ww[rows] * scale, rows)


# On Spark

PART_SCHEMA = "part int, task int, tokens bigint, numbers binary"


def _parts(task: int, tokens: int, flat: np.ndarray) -> pa.RecordBatch:
    cut = [flat[k : k + CHUNK].astype("<f4").tobytes() for k in range(0, len(flat), CHUNK)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(len(cut)), pa.int32()),
            pa.array([task] * len(cut), pa.int32()),
            pa.array([tokens] * len(cut), pa.int64()),
            pa.array(cut, pa.binary()),
        ],
        names=["part", "task", "tokens", "numbers"],
    )


def _training(batch: pa.RecordBatch, known: Vocabulary) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Symbols and document bounds of the training documents of a batch, some at a time."""
    batch = batch.filter(pa.array(~_held(batch)))
    for _, some in words.slices(words.texts_of(batch.column("text")), LANE_BYTES):
        symbols, sizes = [], [np.zeros(1, dtype=np.int64)]
        for _, texts in words.slices(some, TEXT_BYTES):
            found = tokens_of(texts)
            symbols.append(look_up(known, found)[0])
            sizes.append(np.diff(found.first))
        yield np.concatenate(symbols), np.cumsum(np.concatenate(sizes))


def _end_symbol(known: Vocabulary) -> int:
    end = Tokens(np.array([END], np.uint64), np.array([0]), np.array([0, 1]))
    return int(look_up(known, end)[0][0])


def _trainer(shared, rounds: int, lanes: int):
    """Trains a replica on all training documents of a task; nothing comes from a task without."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, flat, sums = shared.value
        net, sums, tokens = Network(flat.copy()), sums.copy(), 0
        end = _end_symbol(known)
        held = list(batches) if rounds > 1 else batches
        for k in range(rounds):
            for batch in held:
                for symbols, first in _training(batch, known):
                    train_tokens(net, sums, symbols, first, end, lanes)
                    tokens += len(symbols) * (k == 0)
        if tokens:
            both = np.concatenate([net.flat, sums]) if rounds > 1 else net.flat
            yield _parts(TaskContext.get().partitionId(), tokens, both)

    return run


def _average(table: pa.Table) -> pa.Table:
    """Replicas of one part, averaged by their tokens."""
    tokens = table["tokens"].to_numpy()
    rows = np.stack([np.frombuffer(x, "<f4") for x in table["numbers"].to_pylist()])
    mean = (rows * (tokens / tokens.sum())[:, None]).sum(axis=0)
    return pa.table(
        {
            "part": pa.array([table["part"][0].as_py()], pa.int32()),
            "task": pa.array([table["task"][0].as_py() // FAN_IN], pa.int32()),
            "tokens": pa.array([int(tokens.sum())], pa.int64()),
            "numbers": pa.array([mean.astype("<f4").tobytes()], pa.binary()),
        }
    )


def _collected(parts: DataFrame) -> np.ndarray | None:
    """The numbers of one replica: as many as the network has, whatever the corpus."""
    rows = sorted(parts.select("part", "numbers").collect())
    return np.concatenate([np.frombuffer(r.numbers, "<f4") for r in rows]) if rows else None


def start_sample(docs: DataFrame) -> DataFrame:
    """The ``START_DOCS`` rows of ``docs`` that come first by a hash, however the rows are dealt.

    The hash takes in the text, or repeated and null ids would come together. Only about twice as
    many rows as wanted are put in order.
    """
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(2**30))
    share = int(2 * START_DOCS / max(docs.count(), 1) * 2**30) + 1
    return docs.where(place < share).orderBy(place, "doc_id", "text").limit(START_DOCS)


def fit(docs: DataFrame, known: Vocabulary) -> np.ndarray:
    """Weights learnt from all training documents of ``docs`` (doc_id, text)."""
    context = docs.sparkSession.sparkContext
    net = Network.fresh(known.share)
    zeros = np.zeros(Network.SIZE, dtype=np.float32)
    start = start_sample(docs).mapInArrow(
        _trainer(context.broadcast((known, net.flat, zeros)), START_ROUNDS, START_LANES), PART_SCHEMA
    )
    both = _collected(start)
    if both is None:
        return net.flat
    flat, sums = both[: Network.SIZE].copy(), both[Network.SIZE :].copy()
    shared = context.broadcast((known, flat, sums))
    replicas = docs.mapInArrow(_trainer(shared, 1, LANES), PART_SCHEMA)
    for _ in range(2):  # teams of teams; a few thousand tasks leave one replica
        team = F.floor(F.col("task") / FAN_IN).alias("team")
        replicas = replicas.groupBy("part", team).applyInArrow(_average, PART_SCHEMA)
    return _collected(replicas.groupBy("part").applyInArrow(_average, PART_SCHEMA))


SCORE_SCHEMA = (
    "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
    "base double, model double, hash bigint, times bigint"
)
NAMES = [x.split()[0] for x in SCORE_SCHEMA.split(", ")]
_ARROW = {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
TYPES = [_ARROW[x.split()[1]] for x in SCORE_SCHEMA.split(", ")]


def _scorer(shared):
    """A row for each document, and one for each of its words whose count a task does not know."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, flat = shared.value
        net, end = Network(flat), _end_symbol(known)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            held, done = _held(batch), 0
            for _, some in words.slices(words.texts_of(batch.column("text")), LANE_BYTES):
                parts, flat_symbols, sizes = [], [], [np.zeros(1, dtype=np.int64)]
                for _, texts in words.slices(some, TEXT_BYTES):
                    found = tokens_of(texts)
                    symbol, count = look_up(known, found)
                    size = np.diff(found.first)
                    rare = np.flatnonzero(count < 0)
                    if len(rare):
                        doc = np.searchsorted(found.first, rare, "right") - 1
                        yield rare_words(row + doc, found.hashes[rare])
                    own = (known.of_bucket[np.maximum(found.buckets, 0)] == symbol) & (
                        found.buckets >= 0
                    )
                    parts.append((row, size, count, np.where(own, found.buckets, np.int8(-1))))
                    flat_symbols.append(symbol)
                    sizes.append(size)
                    row += len(size)
                first = np.cumsum(np.concatenate(sizes))
                logs, at = score_tokens(net, np.concatenate(flat_symbols), first, end), 0
                for ids, size, count, bucket in parts:
                    here = logs[at : at + len(count)].astype(np.float64)
                    at += len(count)
                    ends = pa.array(ids + np.arange(len(size)))
                    name = batch.column("doc_id").slice(done, len(size))
                    held_here = held[done : done + len(size)]
                    done += len(size)
                    yield documents(ends, name, held_here, size, here, count, bucket)

    def rare_words(rows: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((hashes, rows))
        rows, hashes = rows[order], hashes[order]
        new = np.append(True, (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1]))
        starts = np.flatnonzero(new)
        columns = [pa.nulls(len(starts), t) for t in TYPES]
        columns[0] = pa.array(rows[starts])
        columns[-2:] = (
            pa.array(hashes[starts].view(np.int64)),
            pa.array(np.diff(starts, append=len(rows))),
        )
        return pa.RecordBatch.from_arrays(columns, names=NAMES)

    def documents(rows, names, held, size, logs, count, bucket) -> pa.RecordBatch:
        known = shared.value[0]
        whole = known.total + 0.5 * (known.distinct + 1)
        sure, own = count >= 0, bucket >= 0
        likely = np.exp(logs)
        # In a bucket, and by shares alone, a word weighs its count and a half.
        weight = np.where(sure, np.log10(np.maximum(count, 0) + 0.5), 0)
        likely /= np.where(own, known.bucket_total.take(np.maximum(bucket, 0)), 1)
        by_share = np.where(own, 1, count + 0.5) / whole
        model = np.log10((1 - SHARES) * likely + SHARES * by_share)
        model += np.where(own & sure, weight, 0)
        base = np.where(sure, weight - np.log10(whole), 0)
        starts = np.cumsum(size) - size  # of documents; each has an end at least
        return pa.RecordBatch.from_arrays(
            [
                rows,
                names,
                pa.array(held),
                pa.array(size),
                pa.array(np.add.reduceat(count > 0, starts, dtype=np.int64)),
                pa.array(np.add.reduceat(base, starts)),
                pa.array(np.add.reduceat(model, starts)),
                *[pa.nulls(len(size), t) for t in TYPES[-2:]],
            ],
            names=NAMES,
        )

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """Learns from the training documents of ``docs`` (doc_id, text) and scores all of them.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (smoothed word shares) and
    score (the model), both log10 over the whole text and its end. Null, empty and wordless texts
    are an end alone. Ids may be null (then in training) or repeated: each row is scored. Other
    columns are ignored. If no document is in training, all tokens are unknown to both. ``score``
    depends on how rows are dealt to tasks, as each task trains a replica.
    """
    spark: SparkSession = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    counts = keep(count_words(docs), "word-counts").df
    known = vocabulary(counts)
    weights = fit(docs, known)
    shared = spark.sparkContext.broadcast((known, weights))
    scored = keep(docs.mapInArrow(_scorer(shared), SCORE_SCHEMA), "scored").df
    whole = known.total + 0.5 * (known.distinct + 1)
    n = F.coalesce(F.col("c.n"), F.lit(0))
    times = F.col("w.times")
    rare = (
        scored.where("times IS NOT NULL")
        .alias("w")
        .join(counts.alias("c"), F.col("w.hash") == F.col("c.hash"), "left")
        .groupBy("w.row")
        .agg(
            F.sum(F.when(n > 0, times).otherwise(0)).alias("more_known"),
            F.sum(times * F.log10((n + 0.5) / F.lit(whole))).alias("more_base"),
            F.sum(times * F.log10(n + 0.5)).alias("more_model"),
        )
    )
    return (
        scored.where("times IS NULL")
        .join(rare, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            F.lit(known.total).cast("bigint").alias("train_tokens"),
            (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
            (F.col("model") + F.coalesce("more_model", F.lit(0.0))).alias("score"),
        )
    )
