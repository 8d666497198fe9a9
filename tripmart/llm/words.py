"""Words, hashes and shingles of whole Arrow text columns, by numpy on their bytes.

A word is a run of bytes other than the six ASCII white-space characters, which in UTF-8 is a
run of characters other than those. Texts are worked through in blocks of about ``BLOCK`` bytes,
so that temporary arrays stay small however long a batch or a single text is.

Nulls count as empty texts. Hashes have 64 bits; two different words or shingles share one with a
probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK = 1 << 17
SHINGLE = 5

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything in ASCII that is neither a letter nor a digit.
PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32



def white(data: np.ndarray) -> np.ndarray:
    """``WHITE[data]``, by arithmetic on bytes, which is many times faster than a table."""
    return (data - np.uint8(0x09) < 5) | (data == 0x20)


def lowered(data: np.ndarray) -> np.ndarray:
    """``LOWER[data]``, likewise."""
    capital = data - np.uint8(0x41) < 26
    return data | (capital.view(np.uint8) << np.uint8(5))


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    """base**0 ... base**(count - 1) modulo 2**64."""
    out = np.ones(count, dtype=np.uint64)
    done = 1
    while done < count:
        step = min(done, count - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


_UP = _powers(_BASE, 2 * BLOCK)
_DOWN = _powers(_INVERSE, 2 * BLOCK)


def _power_tables(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers for ``count`` places; only a block with a word longer than BLOCK needs more."""
    if count <= len(_UP):
        return _UP, _DOWN
    return _powers(_BASE, count), _powers(_INVERSE, count)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers over the whole word (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Texts(NamedTuple):
    """The bytes of some texts, and where each begins; ``offsets`` has one entry more."""

    data: np.ndarray
    offsets: np.ndarray

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()

    def __len__(self) -> int:
        return len(self.offsets) - 1


def texts_of(column: pa.Array) -> Texts:
    """The buffers of a string column without a copy, unless it holds nulls."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return Texts(np.empty(0, np.uint8), np.zeros(1, np.int64))
    wide = pa.types.is_large_string(column.type)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    base = offsets[0]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return Texts(whole[base : offsets[-1]], offsets - base)


def slices(texts: Texts, size: int) -> Iterator[tuple[int, Texts]]:
    """Consecutive rows of about ``size`` bytes together, with the number of the first row."""
    row, rows = 0, len(texts)
    while row < rows:
        end = int(np.searchsorted(texts.offsets, texts.offsets[row] + size, "right")) - 1
        end = min(max(end, row + 1), rows)
        lo, hi = texts.offsets[row], texts.offsets[end]
        yield row, Texts(texts.data[lo:hi], texts.offsets[row : end + 1] - lo)
        row = end


def cuts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about BLOCK bytes that end where white space begins or between two texts.

    A longer word or run of white space makes a longer range: neither is cut.
    """
    at, size = 0, len(data)
    while at < size:
        end = min(at + BLOCK, size)
        if end < size:
            k = int(np.searchsorted(offsets, end))
            limit = int(offsets[k]) if k < len(offsets) else size
            look = 1 << 10
            while end < limit:
                white = WHITE[data[end - 1 : min(end + look, limit)]]
                turn = white[1:] & ~white[:-1]
                if turn.any():
                    end += int(turn.argmax())
                    break
                end += len(turn)
                look *= 2
        yield at, end
        at = end


def spans(
    data: np.ndarray, begins: np.ndarray, between: np.ndarray = WHITE
) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word; ``begins`` marks bytes at which a text begins."""
    inside = ~(white(data) if between is WHITE else between[data])
    first = inside.copy()
    first[1:] &= ~inside[:-1] | begins[1:]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | begins[1:]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def begin_marks(offsets: np.ndarray, at: int, end: int) -> np.ndarray:
    marks = np.zeros(end - at, dtype=bool)
    lo, hi = np.searchsorted(offsets, [at, end])
    marks[offsets[lo:hi] - at] = True
    return marks


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span."""
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    raw = (total[ends] - total[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(np.uint64))


class Words(NamedTuple):
    """All words of some texts; words of text r are ``first[r]:first[r + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray


def words_of(texts: Texts, lower: bool = True, between: np.ndarray = WHITE) -> Words:
    """Places and hashes of all words; with ``lower`` the hashes ignore the case of A-Z.

    ``between`` marks the bytes between words; it includes white space.
    """
    parts = []
    for at, end in cuts(texts.data, texts.offsets):
        data = texts.data[at:end]
        starts, ends = spans(data, begin_marks(texts.offsets, at, end), between)
        hashes = span_hashes(lowered(data) if lower else data, starts, ends)
        parts.append((starts + at, ends + at, hashes))
    if not parts:
        none = np.empty(0, np.int64)
        return Words(none, none, none.astype(np.uint64), np.zeros(len(texts.offsets), np.int64))
    starts, ends, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
    return Words(starts, ends, hashes, np.searchsorted(starts, texts.offsets))


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` consecutive hashes."""
    count = max(len(hashes) - length + 1, 0)
    out = np.zeros(count, dtype=np.uint64)
    for k in range(length):
        place = pow(0xD1342543DE82EF95, k + 1, 1 << 64)
        out += hashes[k : k + count] * np.uint64(place)
    return mix(out)


def shingles(hashes: np.ndarray, length: int = SHINGLE) -> np.ndarray:
    """Hashes of a text's shingles in order, repeats included.

    With fewer than ``length`` words the whole sequence is one; without words there is none.
    """
    if not len(hashes):
        return hashes
    return windows(hashes, min(length, len(hashes)))


def segment_hashes(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of the bytes between each two neighbouring ``bounds`` (ascending), however long."""
    bounds = np.asarray(bounds, dtype=np.int64)
    total = np.zeros(len(bounds), dtype=np.uint64)  # prefix sums at the bounds
    down = np.ones(len(bounds), dtype=np.uint64)
    carry, done = 0, 0
    for at in range(0, len(data) + 1, BLOCK):
        block = data[at : at + BLOCK]
        sums = np.zeros(len(block) + 1, dtype=np.uint64)
        np.cumsum((block.astype(np.uint64) + np.uint64(1)) * _UP[: len(block)], out=sums[1:])
        upto = int(np.searchsorted(bounds, at + len(block), "right"))
        here = bounds[done:upto] - at
        scale = pow(_BASE, at, 1 << 64)
        total[done:upto] = np.uint64(carry) + sums[here] * np.uint64(scale)
        down[done:upto] = _DOWN[here] * np.uint64(pow(_INVERSE, at, 1 << 64))
        carry = (carry + int(sums[-1]) * scale) % (1 << 64)
        done = upto
    return mix((total[1:] - total[:-1]) * down[:-1] + np.diff(bounds).astype(np.uint64))
