"""Token ids of whole texts by the ``tokenizers`` library, with a memo of the pieces met so far.

Public byte-pair tokenizers cut a text into small pieces before they merge anything, and no piece
spans a change from a visible character to white space. So a text is cut there, by numpy, and the
library is asked only for pieces that this worker process has not met before. The ids are those
of the library for the whole text; the tests hold them against it.

``encode_special_tokens`` is on: the names of special tokens in a text are ordinary text.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tripmart.llm import words

#: Pieces that the memo of one worker holds at most; then it starts anew.
MEMO = 3_000_000
_SLOTS = 1 << 22
_SHIFT = np.uint64(64 - 22)

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_POINT = np.zeros(256, dtype=bool)
_POINT[[ord(","), ord(".")]] = True


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: itself if it is printable in
    Latin-1, else the next one from U+0100 on."""
    out, spare = {}, 0x100
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b:
            out[b] = chr(b)
        else:
            out[b] = chr(spare)
            spare += 1
    return out


_LETTERS = _byte_letters()


class Encoded(NamedTuple):
    """Ids of some texts; those of text r are ``ids[first[r]:first[r + 1]]``."""

    ids: np.ndarray
    first: np.ndarray


class Encoder:
    """``name``: a file of the public tokenizers. ``spaces``: white space belongs to the pieces
    (byte-level vocabularies) or is dropped (those with word ends, which lower the case)."""

    def __init__(self, name: str, spaces: bool):
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.spaces = spaces
        self.size = self.tokenizer.get_vocab_size()
        self._points: dict[bytes, list[int]] = {}
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(_SLOTS, dtype=np.uint64)
        self.place = np.zeros(_SLOTS, dtype=np.int64)
        self.count = np.zeros(_SLOTS, dtype=np.int32)
        self.ids = np.empty(1 << 20, dtype=np.min_scalar_type(self.size))
        self.used = self.known = 0

    # Cutting

    def _cut(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each piece; commas and full stops at the end of a word stand alone."""
        white = words.WHITE[data]
        after = np.ones(len(data), dtype=bool)  # white space or the end of a text follows
        after[:-1] = white[1:] | begins[1:]
        alone = _POINT[data] & after
        alone[0] = False
        alone[1:] &= _LETTER[data[:-1]] & ~begins[1:]
        if self.spaces:
            first = begins | alone
            first[0] = True
            first[1:] |= white[1:] & ~white[:-1]
            starts = np.flatnonzero(first)
            return starts, np.append(starts[1:], len(data))
        first = ~white
        first[1:] &= white[:-1] | begins[1:] | alone[1:]
        last = ~white & after
        last[:-1] |= alone[1:]
        return np.flatnonzero(first), np.flatnonzero(last) + 1

    def _odd(self, texts: words.Texts) -> np.ndarray:
        """Rows with white space outside ASCII, for which cutting at ASCII alone is not safe."""
        d = texts.data
        if not self.spaces or not len(d):
            return np.empty(0, np.int64)
        padded = np.append(d, np.zeros(2, np.uint8))
        found = [np.flatnonzero((d >= 0x1C) & (d <= 0x1F))]
        for lead, after in (
            (0xC2, lambda b, c: (b == 0x85) | (b == 0xA0)),
            (0xE1, lambda b, c: (b == 0x9A) & (c == 0x80)),
            (
                0xE2,
                lambda b, c: ((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)))
                | ((b == 0x81) & (c == 0x9F)),
            ),
            (0xE3, lambda b, c: (b == 0x80) & (c == 0x80)),
        ):
            at = np.flatnonzero(d == lead)
            found.append(at[after(padded[at + 1], padded[at + 2])])
        return np.unique(np.searchsorted(texts.offsets, np.concatenate(found), "right") - 1)

    # Asking the library

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _word(self, raw: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize(raw.decode("latin-1").translate(_LETTERS))]

    def _new(self, piece: bytes) -> list[int]:
        """Ids of one piece: a lone word of letters goes straight to the library's merge model."""
        text = piece.decode()
        if self.spaces:
            if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
                return self._word(piece)
        elif text.isalpha() and max(text) <= "ɏ" and "İ" not in text:
            return self._word(text.lower().encode())
        if len(piece) < 3:
            if piece not in self._points:
                self._points[piece] = self._whole(text)
            return self._points[piece]
        return self._whole(text)

    # The memo: an open hash table of piece hashes

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each hash, or -1."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        rest, at = np.arange(len(hashes)), (hashes >> _SHIFT).astype(np.int64)
        while len(rest):
            key = self.keys[at]
            hit = key == hashes[rest]
            out[rest[hit]] = at[hit]
            on = ~hit & (key != 0)
            rest, at = rest[on], (at[on] + 1) & (_SLOTS - 1)
        return out

    def _add(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        ids = [self._new(p) for p in pieces]
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for y in ids for x in y), self.ids.dtype, int(count.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.append(self.ids, np.empty_like(self.ids))
        self.ids[self.used : self.used + len(flat)] = flat
        place = self.used + np.cumsum(count) - count
        self.used += len(flat)
        self.known += len(ids)
        rest, at = np.arange(len(hashes)), (hashes >> _SHIFT).astype(np.int64)
        while len(rest):
            free = np.flatnonzero(self.keys[at] == 0)
            _, which = np.unique(at[free], return_index=True)
            took = free[which]
            row = rest[took]
            self.keys[at[took]], self.place[at[took]] = hashes[row], place[row]
            self.count[at[took]] = count[row]
            left = np.ones(len(rest), dtype=bool)
            left[took] = False
            rest, at = rest[left], (at[left] + 1) & (_SLOTS - 1)

    def _pieces(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and slot of each piece of a block."""
        starts, ends = self._cut(data, begins)
        hashes = words.span_hashes(data if self.spaces else words.LOWER[data], starts, ends)
        hashes[hashes == 0] = 1
        slots = self._find(hashes)
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            new, which = np.unique(hashes[missing], return_index=True)
            if self.known + len(new) > MEMO:
                self._clear()
                new, which = np.unique(hashes, return_index=True)
                missing = np.arange(len(hashes))
            raw = data.tobytes()
            rows = missing[which]
            self._add(new, [raw[a:b] for a, b in zip(starts[rows].tolist(), ends[rows].tolist())])
            slots[missing] = self._find(hashes[missing])
        return starts, slots

    def encode(self, texts: words.Texts) -> Encoded:
        """Ids of all texts, each whole; an empty text has none."""
        parts, counts = [], np.zeros(len(texts) + 1, dtype=np.int64)
        for at, end in words.cuts(texts.data, texts.offsets):
            data = texts.data[at:end]
            starts, slots = self._pieces(data, words.begin_marks(texts.offsets, at, end))
            count = self.count[slots].astype(np.int64)
            ahead = np.cumsum(count) - count
            total = int(count.sum())
            parts.append(self.ids[np.repeat(self.place[slots] - ahead, count) + np.arange(total)])
            row = np.searchsorted(texts.offsets, starts + at, "right") - 1
            counts[1:] += np.bincount(row, count, len(texts)).astype(np.int64)
        ids = np.concatenate(parts) if parts else np.empty(0, self.ids.dtype)
        first = np.cumsum(counts)
        odd = self._odd(texts)
        if not len(odd):
            return Encoded(ids, first)
        each = np.split(ids, first[1:-1])
        for row in odd.tolist():
            each[row] = np.array(self._whole(texts.text(row).decode()), dtype=ids.dtype)
        return Encoded(np.concatenate(each), np.cumsum([0, *map(len, each)]))


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(name: str, spaces: bool) -> Encoder:
    """The encoder of this worker process, with what its memo holds from earlier batches."""
    key = (name, spaces)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(name, spaces)
    return _ENCODERS[key]
