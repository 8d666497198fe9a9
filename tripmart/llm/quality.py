"""Quality rules in a short-circuit cascade.

A rule looks at some texts and says which it rejects. On a sample, the next rule is each time the
one with most rejections per second, given what the rules before it have left and worked out; in
that order they run, and each sees only the texts that are left. A text is kept if no rule rejects
it, so the order, and with it the sample and the clock, moves work but never a verdict.

Words are ``[^\\x20\\x09-\\x0D]+``. Work that rules share (words, letters, lines) is done once a
batch of texts, when the first rule asks for it, and handed on with the texts that are left.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm import words
from tripmart.llm.binary import TEXT_BYTES

#: Words in the windows that count as repeated.
WINDOW = 8
#: Rows of the sample on which costs and selectivities are measured.
SAMPLE_ROWS = 2000

_SYMBOL = np.zeros(256, dtype=np.int8)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_UPPER = np.zeros(256, dtype=np.int8)
_UPPER[0x41:0x5B] = 1
_LOWER = np.zeros(256, dtype=np.int8)
_LOWER[0x61:0x7B] = 1
_DIGIT = np.zeros(256, dtype=np.int8)
_DIGIT[0x30:0x3A] = 1
_IN_WORD = (~words.WHITE).astype(np.int8)
_IN_WORD[0x80:0xC0] = 0  # the later bytes of a character


class Context:
    """Some texts, and what has been worked out about them so far."""

    def __init__(self, texts: words.Texts):
        self.texts = texts

    def __len__(self) -> int:
        return len(self.texts)

    def has_words(self) -> bool:
        """Whether the words of these texts, or of more, are known."""
        return "words" in self.__dict__

    def fork(self) -> Context:
        """The same texts and results; what is worked out on it does not come back."""
        out = Context.__new__(type(self))
        out.__dict__.update(self.__dict__)
        return out

    def rows(self, chosen: np.ndarray) -> Context:
        """Only those texts, with what is known of them."""
        return self if chosen.all() else _Rest(self, chosen)

    def _per_text(self, table: np.ndarray) -> np.ndarray:
        """Sum of a table's values over the bytes of each text."""
        out = np.zeros(len(self.texts), dtype=np.int64)
        if len(self.texts.data):
            filled = np.diff(self.texts.offsets) > 0
            at = self.texts.offsets[:-1][filled]
            out[filled] = np.add.reduceat(table[self.texts.data], at, dtype=np.int64)
        return out

    @cached_property
    def words(self) -> words.Words:
        return words.words_of(self.texts, lower=False)

    @cached_property
    def n_words(self) -> np.ndarray:
        return np.diff(self.words.first)

    @cached_property
    def word_chars(self) -> np.ndarray:
        return self._per_text(_IN_WORD)

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self._per_text(_SYMBOL)

    @cached_property
    def n_upper(self) -> np.ndarray:
        return self._per_text(_UPPER)

    @cached_property
    def n_lower(self) -> np.ndarray:
        return self._per_text(_LOWER)

    @cached_property
    def n_digits(self) -> np.ndarray:
        return self._per_text(_DIGIT)

    @cached_property
    def n_stutters(self) -> np.ndarray:
        """Words equal to the word before."""
        hashes, first = self.words.hashes, self.words.first
        same = np.append(False, hashes[1:] == hashes[:-1])[: len(hashes)]
        same[first[:-1][first[:-1] < len(hashes)]] = False
        total = np.append(0, np.cumsum(same))
        return total[first[1:]] - total[first[:-1]]

    @cached_property
    def _lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Number of lines with a word, and of those equal to an earlier one, of each text."""
        data, offsets = self.texts
        after = np.flatnonzero(data == 0x0A)
        bounds = np.unique(np.concatenate([offsets, after, after + 1]))
        hashes = words.segment_hashes(data, bounds)
        bounds = bounds[:-1]
        filled = np.searchsorted(self.words.starts, bounds)
        filled = np.append(filled[1:], len(self.words.starts)) > filled
        text = np.searchsorted(offsets, bounds, "right") - 1
        text, hashes = text[filled], hashes[filled]
        fresh = np.unique(np.stack([text.astype(np.uint64), hashes]), axis=1)[0].astype(np.int64)
        total = np.bincount(text, minlength=len(self.texts))
        return total, total - np.bincount(fresh, minlength=len(self.texts))

    @cached_property
    def n_lines(self) -> np.ndarray:
        return self._lines[0]

    @cached_property
    def n_dup_lines(self) -> np.ndarray:
        return self._lines[1]

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        """Words in windows of ``WINDOW`` words that a text has twice or more."""
        hashes, first = self.words.hashes, self.words.first
        own = words.windows(hashes, WINDOW)
        text = np.searchsorted(first, np.arange(len(own)), "right") - 1
        at = np.flatnonzero(np.arange(len(own)) + WINDOW <= first[text + 1])
        place = words.mix(text[at].astype(np.uint64) + np.uint64(1))
        _, which, count = np.unique(own[at] ^ place, return_inverse=True, return_counts=True)
        again = at[count[which] > 1]
        cover = np.zeros(len(hashes) + 1, dtype=np.int64)
        cover[again] += 1
        np.subtract.at(cover, again + WINDOW, 1)
        inside = np.append(0, np.cumsum(np.cumsum(cover)[:-1] > 0))
        return inside[first[1:]] - inside[first[:-1]]


class _Rest(Context):
    """The texts of a context that are left; bytes and words are copied when a rule asks for them."""

    def __init__(self, whole: Context, chosen: np.ndarray):
        for name, known in whole.__dict__.items():
            if name == "_lines":
                self.__dict__[name] = tuple(x[chosen] for x in known)
            elif name != "chosen" and isinstance(known, np.ndarray):
                self.__dict__[name] = known[chosen]
        if isinstance(whole, _Rest) and not {"texts", "words"} & set(whole.__dict__):
            among = whole.chosen.copy()  # nothing was copied there, so copy from where it came from
            among[among] = chosen
            whole, chosen = whole.whole, among
        self.whole, self.chosen = whole, chosen

    def __len__(self) -> int:
        return int(self.chosen.sum())

    def has_words(self) -> bool:
        return super().has_words() or self.whole.has_words()

    @cached_property
    def texts(self) -> words.Texts:
        size = np.diff(self.whole.texts.offsets)
        return words.Texts(
            self.whole.texts.data[np.repeat(self.chosen, size)],
            np.append(0, np.cumsum(size[self.chosen])),
        )

    @cached_property
    def words(self) -> words.Words:
        if not self.whole.has_words():
            return words.words_of(self.texts, lower=False)
        known = self.whole.words
        size = np.diff(known.first)
        left = np.repeat(self.chosen, size)
        size = size[self.chosen]
        moved = self.texts.offsets[:-1] - self.whole.texts.offsets[:-1][self.chosen]
        moved = np.repeat(moved, size)
        return words.Words(
            known.starts[left] + moved,
            known.ends[left] + moved,
            known.hashes[left],
            np.append(0, np.cumsum(size)),
        )


class Rule(NamedTuple):
    """``rejects`` returns a boolean for each text of a context."""

    name: str
    rejects: Callable[[Context], np.ndarray]


def too_short(c: Context) -> np.ndarray:
    return c.n_words < 20


def repetitive(c: Context) -> np.ndarray:
    return 100 * c.n_repeat_words > 30 * c.n_words


def many_symbols(c: Context) -> np.ndarray:
    """More than three symbols to ten words: markup, tables, noise."""
    return 10 * c.n_symbols > 3 * c.n_words


def repeated_lines(c: Context) -> np.ndarray:
    """More than half of at least ten lines stood before."""
    return (c.n_lines >= 10) & (2 * c.n_dup_lines > c.n_lines)


def stuttering(c: Context) -> np.ndarray:
    """More than half of the words equal the word before."""
    return 2 * c.n_stutters > c.n_words


def odd_word_length(c: Context) -> np.ndarray:
    """Words of fewer than two or more than twenty characters on average."""
    return (c.word_chars < 2 * c.n_words) | (c.word_chars > 20 * c.n_words)


def shouting(c: Context) -> np.ndarray:
    """More capitals than small letters."""
    return c.n_upper > c.n_lower


def mostly_digits(c: Context) -> np.ndarray:
    return 2 * c.n_digits > c.word_chars


BASE = (Rule("too_short", too_short), Rule("repetitive", repetitive))
RULES = (
    *BASE,
    Rule("many_symbols", many_symbols),
    Rule("repeated_lines", repeated_lines),
    Rule("stuttering", stuttering),
    Rule("odd_word_length", odd_word_length),
    Rule("shouting", shouting),
    Rule("mostly_digits", mostly_digits),
)


def ordered(rules: tuple[Rule, ...], texts: words.Texts) -> tuple[Rule, ...]:
    """Rules by rejections per second on these texts, the best first.

    Each place goes to the rule that is best on the texts left there; work that an earlier rule has
    done already costs it nothing.
    """
    chain, left, context = [], list(rules), Context(texts)
    while left:
        worth = {}
        for rule in left:
            start = time.perf_counter()
            rejected = int(rule.rejects(context.fork()).sum())
            worth[rule.name] = rejected / max(time.perf_counter() - start, 1e-9)
        best = min(left, key=lambda r: (-worth[r.name], r.name))
        left.remove(best)
        chain.append(best)
        context = context.rows(~best.rejects(context))
    return tuple(chain)


def cascade(rules: tuple[Rule, ...], context: Context) -> np.ndarray:
    """Which texts no rule rejects; each rule sees only what those before it have left."""
    kept = np.zeros(len(context), dtype=bool)
    left = np.arange(len(context))
    for rule in rules:
        if not len(left):
            break
        fine = ~rule.rejects(context)
        left = left[fine]
        context = context.rows(fine)
    kept[left] = True
    return kept


def plan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> tuple:
    """The rules, ordered by what they do on a sample of about ``rows`` rows, twice that at most.

    Rows are taken by a hash of id and text, so only the sample is moved. The measuring runs in one
    task; only the rules' names come back to the driver.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [x for b in batches for x in b.column("text").to_pylist()]
        found = ordered(rules, words.texts_of(pa.array(texts, pa.string())))
        yield pa.RecordBatch.from_pydict({"name": [r.name for r in found]})

    share = min(rows / max(docs.count(), 1), 1.0)
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40))
    sample = docs.where(place < int(share * (1 << 40))).select("text").limit(2 * rows)
    names = [r.name for r in sample.mapInArrow(measure, "name string").collect()]
    return tuple(sorted(rules, key=lambda r: names.index(r.name))) if names else rules


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VERDICT_SCHEMA = (
    "doc_id bigint, " + ", ".join(f"{m} bigint" for m in MEASURES) + ", base_failed boolean, kept boolean"
)


def verdicts(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures and verdict of each row of ``docs`` (doc_id, text); other columns are ignored.

    A null text has no words, and so is rejected as too short. Null and repeated ids are carried.
    The measures belong to the result, so they cover all texts; the rules take them from there and
    work out the rest only for the texts left. ``rules`` must hold those of ``BASE``.
    """
    chain = plan(docs, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in words.slices(words.texts_of(batch.column("text")), TEXT_BYTES):
                whole = Context(texts)
                measured = [pa.array(getattr(whole, m), pa.int64()) for m in MEASURES]
                failed = too_short(whole) | repetitive(whole)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, len(texts)),
                        *measured,
                        pa.array(failed),
                        pa.array(cascade(chain, whole)),
                    ],
                    names=["doc_id", *MEASURES, "base_failed", "kept"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, VERDICT_SCHEMA)


def accepted(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with all its columns, without the rows that a rule rejects."""
    chain = plan(docs, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.names.index("text"))
            kept = [cascade(chain, Context(t)) for _, t in words.slices(words.texts_of(column), TEXT_BYTES)]
            yield batch.filter(pa.array(np.concatenate([np.empty(0, bool), *kept])))

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema])
    return docs.mapInArrow(run, schema)


#: The measures and all rules, for DuckDB; ids must not be repeated.
ORACLE_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS found,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
words AS (
  SELECT doc_id, len(found) AS n, unnest(found) AS word, generate_subscripts(found, 1) AS place
  FROM texts),
windows AS (
  SELECT doc_id, n, word, place, lag(word) OVER own = word AS same,
         string_agg(word, ' ') OVER (own ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS span
  FROM words WINDOW own AS (PARTITION BY doc_id ORDER BY place)),
counted AS (
  SELECT *, place + 7 <= n
            AND count(*) FILTER (place + 7 <= n) OVER (PARTITION BY doc_id, span) > 1 AS again
  FROM windows),
covered AS (
  SELECT *, bool_or(again) OVER (
              PARTITION BY doc_id ORDER BY place ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS inside
  FROM counted),
sums AS (
  SELECT doc_id, sum(length(word)) AS word_chars, count(*) FILTER (inside) AS n_repeat_words,
         count(*) FILTER (same) AS n_stutters
  FROM covered GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(found) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_stutters, 0) AS n_stutters,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(text, '[^a-z]', '', 'g')) AS n_lower,
         length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits
  FROM texts LEFT JOIN sums USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words
            OR (n_lines >= 10 AND 2 * n_dup_lines > n_lines) OR 2 * n_stutters > n_words
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR n_upper > n_lower OR 2 * n_digits > word_chars) AS kept
FROM judged
"""
