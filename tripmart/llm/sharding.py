"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered from 0 in the order of stated columns, by one range shuffle. A Feistel network
on just enough bits permutes the numbers; a result beyond the last row goes through it again
(cycle walking) until it is a row number, which takes two turns on average, as the bits reach at
most twice the rows. The permuted number, split by the count of shards, is the shard and the slot:
shards differ by one row at most, and slots run from 0 without gaps.

Nothing but the row count and the seed is needed to tell where a row goes (``Shuffle.place``) or
which row stands in a slot (``Shuffle.number``), so a reader can resume anywhere without an index.

Rows equal in all ordering columns are interchangeable and spread like any others: equal texts are
not kept together. Nulls come first in the order; an empty table gives an empty one. Columns named
``shard`` and ``slot`` of the input are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.row_id import assign_row_id
from tripmart.session import keep

SHARDS = 8
SEED = 20240601
ROUNDS = 6

# Multipliers of the 32-bit finaliser of MurmurHash3, used as round function.
MIX = (0x85EBCA6B, 0xC2B2AE35)
_WORD = 0xFFFFFFFF


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    """32-bit key of each round."""
    digests = [hashlib.sha256(f"{seed}:{i}".encode()).digest() for i in range(rounds)]
    return [int.from_bytes(d[:4], "little") for d in digests]


def halves(rows: int) -> tuple[int, int]:
    """Bits of the upper and lower half of the network's domain."""
    bits = max(2, (rows - 1).bit_length())
    return bits // 2, bits - bits // 2


def _mixed(value: np.ndarray, key: int) -> np.ndarray:
    h = (value ^ np.uint64(key)) & np.uint64(_WORD)
    h = (h * np.uint64(MIX[0])) & np.uint64(_WORD)
    h ^= h >> np.uint64(13)
    h = (h * np.uint64(MIX[1])) & np.uint64(_WORD)
    return h ^ (h >> np.uint64(16))


class Shuffle(NamedTuple):
    """A permutation of the numbers below ``rows``, dealt to ``shards``. Up to 2**62 rows."""

    rows: int
    shards: int = SHARDS
    seed: int = SEED

    def _turn(self, numbers: np.ndarray, keys: Sequence[tuple[int, int]]) -> np.ndarray:
        high, low = halves(self.rows)
        upper, lower = numbers >> np.uint64(low), numbers & np.uint64((1 << low) - 1)
        for place, key in keys:
            if place % 2:
                upper = upper ^ (_mixed(lower, key) & np.uint64((1 << high) - 1))
            else:
                lower = lower ^ (_mixed(upper, key) & np.uint64((1 << low) - 1))
        return (upper << np.uint64(low)) | lower

    def _walked(self, numbers: np.ndarray, backwards: bool) -> np.ndarray:
        keys = list(enumerate(round_keys(self.seed)))
        if backwards:
            keys.reverse()
        out = np.asarray(numbers, dtype=np.uint64).copy()
        todo = np.arange(len(out))
        while len(todo):
            out[todo] = self._turn(out[todo], keys)
            todo = todo[out[todo] >= np.uint64(self.rows)]
        return out.astype(np.int64)

    def permuted(self, numbers: np.ndarray) -> np.ndarray:
        """New place of each row number."""
        return self._walked(numbers, backwards=False)

    def original(self, places: np.ndarray) -> np.ndarray:
        """Row number at each place."""
        return self._walked(places, backwards=True)

    def place(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shard and slot of each row number."""
        at = self.permuted(numbers)
        return at % self.shards, at // self.shards

    def number(self, shard: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Row number in each slot of each shard."""
        return self.original(np.asarray(slot) * self.shards + np.asarray(shard))


def sharded(
    rows: DataFrame, order_by: Sequence[str], shards: int = SHARDS, seed: int = SEED
) -> DataFrame:
    """``rows`` with ``shard`` (int) and ``slot`` (long), the same for any partitioning of the input.

    ``order_by`` should tell rows apart as far as it matters. The rows are written twice to the
    shared folder: pass only the columns that are wanted.
    """
    rows = rows.drop("shard", "slot")
    kept = keep(rows, "shard-rows")  # counted; range bounds are then sampled from this copy
    shuffle = Shuffle(kept.rows, shards, seed)

    @F.pandas_udf("bigint")
    def permuted(number: pd.Series) -> pd.Series:
        return pd.Series(shuffle.permuted(number.to_numpy() - 1))

    numbered = assign_row_id(kept.df, "__number", order_by)
    return numbered.withColumn("__at", permuted("__number")).select(
        *rows.columns,
        F.expr(f"cast(__at % {shards} AS int)").alias("shard"),
        F.expr(f"__at div {shards}").alias("slot"),
    )


def write_shards(placed: DataFrame, path: str) -> None:
    """Write a sharded frame as one folder per shard, whose files are sorted by slot.

    The slots of a shard are spread over several files by ranges, so that no task holds a shard.
    """
    (
        placed.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.mode("overwrite")
        .partitionBy("shard")
        .parquet(path)
    )


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32): bytes of the text and one more, and its checksum; null as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def oracle_sql(shards: int = SHARDS, seed: int = SEED) -> str:
    """Shards of the ``documents`` table in DuckDB: checksum, network and walk in SQL."""
    entry = "CAST(i AS UBIGINT) AS c FROM range(256) g(i)"
    for _ in range(8):
        entry = f"CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END AS c FROM (SELECT i, {entry})"

    def turned(rows: str) -> str:
        """All rounds over the column ``spot``."""
        kept = "number, high, low, n"
        state = f"SELECT {kept}, spot >> low AS upper, spot & ((1::UBIGINT << low) - 1) AS lower FROM ({rows})"
        for place, key in enumerate(round_keys(seed)):
            read, bits = ("lower", "high") if place % 2 else ("upper", "low")
            mask = f"((1::UBIGINT << {bits}) - 1)"
            sides = {"upper": "upper", "lower": "lower"}
            changed = "upper" if place % 2 else "lower"
            sides[changed] = f"xor({changed}, xor(h2, h2 >> 16) & {mask}) AS {changed}"
            state = f"""SELECT {kept}, {sides["upper"]}, {sides["lower"]} FROM (
  SELECT *, (xor(h1, h1 >> 13) * {MIX[1]}) & {_WORD} AS h2 FROM (
  SELECT *, (xor({read}, {key}::UBIGINT) * {MIX[0]}) & {_WORD} AS h1 FROM ({state})))"""
        return f"SELECT number, (upper << low) | lower AS spot, high, low, n FROM ({state})"

    return f"""WITH RECURSIVE codes AS (
  SELECT list(c ORDER BY i) AS code FROM (SELECT i, {entry})),
texts AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                   lambda b: CAST('0x' || b AS UBIGINT)) AS bytes
  FROM documents),
sized AS (
  SELECT doc_id, size, CAST(xor(list_reduce(list_prepend(4294967295::UBIGINT, bytes),
    lambda c, b: xor(code[CAST(xor(c, b) & 255 AS BIGINT) + 1], c >> 8)), 4294967295) AS BIGINT) AS text_crc32
  FROM texts, codes),
numbered AS (
  SELECT *, CAST(row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS UBIGINT)
    AS number FROM sized),
halves AS (
  SELECT count(*) AS n, CAST(greatest(2, length(bin(greatest(count(*) - 1, 1)))) // 2 AS UBIGINT) AS high,
    CAST(greatest(2, length(bin(greatest(count(*) - 1, 1)))) AS UBIGINT) - high AS low FROM documents),
walk AS (
  {turned("SELECT number, number AS spot, high, low, n FROM numbered, halves")}
  UNION ALL
  {turned("SELECT * FROM walk WHERE spot >= n")}),
placed AS (SELECT number, spot FROM walk WHERE spot < n)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(spot % {shards} AS INT) AS shard,
  CAST(spot // {shards} AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard
FROM numbered JOIN placed USING (number)"""
