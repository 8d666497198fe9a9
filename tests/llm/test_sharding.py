"""Sharding by a Feistel permutation: against its own law, by definition, and in both directions."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from shared_rows import folder, none, odd  # noqa: F401

from tripmart.llm import queries, sharding
from tripmart.llm.sharding import Shuffle
from tripmart.session import new_path


def turned(number, rows, seed):
    """One walk of one number, by definition."""
    low = max(2, (rows - 1).bit_length())
    high, low = low // 2, low - low // 2
    while True:
        upper, lower = number >> low, number & ((1 << low) - 1)
        for place, key in enumerate(sharding.round_keys(seed)):
            h = lower if place % 2 else upper
            h = (h ^ key) * 0x85EBCA6B % 2**32
            h = (h ^ (h >> 13)) * 0xC2B2AE35 % 2**32
            h ^= h >> 16
            if place % 2:
                upper ^= h & ((1 << high) - 1)
            else:
                lower ^= h & ((1 << low) - 1)
        number = upper << low | lower
        if number < rows:
            return number


@pytest.mark.parametrize("rows", [1, 2, 3, 4, 5, 8, 9, 17, 1000, 1024, 1025])
def test_permutation(rows):
    shuffle, numbers = Shuffle(rows, 8, 7), np.arange(rows)
    places = shuffle.permuted(numbers)
    assert sorted(places.tolist()) == list(range(rows))
    assert places.tolist() == [turned(i, rows, 7) for i in range(rows)]
    assert shuffle.original(places).tolist() == numbers.tolist()


@given(st.integers(1, 2**62), st.integers(0, 2**40), st.data())
@settings(max_examples=100, deadline=None)
def test_slots_are_computable_both_ways(rows, seed, data):
    number = data.draw(st.integers(0, rows - 1))
    shuffle = Shuffle(rows, 8, seed)
    shard, slot = shuffle.place(np.array([number]))
    assert shuffle.number(shard, slot).tolist() == [number]


def test_neighbours_part_and_seeds_differ():
    one, two = Shuffle(50_000, 8, 1), Shuffle(50_000, 8, 2)
    numbers = np.arange(50_000)
    a, b = one.permuted(numbers), two.permuted(numbers)
    assert abs(np.corrcoef(numbers, a)[0, 1]) < 0.02
    assert (a == b).mean() < 0.001
    assert (np.abs(np.diff(a)) < 50).mean() < 0.01
    counts = np.bincount(one.place(numbers[:8000])[0], minlength=8)
    assert counts.min() > 850  # any range of rows meets all shards alike


def check_law(rows, shards=8):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
    counts = [len(by_shard.get(k, [])) for k in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_shards_of_all_documents(spark, folder):
    query = queries.QUERIES["op12_feistel_sharding"]
    got = query(spark, folder).collect()
    check_law(got)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    sizes = [(d.doc_id, len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in docs]
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted(sizes)
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    shuffle = Shuffle(len(docs))
    for number, (doc_id, *_) in enumerate(sorted(sizes)):
        shard, slot = shuffle.place(np.array([number]))
        assert (shard[0], slot[0]) == next((r.shard, r.slot) for r in got if r.doc_id == doc_id)


def test_any_partitioning_gives_the_same_shards(spark, odd):
    sizes = sharding.document_sizes(odd)
    order = ["doc_id", "size", "text_crc32"]
    one = sharding.sharded(sizes.coalesce(1), order, 3, 5).collect()
    many = sharding.sharded(sizes.repartition(7, F.rand(1)), order, 3, 5).collect()
    assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, many), key=repr)
    check_law(one, 3)


def test_extra_columns_stay_and_own_ones_are_replaced(spark, odd):
    clashing = odd.withColumns({"shard": F.lit("s"), "slot": F.lit(-1)})
    got = sharding.sharded(clashing, ["doc_id", "text"])
    assert got.columns == [*odd.columns, "shard", "slot"]
    rows = got.collect()
    check_law(rows)
    assert {r.kept for r in rows} == {"k"}


def test_empty_table(spark, none):
    assert sharding.sharded(sharding.document_sizes(none), ["doc_id"]).collect() == []


def test_one_row_repeated(spark):
    rows = spark.range(500).select(F.lit(1).cast("bigint").alias("doc_id"), F.lit("same").alias("text"))
    check_law(sharding.sharded(sharding.document_sizes(rows), ["doc_id"], 8).collect())


def test_written_shards_read_in_slot_order(spark, odd):
    path = new_path(spark, "test-shards")
    sharding.write_shards(sharding.sharded(odd, ["doc_id", "text"], 2), path)
    back = spark.read.parquet(path)
    assert back.count() == odd.count()
    check_law(back.collect(), 2)
    files = back.select("_metadata.file_path", "shard").distinct()
    assert files.count() >= back.select("shard").distinct().count() == 2
