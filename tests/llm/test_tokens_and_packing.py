"""Words, token ids, bit packing and best-fit packing."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from shared_rows import ODD, folder, lower, none, odd, split  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmart.llm import binary, packing, words
from tripmart.llm.tokens import encoder
from tripmart.session import new_path

TOKENIZERS = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]
PIECES = st.sampled_from(
    ["a", "The", "ing", " ", "  ", "\n", "\t", ",", ".", "!", "'s", "'", "é", "É", "漢", "1", "23",
     " ", " ", "\x1c", "\x85", "İ", "Σ", "é", "-", "…", "<|endoftext|>"]
)
TEXTS = st.lists(st.lists(PIECES, max_size=12).map("".join), min_size=1, max_size=5)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_ids_are_the_librarys(texts):
    for name, spaces in TOKENIZERS:
        code = encoder(name, spaces)
        got = code.encode(words.texts_of(pa.array(texts)))
        each = np.split(got.ids, got.first[1:-1])
        for text, ids in zip(texts, each, strict=True):
            assert ids.tolist() == code.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_and_their_hashes(texts):
    found = words.words_of(words.texts_of(pa.array(texts)))
    want = [split(lower(t)) for t in texts]
    assert np.diff(found.first).tolist() == [len(w) for w in want]
    flat = [x for w in want for x in w]
    names: dict[int, str] = {}
    for h, w in zip(found.hashes.tolist(), flat, strict=True):
        assert names.setdefault(h, w) == w
    assert len(names) == len(set(flat))


def test_long_words_are_not_cut():
    texts = pa.array(["y" * (3 * words.BLOCK) + " z", "y" * (3 * words.BLOCK)])
    found = words.words_of(words.texts_of(texts))
    assert np.diff(found.first).tolist() == [2, 1]
    assert found.hashes[0] == found.hashes[2] != found.hashes[1]


@pytest.mark.parametrize("run", ["\n\n\n", " \n\t ", "\n" * 3000])
def test_white_space_is_not_cut(run):
    """Runs of white space that stand across the end of a block."""
    code = encoder("byte_bpe_50k.json", True)
    for ahead in (1, 2, len(run) - 1, len(run)):
        text = ("word " * words.BLOCK)[: words.BLOCK - ahead - 1] + "a" + run + "b"
        got = code.encode(words.texts_of(pa.array(["x", text, "y"])))
        ids = got.ids[got.first[1] : got.first[2]].tolist()
        assert ids == code.tokenizer.encode(text, add_special_tokens=False).ids


def test_segments_hash_alike_wherever_they_stand():
    random.seed(3)
    lines = [bytes(random.choices(range(256), k=random.choice([0, 1, 50, 200_000]))) for _ in range(9)]
    lines += lines
    data = np.frombuffer(b"".join(lines), np.uint8)
    bounds = np.cumsum([0, *map(len, lines)])
    hashes = words.segment_hashes(data, bounds)
    assert (hashes[:9] == hashes[9:]).all()
    assert len(set(hashes.tolist())) == len(set(lines))


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 32), st.integers(0, 300), st.integers(0, 2**32))
def test_bits_round_trip(bits, count, seed):
    ids = np.random.default_rng(seed).integers(0, 1 << bits, count, dtype=np.uint64)
    packed = binary.pack(ids, bits)
    assert len(packed) == -(-count // 64) * bits * 8
    assert (binary.unpack(packed, bits, 0, count) == ids).all()
    for start in range(0, count, 37):
        size = min(count - start, 70)
        assert (binary.unpack(packed, bits, start, size) == ids[start : start + size]).all()


def brute_ids(text, name, end):
    code = encoder(name, name.startswith("byte"))
    return [*code.tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_files_hold_all_ids_in_order(spark, odd):
    path = new_path(spark, "test-binary")
    binary.write_tokens(odd, path, "word_bpe_49k.json", False, 1)
    rows = sorted(binary.read_tokens(spark, path).collect(), key=lambda r: r.start)
    want = sorted(
        ((d, brute_ids(t, "word_bpe_49k.json", 1)) for d, t in ODD),
        key=lambda x: (x[0] is not None, x[0]),
    )
    assert [r.doc_id for r in rows] == [d for d, _ in want]
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in rows) == sorted(
        (d or -1, len(i), crc(i)) for d, i in want
    )
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    for doc in (1, 6, 10):
        own = [i for d, i in want if d == doc]
        assert [x.tolist() for x in binary.document_ids(spark, path, doc)] == own
    execution = binary.blocks_of(spark, path, 6)._jdf.queryExecution()
    plan = spark._jvm.PythonSQLUtils.explainString(execution, "formatted")
    assert "LessThanOrEqual(low,6)" in plan and "GreaterThanOrEqual(high,6)" in plan


def test_random_access_reads_few_blocks(spark, monkeypatch):
    """By the bounds alone, a document is in one block of many."""
    docs = spark.createDataFrame([(i, f"word{i} and more") for i in range(400)], "doc_id bigint, text string")
    path = new_path(spark, "test-binary")
    monkeypatch.setattr(binary, "BLOCK_IDS", 50)  # these two go to the tasks by value
    monkeypatch.setattr(binary, "TEXT_BYTES", 100)
    binary.write_tokens(docs, path, "word_bpe_49k.json", False, 1)
    blocks = spark.read.parquet(path)
    inside = blocks.where("low <= 123 AND high >= 123")
    assert blocks.count() > 1 and inside.count() == 1
    assert inside.first().low <= 123 <= inside.first().high
    assert len(binary.document_ids(spark, path, 123)) == 1


def test_empty_tables(spark, none):
    path = new_path(spark, "test-binary")
    binary.write_tokens(none, path, "word_bpe_49k.json", False, 1)
    assert binary.read_tokens(spark, path).collect() == []
    assert packing.pack_documents(none, "byte_bpe_50k.json", True, 0).collect() == []


def check_packed(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for some in bins.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pieces_cover_documents(spark, odd):
    rows = packing.pack_documents(odd, "byte_bpe_50k.json", True, 0, 64).collect()
    check_packed(rows, 64)
    want = []
    for d, t in ODD:
        ids = brute_ids(t, "byte_bpe_50k.json", 0)
        first = (len(ids) - 1) % 64 + 1
        cuts = [0, *range(first, len(ids) + 1, 64)]
        want += [
            (d or -1, k, a, b - a, crc(ids[a:b]))
            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
        ]
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(
        want
    )


@pytest.mark.parametrize("most", [1, 8, 512])
def test_bounded_best_fit(most):
    random.seed(5)
    packer = packing.BestFit(100, most)
    fill: dict[int, int] = {}
    for length in (random.randint(1, 100) for _ in range(3000)):
        before = packer.left_open()
        one, offset = packer.add(length)
        assert offset == fill.get(one, 0)
        fits = [100 - f for f in before.values() if 100 - f >= length]
        if fits:  # the tightest open bin
            assert 100 - offset == min(fits)
        else:
            assert one not in fill
        fill[one] = offset + length
        assert packer.open <= most
    assert max(fill.values()) <= 100
    if most == 512:
        assert len(fill) <= 1.05 * sum(fill.values()) / 100


def test_few_sequences_from_many_tasks(spark):
    random.seed(6)
    items = spark.createDataFrame(
        [(i, random.randint(1, 2048)) for i in range(4000)], "doc_id bigint, length bigint"
    ).repartition(13)
    path = new_path(spark, "items")
    items.write.parquet(path)
    rows = packing.pack(spark.read.parquet(path), most=64).collect()
    assert sorted(r.doc_id for r in rows) == list(range(4000))
    assert check_packed(rows, 2048) <= 1.05 * sum(r.length for r in rows) / 2048
