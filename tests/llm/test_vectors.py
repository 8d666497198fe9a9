"""Operators on embeddings against brute force."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from shared_rows import folder  # noqa: F401

from tripmart.llm import lloyd, queries, vectors, whitening
from tripmart.llm.bidiagonal import bidiagonalised, qd_values, right_vectors

SCHEMA = "vec_id bigint, embedding array<double>, x string, chunk int, cluster int, component int"


def given_vectors(folder):
    table = pq.read_table(f"{folder}/embeddings.parquet")
    whole = np.floor(np.array(table.column("embedding").to_pylist(), dtype=np.float64) * 256)
    return table.column("vec_id").to_pylist(), whole.astype(np.int64)


def frame(spark, rows):
    """Vectors with extra columns named like the operators' own."""
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)


#: Nulls, non-finite and empty vectors, other lengths, copies, repeated and null ids.
ODD = [
    (1, [0.5, -0.25, 0.125]),
    (1, [0.5, -0.25, 0.125]),
    (2, None),
    (3, [None, 1.0, 2.0]),
    (4, [float("nan"), 1.0, 1.0]),
    (5, [float("-inf"), 0.0, 0.0]),
    (6, []),
    (7, [-0.0, -0.001, 0.001]),
    (8, [1.0, 2.0]),
    (9, [2.0, -1.0, 0.5]),
    (None, [2.0, -1.0, 0.75]),
    (10, [0.0, 0.0, 0.0]),
    (11, [3.0, 1.0, -2.0]),
]


def kept(rows, dims):
    out = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(c is not None and np.isfinite(c) for c in v):
            out.append((i, np.floor(np.array(v) * 256).astype(np.int64)))
    return out


# ---------------------------------------------------------------- whole vectors


def test_whole_vectors(spark):
    got = vectors.whole_vectors(frame(spark, [*ODD, (12, [1e300, -1e300, 0.0])])).collect()
    want = [(i, v.tolist()) for i, v in kept(ODD, 3)] + [(6, []), (8, [256, 512])]
    want.append((12, [2**63 - 1, -(2**63), 0]))
    assert sorted(((r.id, list(r.x)) for r in got), key=repr) == sorted(want, key=repr)


# ---------------------------------------------------------------- small matrices


@pytest.mark.parametrize(
    "a",
    [
        np.eye(5),
        np.ones((7, 4)),
        np.zeros((3, 3)),
        np.diag([1e9, 1.0, 1e-9]),
        np.vstack([np.eye(4)] * 3)[:, [0, 0, 1, 2, 3]],
        np.arange(12.0).reshape(4, 3),
        np.array([[3.0]]),
    ],
)
def test_right_vectors_of_odd_matrices(a):
    values, z, total = right_vectors(a, 4)
    want = np.linalg.svd(a, compute_uv=False) ** 2
    top = max(want.max(), 1e-300)
    assert np.allclose(values, want[: len(values)], rtol=1e-13, atol=1e-14 * top)
    assert all(v <= 1e-20 * top for v in want[len(values) : 4])
    assert np.abs(a.T @ (a @ z) - z * values).max(initial=0) <= 1e-13 * top
    assert np.abs(z.T @ z - np.eye(len(values))).max(initial=0) < 1e-13
    assert total == pytest.approx((a * a).sum())


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 24), st.integers(1, 24), st.integers(0, 2**31))
def test_right_vectors_of_small_whole_matrices(rows, columns, seed):
    a = np.random.default_rng(seed).integers(-3, 4, (rows, columns)).astype(float)
    a = np.vstack([a, np.zeros((max(columns - rows, 0), columns))])
    values, z, _ = right_vectors(a, 5)
    want = np.linalg.svd(a, compute_uv=False) ** 2
    top = max(want.max(), 1e-300)
    assert np.abs(values - want[: len(values)]).max(initial=0) <= 1e-12 * top
    assert np.abs(a.T @ (a @ z) - z * values).max(initial=0) <= 1e-12 * top
    assert np.abs(z.T @ z - np.eye(len(values))).max(initial=0) <= 1e-12


def test_small_singular_values_are_relatively_accurate():
    d, e = np.array([1.0, 1e-3, 1e-6, 1e-9]), np.array([0.5, 1e-3, 1e-7])
    b = np.diag(d) + np.diag(e, 1)
    got = sorted(qd_values((d**2).tolist(), (e**2).tolist()))
    product = np.prod(np.sqrt(got))  # of all singular values: the determinant, known exactly
    assert product == pytest.approx(np.prod(d), rel=1e-13)
    assert np.sqrt(got[-1]) == pytest.approx(np.linalg.norm(b, 2), rel=1e-14)
    diagonal, upper, p = bidiagonalised(b)
    assert np.allclose(p.T @ p, np.eye(4), atol=1e-15)


# ---------------------------------------------------------------- whitening


def check_whitened(got, ids, x, components=4):
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    variance, axes = np.linalg.eigh(np.cov(fit.T, bias=True))
    order = np.argsort(variance)[::-1][:components]
    for k, at in enumerate(order):
        rows = sorted(((r.vec_id, r) for r in got if r.component == k + 1), key=repr)
        plain = sorted(
            ((i, v) for i, v in zip(ids, x.tolist(), strict=True)), key=lambda p: repr((p[0],))
        )
        assert len(rows) == len(plain)
        want = (np.array([v for _, v in plain]) - sums / n) @ axes[:, at] / np.sqrt(variance[at])
        have = {}
        for (i, v), w in zip(plain, want, strict=True):
            have.setdefault((i, int(((n * np.array(v) - sums) ** 2).sum())), []).append(w)
        sign = 0
        for i, r in rows:
            assert (r.n, r.deviation >= 0) == (n, True)
            w = have[(i, r.deviation)][0]
            sign = sign or np.sign(w * r.whitened)
            assert r.whitened == pytest.approx(sign * w, abs=1e-9)
            assert r.explained == pytest.approx(variance[at] / variance.sum(), rel=1e-10)
            assert r.identity_error < 1e-10


def test_whitening_of_all_embeddings(spark, folder):
    got = queries.QUERIES["op11_bidiagonal_whitening"](spark, folder).collect()
    ids, x = given_vectors(folder)
    assert len(got) == 4 * len(ids)
    check_whitened(got, ids, x)


def test_whitening_of_odd_rows(spark):
    whole = vectors.whole_vectors(frame(spark, ODD))
    got = whitening.whitened(whole).collect()
    ids, x = zip(*kept(ODD, 3), strict=True)
    assert {r.component for r in got} == {1, 2, 3}
    check_whitened(got, ids, np.array(x), 3)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])]])
def test_nothing_to_whiten(spark, rows):
    assert whitening.whitened(vectors.whole_vectors(frame(spark, rows))).count() == 0


def test_many_factors_are_merged_in_a_tree(spark):
    """More partitions than one merge takes, many of them empty; one vector holds most rows."""
    rng = np.random.default_rng(3)
    x = np.vstack([rng.integers(-50, 50, (60, 5)), np.tile([1, 2, 3, 4, 5], (200, 1))])
    rows = [(i, (v / 256).tolist()) for i, v in enumerate(x)]
    whole = vectors.whole_vectors(frame(spark, rows)).repartition(40)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = whitening.whitened(whole, dims=5).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    check_whitened(got, list(range(len(x))), x)


def test_wide_numbers_have_no_deviation_in_a_long(spark):
    rows = [(1, [1e16, 0.0]), (2, [-1e16, 0.0]), (3, [0.0, 1.0])]
    got = whitening.whitened(vectors.whole_vectors(frame(spark, rows))).collect()
    assert {r.deviation for r in got if r.vec_id != 3} == {None}
    assert max(r.identity_error for r in got) < 1e-9


# ---------------------------------------------------------------- clusters


def lloyd_by_definition(rows, clusters, rounds):
    """(id, cluster, distance) of whole vectors, and the centroids."""
    order = sorted(
        range(len(rows)),
        key=lambda i: (
            hashlib.sha256(f"2:{'' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest(),
            list(rows[i][1]),
        ),
    )
    c = [list(map(int, rows[i][1])) for i in order[:clusters]]

    def nearest():
        out = []
        for i, x in rows:
            d = [sum((int(a) - b) ** 2 for a, b in zip(x, row, strict=True)) for row in c]
            out.append((i, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        at = nearest()
        for k in range(len(c)):
            own = [x for (_, x), (_, label, _) in zip(rows, at, strict=True) if label == k]
            if own:
                c[k] = [sum(int(x[d]) for x in own) // len(own) for d in range(len(c[k]))]
    return nearest(), c


def check_clusters(got, rows, clusters, rounds):
    want, c = lloyd_by_definition(rows, clusters, rounds)
    texts = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c]
    inertia = {k: sum(d for _, label, d in want if label == k) for k in range(len(c))}
    total = sum(inertia.values())
    expected = [(i, k, d, inertia[k], total, texts[k]) for i, k, d in want]
    have = [
        (r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
        for r in got
    ]
    assert sorted(have, key=repr) == sorted(expected, key=repr)


def test_clusters_of_all_embeddings(spark, folder):
    got = queries.QUERIES["op13_sharded_lloyd"](spark, folder).collect()
    ids, x = given_vectors(folder)
    check_clusters(got, list(zip(ids, x.tolist(), strict=True)), 40, 5)


def test_clusters_of_odd_rows(spark):
    whole = vectors.whole_vectors(frame(spark, ODD))
    # Blocks of two columns, of which the second is narrower; chunks of any size.
    got = lloyd.digests(*lloyd.clustered(whole, 3, 2, dims=3, block_dims=2)).collect()
    check_clusters(got, kept(ODD, 3), 3, 2)


def test_more_clusters_than_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [5.0, 5.0])]
    whole = vectors.whole_vectors(frame(spark, rows))
    got = lloyd.digests(*lloyd.clustered(whole, 5, 2, dims=2)).collect()
    check_clusters(got, kept(rows, 2), 5, 2)


def test_no_vectors_give_no_clusters(spark):
    whole = vectors.whole_vectors(frame(spark, [(1, None)]))
    assert lloyd.digests(*lloyd.clustered(whole, 3, 1, dims=2)).count() == 0


def test_block_tables_go(spark):
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("lloyd_blocks_")]


@given(st.integers(0, 2**31), st.sampled_from([100, 2**20, 2**26]))
@settings(max_examples=30, deadline=None)
def test_distances_are_exact(seed, top):
    rng = np.random.default_rng(seed)
    x, c = rng.integers(-top, top, (7, 16)), rng.integers(-top, top, (5, 16))
    want = [[sum(int(a - b) ** 2 for a, b in zip(r, s, strict=True)) for s in c] for r in x]
    assert lloyd.squared_distances(x, c).tolist() == want


def test_hot_copies_share_a_cluster(spark):
    rows = [(i, [1.0, 0.0]) for i in range(3000)] + [(9000 + i, [0.0, float(i)]) for i in range(50)]
    whole = vectors.whole_vectors(frame(spark, rows)).repartition(8, F.col("id"))
    got = lloyd.digests(*lloyd.clustered(whole, 4, 3, dims=2, block_dims=1)).collect()
    check_clusters(got, kept(rows, 2), 4, 3)
