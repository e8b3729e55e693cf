"""Whitening and hard negatives against dense linear algebra and plain Python."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from shelfwright.llm import rns_negatives, whitening
from tests.conftest import SMALL

VECTORS = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("clash") for c in ("x", "uid", "n", "space", "score", "dim")})


# Whitening


def triangular(matrix):
    return np.linalg.qr(matrix, mode="r")


def clustered(gap, size=30):
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(size, size)))
    return triangular(np.diag([5, 5 * (1 - gap), 5 * (1 - 2 * gap), 5 * (1 - 3 * gap), *rng.uniform(0, 4.9, size - 4)]) @ q.T)


def hard_cases():
    rng = np.random.default_rng(4)
    for size in (1, 2, 3, 5, 64):
        yield triangular(rng.normal(size=(3 * size, size)))
    yield from (np.eye(10), np.zeros((5, 5)), np.diag(10.0 ** -np.arange(40.0)) @ np.triu(np.ones((40, 40))))
    flat = rng.normal(size=(100, 20))
    flat[:, 3], flat[:, 7] = 0, flat[:, 8]
    yield triangular(flat)
    few = np.zeros((20, 20))
    few[:3] = triangular(rng.normal(size=(3, 20)))
    yield few
    yield from map(clustered, (0, 1e-15, 1e-12, 1e-8, 1e-4))
    peaks = np.diag(np.abs(np.arange(21) - 10.0) + 5) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    yield np.linalg.cholesky(peaks).T


def test_right_vectors_of_hard_matrices():
    for r in hard_cases():
        values, vectors = whitening.right_vectors(r, 4)
        want = np.linalg.svd(r, compute_uv=False)[:4] ** 2
        top = max(want[0], 1e-300)
        assert np.abs(values - want).max() <= 1e-13 * top
        assert np.abs(r.T @ r @ vectors.T - vectors.T * values).max() <= 1e-13 * top
        assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max() <= 1e-12


def test_dqds_keeps_small_values_accurate():
    rng = np.random.default_rng(5)
    for _ in range(100):
        size = int(rng.integers(2, 40))
        d, e = 10.0 ** rng.uniform(-8, 8, size), 10.0 ** rng.uniform(-8, 8, size - 1)
        values = whitening.dqds(d**2, e**2)
        # The product of all values is known to full accuracy, whatever their range.
        assert len(values) == size and abs(np.log(values).sum() - 2 * np.log(d).sum()) < 1e-9


def dense(vectors, k=4):
    """n, S, eigenvalues, directions, trace of the distinct integer vectors."""
    x = np.unique(np.floor(256 * vectors.astype(np.float64)).astype(np.int64), axis=0)
    centred = x - x.mean(axis=0)
    values, directions = np.linalg.eigh(centred.T @ centred / len(x))
    return len(x), x.sum(axis=0), values[::-1][:k], directions[:, ::-1][:, :k].T, values.sum()


def compare(rows, vectors, ids):
    n, sums, values, directions, trace = dense(vectors)
    got = defaultdict(list)
    for r in rows:
        got[r["component"]].append(r)
    x = np.floor(256 * vectors.astype(np.float64)).astype(np.int64)
    want_deviation = dict(zip(ids, ((n * x - sums) ** 2).sum(axis=1).tolist(), strict=True))
    for c, own in got.items():
        own = sorted(own, key=lambda r: r["vec_id"])
        assert [r["vec_id"] for r in own] == sorted(ids)
        w = np.array([r["whitened"] for r in own])
        want = ((x - sums / n) @ directions[c - 1] / math.sqrt(values[c - 1]))[np.argsort(ids, kind="stable")]
        assert min(np.abs(w - want).max(), np.abs(w + want).max()) < 1e-7
        for r in own:
            assert r["n"] == n and r["deviation"] == want_deviation[r["vec_id"]]
            assert abs(r["explained"] * trace / values[c - 1] - 1) < 1e-9 and r["identity_error"] < 1e-9
    return set(got)


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.1"])
def test_op13(spark, folder):
    source = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    rows = queries()["op13_whitened_embeddings"](spark, folder).collect()
    assert compare(rows, np.stack(source.embedding.to_numpy()), source.vec_id.tolist()) == {1, 2, 3, 4}


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(6)
    good = rng.normal(size=(40, 6)).astype(np.float32)
    good[:, 2] = 0.5  # a constant entry
    rows = [(i, v.tolist(), None if i % 3 else 1) for i, v in enumerate(good)]
    odd = [(100, None, 1), (101, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (102, [math.nan] * 6, 1), (103, [math.inf] * 6, 1), (104, [], 1), (105, [1.0, 2.0], 1)]
    copies = [(200, good[0].tolist(), 1)] * 30 + [(None, good[1].tolist(), 1)]
    got = whitening.whitened_rows(table(spark, rows + odd + copies).repartition(20)).collect()
    assert sum(r["vec_id"] == 200 for r in got) == 120 and sum(r["vec_id"] is None for r in got) == 4
    assert {r["vec_id"] for r in got} == {*range(40), 200, None}
    compare([r for r in got if r["vec_id"] is not None and r["vec_id"] < 40], good, list(range(40)))


def test_whitening_of_few_rows(spark):
    assert whitening.whitened_rows(table(spark, [])).count() == 0
    assert whitening.whitened_rows(table(spark, [(1, None, 1), (2, [], 1)])).count() == 0
    same = whitening.whitened_rows(table(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)])).collect()
    assert len(same) == 4 and all((r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) == (1, 0, None, None, None) for r in same)
    pair = whitening.whitened_rows(table(spark, [(1, [1.0, 0.0, 0.0], 1), (2, [0.0, 1.0, 0.0], 1)])).collect()
    assert sorted((r["vec_id"], r["component"], None if r["whitened"] is None else round(abs(r["whitened"]), 9)) for r in pair) == [
        (1, 1, 1.0), (1, 2, None), (1, 3, None), (2, 1, 1.0), (2, 2, None), (2, 3, None)
    ]
    zero = whitening.whitened_rows(table(spark, [(1, [0.0, -0.0], 1), (2, [-0.0, 0.0], 1)])).collect()
    assert all(r["n"] == 1 for r in zero)


def test_whitening_beyond_64_bits(spark):
    big = [[1e12, 0.0], [0.0, 2e12], [3e30, 1.0]]
    got = whitening.whitened_rows(table(spark, [(i, v, 1) for i, v in enumerate(big)])).collect()
    assert len(got) == 6 and all(r["deviation"] is None for r in got) and all(r["identity_error"] < 1e-9 for r in got)


def test_factors_merge_over_many_tasks(spark):
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(900, 5)).astype(np.float32)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "300")  # more than 16 x 16 factors
    try:
        source = table(spark, [(i, v.tolist(), 1) for i, v in enumerate(vectors)])
        compare(whitening.whitened_rows(source).collect(), vectors, list(range(900)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


# Hard negatives


def test_residue_products_are_exact():
    rng = np.random.default_rng(9)
    for length, most in ((1, 3), (64, 300), (700, 40_000), (64, 1 << 27)):
        a, b = rng.integers(-most, most, size=(5, length)), rng.integers(-most, most, size=(7, length))
        a[0], b[0], a[1] = most, most, -most
        bound = max(int((v.astype(object) ** 2).sum()) for v in (*a, *b))
        primes = rns_negatives.primes_beyond(4 * bound)
        assert math.prod(primes) > 4 * bound and len(primes) == len(set(primes))
        got = rns_negatives.Residues(a, primes).scores(rns_negatives.Residues(b, primes))
        assert got.tolist() == (a.astype(object) @ b.T.astype(object)).tolist()


def test_firsts_equal_a_sort():
    rng = np.random.default_rng(10)
    firsts, rows = rns_negatives.Firsts(3, 4), []
    for begin in range(0, 400, 40):
        scores, ids = rng.integers(0, 12, size=(3, 40)), rng.permutation(400)[:40]
        uids = np.arange(begin, begin + 40)
        firsts.add(scores, scores < 10, ids, uids)
        rows += [(a, -int(scores[a, c]), int(ids[c]), int(uids[c])) for a in range(3) for c in range(40) if scores[a, c] < 10]
    a, score, ids, uids = firsts.settle()
    want = [r for n in range(3) for r in sorted(r for r in rows if r[0] == n)[:4]]
    assert list(zip(a.tolist(), (-score).tolist(), ids.tolist(), uids.tolist(), strict=True)) == want


def plain_negatives(rows, anchor):
    usable = [
        (i, str(label), np.floor(256 * np.array(v, dtype=np.float32).astype(np.float64)).astype(np.int64))
        for i, v, label in rows if v and label is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out, last = [], 1 << 62
    for n, (i, label, v) in enumerate(usable):
        if i is None or not anchor(i):
            continue
        others = [(-int(v @ w), last if j is None else j, m, kind) for m, (j, kind, w) in enumerate(usable) if m != n and len(w) == len(v)]
        for score, j, _, _ in sorted(o for o in others if o[3] == label)[:5]:
            fits = sorted(o for o in others if o[3] != label and -30 * score <= -100 * o[0] <= -90 * score)[:10]
            out += [(i, None if j == last else j, rank, None if o[1] == last else o[1], -score, -o[0]) for rank, o in enumerate(fits, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("blocks", [False, True])
def test_hard_negatives(spark, monkeypatch, blocks):
    if blocks:
        monkeypatch.setattr(rns_negatives, "ANCHOR_ROWS", 7)
        monkeypatch.setattr(rns_negatives, "STRIPE_ROWS", 25)
    rng = np.random.default_rng(11)
    near = rng.normal(size=4)
    rows = [(i, (near + rng.normal(size=4) * 0.7).round(1).tolist(), int(rng.integers(0, 3))) for i in range(150)]
    rows += [(None, [1.0, 1.0, 1.0, 1.0], 0), (400, [0.0] * 4, 1), (401, rows[0][1], 2), (402, rows[0][1], 2)]
    rows += [(500, None, 1), (510, [], 1), (520, [1.0, None, 1.0, 1.0], 1), (530, [math.nan] * 4, 0), (540, [1.0] * 4, None)]
    rows += [(600 + i, [0.5 * i, 1.0, -1.0], i % 2) for i in range(30)]
    got = rns_negatives.hard_negatives(table(spark, rows).repartition(5), F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got), key=str) == plain_negatives(rows, lambda i: i % 10 == 0)


def test_hard_negatives_without_matches(spark):
    anchors = F.col("vec_id") % 100 == 0
    assert rns_negatives.hard_negatives(table(spark, []), anchors).count() == 0
    assert rns_negatives.hard_negatives(table(spark, [(100, [1.0], 1), (1, [1.0], 2)]), anchors).count() == 0
    huge = [(100, [1e30], 1), (1, [1e30], 1), (2, [1e29], 2)]
    assert rns_negatives.hard_negatives(table(spark, huge), anchors).count() == 0
    repeated = [(100, [1.0], 1), (100, [1.0], 1), (7, [0.5], 2), (7, [0.5], 2)]
    got = rns_negatives.hard_negatives(table(spark, repeated), anchors).collect()
    assert sorted(map(tuple, got)) == [(100, 100, n, 7, 65536, 32768) for n in (1, 1, 2, 2)]
