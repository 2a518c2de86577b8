"""Whitening against a dense eigendecomposition."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tidewire.llm import queries, whitening


@pytest.mark.parametrize("size,rank,most", [(64, 64, 256), (64, 20, 256), (300, 300, 90), (5, 5, 256), (10, 3, 256), (40, 40, 40)])
def test_lanczos_finds_the_leading_pairs(size, rank, most):
    r = np.random.default_rng(size)
    v = (r.standard_normal((3 * size, rank)) * np.logspace(0, -2, rank)) @ np.linalg.qr(r.standard_normal((size, rank)))[0].T
    v = v.T @ v
    found = whitening.leading(lambda b: v @ b, size, 8, most=most)
    values, vectors = (x[..., ::-1] for x in np.linalg.eigh(v))
    k = min(8, rank, size)
    assert np.abs(found.values[:k] - values[:k]).max() < 1e-12 * values[0]
    assert np.abs(np.abs((found.vectors[:, :k] * vectors[:, :k]).sum(0)) - 1).max() < 1e-9


@pytest.mark.parametrize("v", [np.eye(30), np.zeros((30, 30)), np.diag([5.0] * 20 + [1.0] * 60), np.ones((20, 20))])
def test_lanczos_goes_on_after_a_breakdown(v):
    found = whitening.leading(lambda b: v @ b, len(v), 8, block=4)
    assert np.allclose(found.values, np.linalg.eigvalsh(v)[::-1][:8], atol=1e-12)
    assert np.allclose(found.vectors.T @ found.vectors, np.eye(8))


def plain(rows, components=8):
    """(key, component) -> n, deviation, whitened, explained, from a dense decomposition."""
    kept = [(k, [math.floor(1024 * float(c)) + 100_000 for c in v]) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, x = len(kept), np.array([v for _, v in kept], dtype=object)
    s = x.sum(0)
    d = n * x - s
    z = d.astype(float) / n
    values, vectors = (a[..., ::-1] for a in np.linalg.eigh(z.T @ z / n))
    good = min(components, int((values > 1e-12 * values.sum()).sum()))
    w = z @ vectors[:, :good] / np.sqrt(values[:good])
    return {(k, c + 1): (n, int((d[i] ** 2).sum()), w[i, c], values[c] / values.sum()) for i, (k, _) in enumerate(kept) for c in range(good)}


def same(rows, want):
    assert {(r["vec_id"], r["component"]) for r in rows} == set(want)
    signs: dict = {}
    for r in rows:
        n, deviation, whitened, explained = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation) and r["explained"] == pytest.approx(explained, rel=1e-9) and r["identity_error"] < 1e-9
        if abs(whitened) > 1e-3:
            assert signs.setdefault(r["component"], np.sign(whitened * r["whitened"])) == np.sign(whitened * r["whitened"])
        assert abs(r["whitened"]) == pytest.approx(abs(whitened), abs=1e-8)
    assert len({r["identity_error"] for r in rows}) <= 1


@pytest.mark.parametrize("size,n", [(64, 300), (12, 40), (3, 50), (20, 6)])
def test_whitening_as_a_dense_decomposition(spark, size, n):
    r = random.Random(size)
    rows = [(i, [r.gauss(0, 1 / (j + 1)) for j in range(size)]) for i in range(n)]
    rows += [(1000, None), (1001, [math.nan] * size), (1002, [math.inf, *[0.0] * (size - 1)]), (1003, [None, *[0.0] * (size - 1)]), (None, rows[0][1]), (1004, rows[0][1])]
    df = spark.createDataFrame([(k, v, 1.5, "x") for k, v in rows], "vec_id long, embedding array<float>, n double, whitened string").repartition(3)
    want = plain([(r["vec_id"], r["embedding"]) for r in df.collect()])
    same(whitening.whiten(df, "vec_id", "embedding").collect(), want)


def test_tables_without_variance_give_no_rows(spark):
    kind = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)], [(1, None), (2, [])]):
        out = whitening.whiten(spark.createDataFrame(rows, kind), "vec_id", "embedding")
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and out.count() == 0
    uneven = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [1.0])], kind)
    assert {r["vec_id"] for r in whitening.whiten(uneven, "vec_id", "embedding").collect()} == {1, 2}


def test_deviations_beyond_a_long_are_null(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [3e6, 1.0])], "vec_id long, embedding array<double>")
    rows = whitening.whiten(df, "vec_id", "embedding").collect()
    assert {r["deviation"] for r in rows} == {None} and {r["n"] for r in rows} == {3}


def test_the_query_over_its_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    same(queries.op11_whitening(spark, "/root/testdata/sf0.01").collect(), plain([(r["vec_id"], r["embedding"]) for r in table]))
