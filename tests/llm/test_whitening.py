"""Whitening against numpy's eigenvectors, exact sums, and odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import queries as Q
from millrace.llm.whitening import _exact_products, fit_whitening, polar_unitary, spectral_components, whitened_components

SF = "/root/testdata/sf0.001"


def plain(vectors, k=8):
    """n, exact deviations, whitened rows and shares by numpy."""
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    deviation = [sum(int(v) ** 2 for v in r) for r in n * x - s]
    y = (n * x - s).astype(float) / n
    e, w = np.linalg.eigh(y.T @ y / n)
    e, w = e[::-1][:k], w[:, ::-1][:, :k]
    return n, deviation, y @ w / np.sqrt(e), e / np.trace(y.T @ y / n)


def test_whitened_vectors_equal_numpy(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids = [r["vec_id"] for r in rows]
    n, deviation, white, share = plain([r["embedding"] for r in rows])
    got = Q.op11_whitening(spark, SF).collect()
    assert len(got) == 8 * n and {r["n"] for r in got} == {n}
    assert {(r["vec_id"], r["deviation"]) for r in got} == set(zip(ids, deviation, strict=True))
    assert all(abs(r["explained"] - share[r["component"] - 1]) < 1e-10 and r["identity_error"] < 1e-9 for r in got)
    mine = np.zeros((n, 8))
    for r in got:
        mine[ids.index(r["vec_id"]), r["component"] - 1] = r["whitened"]
    assert np.allclose(np.abs(mine), np.abs(white), atol=1e-7)
    assert all(np.allclose(mine[:, c], white[:, c], atol=1e-7) or np.allclose(mine[:, c], -white[:, c], atol=1e-7) for c in range(8))
    assert np.abs(mine.T @ mine / n - np.eye(8)).max() < 1e-9


def test_partitions_do_not_matter(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    a, b = fit_whitening(df.repartition(1)), fit_whitening(df.repartition(7))
    assert a.sums == b.sums and (a.covariance == b.covariance).all() and (a.components == b.components).all()


@pytest.mark.parametrize("d", [1, 2, 3, 17, 64])
def test_components_of_hard_matrices(d):
    rng = np.random.default_rng(d)
    turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
    for values in (rng.random(d) ** 6, np.ones(d), np.r_[np.ones(d - d // 2), np.zeros(d // 2)], np.r_[1.0, np.full(d - 1, 1e-9)], 1 + 1e-13 * rng.random(d), rng.normal(size=d)):
        a = (turn * values) @ turn.T
        a = (a + a.T) / 2
        e, w = spectral_components(a)
        whole = max(np.abs(values).max(), 1e-300)
        assert np.allclose(e, np.sort(values)[::-1], atol=1e-13 * whole * 10)
        assert np.abs(w.T @ w - np.eye(d)).max() < 1e-13 and np.abs(a @ w - w * e).max() < 1e-13 * whole


def test_polar_factor_is_orthogonal():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(20, 20))
    a = a + a.T
    u = polar_unitary(a)
    values, vectors = np.linalg.eigh(a)
    assert np.abs(u - (vectors * np.sign(values)) @ vectors.T).max() < 1e-12


def test_products_of_large_numbers_are_exact():
    y = np.array([[1 << 40, -(1 << 39) + 1], [3, 5]])
    assert _exact_products(y) == (y.astype(object).T @ y.astype(object)).tolist()
    small = np.random.default_rng(1).integers(-3000, 3000, (500, 4))
    assert _exact_products(small, 1 << 30) == (small.T @ small).tolist()


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    odd = [(1, [0.5, -1.0]), (1, [0.5, -1.0]), (None, [0.25, 3.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [1.0, -inf]), (6, []), (7, [1.0]), (8, [1.0, 2.0, 3.0]), (9, [2.0, 7.5]), (10, [1e30, 0.0])]
    df = spark.createDataFrame(odd, "vec_id long, embedding array<float>").withColumns({c: F.lit("x") for c in ("key", "vector", "n", "at", "deviation", "whitened", "component")})
    got = whitened_components(df).collect()
    n, deviation, white, share = plain([v for k, v in odd if k in (1, None, 9)])
    assert sorted((r["vec_id"] or 0, r["component"], r["deviation"]) for r in got) == sorted((k, c, d) for k, d in zip([1, 1, 0, 9], deviation, strict=True) for c in (1, 2))
    assert {r["n"] for r in got} == {4} and max(abs(abs(r["whitened"]) - abs(white[[1, 1, 0, 9].index(r["vec_id"] or 0) if r["vec_id"] else 2, r["component"] - 1])) for r in got) < 1e-9
    for few in (df.limit(0), df.filter("vec_id = 1"), df.filter("vec_id is null"), df.filter("vec_id in (2, 6)")):
        assert whitened_components(few).collect() == []


def test_deviations_beyond_a_long(spark):
    df = spark.createDataFrame([(1, [8e9, 0.0]), (2, [-8e9, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["deviation"] for r in whitened_components(df, 1).collect()}
    assert got[1] is None and got[2] is None and got[3] == plain([[8e9, 0.0], [-8e9, 1.0], [0.0, 2.0]])[1][2]
