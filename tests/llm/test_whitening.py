"""Whitening against a dense eigendecomposition, exact integers and hand-made spectra."""

import math

import numpy as np
import pytest

from folioaudit.llm import queries as Q
from folioaudit.llm import whitening as W
from folioaudit.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def dense(rows, components=16):
    """Rows (id, integers), and e and explained by numpy over the distinct vectors."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    ints = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in usable]
    listed = sorted({tuple(x) for _, x in ints})
    n, sums = len(listed), [sum(column) for column in zip(*listed)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in listed])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-11 * values[0]).sum()))
    out = {}
    for i, x in ints:
        gap = [n * c - s for c, s in zip(x, sums)]
        out[i] = n, sum(g * g for g in gap), np.array([g / n for g in gap]) @ vectors[:, :k] / np.sqrt(values[:k])
    return out, values[:k], values[:k] / values.sum()


def compare(got, rows):
    want, values, explained = dense(rows)
    found = {}
    for r in got:
        found.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(found) == set(want)
    signs = {}
    for i, by in found.items():
        n, deviation, white = want[i]
        assert sorted(by) == list(range(1, len(values) + 1))
        for c, r in by.items():
            assert (r["n"], r["deviation"]) == (n, deviation)
            assert r["explained"] == pytest.approx(explained[c - 1], rel=1e-9)
            assert r["eigenvalue"] == pytest.approx(values[c - 1], rel=1e-12)
            assert r["identity_error"] < 1e-9
            sign = signs.setdefault(c, math.copysign(1, r["whitened"] * white[c - 1]))
            assert r["whitened"] == pytest.approx(sign * white[c - 1], abs=1e-7)


def test_query_equals_dense(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf_dir, "embeddings").collect()]
    got = Q.op12_chebyshev_whitening(spark, sf_dir)
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(got.collect(), rows)


def test_bad_vectors_copies_and_few_dimensions(spark):
    random = np.random.default_rng(5)
    good = [(i, [float(np.float32(c)) for c in random.normal(size=5) * [9, 3, 3, 1, 0.5]]) for i in range(200)]
    bad = [(900, None), (901, [1.0, None, 2.0, 3.0, 4.0]), (902, [float("nan")] * 5), (903, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (904, []), (905, [1.0, 2.0])]
    rows = good + bad
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    compare(W.whiten(df).collect(), [r for r in rows if r[0] != 905])
    copies = df.unionByName(spark.createDataFrame([(None, good[0][1], 0)] * 3 + [(7, good[7][1], 0)], SCHEMA))
    got = W.whiten(copies.selectExpr("*", "1 as x", "2 as n", "3 as c").repartition(7)).collect()
    assert sum(r["vec_id"] is None for r in got) == 15 and sum(r["vec_id"] == 7 for r in got) == 10
    assert {r["n"] for r in got} == {len({tuple(v) for _, v in [(i, [math.floor(64 * c) for c in v]) for i, v in good]})}


def test_few_ranks_and_nothing(spark):
    rows = [(i, [float(i), 2.0 * i, 3.0, float(i % 3)]) for i in range(50)]
    compare(W.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).collect(), rows)
    assert W.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(9)], SCHEMA)
    assert W.whiten(same).collect() == []


def test_huge_entries(spark):
    rows = [(i, [1e30 * (i % 2), -1e300 if i == 3 else 0.5 * i, float(i)]) for i in range(6)]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["vec_id"] for r in got} == set(range(6)) and all(math.isfinite(r["whitened"]) for r in got)
    assert all(r["deviation"] is None for r in got)


@pytest.mark.parametrize("kind", ["flat", "steep", "clusters", "deficient", "equal"])
def test_spectra(kind):
    """Hard spectra: close, equal, tiny and vanishing eigenvalues."""
    size = 120
    values = {
        "flat": np.linspace(70, 60, size),
        "steep": 10.0 ** -np.linspace(0, 9, size),
        "clusters": np.repeat([9.0, 8.0, 1.0], 40),
        "deficient": np.concatenate([[5, 4, 3], np.zeros(size - 3)]),
        "equal": np.full(size, 2.0),
    }[kind]
    basis = np.linalg.qr(np.random.default_rng(1).standard_normal((size, size)))[0]
    matrix = (basis * values) @ basis.T
    found = W.leading(lambda q: matrix @ q, size, 16)
    count = 3 if kind == "deficient" else 16
    assert found.values == pytest.approx(np.sort(values)[::-1][:count], rel=1e-10)
    assert np.abs(matrix @ found.vectors - found.vectors * found.values).max() < 1e-11 * values.max()
    assert np.abs(found.vectors.T @ found.vectors - np.eye(count)).max() < 1e-12


def test_polynomial_is_the_chebyshev_one():
    points = np.linspace(0, 10, 50)
    matrix, ones = np.diag(points), np.ones((50, 1))
    got = W.chebyshev(lambda q: matrix @ q, ones, matrix @ ones, 1.0, 6.0, 10.0, 7)[:, 0]
    poly = np.polynomial.chebyshev.Chebyshev([0] * 7 + [1], domain=[1, 6])
    assert got == pytest.approx(poly(points) / poly(10.0), rel=1e-9, abs=1e-12)
