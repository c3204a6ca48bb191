"""Whitening against whole-number arithmetic in plain Python and numpy's covariance."""

import math
from fractions import Fraction

import numpy as np
import pytest

from lakemart.llm import whitening
from tests.llm.helpers import SF

SCHEMA = "vec_id long, embedding array<float>, label int, x string"


def plain(rows, components):
    """vec_id -> (n, deviation, whitened up to signs, explained)."""
    good = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    centred = [[n * x[k] - sums[k] for k in range(d)] for x in fit]
    cov = np.array([[float(Fraction(sum(y[a] * y[b] for y in centred), n ** 3)) for b in range(d)] for a in range(d)])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = []
    for i, x in good:
        y = [n * x[k] - sums[k] for k in range(d)]
        out.append((i, n, sum(v * v for v in y), np.array(y, float) / n @ vectors / np.sqrt(values), values / np.trace(cov)))
    return out


def by_row(df, k):
    """One entry per vector: its id, n, deviation, whitened and explained in order of the components."""
    rows = sorted(df.collect(), key=lambda r: r["component"])
    groups = {}
    for r in rows:
        groups.setdefault(r["vec_id"], []).append(r)
    out = {}
    for i, g in groups.items():
        copies = len(g) // k
        out[i] = (g[0]["n"], int(g[0]["deviation"]), np.array([r["whitened"] for r in g[::copies]]),
                  np.array([r["explained"] for r in g[::copies]]), g[0]["identity_error"])
    return out


def compare(df, rows, k):
    got, expected = by_row(df, k), plain(rows, k)
    assert set(got) == {i for i, *_ in expected}
    signs = np.ones(k)
    for at, (i, *_, w, _) in enumerate(expected):
        if at == 0 or (np.abs(w) > 0.01).all():
            signs = np.sign(w) * np.sign(got[i][2])
            break
    for i, n, deviation, w, explained in expected:
        assert got[i][:2] == (n, deviation)
        np.testing.assert_allclose(got[i][2] * signs, w, rtol=1e-6, atol=1e-6)
        np.testing.assert_allclose(got[i][3], explained, rtol=1e-9)
        assert got[i][4] < 1e-9


def test_random_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(7) * np.arange(1, 8) * 0.3).tolist(), 0, "") for i in range(300)]
    rows += [(1000 + i, rows[5][1], 1, "") for i in range(200)]  # copies count once in the fit
    rows += [(2000, None, 0, ""), (2001, [], 0, ""), (2002, [float("nan")] * 7, 0, ""), (2003, [None] + [0.1] * 6, 0, ""),
             (2004, [float("inf")] + [0.0] * 6, 0, ""), (2005, [0.0] * 7, None, None)]
    df = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert {f.name for f in df.schema} >= {"vec_id", "component", "whitened"}
    floats = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v, *_ in rows]
    compare(df, floats, 7)


def test_given_vectors(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    compare(whitening.whiten(rows), [(r["vec_id"], r["embedding"]) for r in rows.collect()], 16)


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(3) * 1e10).tolist()) for i in range(40)]
    compare(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), rows, 3)


def test_covariance_is_exact():
    rng = np.random.default_rng(5)
    x = rng.integers(-50, 50, (101, 4)) + 1_000_000
    sums = [int(s) for s in x.sum(axis=0)]
    z = x - np.array([s // 101 for s in sums])
    squares = {(i, j): int(((z[:, i] + z[:, j]) ** 2).sum()) if i != j else int((z[:, i] ** 2).sum())
               for i in range(4) for j in range(i, 4)}
    np.testing.assert_allclose(whitening.covariance(101, sums, squares), np.cov(x.T, bias=True), rtol=1e-12)


def test_a_dimension_without_variance(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [0.25, *rng.standard_normal(2).tolist()]) for i in range(50)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 150
    assert all(r["whitened"] == 0 and r["explained"] == 0 for r in got if r["component"] == 3)
    assert max(r["identity_error"] for r in got) < 1e-9


def test_any_input(spark):
    schema = "vec_id long, embedding array<float>, n long, x string, component int"
    some = [(None, [0.5, 1.0], 1, "", 2), (1, [0.5, 1.0], 1, "", 2), (1, [0.5, -1.0], 1, "", 2), (2, None, None, None, None)]
    got = whitening.whiten(spark.createDataFrame(some, schema)).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2)]
    assert all(r["n"] == 2 and r["deviation"] == 128 ** 2 for r in got)
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame(some[3:], schema)).collect() == []
    with pytest.raises(ValueError, match="dimensions"):
        whitening.whiten(spark.createDataFrame([*some, (5, [1.0], 1, "", 1)], schema))
