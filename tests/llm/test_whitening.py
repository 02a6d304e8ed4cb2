"""Operator 12: spectrum slicing against the library's solver, exact sums, whitened rows."""

import itertools
from fractions import Fraction

import numpy as np
import pytest

from tracelode.llm import spectrum, whitening
from tracelode.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def matrices():
    rng = np.random.default_rng(7)
    for n in (1, 2, 3, 7, 8, 9, 40, 64):
        x = rng.standard_normal((n + 6, n)) / np.sqrt(np.arange(n) + 1)
        yield x.T @ x * 1e4
    for values in ([5] * 4 + [2] * 3 + [1] * 13, [3] * 20, [7, 7, 0] + [0] * 9, [1, 1e-9, 1e-18, 0], [4, 4 - 1e-9, 4 - 2e-9, 1, 1, 0], [-3, 2, -1, 5]):
        q, _ = np.linalg.qr(rng.standard_normal((len(values),) * 2))
        a = q @ np.diag(np.array(values, float)) @ q.T
        yield (a + a.T) / 2
    yield np.zeros((5, 5))
    yield np.diag([1.0, 2.0, 3.0])
    yield np.array([[0.0, 1.0], [1.0, 0.0]])
    yield np.array([[0.0, 1, 2], [1, 0, 3], [2, 3, 0]])


@pytest.mark.parametrize("matrix", list(matrices()))
def test_leading_pairs(matrix):
    true = np.linalg.eigvalsh(matrix)[::-1]
    norm = max(np.abs(true).max(), 1e-300)
    got = spectrum.leading(matrix, 8)
    k = min(8, len(matrix))
    assert len(got.values) == k and got.certified.all()
    assert np.abs(got.values - true[:k]).max() <= 1e-13 * norm
    assert np.abs(got.vectors.T @ got.vectors - np.eye(k)).max() < 1e-13
    assert np.abs(matrix @ got.vectors - got.vectors * got.values).max() <= 1e-12 * norm
    for shift in np.random.default_rng(1).uniform(true.min() - norm, true.max() + norm, 20):
        assert spectrum.above(matrix, shift) == int((true > shift).sum())


def test_products_are_exact():
    rng = np.random.default_rng(2)
    for top in (3, 2000, 1 << 30, 1 << 44):
        y = rng.integers(-top, top, (40, 5))
        want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(5)] for i in range(5)]
        assert whitening.products(y).tolist() == want


def plain(vectors):
    """Rows kept, integer entries, n, exact sums, exact covariance."""
    kept = [i for i, v in enumerate(vectors) if v and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(1024 * c)) + 100_000 for c in vectors[i]] for i in kept]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    cov = np.array([[float(sum(Fraction(n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x) / n**3) for j in range(d)] for i in range(d)])
    return kept, x, n, sums, cov


def test_against_exact_arithmetic(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.standard_normal((70, 12)) * (1 + np.arange(12)) + 3).astype(np.float32).astype(float).tolist()
    vectors += [vectors[0], vectors[0], None, [], [1.0] * 5, [None] + [0.0] * 11, [float("nan")] * 12, [float("inf")] + [0.0] * 11, [1e30] + [0.0] * 11]
    ids = [*range(70), 0, None, *range(200, 207)]
    frame = spark.createDataFrame(list(zip(ids, vectors)), "vec_id long, embedding array<double>").repartition(4)
    frame = frame.selectExpr("*", "'x' AS whitened", "1 AS deviation", "2 AS key", "3 AS vector", "4 AS n")
    usable = [v if v and len(v) == 12 and v[0] != 1e30 else None for v in vectors]
    kept, x, n, sums, cov = plain(usable)
    model = whitening.fit(frame)
    assert (model.n, model.sums) == (n, sums)
    true, basis = np.linalg.eigh(cov)
    true, basis = true[::-1][:8], basis[:, ::-1][:, :8]
    assert np.allclose(model.values, true, rtol=1e-12)
    assert np.abs(np.abs((basis * model.vectors).sum(axis=0)) - 1).max() < 1e-12
    assert np.allclose(model.explained, true / np.trace(cov), rtol=1e-12)
    assert model.identity_error < 1e-9
    rows = whitening.whitened(frame, model).collect()
    want = []
    for i, r in zip(kept, x):
        own = (np.array(r) - np.array([s / n for s in sums])) @ (model.vectors / np.sqrt(model.values))
        want.append((ids[i], sum((n * a - s) ** 2 for a, s in zip(r, sums)), own))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert len(rows) == len(want)
    for got, (vec_id, deviation, own) in zip(sorted(rows, key=key), sorted(want, key=key)):
        assert (got[0], got[1]) == (vec_id, deviation)
        assert np.allclose(got[2], own, atol=1e-9)


def test_results_do_not_depend_on_partitions(spark):
    frame = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    one, many = whitening.fit(frame.coalesce(1)), whitening.fit(frame.repartition(7))
    assert one.sums == many.sums and (one.values == many.values).all() and (one.vectors == many.vectors).all()


def test_tables_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        assert whitening.fit(spark.createDataFrame(rows, schema)) is None
    flat = whitening.fit(spark.createDataFrame([(1, [0.0, 2.0]), (2, [1.0, 2.0]), (3, [4.0, 2.0])], schema))
    assert len(flat.values) == 1 and flat.explained.tolist() == [1.0]


def test_a_deviation_beyond_a_long_is_null(spark):
    frame = spark.createDataFrame([(i, [float(i % 2) * 4e6, 1.0 * i]) for i in range(4)], "vec_id long, embedding array<double>")
    model = whitening.fit(frame)
    got = {r["vec_id"]: r["deviation"] for r in whitening.whitened(frame, model).collect()}
    for i in range(4):
        x = [int(1024 * (i % 2) * 4e6) + 100_000, 1024 * i + 100_000]
        true = sum((model.n * a - s) ** 2 for a, s in zip(x, model.sums))
        assert got[i] == (true if true < 2**63 * 0.999 else None)
    assert None in got.values()


def test_query(spark):
    rows = QUERIES["op12_whitening"](spark, SF_DIR).collect()
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    x = np.floor(1024 * np.array([r["embedding"] for r in table], np.float64)).astype(np.int64) + 100_000
    cov = np.cov(x.T, bias=True)
    true, basis = np.linalg.eigh(cov)
    true, basis = true[::-1], basis[:, ::-1]
    assert len(rows) == 8 * len(table)
    by_id = {r["vec_id"]: i for i, r in enumerate(table)}
    signs = {}
    for r in rows:
        i, k = by_id[r["vec_id"]], r["component"] - 1
        own = (x[i] - x.mean(axis=0)) @ basis[:, k] / np.sqrt(true[k])
        signs.setdefault(k, np.sign(own * r["whitened"]))
        assert abs(own * signs[k] - r["whitened"]) < 1e-8
        assert abs(r["explained"] - true[k] / np.trace(cov)) < 1e-10
        assert r["n"] == len(table) and r["identity_error"] < 1e-9
    assert all(len(list(g)) == 8 for _, g in itertools.groupby(sorted(r["vec_id"] for r in rows)))
