"""Whitening against a dense eigensolver, and its edges."""

import math
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from coldshelf.llm import whitening
from coldshelf.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def dense(x):
    distinct = np.unique(x, axis=0)
    centred = distinct - distinct.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(distinct))
    return distinct, values[::-1], vectors[:, ::-1]


def check(found, ids, x, components=4):
    distinct, values, vectors = dense(x)
    n, sums = len(distinct), [sum(map(int, c)) for c in distinct.T.astype(int)]
    rows = {(r.vec_id, r.component): r for r in found}
    assert len(rows) == len(found) == len(ids) * components
    signs = {}
    for k in range(1, components + 1):
        along = (x - distinct.mean(axis=0)) @ vectors[:, k - 1] / math.sqrt(values[k - 1])
        got = np.array([rows[i, k].whitened for i in ids])
        signs[k] = 1 if np.abs(got - along).max() < np.abs(got + along).max() else -1
        assert np.abs(got - signs[k] * along).max() < 1e-7
    for i, v in zip(ids, x.astype(int).tolist()):
        r = rows[i, 1]
        assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(v, sums))
    for k in range(1, components + 1):
        assert abs(rows[ids[0], k].explained - values[k - 1] / values.sum()) < 1e-10
    assert {r.identity_error for r in found} == {found[0].identity_error} and found[0].identity_error < 1e-9


def test_query_matches_a_dense_solver(spark):
    rows = duckdb.execute(f"SELECT vec_id, embedding FROM '{SF_DIR}/embeddings.parquet'").fetchall()
    x = np.floor(256 * np.array([np.array(v, np.float32).astype(float) for _, v in rows]))
    check(QUERIES["op12_whitening"](spark, SF_DIR).collect(), [i for i, _ in rows], x)


def product_of(values, seed=5):
    turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    matrix = turn * values @ turn.T
    calls = []

    def product(block):
        calls.append(block.shape[1])
        return matrix @ block

    return product, turn, calls


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(100, 1, 200),
        np.concatenate(([1000.0, 999.9, 500, 499.99], np.linspace(499, 480, 196))),
        np.concatenate(([5.0, 5.0, 5.0, 4.0], np.linspace(3, 0, 96))),
        np.concatenate(([1e6, 1.0, 0.9, 0.8], np.linspace(0.7, 0.1, 60))),
        np.concatenate(([3.0, 2.0], np.zeros(80))),
        np.full(50, 7.0),
        np.zeros(30),
        np.array([4.0, 2.0, 1.0]),
        np.array([1.0]),
    ],
)
def test_leading_components_of_known_matrices(values):
    product, turn, calls = product_of(values)
    count = min(4, len(values))
    found, vectors, certified = whitening.leading(product, len(values), count)
    assert certified and len(calls) < 200
    assert np.abs(found - values[:count]).max() <= 1e-11 * max(values[0], 1e-300)
    for i in range(count):
        same = np.abs(values - values[i]) <= 1e-9 * values[0]
        if values[0] > 0:
            # Inside the space of all equal values.
            assert np.linalg.norm(turn[:, same].T @ vectors[:, i]) == pytest.approx(1, abs=1e-9)
    assert np.abs(vectors.T @ vectors - np.eye(count)).max() < 1e-12


def test_the_filter_damps_the_unwanted_part():
    values = np.linspace(1, 10, 10)
    block = np.eye(10)
    out = np.diag(whitening.filtered(lambda b: values[:, None] * b, block, values[:, None] * block, 1.0, 8.0, 10.0))
    assert out[9] > 0.5 and np.abs(out[:8]).max() < out[9] * 1e-4


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("x", F.lit("clash")).withColumn("component", F.lit(1))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(8)
    good = [(i, rng.standard_normal(6).tolist(), i % 3) for i in range(40)]
    bad = [(100, None, 0), (101, [nan] + [1.0] * 5, 0), (102, [inf] + [1.0] * 5, 0), (103, [-inf] + [1.0] * 5, None), (104, [None] + [1.0] * 5, 0)]
    short = [(50, [1.5, -2.0], 0), (51, [], 0)]
    again = [(60, good[0][1], 0), (None, good[1][1], 0)]
    found = whitening.whitened(table(spark, good + bad + short + again)).collect()
    vectors = [(i, v + [0.0] * (6 - len(v))) for i, v, _ in good + short + again]
    check(found, [i for i, _ in vectors], np.floor(256 * np.array([v for _, v in vectors])))


def test_without_variance_or_rows(spark):
    assert whitening.whitened(table(spark, [])).collect() == []
    assert whitening.whitened(table(spark, [(1, None, 0), (2, [], 0)])).collect() == []
    one = whitening.whitened(table(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 1)])).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one) == [
        (i, k, 1, 0, None, None, None) for i in (1, 2) for k in (1, 2)
    ]
    line = whitening.whitened(table(spark, [(i, [float(i), 2.0 * i, 0.0], 0) for i in range(5)])).collect()
    assert {r.whitened is None for r in line if r.component > 1} == {True}
    assert all(r.identity_error < 1e-12 and r.whitened is not None for r in line if r.component == 1)


def test_large_entries_are_exact_or_null(spark):
    found = whitening.whitened(table(spark, [(1, [1e7, 0.0], 0), (2, [-1e7, 1.0], 0), (3, [1e300, 0.0], 0)])).collect()
    x = {1: [2_560_000_000, 0], 2: [-2_560_000_000, 256], 3: [(1 << 63) - 1, 0]}
    sums = [sum(c) for c in zip(*x.values())]
    for r in found:
        exact = sum((3 * a - s) ** 2 for a, s in zip(x[r.vec_id], sums))
        assert r.deviation == (exact if exact < 1 << 63 else None)
