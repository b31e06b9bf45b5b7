"""op10: queries that find fewer than k rows in their buckets."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from folia.llm import common, crosspolytope


def nearest(spark, ids, x):
    rows = [(int(i), v.tolist()) for i, v in zip(ids, x)]
    by = defaultdict(list)
    for r in crosspolytope.nearest(common.written(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))).orderBy("query_id", "rank").collect():
        by[r["query_id"]].append(r["vec_id"])
    return dict(by)


def brute(ids, x, q):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = unit @ unit[q]
    return [int(ids[k]) for k in np.lexsort((ids, -s)) if k != q][:5]


@pytest.mark.parametrize("n", [2, 5, 8])
def test_tiny_table(spark, n):
    ids = np.arange(n)
    x = np.random.default_rng(n).normal(size=(n, 64))
    got = nearest(spark, ids, x)
    assert set(got) == {0} and len(got[0]) == min(5, n - 1)
    if n <= 6:
        assert got[0] == brute(ids, x, 0)


def test_tight_cluster_and_queries_outside(spark, monkeypatch):
    monkeypatch.setattr(crosspolytope, "BLOCK", (512, 16))
    rng = np.random.default_rng(7)
    ids = np.arange(3000)
    x = rng.normal(size=64) + 0.01 * rng.normal(size=(3000, 64))
    asked = np.flatnonzero(ids % 50 == 0)
    x[asked] = rng.normal(size=(len(asked), 64))
    got = nearest(spark, ids, x)
    assert set(got) == set(asked.tolist()) and all(len(v) == 5 for v in got.values())
    assert sum(got[q] == brute(ids, x, q) for q in asked.tolist()) >= 5


def test_finite_vectors_of_any_size(spark):
    """Components whose squares over- or underflow, among usual ones; scaling by a power of two changes no score."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 16))
    scale = np.ones(300)
    scale[::7], scale[1::7], scale[2::7] = 1e200, 1e-200, 2.0**-1000
    scale[50], scale[100] = 1e-200, 1e200
    x = base * scale[:, None]
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    got = crosspolytope.nearest(common.written(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), probes=32).orderBy("query_id", "rank").collect()
    by = defaultdict(list)
    for r in got:
        assert np.isfinite(r["score"])
        by[r["query_id"]].append(r["vec_id"])
    ids = np.arange(300)
    assert {q: v for q, v in by.items()} == {q: brute(ids, base, q) for q in range(0, 300, 50)}


def test_one_id_with_several_vectors(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 8))
    rows = [(int(i % 50), v.tolist()) for i, v in enumerate(x)]
    got = crosspolytope.nearest(common.written(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))).collect()
    assert {r["query_id"] for r in got} == {0} and len(got) == 5 and len({r["vec_id"] for r in got}) == 5 and 0 not in {r["vec_id"] for r in got}
