"""Span alignment against all permutations, above seven spans too."""

from __future__ import annotations

from itertools import permutations

import numpy as np

from folia.operators import metrics
from folia.plans import metric_queries


def test_assignment_is_the_optimum():
    rng = np.random.default_rng(5)
    for n, w in [(1, 1), (1, 4), (3, 3), (2, 6), (4, 8), (8, 8)]:
        m = rng.integers(0, 5, (n, w)) / 4
        assert abs(metrics.assignment(m) - max(sum(m[i, j] for i, j in enumerate(q)) for q in permutations(range(w), n))) < 1e-9


def test_query_takes_whole_turns(spark, tiny):
    p = metric_queries.pairs(spark, tiny)
    assert p.where("size(split(gold, ' ')) > 12").count() > 0
    assert metric_queries.metric_aligned_f1(spark, tiny).count() == p.count()
