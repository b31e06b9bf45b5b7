"""Connected components against a plain union-find."""

from __future__ import annotations

import random

import pytest

from folia.llm.common import components


@pytest.mark.parametrize("hops", [1, 3])
def test_components(spark, hops):
    draw = random.Random(5)
    edges = [(k, k + 1) for k in range(40)] + [(1000, 1001 + k) for k in range(50)] + [(draw.randrange(2000, 2300), draw.randrange(2000, 2300)) for _ in range(200)] + [(7, 7), (9000, 9000)]
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        up[top(a)] = top(b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), hops).collect()}
    assert set(got) == {x for a, b in edges if a != b for x in (a, b)}
    pairs = {(top(x), r) for x, r in got.items()}
    assert len(pairs) == len({a for a, _ in pairs}) == len({r for _, r in pairs})
    assert components(spark.createDataFrame([], "a long, b long"), hops).count() == 0
