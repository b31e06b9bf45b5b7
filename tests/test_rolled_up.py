"""Roll-up with paths for inner nodes only, against paths for all."""

from __future__ import annotations

import pytest

from folia.operators import tree
from folia.plans import runtime, tree_queries


@pytest.mark.parametrize("rows", [250_000, 3])
def test_equal_to_paths_of_all(spark, monkeypatch, rows):
    """Two documents, repeated nodes, one under two parents, a root alone, cycles, missing parents, null values and ids; leaves get no path."""
    nodes = [("x", 1, None, 1.0), ("x", 2, 1, 2.0), ("x", 2, 1, 5.0), ("x", 3, 2, 4.0), ("x", 4, 2, None), ("x", 4, 3, 8.0), ("x", 9, 8, 1.0), ("x", 6, 7, 1.0), ("x", 7, 6, 1.0), ("x", 5, 7, 1.0)]
    nodes += [("y", 1, None, None), ("y", 2, 1, None), ("z", 3, None, 3.0), ("x", None, 3, 16.0), ("x", 10, 1, 32.0), (None, 1, None, 1.0), (None, 2, 1, 1.0)]
    df = spark.createDataFrame(nodes, "d string, node_id int, parent_id int, v double")
    want = sorted(map(tuple, tree.roll_up(tree.with_paths(df, ["d"]), ["d"], "v").collect()), key=repr)
    monkeypatch.setattr(runtime, "ROWS", rows)
    pathed, made = [], tree.with_paths
    monkeypatch.setattr(tree, "with_paths", lambda df, doc: pathed.append(made(df, doc)) or pathed[-1])
    out = tree.rolled_up(df, ["d"], "v")
    assert out.columns == ["d", "node_id", "n_nodes", "total"]
    assert sorted(map(tuple, out.collect()), key=repr) == want
    assert {r["node_id"] for r in pathed[0].collect()} == {1, 2, 3}  # the roots and nodes with children


def test_query_gives_leaves_no_path(spark, tiny, monkeypatch):
    pathed, made = [], tree.with_paths
    monkeypatch.setattr(tree, "with_paths", lambda df, doc: pathed.append(made(df, doc)) or pathed[-1])
    lines = tree_queries.tree_bottom_up_rollup(spark, tiny).where("node_id like 'l%'").count()
    assert lines > 1000 and not pathed[0].where("node_id like 'l%'").count()
