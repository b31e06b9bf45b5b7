"""Tables that are dealt by keys over tasks that follow their rows: the same results, in more tasks."""

from __future__ import annotations

import pytest

from folia.operators import table_graph, tree
from folia.plans import catalog, runtime


def test_dealt(spark, monkeypatch):
    df = spark.range(100)
    assert runtime.dealt(df, 10**6, "id") is df  # four partitions are enough
    monkeypatch.setattr(runtime, "ROWS", 10)
    assert runtime.dealt(df, 100, "id").rdd.getNumPartitions() == 10


@pytest.mark.parametrize("name", "graph_degree renamed_edges ppr_node_mass table_relations routed_hits bm25_topk text_rerank".split())
def test_same_results(spark, tiny, monkeypatch, name):
    def rows():
        return sorted(map(tuple, catalog.QUERIES[name](spark, tiny).collect()))

    usual = rows()
    dealt = []
    monkeypatch.setattr(runtime, "ROWS", 400)
    repartition = type(spark.range(1)).repartition
    monkeypatch.setattr(type(spark.range(1)), "repartition", lambda self, n, *c: dealt.append(n) or repartition(self, n, *c))
    assert rows() == usual and max(dealt) > 4


def test_relations_of_one_reading(spark):
    """The name of a table comes from its own rows, not from a second making of all entities; tables without a key or without an own entity give none."""
    e = spark.createDataFrame([("k", 0, "t", "TABLE"), ("k", 1, "a", "COLUMN"), ("k", 2, "b", "TABLE"), ("m", 1, "c", "COLUMN"), (None, 0, "u", "TABLE"), (None, 1, "d", "X")], "k string, place int, name string, type string")
    out = table_graph.table_relations(e, "k")
    assert [(r["src"], r["dst"]) for r in out.collect()] == [("t", "a")]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_paths_end_at_leaves(spark, monkeypatch):
    """Leaves are not held against all nodes once more: a level with no parent among its nodes is the last."""
    rows = [("r", None), ("a", "r"), ("b", "r"), ("c", "a"), ("x", "y"), ("y", "x"), ("z", "gone")]
    met = []
    materialize = runtime.materialize
    monkeypatch.setattr(runtime, "materialize", lambda df: met.append(df.columns) or materialize(df))
    got = {r["node_id"]: (r["depth"], r["path"]) for r in tree.with_paths(spark.createDataFrame(rows, "node_id string, parent_id string"), []).collect()}
    assert got == {"r": (0, ["r"]), "a": (1, ["r", "a"]), "b": (1, ["r", "b"]), "c": (2, ["r", "a", "c"])}
    assert sum("depth" in c for c in met) == 2  # two levels below the root, and no empty one
