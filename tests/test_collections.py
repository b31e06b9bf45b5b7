"""Collections, graph files, repaired records and schema summaries, by hand and by plain models."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from folia.operators import collections, datasets, extracted, merging, outlines, resolution
from folia.sources import graphs


def test_node_link_files_and_stores(spark, tmp_path):
    """A file as graph libraries write it, the store of three tables, first definitions, lookups."""
    g = {
        "graph": {"directed": False, "nodes": [{"id": "a", "entity_name": "A", "entity_type": "X", "description": "d", "source_ids": [2, 1, 2]}, {"id": "b"}], "links": [{"source": "a", "target": "b", "weight": 2, "source_ids": [3]}]},
        "tree2kg": {"7": ["a", "b", "a"], "8": []}, "variant": None,
    }
    (tmp_path / "g.json").write_text(json.dumps(g, indent=1))
    v, e, b = graphs.read_node_link(spark, str(tmp_path / "g.json"))
    assert sorted((r["id"], r["entity_name"], r["source_ids"]) for r in v.collect()) == [("a", "A", [1, 2]), ("b", None, [])]
    assert [(r["source"], r["target"], r["weight"], r["source_ids"]) for r in e.collect()] == [("a", "b", 2.0, [3])]
    assert sorted((r["node"], r["entity"]) for r in b.collect()) == [(7, "a"), (7, "b")]
    found = spark.createDataFrame([(9, 1, "c", "C2"), (8, 2, "c", "C1"), (8, 1, "a", "other"), (9, 1, "c", "C2")], "node long, pos int, id string, entity_name string")
    v2, b2 = graphs.add_and_link(v.select("id", "entity_name"), b, found)
    assert sorted((r["id"], r["entity_name"]) for r in v2.collect()) == [("a", "A"), ("b", None), ("c", "C1")]
    assert sorted((r["node"], r["entity"]) for r in b2.collect()) == [(7, "a"), (7, "b"), (8, "a"), (8, "c"), (9, "c")]
    graphs.save_graph(v2, e, b2, str(tmp_path / "store"))
    back = graphs.load_graph(spark, str(tmp_path / "store"))
    assert [x.count() for x in back] == [3, 1, 5]
    hit, miss = graphs.lookup(v2, spark.createDataFrame([("a",), ("z",), ("a",)], "id string"))
    assert [r["id"] for r in hit.collect()] == ["a"] and [r["id"] for r in miss.collect()] == ["z"]


def test_update_plan_and_names(spark):
    wanted = spark.createDataFrame([(1, "short"), (1, "longer"), (1, "bonger"), (2, "x"), (3, None)], "id int, document string")
    put, gone = collections.update_plan(wanted, spark.createDataFrame([(2,), (4,), (4,)], "id int"), "id")
    assert sorted(map(tuple, put.collect())) == [(1, "bonger"), (3, None)] and [tuple(r) for r in gone.collect()] == [(4,)]
    rows = [(1, 0, "root", None, None, None, "/x/y.tar.gz"), (1, 5, "NodeType.TITLE", "T", " s ", None, None), (2, 1, "title", None, "s", None, None), (2, 2, "title", "u", "  ", None, None), (3, 0, "NodeType.ROOT", None, None, "own.md", "/z.pdf"), (3, 1, "title", "v", "w", None, None)]
    t = spark.createDataFrame(rows, "doc int, node_id int, type string, content string, summary string, file_name string, file_path string")
    assert sorted(map(tuple, collections.title_summaries(t, ["doc"]).collect())) == [(1, 5, "T", "s", "y.tar"), (2, 1, "", "s", ""), (3, 1, "v", "w", "own")]


def test_equation_and_repair(spark):
    e = spark.createDataFrame([("a b c d e f g h i",), ("x",)], "c string").select(extracted.equation_entity(F.col("c")).alias("e"))
    assert [tuple(r["e"]) for r in e.collect()] == [("Equation: a b c d e f g h", "EQUATION_OR_FORMULA", "A formula represented by LaTeX code: a b c d e f g h i"), ("Equation: x", "EQUATION_OR_FORMULA", "A formula represented by LaTeX code: x")]
    ents = spark.createDataFrame([(1, 0, " Big  Cat", "wild animal", "one"), (1, 1, "big cat", "Wild Animal", "two"), (1, 2, "big cat", "pet", None), (2, 0, "dog", "x", "d")], "k int, pos int, name string, type string, description string")
    rels = spark.createDataFrame(
        [(1, 0, "Big Cat", "river bank", "by", 1.0, "f"), (1, 1, "big cat", " River  Bank", "by", 2.0, "g"), (1, 2, "big cats", "big cat", "is", 3.0, "h"), (3, 0, "p", "q", "r", 1.0, "")],
        "k int, pos int, src string, dst string, relation string, weight double, description string")
    e, r = extracted.repair_records(ents, rels, "k")
    assert sorted(map(tuple, e.collect())) == [(1, "big cat", "PET", ""), (1, "big cat", "WILD_ANIMAL", "one two"), (1, "big cats", "UNKNOWN", ""), (1, "river bank", "UNKNOWN", ""), (2, "dog", "X", "d"), (3, "p", "UNKNOWN", ""), (3, "q", "UNKNOWN", "")]
    assert sorted(map(tuple, r.collect())) == [(1, "big cat", "river bank", "by", 1.0, "f"), (1, "big cats", "big cat", "is", 3.0, "h"), (3, "p", "q", "r", 1.0, "")]


def test_schema_summary(spark):
    rows = [
        ([["", "A", "B"], ["r1", "1", "2"], ["r2", "3", "%"], ["", "5", "note"]], "Cap", "Foot"), ([["A", "B"], ["x", "y"], ["", "z"]], "", None),
        ([["1", "2"], ["3"]], None, None), ([], "Only", "f"), (None, None, None), ([["", None]], "C", ""),
    ]
    df = spark.createDataFrame(rows, "g array<array<string>>, c string, f string")
    got = [r[0] for r in df.select(extracted.schema_summary(F.col("g"), F.col("c"), F.col("f"))).collect()]
    assert got == [
        "Table Caption: Cap\nType: Data-heavy table (schema summary)\nColumn Labels: A, B, r1\nRow Labels: A, r1, r2\nOther Labels: note\nFootnote: Foot",
        "Type: Text-heavy table (full linearization)\nRow 1: 'A' is 'x'; 'B' is 'y';\nRow 2: 'B' is 'z';", "Type: Data-heavy table (schema summary)", "Only", "", "C",
    ]


def test_levels_of_a_model(spark):
    titles = spark.createDataFrame([("d", k, 1, f"t{k}") for k in range(5)], "doc string, at int, level int, text string")
    given = spark.createDataFrame([("d", 0, 0, 0), ("d", 1, -1, 0), ("d", 2, 2, 0), ("d", 2, 3, 9), ("d", 9, 1, 0)], "doc string, at int, level int, parent int")
    got = outlines.apply_levels(titles, given, ["doc"], "at", "level")
    assert sorted((r["at"], r["level"], r["parent"], r["text"]) for r in got.collect()) == [(0, 0, 0, "t0"), (2, 2, 0, "t2")]


def test_samples_of_groups(spark):
    nodes = spark.createDataFrame(
        [(1, "NodeType.TEXT", "x" * 600, None, None, None, 0), (2, "NodeType.TABLE", "c", "", "b" * 600, None, None), (3, "NodeType.IMAGE", None, "cap", None, "s" * 400, 4), (4, "NodeType.TITLE", "T", None, None, None, 2)],
        "index_id int, type string, content string, caption string, table_body string, summary string, page_idx int")
    groups = spark.createDataFrame([(1, [3, 1, 3, 99, 2], "a"), (2, [1], "b"), (3, [99, 98], "c"), (4, [4, 3, 2, 1, 4], "d")], "group_id int, ids array<int>, how string")
    good = datasets.valid_groups(groups, nodes)
    assert sorted((r["group_id"], r["ids"]) for r in good.collect()) == [(1, [3, 1, 2]), (4, [4, 3, 2, 1])]
    qa = spark.createDataFrame([(1, " why? ", " so "), (2, "q", "a"), (9, "q", "a")], "group_id int, question string, answer string")
    got = {r["group_id"]: r for r in datasets.assemble_samples(good.unionByName(groups.where("group_id = 2")), nodes, qa).collect()}
    assert sorted(got) == [1, 2] and (got[1]["question"], got[1]["answer"], got[1]["chunk_ids"], got[1]["chunk_types"], got[1]["is_multi_chunk"], got[1]["how"]) == ("why?", "so", [3, 1, 2], ["image", "text", "table"], True, "a")
    assert [tuple(e) for e in got[1]["evidences"]] == [(3, "image", 5, ("cap | " + "s" * 400)[:300]), (1, "text", 1, "x" * 500), (2, "table", None, "b" * 500)]
    assert not got[2]["is_multi_chunk"]
    single, multi = spark.range(50).withColumnRenamed("id", "group_id"), spark.range(100, 103).withColumnRenamed("id", "group_id")
    took = datasets.sample_groups(single, multi, 15, 0.7, 3).collect()
    assert [sum(r["kind"] == k for r in took) for k in ("single", "multi")] == [10, 3] and len({r["place"] for r in took}) == 13


def test_decisions_and_refined_texts(spark):
    c = spark.createDataFrame([(1, 5, 0.9), (1, 4, 0.9), (1, 3, 0.2), (2, 1, 0.4), (3, 7, 0.6), (3, 8, 0.5)], "g int, id int, score double")
    assert sorted(map(tuple, resolution.decide(c, "g").collect())) == [(1, 4, 0.9), (3, 7, 0.6)]
    chosen = spark.createDataFrame([(1, 1), (2, 0), (3, 2)], "g int, index int")
    assert sorted(map(tuple, resolution.decide(c, "g", chosen=chosen).collect())) == [(1, 5, 0.9)]
    assert resolution.decide(c, "g", chosen=spark.createDataFrame([(1, -1), (3, None)], "g int, index int")).count() == 0
    e = spark.createDataFrame([("a<SEP> b<SEP>a<SEP>",), ("plain",), (None,), ("<SEP>",)], "description string")
    assert [r[0] for r in merging.refined_descriptions(e).collect()] == ["a; b", "plain", None, ""]
