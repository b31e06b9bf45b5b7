"""Continuations, stitching, trees and retrieval pieces against plain models."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from folia.operators import metrics, repair, retrieval, tree


def scan(rows, at, gap=2):
    """The plain forward scan."""
    picked, capitals = [], 0
    for r in rows[at + 1 :]:
        if r["page"] > rows[at]["page"] + gap:
            break
        if r["type"] in ("table", "image") or (r["text_level"] if r["text_level"] is not None else -1) >= 0:
            continue
        if r["type"] == "equation":
            picked.append(r["pos"])
            continue
        t = (r["text"] or "").strip()
        if len(t) < 3:
            continue
        word = t.split(" ")[0]
        if t[0].islower() or word.isupper() and len(word) > 1:
            picked.append(r["pos"])
        elif t[0].isupper():
            capitals += 1
            if capitals > 1 or picked:
                break
            picked.append(r["pos"])
        else:
            break
    return picked


def test_continuations(spark):
    r = random.Random(1)
    starts = ["lower case words", "Upper case words", "NASA said so", "1 is a number", "ab", "", "é accent", "- dash"]
    rows = []
    for doc in range(6):
        page = 0
        for pos in range(60):
            page += r.random() < 0.15
            kind = r.choice(["text"] * 8 + ["table", "image", "equation"])
            rows.append((doc, pos, page, kind, 1 if kind == "text" and r.random() < 0.1 else None, r.choice(starts) + ("-" if r.random() < 0.2 else "")))
    df = spark.createDataFrame(rows, "doc int, pos int, page int, type string, text_level int, text string")
    got = {(x["doc"], x["pos"]): (x["picked"], x["merged"]) for x in repair.continuations(df, ["doc"], "true").collect()}
    names = ["doc", "pos", "page", "type", "text_level", "text"]
    for doc in range(6):
        own = [dict(zip(names, x)) for x in rows if x[0] == doc]
        for k in range(60):
            picked = scan(own, k)
            merged = "".join(t[:-1] if t.endswith("-") else t + " " for t in [own[k]["text"], *(own[p]["text"] for p in picked)]).strip()
            assert got[doc, k] == (picked, merged)


def test_deep_chain_is_whole(spark):
    rows = [(k, k - 1 if k else None) for k in range(100)] + [(500, 501), (501, 500)]
    out = tree.with_paths(spark.createDataFrame(rows, "node_id int, parent_id int"), [])
    assert out.count() == 100 and out.agg(F.max("depth")).first()[0] == 99


def test_typed_scores(spark):
    rows = [
        ("Int", "12", "12.7", 1.0), ("Int", "12", "13", 0.0), ("Int", "12", "a", 0.0), ("Float", "50%", "50", 1.0), ("Float", "0.5", "50", 1.0), ("Float", "0.5", "0.6", 0.0), ("Float", "50", "0.5", 1.0), ("Float", "3.14159", "3.14", 1.0),
        ("Str", "https://a.example/x", "https://a.example/y", 0.0), ("Str", "Paris (France)", "paris", 1.0), ("Str", "kitten", "kittex", 1 - 1 / 6), ("Str", "ab", "zz", 0.0), ("Str", "page 5", "Page 5", 1.0),
        ("List", '["b", "a"]', '["A", "B"]', 1.0), ("List", '["a"]', '["a", "b"]', 0.0), ("List", '["1", "2"]', '["2", "3"]', 0.0), ("List", "one thing", "one thing", 1.0), ("None", "Not answerable", "not answerable", 1.0),
    ]
    df = spark.createDataFrame(rows, "k string, g string, p string, want double")
    for r in df.withColumn("got", metrics.typed_score(F.col("k"), F.col("g"), F.col("p"))).collect():
        assert abs(r["got"] - r["want"]) < 1e-9, r


def test_tree_of_nested_ranges(spark):
    blocks = spark.createDataFrame([(1, k) for k in range(8)], "doc int, pdf_id int")
    outline = spark.createDataFrame([(1, 0, 0, None, 8), (1, 2, 1, 0, 5), (1, 5, 2, 99, 8)], "doc int, pdf_id int, text_level int, parent_id int, end_id int")
    rows = repair.build_tree(blocks, outline, ["doc"]).orderBy("index_id").collect()
    assert [(r["pdf_id"], r["parent_index"], r["outline_node"]) for r in rows] == [
        (0, 0, True), (1, 1, False), (2, 1, False), (3, 1, False), (4, 1, False), (5, 1, False), (6, 1, False), (7, 1, False),
        (2, 1, True), (3, 9, False), (4, 9, False), (5, None, True), (6, 12, False), (7, 12, False),
    ]


def test_entity_links_force_one(spark):
    q = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<double>")
    e = spark.createDataFrame([(10, [1.0, 0.1]), (11, [-1.0, 0.5])], "vec_id long, embedding array<double>")
    assert {r["query_id"] for r in retrieval.link_entities(q, e, 0.2).collect()} == {0}
    assert retrieval.link_entities(q, e, 0.0001).count() == 1
    scores = retrieval.vector_scores(spark.createDataFrame([(1,), (2,)], "node int"), spark.createDataFrame([(1, [1.0, 2.0])], "node int, v array<double>"), [3.0, 1.0])
    assert {r["node"]: r["score"] for r in scores.collect()} == {1: 5.0, 2: 0.0}
    g = spark.createDataFrame([(1, 0.5), (2, 0.1)], "node int, score double")
    t = spark.createDataFrame([(1, 0.2), (3, 0.9)], "node int, score double")
    assert {r["node"] for r in retrieval.select_nodes(g, t, 1).collect()} == {1, 3}
    sub = retrieval.subgraph_of(spark.createDataFrame([(1, 2, 1), (2, 3, 1)], "a int, b int, weight int"), spark.createDataFrame([(7, 1), (7, 2), (8, 3)], "node int, entity int"), spark.createDataFrame([(7,)], "node int"))
    assert [(r["a"], r["b"], r["weight"]) for r in sub.collect()] == [(1, 2, 1)]


def test_question_validity(spark):
    rows = [("What is it?", "a thing", True), ("What", "a thing", False), ("same same", "same same", False), ("在哪一页？出现", "a thing", False), ("seven77", "a thing", False), ("eight888", "a thing", True)]
    df = spark.createDataFrame(rows, "q string, a string, want boolean")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", repair.valid_qa(F.col("q"), F.col("a"))).collect())
    assert spark.range(1).select(retrieval.vertex_id(F.lit("a"), F.lit("B"))).first()[0] == "Name: a\nType: B"
