"""Plans, extraction in rounds and chunked outlines against plain models."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from folia.operators import gleaning, outlines, planning, tree


def test_plan_of_questions(spark):
    q = spark.createDataFrame([(1, "Who wrote it? That town, and their size; and how"), (2, "One part only"), (3, " "), (4, None), (5, "find the river and then it length")], "q int, text string")
    got = {}
    for r in planning.plan_questions(q, "q", "text").collect():
        got.setdefault(r["q"], []).append((r["step"], r["type"], r["question"], r["depends"]))
    assert sorted(got) == [1, 2, 5]
    assert sorted(got[1]) == [
        (0, "retrieval", "Who wrote it", []), (1, "retrieval", "{0} town", [0]), (2, "retrieval", "{1} size", [1]), (3, "retrieval", "and how", []),
        (4, "synthesis", "Who wrote it? That town, and their size; and how", [0, 1, 2, 3]),
    ]
    assert got[2] == [(0, "retrieval", "One part only", [])]
    assert sorted(got[5])[:2] == [(0, "retrieval", "find the river", []), (1, "retrieval", "{0} length", [0])]


def test_levels_and_problems(spark):
    steps = [(1, 0, []), (1, 1, [0]), (1, 2, [0, 1]), (1, 3, []), (2, 0, [1]), (2, 1, [0]), (2, 2, [1]), (2, 3, [9]), (2, 4, [3]), (2, 5, []), (3, 0, [0]), (4, 7, [8, 8]), (4, 8, []), (5, 0, [1]), (5, 1, [2]), (5, 2, [0]), (5, 3, [2]), (5, 4, [3])]
    done, bad = planning.plan_levels(spark.createDataFrame(steps, "q int, step int, depends array<int>"), "q")
    assert sorted(map(tuple, done.collect())) == [(1, 0, 0), (1, 1, 1), (1, 2, 2), (1, 3, 0), (2, 5, 0), (4, 7, 1), (4, 8, 0)]
    assert sorted(map(tuple, bad.collect())) == [
        (2, 0, "cycle"), (2, 1, "cycle"), (2, 2, "waits"), (2, 3, "missing"), (2, 4, "waits"), (3, 0, "cycle"), (5, 0, "cycle"), (5, 1, "cycle"), (5, 2, "cycle"), (5, 3, "waits"), (5, 4, "waits"),
    ]


def test_run_plans(spark):
    steps = [(1, 0, "retrieval", "who", []), (1, 1, "retrieval", "age of {0} and {0}", [0]), (1, 2, "retrieval", "{1} {0}", [1, 0]), (1, 3, "synthesis", "all", [0, 1, 2]), (2, 0, "retrieval", "x{0}", []), (3, 0, "retrieval", "y", [0])]
    df = spark.createDataFrame(steps, "q int, step int, type string, question string, depends array<int>")
    done, bad = planning.run_plans(df, "q", lambda t: t.where("asked <> 'x{0}'").withColumn("answer", F.concat(F.lit("<"), "asked", F.lit(">"))))
    got = {(r["q"], r["step"]): (r["level"], r["asked"], r["answer"]) for r in done.collect()}
    who, age = "<who>", "<age of <who> and <who>>"
    assert got[1, 0] == (0, "who", who) and got[1, 1] == (1, "age of <who> and <who>", age) and got[1, 2] == (2, f"{age} {who}", f"<{age} {who}>")
    assert got[1, 3][1] == f"all\nwho: {who}\nage of <who> and <who>: {age}\n{age} {who}: <{age} {who}>"
    assert got[2, 0] == (0, "x{0}", "") and (3, 0) not in got and [tuple(r) for r in bad.collect()] == [(3, 0, "cycle")]
    assert planning.run_plans(df.limit(0), "q", lambda t: t.withColumn("answer", F.lit("")))[0].count() == 0


@pytest.mark.parametrize("patience", [1, 2])
def test_gleaning_rounds(spark, patience):
    """Rounds and records against a loop, with an extractor that finds some records again."""
    r = random.Random(patience)
    plan = {c: [[f"r{r.randrange(6)}" for _ in range(r.choice([0, 0, 1, 2]))] for _ in range(6)] for c in range(40)}
    rows = [(c, n, x) for c, v in plan.items() for n, found in enumerate(v) for x in found]
    all_of = spark.createDataFrame(rows, "chunk_id int, n int, record string")
    asked = []

    def extract(front, n):
        asked.append({x["chunk_id"] for x in front.select("chunk_id").collect()})
        return front.join(all_of.where(F.col("n") == n), "chunk_id").select("chunk_id", F.lit("k").alias("kind"), "record")

    got = {(x["chunk_id"], x["record"], x["round"]) for x in gleaning.glean(spark.createDataFrame([(c, "") for c in plan], "chunk_id int, text string"), extract, 5, patience).collect()}
    want, fronts = set(), []
    seen, idle = {c: set() for c in plan}, dict.fromkeys(plan, 0)
    front = set(plan)
    for n in range(5):
        if not front:
            break
        fronts.append(set(front))
        for c in sorted(front):
            new = set(plan[c][n]) - seen[c]
            want |= {(c, x, n) for x in new}
            seen[c] |= new
            idle[c] = 0 if new else idle[c] + 1
        front = {c for c in front if idle[c] < patience}
    assert got == want and asked == fronts and len(fronts) > 2


def test_default_extractor(spark):
    docs = spark.createDataFrame([(1, "we met Anna, Bob at x.y@z.org on 2024 with NASA"), (2, "nothing here 12345")], "chunk_id int, text string")
    got = sorted((x["chunk_id"], x["kind"], x["record"], x["round"]) for x in gleaning.glean(docs, most_rounds=5).collect())
    assert got == [(1, "address", "x.y@z.org", 1), (1, "name", "Anna", 0), (1, "name", "Bob", 0)]


@pytest.mark.parametrize("budget", [None, 7])
def test_outline_in_chunks(spark, budget):
    """Parents as in one pass over the document; contexts as a stack gives them; one document holds most titles."""
    r = random.Random(9)
    rows = [(d, k * 3, r.choice([0, 1, 1, 2, 2, 3]), " ".join("w" * r.randint(1, 4))) for d, n in ((1, 300), (2, 5), (3, 1)) for k in range(n)]
    df = spark.createDataFrame(rows, "d int, at long, level int, text string")
    got = outlines.outline_in_chunks(df, ["d"], "at", "level", 3, text="text" if budget else None, budget=budget or 0, most=7, block=50).collect()
    whole = {(x["d"], x["at"]): x["parent"] for x in tree.heading_parents(df, ["d"], "at", "level", 3).collect()}
    assert {(x["d"], x["at"]): x["parent"] for x in got} == whole
    chunks = {}
    for x in sorted(got, key=lambda x: (x["d"], x["at"])):
        chunks.setdefault((x["d"], tuple(x["chunk"])), []).append(x)
    stack, doc = [], None
    for (d, _), v in chunks.items():
        if d != doc:
            stack, doc = [], d
        assert len(v) <= 7 and (not budget or len(v) == 1 or sum(len(x["text"].split()) for x in v) <= budget)
        for x in v:
            assert [tuple(h) for h in x["context"]] == stack
        for x in v:
            while stack and stack[-1][0] >= x["level"]:
                stack.pop()
            stack.append((x["level"], x["at"]))


def test_line_height(spark):
    rows = [(100.0, 10.0, "x" * 20), (100.0, 40.0, "x" * 60), (400.0, 10.0, "x" * 500), (0.0, 10.0, "x"), (10.0, 0.0, "x"), (10.0, 5.0, ""), (10.0, 5.0, None), (None, None, "x")]
    got = [x[0] for x in spark.createDataFrame(rows, "w double, h double, t string").select(outlines.line_height(F.col("w"), F.col("h"), F.col("t"))).collect()]

    def plain(w, h, t):
        if not h or h <= 0:
            return 0.0
        if not w or not t:
            return h
        lines = 1 if w / h > 15 else round(max(1.0, math.sqrt(len(t) * h / w * 0.5)))
        return h / lines

    assert got == [pytest.approx(plain(*x)) for x in rows]
