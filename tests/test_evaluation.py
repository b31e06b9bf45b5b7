"""Scores against several golds and a judge's answers, against plain models."""

from __future__ import annotations

import random
import re
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from folia.operators import evaluation, metrics

INFOS = "array<struct<unanswerable: boolean, extractive_spans: array<string>, free_form_answer: string, yes_no: boolean, evidence: array<string>>>"


def norm(s):
    s = "".join(c for c in s.lower() if c not in set(string.punctuation))
    return " ".join(re.sub(r"\b(a|an|the)\b", " ", s).split())


def f1(p, g):
    p, g = norm(p).split(), norm(g).split()
    n = sum((Counter(p) & Counter(g)).values())
    return 2 * n / (len(p) + len(g)) if n else 0.0


def test_normal_answer(spark):
    texts = ["The cat's  hat!", "an-a the", "“the” ça a été, A.", "", "x_y [z] \\ {q}", "Theory of a thing", "naïve a-b"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "c string").select(evaluation.normal_answer(F.col("c"))).collect()]
    assert got == [norm(t) for t in texts]


def test_shared_tokens(spark):
    r = random.Random(1)
    rows = [([r.choice("abcde") for _ in range(r.randint(0, 9))], [r.choice("abcdefg") for _ in range(r.randint(0, 9))]) for _ in range(200)]
    got = [x[0] for x in spark.createDataFrame(rows, "g array<string>, p array<string>").select(metrics.shared_tokens(F.col("g"), F.col("p"))).collect()]
    assert got == [sum((Counter(g) & Counter(p)).values()) for g, p in rows]


def test_gold_answers_and_best_scores(spark):
    infos = [
        (True, ["x"], "y", True, ["e"]), (False, ["red cat", "dog"], "free", None, ["t", "FLOAT SELECTED: Table 1"]), (False, [], "a free answer", False, None),
        (False, None, "", True, []), (False, [], None, False, ["e"]), (False, [], "", None, ["e"]), (None, None, None, None, None),
    ]
    df = spark.createDataFrame([(1, infos), (2, []), (3, None)], f"k int, infos {INFOS}")
    got = {r["k"]: r["g"] for r in df.select("k", evaluation.gold_answers(F.col("infos"), True).alias("g")).collect()}
    assert [(g["answer"], g["evidence"], g["type"], g["raw"]) for g in got[1]] == [
        ("Not answerable", [], "none", ["Not answerable"]), ("red cat, dog", ["t"], "extractive", ["red cat", "dog"]), ("a free answer", [], "abstractive", ["a free answer"]),
        ("Yes", [], "boolean", ["Yes"]), ("No", ["e"], "boolean", ["No"]),
    ]
    assert got[2] == [] and got[3] is None
    results = spark.createDataFrame([(1, "m", "The red cat and a dog"), (2, "m", "x"), (3, "n", "x"), (4, "n", None)], "k int, method string, prediction string")
    scored = evaluation.evaluate(results, df, ["k"])
    rows = {r["k"]: r for r in scored.collect()}
    want = max(f1("The red cat and a dog", g) for g in ("Not answerable", "red cat, dog", "a free answer", "Yes", "No"))
    assert rows[1]["accuracy"] == 1.0 and rows[1]["f1"] == pytest.approx(want) and rows[1]["n_golds"] == 5 and rows[1]["answerable"]
    assert [(rows[k]["accuracy"], rows[k]["f1"], rows[k]["n_golds"]) for k in (2, 3, 4)] == [(0.0, 0.0, 0)] * 3
    assert rows[2]["answerable"] is False and rows[4]["answerable"] is None


def test_report_is_saved(spark, tmp_path):
    scored = spark.createDataFrame([("m", 1, 1.0, 0.5, True), ("m", 2, 0.0, 0.25, False), ("n", 3, 1.0, 1.0, None)], "method string, k int, accuracy double, f1 double, answerable boolean")
    out = {r["method"]: r for r in evaluation.save_scores(scored, str(tmp_path / "s"), ["method"], ["k", "gone", "f1"]).collect()}
    assert (out["m"]["n"], out["m"]["n_answerable"], out["m"]["accuracy"], out["m"]["answerable_f1"]) == (2, 1, 0.5, 0.5) and out["n"]["answerable_accuracy"] is None
    assert spark.read.parquet(str(tmp_path / "s/results")).columns == ["k", "f1", "method", "accuracy", "answerable"]
    assert spark.read.json(str(tmp_path / "s/scores")).count() == 2


def test_judge_answer(spark):
    texts = ["Extracted results: a: b\nFormat: Str\nScore: 0.5", "  score :1 \nno line", "FORMAT: x\nformat: y", "", None, "score: high", "Score: 1\nscore: 0.25 "]
    got = [tuple(r[0]) for r in spark.createDataFrame([(t,) for t in texts], "c string").select(evaluation.judge_answer(F.col("c"))).collect()]
    none = evaluation.MISSING
    assert got == [("a: b", "Str", 0.5), (none, none, 1.0), (none, "y", 0.0), (none, none, 0.0), (none, none, 0.0), (none, none, 0.0), (none, none, 0.25)]


def test_paragraph_f1(spark):
    rows = [(["a", "b"], ["b", "c", "c"]), ([], []), ([], ["a"]), (["a"], ["b"])]
    got = [r[0] for r in spark.createDataFrame(rows, "p array<string>, g array<string>").select(evaluation.paragraph_f1(F.col("p"), F.col("g"))).collect()]
    assert got == [pytest.approx(2 * 1 / 5), 1.0, 0.0, 0.0]
