"""The near-duplicate stage of the pipeline against a brute-force Jaccard similarity."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline as P
from folia.llm import common, jaccard


def shingles(t, width=5):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(sets):
    """Root of each distinct set."""
    at = {s: s for s in sets}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for a, b in combinations(at, 2):
        if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b):
            at[find(a)] = find(b)
    return {s: find(s) for s in at}


def made():
    """Near copies of all similarities around 0.8, large groups of them, boilerplate, short texts."""
    r = random.Random(3)
    word = lambda: f"w{r.randrange(5000)}"
    base = [[word() for _ in range(r.choice([8, 30, 120]))] for _ in range(40)]
    texts = [" ".join(b) for b in base]
    for b in base:
        for edits in (1, 2, 3, 4, 6):
            c = list(b)
            for _ in range(edits):
                c[r.randrange(len(c))] = word()
            texts.append(" ".join(c))
    big = [word() for _ in range(150)]
    for _ in range(80):  # one group, more than 24 in a key
        c = list(big)
        for _ in range(r.randrange(1, 6)):
            c[r.randrange(len(c))] = word()
        texts.append(" ".join(c))
    licence = " ".join(word() for _ in range(60))
    texts += [licence + " " + " ".join(word() for _ in range(40)) for _ in range(60)]
    return texts + [licence, licence.upper(), "one", "one", "One  two", "", None, " \n"]


@pytest.mark.parametrize("which", ["made", "parts", "sf0.01"])
def test_stage_equals_brute_force(spark, which, monkeypatch):
    if which == "parts":  # crowded keys in many small parts
        monkeypatch.setattr(jaccard, "CHUNK", 5)
    texts = made() if which != "sf0.01" else [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    docs = common.written(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    root = brute({shingles(t) for t in texts})
    want = {}
    for k, t in enumerate(texts):
        want.setdefault(root[shingles(t)], k)
    assert sorted(r["doc_id"] for r in P.near_duplicates(spark, docs, "").collect()) == sorted(want.values())


def test_parts_of_a_crowded_key(spark, monkeypatch):
    """Chains of near copies that lie in different parts, and sets that are alike to none, all in one key."""
    monkeypatch.setattr(jaccard, "CHUNK", 4)
    r = random.Random(5)
    sets, at = {}, 1
    for _ in range(4):
        s = [r.getrandbits(63) for _ in range(60)]
        for _ in range(12):  # each differs by three shingles from the one before
            s = s[3:] + [r.getrandbits(63) for _ in range(3)]
            sets[at], at = frozenset(s), at + 1
    for _ in range(6):
        sets[at], at = frozenset(r.getrandbits(63) for _ in range(60)), at + 1
    stored = common.written(spark.createDataFrame([(k, np.sort(np.array(list(s), np.uint64)).tobytes()) for k, s in sets.items()], "node long, shingles binary"))
    crowd = common.written(spark.createDataFrame([(7, k) for k in sets], "key long, node long"))
    sizes = stored.selectExpr("node", "cast(octet_length(shingles) / 8 as long) as n")
    links = jaccard.together(jaccard.parted(crowd, sizes), stored, ["key", "part"])
    assert jaccard.parted(crowd, sizes).groupBy("part").count().count() > 5
    root = {x["node"]: x["root"] for x in jaccard.across(crowd, stored, common.components(links), sizes).collect()}
    want = brute(list(sets.values()))
    groups = lambda of: {frozenset(k for k in sets if of(k) == v) for v in map(of, sets)}
    assert groups(lambda k: root.get(k, k)) == groups(lambda k: want[sets[k]])


def test_long_sets_make_more_parts(spark, monkeypatch):
    """Parts follow the shingles of their sets, not their number alone."""
    monkeypatch.setattr(jaccard, "SHINGLES", 1000)
    crowd = spark.createDataFrame([(1, k) for k in range(40)] + [(2, k) for k in range(40, 80)], "key long, node long")
    sizes = spark.createDataFrame([(k, 500 if k < 40 else 3) for k in range(80)], "node long, n long")
    parts = {r["key"]: r["parts"] for r in jaccard.parted(crowd, sizes).select("key", "parts").distinct().collect()}
    assert parts == {1: 20, 2: 1}
