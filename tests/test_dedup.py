"""Keeping what is unlike all kept before, against the plain loop."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from folia.functions.text import tokens
from folia.operators import dedup


def loop(rows, of, limit):
    kept, sets = [], []
    for key, t in rows:
        s = of(t)
        if not any(s | k and len(s & k) / len(s | k) >= limit for k in sets):
            kept.append(key)
            sets.append(s)
    return kept


def test_whole_conversations(spark, tiny):
    c = spark.read.parquet(f"{tiny}/conversations.parquet")
    rows = sorted((r["conv_id"], r["turn"], r["text"]) for r in c.collect())
    got = dedup.distinct_in_order(c, ["conv_id", "turn"], "text", block=8)
    assert sorted(got.columns) == sorted(c.columns)
    assert sorted((r["conv_id"], r["turn"]) for r in got.collect()) == loop([((a, b), t) for a, b, t in rows], lambda t: set(t or ""), 0.7)


@pytest.mark.parametrize("limit,block", [(0.5, 4), (0.7, 16), (1.0, 64)])
def test_words_in_any_layout(spark, limit, block):
    """Chains of likeness, copies, blanks and nulls; a hot text in a third of the rows."""
    r = random.Random(block)
    words = [f"w{k}" for k in range(9)]
    rows = [(k, None if k % 31 == 0 else "same few words" if k % 3 == 0 else " ".join(r.choice(words) for _ in range(r.randint(0, 7)))) for k in range(300)]
    df = spark.createDataFrame(rows, "id long, text string").withColumn("a", F.lit("mine"))
    got = dedup.distinct_in_order(df.repartition(5), ["id"], "text", limit, lambda c: F.coalesce(tokens(c), F.array().cast("array<string>")), block=block)
    assert sorted(x["id"] for x in got.collect()) == loop(rows, lambda t: set((t or "").split()), limit)


def test_empty(spark):
    assert dedup.distinct_in_order(spark.createDataFrame([], "id long, text string"), ["id"], "text").count() == 0
