"""op12 against a plain count, on awkward rows and at lowered supports; whole tables are held against SQL in tests/test_queries.py."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from folia.llm import collocations, common
from tests.llm.test_operators import awkward


def plain(rows, support, top):
    seen, total = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        total[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    seen[lang, tuple(w[i : i + k])] += 1
    often = {p: n for p, n in seen.items() if n >= support}
    found = defaultdict(list)
    for (lang, p), a in often.items():
        if len(p) < 2:
            continue
        if any(m == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * n >= 80 * a for (m, q), n in often.items()):
            continue
        score, k = min((2000000 * a // (often[lang, p[:k]] + often[lang, p[k:]]), k) for k in range(1, len(p)))
        found[lang].append((-score, -a, " ".join(p).encode(), often[lang, p[:k]], often[lang, p[k:]]))
    return sorted((lang, r, p.decode(), -a, x, y, total[lang], -s) for lang, v in found.items() for r, (s, a, p, x, y) in enumerate(sorted(v)[:top], 1))


@pytest.mark.parametrize("support,top,shards", [(30, 2000, 8), (2, 2000, 8), (6, 7, 1), (6, 2000, 3)])
def test_awkward_rows(spark, support, top, shards, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 4000)  # many slices of a few words
    monkeypatch.setattr(collocations, "HELD", 3000)
    monkeypatch.setattr(collocations, "WORDS", 30)
    more = [(2000, "The cat. THE cat\tsat!the CAT\x0bsat the \x1ccat É é", "x"), (2001, "a b a b a b a b, a b", None), (2002, "a b a b a b", "und")] * 4
    odd = awkward(spark).unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string"), allowMissingColumns=True)
    odd = common.written(odd.withColumns({"phrase": F.lit(1), "n": F.lit("n"), "score": F.lit(None).cast("int")}))
    got = collocations.collocations(odd, support, top, shards).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    assert sorted(map(tuple, got)) == plain([(r["lang"], r["text"]) for r in odd.collect()], support, top)


def test_counts_follow_no_layout(spark, tiny):
    """Shards, their number and the order of rows change nothing."""
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    one = collocations.frequent_phrases(docs, 5, 1)[0].collect()
    many = collocations.frequent_phrases(docs.repartition(7), 5, 40, deal_by="text")[0].collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many)) and len(one) > 1000


def test_hot_phrase_and_wide_numbers(spark):
    """One phrase in a third of all rows, and counts whose product passes 64 bits."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.when(F.col("id") % 3 == 0, "one two three").otherwise(F.concat(F.lit("w"), F.col("id"))).alias("text"))
    got = collocations.collocations(docs).collect()
    assert [(r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in got] == [("one two three", 1000, 1000, 1000, 5000, 1000000)]
    big = spark.sql("select 9000000000000000000L a, 9000000000000000001L l, 9000000000000000003L r")
    score = big.select(F.expr("cast(2000000 as decimal(7, 0)) * cast(a as decimal(20, 0)) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")).first()[0]
    assert score == 2000000 * 9000000000000000000 // 18000000000000000004


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0
