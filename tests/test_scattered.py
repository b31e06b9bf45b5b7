"""The search deals documents over tasks that follow their rows, however many partitions Spark would take by itself."""

from __future__ import annotations

from folia.operators import bm25
from folia.plans import catalog, runtime
from folia.session import table


def test_search_with_many_partitions(spark, tiny, monkeypatch):
    docs, items = table(spark, tiny, "documents"), table(spark, tiny, "benchmark")
    usual = bm25.search(docs, items, 3).collect()
    dealt, splits = [], []
    monkeypatch.setattr(runtime, "ROWS", 500)
    repartition, materialize = type(docs).repartition, runtime.materialize
    monkeypatch.setattr(type(docs), "repartition", lambda self, n, *c: dealt.append(n) or repartition(self, n, *c))
    monkeypatch.setattr(runtime, "materialize", lambda df: splits.append(spark.conf.get(runtime.SPLIT[0])) or materialize(df))
    spark.conf.set("spark.sql.shuffle.partitions", "1000")
    try:
        assert sorted(bm25.search(docs, items, 3).collect()) == sorted(usual)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    n = docs.count()
    assert dealt[0] == -(-bm25.TERMS * n // 500) and dealt[1] >= -(-(n * items.count() // bm25.PAIRS) // 500)
    assert splits.count(runtime.SPLIT[2]) == 2 and spark.conf.get(runtime.SPLIT[0]) == runtime.SPLIT[1]


def test_few_rows_take_every_core(spark):
    assert runtime.scattered(spark.range(10), 10, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_own_splits_stay(spark):
    key, usual, short = runtime.SPLIT
    with runtime.short_splits(spark):
        assert spark.conf.get(key) == short
    spark.conf.set(key, "8m")
    try:
        with runtime.short_splits(spark):
            assert spark.conf.get(key) == "8m"
        assert spark.conf.get(key) == "8m"
    finally:
        spark.conf.set(key, usual)


def test_answers_with_many_partitions(spark, tiny, monkeypatch):
    usual = sorted(catalog.QUERIES["evidence_answers"](spark, tiny).collect())
    dealt = []
    monkeypatch.setattr(runtime, "ROWS", 500)
    repartition = type(spark.range(1)).repartition
    monkeypatch.setattr(type(spark.range(1)), "repartition", lambda self, n, *c: dealt.append(n) or repartition(self, n, *c))
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        assert sorted(catalog.QUERIES["evidence_answers"](spark, tiny).collect()) == usual
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(dealt) == 2 and min(dealt) > 4
