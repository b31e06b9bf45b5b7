"""op2: rows that repeat an id and text thousands of times are dealt over blocks."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from folia.llm import common, mixing


def test_equal_rows_are_dealt_out(spark):
    same = spark.range(6000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("a few equal words").alias("text"), F.lit("a").alias("source"))
    rest = spark.range(1000).select((F.col("id") + 100).alias("doc_id"), F.lit("other words").alias("text"), F.lit("b").alias("source"))
    docs = common.written(same.unionByName(rest).repartition(5))
    t = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("row"))
    got = mixing.repeats(common.written(t))
    numbers = sorted(r["repeat"] for r in got.collect())
    assert numbers == list(range(6000))
    out = mixing.mix_sources(docs)
    per = {r["doc_id"] == 7: r for r in out.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("taken").alias("taken"), F.max("copies").alias("most"), F.first("target").alias("target")).where("doc_id = 7").collect()}
    assert per[True]["n"] == 6000 and abs(per[True]["taken"] - per[True]["target"]) <= 8
    again = mixing.mix_sources(docs.repartition(3))
    count = lambda x: sorted(tuple(r) for r in x.groupBy("doc_id", "copies").count().collect())
    assert count(out) == count(again)
    assert out.where("source_size = 0").count() == 0 and math.isfinite(per[True]["target"])
