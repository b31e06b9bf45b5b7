"""Sentence chunks under a word budget."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.functions.text import pack_greedy, sentences, words


def sentence_chunks(docs: DataFrame, budget: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, chunk_id, n_words, n_sentences, text): whole sentences packed in order; a sentence above the budget is cut by words first."""
    parts = F.transform(sentences(text_col), lambda s: words(s))
    cut = F.flatten(
        F.transform(
            F.filter(parts, lambda w: F.size(w) > 0),
            lambda w: F.transform(F.sequence(F.lit(0), F.floor((F.size(w) - 1) / budget).cast("int")), lambda k: F.slice(w, k * budget + 1, F.lit(budget))),
        )
    )
    t = docs.select(id_col, cut.alias("items")).where("size(items) > 0")
    t = t.withColumn("chunk", pack_greedy(F.transform("items", lambda w: F.size(w)), F.lit(budget)))
    rows = t.select(id_col, F.posexplode(F.arrays_zip("items", "chunk")).alias("pos", "x")).select(id_col, "pos", F.col("x.items").alias("w"), F.col("x.chunk").alias("chunk_id"))
    return rows.groupBy(id_col, "chunk_id").agg(
        F.sum(F.size("w")).alias("n_words"), F.count("*").alias("n_sentences"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "w"))), lambda x: F.array_join(x["w"], " ")), " ").alias("text"),
    )
