"""BM25: postings, statistics and search as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folia.functions.text import tokens

K1, B = 1.5, 0.75
#: About how many words of a document are terms of questions.
TERMS = 100
#: Pairs of a document and a question that weigh as much as a row of terms.
PAIRS = 2


def postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(term, id, tf)."""
    return docs.select(id_col, F.explode(tokens(text_col)).alias("term")).groupBy("term", id_col).agg(F.count("*").alias("tf"))


def doc_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(id_col, F.coalesce(F.size(tokens(text_col)), F.lit(0)).alias("dl"))


def term_stats(post: DataFrame, n_docs: int) -> DataFrame:
    """(term, df, idf)."""
    df = post.groupBy("term").agg(F.count("*").alias("df"))
    return df.withColumn("idf", F.log((F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1))


def search(docs: DataFrame, questions: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text", q_id: str = "item_id", q_text: str = "text") -> DataFrame:
    """(q_id, id, score, rank): the k best documents of each question; a repeated query term counts as often as it stands there.

    Scores are rounded to 6 places, so that copies tie whatever the order of summation. Only terms of the questions leave the documents, and they are dealt by id over tasks that follow
    their rows and the pairs with questions, so that a document is scored for all questions where its terms are and only the best of each task go on. Documents without any match have score 0 and fill up short lists, smallest id first."""
    from folia.plans.runtime import materialize, scattered, short_splits

    spark = docs.sparkSession

    asked = questions.select(F.col(q_id), F.explode(tokens(q_text)).alias("term")).groupBy(q_id, "term").agg(F.count("*").alias("qtf"))
    # one reading of the documents: the empty term, which no text has, gives each its length
    terms = asked.select("term").union(spark.createDataFrame([("",)], "term string")).distinct()
    sized = docs.select(id_col, F.coalesce(tokens(text_col), F.array().cast("array<string>")).alias("_w"))
    spread = sized.select(id_col, F.size("_w").alias("dl"), F.explode(F.array_append("_w", F.lit(""))).alias("term"))
    met = spread.join(materialize(terms), "term", "left_semi")
    with short_splits(spark):
        tf = materialize(scattered(met, TERMS * docs.count(), id_col).groupBy("term", id_col, "dl").agg(F.count("*").alias("tf")))
    every = tf.where("term = ''")
    stats = every.agg(F.sum("tf").alias("n"), (F.sum(F.col("tf") * F.col("dl")) / F.sum("tf")).alias("avgdl")).first()
    n, avgdl = stats["n"] or 0, stats["avgdl"] or 1.0
    found = tf.where("term <> ''")
    idf = term_stats(found, n).select("term", "idf")
    part = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / avgdl))
    weights = materialize(asked.join(idf, "term").select(q_id, "term", "qtf", "idf"))
    # a document meets every question at most
    here = scattered(found.select("term", id_col, part.alias("w")), max(tf.count(), n * questions.count() // PAIRS), id_col)
    scored = here.join(weights, "term").groupBy(q_id, id_col).agg(F.round(F.sum(F.col("qtf") * F.col("idf") * F.col("w")), 6).alias("score"))
    w = Window.partitionBy(q_id).orderBy(F.desc("score"), id_col)
    with short_splits(spark):
        scored = materialize(scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("rank"))
    # as many of the smallest ids as could be needed when the first k all match
    spare = [r[0] for r in every.select(id_col).orderBy(id_col).limit(2 * k).collect()]
    few = questions.select(q_id).join(scored.groupBy(q_id).agg(F.count("*").alias("hits")), q_id, "left").where(f"coalesce(hits, 0) < {k}")
    fill = few.select(q_id, F.explode(F.array(*[F.lit(x) for x in spare])).alias(id_col)) if spare else None
    if fill is not None:
        scored = scored.unionByName(fill.join(scored, [q_id, id_col], "left_anti").withColumn("score", F.lit(0.0)))
    return materialize(scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k))
