"""Rows of a tree for flat collections: texts by type, groups by modality, title summaries, evidence, and what an update has to write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Types of nodes, and the order in which modalities are numbered.
ROOT, IMAGE, TABLE, TITLE = "root", "image", "table", "title"
PLAIN = ("text", "title", "equation")
MODALITIES = ("text", "image", "fused")


def node_type(c: Column) -> Column:
    """Lower-case type of a node without a class name before it: NodeType.TITLE is title."""
    return F.lower(F.element_at(F.split(c, r"\."), -1))


def _some(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def flat_texts(nodes: DataFrame) -> DataFrame:
    """(…nodes, text) for a collection of texts: an image by caption and footnote, a table by content and body, others by their content, left out where it is empty. The root and unknown types are left out."""
    t = nodes.withColumn("_t", node_type(F.col("type")))
    text = F.when(F.col("_t") == IMAGE, F.concat(_some(F.col("caption")), _some(F.col("footnote")))).when(F.col("_t") == TABLE, F.concat(_some(F.col("content")), _some(F.col("table_body")))).otherwise(F.col("content"))
    kept = F.col("_t").isin(IMAGE, TABLE) | (F.col("_t").isin(*PLAIN) & (_some(F.col("content")) != ""))
    return t.where(kept).withColumn("text", text).drop("_t")


def by_modality(nodes: DataFrame, doc: list[str], order: str) -> DataFrame:
    """(…nodes, modality, embedding_idx): text where a node has content, image where an image or table has a path, fused where it has both, null where neither; the root is left out.

    embedding_idx counts from 0 in each document: texts first, then images, then fused, each in order; null without a modality. Places come from counts of the groups and places inside them, so a document is numbered by as many tasks as it has modalities."""
    t = nodes.withColumn("_t", node_type(F.col("type"))).where(F.col("_t") != ROOT)
    text, image = _some(F.col("content")) != "", F.col("_t").isin(IMAGE, TABLE) & (_some(F.col("img_path")) != "")
    t = t.withColumn("modality", F.when(text & image, "fused").when(text, "text").when(image, "image")).drop("_t")
    sizes = t.where("modality is not null").groupBy(*doc).pivot("modality", list(MODALITIES)).count().select(*doc, *[F.coalesce(m, F.lit(0)).alias(f"_{m}") for m in MODALITIES])
    before = F.when(F.col("modality") == "text", F.lit(0)).when(F.col("modality") == "image", F.col("_text")).otherwise(F.col("_text") + F.col("_image"))
    at = F.row_number().over(Window.partitionBy(*doc, "modality").orderBy(order)) - 1
    t = t.join(sizes, doc, "left").withColumn("embedding_idx", F.when(F.col("modality").isNotNull(), before + at))
    return t.drop(*[f"_{m}" for m in MODALITIES])


def title_summaries(nodes: DataFrame, doc: list[str]) -> DataFrame:
    """(doc…, node_id, title, summary, file_name): titles with a summary that is not blank, trimmed; file_name is the stem of the file of the root, empty where it has none."""
    t = nodes.withColumn("_t", node_type(F.col("type")))
    named = F.coalesce(F.when(_some(F.col("file_name")) != "", F.col("file_name")), F.col("file_path"))
    stem = F.regexp_replace(F.regexp_replace(_some(named), r"^.*/", ""), r"(?<=.)\.[^.]*$", "")
    roots = t.where(F.col("_t") == ROOT).groupBy(*doc).agg(F.min_by(stem, "node_id").alias("_stem"))
    out = t.where((F.col("_t") == TITLE) & (F.trim(_some(F.col("summary"))) != "")).join(roots, doc, "left")
    return out.select(*doc, "node_id", _some(F.col("content")).alias("title"), F.trim("summary").alias("summary"), F.coalesce("_stem", F.lit("")).alias("file_name"))


def evidence(asked: DataFrame, nodes: DataFrame, query: str, ids: str) -> DataFrame:
    """(query, place, index_id, type, content, page, img_path, table_body, caption, footnote): the nodes of an array of ids, in its order; fields that a type does not have are null. Ids without a node are left out."""
    rows = asked.select(query, F.posexplode(ids).alias("place", "index_id")).join(nodes, "index_id")
    kind = node_type(F.col("type"))
    only = lambda c, *kinds: F.when(kind.isin(*kinds), F.col(c)).alias(c)
    return rows.select(query, "place", "index_id", kind.alias("type"), "content", F.col("page_idx").alias("page"), only("img_path", IMAGE, TABLE), only("table_body", TABLE), only("caption", TABLE), only("footnote", TABLE))


def update_plan(wanted: DataFrame, present: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows to insert, ids to delete) that bring a collection to what is wanted: of rows that share an id that with the longest document is written once, ids that are there already are left alone, and ids that are no longer wanted go.

    wanted (key, document, …); ties between documents go to the smaller text."""
    w = Window.partitionBy(key).orderBy(F.desc(F.length("document")), "document")
    once = wanted.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    have = present.select(key).distinct()
    return once.join(have, key, "left_anti"), have.join(wanted.select(key).distinct(), key, "left_anti")
