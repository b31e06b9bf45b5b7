"""Page repair and tree building: checks of blocks and answers, continuations of broken paragraphs, outlines and trees made from blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folia.functions.text import is_acronym, is_boilerplate, is_contents

# How questions about the place of a text are put.
PAGE_QUESTIONS = r"位于(?:第)?\s*\d+\s*页|在(?:文档|文件|说明书|手册)?的?第?\s*\d+\s*页|位于哪\s*[一]?\s*页|在哪\s*[一]?\s*页|第\s*几\s*页|哪\s*一\s*页|页\s*码\s*是"
QUESTION_MARKS = ("？", "?", "。")


def chunk_type(kind: Column) -> Column:
    """table, image or title where the type's name holds that word, else text."""
    name = F.upper(F.coalesce(kind, F.lit("")))
    out = F.lit("text")
    for k in ("TITLE", "IMAGE", "TABLE"):
        out = F.when(name.contains(k), F.lit(k.lower())).otherwise(out)
    return out


def valid_node(kind: Column, content: Column, caption: Column, summary: Column, body: Column) -> Column:
    """Whether a node has enough to ask about: images a caption or summary, tables a body or caption, titles over three
    characters, texts at least twenty that are neither contents nor boilerplate. The root has not."""
    has = lambda c: F.coalesce(c, F.lit("")) != ""
    text = F.trim(F.coalesce(content, F.lit("")))
    t = chunk_type(kind)
    return (
        F.when(F.lower(F.coalesce(kind, F.lit(""))).isin("root", "nodetype.root"), F.lit(False))
        .when(t == "image", has(caption) | has(summary)).when(t == "table", has(body) | has(caption)).when(t == "title", F.length(text) > 3)
        .otherwise((F.length(text) >= 20) & ~is_contents(text) & ~is_boilerplate(text))
    )


def valid_qa(question: Column, answer: Column) -> Column:
    """Question and answer of five characters and more that differ and do not ask for a page; without a question mark, a question of eight."""
    q, a = F.trim(F.coalesce(question, F.lit(""))), F.trim(F.coalesce(answer, F.lit("")))
    asked = F.endswith(q, F.lit(QUESTION_MARKS[0])) | F.endswith(q, F.lit(QUESTION_MARKS[1])) | F.endswith(q, F.lit(QUESTION_MARKS[2]))
    return (F.length(q) >= 5) & (F.length(a) >= 5) & (q != a) & ~q.rlike(PAGE_QUESTIONS) & ~a.rlike(PAGE_QUESTIONS) & (asked | (F.length(q) >= 8))


def page_range(df: DataFrame, group: list[str], page: str) -> DataFrame:
    """(group…, pages): `first-last` counted from 1, one number for a single row, `?` where no page is known."""
    lo, hi = (F.min(page) + 1).cast("string"), (F.max(page) + 1).cast("string")
    pages = F.when(F.count(page) == 0, F.lit("?")).when(F.count(page) == 1, lo).otherwise(F.concat(lo, F.lit("-"), hi))
    return df.groupBy(*group).agg(pages.alias("pages"))


def stitched(texts: Column) -> Column:
    """Texts as one: a text that ends with a hyphen loses it and runs on, others are followed by a space."""
    part = lambda t: F.when(t.endswith("-"), F.substring(t, F.lit(1), F.length(t) - 1)).otherwise(F.concat(t, F.lit(" ")))
    return F.trim(F.array_join(F.transform(texts, part), ""))


def continuations(blocks: DataFrame, doc: list[str], broken: str, gap: int = 2) -> DataFrame:
    """(doc…, pos, picked, merged) for each block of which the expression `broken` holds: the blocks that go on from it.

    blocks: doc…, pos, page, type, text_level, text. Pages up to `gap` further are looked at, in order; tables, images, titles and
    texts under three characters are passed over. Equations, texts with a lower-case start or an acronym ahead go on. A text with a capital
    is taken if it is the first of all; the next capital, or any other start, ends the search. Only blocks of gap + 1 pages stand in a row's window."""
    text = F.trim(F.coalesce("text", F.lit("")))
    passed = F.col("type").isin("table", "image") | (F.coalesce("text_level", F.lit(-1)) >= 0)
    kind = (
        F.when(passed, F.lit("skip")).when(F.col("type") == "equation", F.lit("on")).when(F.length(text) < 3, F.lit("skip"))
        .when(text.rlike(r"^\p{Ll}") | is_acronym(text), F.lit("on")).when(text.rlike(r"^\p{Lu}"), F.lit("capital")).otherwise(F.lit("end"))
    )
    pages = Window.partitionBy(*doc).orderBy("page").rangeBetween(0, gap)
    entry = F.struct("pos", kind.alias("kind"), F.coalesce("text", F.lit("")).alias("text"))
    rows = blocks.withColumn("_near", F.collect_list(entry).over(pages)).where(broken)
    after = F.filter(F.array_sort("_near"), lambda x: (x["pos"] > F.col("pos")) & (x["kind"] != "skip"))
    rows = rows.withColumn("_after", after)
    ends = F.filter(F.transform("_after", lambda x, i: F.when((x["kind"] == "end") | ((x["kind"] == "capital") & (i > 0)), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("_picked", F.slice("_after", F.lit(1), F.coalesce(F.get(ends, F.lit(0)), F.size("_after"))))
    merged = stitched(F.concat(F.array(F.coalesce("text", F.lit(""))), F.transform("_picked", lambda x: x["text"])))
    return rows.select(*doc, "pos", F.transform("_picked", lambda x: x["pos"]).alias("picked"), merged.alias("merged"))


def refine_outline(outline: DataFrame, doc: list[str], order: str = "pdf_id") -> DataFrame:
    """Outline entries (doc…, pdf_id, text_level, parent_id) with a top: where no entry has level 0, the first one gets it; entries
    below the top without a parent (0) get the first entry of level 0."""
    w = Window.partitionBy(*doc)
    first = F.row_number().over(w.orderBy(order)) == 1
    lacks = ~F.max(F.col("text_level") == 0).over(w)
    t = outline.withColumn("_first", first).withColumn("_lacks", lacks)
    t = t.withColumn("text_level", F.when(F.col("_first") & F.col("_lacks"), 0).otherwise(F.col("text_level"))).drop("_first", "_lacks")
    top = F.min(F.when(F.col("text_level") == 0, F.col(order))).over(w)
    return t.withColumn("_top", top).withColumn("parent_id", F.when((F.col("text_level") != 0) & (F.col("parent_id") == 0), F.col("_top")).otherwise(F.col("parent_id"))).drop("_top")


def build_tree(blocks: DataFrame, outline: DataFrame, doc: list[str]) -> DataFrame:
    """(doc…, index_id, parent_index, pdf_id, outline_node): the nodes of a document in the order they are made, root 0 left out.

    outline: doc…, pdf_id, text_level, parent_id, end_id (exclusive). Each title is followed by the blocks after it and before its end; ranges may nest, a block
    then stands under each of their titles. A title of level 0 or without parent hangs on the root; a parent_id names the last node made of that
    block; an unknown one gives null. Blocks meet titles by a range join within the document."""
    titles = outline.select(*doc, F.col("pdf_id").alias("at"), "text_level", "parent_id", "end_id")
    under = blocks.select(*doc, "pdf_id").join(titles.select(*doc, "at", "end_id"), doc).where("pdf_id > at and pdf_id < end_id")
    rows = titles.select(*doc, "at", F.col("at").alias("pdf_id"), F.lit(True).alias("outline_node"), "text_level", "parent_id")
    rows = rows.unionByName(under.select(*doc, "at", "pdf_id", F.lit(False).alias("outline_node"), F.lit(None).cast("int").alias("text_level"), F.lit(None).cast(titles.schema["parent_id"].dataType).alias("parent_id")))
    rows = rows.withColumn("index_id", F.row_number().over(Window.partitionBy(*doc).orderBy("at", F.desc("outline_node"), "pdf_id")))
    own = rows.where("outline_node").select(*doc, "at", F.col("index_id").alias("_title"))
    last = rows.groupBy(*doc, F.col("pdf_id").alias("parent_id")).agg(F.max("index_id").alias("_parent"))
    rows = rows.join(own, [*doc, "at"]).join(last, [*doc, "parent_id"], "left")
    parent = F.when(~F.col("outline_node"), F.col("_title")).when((F.col("text_level") == 0) | F.col("parent_id").isNull(), F.lit(0)).otherwise(F.col("_parent"))
    return rows.select(*doc, "index_id", parent.alias("parent_index"), "pdf_id", "outline_node")
