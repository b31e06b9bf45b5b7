"""Outlines of very long documents in chunks of titles, with the open headings carried from chunk to chunk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folia.functions.text import words
from folia.operators.answers import packed
from folia.plans.runtime import materialize

#: Words and titles of a chunk at most.
WORDS, TITLES = 2000, 51


def line_height(width: Column, height: Column, text: Column) -> Column:
    """Height of a line in a box: its height over the lines that its characters should take, at half as wide as high; a box 15 times as wide as high is one line.

    A box without width or text is a line, without height it is 0."""
    lines = F.greatest(F.lit(1.0), F.rint(F.sqrt(F.length(text) * height / width * 0.5)))
    lines = F.when(width > 15 * height, F.lit(1.0)).otherwise(lines)
    flat = F.coalesce(height, F.lit(0.0)) <= 0
    return F.when(flat, F.lit(0.0)).when((F.coalesce(width, F.lit(0.0)) <= 0) | (F.coalesce(F.length(text), F.lit(0)) == 0), height).otherwise(height / lines)


def numbered(rows: DataFrame, key: list[str], order: str, block: int) -> DataFrame:
    """Adds number: the place of a row in its key from 0. Rows are numbered inside blocks of the order, and blocks by counts, so a key is not numbered in one task."""
    t = rows.withColumn("_b", F.floor(F.col(order) / block).cast("long"))
    before = F.sum("_n").over(Window.partitionBy(*key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    size = t.groupBy(*key, "_b").agg(F.count("*").alias("_n")).select(*key, "_b", F.coalesce(before, F.lit(0)).alias("_before"))
    at = F.row_number().over(Window.partitionBy(*key, "_b").orderBy(order)) - 1
    return t.withColumn("_at", at).join(size, [*key, "_b"]).withColumn("number", F.col("_before") + F.col("_at")).drop("_b", "_at", "_before")


def title_chunks(titles: DataFrame, doc: list[str], order: str, text: str | None = None, budget: int = WORDS, most: int = TITLES, block: int = 4096) -> DataFrame:
    """Adds chunk (run, part): runs of at most `most` titles, cut where the words of a part would pass the budget; a title above it is a part of its own."""
    t = numbered(titles, doc, order, block).withColumn("_run", F.floor(F.col("number") / most)).drop("number")
    if text is None:
        return t.withColumn("chunk", F.struct(F.col("_run").alias("run"), F.lit(0).alias("part"))).drop("_run")
    n = F.size(words(F.coalesce(F.col(text), F.lit(""))))
    runs = t.groupBy(*doc, "_run").agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), n.alias("n")))).alias("x"))
    cut = runs.select(*doc, "_run", F.explode(F.arrays_zip(F.col("x").alias("x"), packed(F.transform("x", lambda e: e["n"]), budget).alias("g"))).alias("e")).select(*doc, "_run", F.col("e.x.o").alias(order), F.col("e.g").alias("part"))
    return t.join(cut, [*doc, "_run", order]).withColumn("chunk", F.struct(F.col("_run").alias("run"), "part")).drop("_run", "part")


def outline_in_chunks(titles: DataFrame, doc: list[str], order: str, level: str, max_level: int, text: str | None = None, budget: int = WORDS, most: int = TITLES, block: int = 4096) -> DataFrame:
    """(…titles, chunk, context, parent): the nearest title before with a smaller level (0 to max_level), found chunk by chunk.

    context are the headings that are open where the chunk begins: an array of (level, order), outermost first, as a model for the chunk would be given it. What a chunk hands on is its last
    title of each level, and the latest of several hand-overs counts, so all chunks are scanned side by side and only their states, a row each, meet in order; then each chunk is settled alone. The result
    is that of one pass over the whole document. Order is a whole number without ties in a document."""
    t = materialize(title_chunks(titles, doc, order, text, budget, most, block))
    levels = range(max_level + 1)
    state = t.groupBy(*doc, "chunk").agg(*[F.max(F.when(F.col(level) == k, F.col(order))).alias(f"_l{k}") for k in levels])
    before = Window.partitionBy(*doc).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = state.select(*doc, "chunk", *[F.max(f"_l{k}").over(before).alias(f"_c{k}") for k in levels])
    # a heading is open if none of its level or a smaller one came after it
    heads = []
    for k in levels:
        smaller = [F.col(f"_c{j}") for j in range(k)]
        is_open = F.col(f"_c{k}").isNotNull() & ((F.col(f"_c{k}") > F.coalesce(F.greatest(*smaller), F.lit(-(1 << 62))) if len(smaller) > 1 else F.col(f"_c{k}") > F.coalesce(smaller[0], F.lit(-(1 << 62)))) if smaller else F.lit(True))
        heads.append(F.when(is_open, F.struct(F.lit(k).alias("level"), F.col(f"_c{k}").alias("order"))))
    carried = carried.withColumn("context", F.filter(F.array(*heads), lambda h: h.isNotNull()))
    inside = Window.partitionBy(*doc, "chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = t
    for k in range(max_level):
        rows = rows.withColumn(f"_w{k}", F.max(F.when(F.col(level) == k, F.col(order))).over(inside))
    rows = rows.join(carried, [*doc, "chunk"])
    parent = F.lit(None).cast(titles.schema[order].dataType)
    for k in range(1, max_level + 1):
        near = [F.col(f"_{s}{j}") for s in "wc" for j in range(k)]
        parent = F.when(F.col(level) == k, F.greatest(*near)).otherwise(parent)
    return rows.select(*titles.columns, "chunk", "context", parent.alias("parent"))


def apply_levels(titles: DataFrame, given: DataFrame, doc: list[str], order: str, level: str) -> DataFrame:
    """Titles with the levels and parents that a model gave (doc…, order, level, parent); titles it left out, or gave the level -1, go. Levels for no title, or given again, are left alone: the first parent of the smallest level counts."""
    one = given.groupBy(*doc, order).agg(F.min(F.struct(F.col(level).alias("l"), F.col("parent").alias("p"))).alias("_g")).where("_g.l <> -1")
    return titles.drop("parent").join(one, [*doc, order]).withColumns({level: F.col("_g.l"), "parent": F.col("_g.p")}).drop("_g")


def outline_context(outline: DataFrame, doc: list[str], order: str, level: str, first: int = 3, last: int = 5) -> DataFrame:
    """(doc…, order, level, place): what of a settled outline the next chunk is shown: titles of level 0, the first three and the last five of level 1, and the tail from the last title of level 1 on, its last five; each once, at its first place.

    Only so many titles of a document meet, however long it is: the places from either end are taken in parts first."""
    from folia.operators.summaries import first_of_groups

    back = outline.withColumn("_back", -F.col(order))
    one = outline.where(F.col(level) == 1)
    part = lambda df, k: df.select(*doc, F.lit(k).alias("_part"), F.col(order).alias("_o"), F.col(level).alias("_l"))
    heads = part(outline.where(F.col(level) == 0), 0)
    early = part(first_of_groups(one, doc, [order], first), 1)
    late = part(first_of_groups(back.where(F.col(level) == 1), doc, ["_back"], last), 2)
    border = one.groupBy(*doc).agg(F.max(order).alias("_from"))
    after = back.join(border, doc, "left").where(F.col("_from").isNull() | (F.col(order) >= F.col("_from")))
    tail = part(first_of_groups(after, doc, ["_back"], last), 3)
    every = heads.unionByName(early).unionByName(late).unionByName(tail).groupBy(*doc, "_o").agg(F.min("_part").alias("_part"), F.first("_l").alias("_l"))
    place = F.row_number().over(Window.partitionBy(*doc).orderBy("_part", "_o")) - 1
    return every.withColumn("place", place).select(*doc, F.col("_o").alias(order), F.col("_l").alias(level), "place")
