"""Answers from evidence: items packed into prompts under a budget, partial answers, and their reduction to one.

Where a model would answer, a function of columns does; the default picks the sentence that shares most words with the question."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folia.functions.text import sentences, tokens, words
from folia.plans.runtime import materialize

# How evidence and partial answers are written, and the answer where there is none.
SEPARATOR = "\n\n---\n\n"
NOTHING = "Based on the provided information, I couldn't find an answer."
NOTHING_COMPLEX = "I could not find the necessary information to answer the complex question."
IMAGE = "image"

Answer = Callable[[Column, Column], Column]


def best_sentence(question: Column, text: Column) -> Column:
    """The sentence or line with the most different words of the question, the first of equal ones; empty for a blank text."""
    q = F.array_distinct(tokens(question))
    parts = F.filter(F.flatten(F.transform(F.split(text, "\n"), lambda line: sentences(line))), lambda s: F.size(words(s)) > 0)
    best = F.aggregate(
        parts, F.struct(F.lit(-1).alias("n"), F.lit("").alias("s")),
        lambda a, s: F.when(F.size(F.array_intersect(q, tokens(s))) > a["n"], F.struct(F.size(F.array_intersect(q, tokens(s))).alias("n"), s.alias("s"))).otherwise(a),
    )
    return F.coalesce(best["s"], F.lit(""))


def split_evidence(items: DataFrame, kind: str = "type", page: str = "page") -> tuple[DataFrame, DataFrame]:
    """(text evidence, image evidence); pages count from 1 in both. A null type is text."""
    moved = items.withColumn(page, F.col(page) + 1)
    is_image = F.coalesce(F.lower(kind) == IMAGE, F.lit(False))
    return moved.where(~is_image), moved.where(is_image)


def evidence_text(kind: Column, page: Column, content: Column) -> Column:
    return F.concat(F.lit("Type: "), F.coalesce(kind, F.lit("text")), F.lit(" in Page: "), F.coalesce(page.cast("string"), F.lit("-1")), F.lit("\nContent: "), F.coalesce(content, F.lit("")), F.lit("\n"))


def packed(sizes: Column, budget: int) -> Column:
    """Group number of each item of an array of sizes: a group is closed before the item that would carry it over the budget. An item above the budget is a group of its own."""
    start = F.struct(F.lit(0).alias("group"), F.lit(0).cast("long").alias("held"), F.array().cast("array<int>").alias("groups"))

    def add(s: Column, n: Column) -> Column:
        full = (F.size(s["groups"]) > 0) & (s["held"] + n > budget)
        group = s["group"] + full.cast("int")
        return F.struct(group.alias("group"), F.when(full, n.cast("long")).otherwise(s["held"] + n).alias("held"), F.concat(s["groups"], F.array(group)).alias("groups"))

    return F.aggregate(sizes, start, add, lambda s: s["groups"])


def pack_prompts(items: DataFrame, query: str, order: str, budget: int, kind: str = "type", page: str = "page", content: str = "content") -> DataFrame:
    """(query, chunk, n_items, n_words, text): evidence of each query in order, in chunks of at most `budget` words.

    An item is written with its type and page. One whose writing is above the budget is cut into pieces of `budget` words of its content, each with the same type and page; such a piece and its
    heading may be a chunk a few words above the budget, and nothing else is. Order has to be free of ties in a query; a query's evidence is what a retrieval has chosen, so it is gathered in one row.
    Null contents are empty items."""
    written = evidence_text(F.col(kind), F.col(page), F.col(content))
    w = words(F.coalesce(F.col(content), F.lit("")))
    pieces = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(w) - 1, F.lit(0)) / budget).cast("int")), lambda k: F.array_join(F.slice(w, k * budget + 1, F.lit(budget)), " "))
    parts = F.when(F.size(words(written)) > budget, F.transform(pieces, lambda p: evidence_text(F.col(kind), F.col(page), p))).otherwise(F.array(written))
    each = items.select(query, order, F.posexplode(parts).alias("_at", "_text")).withColumn("_n", F.size(words("_text")))
    rows = each.groupBy(query).agg(F.sort_array(F.collect_list(F.struct(order, "_at", "_text", "_n"))).alias("x"))
    rows = rows.withColumn("_g", packed(F.transform("x", lambda e: e["_n"]), budget))
    one = rows.select(query, F.posexplode(F.arrays_zip(F.col("x").alias("x"), F.col("_g").alias("g"))).alias("_at", "e")).select(query, "_at", F.col("e.g").alias("chunk"), F.col("e.x._text").alias("_text"), F.col("e.x._n").alias("_n"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_text"))), lambda e: e["_text"]), SEPARATOR)
    return one.groupBy(query, "chunk").agg(F.count("*").alias("n_items"), F.sum("_n").alias("n_words"), text.alias("text"))


def partial_answers(questions: DataFrame, prompts: DataFrame, images: DataFrame | None, query: str, question: str, answer: Answer = best_sentence) -> DataFrame:
    """(query, place, source, content): one answer for each chunk of text, then one for each image (query, order, page, content, img_path), by its caption.

    Images without a path give none."""
    asked = questions.select(query, F.col(question).alias("_q"))
    text = prompts.join(asked, query).select(query, F.struct(F.lit(0).alias("kind"), F.col("chunk").cast("long").alias("at")).alias("_o"), F.concat(F.lit("Text Chunk "), (F.col("chunk") + 1).cast("string")).alias("source"), answer(F.col("_q"), F.col("text")).alias("content"))
    if images is None:
        return text.select(query, F.col("_o").alias("place"), "source", "content")
    from pyspark.sql import Window

    shown = images.where("coalesce(img_path, '') <> ''").withColumn("_i", F.row_number().over(Window.partitionBy(query).orderBy("order")))
    caption = F.concat(F.lit("An image in Page: "), F.coalesce(F.col("page").cast("string"), F.lit("-1")), F.lit(", Caption: "), F.coalesce("content", F.lit("")))
    seen = shown.join(asked, query).select(query, F.struct(F.lit(1).alias("kind"), F.col("_i").cast("long").alias("at")).alias("_o"), F.concat(F.lit("Image "), F.col("_i").cast("string")).alias("source"), answer(F.col("_q"), caption).alias("content"))
    return text.unionByName(seen).select(query, F.col("_o").alias("place"), "source", "content")


def reduce_answers(questions: DataFrame, partials: DataFrame, query: str, question: str, budget: int, answer: Answer = best_sentence, nothing: str = NOTHING) -> DataFrame:
    """(query, answer, n_partials, rounds): partial answers (query, place, source, content) brought down to one.

    No partial answer gives `nothing`, one is the answer. More are written one under the other and packed into chunks of at most `budget` words, two a chunk at least, each chunk is answered, and so on until
    one is left: the usual case is one round, very many partial answers need a few. Each round is a written table of fewer rows, queries that are done take no further part. The result follows
    `place` alone, not the layout of the rows."""
    asked = questions.select(query, F.col(question).alias("_q"))
    counts = partials.groupBy(query).agg(F.count("*").alias("n_partials"))
    here = materialize(partials.select(query, F.col("place").alias("_p"), "source", "content"))
    done, rounds = None, 0
    while True:
        rows = here.groupBy(query).agg(F.sort_array(F.collect_list(F.struct("_p", "source", "content"))).alias("x"))
        single = rows.where(F.size("x") == 1).select(query, F.element_at("x", 1)["content"].alias("answer"), F.lit(rounds).alias("rounds"))
        done = materialize(single if done is None else done.unionByName(single))
        rows = rows.where(F.size("x") > 1)
        if not rows.take(1):
            break
        text = lambda e: F.concat(F.lit("### Analysis from "), e["source"], F.lit("\n"), e["content"], F.lit("\n---"))
        # a chunk takes two at least, so that every round leaves fewer
        groups = packed_pairs(F.transform("x", lambda e: F.size(words(text(e)))), budget)
        each = rows.select(query, F.posexplode(F.arrays_zip(F.col("x").alias("x"), groups.alias("g"))).alias("_at", "e")).select(query, "_at", F.col("e.g").alias("g"), text(F.col("e.x")).alias("_t"))
        prompt = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_t"))), lambda e: e["_t"]), "\n")
        chunks = each.groupBy(query, "g").agg(prompt.alias("text")).join(asked, query)
        rounds += 1
        place = F.struct(F.lit(0).alias("kind"), F.col("g").cast("long").alias("at"))
        here = materialize(chunks.select(query, place.alias("_p"), F.concat(F.lit("Text Chunk "), (F.col("g") + 1).cast("string")).alias("source"), answer(F.col("_q"), F.col("text")).alias("content")))
    out = asked.select(query).join(done, query, "left").join(counts, query, "left")
    return out.select(query, F.coalesce("answer", F.lit(nothing)).alias("answer"), F.coalesce("n_partials", F.lit(0)).alias("n_partials"), F.coalesce("rounds", F.lit(0)).alias("rounds"))


def packed_pairs(sizes: Column, budget: int) -> Column:
    """As packed, but no group is closed with one item; a last item alone joins the group before it."""
    start = F.struct(F.lit(0).alias("group"), F.lit(0).cast("long").alias("held"), F.lit(0).alias("n"), F.array().cast("array<int>").alias("groups"))

    def add(s: Column, n: Column) -> Column:
        full = (s["n"] >= 2) & (s["held"] + n > budget)
        group = s["group"] + full.cast("int")
        return F.struct(
            group.alias("group"), F.when(full, n.cast("long")).otherwise(s["held"] + n).alias("held"), F.when(full, F.lit(1)).otherwise(s["n"] + 1).alias("n"), F.concat(s["groups"], F.array(group)).alias("groups")
        )

    def end(s: Column) -> Column:
        alone = (s["n"] == 1) & (s["group"] > 0)
        return F.when(alone, F.concat(F.slice(s["groups"], 1, F.size(s["groups"]) - 1), F.array(s["group"] - 1))).otherwise(s["groups"])

    return F.aggregate(sizes, start, add, end)


def complex_answers(questions: DataFrame, findings: DataFrame, query: str, question: str, budget: int, answer: Answer = best_sentence) -> DataFrame:
    """(query, answer, n_partials, rounds): answers to questions in parts, from the findings (query, step, question, answer) of the steps of their plans; the same reduction, with `NOTHING_COMPLEX` where there is no finding."""
    place = F.struct(F.lit(0).alias("kind"), F.col("step").cast("long").alias("at"))
    rows = findings.select(query, place.alias("place"), F.concat(F.lit("'"), F.col("question"), F.lit("'")).alias("source"), F.col("answer").alias("content"))
    return reduce_answers(questions, rows, query, question, budget, answer, NOTHING_COMPLEX)
