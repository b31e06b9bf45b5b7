"""Scores of answers against several gold answers, answers of a judge, and reports over result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folia.functions.text import words
from folia.operators.metrics import shared_tokens

# Gold answers that are none or a yes or no, the mark of evidence that is not text, keys of a judge's answer, and what stands for a missing one.
NOT_ANSWERABLE, YES, NO = "Not answerable", "Yes", "No"
FLOAT_MARK = "FLOAT SELECTED"
JUDGED, MISSING = ("extracted results", "format", "score"), "Failed to extract"
# Fixed value: the marks that normalising takes out of an answer.
MARKS = r"""[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]"""
#: Type of a gold answer beside its texts: what is compared as tokens, and what has to be contained.
GOLD = "struct<answer: string, evidence: array<string>, type: string, raw: array<string>>"


def normal_answer(c: Column) -> Column:
    """Lower case without marks and articles, single spaces."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), MARKS, ""), r"(?U)\b(a|an|the)\b", " ")
    return F.array_join(words(bare), " ")


def gold_answers(infos: Column, text_only: bool = False) -> Column:
    """Gold answers (GOLD) of annotations, an array of (unanswerable, extractive_spans, free_form_answer, yes_no, evidence).

    The first that is there counts: unanswerable, spans (joined by commas; each is contained alone), a free answer, yes or no. An annotation with none of them is left out.
    text_only: without evidence that is a figure or a table; an unanswerable question has none."""
    some = lambda c: F.coalesce(c, F.lit("")) != ""

    def one(a: Column) -> Column:
        spans = F.coalesce(a["extractive_spans"], F.array().cast("array<string>"))
        evidence = F.coalesce(a["evidence"], F.array().cast("array<string>"))
        if text_only:
            evidence = F.filter(evidence, lambda e: ~e.contains(FLOAT_MARK))
        gold = lambda answer, kind, raw, e=evidence: F.struct(answer.alias("answer"), e.alias("evidence"), F.lit(kind).alias("type"), raw.alias("raw"))
        word = lambda t: gold(F.lit(t), "boolean", F.array(F.lit(t)))
        return (
            F.when(a["unanswerable"], gold(F.lit(NOT_ANSWERABLE), "none", F.array(F.lit(NOT_ANSWERABLE)), F.array().cast("array<string>")))
            .when(F.size(spans) > 0, gold(F.array_join(spans, ", "), "extractive", spans))
            .when(some(a["free_form_answer"]), gold(a["free_form_answer"], "abstractive", F.array(a["free_form_answer"])))
            .when(a["yes_no"], word(YES)).when(~a["yes_no"], word(NO))
        )

    return F.filter(F.transform(infos, one), lambda g: g.isNotNull())


def answer_f1(predicted: Column, gold: Column) -> Column:
    """Token F1 of two texts; 0 where no token is shared, both empty included."""
    p, g = (F.split(normal_answer(c), " ") for c in (predicted, gold))
    p, g = (F.filter(x, lambda w: w != "") for x in (p, g))
    shared = shared_tokens(g, p)
    return F.when(shared == 0, F.lit(0.0)).otherwise(2.0 * shared / (F.size(p) + F.size(g)))


def contained(predicted: Column, raw: Column) -> Column:
    """1 where a gold text stands in the prediction, both normalised; else 0."""
    p = normal_answer(predicted)
    return F.exists(raw, lambda g: F.contains(p, normal_answer(g))).cast("double")


def paragraph_f1(predicted: Column, gold: Column) -> Column:
    """F1 of two lists of paragraphs: distinct shared ones over their lengths; two empty lists are 1."""
    same = F.size(F.array_intersect(predicted, gold))
    return F.when((F.size(predicted) == 0) & (F.size(gold) == 0), F.lit(1.0)).when(same == 0, F.lit(0.0)).otherwise(2.0 * same / (F.size(predicted) + F.size(gold)))


def best_scores(df: DataFrame, predicted: str, golds: str) -> DataFrame:
    """Adds accuracy and f1: the best containment and token F1 over an array of gold answers (GOLD); 0 without any."""
    best = lambda f: F.coalesce(F.array_max(F.transform(golds, f)), F.lit(0.0))
    p = F.col(predicted)
    return df.withColumns({"accuracy": best(lambda g: contained(p, g["raw"])), "f1": best(lambda g: answer_f1(p, g["answer"]))})


def judge_answer(c: Column) -> Column:
    """(extracted, format, score) of a judge's lines of key and value: the last line of a key counts, other lines do not. A missing text is `Failed to extract`, a missing or odd score 0."""
    lines = F.filter(F.split(F.trim(F.coalesce(c, F.lit(""))), "\n"), lambda x: F.contains(x, F.lit(":")))
    strip = lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")
    pairs = F.transform(lines, lambda x: F.struct(strip(F.lower(F.substring_index(x, ":", 1))).alias("k"), strip(F.regexp_replace(x, r"^[^:]*:", "")).alias("v")))
    last = lambda k: F.element_at(F.filter(pairs, lambda x: x["k"] == k), -1)["v"]
    text = lambda k: F.coalesce(F.when(F.exists(pairs, lambda x: x["k"] == k), last(k)), F.lit(MISSING))
    score = F.when(F.exists(pairs, lambda x: x["k"] == JUDGED[2]), last(JUDGED[2])).try_cast("double")
    return F.struct(text(JUDGED[0]).alias("extracted"), text(JUDGED[1]).alias("format"), F.coalesce(score, F.lit(0.0)).alias("score"))


def evaluate(results: DataFrame, golds: DataFrame, keys: list[str], predicted: str = "prediction", infos: str = "infos", text_only: bool = False) -> DataFrame:
    """Results with accuracy, f1, n_golds and answerable: each result (keys…, prediction, …) against the annotations (keys…, infos) of its question.

    answerable: a gold answer other than that there is none. Results without annotations have no golds, scores of 0 and a null answerable. One join; every document is scored where its rows are."""
    g = golds.select(*keys, gold_answers(F.col(infos), text_only).alias("_g"))
    t = best_scores(results.join(g, keys, "left"), predicted, "_g")
    return t.withColumns({"n_golds": F.coalesce(F.size("_g"), F.lit(0)), "answerable": F.exists("_g", lambda x: x["type"] != "none")}).withColumn("n_golds", F.greatest("n_golds", F.lit(0))).drop("_g")


def report(scored: DataFrame, group: list[str], scores: list[str] | tuple = ("accuracy", "f1")) -> DataFrame:
    """(group…, n, n_answerable, the mean of each score, and its mean over answerable results)."""
    means = [F.avg(s).alias(s) for s in scores] + [F.avg(F.when(F.col("answerable"), F.col(s))).alias(f"answerable_{s}") for s in scores]
    return scored.groupBy(*group).agg(F.count("*").alias("n"), F.count_if("answerable").alias("n_answerable"), *means)


def in_order(df: DataFrame, first: list[str]) -> DataFrame:
    """Columns named in `first` that are there, in that order, then the others as they stand."""
    return df.select(*[c for c in first if c in df.columns], *[c for c in df.columns if c not in first])


def save_scores(scored: DataFrame, path: str, group: list[str], first: list[str]) -> DataFrame:
    """Writes scored results (Parquet, columns in order of `first`) and their report (JSON lines) under a folder, and gives the report back."""
    in_order(scored, first).write.mode("overwrite").parquet(f"{path}/results")
    total = report(scored.sparkSession.read.parquet(f"{path}/results"), group)
    total.write.mode("overwrite").json(f"{path}/scores")
    return total
