"""Plans of questions in parts as dependency graphs: made without a model, checked, and run level by level, answers of one level filled into the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folia.functions.text import words
from folia.plans.runtime import materialize

# Types of steps, and words at the start of a part that stand for the answer before it.
RETRIEVAL, SYNTHESIS = "retrieval", "synthesis"
STANDS_FOR = ("it", "its", "they", "them", "their", "that", "this", "these", "those")
#: Where a question falls into parts.
PARTS = r"\s*(?:[;?]|,? and then |, and )\s*"


def plan_questions(questions: DataFrame, query: str, question: str) -> DataFrame:
    """(query, step, type, question, depends): the parts of each question as steps from 0, and behind two or more of them a synthesis over all.

    A part that begins with a word that stands for something (it, that, their …) asks about the answer before it: the word becomes the mark {n} of that step, on which it depends.
    A question of one part is simple: one retrieval step. Blank questions have no steps."""
    parts = F.filter(F.split(F.coalesce(F.col(question), F.lit("")), PARTS), lambda p: F.size(words(p)) > 0)

    def step(p: Column, i: Column) -> Column:
        w = words(p)
        refers = (i > 0) & F.lower(F.element_at(w, 1)).isin(*STANDS_FOR)
        mark = F.concat(F.lit("{"), (i - 1).cast("string"), F.lit("}"))
        rest = F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0)))
        text = F.when(refers, F.array_join(F.concat(F.array(mark), rest), " ")).otherwise(F.array_join(w, " "))
        return F.struct(i.alias("step"), F.lit(RETRIEVAL).alias("type"), text.alias("question"), F.when(refers, F.array(i - 1)).otherwise(F.array().cast("array<int>")).alias("depends"))

    steps = F.transform("_p", step)
    last = F.struct(F.size("_p").alias("step"), F.lit(SYNTHESIS).alias("type"), F.col("_q").alias("question"), F.transform("_p", lambda p, i: i).alias("depends"))
    t = questions.select(query, F.col(question).alias("_q"), parts.alias("_p")).where("size(_p) > 0")
    return t.select(query, F.explode(F.when(F.size("_p") > 1, F.concat(steps, F.array(last))).otherwise(steps)).alias("s")).select(query, "s.*")


def plan_levels(steps: DataFrame, query: str) -> tuple[DataFrame, DataFrame]:
    """((query, step, level), (query, step, problem)): the level of each step, one above the highest it depends on, and the steps that cannot run.

    problem: `missing` where a step depends on one that its plan does not have, `cycle` where it waits on itself, `waits` where it waits on such steps. One round a level, in which the steps that are still open meet those just done."""
    every = materialize(steps.select(query, "step", F.array_distinct("depends").alias("depends")))
    arcs = materialize(every.select(query, "step", F.explode("depends").alias("on")))
    known = every.select(query, F.col("step").alias("on"))
    lost = materialize(arcs.join(known, [query, "on"], "left_anti").select(query, "step").distinct())
    front = materialize(every.where("size(depends) = 0").select(query, "step", F.lit(0).alias("level")))
    done, level, left = front, 0, arcs
    while front.take(1):
        level += 1
        met = front.select(query, F.col("step").alias("on"))
        touched = left.join(met, [query, "on"], "left_semi").select(query, "step").distinct()
        left = materialize(left.join(met, [query, "on"], "left_anti"))
        front = materialize(touched.join(left.select(query, "step").distinct(), [query, "step"], "left_anti").withColumn("level", F.lit(level)))
        done = done.unionByName(front)
    stuck = materialize(every.join(done, [query, "step"], "left_anti").select(query, "step"))
    # of the stuck steps those on a cycle: what waits on nothing stuck goes, from below and from above
    ring = arcs.join(stuck, [query, "step"], "left_semi").join(stuck.withColumnRenamed("step", "on"), [query, "on"], "left_semi")
    while True:
        ring = materialize(ring)
        ends = ring.select(query, F.col("on").alias("step")).distinct()
        starts = ring.select(query, F.col("step").alias("on")).distinct()
        kept = materialize(ring.join(ends, [query, "step"], "left_semi").join(starts, [query, "on"], "left_semi"))
        if kept.count() == ring.count():
            break
        ring = kept
    cyclic = ring.select(query, "step").distinct().withColumn("problem", F.lit("cycle"))
    bad = stuck.join(lost.withColumn("_m", F.lit("missing")), [query, "step"], "left").join(cyclic, [query, "step"], "left")
    return done, bad.select(query, "step", F.coalesce("_m", "problem", F.lit("waits")).alias("problem"))


def run_plans(steps: DataFrame, query: str, answer: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """((query, step, level, type, asked, answer), problems as in plan_levels): all plans level by level.

    answer takes (query, step, type, asked) of one level and gives (query, step, answer). asked is the question with each mark {n} of a step it depends on replaced by that step's answer, and for a synthesis the findings:
    a line `question: answer` for each step it depends on, in order, under the question. A missing answer is empty. Levels are written tables; plans that are done take no further part."""
    levels, problems = plan_levels(steps, query)
    t = materialize(steps.join(levels, [query, "step"]))
    top = t.agg(F.max("level")).first()[0]
    done = None
    for level in range((top if top is not None else -1) + 1):
        here = t.where(F.col("level") == level).select(query, "step", "type", "question", "depends", "level")
        if done is None:
            asked = here.withColumn("asked", F.col("question"))
        else:
            need = here.select(query, "step", F.explode(F.array_distinct("depends")).alias("on"))
            got = need.join(done.select(query, F.col("step").alias("on"), F.struct(F.col("step").alias("on"), "asked", "answer").alias("f")), [query, "on"]).groupBy(query, "step").agg(F.sort_array(F.collect_list("f")).alias("f"))
            filled = F.aggregate("f", F.col("question"), lambda q, f: F.replace(q, F.concat(F.lit("{"), f["on"].cast("string"), F.lit("}")), f["answer"]))
            findings = F.concat_ws("\n", F.col("question"), F.array_join(F.transform("f", lambda f: F.concat(f["asked"], F.lit(": "), f["answer"])), "\n"))
            asked = here.join(got, [query, "step"], "left").withColumn("asked", F.when(F.col("f").isNull(), F.col("question")).when(F.col("type") == SYNTHESIS, findings).otherwise(filled)).drop("f")
        asked = materialize(asked)
        said = answer(asked.select(query, "step", "type", "asked"))
        made = materialize(asked.join(said.select(query, "step", "answer"), [query, "step"], "left").select(query, "step", "level", "type", "asked", F.coalesce("answer", F.lit("")).alias("answer")))
        done = made if done is None else done.unionByName(made)
    if done is None:
        done = t.select(query, "step", "level", "type", F.col("question").alias("asked"), F.lit("").alias("answer"))
    return done, problems
