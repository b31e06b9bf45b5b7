"""Entity resolution in stages, independent of input order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folia.operators.graph import smallest_reachable


def similarity(a: str, b: str):
    """1 - edit distance over the longer length."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))


def resolve(entities: DataFrame, block: list[str], at_least: float = 0.9) -> DataFrame:
    """(id, canonical): entities (id, name, block columns) merged with earlier ones of the same block.

    Equal names are merged by an aggregate first, so only distinct names of a block are compared. Each name
    then links to its most alike earlier name at or above the threshold (smallest id on ties), and
    canonical is the smallest id that the links reach. A block is the unit of comparison: choose keys that keep it small."""
    names = entities.groupBy(*block, "name").agg(F.min("id").alias("first"))
    a = names.toDF(*block, "name", "id")
    b = names.toDF(*block, "other", "earlier")
    scored = a.join(b, block).where("earlier < id").withColumn("s", similarity("name", "other")).where(F.col("s") >= at_least)
    links = scored.groupBy("id").agg(F.max_by("earlier", F.struct("s", (-F.col("earlier")).alias("e"))).alias("earlier"))
    roots = smallest_reachable(links.select(F.col("id").alias("a"), F.col("earlier").alias("b"))).toDF("first", "root")
    merged = entities.join(names, [*block, "name"]).join(roots, "first", "left")
    return merged.select("id", F.coalesce("root", "first").alias("canonical"))


def select_candidates(scored: DataFrame, group: str, k: int = 10, far: float = 0.2, bar: float = 0.5, ratio: float = 0.6) -> DataFrame:
    """Candidates (group, id, distance, score) that stay: none where the best distance is above `far` or the best score under `bar`; else the k nearest, cut where a score falls under ratio times the one before."""
    w = Window.partitionBy(group)
    near = scored.withColumn("_r", F.row_number().over(w.orderBy("distance", "id"))).where(F.col("_r") <= k)
    gated = near.withColumn("_d", F.min("distance").over(w)).withColumn("_s", F.max("score").over(w)).where((F.col("_d") <= far) & (F.col("_s") >= bar))
    o = w.orderBy(F.desc("score"), "id")
    ok = F.coalesce(F.col("score") >= ratio * F.lag("score").over(o), F.lit(True)).cast("int")
    return gated.withColumn("_ok", ok).withColumn("_all", F.min("_ok").over(o)).where("_all = 1").drop("_r", "_d", "_s", "_ok", "_all")


def decide(candidates: DataFrame, group: str, bar: float = 0.5, chosen: DataFrame | None = None) -> DataFrame:
    """(group, id, score): the match of each group among its candidates (group, id, score), or no row where none is taken.

    None is where the best score is under `bar`. Else a choice (group, index), counted from 0 in falling order of score, decides; -1, an index beyond the candidates and a null take none, and
    without choices the best is taken. Equal scores go by id; a group's candidates are few by select_candidates."""
    w = Window.partitionBy(group)
    t = candidates.withColumn("_i", F.row_number().over(w.orderBy(F.desc("score"), "id")) - 1).withColumn("_best", F.max("score").over(w)).where(F.col("_best") >= bar)
    if chosen is None:
        return t.where("_i = 0").select(group, "id", "score")
    return t.join(chosen.select(group, F.col("index").alias("_i")), [group, "_i"]).select(group, "id", "score")


def rewrite_relations(relations: DataFrame, canonical: DataFrame) -> DataFrame:
    """Relations (src, dst, relation, weight) between canonical entities: dangling ends and self loops go, repeats keep the heaviest."""
    a, b = canonical.toDF("src", "a"), canonical.toDF("dst", "b")
    t = relations.join(a, "src").join(b, "dst").where("a <> b")
    return t.groupBy("a", "b", "relation").agg(F.max("weight").alias("weight"))
