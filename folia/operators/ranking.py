"""Merging rankers, linking nodes and sections, retrieval as one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folia.operators.skyline import skyline_2d, with_fallback


def merge_scores(rankers: dict[str, DataFrame], id_col: str) -> DataFrame:
    """One row for each id with a column for each ranker (id, score); a missing score is 0.

    A union and one aggregate, so that any number of rankers costs one shuffle."""
    stacked = None
    for name, df in rankers.items():
        part = df.select(id_col, F.lit(name).alias("_ranker"), F.col("score").cast("double").alias("score"))
        stacked = part if stacked is None else stacked.unionByName(part)
    aggs = [F.coalesce(F.max(F.when(F.col("_ranker") == n, F.col("score"))), F.lit(0.0)).alias(n) for n in rankers]
    return stacked.groupBy(id_col).agg(*aggs)


def linked_nodes(entities: DataFrame, bridge: DataFrame) -> DataFrame:
    """(node, map_cnt, linked): how many of the entities each node holds, and which."""
    hit = bridge.join(entities.select("entity").distinct(), "entity", "left_semi")
    return hit.groupBy("node").agg(F.count_distinct("entity").alias("map_cnt"), F.sort_array(F.collect_set("entity")).alias("linked"))


def mass_per_node(ranks: DataFrame, bridge: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(node, score): PageRank of the entities of each node; nodes without any get 0."""
    got = bridge.join(ranks.select(F.col("node").alias("entity"), "rank"), "entity").groupBy("node").agg(F.sum("rank").alias("score"))
    if nodes is None:
        return got
    return nodes.select("node").join(got, "node", "left").select("node", F.coalesce("score", F.lit(0.0)).alias("score"))


def seed_mass(similarities: DataFrame) -> DataFrame:
    """(node, mass): similarity moved to 0..1, added up for each vertex, as a share of all; empty where the sum is not positive."""
    per = similarities.groupBy("node").agg(F.sum((F.col("similarity") + 1) / 2).alias("m"))
    total = per.agg(F.sum("m").alias("total"))
    return per.join(F.broadcast(total)).where("total > 0").select("node", (F.col("m") / F.col("total")).alias("mass"))  # one row is broadcast


def select_front(scores: DataFrame, id_col: str, a: str, b: str, k: int) -> DataFrame:
    """The skyline of two rankers with its fallback."""
    return with_fallback(scores, skyline_2d(scores, a, b), id_col, [a, b], k)


def top_k(df: DataFrame, group: list[str], score: str, id_col: str, k: int) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(F.desc(score), id_col)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
