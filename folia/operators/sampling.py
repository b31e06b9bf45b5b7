"""Sampling and dataset preparation with draws that any engine can repeat (md5 of a seed and the id)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folia.operators.places import placed
from folia.session import ship


def draw(seed: int, *ids: Column | str) -> Column:
    """A hex string in pseudo-random order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in ids]))


def uniform(seed: int, *ids: Column | str) -> Column:
    """A number in [0, 1) from the first 13 hex digits of the draw."""
    return F.conv(F.substring(draw(seed, *ids), 1, 13), 16, 10).cast("double") / float(16**13)


def first_by_content(df: DataFrame, text: str, order: str) -> DataFrame:
    """The first row of each text up to case and white space; blank texts go. Texts are compared by digest."""
    norm = F.trim(F.regexp_replace(F.lower(F.col(text)), r"\s+", " "))
    t = df.withColumn("_n", norm).where("_n <> ''").withColumn("_k", F.md5("_n")).drop("_n")
    keep = t.groupBy("_k").agg(F.min(order).alias(order))
    return t.join(keep, ["_k", order], "left_semi").drop("_k")


def stratified(df: DataFrame, stratum: str, id_col: str, quotas: dict[str, int], spill_to: str, seed: int) -> DataFrame:
    """Rows by draw up to each stratum's quota; what a stratum lacks is added to the quota of `spill_to`."""
    have = {r[stratum]: r["n"] for r in df.where(F.col(stratum).isin(list(quotas))).groupBy(stratum).agg(F.count("*").alias("n")).collect()}  # as many as there are quotas
    short = sum(max(0, q - have.get(k, 0)) for k, q in quotas.items() if k != spill_to)
    want = {k: min(q, have.get(k, 0)) for k, q in quotas.items()} | {spill_to: quotas.get(spill_to, 0) + short}
    quota = F.create_map(*[x for k, v in want.items() for x in (F.lit(k), F.lit(v))])
    w = Window.partitionBy(stratum).orderBy(draw(seed, id_col), id_col)
    return df.where(F.col(stratum).isin(list(want))).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= quota[F.col(stratum)])


def allocate(scales: DataFrame, key: str, scale: str, total: int, least: int) -> DataFrame:
    """Adds n: total shared in proportion to scale, `least` at least, half-even rounding; the residual goes one by one over the largest, once."""
    s = scales.agg(F.sum(scale).alias("s"), F.count("*").alias("n")).first()
    whole = s["s"] or 0
    part = F.greatest(F.lit(least), F.bround(F.col(scale) * F.lit(float(total)) / F.lit(float(whole or 1)), 0).cast("long"))
    t = scales.withColumn("n", part)
    gap = total - (t.agg(F.sum("n")).first()[0] or 0)
    step = 1 if gap > 0 else -1
    can = F.lit(True) if gap > 0 else F.col("n") > least
    return placed(t, [F.desc(scale), F.asc(key)], "_r").withColumn("n", F.col("n") + F.when((F.col("_r") < abs(gap)) & can, F.lit(step)).otherwise(F.lit(0))).drop("_r")


def parent_child_groups(children: DataFrame, parent: str, child: str, seed: int, most: int = 3) -> DataFrame:
    """(parent, nodes): each parent with one to `most` of its children by draw, the number by draw too; nodes has the parent first, then the children in order."""
    w = Window.partitionBy(parent).orderBy(draw(seed, child), child)
    t = children.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= most).where(F.col("_r") <= 1 + F.floor(uniform(seed, parent) * most))
    return t.groupBy(parent).agg(F.concat(F.array(F.first(parent)), F.sort_array(F.collect_list(child))).alias("nodes"))


def cross_section_groups(children: DataFrame, section: str, child: str, seed: int, most: int = 20) -> DataFrame:
    """(g, nodes): up to `most` groups, and two for each section, of one child from each of two or three sections; all by draw.

    Sections without children take no part. Children are aggregated, not numbered, so a large section is no large task."""
    n = children.select(section).distinct().count()
    if n < 2:
        return children.sparkSession.createDataFrame([], "g int, nodes array<string>")
    rounds = range(min(most, 2 * n))
    of = children.groupBy(section).agg(*[F.min(F.struct(draw(seed, F.lit(g), child).alias("d"), F.col(child).cast("string").alias("v")))["v"].alias(f"_{g}") for g in rounds])
    t = of.select(section, F.posexplode(F.array(*[f"_{g}" for g in rounds])).alias("g", "_v"))
    w = Window.partitionBy("g").orderBy(draw(seed + 1, "g", section), section)
    t = t.withColumn("_r", F.row_number().over(w)).where("_r <= 3").where(F.col("_r") <= 2 + F.floor(uniform(seed, "g") * 2))
    return t.groupBy("g").agg(F.sort_array(F.collect_list("_v")).alias("nodes"))


def mixed_groups(sources: dict[str, DataFrame], total: int, seed: int) -> DataFrame:
    """(method, nodes): `total` groups in equal parts of the sources by draw; the last source takes what division leaves. A source that has too few gives all."""
    part = max(1, total // len(sources))
    out = None
    for k, (name, groups) in enumerate(sources.items()):
        want = part if k + 1 < len(sources) else max(0, total - part * k)
        nodes = F.array_join(F.transform("nodes", lambda x: x.cast("string")), ",")
        took = groups.select(F.lit(name).alias("method"), "nodes").orderBy(draw(seed, F.lit(name), nodes), nodes).limit(want)
        out = took if out is None else out.unionByName(took)
    return out


def weighted_sample(df: DataFrame, id_col: str, weight: str, k: int, seed: int) -> DataFrame:
    """k rows without replacement, in proportion to weight (exponential keys)."""
    key = -F.log(uniform(seed, id_col) + 1e-300) / F.col(weight)
    return df.where(F.col(weight) > 0).withColumn("_key", key).orderBy("_key", id_col).limit(k).drop("_key")


def weighted_label(u: Column, weights: dict[str, float]) -> Column:
    """The label whose share of the cumulated weights holds u."""
    total, acc, out = sum(weights.values()), 0.0, None
    for name, w in weights.items():
        acc += w / total
        out = F.when(u < acc, name) if out is None else out.when(u < acc, name)
    return out.otherwise(list(weights)[-1])


def split_slices(df: DataFrame, key: str, n: int) -> DataFrame:
    """Adds slice 1..n: the distinct keys in order, cut to runs of ceil(keys / n)."""
    ranked = placed(df.select(key).distinct(), [F.asc(key)], "_k")
    size = max(1, -(-ranked.count() // n))
    return df.join(ranked.select(key, (F.floor(F.col("_k") / size) + 1).cast("int").alias("slice")), key)


def greedy_distinct(df: DataFrame, group: str, order: str, text: str, limit: float = 0.7) -> DataFrame:
    """Rows kept when the Jaccard similarity of their character set with every row kept before in the group is under the limit.

    Sequential inside a group by definition; groups are dealt over the cluster."""
    ship(df.sparkSession)

    def keep(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values(order, kind="stable")
        kept: list[set] = []
        flags = []
        for t in x[text]:
            s = set((t or "").lower())
            ok = all(len(s & k) < limit * len(s | k) for k in kept) if s else True
            flags.append(ok)
            if ok:
                kept.append(s)
        return x[flags]

    return df.groupBy(group).applyInPandas(keep, df.schema)


def char_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of the character sets of two strings."""
    x, y = F.array_distinct(F.split(F.lower(a), "")), F.array_distinct(F.split(F.lower(b), ""))
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))


def distribution(df: DataFrame, cols: list[str]) -> DataFrame:
    """(category, value, n, share) of each column."""
    e = F.explode(F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).cast("string").alias("value")) for c in cols]))
    n = df.select(e.alias("e")).groupBy("e.category", "e.value").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("category")))
