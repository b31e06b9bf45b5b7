"""Skylines: rows that no other row beats in every dimension."""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folia.session import ship


def skyline_2d(df: DataFrame, a: str, b: str, cells: int = 256) -> DataFrame:
    """Rows on the Pareto front of two maximised columns; ties stay.

    One row for each distinct `a` is left after a partial aggregate. These fall into cells of about equal number by ranges of `a`; a row stays if it tops the best `b` of all
    higher cells and of the higher rows of its own, a running maximum inside each cell. Only the cells' best ones, a row each, meet in one task."""
    best = df.where(f"{a} is not null and {b} is not null").groupBy(a).agg(F.max(b).alias("_b"))
    cuts = best.agg(F.percentile_approx(F.col(a).cast("double"), [k / cells for k in range(1, cells)], 20 * cells).alias("q")).first()["q"]
    if cuts is None:
        return df.limit(0)
    bounds = F.array(*[F.lit(float(x)) for x in sorted(set(cuts))])
    celled = best.withColumn("_cell", F.size(F.filter(bounds, lambda x: x <= F.col(a).cast("double"))))
    tops = celled.groupBy("_cell").agg(F.max("_b").alias("_top"))
    above = Window.orderBy(F.desc("_cell")).rowsBetween(Window.unboundedPreceding, -1)
    bars = tops.withColumn("_bar", F.max("_top").over(above)).select("_cell", "_bar")  # `cells` rows at most
    higher = Window.partitionBy("_cell").orderBy(F.desc(a)).rowsBetween(Window.unboundedPreceding, -1)
    thin = celled.join(F.broadcast(bars), "_cell").where("_bar is null or _b > _bar")
    front = thin.withColumn("_pm", F.max("_b").over(higher)).where("_pm is null or _b > _pm").select(F.col(a).alias("_a"), "_b")
    return df.join(front, (F.col(a) == F.col("_a")) & (F.col(b) == F.col("_b"))).drop("_a", "_b")


def _front(m: np.ndarray) -> np.ndarray:
    order = np.lexsort(tuple(-m[:, k] for k in range(m.shape[1] - 1, -1, -1)))
    kept: list[int] = []
    for i in order:
        f = m[kept]
        if not len(kept) or not ((f >= m[i]).all(axis=1) & (f > m[i]).any(axis=1)).any():
            kept.append(i)
    return np.array(kept, int)


def skyline(df: DataFrame, dims: list[str], cells: int = 4096) -> DataFrame:
    """Rows on the Pareto front of any number of maximised columns; ties stay, rows with a null or NaN among them go.

    Each Arrow batch gives its own front. Of these rows go those whose cell of a grid another cell tops in every dimension; the grid has `cells` cells
    at most, so the tables of cells and of pairs of cells are bounded. The rest is held against the rows of cells that can beat it, by an anti join on the cell: no step takes one partition."""
    ship(df.sparkSession)
    for c in dims:
        df = df.where(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # ranks compare as the values do, whatever their type
            ranks = [np.unique(b.column(c).to_numpy(zero_copy_only=False), return_inverse=True)[1] for c in dims]
            yield b.take(pa.array(_front(np.stack(ranks, axis=1)))) if b.num_rows else b

    # some dimensions are not cut where they are too many for the number of cells
    cut = dims[: max(1, int(math.log2(cells)))]
    per = max(2, int(cells ** (1 / len(cut))))
    finite = [F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c).cast("double")) for c in cut]
    edge = df.agg(*[f(x).alias(f"{n}{i}") for i, x in enumerate(finite) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    place = []
    for i, c in enumerate(cut):
        lo, hi = edge[f"lo{i}"] or 0.0, edge[f"hi{i}"] or 0.0
        step = (hi / per - lo / per) or 1.0
        place.append(F.floor(F.least(F.greatest((F.col(c).cast("double") - F.lit(lo)) / F.lit(step), F.lit(0.0)), F.lit(per - 1.0))).cast("int"))
    from folia.plans.runtime import materialize

    rows = materialize(df.mapInArrow(local, df.schema).withColumn("_cell", F.array(*place)))
    grid = rows.select("_cell").distinct()
    at = lambda n: [F.col(n)[i] for i in range(len(cut))]
    every = lambda tests: functools.reduce(operator.and_, tests)
    pairs = grid.select(F.col("_cell").alias("x")).join(grid.select(F.col("_cell").alias("y")), every([y >= x for x, y in zip(at("x"), at("y"))]))
    pairs = materialize(pairs)
    if len(cut) == len(dims):
        pairs = pairs.join(pairs.where(every([y > x for x, y in zip(at("x"), at("y"))])).select("x").distinct(), "x", "left_anti")
    points = rows.select("_cell", *dims).distinct()
    better = points.join(pairs.withColumnRenamed("y", "_cell"), "_cell").select(F.col("x").alias("_of"), *[F.col(c).alias(f"_b{i}") for i, c in enumerate(dims)])
    rows = rows.join(pairs.select(F.col("x").alias("_cell")).distinct(), "_cell", "left_semi")
    mine = [(F.col(c), F.col(f"_b{i}")) for i, c in enumerate(dims)]
    beaten = every([F.col("_cell") == F.col("_of"), *[b >= a for a, b in mine], functools.reduce(operator.or_, [b > a for a, b in mine])])
    return rows.join(better, beaten, "left_anti").select(*df.columns)


def with_fallback(df: DataFrame, front: DataFrame, id_col: str, scores: list[str], k: int, extra: int = 5) -> DataFrame:
    """The front; where it is under k rows and there are k candidates, also the `extra` best of each score."""
    top = [df.orderBy(F.desc(s), id_col).limit(extra) for s in scores]
    short = front.agg((F.count("*") < k).alias("short")).join(df.agg((F.count("*") >= k).alias("enough"))).where("short and enough")
    more = None
    for t in top:
        more = t if more is None else more.unionByName(t)
    return front.unionByName(more.join(short, F.lit(True), "left_semi")).dropDuplicates([id_col])
