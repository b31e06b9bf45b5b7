"""Mixing sources to target weights with the cube method.

Every source has a target in words. Each of its rows is expected target / size
of source times: the whole part is taken for certain, the rest is its
inclusion probability. The cube method moves the probabilities of a few rows at a
time along the null space of two constraints, the words and the number of
documents of the source, until all but a few are 0 or 1: the flight. Rows are
dealt to blocks, each block is flown apart and keeps its own totals; what is left
of the blocks, two rows at most for each, is flown again together, until one block is left
and its last rows are landed on the words alone."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folia.llm.common import WORD, written
from folia.session import ship

#: Rows of one source that are flown together; small, so that a source with a third of all rows spreads over many tasks.
BLOCK_ROWS = 200
EPS = 1e-9


def fly(p: np.ndarray, size: np.ndarray, seed: int, land: bool) -> np.ndarray:
    """Probabilities after the flight over (size, count); with land, all are 0 or 1."""
    p = p.astype(float).tolist()
    s = size.astype(float).tolist()
    rng = np.random.Generator(np.random.PCG64(seed))
    draws = iter(())
    held: list[int] = []
    for i in range(len(p)):
        if not EPS < p[i] < 1 - EPS:
            continue
        held.append(i)
        if len(held) < 3:
            continue
        a, b, c = held
        # u is orthogonal to (size) and (1, 1, 1)
        u = (s[b] - s[c], s[c] - s[a], s[a] - s[b])
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        up = min((1 - p[k]) / x if x > 0 else -p[k] / x for k, x in zip(held, u) if x)
        down = min(p[k] / x if x > 0 else (p[k] - 1) / x for k, x in zip(held, u) if x)
        if (d := next(draws, None)) is None:
            draws = iter(rng.random(4096).tolist())
            d = next(draws)
        step = up if d * (up + down) < down else -down
        for k, x in zip(held, u):
            v = p[k] + step * x
            p[k] = 0.0 if v < EPS else 1.0 if v > 1 - EPS else v
        held = [k for k in held if EPS < p[k] < 1 - EPS]
    if land:
        # the landing: words only for two rows, then a draw for the last one
        if len(held) == 2:
            a, b = held
            u = (s[b], -s[a]) if s[a] or s[b] else (1.0, -1.0)
            up = min((1 - p[k]) / x if x > 0 else -p[k] / x for k, x in zip(held, u) if x)
            down = min(p[k] / x if x > 0 else (p[k] - 1) / x for k, x in zip(held, u) if x)
            step = up if rng.random() * (up + down) < down else -down
            for k, x in zip(held, u):
                v = p[k] + step * x
                p[k] = 0.0 if v < EPS else 1.0 if v > 1 - EPS else v
        for k in held:
            if EPS < p[k] < 1 - EPS:
                p[k] = 1.0 if rng.random() < p[k] else 0.0
    return np.array([round(x) if x < EPS or x > 1 - EPS else x for x in p])


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """(source, source_size, target): sources in code point order, null last, take the weights in turn.

    A target stops at `most` times its source's size; what is above is shared again
    by weight among the others. `sizes` has source and size, one row for each source will do."""
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    w = Window.orderBy(F.col("source").isNull(), "source")  # a row for each source
    turn = F.array(*[F.lit(float(x)) for x in weights])
    per = written(per.withColumn("weight", F.element_at(turn, ((F.row_number().over(w) - 1) % len(weights) + 1).cast("int"))))
    cap = F.lit(float(most)) * F.col("source_size")
    total = per.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    level = None
    while True:
        # rows below the level keep their share; the level rises as others stop
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        r = per.agg(F.sum(F.when(full, cap).otherwise(0.0)).alias("used"), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        new = (total - r["used"]) / r["open"] if r["open"] else level
        if new is None or level is not None and new <= level * (1 + 1e-12):
            level = new if level is None else level
            break
        level = new
    return per.select("source", "source_size", F.least(F.col("weight") * F.lit(level or 0.0), cap).alias("target"))


def repeats(t: DataFrame) -> DataFrame | None:
    """(row, repeat): numbers from 0 of the rows that share doc_id and text_hash with others; None if there are none.

    Rows are numbered inside runs of 2^20 row numbers, and runs are moved by the counts before them: no group is numbered whole in one task."""
    key = ["doc_id", "text_hash"]
    many = t.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"m.{c}")) for c in key]
    few = t.alias("t").join(many.alias("m"), same, "left_semi").select("row", *key, F.shiftright("row", 20).alias("run"))
    few = written(few)
    if not few.take(1):
        return None
    sizes = few.groupBy(*key, "run").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*key).orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.withColumn("before", F.coalesce(before, F.lit(0)))
    at = few.withColumn("at", F.row_number().over(Window.partitionBy(*key, "run").orderBy("row")) - 1)
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"s.{c}")) for c in (*key, "run")]
    return at.alias("a").join(sizes.alias("s"), same).select("a.row", (F.col("at") + F.col("before")).alias("repeat"))


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0, seed: int = 7,
    text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", row_col: str | None = None,
) -> DataFrame:
    """(doc_id, text_hash, size, source_size, target, copies, taken, row) for every row; row is row_col, or a number given here.

    size: words of the text (null: 0); taken = copies * size; no row has more than ceil(target /
    source_size) copies, so at most `most`. Draws depend on doc_id, text and seed alone, so reruns agree.
    Rows that repeat doc_id and text are rows of their own. A source without words has target 0 and no copies.
    Other columns are ignored; null ids are allowed."""
    spark = docs.sparkSession
    ship(spark)
    t = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(text_col).alias("text_hash"),
        (F.col(row_col).cast("long") if row_col else F.monotonically_increasing_id()).alias("row"),
    )
    t = written(t)
    again = repeats(t)
    t = t.withColumn("repeat", F.lit(0).cast("long")) if again is None else t.join(again, "row", "left").withColumn("repeat", F.coalesce("repeat", F.lit(0).cast("long")))
    targets = source_targets(t, weights, most)
    rows = t.join(targets, t["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate + EPS)
    rows = rows.withColumn("sure", whole.cast("int")).withColumn("p", F.greatest(F.lit(0.0), rate - whole))
    counts = t.groupBy("source").agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / BLOCK_ROWS).cast("int")
    most_parts = counts.agg(F.max(parts)).first()[0] or 1
    rows = rows.join(counts, rows["source"].eqNullSafe(counts["source"])).drop(counts["source"]).withColumn("parts", parts)
    # rows that repeat id and text are dealt out by their number among themselves
    order = F.when(F.col("repeat") == 0, F.xxhash64("doc_id", "text_hash", F.lit(seed))).otherwise(F.xxhash64("doc_id", "text_hash", F.lit(seed), "repeat"))
    left = rows.where(f"p > {EPS} and size > 0").select("row", "source", "size", "p", order.alias("draw"), "parts")

    def flight(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by([("draw", "ascending"), ("size", "ascending"), ("row", "ascending")])
        p = fly(t.column("p").to_numpy(), t.column("size").to_numpy(), abs(hash((seed, int(key[2].as_py())))), key[1].as_py() == 1)
        return t.set_column(t.column_names.index("p"), "p", pa.array(p, pa.float64())).drop_columns(["block"])

    done = None
    while True:
        # a source whose rows are one block is landed
        at = left.withColumn("block", F.pmod(F.shiftright("draw", 20), F.col("parts")))
        flown = written(at.groupBy("source", "parts", "block").applyInArrow(flight, "row long, source string, size long, p double, draw long, parts int"))
        settled = flown.where("p in (0.0, 1.0)").select("row", "p")
        done = settled if done is None else done.union(settled)
        if most_parts == 1:
            break
        # two rows of a block are left at most
        most_parts = -(-2 * most_parts // BLOCK_ROWS)
        left = flown.where("p not in (0.0, 1.0)").withColumn("parts", F.ceil(2 * F.col("parts") / BLOCK_ROWS).cast("int"))
    taken = done.select("row", F.col("p").cast("int").alias("extra"))
    rows = rows.join(taken, "row", "left").withColumn("copies", F.col("sure") + F.coalesce("extra", F.lit(0)))
    return rows.select("doc_id", "text_hash", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "row")
