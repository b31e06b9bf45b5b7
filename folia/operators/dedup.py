"""Keeping what is unlike all that was kept before, over a whole table.

The plain rule is a loop: a row stays if no kept row before it is as similar as the limit. Its result is the first independent set, in
the order of the rows, of the graph of similar pairs; it is found by rounds over growing blocks, with no group in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folia.plans.runtime import materialize

#: Sets in the first block; each block is twice as large as the one before.
BLOCK = 256


def characters(c: Column) -> Column:
    return F.filter(F.split(F.coalesce(c, F.lit("")), ""), lambda x: x != "")


def similar_pairs(left: DataFrame, right: DataFrame, limit: float) -> DataFrame:
    """(a, b): ids of sets (id, items) of left and right whose Jaccard similarity is `limit` or more. items are sorted, the rarest first.

    Two such sets share limit * n items at least, n the larger size, so the first n - ceil(limit * n) + 1 items of each have one in common. Pairs meet by these,
    those whose sizes are too far apart are left out, and the others are compared."""
    n = F.size("items")
    keys = F.slice("items", 1, (n - F.ceil(F.lit(limit) * n - 1e-9) + 1).cast("int"))
    a = left.select(F.col("id").alias("a"), F.col("items").alias("ia"), F.explode(keys).alias("key"))
    b = right.select(F.col("id").alias("b"), F.col("items").alias("ib"), F.explode(keys).alias("key"))
    near = F.least(F.size("ia"), F.size("ib")) >= limit * F.greatest(F.size("ia"), F.size("ib")) - 1e-9
    # a pair is compared under the first key that both have
    shared = F.array_intersect("ia", "ib")
    met = a.join(b, "key").where(near & (F.get(shared, F.lit(0)) == F.col("key")))
    same = F.size(shared)
    return met.where(same / (F.size("ia") + F.size("ib") - same) >= limit).select("a", "b")


def first_independent(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id): what a greedy choice in order of id takes: a node that no taken node before it is linked to. pairs (a, b) with a < b.

    Each round takes the nodes without an open node before them and drops their neighbours."""
    open_, links, taken = nodes.select("id"), pairs, None
    while True:
        blocked = links.select(F.col("b").alias("id")).distinct()
        free = materialize(open_.join(blocked, "id", "left_anti"))
        taken = free if taken is None else taken.unionByName(free)
        gone = links.join(free.withColumnRenamed("id", "a"), "a", "left_semi").select(F.col("b").alias("id")).distinct()
        open_ = materialize(open_.join(free, "id", "left_anti").join(gone, "id", "left_anti"))
        if not open_.take(1):
            return taken
        still = open_.select("id")
        links = materialize(links.join(still.withColumnRenamed("id", "a"), "a", "left_semi").join(still.withColumnRenamed("id", "b"), "b", "left_semi"))


def distinct_in_order(df: DataFrame, order: list[str], text: str, limit: float = 0.7, items: Callable[[Column], Column] = characters, block: int = BLOCK) -> DataFrame:
    """Rows that are less similar than `limit` to every row kept before, in the order of columns that no two rows share.

    Similarity is the Jaccard one of the sets of items of a text, its characters by default. Texts without items are like no other and stay. Of rows with equal
    sets the first alone is looked at, so copies cost an aggregate. Blocks of the order are settled one after the other, each twice as large: a block's similar pairs give its own choice, and what that
    takes drops its like from the rest. Where much is alike the rest shrinks fast, where little is, there are few pairs; a table takes some log2(n / block) blocks."""
    place = F.struct(*order)
    rows = df.withColumn("_id", place).withColumn("_items", F.sort_array(F.array_distinct(items(F.col(text)))))
    blank = rows.where(F.size("_items") == 0)
    firsts = rows.where(F.size("_items") > 0).groupBy("_items").agg(F.min("_id").alias("id"))
    firsts = materialize(firsts)
    # items by how many sets hold them, so that what few sets have comes first
    often = firsts.select(F.explode("_items").alias("item")).groupBy("item").agg(F.count("*").alias("n"))
    sets = firsts.select("id", F.explode("_items").alias("item")).join(often, "item").groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "item"))), lambda x: x["item"]).alias("items"))
    rest, kept = materialize(sets), None
    while rest.take(1):
        end = rest.select("id").orderBy("id").limit(block).agg(F.max("id").alias("end"))
        here = materialize(rest.crossJoin(F.broadcast(end)).where(F.col("id") <= F.col("end")).drop("end"))  # one row is broadcast
        pairs = materialize(similar_pairs(here, here, limit).where("a < b"))
        took = materialize(here.join(first_independent(here, pairs), "id"))
        kept = took.select("id") if kept is None else kept.unionByName(took.select("id"))
        later = rest.join(here.select("id"), "id", "left_anti")
        like = similar_pairs(took, later, limit).select(F.col("b").alias("id")).distinct()
        rest = materialize(later.join(like, "id", "left_anti"))
        block *= 2
    if kept is None:
        return blank.drop("_id", "_items")
    return blank.unionByName(rows.where(F.size("_items") > 0).join(kept.withColumnRenamed("id", "_id"), "_id", "left_semi").select(blank.columns)).drop("_id", "_items")
