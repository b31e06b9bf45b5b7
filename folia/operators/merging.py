"""Ordered merges of entities, with merges that meet a third entity, as links between events instead of a replay."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folia.operators.graph import smallest_reachable
from folia.operators.summaries import joined_texts
from folia.plans.runtime import materialize

# Fixed value: what stands between the descriptions of merged entities.
SEPARATOR = "<SEP>"


def last_before(rows: DataFrame, key: str, order: str, value: str, block: int = 4096) -> DataFrame:
    """Adds previous: value of the row before in the order of its key (null for the first).

    Rows of a key go by blocks of the order, and blocks hand on their last row, so that a key with a third of all rows is not one task's."""
    t = rows.withColumn("_b", F.floor(F.col(order) / block).cast("long"))
    last = t.groupBy(key, "_b").agg(F.max_by(value, order).alias("_last"))
    last = last.select(key, "_b", F.lag("_last").over(Window.partitionBy(key).orderBy("_b")).alias("_carried"))
    inside = t.withColumn("_lag", F.lag(F.struct(F.col(value).alias("v"))).over(Window.partitionBy(key, "_b").orderBy(order)))
    return inside.join(last, [key, "_b"]).withColumn("previous", F.when(F.col("_lag").isNotNull(), F.col("_lag.v")).otherwise(F.col("_carried"))).drop("_b", "_lag", "_carried")


def merge_links(entities: DataFrame, merges: DataFrame) -> DataFrame:
    """(a, b): links between what each merge makes and what it takes. Nodes are entity ids, and -1 - seq for the result of a merge.

    entities (id >= 0, name), names distinct; merges (seq, old, new, name), seq distinct. A merge takes what its old and new name stand for at that time and makes an entity of the given name. Where
    an entity bears that name already, a third one, it is taken too; it does if the last merge that had the name made it, or if none had. A name whose entity was merged under another name is free and starts anew.

    What a name stands for is the result of the last merge that had it as old, new or result, and what that has become; before the first one it is the entity of the name. So links need the row before in the
    order of each name, no replay."""
    touch = F.explode(F.array(*[F.struct(F.lit(k).alias("role"), F.col(c).alias("touched")) for k, c in enumerate(("old", "new", "name"))]))
    touched = merges.select("seq", "name", touch.alias("t")).select("seq", F.col("name").alias("made"), "t.*")
    # one row for a name in a merge, whatever its roles
    events = touched.groupBy("touched", "seq").agg(F.first("made").alias("made"), F.min("role").alias("role"))
    events = events.withColumn("result", F.struct("seq", "made"))
    before = last_before(events, "touched", "seq", "result")
    names = entities.select(F.col("id"), F.col("name").alias("touched"))
    found = before.join(names, "touched", "left")
    # a name given to the result only counts where an entity bears it
    bears = (F.col("role") < 2) | (F.col("previous.made") == F.col("touched"))
    past = F.when(F.col("previous").isNotNull() & bears, -1 - F.col("previous.seq")).when(F.col("previous").isNull(), F.col("id"))
    return found.select((-1 - F.col("seq")).alias("a"), past.alias("b")).where("b is not null")


def merged_entities(entities: DataFrame, merges: DataFrame) -> DataFrame:
    """(id, canonical, name): of each entity the smallest id it is merged with and the name in the end, as a replay of the merges in the order of seq gives them.

    Names in merges that no entity bears and no merge has made take nothing; a merge of unknown names alone makes an entity without rows. An entity that no merge takes keeps its id and name."""
    links = merge_links(entities, merges)
    # roots: the smallest node, so the last merge of a component, as results have falling negative ids
    root = smallest_reachable(links.select("a", "b"))
    last = root.join(merges.select((-1 - F.col("seq")).alias("root"), F.col("name").alias("final")), "root").select("node", "root", "final")
    t = entities.join(last, F.col("id") == F.col("node"), "left").drop("node")
    t = materialize(t.select("id", F.coalesce("root", "id").alias("root"), F.coalesce("final", "name").alias("name")))
    first = t.groupBy("root").agg(F.min("id").alias("canonical"))
    return t.join(first, "root").select("id", "canonical", "name")


def merged_descriptions(entities: DataFrame, merged: DataFrame, most_words: int = 1000, most_chars: int = 10000) -> DataFrame:
    """(canonical, name, n, description): descriptions of merged entities in order of id with <SEP> between, cut to words and characters; n of them are not blank.

    entities (id, description). Of a group only the descriptions that fit meet in one row; entities without descriptions have an empty one and n 0."""
    t = merged.join(entities.select("id", F.col("description").alias("_d")), "id")
    text = joined_texts(t, ["canonical"], ["id"], "_d", most_words, SEPARATOR)
    cut = F.array_join(F.slice(F.split("text", " "), 1, most_words), " ")
    names = merged.groupBy("canonical").agg(F.first("name").alias("name"))
    return names.join(text, "canonical", "left").select("canonical", "name", F.coalesce("n", F.lit(0)).alias("n"), F.substring(F.coalesce(cut, F.lit("")), 1, most_chars).alias("description"))


def distinct_parts(description: Column) -> Column:
    """The different parts of a joined description, in order, with semicolons between: the default where a model would rewrite it."""
    parts = F.filter(F.transform(F.split(description, SEPARATOR), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_join(F.array_distinct(parts), "; ")


def refined_descriptions(entities: DataFrame, rewrite: Callable[[Column], Column] = distinct_parts) -> DataFrame:
    """Entities with those descriptions rewritten that come from several sources, that is, hold the separator; the others stay as they are, nulls included."""
    joined = F.contains(F.col("description"), F.lit(SEPARATOR))
    return entities.withColumn("description", F.when(joined, rewrite(F.col("description"))).otherwise(F.col("description")))


def renamed_ends(edges: DataFrame, merged: DataFrame) -> DataFrame:
    """Edges (a, b, weight) between canonical entities: parallel ones add up, loops and edges to unknown entities go."""
    one = merged.select(F.col("id"), F.col("canonical"))
    t = edges.join(one.toDF("a", "ca"), "a").join(one.toDF("b", "cb"), "b").where("ca <> cb")
    return t.groupBy(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).agg(F.sum("weight").alias("weight"))
