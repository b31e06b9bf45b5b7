"""K-d tree partitioning into shards of near equal bytes.

The set is split again and again at the weighted median of its widest metadata
dimension until every leaf holds at most the target bytes. Medians are exact
and distributed: a histogram of bytes over one key finds the bin that holds the
median, the bin is divided again until it holds one value, then the next key
breaks the tie. All nodes of a level share these jobs, and only histograms,
of BINS rows for each node at most, reach the driver."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folia.llm.common import written

BINS = 1024
#: Columns that hold a row's place in each dimension, and those that break ties.
DIMENSIONS = ("d_id", "d_size", "d_source", "d_lang")
TIES = ("d_id", "row")


def _places(t: DataFrame, c: str) -> DataFrame:
    """(value, place): the distinct values of a column numbered from 0 in code point order, null first; all of a string counts.

    Values are sorted over range partitions and numbered in each; only the partitions' counts are summed up together."""
    names = written(t.select(F.col(c).alias("value")).distinct().orderBy(F.asc_nulls_first("value")).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    counts = names.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    heads = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("head"))
    inner = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return names.withColumn("part", part).join(heads, "part").select("value", (F.col("head") + inner).alias("place"))


@dataclass
class _Cut:
    """Rows of a node with (value of dim, id, row) up to `at` go left."""

    dim: str
    at: tuple[int, int, int]

    def right(self) -> Column:
        a, b, c = self.at
        d = F.col(self.dim)
        beyond = (d == a) & ((F.col("d_id") > b) | ((F.col("d_id") == b) & (F.col("row") > c)))
        return (d > a) | beyond


def _ranges(t: DataFrame, node: Column) -> dict[int, dict]:
    agg = [F.sum("size").alias("bytes"), F.count("*").alias("rows")]
    for d in DIMENSIONS:
        agg += [F.min(d).alias(f"lo_{d}"), F.max(d).alias(f"hi_{d}")]
    return {r["node"]: r.asDict() for r in t.groupBy(node.alias("node")).agg(*agg).collect()}


def _medians(t: DataFrame, node: Column, want: dict[int, tuple[str, float, int, int]]) -> dict[int, tuple[int, int, int]]:
    """For each node the key (dim value, id, row) at which its bytes reach the wanted sum."""
    state = {k: {"keys": [d, *TIES], "fixed": [], "before": 0.0, "goal": goal, "span": (lo, hi)} for k, (d, goal, lo, hi) in want.items()}
    while todo := {k: s for k, s in state.items() if len(s["fixed"]) < 3}:
        # bins of this pass: span of the current key among the rows that share the fixed keys
        inside, key, bin_of = F.lit(False), F.lit(None).cast("long"), F.lit(None).cast("int")
        for k, s in todo.items():
            mine = node == k
            for c, v in zip(s["keys"], s["fixed"]):
                mine = mine & (F.col(c) == v)
            c = F.col(s["keys"][len(s["fixed"])])
            if s["span"]:
                lo, hi = s["span"]
                mine = mine & c.between(lo, hi)
                width = max(1, -(-(hi - lo + 1) // BINS))
                # spans beyond 63 bits are counted in decimals
                apart = c - lo if hi - lo < 1 << 53 else c.cast("decimal(20,0)") - F.lit(str(lo)).cast("decimal(20,0)")
                b = F.floor(apart / width if hi - lo < 1 << 53 else apart / F.lit(str(width)).cast("decimal(20,0)")).cast("int")
            else:
                b = F.lit(0)
            inside, key, bin_of = inside | mine, F.when(mine, c).otherwise(key), F.when(mine, b).otherwise(bin_of)
        rows = (
            t.where(inside).groupBy(node.alias("node"), bin_of.alias("bin"))
            .agg(F.sum("size").alias("bytes"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect()
        )
        by: dict[int, list] = {}
        for r in sorted(rows, key=lambda r: (r["node"], r["bin"])):
            by.setdefault(r["node"], []).append(r)
        for k, s in todo.items():
            acc = s["before"]
            for i, r in enumerate(by[k]):
                if acc + r["bytes"] >= s["goal"] or i == len(by[k]) - 1:
                    break
                acc += r["bytes"]
            s["before"], s["span"] = acc, (r["lo"], r["hi"])
            if r["lo"] == r["hi"]:
                s["fixed"].append(r["lo"])
                s["span"] = None
    return {k: tuple(s["fixed"]) for k, s in state.items()}


def kd_shards(
    docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
    text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", lang_col: str = "lang",
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row of `docs`.

    size: UTF-8 bytes of the text (null: none) plus 1. Give the number of shards or
    the target bytes of a leaf, which gives a power of two. A node for k shards is cut at
    floor(k/2)/k of its bytes, along the dimension (id, size, source, language) whose range is
    the largest part of the range over all rows; the range of source and language is that of their places among all values. slot numbers each shard's rows from 0 without gaps.
    Null ids come first (with the smallest long); ids may span all 64 bits; texts of any length are a row like others; rows that repeat are rows like any other and split apart by their row
    number; no cut separates fewer than two rows, so shards may stay empty on tiny tables. A
    missing source or language column counts as null. Other columns are ignored."""
    spark = docs.sparkSession
    have = set(docs.columns)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    null = F.lit(None).cast("string")
    t = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        (F.col(source_col).cast("string") if source_col in have else null).alias("source"),
        (F.col(lang_col).cast("string") if lang_col in have else null).alias("lang"),
    )
    t = written(t.select("*", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d_id"), F.col("size").alias("d_size"), F.monotonically_increasing_id().alias("row")))
    for c in ("source", "lang"):
        at = _places(t, c)
        t = t.join(at, F.col(c).eqNullSafe(F.col("value"))).withColumnRenamed("place", f"d_{c}").drop("value", c)
    t = written(t)
    whole = _ranges(t, F.lit(0))
    if not whole:
        return spark.createDataFrame([], "doc_id long, size long, text_crc32 long, shard int, slot long")
    if shards is None:
        shards = 1
        while whole[0]["bytes"] / shards > (target_bytes or 1 << 30):
            shards *= 2
    total = {d: max(1, whole[0][f"hi_{d}"] - whole[0][f"lo_{d}"]) for d in DIMENSIONS}
    # a node is named by its first shard; `open` has the number of shards below it
    node, open_nodes = F.lit(0), {0: shards}
    while any(k > 1 for k in open_nodes.values()):
        found = _ranges(t, node)
        want = {}
        for first, k in open_nodes.items():
            r = found.get(first)
            if k > 1 and r and r["rows"] > 1:
                dim = max(DIMENSIONS, key=lambda d: (r[f"hi_{d}"] - r[f"lo_{d}"]) / total[d])
                want[first] = (dim, r["bytes"] * (k // 2) / k, r[f"lo_{dim}"], r[f"hi_{dim}"])
        move = node
        for first, at in _medians(t, node, want).items():
            cut = _Cut(want[first][0], at)
            move = F.when((node == first) & cut.right(), F.lit(first + open_nodes[first] // 2)).otherwise(move)
        nxt = {}
        for first, k in open_nodes.items():
            if k > 1:
                nxt |= {first: k // 2, first + k // 2: k - k // 2}
            else:
                nxt[first] = k
        t = written(t.withColumn("node", move.cast("int")))
        node, open_nodes = F.col("node"), nxt
    return numbered(t.withColumn("shard", node.cast("int"))).select("doc_id", "size", "text_crc32", "shard", "slot")


def numbered(t: DataFrame, group: str = "shard", row: str = "row") -> DataFrame:
    """Adds slot: numbers the rows of each group from 0 without gaps, without bringing a group together.

    Rows fall into parts by the hash of their row number; parts are numbered apart and
    moved by the counts of the parts before them."""
    parts = int(t.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    t = t.withColumn("_part", F.pmod(F.xxhash64(row), F.lit(parts)).cast("int"))
    w = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = t.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    before = counts.select(group, "_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    inner = Window.partitionBy(group, "_part").orderBy(row)
    return t.withColumn("_k", F.row_number().over(inner) - 1).join(before, [group, "_part"]).withColumn("slot", (F.col("_k") + F.col("_before")).cast("long")).drop("_part", "_k", "_before")
