"""Near duplicates by the Jaccard similarity of word shingles: SimHash first, then what it cannot see, without a lost pair.

1. The fingerprints of the sets are linked by anchor-point covering (folia.llm.simhash). Its links are confirmed by their exact
   similarity; they join most near copies, and in large groups by a few links each.
2. A pair of similarity 4/5 may differ in more bits than a selective covering allows, so the rest is found by prefix filtering: two such sets share
   at least 4/5 of the larger one, so in any fixed order of all shingles they share one among the first n - ceil(4n/5) + 1
   of each: its keys. The order is by hash, with shingles that stand in many sets last, so that boilerplate seldom is
   a key. Sets meet by key. Of the pairs that meet those go that step 1 has joined, and those whose bitmaps (the parity of the shingles that fall
   on a bit) differ in more bits than sets of that similarity have shingles apart; the others are confirmed exactly. Where many sets
   meet in a key, they are compared there in parts of bounded size, and a part gives a spanning forest of its links, not its pairs.
   Before sets travel, what is left is held against bitmaps that are as long as the sets are large: short ones tell long sets nothing.

Sets are not stored: they are made from the texts where they are needed, and kept only for those that are compared."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.llm.common import bit_map, buckets, components, gather, lean, lean_group, marked, pack, raw, slices, written
from folia.llm.simhash import fold, link_fingerprints, shingle_hashes
from folia.session import ship

#: Similarity from which texts are near duplicates, as a fraction.
LEAST = (4, 5)
SEED = 42
#: Sets that meet in one key: more are compared together.
SMALL = 32
#: Sets of one key that are compared in one task, and their shingles: keys of more are cut in parts, then parts are compared with each other.
CHUNK, SHINGLES = 512, 4 << 20
#: Shingles in a bucket of pairs to be confirmed.
BUCKET = 8 << 20
#: Sets of more rows than this part of all are few, so they may be broadcast.
HOT = 256
#: Bits of a set's bitmap, and of the least fine one.
BITS = 1024
#: Pairs for each set that a part of a crowded key may give; where more are open, its sets are compared together.
SPARSE = 4
#: Shingles that go to the end of the order at most; it bounds what the driver gathers and changes cost, not results.
COMMON = 1 << 17


def describe(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, row, node, fp, n, bits) of (doc_id, row, text): node names the set of n shingles, fp is its text's fingerprint; texts without words have node 0.

    Rows without bits give in node a shingle that several different sets of a slice hold, in n how many do."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 2 << 20):
            hashes = [shingle_hashes(t, width) for t in raw(b, "text")]
            sets = [np.unique(h) for h in hashes]
            node = _names(sets)
            bits = [np.packbits((np.bincount((s & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1).astype(np.uint8)).tobytes() for s in sets]
            size = np.fromiter(map(len, sets), np.int64, len(sets))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row"), pa.array(node.view(np.int64)), pa.array(fold(hashes).view(np.int64)), pa.array(size), pa.array(bits, pa.binary())], names=names)
            shingle, times = np.unique(np.concatenate([sets[k] for k in np.unique(node, return_index=True)[1]]), return_counts=True)
            shingle, times = shingle[times > 1].view(np.int64), times[times > 1].astype(np.int64)
            none = pa.nulls(len(shingle), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.array(shingle), none, pa.array(times), pa.nulls(len(shingle), pa.binary())], names=names)

    names = ["doc_id", "row", "node", "fp", "n", "bits"]
    return docs.mapInArrow(run, "doc_id long, row long, node long, fp long, n long, bits binary")


def _names(sets: list[np.ndarray]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) if len(s) else 0 for s in sets], np.uint64)


def keys(size: np.ndarray, flat: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(set, shingle) of the keys of each set; `flat` has the sets one after the other, each sorted; `common` is sorted."""
    if not len(flat):
        return np.zeros(0, np.int64), flat
    who = np.repeat(np.arange(len(size)), size)
    if len(common):
        at = np.minimum(np.searchsorted(common, flat), len(common) - 1)
        order = np.lexsort((common[at] == flat, who))
        flat = flat[order]
    n_keys = size - -(-LEAST[0] * size // LEAST[1]) + 1
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    first = place < np.repeat(n_keys, size)
    return who[first], flat[first]


def _similar(shared, a, b):
    """Whether sets of a and b shingles, `shared` in both, reach LEAST."""
    return LEAST[1] * shared >= LEAST[0] * (a + b - shared)


def _meetings(key: np.ndarray, node: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of nodes that meet in a key of at most SMALL sets; (key, node) of the other keys."""
    order = np.lexsort((node, key))
    key, node, size = key[order], node[order], size[order].astype(np.int64)
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    n = np.diff(np.concatenate((start, [len(key)])))
    few, group = np.repeat(n <= SMALL, n), np.repeat(np.arange(len(start)), n)
    found = [np.zeros((0, 2), np.uint64)]
    for d in range(1, SMALL):
        ok = np.flatnonzero(few[:-d] & (group[:-d] == group[d:]))
        if not len(ok):
            break
        a, b = size[ok], size[ok + d]
        ok = ok[_similar(np.minimum(a, b), a, b)]
        found.append(np.stack((node[ok], node[ok + d]), axis=1))
    return np.unique(np.concatenate(found), axis=0), np.stack((key[~few], node[~few]), axis=1)


def fine_map(s: np.ndarray) -> bytes:
    """Bitmap of a set with a bit for each of its shingles at least, their number a power of two, so that halves of a longer one fold onto a shorter one."""
    bits = max(BITS, 1 << (len(s) - 1).bit_length())
    return np.packbits((np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(x: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) at a smaller length."""
    while x.shape[-1] > words:
        half = x.shape[-1] // 2
        x = x[..., :half] ^ x[..., half:]
    return x


def _may_reach(apart, n):
    """Whether sets of n shingles in all whose bitmaps differ in `apart` bits may reach LEAST."""
    return (LEAST[0] + LEAST[1]) * apart <= (LEAST[1] - LEAST[0]) * n


def open_pairs(maps: list[bytes], size: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Places (rows a, b) of the sets of different roots that may reach LEAST by their sizes and fine bitmaps."""
    words, found = np.array([len(m) // 8 for m in maps], np.int64), [np.zeros((0, 2), np.int64)]
    for w in np.unique(words):  # the shorter bitmap of a pair has w words; sets that are alike have at most twice as long ones
        at = np.concatenate((np.flatnonzero(words == w), np.flatnonzero(words == 2 * w)))
        x = np.stack([folded(np.frombuffer(maps[k], np.uint64), w) for k in at])
        for i in range(int((words == w).sum())):
            a, others = at[i], at[i + 1 :]
            ok = np.flatnonzero((root[others] != root[a]) & _similar(np.minimum(size[others], size[a]), size[others], size[a]))
            if len(ok):
                ok = ok[_may_reach(np.bitwise_count(x[i + 1 + ok] ^ x[i]).sum(axis=1, dtype=np.int64), size[others[ok]] + size[a])]
                found.append(np.stack((np.full(len(ok), a), others[ok]), axis=1))
    return np.concatenate(found)


def forest(node: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Spanning links of the sets that reach LEAST: reached ones leave those that are compared."""
    size = np.array([len(s) for s in sets], np.int64)
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.split(flat, np.cumsum(size)[:-1])
    mark = np.zeros(int(flat.max()) + 1, bool)
    left, links = np.arange(len(sets)), []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        flat = np.concatenate([own[k] for k in left])
        while queue and len(left):
            x = queue.pop()
            mark[own[x]] = True
            shared = np.add.reduceat(mark[flat].astype(np.int64), np.cumsum(size[left]) - size[left])
            mark[own[x]] = False
            near = _similar(shared, size[x], size[left])
            if near.any():
                hit = left[near]
                links += [(int(node[x]), int(node[y])) for y in hit]
                queue += list(hit)
                flat, left = flat[np.repeat(~near, size[left])], left[~near]
    return links


def stored(docs: DataFrame, rows: DataFrame, width: int, form=np.ndarray.tobytes) -> DataFrame:
    """(node, shingles) of the texts of `rows` (node, row), as `form` gives the bytes of a set. A bit map of the rows keeps other texts out of the join."""
    rows = written(rows)
    few = bit_map(rows.select(F.xxhash64("row").alias("h")))

    @lean
    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.select(["row", "text"]).filter(pa.array(marked(few.value, b.column("h").to_numpy().view(np.uint64))))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 2 << 20):
            sets = [form(np.unique(shingle_hashes(t, width))) for t in raw(b, "text")]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"])

    some = docs.select("row", "text", F.xxhash64("row").alias("h")).mapInArrow(sift, "row long, text string")
    return written(some.join(rows, "row").select("node", "text").mapInArrow(run, "node long, shingles binary"))


def confirmed(pairs: DataFrame, sets: DataFrame, sizes: DataFrame) -> DataFrame:
    """The pairs (a, b) of LEAST or more; the set of a goes to its bucket once, that of b once for each pair.

    sizes (node, n): shingles of each set; the buckets follow what the pairs bring together."""

    held = pairs.join(sizes.toDF("b", "n"), "b").agg(F.sum("n")).first()[0] or 0
    parts = max(buckets(pairs.sparkSession, 8), -(-held // BUCKET))
    bucket = F.pmod(F.xxhash64("a"), F.lit(parts)).cast("int").alias("bucket")

    @lean_group
    def check(own: pa.Table, others: pa.Table) -> pa.Table:
        at = {k: np.frombuffer(x, np.uint64) for k, x in zip(own.column("a").to_pylist(), own.column("own").to_pylist())}
        good = np.zeros(others.num_rows, bool)
        for k, (a, y) in enumerate(zip(others.column("a").to_pylist(), (v.as_py() for c in others.column("other").chunks for v in c))):
            x, y = at[a], np.frombuffer(y, np.uint64)
            good[k] = _similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))
        return others.select(["a", "b"]).filter(pa.array(good))

    asked = pairs.select("a").distinct().withColumnRenamed("a", "node")
    left = sets.join(asked, "node", "left_semi").select(F.col("node").alias("a"), F.col("shingles").alias("own"))
    right = pairs.join(sets.join(pairs.select(F.col("b").alias("node")).distinct(), "node", "left_semi").withColumnRenamed("node", "b"), "b").select(F.col("a").alias("a"), F.col("b").alias("b"), F.col("shingles").alias("other"))
    return left.select("a", "own", bucket).groupBy("bucket").cogroup(right.select("a", "b", "other", bucket).groupBy("bucket")).applyInArrow(check, "a long, b long")


def confirmed_in_turns(pairs: DataFrame, sets: DataFrame, sizes: DataFrame) -> DataFrame:
    """Links of LEAST or more among the pairs (a, b) that join all that the pairs of LEAST or more join.

    One pair for each b goes first; of the others only those whose ends these have not joined are looked at, so that a group of near copies sends each set once, not once for each pair."""
    pairs = pairs.distinct()
    star = written(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    first = written(confirmed(star, sets, sizes))
    root = components(first)
    rest = pairs.join(star, ["a", "b"], "left_anti").join(root.toDF("a", "ra"), "a", "left").join(root.toDF("b", "rb"), "b", "left")
    rest = written(rest.where("coalesce(ra, a) <> coalesce(rb, b)").select("a", "b"))
    return first.union(confirmed(rest, sets, sizes)) if rest.take(1) else first


def meetings(docs: DataFrame, width: int, common: np.ndarray) -> DataFrame:
    """(a, b, many): nodes a and b meet in a key of few; where many, a is such a key and b one of its nodes."""
    n = buckets(docs.sparkSession)

    @lean
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 2 << 20):
            sets = [np.unique(shingle_hashes(t, width)) for t in raw(b, "text")]
            node, first = np.unique(_names(sets), return_index=True)
            sets = [sets[k] for k in first]
            size = np.array([len(x) for x in sets], np.int64)
            who, key = keys(size, np.concatenate(sets), common)
            mixed = key * np.uint64(0x9E3779B97F4A7C15)
            bucket = ((mixed >> np.uint64(33)) % np.uint64(n)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            # 32 bits of a key tell it apart within its bucket; where they do not, a pair more is compared
            bucket, key, who = bucket[order], (mixed[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32), who[order]
            edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
            rows = [(int(bucket[lo]), pack(k=key[lo:hi], n=node[who[lo:hi]], s=size[who[lo:hi]].astype(np.uint32))) for lo, hi in zip(edges, edges[1:]) if hi > lo]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "blob"])

    @lean_group
    def meet(t: pa.Table) -> pa.Table:
        key, node, size = gather(t.column("blob").to_pylist(), ("u4", "u8", "u4"))
        order = np.lexsort((node, key))
        key, node, size = key[order], node[order], size[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        at = np.uint64(t.column("bucket")[0].as_py()) << np.uint64(32)
        pairs, many = _meetings(key[fresh].astype(np.uint64) | at, node[fresh], size[fresh])
        both = np.concatenate((pairs, many)).view(np.int64)
        return pa.table({"a": np.ascontiguousarray(both[:, 0]), "b": np.ascontiguousarray(both[:, 1]), "many": np.arange(len(both)) >= len(pairs)})

    return written(docs.select("text").mapInArrow(spread, "bucket int, blob binary").groupBy("bucket").applyInArrow(meet, "a long, b long, many boolean"))


def unsettled(crowd: DataFrame, roots: DataFrame, by: list[str]) -> DataFrame:
    """The rows of crowd (by…, node) whose group has nodes of several roots; a node that roots (node, root) lacks is its own."""
    rooted = crowd.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rooted.groupBy(*by).agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select(*by)
    return crowd.join(mixed, by, "left_semi")


def parted(crowd: DataFrame, sizes: DataFrame) -> DataFrame:
    """crowd (key, node) with the parts of its key and the part of each node, of about CHUNK nodes or SHINGLES shingles each; sizes (node, n)."""
    parts = F.greatest(F.ceil(F.count("*") / CHUNK), F.ceil(F.sum("n") / SHINGLES)).cast("int").alias("parts")
    keys_of = crowd.join(sizes.select("node", "n"), "node").groupBy("key").agg(parts)
    return crowd.join(keys_of, "key").withColumn("part", F.pmod(F.xxhash64("node", F.lit(SEED)), "parts").cast("int"))


def together(crowd: DataFrame, sets: DataFrame, by: list[str]) -> DataFrame:
    """Links that span what reaches LEAST within each group of crowd (by…, node)."""

    def run(t: pa.Table) -> pa.Table:
        got = forest(t.column("node").to_numpy(), [np.frombuffer(x, np.uint64) for x in t.column("shingles").to_pylist()])
        return pa.table({"a": pa.array([g[0] for g in got], pa.int64()), "b": pa.array([g[1] for g in got], pa.int64())})

    sets = sets.join(crowd.select("node").distinct(), "node", "left_semi")
    return crowd.join(sets, "node").select(*by, "node", "shingles").groupBy(*by).applyInArrow(run, "a long, b long")


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """roots (node, root) after further links (a, b): only the links between components are contracted."""
    ends = links.join(roots.toDF("a", "ra"), "a", "left").join(roots.toDF("b", "rb"), "b", "left")
    top = components(ends.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))).toDF("root", "top")
    known = roots.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    fresh = top.join(roots.select(F.col("node").alias("root")), "root", "left_anti").select(F.col("root").alias("node"), F.col("top").alias("root"))
    return written(known.union(fresh))


def sifted(pairs: DataFrame, fine: DataFrame) -> DataFrame:
    """The pairs (a, b) that may reach LEAST by their fine bitmaps; fine (node, bits, n, root)."""

    @lean
    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok, n = np.zeros(b.num_rows, bool), b.column("n").to_numpy(zero_copy_only=False)
            for k in range(b.num_rows):
                x, y = (np.frombuffer(b.column(c)[k].as_py(), np.uint64) for c in ("xa", "xb"))
                words = min(len(x), len(y))
                ok[k] = _may_reach(int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum(dtype=np.int64)), n[k])
            yield b.select(["a", "b"]).filter(pa.array(ok))

    side = lambda k: fine.select(F.col("node").alias(k), F.col("bits").alias(f"x{k}"), F.col("n").alias(f"n{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", "xa", "xb", (F.col("na") + F.col("nb")).alias("n")).mapInArrow(differ, "a long, b long")


def opened(crowd: DataFrame, fine: DataFrame, by: list[str]) -> DataFrame:
    """(key, a, b) of crowd (key, by…, node): pairs of different roots of a group that may reach LEAST by their fine bitmaps, or, where these
    are over SPARSE for each of their nodes, the nodes alone (b null)."""

    @lean_group
    def run(t: pa.Table) -> pa.Table:
        node, size, root = (t.column(c).to_numpy() for c in ("node", "n", "root"))
        got = open_pairs(t.column("bits").to_pylist(), size, root)
        held = np.unique(got)
        many = len(got) > SPARSE * len(held)
        a = node[held] if many else np.minimum(node[got[:, 0]], node[got[:, 1]])
        b = pa.nulls(len(a), pa.int64()) if many else pa.array(np.maximum(node[got[:, 0]], node[got[:, 1]]))
        return pa.table({"key": pa.array(np.full(len(a), t.column("key")[0].as_py(), np.int64)), "a": pa.array(a), "b": b})

    return crowd.select(*by, "node").join(fine, "node").groupBy(*by).applyInArrow(run, "key long, a long, b long")


def part_pairs(crowd: DataFrame) -> DataFrame:
    """(key, lo_part, hi_part, node): every two parts of a key of crowd (key, node, parts, part)."""
    two = crowd.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("part <> other")
    return two.select("key", F.least("part", "other").alias("lo_part"), F.greatest("part", "other").alias("hi_part"), "node")


def across(crowd: DataFrame, sets: DataFrame, roots: DataFrame, sizes: DataFrame) -> DataFrame:
    """roots after the links between the parts of crowded keys (key, node), so that no task holds a whole key.

    First one node of each component that a key has is compared, which settles groups of near copies; then, in keys that still hold several
    components, every two parts that do."""
    left = written(unsettled(crowd, roots, ["key"]))
    if not left.take(1):
        return roots
    rooted = left.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = written(parted(rooted.groupBy("key", "root").agg(F.min("node").alias("node")).select("key", "node"), sizes))
    roots = merged(roots, together(heads, sets, ["key", "part"]))
    left = written(parted(unsettled(left, roots, ["key"]), sizes))
    if not left.take(1):
        return roots
    by = ["key", "lo_part", "hi_part"]
    return merged(roots, together(written(unsettled(part_pairs(left), roots, by)), sets, by))


def near_duplicates(docs: DataFrame, row_col: str, width: int = 5, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, row, root): root names the component of links of LEAST or more.

    Texts of one set of shingles are one node, so groups of copies cost one row. Null texts and texts without words are one component.
    row_col numbers the rows; ids may repeat or be null. Texts are taken whole. An empty table gives an empty one; other columns are ignored."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(row_col).cast("long").alias("row"), F.col(text_col).cast("string").alias("text"))
    info = written(describe(docs, width))
    prints = info.where("bits is not null").select("doc_id", "row", "node")
    nodes = written(info.where("bits is not null and node <> 0").groupBy("node").agg(F.count("*").alias("rows"), F.min("row").alias("row"), F.min("fp").alias("fp"), F.min("n").alias("n"), F.min("bits").alias("bits")))
    # step 1: the fingerprints; of those that share one, each is held against the first
    first = nodes.groupBy("fp").agg(F.min("node").alias("node"))
    linked = link_fingerprints(first).join(first.toDF("a", "na"), "a").join(first.toDF("b", "nb"), "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
    same = nodes.join(first.withColumnRenamed("node", "b"), "fp").where("node <> b").select(F.col("node").alias("a"), "b")
    near = written(linked.union(same).distinct())
    ends = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
    sure = written(confirmed(near, stored(docs, nodes.join(ends, "node").select("node", "row"), width), nodes.select("node", "n")))
    joined = components(sure).toDF("node", "root")
    # step 2: the keys
    often = info.where("bits is null").groupBy("node").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "node").limit(COMMON).select("node").collect()
    met = meetings(docs, width, np.unique(np.array([r["node"] for r in often], np.int64).view(np.uint64)))
    maps = nodes.join(joined, "node", "left").select("node", "bits", "n", F.coalesce("root", "node").alias("root"))

    @lean
    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint64).reshape(b.num_rows, -1) for c in ("xa", "xb"))
            n = b.column("na").to_numpy(zero_copy_only=False) + b.column("nb").to_numpy(zero_copy_only=False)
            apart = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
            ok = _may_reach(apart, n)
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    pairs = met.where("not many").select("a", "b").distinct().join(maps.toDF("a", "xa", "na", "ra"), "a").join(maps.toDF("b", "xb", "nb", "rb"), "b").where("ra <> rb")
    pairs = written(pairs.select("a", "b", "xa", "na", "xb", "nb").mapInArrow(differ, "a long, b long"))
    # a key whose nodes step 1 has all joined has nothing left to find
    crowd = unsettled(met.where("many").select(F.col("a").alias("key"), F.col("b").alias("node")), maps.select("node", "root"), ["key"])
    crowd = written(parted(crowd, nodes))
    # fine bitmaps of what is open; sets are made of what these leave
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(crowd.select("node")).distinct()
    fine = stored(docs, nodes.join(needed, "node").select("node", "row"), width, fine_map).withColumnRenamed("shingles", "bits")
    fine = written(fine.join(maps.select("node", "n", "root"), "node"))
    seen = written(opened(crowd, fine, ["key", "part"]).union(opened(part_pairs(crowd.where("parts > 1")), fine, ["key", "lo_part", "hi_part"])))
    pairs = written(sifted(pairs, fine).union(seen.where("b is not null").select("a", "b")).distinct())
    crowd = written(seen.where("b is null").select("key", F.col("a").alias("node")).distinct())
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(crowd.select("node")).distinct()
    some = stored(docs, nodes.join(needed, "node").select("node", "row"), width)
    roots = merged(joined, confirmed_in_turns(pairs, some, nodes.select("node", "n")))
    crowd = written(parted(unsettled(crowd, roots, ["key"]), nodes))
    if crowd.take(1):
        roots = merged(roots, together(crowd, some, ["key", "part"]))
    if crowd.where("parts > 1").take(1):
        roots = across(crowd.where("parts > 1").select("key", "node"), some, roots, nodes)
    # rows whose text no link touches keep their node; sets of very many rows are few, so their rows stay where they are
    label = written(nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "rows"))
    hot = F.broadcast(label.where(F.col("rows") > (label.agg(F.sum("rows")).first()[0] or 0) / HOT).drop("rows"))
    blank = prints.where("node = 0").withColumn("root", F.col("node"))
    said = prints.where("node <> 0")
    rest = said.join(hot.select("node"), "node", "left_anti").join(label.drop("rows"), "node")
    return blank.unionByName(said.join(hot, "node")).unionByName(rest).select("doc_id", "row", "root")
