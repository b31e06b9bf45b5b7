"""SimHash near-duplicates by anchor-point covering.

The 64 bits are cut into three blocks, so that a pair within 4 bits differs by at
most one bit in some block. In each block the codewords of a covering code, the
Hamming code of 15 bits beside free bits, are the anchors: its covering radius is
1, and every fingerprint goes to all anchors within radius + block threshold = 2.
A linked pair then meets at the anchor nearest to either of the two. Fingerprints
are compared per anchor, over all 64 bits, and an anchor gives a spanning forest of
its links, not its pairs."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.llm.common import buckets, components, gather, lean, lean_group, pack, raw, slices, written
from folia.session import ship

#: (first bit, bits) of the blocks.
BLOCKS = ((0, 21), (21, 21), (42, 22))
CODE_BITS = 15
#: A fingerprint with more than this part of all rows is joined by itself.
HOT = 256
SEED = 42


def shingle_hashes(text: bytes | None, width: int) -> np.ndarray:
    """XXH64 of each shingle of `width` words, repeats included; fewer words are one shingle, no words none."""
    w = (text or b"").lower().split()
    n = len(w)
    flat = b" ".join(w)
    if n <= width:
        return np.array([xxhash.xxh64_intdigest(flat, SEED)] if n else [], np.uint64)
    size = np.fromiter(map(len, w), np.int64, n)
    end = np.cumsum(size + 1) - 1
    pieces = [flat[a:z] for a, z in zip((end - size)[: n - width + 1].tolist(), end[width - 1 :].tolist())]
    return np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, len(pieces))


def fold(hashes: list[np.ndarray]) -> np.ndarray:
    """The fingerprint of each array of hashes: a bit is 1 where over half of them have it."""
    n = np.fromiter(map(len, hashes), np.int64, len(hashes))
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    all_h = np.concatenate(hashes)
    per = -(-n[full] // 255)
    # counters of 8 bits in the bytes of 64-bit words: at most 255 hashes are added up before they are widened
    seg_doc = np.repeat(np.arange(len(full)), per)
    within = np.arange(len(seg_doc)) - np.repeat(np.cumsum(per) - per, per)
    first = np.cumsum(n[full]) - n[full]
    seg_start = first[seg_doc] + 255 * within
    doc_start = np.cumsum(per) - per
    lanes = np.uint64(0x0101010101010101)
    ones = np.zeros((len(full), 64), np.int64)
    for k in range(8):
        part = np.add.reduceat((all_h >> np.uint64(k)) & lanes, seg_start)
        ones[:, k::8] = np.add.reduceat(part.view(np.uint8).reshape(-1, 8).astype(np.int64), doc_start, axis=0)
    bits = (2 * ones > n[full][:, None]).astype(np.uint8)
    out[full] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).reshape(-1)
    return out


def fingerprints(docs: DataFrame, width: int = 4, text_col: str = "text", id_col: str = "doc_id", row_col: str | None = None) -> DataFrame:
    """(doc_id, fp long [, row long]): a bit is 1 where over half the shingle hashes have it.

    No words: zero. Fewer words than `width`: the whole sequence is the one shingle."""
    ship(docs.sparkSession)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 2 << 20):
            fp = pa.array(fold([shingle_hashes(t, width) for t in raw(b, "text")]).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), fp, *(b.column(c) for c in rows)], names=["doc_id", "fp", *rows])

    rows = ["row"] if row_col else []
    frame = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *[F.col(row_col).cast("long").alias("row") for _ in rows])
    return frame.mapInArrow(run, "doc_id long, fp long" + ", row long" * len(rows))


def _patterns(bits: int, radius: int) -> list[np.ndarray]:
    """For each syndrome the bit patterns of at most `radius` bits that lead to a codeword."""
    free = bits - CODE_BITS
    by: list[list[int]] = [[] for _ in range(CODE_BITS + 1)]
    for a in range(radius + 1):
        for code in combinations(range(CODE_BITS), a):
            syndrome = 0
            for i in code:
                syndrome ^= i + 1
            for b in range(radius - a + 1):
                for rest in combinations(range(free), b):
                    by[syndrome].append(sum(1 << i for i in code) | sum(1 << (CODE_BITS + i) for i in rest))
    return [np.array(x, np.uint64) for x in by]


def _syndrome(block: np.ndarray) -> np.ndarray:
    out = np.zeros(len(block), np.uint64)
    for i in range(CODE_BITS):
        out ^= ((block >> np.uint64(i)) & np.uint64(1)) * np.uint64(i + 1)
    return out


def anchors(fp: np.ndarray, radius: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(index into fp, anchor): every anchor within `radius` of each fingerprint's blocks; the block is part of the anchor."""
    who, what = [], []
    for k, (low, bits) in enumerate(BLOCKS):
        block = (fp >> np.uint64(low)) & np.uint64((1 << bits) - 1)
        syndrome = _syndrome(block)
        for s, patterns in enumerate(_patterns(bits, radius)):
            rows = np.flatnonzero(syndrome == s)
            if len(rows):
                who.append(np.repeat(rows, len(patterns)))
                what.append((block[rows][:, None] ^ patterns[None, :]).reshape(-1) | np.uint64(k << 32))
    if not who:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(who), np.concatenate(what)


def _forest(fp: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Spanning links of fingerprints within `limit` bits: reached ones leave the set that is compared."""
    left = fp
    links: list[tuple[int, int]] = []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= limit
            if near.any():
                hit = left[near]
                links += [(int(x), int(y)) for y in hit]
                queue += list(hit)
                left = left[~near]
    return links


def _links(anchor: np.ndarray, fp: np.ndarray, limit: int, small: int = 24) -> np.ndarray:
    """Linked fingerprints (rows a, b) over groups of equal anchors."""
    order = np.argsort(anchor, kind="stable")
    anchor, fp = anchor[order], fp[order]
    start = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    size = np.diff(np.concatenate((start, [len(anchor)])))
    found = []
    # small groups side by side: element i against the one d places on, d below `small`
    within = np.repeat(size <= small, size)
    group = np.repeat(np.arange(len(start)), size)
    for d in range(1, small):
        if len(anchor) <= d:
            break
        ok = np.flatnonzero(within[:-d] & (group[:-d] == group[d:]))
        if not len(ok):
            break
        hit = ok[np.bitwise_count(fp[ok] ^ fp[ok + d]) <= limit]
        if len(hit):
            found.append(np.stack((fp[hit], fp[hit + d]), axis=1))
    for g in np.flatnonzero(size > small):
        links = _forest(fp[start[g] : start[g] + size[g]], limit)
        if links:
            found.append(np.array(links, np.uint64))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.uint64)


def link_fingerprints(distinct: DataFrame, limit: int = 4) -> DataFrame:
    """(a, b): links between the distinct fingerprints in column fp, enough of them to span every component."""
    if limit // len(BLOCKS) != 1:
        raise ValueError("the blocks hold for a limit of 3 to 5 bits")
    spark = distinct.sparkSession
    n = buckets(spark)

    @lean
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1 << 16):
                fp = b.column("fp").slice(at, 1 << 16).to_numpy(zero_copy_only=False).view(np.uint64)
                who, what = anchors(fp)
                bucket = (((what * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(n)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                bucket, what, mine = bucket[order], what[order], fp[who[order]]
                cut = np.flatnonzero(np.diff(bucket)) + 1
                edges = [0, *cut.tolist(), len(bucket)]
                rows = [(int(bucket[lo]), pack(a=what[lo:hi], f=mine[lo:hi])) for lo, hi in zip(edges, edges[1:]) if hi > lo]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "blob"])

    @lean_group
    def compare(t: pa.Table) -> pa.Table:
        anchor, fp = gather(t.column("blob").to_pylist(), ("u8", "u8"))
        got = _links(anchor, fp, limit).view(np.int64)
        return pa.table({"a": np.ascontiguousarray(got[:, 0]), "b": np.ascontiguousarray(got[:, 1])})

    return distinct.select("fp").mapInArrow(spread, "bucket int, blob binary").groupBy("bucket").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, limit: int = 4, width: int = 4, text_col: str = "text", id_col: str = "doc_id", row_col: str | None = None) -> DataFrame:
    """(doc_id, fp, component_id, root [, row]): component_id is the smallest doc_id that can be reached, root a fingerprint that names the component.

    Equal fingerprints are one node, so groups of copies cost one row. Rows that
    repeat a doc_id give a row each, in the component of their own text; a null doc_id belongs to a component
    but never names one unless all its ids are null. Texts without words share fingerprint zero and are
    linked like any other. Other columns are ignored."""
    prints = written(fingerprints(docs, width, text_col, id_col, row_col))
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    roots = components(link_fingerprints(nodes, limit)).toDF("fp", "root")
    small = roots.join(nodes, "fp").groupBy("root").agg(F.min("least").alias("component"))
    named = roots.join(small, "root").select("fp", "component", "root")
    label = nodes.join(named, "fp", "left").select("fp", "n", F.coalesce("component", "least").alias("component_id"), F.coalesce("root", "fp").alias("root"))
    # fingerprints of more than a part of all rows: fewer than HOT of them, so they can be broadcast, and their rows stay where they are
    label = written(label)
    hot = F.broadcast(label.where(F.col("n") > (label.agg(F.sum("n")).first()[0] or 0) / HOT).drop("n"))
    rest = prints.join(hot.select("fp"), "fp", "left_anti").join(label.drop("n"), "fp")
    return prints.join(hot, "fp").unionByName(rest).select("doc_id", "fp", "component_id", "root", *(["row"] if row_col else []))
