"""Removal of repeated word passages with difference-cover anchors.

A window is `window` (20) words of one text. Positions whose residue modulo 13 lies
in the difference cover {0, 1, 3, 9} are anchors: every difference modulo 13 is a
difference of two of these, so that two equal windows share an anchor at the same
offset, and the 8 words from it lie within both. Only at anchors are 8 words
hashed and shuffled. With each anchor goes a hash of its whole reach, the words
of all windows that hold the anchor:

1. Anchors with equal reach: all but the first lie in passages that start earlier, so
   all windows that hold them are repeats. This settles the inside of long repeats.
2. Where the same 8 words occur with different reach, the first anchor of each reach is
   extended: the windows that hold it are hashed over all their words and
   compared; all but the first of equal windows are repeats.

Equal reaches and equal windows are folded where they are read, so that a passage
shared by many texts costs one entry for each task and bucket, not one for each text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folia.llm.common import buckets, covered, gather, lean, lean_group, mix, pack, raw, slices, written
from folia.session import ship

PERIOD = 13
COVER = (0, 1, 3, 9)
BASE = np.uint64(0x9E3779B97F4A7C15)
SECOND = np.uint64(0xC2B2AE3D27D4EB4F)
#: A document is named by its id and its place among the texts of that id, which is 0 for nearly all; null ids come last.
DOC = ("i8", "u4")
#: Places of null ids begin here.
NULLS = 1 << 31
#: Bytes of text in a bucket of documents or hashes, about.
BUCKET = 24 << 20
SPOT = (*DOC, "i4")


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    for i in range(1, n):
        out[i] = out[i - 1] * base
    return out


def _runs(h: np.ndarray, at: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash of the `size` words from each position."""
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        out = out * base + h[at + k]
    return mix(out)


def _reach(h: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, before: int, after: int) -> np.ndarray:
    """Hash of the words from `before` ahead of each position to `after` behind it, cut at the text's ends [lo, hi)."""
    left = np.minimum(at - lo, before)
    right = np.minimum(hi - at, after)
    out = (left * 64 + right).astype(np.uint64)
    for k in range(-before, after):
        ok = (k >= -left) & (k < right)
        out = out * SECOND + np.where(ok, h[np.where(ok, at + k, 0)], np.uint64(1))
    return mix(out)


def _order(*keys: np.ndarray) -> np.ndarray:
    return np.lexsort(keys[::-1])


def _new(*keys: np.ndarray) -> np.ndarray:
    """True where sorted rows differ from the one above."""
    n = len(keys[0])
    out = np.zeros(n, bool)
    if n:
        out[0] = True
        for k in keys:
            out[1:] |= k[1:] != k[:-1]
    return out


class _Texts:
    """Words of some texts, end to end."""

    def __init__(self, ids: np.ndarray, tags: np.ndarray, texts: list[bytes | None], hashed: bool = True):
        self.text = [t or b"" for t in texts]
        self.tag = tags.astype(np.uint32)
        self.id = ids
        # words are split text by text, so that those of one text are held at a time
        each = [_word_hashes(t.split()) for t in self.text] if hashed else []
        self.n = np.fromiter(map(len, each) if hashed else (len(t.split()) for t in self.text), np.int64, len(self.text))
        self.end = np.cumsum(self.n)
        self.start = self.end - self.n
        self.h = np.concatenate(each) if each else np.empty(0, np.uint64)

    def rows(self, doc: np.ndarray, tag: np.ndarray) -> np.ndarray:
        """Row of each named document. Rows that repeat id and text are one document; its first row is meant."""
        order = _order(self.id, self.tag)
        mine = np.empty(len(order), [("d", "i8"), ("t", "u4")])
        mine["d"], mine["t"] = self.id[order], self.tag[order]
        ask = np.empty(len(doc), mine.dtype)
        ask["d"], ask["t"] = doc, tag
        known, back = np.unique(ask, return_inverse=True)
        return order[np.searchsorted(mine, known)][back]


def _doc_bucket(doc: np.ndarray, tag: np.ndarray, n: int) -> np.ndarray:
    """As the column bucket of dealt()."""
    return (np.mod(doc, n) + np.mod(tag.astype(np.int64), n)) % n


def places(docs: DataFrame, id_col: str, text_col: str) -> DataFrame | None:
    """(id, h, place) of texts whose id has other texts too, in order of the text's hash h; None where there are none.

    Texts of one id are numbered in 256 ranges of their hash, so that an id (or null) of very many rows is not gathered."""
    keys = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("h"))
    more = keys.groupBy("id").agg(F.min("h").alias("a"), F.max("h").alias("z")).where("a <> z").select("id")
    more = written(more)
    if not more.take(1):
        return None
    one = keys.join(more, keys["id"].eqNullSafe(more["id"]), "left_semi").distinct().withColumn("part", F.shiftright("h", 56).cast("int"))
    one = written(one)
    counts = one.groupBy("id", "part").agg(F.count("*").alias("n"))
    over = Window.partitionBy("id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col("id").alias("i"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))
    inner = one.withColumn("k", F.row_number().over(Window.partitionBy("id", "part").orderBy("h")) - 1)
    both = inner.join(before, inner["id"].eqNullSafe(before["i"]) & (inner["part"] == before["p"]))
    out = written(both.select("id", "h", (F.col("k") + F.col("before")).alias("place")))
    if out.agg(F.max("place")).first()[0] >= NULLS:
        raise ValueError(f"an id has more than {NULLS} texts")
    return out


def _by_bucket(bucket: np.ndarray, **arrays: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(bucket, blob) of the rows dealt to each bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cut = np.flatnonzero(np.diff(bucket)) + 1
    edges = [0, *cut.tolist(), len(bucket)]
    for lo, hi in zip(edges, edges[1:]):
        if hi > lo:
            yield int(bucket[lo]), pack(**{k: v[order[lo:hi]] for k, v in arrays.items()})


def _rows(found: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.int32()), pa.array([x[2] for x in found], pa.binary())],
        names=["bucket", "kind", "blob"],
    )


MESSAGES = "bucket int, kind int, blob binary"
#: kind of a message: entries to compare; spots of which all windows are repeats; spots to be extended; starts of repeated windows.
COMPARE, SETTLED, EXTEND, REPEAT = range(4)


def dedup_passages(docs: DataFrame, window: int = 20, text_col: str = "text", id_col: str = "doc_id", keep_text: bool = True, carry: list[str] | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256 [, kept_text] [, columns to carry]) for every text.

    A word goes if a window of words that covers it starts earlier too: in a smaller
    doc_id or earlier in the same text, judged on the input. kept_text: the other
    words, joined by one space. A null text has no words. Rows that repeat doc_id and
    text are one document and all get its result; equal ids with different texts
    are ordered by Spark's xxhash64 of the text; null ids come last, in that order too. Columns that are not carried are ignored.
    A text is held by one worker, however long; buckets of texts follow the bytes of all texts."""
    spark = docs.sparkSession
    ship(spark)
    short = window - PERIOD + 1
    if short < 2:
        raise ValueError(f"window has to be at least {PERIOD + 1} words")
    before, after = PERIOD - 1, window
    held = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    # a message goes from each group to each bucket at most
    n_hash = max(buckets(spark, 1), -(-held // BUCKET))
    n_doc = next(k for k in range(2 * n_hash, 4 * n_hash + 2) if all(k % d for d in range(2, int(k**0.5) + 1)))  # a prime, for ids in steps
    last = (1 << 63) - 1
    carry = carry or []
    text = F.col(text_col).cast("string")
    # columns take numbers for names, so that none clashes
    full = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), *[F.col(c).alias(f"_{k}") for k, c in enumerate(carry)])
    if (place := places(docs, id_col, text_col)) is not None:
        at = place.toDF("i", "h", "place")
        full = full.withColumn("hash", F.xxhash64("text")).join(at, F.col("id").eqNullSafe(F.col("i")) & (F.col("hash") == F.col("h")), "left").drop("i", "h", "hash")
    else:
        full = full.withColumn("place", F.lit(None).cast("long"))
    tag = F.coalesce("place", F.lit(0)) + F.when(F.col("id").isNull(), F.lit(NULLS)).otherwise(0)
    full = full.select(F.coalesce("id", F.lit(last)).alias("doc"), tag.cast("long").alias("tag"), "text", *[f"_{k}" for k in range(len(carry))])
    if place is not None:
        full = written(full)
    frame = full.select("doc", "tag", "text")

    def fold(entry: dict[str, np.ndarray], key: list[str]) -> tuple[dict, dict]:
        """Entries that are the first of their key, and the others."""
        o = _order(*(entry[k] for k in (*key, "doc", "tag", "pos")))
        entry = {k: v[o] for k, v in entry.items()}
        same_spot = ~_new(*(entry[k] for k in (*key, "doc", "tag", "pos")))  # a row that repeats a document
        entry = {k: v[~same_spot] for k, v in entry.items()}
        new = _new(*(entry[k] for k in key))
        return {k: v[new] for k, v in entry.items()}, {k: v[~new] for k, v in entry.items()}

    def spots(e: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        return {k: e[k] for k in ("doc", "tag", "pos")}

    def find_anchors(kind: int):
        """Messages of one kind. Anchors are found once for either, so that the entries to compare, which are many, go straight to their shuffle."""

        @lean
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[dict] = []

            def flush() -> pa.RecordBatch:
                entry = {k: np.concatenate([x[k] for x in held]) for k in held[0]}
                held.clear()
                first, rest = fold(entry, ["anchor", "reach"])
                bucket = ((first["anchor"] >> np.uint64(32)) % np.uint64(n_hash)).astype(np.int64)
                if kind == COMPARE:
                    return _rows([(k, COMPARE, x) for k, x in _by_bucket(bucket, anchor=first["anchor"].astype(np.uint32), reach=first["reach"], **spots(first))])
                return _rows([(k, SETTLED, x) for k, x in _by_bucket(_doc_bucket(rest["doc"], rest["tag"], n_doc), **spots(rest))])

            count = 0
            for b in slices(batches, "text", 2 << 20):
                t = _Texts(b.column("doc").to_numpy(zero_copy_only=False), b.column("tag").to_numpy(zero_copy_only=False), raw(b, "text"))
                if not len(t.h):
                    continue
                row = np.repeat(np.arange(len(t.n)), t.n)
                pos = np.arange(len(t.h)) - t.start[row]
                in_cover = np.isin(np.arange(PERIOD), COVER)
                at = np.flatnonzero(in_cover[pos % PERIOD] & (pos + short <= t.n[row]) & (t.n[row] >= window))
                r = row[at]
                held.append({
                    "anchor": _runs(t.h, at, short, BASE), "reach": _reach(t.h, at, t.start[r], t.end[r], before, after),
                    "doc": t.id[r], "tag": t.tag[r], "pos": pos[at].astype(np.int32),
                })
                count += len(at)
                if count > 500_000:
                    yield flush()
                    count = 0
            if held:
                yield flush()

        return run

    @lean_group
    def compare_anchors(t: pa.Table) -> pa.Table:
        names = ("anchor", "reach", "doc", "tag", "pos")
        first, rest = fold(dict(zip(names, gather(t.column("blob").to_pylist(), ("u4", "u8", *SPOT)))), ["anchor", "reach"])
        lead = np.flatnonzero(_new(first["anchor"]))
        size = np.diff(np.concatenate((lead, [len(first["anchor"])])))
        many = np.repeat(size > 1, size)
        more = {k: v[many] for k, v in first.items()}
        out = [(k, SETTLED, x) for k, x in _by_bucket(_doc_bucket(rest["doc"], rest["tag"], n_doc), **spots(rest))]
        out += [(k, EXTEND, x) for k, x in _by_bucket(_doc_bucket(more["doc"], more["tag"], n_doc), **spots(more))]
        return pa.Table.from_batches([_rows(out)])

    def window_range(t: _Texts, msgs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """[start, end) over t.h of the starts of the windows that hold the spots."""
        doc, tag, pos = gather(msgs, SPOT)
        if not len(doc):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        r = t.rows(doc, tag)
        lo, hi = np.maximum(pos - before, 0), np.minimum(pos, t.n[r] - window)
        ok = hi >= lo
        return (t.start[r] + lo)[ok], (t.start[r] + hi + 1)[ok]

    def load(texts: pa.Table, hashed: bool) -> _Texts:
        return _Texts(texts.column("doc").to_numpy(), texts.column("tag").to_numpy(), raw(texts, "text"), hashed)

    def messages(t: pa.Table, kind: int) -> list[bytes]:
        return [x for k, x in zip(t.column("kind").to_pylist(), t.column("blob").to_pylist()) if k == kind]

    @lean_group
    def extend(texts: pa.Table, msgs: pa.Table) -> pa.Table:
        ask = messages(msgs, EXTEND)
        if not ask or not texts.num_rows:
            return pa.Table.from_batches([_rows([])])
        t = load(texts, True)
        n = len(t.h)
        todo = covered(n, *window_range(t, ask)) & ~covered(n, *window_range(t, messages(msgs, SETTLED)))
        at = np.flatnonzero(todo)
        row = np.searchsorted(t.end, at, side="right")
        entry = {"one": _runs(t.h, at, window, BASE), "two": _runs(t.h, at, window, SECOND), "doc": t.id[row], "tag": t.tag[row], "pos": (at - t.start[row]).astype(np.int32)}
        first, rest = fold(entry, ["one", "two"])
        bucket = ((first["one"] >> np.uint64(32)) % np.uint64(n_hash)).astype(np.int64)
        out = [(k, COMPARE, x) for k, x in _by_bucket(bucket, one=first["one"], two=first["two"], **spots(first))]
        out += [(k, REPEAT, x) for k, x in _by_bucket(_doc_bucket(rest["doc"], rest["tag"], n_doc), **spots(rest))]
        return pa.Table.from_batches([_rows(out)])

    @lean_group
    def compare_windows(t: pa.Table) -> pa.Table:
        names = ("one", "two", "doc", "tag", "pos")
        _, rest = fold(dict(zip(names, gather(t.column("blob").to_pylist(), ("u8", "u8", *SPOT)))), ["one", "two"])
        return pa.Table.from_batches([_rows([(k, REPEAT, x) for k, x in _by_bucket(_doc_bucket(rest["doc"], rest["tag"], n_doc), **spots(rest))])])

    @lean_group
    def finish(texts: pa.Table, msgs: pa.Table) -> pa.Table:
        t = load(texts, False)
        n = int(t.n.sum())
        starts, ends = window_range(t, messages(msgs, SETTLED))
        gone = covered(n, starts, ends + window - 1)
        doc, tag, pos = gather(messages(msgs, REPEAT), SPOT)
        if len(doc):
            at = t.start[t.rows(doc, tag)] + pos
            gone |= covered(n, at, at + window)
        # rows that repeat a document take over what its first row lost
        lead = t.rows(t.id, t.tag) if len(t.n) else np.zeros(0, np.int64)
        kept, removed = [], []
        for k, own in enumerate(t.text):
            r, words = lead[k], own.split()
            mask = gone[t.start[r] : t.end[r]] if t.n[r] == t.n[k] else gone[t.start[k] : t.end[k]]
            lost = int(mask.sum())
            kept.append(b" ".join(words) if not lost else b" ".join([w for w, g in zip(words, mask.tolist()) if not g]))
            removed.append(lost)
        ids = pa.array(t.id, mask=t.tag >= NULLS)
        cols = {"doc": ids, "n_words": t.n, "n_removed": np.array(removed, np.int64), "kept_sha256": [hashlib.sha256(x).hexdigest() for x in kept]}
        if keep_text:
            cols["kept_text"] = pa.array(kept, pa.binary()).cast(pa.string())
        return pa.table(cols | {f"_{k}": texts.column(f"_{k}") for k in range(len(carry))})

    def dealt(df: DataFrame) -> DataFrame:
        n = F.lit(n_doc)
        return df.withColumn("bucket", F.pmod(F.pmod("doc", n) + F.pmod("tag", n), n).cast("int"))

    folded = written(frame.mapInArrow(find_anchors(SETTLED), MESSAGES), "lz4")
    hot = written(frame.mapInArrow(find_anchors(COMPARE), MESSAGES).groupBy("bucket").applyInArrow(compare_anchors, MESSAGES), "lz4")
    known = folded.union(hot)
    texts = dealt(frame)
    extended = written(texts.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(extend, MESSAGES), "lz4")
    again = extended.where(f"kind = {COMPARE}").groupBy("bucket").applyInArrow(compare_windows, MESSAGES)
    verdicts = known.where(f"kind = {SETTLED}").union(extended.where(f"kind = {REPEAT}")).union(again)
    schema = T.StructType().add("doc", "long").add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string")
    schema = schema.add("kept_text", "string") if keep_text else schema
    for k in range(len(carry)):
        schema = schema.add(f"_{k}", full.schema[f"_{k}"].dataType)
    out = dealt(full).groupBy("bucket").cogroup(verdicts.groupBy("bucket")).applyInArrow(finish, schema)
    names = ["n_words", "n_removed", "kept_sha256"] + ["kept_text"] * keep_text
    return out.select(F.col("doc").alias("doc_id"), *names, *[F.col(f"_{k}").alias(c) for k, c in enumerate(carry)])
