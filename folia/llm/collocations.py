"""Phrases of two to four words that occur together, mined by SON partitioning.

1. Words are counted exactly; a phrase can only be frequent if its words are.
2. The rows are dealt to shards. Each shard is mined completely for phrases that reach the support lowered to the
   shard's share of the words of the language. A phrase below its lowered support in every shard is below the support overall, so the union
   over the shards misses none. A shard is mined by many tasks: each sends its phrases as sorted runs of 64-bit hashes
   to buckets, which add them up.
3. All phrases whose hash is in the union are counted over all texts exactly, by their words.

Sets of hashes reach the tasks as bit maps of bounded size: a bit that is set by chance costs a count, never a result."""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folia.llm.common import bit_map, buckets, gather, lean, lean_group, marked, mix, pack, raw, slices, written
from folia.session import ship

#: Longest phrase, in words.
LONGEST = 4
#: What stands for a missing language.
NO_LANG = "und"
#: Bytes of text worked on at once; words with their numbers, and hashes with their counts, kept in a worker.
SLICE, WORDS, HELD = 8 << 20, 400_000, 4_000_000
#: Rows of languages and shards that may be broadcast.
SHARES = 100_000
#: Marks and line ends that end a piece.
ENDS = b".,;:!?\n\x0b\x0c\r"
_TO = bytes(10 if c in ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Words(dict):
    """A number and a hash for each word: 0 nothing, 1 the end of a piece."""

    def __init__(self):
        super().__init__({b"": 0, b"\n": 1})
        self.names = [b"", b"\n"]
        self.hashes = array("Q", (0, 0))

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.names)
        self.names.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word))
        return n

    def trim(self) -> None:
        if len(self) > WORDS:
            self.clear()
            self.__init__()


def lang_hash(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode(), 1))


class Pieces:
    """The words of texts of one language in a row, cut into pieces."""

    def __init__(self, words: Words, lang: str, texts: list[bytes]):
        """The texts stand in pieces of their own."""
        spaced = b"\n".join(texts).translate(_TO).replace(b"\n", b" \n ")
        tokens = spaced.split(b" ")
        ids = np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens))
        self.ids = np.append(ids[ids > 0], 1)
        n = len(self.ids)
        ends = np.flatnonzero(self.ids == 1)
        self.left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)  # words from here to the end of the piece
        self.hash = np.frombuffer(words.hashes, np.uint64)[self.ids]
        self.lang = lang_hash(lang)

    def grams(self) -> Iterator[tuple[int, np.ndarray]]:
        """(k, hash of the k words from each place on) for k from 1; only where left >= k is it one of a phrase."""
        h = mix(self.hash ^ self.lang)
        yield 1, h
        for k in range(2, LONGEST + 1):
            h = mix(h[:-1] * _STEP + self.hash[k - 1 :])
            yield k, h


def _by_lang(b: pa.RecordBatch, *more: str) -> dict[tuple, list[bytes]]:
    """Texts of a batch by language and further columns."""
    out: dict[tuple, list[bytes]] = defaultdict(list)
    for key, text in zip(zip(*(b.column(c).to_pylist() for c in ("lang", *more))), raw(b, "text")):
        out[key].append(text)
    return out


def _summed(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, with the sums of their counts."""
    order = np.argsort(h, kind="stable")
    h, n = h[order], n[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    return h[new], np.add.reduceat(n, np.flatnonzero(new)) if len(h) else n


def count_words(rows: DataFrame) -> DataFrame:
    """(lang, shard, word, n): a row for each word of a language (shard null), and one for the words of each shard and language (word null)."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        held: dict[str, np.ndarray] = {}
        total: dict[tuple[str, int], int] = defaultdict(int)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, n in held.items():
                some = np.flatnonzero(n)
                for lo in range(0, len(some), 100_000):
                    part = some[lo : lo + 100_000]
                    names = pa.array([words.names[i] for i in part.tolist()], pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.nulls(len(part), pa.int32()), names, pa.array(n[part])], names=["lang", "shard", "word", "n"])
            held.clear()
            words.trim()

        for b in slices(batches, "text", SLICE):
            for (lang, shard), texts in _by_lang(b, "shard").items():
                p = Pieces(words, lang, texts)
                n = np.bincount(p.ids, minlength=len(words.names))
                n[:2] = 0
                total[lang, shard] += int(n.sum())
                if lang in held:
                    n[: len(held[lang])] += held[lang]
                held[lang] = n
            if len(words) > WORDS:
                yield from flush()
        yield from flush()
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.int32()), pa.nulls(len(total), pa.string()), pa.array(list(total.values()), pa.int64())],
            names=["lang", "shard", "word", "n"],
        )

    return rows.mapInArrow(run, "lang string, shard int, word string, n long").groupBy("lang", "shard", "word").agg(F.sum("n").alias("n"))


def mine_shards(rows: DataFrame, shares: DataFrame, frequent: Broadcast, support: int, shards: int) -> DataFrame:
    """h: hashes of all phrases that reach the lowered support of a shard. shares: (lang, shard, n, all), words of a shard and of its language."""
    n_buckets = max(1, -(-2 * buckets(rows.sparkSession, 1) // shards))

    @lean
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        held: dict[tuple, list] = defaultdict(list)

        def flush() -> pa.RecordBatch:
            out = []
            for (lang, shard), runs in held.items():
                h, n = _summed(*(np.concatenate(x) for x in zip(*runs)))
                edge = np.searchsorted(h, np.array([(k << 64) // n_buckets for k in range(n_buckets)], np.uint64)).tolist() + [len(h)]
                for k, (lo, hi) in enumerate(zip(edge, edge[1:])):
                    if hi > lo:
                        out.append((lang, shard, k, pack(step=np.diff(h[lo:hi], prepend=np.uint64(0)), n=n[lo:hi].astype(np.uint32))))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.string(), pa.int32(), pa.int32(), pa.binary()))], names=["lang", "shard", "bucket", "blob"])

        size = 0
        for b in slices(batches, "text", SLICE):
            for key, texts in _by_lang(b, "shard").items():
                p = Pieces(words, key[0], texts)
                ok = p.left > 0
                for k, h in p.grams():
                    if k == 1:
                        known = ok & marked(frequent.value, h)
                        ok = known
                        continue
                    ok = ok[:-1] & known[k - 1 :] & (p.left[: len(h)] >= k)
                    if ok.any():
                        got = h[ok]
                        held[key].append(_summed(got, np.ones(len(got), np.int64)))
                        size += len(held[key][-1][0])
            words.trim()
            if size > HELD:
                yield flush()
                size = 0
        if size:
            yield flush()

    @lean_group
    def add(t: pa.Table) -> pa.Table:
        runs = [gather([x], ("u8", "u4")) for x in t.column("blob").to_pylist()]
        h, n = _summed(np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in runs]), np.concatenate([x[1].astype(np.int64) for x in runs]))
        part, whole = t.column("n")[0].as_py(), t.column("all")[0].as_py()
        least = max(1, -(-support * part // whole))  # the smallest count that is no less than the share of the support
        return pa.table({"h": h[n >= least].view(np.int64)})

    found = rows.mapInArrow(spread, "lang string, shard int, bucket int, blob binary")
    shares = written(shares)
    if shares.count() <= SHARES:  # else a join by key, which has few keys
        shares = F.broadcast(shares)
    return found.join(shares, ["lang", "shard"]).groupBy("lang", "shard", "bucket").applyInArrow(add, "h long").distinct()


def count_phrases(rows: DataFrame, candidates: Broadcast) -> DataFrame:
    """(lang, phrase, words, n): exact counts of all phrases whose hash is marked."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for b in slices(batches, "text", SLICE):
            for (lang,), texts in _by_lang(b).items():
                p = Pieces(words, lang, texts)
                for k, h in p.grams():
                    if k == 1:
                        continue
                    at = np.flatnonzero(p.left[: len(h)] >= k)
                    at = at[marked(candidates.value, h[at])]
                    if not len(at):
                        continue
                    # places of the same words: numbered word by word, so that equal means equal
                    same = p.ids[at]
                    for j in range(1, k):
                        _, first, same = np.unique(same << 32 | p.ids[at + j], return_index=True, return_inverse=True)
                    n = np.bincount(same)
                    names = [b" ".join([words.names[i] for i in p.ids[x : x + k].tolist()]) for x in at[first].tolist()]
                    for lo in range(0, len(names), 50_000):
                        m = len(names[lo : lo + 50_000])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * m), pa.array(names[lo : lo + m], pa.binary()).cast(pa.string()), pa.array(np.full(m, k, np.int32)), pa.array(n[lo : lo + m].astype(np.int64))],
                            names=["lang", "phrase", "words", "n"],
                        )
            words.trim()

    return rows.mapInArrow(run, "lang string, phrase string, words int, n long").groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, support: int = 30, shards: int = 8, text_col: str = "text", lang_col: str = "lang", deal_by: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, n) of all phrases of one to four words that occur `support` times or more in their language, (lang, n) words of each language).

    A word is a run of characters other than space and tab, A-Z as a-z; marks and line ends cut a text into pieces, and phrases
    stay inside them. Null texts are empty, a null language is `und`. Rows go to shards by the hash of `deal_by`; counts do not depend on it. With `support` or more
    shards the lowered support may be 1, which is still right but finds nothing to leave out."""
    ship(docs.sparkSession)
    shard = F.pmod(F.xxhash64(F.col(deal_by)), F.lit(shards)).cast("int")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), shard.alias("shard"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    counted = written(count_words(rows).where((F.col("n") >= support) | F.col("word").isNull()))
    words = counted.where("word is not null").select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), "n")
    part = counted.where("word is null").select("lang", "shard", "n")
    whole = part.groupBy("lang").agg(F.sum("n").alias("all"))

    @lean
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang = np.array([lang_hash(x) for x in b.column("lang").to_pylist()], np.uint64)
            h = np.array([xxhash.xxh64_intdigest(x) for x in raw(b, "phrase")], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(mix(h ^ lang).view(np.int64))], names=["h"])

    frequent = bit_map(words.mapInArrow(hashed, "h long"))
    mined = written(mine_shards(rows, part.where("n > 0").join(whole, "lang"), frequent, support, shards))
    phrases = count_phrases(rows.select("lang", "text"), bit_map(mined)).where(F.col("n") >= support)
    return written(words.unionByName(phrases)), whole.withColumnRenamed("all", "n")


def _part(first: str, count: str) -> str:
    return f"array_join(slice(w, {first}, {count}), ' ')"


def collocations(docs: DataFrame, support: int = 30, top: int = 2000, shards: int = 8, text_col: str = "text", lang_col: str = "lang", deal_by: str = "doc_id") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best `top` phrases of two to four words of each language.

    a: occurrences, at least `support`; n: words of the language. A phrase is cut in two after its first k words, l and r are the
    occurrences of the parts, and score is floor(2000000 a / (l + r)) for the cut with the lowest score, of equal ones that with the smallest k. A phrase that
    stands inside a longer one with 80 % or more of its occurrences is left out. Ranks go by score, then a, both falling, then by phrase in the order of its bytes.

    Arithmetic is exact (decimals of 38 digits). Repeated rows count each; null and empty texts have no words; texts of any length are taken whole; an empty table gives an empty
    one. Other columns are ignored, whatever their names."""
    seen, totals = frequent_phrases(docs, support, shards, text_col, lang_col, deal_by)
    phrases = seen.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    # each phrase under the shorter ones inside it
    inner = phrases.where("words > 2").select("lang", "a", "w", "words", F.explode(F.expr("sequence(2, words - 1)")).alias("m"))
    inner = inner.select("lang", "a", F.expr("explode(transform(sequence(1, words - m + 1), s -> array_join(slice(w, s, m), ' ')))").alias("phrase"))
    longest = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = phrases.join(longest, ["lang", "phrase"], "left").where("longer is null or 100 * cast(longer as decimal(20, 0)) < 80 * cast(a as decimal(20, 0))").drop("longer")
    cuts = kept.withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr(_part("1", "k")).alias("first"), F.expr(_part("k + 1", "words - k")).alias("rest"))
    count = seen.select("lang", "phrase", "n")
    cuts = cuts.join(count.toDF("lang", "first", "l"), ["lang", "first"]).join(count.toDF("lang", "rest", "r"), ["lang", "rest"])
    score = F.expr("cast(2000000 as decimal(7, 0)) * cast(a as decimal(20, 0)) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    best = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # places by ranges of the order: inside a range by rows, before it by counts, so no language is ranked in one task
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranged = written(best.repartitionByRange(buckets(docs.sparkSession, 1), F.col("lang"), *order).withColumn("part", F.spark_partition_id()))
    before = F.sum("size").over(Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = ranged.groupBy("lang", "part").agg(F.count("*").alias("size")).withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < top)
    near = ranged.join(sizes, ["lang", "part"]).withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    return near.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
