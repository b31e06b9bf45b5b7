"""Alignment of two tokenizers over the same bytes, by interval coalescing.

A is a byte-level BPE of the tokenizers format, B a sentencepiece model that puts a space before a text.
Tokens of both are intervals of bytes. They are sorted by start, the running maximum of their ends is taken, and a
group begins where a start reaches it: there tokens of A and of B both end. Inside a group all tokens of A and B that
overlap are linked.

Neither tokenizer joins bytes across the start of a word, so texts are cut there and each distinct word is aligned once
in a batch. The corpus-wide count of an id pair needs two passes: the first counts words, aligns each distinct one
and adds up its links by pair, the second gives each text its figures."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.llm.bpe import _SPLIT, Vocabulary
from folia.llm.common import lean, slices, written
from folia.session import ship

#: A space or line feed after white space; texts with one are cut by the pattern below instead.
_RUNS = re.compile(r"\s[ \n]")
_CUTS = re.compile(r"(?<=\S)(?=[ \n])")
#: Words counted in a task before their links are added up, and words aligned at once.
COUNTED, AT_ONCE = 400_000, 60_000
#: Bytes of words and their alignments kept in a worker; a word costs about UNIT besides its own.
MEMORY, UNIT = 96 << 20, 400
#: Pairs that one broadcast may hold, 17 bytes each; more are taken in turns.
PAIRS = 4_000_000
SLICE = 4 << 20


class Aligner:
    """Both tokenizers and the alignment of words. A word is a string that begins with its space or line feed."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = Vocabulary(a_path)  # encode_units knows no special strings: they are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        a_bytes = [self.a.pieces.get(i, b"") for i in range(max(self.a.pieces) + 1)]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size = [np.array([len(x) for x in of], np.int64) for of in (a_bytes, b_bytes)]
        self.first = [np.cumsum(s) - s for s in self.size]
        self.bytes = [np.frombuffer(b"".join(of), np.uint8) for of in (a_bytes, b_bytes)]
        # an id of A or B in decimal, before a comma, the other side, and the next group
        self.written = [b"%d%c" % (i, c) for of, end in ((a_bytes, b"|"), (b_bytes, b";")) for i in range(len(of)) for c in (b",", end)]
        self.n_a = len(a_bytes)
        self.space = pieces.index("▁") if "▁" in pieces else -1
        self.by_word = self._cuts_words(b_path, pieces)

    def _cuts_words(self, b_path: str, pieces: list[str]) -> bool:
        """Whether no piece of B goes over the start of a word, and B changes no character but U+2581."""
        try:
            from sentencepiece import sentencepiece_model_pb2

            with open(b_path, "rb") as f:
                spec = sentencepiece_model_pb2.ModelProto.FromString(f.read()).normalizer_spec
        except ImportError:
            return False
        plain = not spec.precompiled_charsmap and spec.add_dummy_prefix and not spec.remove_extra_whitespaces
        whole = sum(map(self.b.is_byte, range(len(pieces)))) == 256 and self.space >= 0 and sum(len(x) == 1 for x in set(self.a.pieces.values())) == 256
        return plain and whole and not any(re.search("[^▁]▁|\n.|.\n", p, re.S) for p in pieces)

    def cut(self, text: str | None) -> list[str] | None:
        """The words of a text with a space before it; None if the text has no tokens."""
        if not text or self.by_word and "▁" in text:
            return None
        text = " " + text
        if not self.by_word:
            return [text]
        if "\0" in text or _RUNS.search(text):
            return _CUTS.split(text)
        return text.replace("\n", "\0\n").replace(" ", "\0 ").split("\0")[1:]

    def encode(self, words: list[str], side: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and the number of each."""
        if side == 0:
            parts = [_SPLIT.findall(w) for w in words]
            every = list(chain.from_iterable(parts))
            once = list(dict.fromkeys(every))
            of = dict(zip(once, self.a.encode_units([t.encode() for t in once])))
            ids = list(map(of.__getitem__, every))
            n = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
            to = np.concatenate(([0], np.cumsum(n)))
            ends = to[np.concatenate(([0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))))]
            return np.frombuffer(b"".join(ids), "<u4").astype(np.int64), np.diff(ends)
        # B puts the space there itself; before a line feed its own token goes again
        ids = self.b.encode([w[1:] if w[0] == " " else w for w in words], num_threads=1)
        ids = [(x or [self.space]) if w[0] == " " else x[1:] for w, x in zip(words, ids)]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())), n

    def _joined(self, ids: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of tokens in a row, and the size of each."""
        size = self.size[side][ids]
        end = np.cumsum(size)
        return self.bytes[side][np.repeat(self.first[side][ids] - (end - size), size) + np.arange(end[-1] if len(end) else 0)], size

    def align(self, words: list[str]) -> dict:
        """For words whose bytes both tokenizers give back: numbers of tokens, groups and links, links as pair codes,
        and the written form. ok: which words those are; the others have zeros."""
        ids, n, ok, data = [None, None], [None, None], np.ones(len(words), bool), [w.encode() for w in words]
        flat, length = np.frombuffer(b"".join(data), np.uint8), np.fromiter(map(len, data), np.int64, len(data))
        for s in (0, 1):
            ids[s], n[s] = self.encode(words, s)
            joined, size = self._joined(ids[s], s)
            edge = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(n[s])))]
            if not (np.array_equal(np.diff(edge), length) and np.array_equal(joined, flat)):
                ok &= np.array([joined[lo:hi].tobytes() == w for lo, hi, w in zip(edge, edge[1:], data)], bool)
        if not ok.all():
            for s in (0, 1):
                ids[s], n[s] = ids[s][np.repeat(ok, n[s])], np.where(ok, n[s], 0)
        word = [np.repeat(np.arange(len(words)), k) for k in n]
        end = [np.cumsum(self.size[s][ids[s]]) for s in (0, 1)]
        start = [e - self.size[s][ids[s]] for s, e in enumerate(end)]
        # interval coalescing: a group begins where a start reaches the running maximum of ends
        both = np.concatenate(start)
        side = np.repeat([0, 1], [len(x) for x in ids])
        order = np.lexsort((side, both))
        reach = np.maximum.accumulate(np.concatenate(end)[order])
        begins = np.ones(len(order), bool)
        begins[1:] = both[order][1:] >= reach[:-1]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(begins) - 1
        # inside a group, each token of A with those of B that it overlaps
        lo, hi = np.searchsorted(end[1], start[0], "right"), np.searchsorted(start[1], end[0], "left")
        links = hi - lo
        partner = np.repeat(lo - (np.cumsum(links) - links), links) + np.arange(links.sum())
        pairs = np.repeat(ids[0] << 32, links) | ids[1][partner]
        # written form: tokens by group, A before B
        at = np.argsort(group * 2 + side, kind="stable")
        last = np.ones(len(at), bool)
        key = (group * 2 + side)[at]
        last[:-1] = key[1:] != key[:-1]
        codes = (2 * np.concatenate((ids[0], ids[1] + self.n_a))[at] + last).tolist()
        tokens = np.concatenate(([0], np.cumsum(n[0] + n[1]))).tolist()
        name = self.written.__getitem__
        return {
            "ok": ok, "n_a": n[0], "n_b": n[1], "n_links": np.bincount(word[0], links, len(words)).astype(np.int64), "pairs": pairs,
            "n_groups": np.bincount(np.concatenate(word)[order][begins], minlength=len(words)),
            "text": [b"".join(map(name, codes[i:j])) for i, j in zip(tokens, tokens[1:])],
        }

    def batches(self, words: list[str]) -> Iterator[tuple[list[str], dict]]:
        """Alignments of words, so many at a time that their bytes stay few."""
        held, size = [], 0
        for w in words:
            held.append(w)
            size += len(w)
            if len(held) == AT_ONCE or size > 1 << 19:
                yield held, self.align(held)
                held, size = [], 0
        if held:
            yield held, self.align(held)


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One for each pair of files in a worker."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def _cut_all(tool: Aligner, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Words of all texts in a row, and the number of each text (-1: it has no tokens)."""
    cut = [tool.cut(t) for t in texts]
    return list(chain.from_iterable(filter(None, cut))), np.array([-1 if x is None else len(x) for x in cut], np.int64)


def count_pairs(texts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(a_id, b_id, n, best): links of each id pair over all texts (column text), and whether no pair of that b_id has more."""

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(a_path, b_path)
        seen: Counter = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["text", "n"])
            seen.clear()
            yield from slices([out], "text", SLICE)

        for b in slices(batches, "text", SLICE):
            seen.update(_cut_all(tool, b.column("text").to_pylist())[0])
            if len(seen) > COUNTED:
                yield from flush()
        if seen:
            yield from flush()

    @lean
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(a_path, b_path)
        code, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in slices(batches, "text", SLICE):
            n, at = b.column("n").to_numpy(), 0
            for some, got in tool.batches(b.column("text").to_pylist()):
                key = np.concatenate((code, got["pairs"]))
                times = np.concatenate((total, np.repeat(n[at : at + len(some)], got["n_links"])))
                at += len(some)
                code, which = np.unique(key, return_inverse=True)
                total = np.zeros(len(code), np.int64)
                np.add.at(total, which, times)
            if len(code) > PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(code >> 32), pa.array(code & 0xFFFFFFFF), pa.array(total)], names=["a_id", "b_id", "n"])
                code, total = code[:0], total[:0]
        yield pa.RecordBatch.from_arrays([pa.array(code >> 32), pa.array(code & 0xFFFFFFFF), pa.array(total)], names=["a_id", "b_id", "n"])

    # each distinct word is aligned once, wherever it stands
    words = texts.select("text").mapInArrow(count, "text string, n long").groupBy("text").agg(F.sum("n").alias("n"))
    counted = words.mapInArrow(link, "a_id long, b_id long, n long").groupBy("a_id", "b_id").agg(F.sum("n").alias("n"))
    counted = written(counted)
    top = counted.groupBy("b_id").agg(F.max("n").alias("top"))
    return written(counted.join(top, "b_id").select("a_id", "b_id", "n", (F.col("n") == F.col("top")).alias("best")))


FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", keep: list[str] | None = None, with_groups: bool = True) -> DataFrame:
    """Columns `keep` with n_a, n_b, n_groups, n_links, n_best, count_sum and groups (binary) for every text.

    groups is `a1,a2|b1;a3|b2,b3`: ids of A and B in decimal, group by group. A pair's count is the number of links
    of all texts that join its two ids. n_best is the number of a text's links whose count is the highest of their id of B,
    ties included; count_sum is the sum of the counts of all its links.

    A null or empty text, and one whose bytes either tokenizer does not give back (for B, U+2581 comes back as a space),
    has no tokens, zeros and an empty `groups`, and adds to no count. Special strings are plain text. Texts of any length are taken whole; a worker holds one text
    and its tokens. Repeated rows count each and give equal rows; an empty table gives an empty one. Columns not kept are
    ignored, kept ones may have any name (one that the result has too is there twice, the kept one first). Both files have to be on every machine.
    The pairs, at most one for two ids, are broadcast in turns of at most PAIRS."""
    ship(docs.sparkSession)
    spark, keep = docs.sparkSession, keep or ["doc_id"]
    ids = [f"k{i}" for i in range(len(keep))]
    frame = docs.select(*[F.col(k).alias(i) for i, k in zip(ids, keep)], F.col(text_col).cast("string").alias("text"))
    pairs = count_pairs(frame, a_path, b_path)
    turns = max(1, -(-pairs.count() // PAIRS))
    kinds = ", ".join(f"{i} {docs.schema[k].dataType.simpleString()}" for i, k in zip(ids, keep))
    frame = frame.withColumns({"best": F.lit(0).cast("long"), "total": F.lit(0).cast("long")})
    for turn in range(turns):
        part = pairs.where(F.pmod(F.xxhash64("a_id", "b_id"), F.lit(turns)) == turn).toArrow()
        code = part["a_id"].to_numpy() << 32 | part["b_id"].to_numpy()
        order = np.argsort(code)
        table = spark.sparkContext.broadcast((code[order], part["n"].to_numpy()[order], part["best"].to_numpy()[order]))
        if turn + 1 < turns:
            frame = written(frame.mapInArrow(partial(_score, a_path, b_path, table, len(ids), False, False), f"{kinds}, text string, best long, total long"))
    made = ", ".join(f"{f} long" for f in FIGURES) + ", groups binary" * with_groups
    out = frame.mapInArrow(partial(_score, a_path, b_path, table, len(ids), True, with_groups), f"{kinds}, {made}")
    return out.toDF(*keep, *FIGURES, *["groups"] * with_groups)


def _score(a_path: str, b_path: str, table, n_keep: int, final: bool, with_groups: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Figures of each text from the pairs of one turn. final: with all figures; else only the sums so far, for the next turn."""
    tool = aligner(a_path, b_path)
    code, count, best = table.value
    place: dict[str, int] = {}
    figures, texts, held = np.zeros((0, 7), np.int64), [], 0

    def learn(new: list[str]) -> None:
        nonlocal figures, held
        rows = [figures]
        for words, got in tool.batches(new):
            of = np.repeat(np.arange(len(words)), got["n_links"])
            at = np.searchsorted(code, got["pairs"])
            at[at == len(code)] = 0
            there = code[at] == got["pairs"] if len(code) else np.zeros(len(at), bool)
            sums = np.zeros((len(words), 2), np.int64)
            if there.any():
                np.add.at(sums, of[there], np.stack((best[at[there]].astype(np.int64), count[at[there]]), axis=1))
            rows.append(np.column_stack((got["n_a"], got["n_b"], got["n_groups"], got["n_links"], sums, got["ok"])))
            place.update(zip(words, range(len(place), len(place) + len(words))))
            texts.extend(got["text"] if with_groups else [])
            held += sum(map(len, words)) + sum(map(len, got["text"])) * with_groups + UNIT * len(words)
        figures = np.concatenate(rows)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal figures, held
        for b in slices(batches, "text", SLICE):
            if held > MEMORY:
                figures, held = np.zeros((0, 7), np.int64), 0
                place.clear()
                texts.clear()
            words, n = _cut_all(tool, b.column("text").to_pylist())
            learn([w for w in dict.fromkeys(words) if w not in place])
            spot = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
            edge = np.concatenate(([0], np.cumsum(np.maximum(n, 0))))
            sums = np.concatenate((np.zeros((1, 7), np.int64), np.cumsum(figures[spot], axis=0)))
            got = sums[edge[1:]] - sums[edge[:-1]]
            ok = (n > 0) & (got[:, 6] == n)
            got[~ok] = 0
            got[:, 4] += b.column("best").to_numpy()
            got[:, 5] += b.column("total").to_numpy()
            cols = list(b.columns[:n_keep])
            if not final:
                cols += [b.column("text"), pa.array(got[:, 4]), pa.array(got[:, 5])]
                names = [*b.schema.names[:n_keep], "text", "best", "total"]
            else:
                cols += [pa.array(np.ascontiguousarray(got[:, k])) for k in range(6)]
                names = [*b.schema.names[:n_keep], *FIGURES]
                if with_groups:
                    at = spot.tolist()
                    form = [b"".join(map(texts.__getitem__, at[i:j]))[:-1] if good else b"" for i, j, good in zip(edge.tolist(), edge[1:].tolist(), ok.tolist())]
                    cols.append(pa.array(form, pa.binary()))
                    names.append("groups")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    yield from run(batches)
