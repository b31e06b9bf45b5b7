"""Byte-level BPE with a pair occurrence index.

Whole texts are cut into pre-tokens by the vocabulary's own pattern. The distinct
pre-tokens of a slice that were not met before are encoded together: every pair is
mapped to all its positions among them, ranks are applied in ascending order, and
each merge updates the lists of the pairs beside it. Encoded units are remembered
in the worker as id strings, and a text is their concatenation."""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folia.llm.common import lean, slices
from folia.session import ship

#: Pre-token pattern of the vocabulary; white space as Unicode has it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
_SPLIT = regex.compile(PATTERN)
_SPACED = re.compile(r" \s")
#: One space between letters: a pre-token always begins there.
_BETWEEN = regex.compile(r"(?<=\p{L}) (?=\p{L})")
#: Bytes of units and their ids kept in a worker, as they lie in memory; beyond that they are forgotten, which costs time only.
MEMORY = 48 << 20
#: A unit costs about this much besides its own bytes and ids.
UNIT = 230
#: Bytes of text encoded at once, ids decoded at once, and characters of a long text cut at once.
SLICE = 1 << 20
IDS = 1 << 18
LONG = 1 << 19


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes: printable Latin-1 stands for itself, the rest for code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Merges by id, bytes by id, and special strings of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.pieces: dict[int, bytes] = {i: bytes(alphabet[c] for c in s) for s, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces |= {i: s.encode() for s, i in self.special.items()}
        self.single = [0] * 256
        for i, p in self.pieces.items():
            if len(p) == 1 and i not in self.special.values():
                self.single[p[0]] = i
        self.rank: dict[int, int] = {}
        self.merges: list[tuple[int, int, int]] = []
        for a, b in spec["model"]["merges"]:
            x, y = vocab[a], vocab[b]
            self.rank[x << 20 | y] = len(self.merges)
            self.merges.append((x, y, vocab[a + b]))
        self.single_ids = np.array(self.single, np.int32)
        self.first_rank = np.full((256, 256), -1, np.int32)
        byte_of = {i: c for c, i in enumerate(self.single)}
        for r, (x, y, _) in enumerate(self.merges):
            if x in byte_of and y in byte_of:
                self.first_rank[byte_of[x], byte_of[y]] = r
        self.cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    def encode_units(self, units: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each unit, by the pair occurrence index over all of them.

        where: for each active rank the positions of its pair, as arrays and as single numbers. A rank with many positions
        is applied to all at once, one with few position by position; both work on the same memory."""
        raw = np.frombuffer(b"".join(units), np.uint8)
        n = len(raw)
        size = np.fromiter(map(len, units), np.int64, len(units))
        end = np.cumsum(size)
        s_ = array("i", self.single_ids[raw].tobytes())
        n_, p_ = array("i", np.arange(1, n + 1, dtype=np.int32).tobytes()), array("i", np.arange(-1, n - 1, dtype=np.int32).tobytes())
        sym, nxt, prv = (np.frombuffer(x, np.int32) if n else np.zeros(0, np.int32) for x in (s_, n_, p_))
        stop = end[size > 0]
        nxt[stop - 1] = -1
        prv[stop[stop < n]] = -1
        merges, get = self.merges, self.rank.get
        many: dict[int, list[np.ndarray]] = {}
        few: dict[int, list[int]] = {}
        if n > 1:
            first = self.first_rank[raw[:-1], raw[1:]]
            first[nxt[:-1] < 0] = -1
            spots = np.flatnonzero(first >= 0)
            ranks = first[spots]
            order = np.argsort(ranks, kind="stable")
            spots, ranks = spots[order], ranks[order]
            cut = np.flatnonzero(np.diff(ranks)) + 1
            for r, x in zip(ranks[np.concatenate(([0], cut))].tolist() if len(ranks) else [], np.split(spots, cut)):
                many[r] = [x]
        active = list(many)
        heapify(active)

        def note(r: int, x: np.ndarray) -> None:
            if r in many:
                many[r].append(x)
            else:
                many[r] = [x]
                if r not in few:
                    heappush(active, r)

        while active:
            r = heappop(active)
            a, b, made = merges[r]
            arrays, single = many.pop(r, []), few.pop(r, [])
            if a != b and sum(map(len, arrays)) + len(single) >= 40:
                i = np.concatenate([*arrays, np.array(single, np.int64)])
                j = nxt[i]
                ok = (sym[i] == a) & (j >= 0)
                i, j = i[ok], j[ok]
                ok = sym[j] == b
                i, j = i[ok], j[ok]
                k = nxt[j]
                sym[i], sym[j], nxt[i] = made, -1, k
                inner = k >= 0
                prv[k[inner]] = i[inner]
                p = prv[i]
                left = p >= 0
                left[left] = sym[p[left]] != made  # such a pair is noted from its left end
                key = np.concatenate((made << 20 | sym[k[inner]].astype(np.int64), sym[p[left]].astype(np.int64) << 20 | made))
                at = np.concatenate((i[inner], p[left]))
                if len(key):
                    order = np.argsort(key, kind="stable")
                    key, at = key[order], at[order]
                    cut = np.flatnonzero(np.diff(key)) + 1
                    starts = [0, *cut.tolist(), len(key)]
                    for q, lo, hi in zip(key[starts[:-1]].tolist(), starts, starts[1:]):
                        if (q := get(q)) is not None:
                            note(q, at[lo:hi])
                continue
            for x in arrays:
                single += x.tolist()
            if a == b:
                single.sort()
            for i in single:
                if s_[i] != a or (j := n_[i]) < 0 or s_[j] != b:
                    continue
                s_[i] = made
                s_[j] = -1
                k = n_[i] = n_[j]
                if k >= 0:
                    p_[k] = i
                    if (q := get(made << 20 | s_[k])) is not None:
                        if q in few:
                            few[q].append(i)
                        else:
                            few[q] = [i]
                            if q not in many:
                                heappush(active, q)
                p = p_[i]
                if p >= 0 and (q := get(s_[p] << 20 | made)) is not None:
                    if q in few:
                        few[q].append(p)
                    else:
                        few[q] = [p]
                        if q not in many:
                            heappush(active, q)
        left = sym >= 0
        ids = sym[left].astype("<u4").tobytes()
        to = (4 * np.concatenate(([0], np.cumsum(left)))[np.concatenate(([0], end))]).tolist()
        return [ids[lo:hi] for lo, hi in zip(to, to[1:])]


class Encoder:
    """Encodes whole texts to little-endian 32-bit ids, with a memory of units."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.plain: dict[str, bytes] = {}  # a unit at the start of a text, or a pre-token
        self.spaced: dict[str, bytes] = {}  # a unit after one space
        self.held = 0
        self.whole_words = not any(" " in s for s in vocabulary.special)
        known = [self.v.pieces.get(i, b"") for i in range(max(self.v.pieces) + 1)]
        self.piece_size = np.array([len(x) for x in known], np.int64)
        self.piece_start = np.cumsum(self.piece_size) - self.piece_size
        self.piece_bytes = np.frombuffer(b"".join(known), np.uint8)

    def forget(self) -> None:
        self.plain, self.spaced, self.held = {}, {}, 0

    def _learn(self, plain: set[str], spaced: set[str]) -> None:
        """Encode units; a unit of letters alone is one pre-token, others are cut, and their pre-tokens are units too."""
        cut = [(0, u, [u] if u.isalpha() else _SPLIT.findall(u)) for u in plain] + [(1, u, [" " + u] if u.isalpha() else _SPLIT.findall(" " + u)) for u in spaced]
        new = []
        for t in dict.fromkeys([t for _, _, x in cut for t in x]):
            if not (t[1:] in self.spaced if len(t) > 1 and t[0] == " " else t in self.plain):
                new.append(t)
        for t, ids in zip(new, self.v.encode_units([t.encode() for t in new])):
            if len(t) > 1 and t[0] == " ":
                self.spaced[t[1:]] = ids
            else:
                self.plain[t] = ids
            self.held += len(t) + len(ids) + UNIT
        for after, u, x in cut:
            if u not in (self.spaced if after else self.plain):
                (self.spaced if after else self.plain)[u] = b"".join([self.spaced[t[1:]] if len(t) > 1 and t[0] == " " else self.plain[t] for t in x])
                self.held += 2 * len(u) + UNIT

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. A long text is encoded in stretches that end where a pre-token ends."""
        if self.whole_words and max(map(len, texts), default=0) > LONG:
            return [b"".join(self._encode([s])[0] for s in _stretches(t)) if len(t) > LONG else self._encode([t])[0] for t in texts]
        return self._encode(texts)

    def _encode(self, texts: list[str]) -> list[bytes]:
        if self.held > MEMORY:
            self.forget()
        jobs: list[tuple[str, list[str]]] = []
        shape: list[list] = []
        for t in texts:
            parts: list = []
            for s in self.v.cut.split(t) if self.v.cut else [t]:
                if s in self.v.special:
                    parts.append(np.array([self.v.special[s]], "<u4").tobytes())
                elif s:
                    # a space before white space joins a longer run, so such texts are cut by the pattern alone
                    jobs.append(("plain", _SPLIT.findall(s)) if _SPACED.search(s) else ("spaced", s.split(" ")))
                    parts.append(len(jobs) - 1)
            shape.append(parts)
        plain: set[str] = set()
        spaced: set[str] = set()
        for kind, units in jobs:
            if kind == "plain":
                plain.update(units)
            else:
                plain.add(units[0])
                spaced.update(units[1:])
        plain -= self.plain.keys()
        spaced -= self.spaced.keys()
        if plain or spaced:
            self._learn(plain, spaced)
        done = []
        for kind, units in jobs:
            if kind == "plain":
                done.append(b"".join(map(self.plain.__getitem__, units)))
            else:
                done.append(self.plain[units[0]] + b"".join(map(self.spaced.__getitem__, units[1:])))
        return [b"".join(p if isinstance(p, bytes) else done[p] for p in parts) for parts in shape]

    def decode_all(self, ids: list[bytes]) -> list[bytes]:
        """Texts of id strings in UTF-8, gathered from the vocabulary's bytes by runs of ids; what is not UTF-8 becomes U+FFFD."""
        flat = np.frombuffer(b"".join(ids), "<u4")
        parts, ends = [], [np.zeros(1, np.int64)]
        for at in range(0, len(flat), IDS):
            run = flat[at : at + IDS]
            size = self.piece_size[run]
            end = np.cumsum(size)
            parts.append(self.piece_bytes[np.repeat(self.piece_start[run] - (end - size), size) + np.arange(int(end[-1]))].tobytes())
            ends.append(end + ends[-1][-1])
        data = b"".join(parts)
        last = np.cumsum(np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids)))
        to = np.concatenate(ends)[np.concatenate(([0], last))].tolist()
        out = []
        for lo, hi in zip(to, to[1:]):
            x = data[lo:hi]
            try:
                x.decode()
            except UnicodeDecodeError:
                x = x.decode("utf-8", "replace").encode()
            out.append(x)
        return out


def _stretches(t: str) -> Iterator[str]:
    """Parts of about LONG characters, each but the first from a single space between letters. Only for vocabularies whose special strings hold no space."""
    lo = 0
    while len(t) - lo > LONG:
        m = _BETWEEN.search(t, lo + LONG)
        if not m:
            break
        yield t[lo : m.start()]
        lo = m.start()
    yield t[lo:]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each file in a worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(Vocabulary(path))
    return _encoders[path]


def encode_decode(
    docs: DataFrame, vocab_path: str, text_col: str = "text", keep: list[str] | None = None, with_ids: bool = True, with_text: bool = False
) -> DataFrame:
    """Columns `keep` with n_tokens, ids_sha256, decoded_sha256 and, on demand, the ids and the decoded text.

    Every whole text is encoded (null: as an empty one) and its ids are decoded again. The
    vocabulary file has to be at `vocab_path` on every machine. Rows are independent: ties and repeated rows give equal
    results, an empty table gives an empty one. Texts of any length are taken whole, a long one in stretches of LONG characters. Columns not in `keep` are ignored; those in it
    may have any name, but where the result has a column of that name too, both are there, the kept one first."""
    ship(docs.sparkSession)
    keep = keep or ["doc_id"]
    made = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids + ["decoded"] * with_text
    # kept columns take numbers for names, so that none clashes
    frame = docs.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keep)], F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    names = [*(f"k{i}" for i in range(len(keep))), *(f"m{i}" for i in range(len(made)))]

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(vocab_path)
        try:
            for b in slices(batches, "text", SLICE):
                ids = tool.encode(b.column("text").to_pylist())
                texts = tool.decode_all(ids)
                cols = [
                    *b.columns[: len(keep)],
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
                ]
                if with_ids:
                    ends = np.cumsum([0, *(len(x) // 4 for x in ids)])
                    cols.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4"))))
                if with_text:
                    cols.append(pa.array(texts, pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=names)
        finally:
            tool.forget()

    kinds = [*(docs.schema[k].dataType for k in keep), T.LongType(), T.StringType(), T.StringType()]
    kinds += [T.ArrayType(T.IntegerType())] * with_ids + [T.StringType()] * with_text
    out = frame.mapInArrow(run, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)]))
    return out.toDF(*keep, *made)
