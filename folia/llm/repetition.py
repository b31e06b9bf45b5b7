"""Quality rules with repetition found by suffix ranks and longest common prefixes.

Texts are word sequences. For every position the longest word sequence that
starts there and occurs again in the same text is found from the suffix order
(ranks by prefix doubling, refined only where a prefix still repeats) and the
common prefix of neighbours in it: the deepest LCP interval that holds the
suffix. The spans of all repeats of at least `min_repeat` words are united."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folia.llm.common import covered, lean, raw, slices
from folia.session import ship

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, covered_fraction double, longest_repeat long, spans array<struct<start:int,end:int>>"
)
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"


def _regroup(order: np.ndarray, key: np.ndarray, base: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of sorted keys. base: the rank that each element's group had before (contiguous in `order`)."""
    n = len(order)
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(key[1:], key[:-1], out=new[1:])
    at = np.arange(n)
    start = np.maximum.accumulate(np.where(new, at, 0))
    if base is None:
        rank = start
    else:
        lead = np.empty(n, bool)
        lead[0] = True
        np.not_equal(base[1:], base[:-1], out=lead[1:])
        rank = base + start - np.maximum.accumulate(np.where(lead, at, 0))
    single = new.copy()
    single[:-1] &= new[1:]
    return rank, ~single


def suffix_repeats(ids: np.ndarray, doc: np.ndarray, ends: np.ndarray, min_repeat: int) -> tuple[np.ndarray, np.ndarray]:
    """For word ids of texts laid end to end (`doc`: text of each word, `ends`: end of
    its text) return the mask of words in repeated 3-word windows, and for each
    position the longest repeat of at least min_repeat words that starts there (else 0)."""
    n = len(ids)
    longest = np.zeros(n, np.int64)
    if not n:
        return np.zeros(0, bool), longest
    key = doc * (np.int64(ids.max()) + 1) + ids
    order = np.argsort(key, kind="stable")
    rank, many = _regroup(order, key[order], None)
    first = np.full(n + 1, -1, np.int64)
    first[order] = rank
    levels = [first]
    active = order[many]
    three = np.zeros(n, bool)
    h = 1
    while len(active):
        last = levels[-1]
        to = active + h
        nxt = np.where(to < ends[active], last[np.minimum(to, n)], -1)
        base = last[active]
        key = base * (n + 1) + nxt + 1
        by = np.argsort(key, kind="stable")
        rank, many = _regroup(by, key[by], base[by])
        ranks = last.copy()
        moved = active[by]
        ranks[moved] = rank
        levels.append(ranks)
        active = moved[many]
        h *= 2
        if h == 2 and len(active):
            ok = active[active + 2 < ends[active]]
            key3 = ranks[ok] * (n + 1) + first[ok + 2]
            o3 = np.argsort(key3, kind="stable")
            _, again = _regroup(o3, key3[o3], None) if len(o3) else (None, np.zeros(0, bool))
            starts = ok[o3[again]]
            three = covered(n, starts, starts + 3)
    # suffixes whose prefix of `power` words repeats, in suffix order
    power = 1
    depth = 0
    while power * 2 <= min_repeat:
        power *= 2
        depth += 1
    if depth >= len(levels):
        return three, longest
    at_power, final = levels[depth], levels[-1]
    some = np.flatnonzero(np.bincount(at_power[:n], minlength=n)[at_power[:n]] > 1)
    sa = some[np.argsort(final[some], kind="stable")]
    i, j = sa[:-1], sa[1:]
    same = at_power[i] == at_power[j]
    i, j = i[same], j[same]
    common = np.zeros(len(i), np.int64)
    for d in range(len(levels) - 1, -1, -1):
        a, b = np.minimum(i + common, n), np.minimum(j + common, n)
        hit = (levels[d][a] == levels[d][b]) & (a < n) & (b < n)
        common += np.where(hit, 1 << d, 0)
    common = np.where(common >= min_repeat, common, 0)
    np.maximum.at(longest, i, common)
    np.maximum.at(longest, j, common)
    return three, longest


def quality_rules(
    docs: DataFrame,
    min_repeat: int = 8,
    max_covered: float = 0.3,
    max_repeat: int = 60,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """Counts, repeated spans (in words) and the verdict for every whole text.

    kept is false where the base rule fails (under 50 words, or over half the
    words lie in 3-word windows found twice or more), where repeats of at least
    min_repeat words cover more than max_covered of the words, or where one
    repeat is longer than max_repeat words. A null text has no words. Rows are
    judged one by one: repeated rows give repeated results, other columns are
    ignored, an empty table gives an empty one."""
    ship(docs.sparkSession)

    @lean
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        char = np.ones(256, bool)
        char[0x80:0xC0] = False
        char[list(SPACES)] = False
        symbol = np.zeros(256, bool)
        symbol[list(SYMBOLS)] = True
        for b in slices(batches, "text"):
            texts = [t or b"" for t in raw(b, "text")]
            words = [t.split() for t in texts]
            counts = np.fromiter(map(len, words), np.int64, len(words))
            flat = [w for x in words for w in x]
            known = {w: i for i, w in enumerate(dict.fromkeys(flat))}
            ids = np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))
            stop = np.cumsum(counts)
            doc = np.repeat(np.arange(len(counts)), counts)
            three, longest = suffix_repeats(ids, doc, np.repeat(stop, counts), min_repeat)
            pos = np.flatnonzero(longest)
            mask = covered(len(ids), pos, pos + longest[pos])
            u8 = np.frombuffer(b"".join(texts) + b" ", np.uint8)
            size = np.fromiter(map(len, texts), np.int64, len(texts))
            to = np.cumsum(size)
            per = lambda m, e, c: (x := np.concatenate(([0], np.cumsum(m))))[e] - x[e - c]
            lines = [[y for y in t.split(b"\n") if y.strip()] for t in texts]
            repeat_words, cover = per(three, stop, counts), per(mask, stop, counts)
            top = np.zeros(len(counts), np.int64)
            np.maximum.at(top, doc[pos], longest[pos])
            failed = (counts < 50) | (100 * repeat_words > 50 * counts)
            share = cover / np.maximum(counts, 1)
            edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
            spans: list[list[dict]] = [[] for _ in texts]
            for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
                while s < e:  # a run may cross into the next text
                    d = int(doc[s])
                    z = min(e, int(stop[d]))
                    lo = int(stop[d] - counts[d])
                    spans[d].append({"start": s - lo, "end": z - lo})
                    s = z
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"), pa.array(counts), pa.array(per(char[u8], to, size)), pa.array(per(symbol[u8], to, size)),
                    pa.array([len(x) - len(set(x)) for x in lines], pa.int64()), pa.array(repeat_words), pa.array(failed),
                    pa.array(~failed & (share <= max_covered) & (top <= max_repeat)), pa.array(share), pa.array(top),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ],
                names=[x.split()[0] for x in SCHEMA.split(", ")],
            )

    from pyspark.sql import functions as F

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(measure, SCHEMA)
