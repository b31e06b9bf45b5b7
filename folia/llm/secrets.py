"""Secret scans with corpus-wide ownership.

Patterns find spans of three kinds. Besides, runs of characters that look like a credential are candidates. The values of
all are known by a digest only, and for each digest the distinct repositories and owners that hold it are counted over the
corpus: a value that many owners hold is a copied example; a candidate that one owner alone holds looks live and is
added to the spans. The patterns' own spans always stay."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.llm.common import lean, raw, slices, written
from folia.session import ship

# Kinds in their order, and the patterns of the first three.
KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
HEX = re.compile(rb"[0-9a-f]{24,}")
#: What looks like a credential: a run of these with some digits and letters and many different characters.
LOOKS = re.compile(rb"[A-Za-z0-9+/_=-]{20,}")
DIGITS, LETTERS, DIFFERENT = 3, 3, 10
#: Words without which no assignment matches.
NAMES = (b"passw", b"secret", b"token", b"api")
LEAST_VALUE = 6


def _class(chars: bytes) -> bytes:
    """A table that maps a class of bytes to x and all others to a space."""
    return bytes(120 if c in chars else 32 for c in range(256))


_ALNUM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_HEX, _LOOKS = _class(b"0123456789abcdef"), _class(_ALNUM + b"+/_=-")
_DIGIT, _LETTER = _ALNUM[:10], _ALNUM[10:]


def spans_of(text: bytes) -> list[tuple[int, int, int, bytes]]:
    """(start, kind, end, value) in bytes; kind 3 are candidates, none of which touches another span."""
    out = []
    low = text.lower()
    if any(n in low for n in NAMES):
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if b"AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    if b"x" * 24 in text.translate(_HEX):
        out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    if b"x" * 20 in text.translate(_LOOKS):
        taken = sorted((s, e) for s, _, e, _ in out)
        ends = np.maximum.accumulate(np.array([e for _, e in taken], np.int64)) if taken else np.zeros(0, np.int64)
        starts = np.array([s for s, _ in taken], np.int64)
        for m in LOOKS.finditer(text):
            v = m[0]
            before = int(np.searchsorted(starts, m.end()))  # spans that start before its end
            if before and ends[before - 1] > m.start():
                continue
            if len(v) - len(v.translate(None, _DIGIT)) >= DIGITS and len(v) - len(v.translate(None, _LETTER)) >= LETTERS and len(set(v)) >= DIFFERENT:
                out.append((m.start(), 3, m.end(), v))
    return sorted(out)


def _in_characters(text: bytes, spans: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int, int, bytes]]:
    if not spans or text.isascii():
        return spans
    first = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    before = np.concatenate(([0], np.cumsum(first)))
    return [(int(before[s]), k, int(before[e]), v) for s, k, e, v in spans]


def find_spans(docs: DataFrame, keep: list[str], text_col: str, repo_col: str, owner_col: str) -> DataFrame:
    """(row, k0, k1, ... for the columns kept, repo, owner, spans): spans are (start, kind, end, digest of the value), in order."""
    ship(docs.sparkSession)
    names = [f"k{i}" for i in range(len(keep))]
    frame = docs.select(
        F.monotonically_increasing_id().alias("row"), *[F.col(k).alias(n) for n, k in zip(names, keep)],
        F.col(repo_col).cast("string").alias("repo"), F.col(owner_col).cast("string").alias("owner"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("value", pa.binary())])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            got = [_in_characters(t, spans_of(t)) for t in raw(b, "text")]
            found = [[{"start": s, "kind": k, "end": e, "value": hashlib.sha256(v).digest()[:16]} for s, k, e, v in x] for x in got]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found, pa.list_(span))], names=[*b.schema.names[:-1], "spans"])

    kinds = "".join(f"{n} {docs.schema[k].dataType.simpleString()}, " for n, k in zip(names, keep))
    return frame.mapInArrow(run, f"row long, {kinds}repo string, owner string, spans array<struct<start: int, kind: int, end: int, value: binary>>")


def ownership(found: DataFrame) -> DataFrame:
    """(value, n_repos, n_owners): distinct repositories and owners of each value; a null one is one more."""
    held = found.select("repo", "owner", F.explode("spans.value").alias("value"))
    who = F.explode(F.array(*[F.struct(F.lit(c == "repo").alias("is_repo"), F.col(c).alias("name")) for c in ("repo", "owner")]))
    # one row a holder first, so that a value in a third of all rows is counted by many tasks
    once = held.select("value", who.alias("who")).select("value", "who.*").distinct()
    return once.groupBy("value").agg(F.count_if("is_repo").alias("n_repos"), F.count_if(~F.col("is_repo")).alias("n_owners"))


SPAN = "struct<start: int, kind: int, end: int, n_repos: bigint, n_owners: bigint>"


def scan_secrets(docs: DataFrame, text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source", keep: list[str] | None = None, max_owners: int = 1) -> DataFrame:
    """Columns `keep` with spans: an array of (start, kind, end, n_repos, n_owners) in order of start, then kind.

    Offsets are in characters, ends exclusive; kind counts KINDS from 0. The first three are those of the patterns, leftmost and not overlapping in each kind. `owned` are
    runs that look like credentials, touch no span of a pattern, and are held by at most `max_owners` owners. n_repos and n_owners say how many distinct repositories and
    owners hold the value of a span, so widely copied examples can be told from credentials of one owner.

    Null and empty texts have no spans; texts of any length are taken whole. A null repository or owner is a repository or owner of its own. A row for each row of docs: repeated rows give equal rows and are one
    holder if their repository is the same; an empty table gives an empty one. Columns not kept are ignored; kept ones may have any name (`spans` is then there twice, the kept one first)."""
    keep = keep or ["doc_id"]
    names = [f"k{i}" for i in range(len(keep))]
    found = written(find_spans(docs, keep, text_col, repo_col, owner_col))
    some = found.where(F.size("spans") > 0)
    known = ownership(some)
    each = some.select("row", F.explode("spans").alias("s")).select("row", "s.*").join(known, "value").where((F.col("kind") < 3) | (F.col("n_owners") <= max_owners))
    lists = each.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "n_repos", "n_owners"))).alias("judged"))
    none = F.array().cast(f"array<{SPAN}>")
    judged = some.select("row", *names).join(lists, "row", "left").select(*names, F.coalesce("judged", none).alias("spans"))
    rest = found.where(F.size("spans") == 0).select(*names, none.alias("spans"))
    return judged.unionByName(rest).toDF(*keep, "spans")
