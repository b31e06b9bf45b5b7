"""Extraction in rounds that go on as long as they find something new."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.plans.runtime import materialize

# What the default looks for, one kind a round.
ROUNDS = (
    ("name", r"[a-z,;] ([A-Z][a-z]+)"), ("address", r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})"), ("code", r"\b([0-9a-f]{16,})\b"),
    ("number", r"\b([0-9]{3,})\b"), ("acronym", r"\b([A-Z]{2,})\b"),
)

# Java's \b takes letters and digits of all scripts for parts of a word before version 19 and not after it; this edge knows ASCII alone, as the SQL does.
EDGE = r"(?:(?<![0-9A-Za-z_])(?=[0-9A-Za-z_])|(?<=[0-9A-Za-z_])(?![0-9A-Za-z_]))"

Extract = Callable[[DataFrame, int], DataFrame]


def by_pattern(chunks: DataFrame, n: int) -> DataFrame:
    """(chunk_id, kind, record) of the n-th kind of ROUNDS: names, addresses, codes, numbers, acronyms; nothing beyond."""
    if n >= len(ROUNDS):
        return chunks.select("chunk_id", F.lit("").alias("kind"), F.lit("").alias("record")).limit(0)
    kind, pattern = ROUNDS[n]
    pattern = pattern.replace(r"\b", EDGE)
    return chunks.select("chunk_id", F.lit(kind).alias("kind"), F.explode(F.regexp_extract_all("text", F.lit(pattern), 1)).alias("record"))


def glean(chunks: DataFrame, extract: Extract = by_pattern, most_rounds: int = 3, patience: int = 1) -> DataFrame:
    """(chunk_id, kind, record, round): records of each chunk (chunk_id, text), each in the round that found it first.

    extract gives records (chunk_id, kind, record) of the chunks of a round, counted from 0; it may look at the round to search otherwise than before. A chunk goes on to the next round if one of its last `patience` rounds
    found a record that none before had, so the frontier shrinks; after `most_rounds` all end. Each round reads the texts of its frontier only and writes its new records and the chunks that stay."""
    front = chunks.select("chunk_id", "text")
    known, idle = None, chunks.select("chunk_id", F.lit(0).alias("idle"))
    for n in range(most_rounds):
        found = extract(front, n).select("chunk_id", "kind", "record").distinct()
        if known is not None:
            found = found.join(known, ["chunk_id", "kind", "record"], "left_anti")
        fresh = materialize(found.withColumn("round", F.lit(n)))
        known = fresh if known is None else known.unionByName(fresh)
        if n + 1 == most_rounds:
            break
        hit = fresh.select("chunk_id").distinct().withColumn("_hit", F.lit(True))
        idle = materialize(idle.join(hit, "chunk_id", "left").select("chunk_id", F.when(F.col("_hit"), F.lit(0)).otherwise(F.col("idle") + 1).alias("idle")).where(F.col("idle") < patience))
        if not idle.take(1):
            break
        front = chunks.select("chunk_id", "text").join(idle.select("chunk_id"), "chunk_id", "left_semi")
    return known
