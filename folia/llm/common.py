"""Shared helpers: the shared scratch folder, slicing of Arrow batches, packed
message blobs and connected components."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.session import scratch, ship

#: Bits of the largest bit map, and of one row of it.
MOST_BITS, ROW_BITS = 1 << 28, 1 << 18
#: A word is a run of bytes other than the space and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """A new folder name under the folder that all executors share."""
    return f"{scratch(spark)}/folia-{uuid.uuid4().hex}"


def written(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    ship(spark)
    path = shared_dir(spark)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def buckets(spark: SparkSession, per_partition: int = 4) -> int:
    """Number of hash buckets: follows the session's shuffle partitions."""
    return per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one slice holds about `limit` bytes of `column`; a longer row is a slice of its own."""
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        size = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = (np.cumsum(size + 64) - 1) // limit
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), n]
        for lo, hi in zip(edges, edges[1:]):
            yield b.slice(lo, hi - lo)


def raw(b: pa.RecordBatch, column: str) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return b.column(column).cast(pa.binary()).to_pylist()


def lean(run):
    """A function over Arrow batches that gives memory back to the system when its task ends; workers are used again by later stages."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def lean_group(run):
    """The same for a function over the Arrow tables of a group."""

    def wrapped(*tables: pa.Table) -> pa.Table:
        try:
            return run(*tables)
        finally:
            give_back()

    def one(table: pa.Table) -> pa.Table:
        return wrapped(table)

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        return wrapped(left, right)

    return one if run.__code__.co_argcount == 1 else two


def give_back() -> None:
    """Return freed memory of this worker to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def pack(**arrays: np.ndarray) -> bytes:
    """Equal-length integer arrays as one compressed blob, stored byte plane by byte plane."""
    parts = []
    for a in arrays.values():
        a = np.ascontiguousarray(a)
        parts.append(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(blob: bytes, kinds: Sequence[str]) -> list[np.ndarray]:
    """The arrays of pack(), given their dtypes in order."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    widths = [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(data) // sum(widths), 0, []
    for k, w in zip(kinds, widths):
        out.append(np.ascontiguousarray(data[at : at + n * w].reshape(w, n).T).view(k).reshape(n))
        at += n * w
    return out


def gather(blobs: Iterable[bytes | None], kinds: Sequence[str]) -> list[np.ndarray]:
    """All blobs of a group, concatenated."""
    got = [unpack(x, kinds) for x in blobs if x]
    if not got:
        return [np.empty(0, k) for k in kinds]
    return [np.concatenate(x) for x in zip(*got)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads entropy to all 64 bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def marked(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes are in a bit map."""
    at = h & np.uint64(8 * len(bits) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def bit_map(hashes: DataFrame) -> Broadcast:
    """Bit map of column h, 16 bits a row as long as that is at most MOST_BITS."""
    spark = hashes.sparkSession
    size = ROW_BITS
    n = hashes.count()
    while size < 16 * n and size < MOST_BITS:
        size *= 2

    @lean_group
    def fill(t: pa.Table) -> pa.Table:
        row = np.zeros(ROW_BITS, np.uint8)
        row[t.column("bit").to_numpy()] = 1
        return pa.table({"row": t.column("row")[:1], "bits": pa.array([np.packbits(row, bitorder="little").tobytes()], pa.binary())})

    at = F.col("h").bitwiseAND(F.lit(size - 1))
    spots = hashes.select(F.shiftright(at, 18).alias("row"), at.bitwiseAND(F.lit(ROW_BITS - 1)).cast("int").alias("bit"))
    got = spots.groupBy("row").applyInArrow(fill, "row long, bits binary").toArrow()
    out = np.zeros((size // ROW_BITS, ROW_BITS // 8), np.uint8)
    for r, b in zip(got["row"].to_pylist(), got["bits"].to_pylist()):
        out[r] = np.frombuffer(b, np.uint8)
    return spark.sparkContext.broadcast(out.reshape(-1))


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Boolean mask of length n: the union of [start, end)."""
    d = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(ends, minlength=n + 1)[: n + 1]
    return np.cumsum(d[:n]) > 0


def components(edges: DataFrame, hops: int = 3, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of `edges` (a, b long), by repeated contraction.

    Each round every node adopts that of the nodes within `hops` links with the smallest
    pseudo-random rank of the round; edges are rewritten between the adopted
    nodes until none is left. Then the rounds are followed from the last to the first. Only aggregates of one row reach the driver;
    each round is two written tables."""
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rounds = []
    while edges.take(1):
        if len(rounds) == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(len(rounds))).alias("h"), F.col(c).alias("v"))  # noqa: B023, E731
        ends = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).toDF("v", "w")
        best = ends.groupBy("v").agg(F.min(rank("w")).alias("m")).select("v", F.least("m", rank("v")).alias("m"))
        for _ in range(hops - 1):
            best = ends.join(best.toDF("w", "m"), "w").groupBy("v").agg(F.min("m").alias("m"))
        best = written(best.select("v", F.col("m")["v"].alias("p")))
        rounds.append(best)
        edges = written(
            edges.join(best.toDF("a", "pa"), "a").join(best.toDF("b", "pb"), "b").where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        )
    if not rounds:
        return edges.sparkSession.createDataFrame([], "node long, root long")
    labels = rounds.pop().toDF("node", "root")
    while rounds:
        later = labels.toDF("p", "root")
        labels = rounds.pop().toDF("node", "p").join(later, "p", "left").select("node", F.coalesce("root", "p").alias("root"))
    return written(labels)
