"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is turned by fast Hadamard pseudo-rotations (three rounds of random
signs and a Hadamard transform) and assigned to its nearest signed axis. Each table
has rotations of its own; `hashes` of them together name a bucket. A query looks
into the `probes` buckets that lie nearest to it in every table, and all that
it finds there is ranked by the exact cosine.

Work is dealt by table and bucket. A crowded bucket is cut into chunks, and queries go to
all its chunks; each chunk returns the best of each query only, and the chunks' best are merged.
Queries that find fewer rows than asked for are compared with all rows, in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folia.llm.common import written
from folia.session import ship

CHUNK = 400
#: Rows and queries of a block where all are compared.
BLOCK = (4096, 512)
FOUND = "query_id long, vec_id long, score double"


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, -1, 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    """The pseudo-rotation of this seed, of vectors padded to a power of two."""
    d = 1 << max(0, (x.shape[1] - 1).bit_length())
    y = np.zeros((len(x), d))
    y[:, : x.shape[1]] = x
    rng = np.random.Generator(np.random.PCG64(seed))
    for _ in range(3):
        y = _hadamard(y * rng.choice([-1.0, 1.0], size=d))
    return y


def _axes(y: np.ndarray) -> np.ndarray:
    """Values along all signed axes."""
    return np.concatenate((y, -y), axis=1)


def home(x: np.ndarray, seeds: list[int]) -> np.ndarray:
    """Bucket of each vector under the joined hashes."""
    out = np.zeros(len(x), np.int64)
    for s in seeds:
        a = _axes(rotated(x, s))
        out = out * a.shape[1] + a.argmax(axis=1)
    return out


def probed(x: np.ndarray, seeds: list[int], probes: int) -> np.ndarray:
    """The `probes` nearest buckets of each vector: by the sum of squared shortfalls along the axes."""
    n = len(x)
    cost, code = np.zeros((n, 1)), np.zeros((n, 1), np.int64)
    for s in seeds:
        a = _axes(rotated(x, s))
        near = np.argsort(-a, axis=1, kind="stable")[:, :probes]
        v = np.take_along_axis(a, near, 1)
        lack = (v[:, :1] - v) ** 2
        cost = (cost[:, :, None] + lack[:, None, :]).reshape(n, -1)
        code = (code[:, :, None] * a.shape[1] + near[:, None, :]).reshape(n, -1)
        best = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        cost, code = np.take_along_axis(cost, best, 1), np.take_along_axis(code, best, 1)
    return code


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a column of vectors, each scaled by a power of two."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    if not n:
        return np.zeros((0, 1))
    x = flat.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.float64)
    # a power of two for each row brings its largest component to between a half and one: no square over- or underflows, no digit changes
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, always summed in the same order."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def nearest(
    vectors: DataFrame, k: int = 5, every: int = 50, tables: int = 10, hashes: int = 1, probes: int = 10, seed: int = 11,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each query, nearest first; all rows if there are fewer than k.

    Queries are rows whose id is divisible by `every`; all rows but the query's own are indexed.
    score is the cosine in double precision; ties go to the smaller id. Rows with a null id, or a vector
    that is null, empty, zero or holds a null or a non-finite component take no part, nor do vectors of another
    length than the commonest (ties: the longest). Of rows with equal vectors only the k + 1 smallest ids can be among the
    nearest, so they are one row of the index. Rows that repeat an id and vector are one. For larger
    collections raise `hashes` to 2, with `tables` and `probes` to match: a bucket then has the share (2d)^-2 instead of (2d)^-1."""
    spark = vectors.sparkSession
    ship(spark)
    v = F.col(vector_col).cast("array<double>")
    sound = (
        F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    )
    rows = vectors.where(sound).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == lengths[0]["d"])
    # copies: the smallest ids of each vector; the hash only finds equal vectors sooner
    ordered = Window.partitionBy("h", "v").orderBy("id")
    copies = rows.distinct().withColumn("h", F.xxhash64("v")).withColumn("r", F.row_number().over(ordered)).where(F.col("r") <= k + 1)
    base = written(copies.groupBy("h", "v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select("v", "ids"))
    queries = written(rows.where(F.col("id") % every == 0).distinct())
    seeds = [[seed * 1_000_003 + t * 101 + h for h in range(hashes)] for t in range(tables)]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("v"))
            for t, s in enumerate(seeds):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, np.int32)), pa.array(home(x, s)), b.column("v"), b.column("ids")], names=["t", "bucket", "v", "ids"]
                )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("v"))
            for t, s in enumerate(seeds):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(home(x, s))], names=["t", "bucket"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("v"))
            for t, s in enumerate(seeds):
                code = probed(x, s, probes)
                at = pa.array(np.repeat(np.arange(len(x)), code.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(code.size, t, np.int32)), pa.array(code.reshape(-1)), b.column("v").take(at), b.column("id").take(at)], names=["t", "bucket", "v", "id"]
                )

    index = base.mapInArrow(put, "t int, bucket long, v array<double>, ids array<long>")
    crowd = written(base.select("v").mapInArrow(place, "t int, bucket long").groupBy("t", "bucket").agg(F.count("*").alias("n")))
    chunks = crowd.select("t", "bucket", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    left = index.join(chunks, ["t", "bucket"]).withColumn("chunk", F.pmod(F.xxhash64("v"), F.col("chunks")).cast("int")).select("t", "bucket", "chunk", "v", "ids")
    right = queries.mapInArrow(ask, "t int, bucket long, v array<double>, id long").join(chunks, ["t", "bucket"])
    right = right.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select("t", "bucket", "chunk", "v", "id")

    def compare(stored: pa.Table, asked: pa.Table) -> pa.Table:
        none = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not stored.num_rows or not asked.num_rows:
            return none
        x, q, ids = _matrix(stored.column("v")), _matrix(asked.column("v")), asked.column("id").to_numpy()
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        own = stored.column("ids").to_pylist()
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for lo in range(0, len(q), 512):
            part = q[lo : lo + 512]
            rough = (part / np.linalg.norm(part, axis=1, keepdims=True)) @ unit.T
            # a copy group may be the query's own alone, so one more is kept; rounding decides nothing
            bound = np.partition(rough, -(k + 1), axis=1)[:, -(k + 1)] if rough.shape[1] > k + 1 else np.full(len(part), -2.0)
            i, j = np.nonzero(rough >= bound[:, None] - 1e-9)
            exact = cosine(part[i], x[j])
            size = np.fromiter((len(own[g]) for g in j), np.int64, len(j))
            out.append((np.repeat(ids[lo + i], size), np.array([y for g in j for y in own[g]], np.int64), np.repeat(exact, size)))
        a, b, s = (np.concatenate(y) for y in zip(*out))
        ok = a != b
        a, b, s = a[ok], b[ok], s[ok]
        o = np.lexsort((b, -s, a))
        a, b, s = a[o], b[o], s[o]
        start = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else np.zeros(0, np.int64)
        place = np.arange(len(a)) - np.repeat(start, np.diff(np.concatenate((start, [len(a)]))))
        top = place < k
        return pa.table({"query_id": a[top], "vec_id": b[top], "score": s[top]})

    found = left.groupBy("t", "bucket", "chunk").cogroup(right.groupBy("t", "bucket", "chunk")).applyInArrow(compare, FOUND)
    merged = written(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    enough = merged.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k).select(F.col("query_id").alias("id"))
    short = written(queries.join(enough, "id", "left_anti").select("id", "v"))
    if n_short := short.count():
        n_rows, n_asked = (-(-n // b) for n, b in zip((base.count(), n_short), BLOCK))
        block = lambda n: F.pmod(F.xxhash64("v"), F.lit(n)).cast("int")
        every_block = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        rows_of = base.select(block(n_rows).alias("b"), every_block(n_asked).alias("q"), "v", "ids").groupBy("b", "q")
        asked_of = short.select(every_block(n_rows).alias("b"), block(n_asked).alias("q"), "v", "id").groupBy("b", "q")
        whole = rows_of.cogroup(asked_of).applyInArrow(compare, FOUND)
        merged = merged.union(whole).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return merged.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
