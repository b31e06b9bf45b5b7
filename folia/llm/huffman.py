"""Token ids as binary blocks under a canonical, length-limited Huffman code.

The ids of all documents, each with an end id, are counted over the corpus; code
lengths come from package-merge, so that none exceeds 16 bits, and codes are
canonical: only the lengths are stored. Documents are put in ascending order of id over
range partitions and written as independent blocks of whole documents. A
block has the bits, the documents' lengths and the bit offset of every
CHECKPOINT-th id, so that its parts decode side by side, by one table of 2^16 entries.

Format, a folder: `blocks` (Parquet, a row for each block: part, block, doc_ids,
doc_lengths, n_ids, checkpoints, bits) and `code` (Parquet: id, length)."""

from __future__ import annotations

import os
import struct
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folia.llm.bpe import byte_alphabet
from folia.llm.common import lean, raw, shared_dir, slices, written
from folia.session import ship

LIMIT = 16
CHECKPOINT = 128
BLOCK_IDS = 1 << 18
#: Words kept with their ids in a worker; beyond that the memory is emptied.
MEMORY = 1_000_000

#: Ids in between are 16 bits wide; vocabularies are smaller than that.
WIDTH = "<u2"


class Words(dict):
    """Ids of words, each encoded by the tokenizers library when it is first asked for.

    A word of lower-case letters is one pre-token, so it goes to the library's BPE model straight, without
    normaliser and pattern; so do its letters where one punctuation mark follows. All else takes the whole way."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        self.tool.no_truncation()
        self.tool.no_padding()
        if self.tool.get_vocab_size() > 1 << 16 or sys.byteorder != "little":
            raise ValueError("ids are taken as 16 bits, low byte first")
        self.tokenize = self.tool.model.tokenize
        self.marks = {bytes((c,)) for c in b",.;:!?"}
        self.char = {b: c for c, b in byte_alphabet().items()}

    def __missing__(self, word: bytes) -> bytes:
        if word.isalpha() and word.islower():  # ASCII letters
            out = array("H", [t.id for t in self.tokenize(word.decode())]).tobytes()
        elif (mark := word[-1:]) in self.marks and word[:-1].decode("utf-8", "replace").isalpha():
            out = self[word[:-1]] + self[mark]
        else:
            s = word.decode("utf-8", "replace")
            if s.isalpha() and s == s.lower() and unicodedata.is_normalized("NFC", s):
                out = array("H", [t.id for t in self.tokenize("".join(map(self.char.__getitem__, word)))]).tobytes()
            else:
                out = array("H", self.tool.encode(s, add_special_tokens=False).ids).tobytes()
        self[word] = out
        return out


_tools: dict[str, Words] = {}


def tokenized(docs: DataFrame, vocab_path: str, end_id: int, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, ids binary, counts array): little-endian 16-bit ids of the whole text and the end id.

    Besides the documents, each task gives one row with ids null and counts: how often each id stands in what it read.

    For vocabularies whose normaliser lower-cases and whose pattern treats white space as a mere
    separator: words between ASCII white space are encoded apart and remembered in the worker."""
    ship(docs.sparkSession)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _tools.setdefault(vocab_path, None) or Words(vocab_path)
        _tools[vocab_path] = known
        end = struct.pack("<H", end_id)
        get = known.__getitem__
        total = np.zeros(1 << 16, np.int64)
        for b in slices(batches, "text"):
            if len(known) > MEMORY:
                known.clear()
            # special strings are matched before lower-casing, so texts that may hold one keep their case
            words = [(t.lower() if b"<|" not in t else t).split() for t in (x or b"" for x in raw(b, "text"))]
            ids = [b"".join(map(get, w)) + end for w in words]
            total += np.bincount(np.frombuffer(b"".join(ids), WIDTH), minlength=1 << 16)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.binary()), pa.nulls(len(ids), pa.list_(pa.int64()))], names=["doc_id", "ids", "counts"])
        if total.any():
            last = total[: np.flatnonzero(total)[-1] + 1]
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([last], pa.list_(pa.int64()))], names=["doc_id", "ids", "counts"])

    frame = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return frame.mapInArrow(run, "doc_id long, ids binary, counts array<long>")


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most `limit` bits by package-merge; 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) == 1:
        lengths[used] = 1
    if len(used) < 2:
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    w = counts[order].astype(np.int64)
    n = len(w)
    weights, is_leaf = w, [np.ones(n, bool)]
    for _ in range(limit - 1):
        even = len(weights) // 2 * 2
        packages = weights[0:even:2] + weights[1:even:2]
        both = np.concatenate((w, packages))
        by = np.argsort(both, kind="stable")
        weights = both[by]
        is_leaf.append(by < n)
    take, ordered = 2 * n - 2, np.zeros(n, np.int64)
    for leaf in reversed(is_leaf):
        mine = int(leaf[:take].sum())
        ordered[:mine] += 1
        take = 2 * (take - mine)
    lengths[order] = ordered
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes = np.zeros(len(lengths), np.uint32)
    code, last = 0, 0
    for i in sorted(np.flatnonzero(lengths).tolist(), key=lambda i: (int(lengths[i]), i)):
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def decode_table(lengths: np.ndarray) -> np.ndarray:
    """For each value of the next LIMIT bits id * 32 + length of the code that stands there."""
    codes = canonical_codes(lengths)
    table = np.zeros(1 << LIMIT, np.uint32)
    for i in np.flatnonzero(lengths).tolist():
        n = int(lengths[i])
        lo = int(codes[i]) << (LIMIT - n)
        table[lo : lo + (1 << (LIMIT - n))] = i * 32 + n
    return table


def encode_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, run: int = 1 << 14) -> tuple[bytes, np.ndarray]:
    """The bit string of ids, and the bit offset of every CHECKPOINT-th id.

    Codes are placed in cells of 32 bits, each in a 64-bit window over its cell and the next. Runs keep the arrays small."""
    size8 = lengths.astype(np.uint8)
    left = (codes.astype(np.uint64) << (np.uint64(64) - np.maximum(lengths, 1).astype(np.uint64))) if len(codes) else np.zeros(0, np.uint64)
    cells = np.zeros(len(ids) // 2 + 4, np.uint64)
    points, base = [], 0
    for lo in range(0, len(ids), run):
        part = ids[lo : lo + run]
        size = size8[part]
        end = np.cumsum(size, dtype=np.int64) + base
        at = end - size
        points.append(at[::CHECKPOINT])
        word = left[part] >> (at & 31).astype(np.uint64)
        cell = at >> 5
        start = np.flatnonzero(cell[1:] != cell[:-1]) + 1
        start = np.concatenate(([0], start))
        joined = np.bitwise_or.reduceat(word, start)
        mine = cell[start]
        cells[mine] |= joined >> np.uint64(32)
        cells[mine + 1] |= joined & np.uint64(0xFFFFFFFF)
        base = int(end[-1])
    return cells.astype(">u4").tobytes()[: -(-base // 8)], np.concatenate(points) if points else np.zeros(0, np.int64)


def decode_bits(bits: bytes, n_ids: int, checkpoints: np.ndarray, table: np.ndarray) -> np.ndarray:
    """All ids of a block; the stretches between checkpoints advance together."""
    u8 = np.frombuffer(bits + bytes(8), np.uint8).astype(np.uint32)
    peek = (u8[:-2] << 16) | (u8[1:-1] << 8) | u8[2:]
    at = np.array(checkpoints, np.int64)
    out = np.zeros((CHECKPOINT, len(at)), np.uint32)
    last = n_ids - (len(at) - 1) * CHECKPOINT
    for k in range(min(CHECKPOINT, n_ids)):
        live = len(at) if k < last else len(at) - 1
        pos = at[:live]
        v = table[(peek[pos >> 3] >> (8 - (pos & 7)).astype(np.uint32)) & 0xFFFF]
        out[k, :live] = v
        pos += v & 31
    return (out >> 5).T.reshape(-1)[:n_ids]


def write_blocks(tokens: DataFrame, path: str) -> None:
    """Write documents of tokenized() as Huffman blocks, in ascending doc_id order; null ids first, equal ids by their tokens."""
    spark = tokens.sparkSession

    # bounded by the vocabulary, not by the corpus
    parts_of = tokens.where("ids is null").select(F.posexplode("counts").alias("id", "n")).where("n > 0")
    got = parts_of.groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max([r["id"] for r in got], default=0) + 1, np.int64)
    for r in got:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    codes = canonical_codes(lengths)
    used = np.flatnonzero(lengths)
    spark.createDataFrame(pa.table({"id": pa.array(used, pa.int64()), "length": pa.array(lengths[used], pa.int64())})).coalesce(1).write.parquet(f"{path}/code")

    @lean
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        docs: list = []
        held: list[bytes] = []
        size = block = 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), WIDTH)
            bits, points = encode_bits(ids, codes, lengths)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([docs], pa.list_(pa.int64())),
                    pa.array([[len(x) // 2 for x in held]], pa.list_(pa.int64())), pa.array([len(ids)], pa.int64()),
                    pa.array([points], pa.list_(pa.int64())), pa.array([bits], pa.binary()),
                ],
                names=["part", "block", "doc_ids", "doc_lengths", "n_ids", "checkpoints", "bits"],
            )

        for b in batches:
            for part_of in slices([b], "ids", 16 << 20):
                for d, x in zip(part_of.column("doc_id").to_pylist(), part_of.column("ids").to_pylist()):
                    docs.append(d)
                    held.append(x)
                    size += len(x) // 2
                    if size >= BLOCK_IDS:
                        yield flush()
                        docs, held = [], []
                        size, block = 0, block + 1
        if held:
            yield flush()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = tokens.where("ids is not null").withColumn("tie", F.xxhash64("ids")).repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "ids")
    schema = "part int, block int, doc_ids array<long>, doc_lengths array<long>, n_ids long, checkpoints array<long>, bits binary"
    ordered.mapInArrow(encode, schema).write.option("compression", "none").parquet(f"{path}/blocks")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in a folder of blocks; start counts the ids of all documents before it."""
    lengths_of = {r["id"]: r["length"] for r in spark.read.parquet(f"{path}/code").collect()}
    lengths = np.zeros(max(lengths_of, default=0) + 1, np.int64)
    for i, n in lengths_of.items():
        lengths[i] = n
    blocks = spark.read.parquet(f"{path}/blocks")
    over_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    in_part = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.select("part", "block", "n_ids")
    # a row for each partition, then one for each block
    heads = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn("head", F.coalesce(F.sum("n").over(over_parts), F.lit(0))).select("part", "head")
    starts = sizes.withColumn("inner", F.coalesce(F.sum("n_ids").over(in_part), F.lit(0))).join(heads, "part")
    starts = starts.select("part", "block", (F.col("head") + F.col("inner")).alias("start"))

    @lean
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(lengths)
        for b in batches:
            for row in range(b.num_rows):
                x = {k: b.column(k)[row] for k in b.schema.names}
                ids = decode_bits(x["bits"].as_py(), x["n_ids"].as_py(), x["checkpoints"].values.to_numpy(), table).astype("<u4")
                sizes = x["doc_lengths"].values.to_numpy().astype(np.int64)
                ends = np.cumsum(sizes)
                view = memoryview(ids.tobytes())
                crc = [zlib.crc32(view[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [x["doc_ids"].values, pa.array(ends - sizes + x["start"].as_py()), pa.array(sizes), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    joined = blocks.join(starts, ["part", "block"]).select("doc_ids", "doc_lengths", "n_ids", "checkpoints", "bits", "start")
    return joined.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens_to_files(docs: DataFrame, vocab_path: str, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Tokenise, write the blocks under `path` (default: a new shared folder) and read them back.

    A null text is empty and has the end id alone. Rows that repeat a doc_id are documents of
    their own, beside each other. An empty table gives files without blocks. Other columns are ignored."""
    path = path or shared_dir(docs.sparkSession)
    write_blocks(written(tokenized(docs, vocab_path, end_id)), path)
    return read_blocks(docs.sparkSession, path)
