"""WARC archives with an index first.

Every page becomes a gzip member with its response record, built where the page is read. The first
page of each payload is found from digests alone; other pages of that payload turn into small
revisit records. Members are laid into archives in row order, and with each archive its part of the
index is written: offset, length, URL and digest of every record. Reading starts from the index: the
wanted records are sorted by archive and offset, neighbours are joined to ranges of bounded
bytes, each range is read once, and the records are cut out of it."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folia.llm.common import lean, lean_group, raw, shared_dir, slices, written
from folia.session import ship

#: An archive is closed when it has this many bytes.
ARCHIVE_BYTES = 64 << 20
#: Members of about this many bytes are laid out together, in row order; a larger member is alone.
CHUNK_BYTES = 32 << 20
RANGE_BYTES = 8 << 20
GAP_BYTES = 64 << 10
DATE = "1970-01-01T00:00:00Z"


def _member(data: bytes) -> bytes:
    """A gzip member without time stamp, so that reruns agree."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _urn(page_id: int | None, row: int) -> bytes:
    """A name of its own for each row, also where page ids repeat or are null."""
    return b"<urn:page:%s:%d>" % (b"none" if page_id is None else str(page_id).encode(), row)


def _uri(url: bytes | None) -> bytes:
    """Control characters and spaces are percent-encoded, so that a URL stays on its line."""
    return b"".join(b"%%%02X" % c if c < 33 or c == 127 else bytes((c,)) for c in url or b"") if url and any(c < 33 or c == 127 for c in url) else url or b""


def record(page_id: int | None, row: int, url: bytes | None, digest: bytes, size: int, payload: bytes | None, refers_to: tuple[int | None, int] = (None, 0)) -> bytes:
    """A response record, or without payload a revisit record of the page and row refers_to."""
    revisit = payload is None
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n" % size + (payload or b"")
    lines = [
        b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"), b"WARC-Record-ID: " + _urn(page_id, row),
        b"WARC-Target-URI: " + _uri(url), b"WARC-Date: " + DATE.encode(), b"WARC-Payload-Digest: sha1:" + digest,
    ]
    if revisit:
        lines += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: " + _urn(*refers_to)]
    lines += [b"Content-Type: application/http;msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def members(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(row, chunk, page_id, url, digest, payload_bytes, member): the gzip member of each page's response; a null payload is empty.

    chunk numbers stretches of CHUNK_BYTES of members of an input partition, whose number stands in the upper bits."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for b in slices(batches, "payload", 2 << 20):
            payloads = [x or b"" for x in raw(b, "payload")]
            digests = [base64.b32encode(hashlib.sha1(x).digest()) for x in payloads]
            row = b.column("row").to_pylist()
            rows = zip(b.column("page_id").to_pylist(), row, raw(b, "url"), digests, payloads)
            out = [_member(record(i, r, u, d, len(x), x)) for i, r, u, d, x in rows]
            chunk = []
            for r, x in zip(row, out):
                chunk.append((r >> 33 << 33) + done // CHUNK_BYTES)
                done += len(x)
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(chunk, pa.int64()), b.column("page_id"), b.column("url"), pa.array(digests, pa.binary()).cast(pa.string()), pa.array([len(x) for x in payloads], pa.int64()), pa.array(out, pa.binary())],
                names=["row", "chunk", "page_id", "url", "digest", "payload_bytes", "member"],
            )

    t = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(payload_col).cast("string").alias("payload")
    )
    return t.mapInArrow(run, "row long, chunk long, page_id long, url string, digest string, payload_bytes long, member binary")


def write_archives(pages: DataFrame, path: str, smallest: int = 0, archive_bytes: int = ARCHIVE_BYTES, **columns) -> DataFrame:
    """Write archives under path/data and their index under path/index; returns the index.

    Payloads of at least `smallest` bytes that repeat an earlier page's (the smallest page_id, null last, then row
    order) become revisits. The first of a payload is a partial aggregate over digests, so that one payload
    of very many pages does not gather in a task. Archives get their names from the rows in them and appear under them
    when they are whole, so a task that runs again replaces its own. A chunk of rows that holds more than archive_bytes gives several archives."""
    spark = pages.sparkSession
    ship(spark)
    store = written(members(pages, **columns), "none")
    order = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("page_id"), F.col("row").alias("row"))
    keys = store.where(F.col("payload_bytes") >= smallest).select("row", "chunk", "page_id", "digest", "payload_bytes")
    first = keys.groupBy("digest", "payload_bytes").agg(F.min(order).alias("first"))
    again = written(keys.join(first, ["digest", "payload_bytes"]).where(F.col("first.row") != F.col("row")).select("row", "chunk", F.col("first.page_id").alias("first_id"), F.col("first.row").alias("first_row")))
    base = f"{path}/data"

    @lean_group
    def lay(held: pa.Table, revisits: pa.Table) -> pa.Table:
        refers = dict(zip(revisits.column("row").to_pylist(), zip(revisits.column("first_id").to_pylist(), revisits.column("first_row").to_pylist())))
        fs, root = pafs.FileSystem.from_uri(base)
        fs.create_dir(root, recursive=True)
        out: list[tuple] = []
        open_: list[bytes] = []
        size = 0

        def close() -> None:
            nonlocal size
            if not open_:
                return
            name = f"{root}/pages-{out[-len(open_)][3]:016x}.warc.gz"
            draft = f"{name}.{uuid.uuid4().hex}"
            with fs.open_output_stream(draft) as f:
                for x in open_:
                    f.write(x)
            fs.move(draft, name)
            for k in range(len(out) - len(open_), len(out)):
                out[k] = (base + "/" + name.rsplit("/", 1)[1], *out[k][1:])
            open_.clear()
            size = 0

        for r in sorted(held.select(["row", "page_id", "url", "digest", "payload_bytes", "member"]).to_pylist(), key=lambda r: r["row"]):
            x = r["member"]
            if r["row"] in refers:
                x = _member(record(r["page_id"], r["row"], r["url"].encode() if r["url"] else None, r["digest"].encode(), r["payload_bytes"], None, refers[r["row"]]))
            if open_ and size + len(x) > archive_bytes:
                close()
            out.append((None, size, len(x), r["row"], r["url"], r["digest"]))
            open_.append(x)
            size += len(x)
        close()
        cols = list(zip(*out)) or [[]] * 6
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.table({k: pa.array(c, t) for k, c, t in zip(("path", "offset", "length", "row", "url", "digest"), cols, kinds)})

    laid = store.groupBy("chunk").cogroup(again.groupBy("chunk")).applyInArrow(lay, "path string, offset long, length long, row long, url string, digest string")
    laid.write.parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")


READ = "row long, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_records(index: DataFrame, range_bytes: int = RANGE_BYTES, gap_bytes: int = GAP_BYTES) -> DataFrame:
    """The records that `index` selects, read by coalesced byte ranges of their archives.

    Ranges are opened where the task runs, through the store of the archive's URL. Digests of responses are
    computed from the bytes read; a record whose bytes do not fit its index row stops the read."""
    ship(index.sparkSession)
    w = Window.partitionBy("path").orderBy("offset")
    end = F.col("offset") + F.col("length")
    far = (F.col("offset") - F.lag(end).over(w) > gap_bytes) | F.lag("offset").over(w).isNull()
    cut = index.withColumn("jump", F.sum(far.cast("int")).over(w)).withColumn("cell", F.floor(F.col("offset") / range_bytes))
    entry = F.struct("offset", "length", "row", "digest")
    ranges = cut.groupBy("path", "jump", "cell").agg(F.sort_array(F.collect_list(entry)).alias("entries"))

    @lean
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, entries in zip(b.column("path").to_pylist(), b.column("entries").to_pylist()):
                store, name = pafs.FileSystem.from_uri(path)
                lo, hi = entries[0]["offset"], max(e["offset"] + e["length"] for e in entries)
                with store.open_input_file(name) as f:
                    data = f.read_at(hi - lo, lo)
                rows = [_parsed(e, data[e["offset"] - lo : e["offset"] - lo + e["length"]]) for e in entries]
                cols = list(zip(*rows))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in READ.split(", ")])

    return ranges.select("path", "entries").mapInArrow(read, READ)


def _parsed(entry: dict, member: bytes) -> tuple:
    data = zlib.decompress(member, 31)
    head, _, block = data.partition(b"\r\n\r\n")
    block = block.removesuffix(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(b":") for x in lines[1:])}
    if not lines[0].startswith(b"WARC/") or int(fields[b"content-length"]) != len(block):
        raise ValueError(f"no record of {entry['length']} bytes at offset {entry['offset']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    page = lambda x: None if x is None or (y := x.decode().split(":")[2]) == "none" else int(y)
    kind = fields[b"warc-type"].decode()
    digest = fields[b"warc-payload-digest"].decode().removeprefix("sha1:")
    if kind == "response":
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload digest differs at offset {entry['offset']}")
        size = len(payload)
    if digest != entry["digest"]:
        raise ValueError(f"index digest differs at offset {entry['offset']}")
    return (
        entry["row"], page(fields.get(b"warc-record-id")), fields.get(b"warc-target-uri", b"").decode("utf-8", "replace"), size, digest, kind,
        page(fields.get(b"warc-refers-to")), payload if kind == "response" else None,
    )


def archive_round_trip(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write all pages to archives under `path` (default: a new shared folder), read all of them back through the index."""
    path = path or shared_dir(pages.sparkSession)
    return read_records(write_archives(pages, path, **options))


def select_urls(spark: SparkSession, path: str, urls: DataFrame) -> DataFrame:
    """Records of the archives at `path` whose URL is in column url of `urls`."""
    return read_records(spark.read.parquet(f"{path}/index").join(urls.select("url").distinct(), "url", "left_semi"))
