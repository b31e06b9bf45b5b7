"""Language identification by compression.

Each language has a zstandard raw-content dictionary, filled from a bounded
sample of labelled texts. A text, reduced to its words in lower case, is cut into pieces of a few KB; every piece is
compressed with each dictionary, and the language with the smallest total wins.
A narrow margin between the two smallest totals is a rejection."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folia.llm.common import lean, lean_group, raw, slices
from folia.session import ship

UNDETERMINED = "und"
_PLAIN = re.compile(rb"[A-Za-z]")
#: ASCII letters in lower case, other ASCII as space; bytes of other letters as they are.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def normal(text: bytes) -> bytes:
    """What is compressed: words in lower case, without digits, signs and repeated space."""
    return b" ".join(text.translate(_LETTERS).split())


def held_out(id_col: str = "doc_id") -> Column:
    """True where crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit_dictionaries(
    labelled: DataFrame, sample_docs: int = 600, dict_bytes: int = 96 * 1024, text_col: str = "text", id_col: str = "doc_id", lang_col: str = "lang"
) -> dict[str, bytes]:
    """{language: dictionary bytes} from labelled texts.

    The bound of the fit: per language at most sample_docs whole texts, those with the smallest hash of id and text, and at most
    dict_bytes of their words, taken from the texts in turn: every text gives an equal share and a short one leaves its rest to others.
    Each language has its own bound, and rows with equal or null ids are told apart by their texts, so none can crowd out another. A
    language's sample is sorted and cut in one task; only the dictionaries reach the driver. Languages are expected to be few. Null texts and labels are not used."""
    ship(labelled.sparkSession)
    text, lang = F.col(text_col).cast("string"), F.col(lang_col).cast("string")
    ok = labelled.where(text.isNotNull() & lang.isNotNull() & (F.length(text) > 0))
    h = F.xxhash64(F.col(id_col), text)
    ok = ok.select(lang.alias("lang"), h.alias("h"), text.alias("text"))
    counts = {r["lang"]: r["n"] for r in ok.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    # a share of the hash range first, four times what is wanted, so that little is sorted; a small language stays whole
    shares = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, 4 * sample_docs / n)))])
    thin = ok.where(F.pmod("h", F.lit(1 << 30)) <= shares[F.col("lang")] * float(1 << 30))
    first = Window.partitionBy("lang").orderBy("h", "text")
    few = thin.withColumn("r", F.row_number().over(first)).where(F.col("r") <= sample_docs)
    if sum(min(n, sample_docs) for n in counts.values()) > 1 << 20:
        raise ValueError("too many languages for dictionaries on the driver")

    @lean_group
    def fill(t: pa.Table) -> pa.Table:
        texts = [normal(x) for x in raw(t.sort_by([("r", "ascending")]), "text")]
        left, size = dict_bytes - len(texts), [0] * len(texts)
        for n, k in enumerate(sorted(range(len(texts)), key=lambda k: len(texts[k]))):
            size[k] = max(0, min(len(texts[k]), left // (len(texts) - n)))
            left -= size[k]
        # a text's share is cut from its middle
        parts = [x[(len(x) - z) // 2 :][:z] for x, z in zip(texts, size)]
        return pa.table({"lang": t.column("lang")[:1], "content": pa.array([b" ".join(parts[::-1])], pa.binary())})

    return {r["lang"]: bytes(r["content"]) for r in few.groupBy("lang").applyInArrow(fill, "lang string, content binary").collect()}


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], piece_bytes: int = 2048, level: int = 6,
    text_col: str = "text", keep: list[str] | None = None, margin: float = 0.0,
) -> DataFrame:
    """Columns `keep` (default doc_id) with lang_pred and score.

    score is the margin, (second - best) / second of the compressed sizes, 0 to 1
    (1 where one language is known). A score below `margin` is a rejection: `und`, with its score. `und` with score 0: the text is null, has no
    letter, or no language is known; ties go to the language that sorts first and have score 0.
    Rows are judged one by one, so repeated rows give equal results; an empty table gives an empty one. Texts are taken whole,
    a long one in pieces. Where a kept column has the name lang_pred or score, both are there, the kept one first."""
    ship(docs.sparkSession)
    keep = keep or ["doc_id"]
    names = sorted(dictionaries)
    contents = [dictionaries[k] for k in names]
    # kept columns take numbers for names, so that none clashes
    frame = docs.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keep)], F.col(text_col).cast("string").alias("text"))

    @lean
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = []
        for c in contents:
            d = zstandard.ZstdCompressionDict(c, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            tools.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False).compress)
        for b in slices(batches, "text", 2 << 20):
            langs, scores = [], []
            for t in raw(b, "text"):
                if not t or not tools or not (_PLAIN.search(t) or any(map(str.isalpha, t.decode("utf-8", "replace")))):
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                t = normal(t)
                pieces = [t] if len(t) <= piece_bytes else [t[i : i + piece_bytes] for i in range(0, len(t), piece_bytes)]
                total = sorted((sum(len(f(p)) for p in pieces), k) for k, f in enumerate(tools))
                score = 1.0 if len(total) == 1 else (total[1][0] - total[0][0]) / total[1][0]
                langs.append(names[total[0][1]] if score >= margin else UNDETERMINED)
                scores.append(score)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    schema = T.StructType([T.StructField(f"k{i}", docs.schema[k].dataType) for i, k in enumerate(keep)]).add("lang_pred", "string").add("score", "double")
    return frame.mapInArrow(predict, schema).toDF(*keep, "lang_pred", "score")
