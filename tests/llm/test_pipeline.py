"""The pipeline against a plain model of its stages, on a small table with awkward rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from folia.llm import common, queries
from tests.llm.test_jaccard import brute, shingles
from tests.llm.test_operators import brute_passages, targets, words

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    rows += [rows[3], rows[3], (None, rows[5][1] + " tail", "en", None, 5), (9000, None, None, None, None), (9001, "", None, "src1", 0), (3, rows[8][1] + " and more words", "en", "src2", 9)]
    return common.written(spark.createDataFrame(rows, COLUMNS))


def test_stages_keep_columns_and_order(spark, docs):
    at = docs
    seen = []
    for name, stage in P.STAGES[:-1]:
        out = common.written(stage(spark, at, ""))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        seen.append((name, at.collect(), out.collect()))
        before, at = at, out
        if name == "passages":
            want = Counter({(k[0], k[3]): n for k, n in brute_passages(before).items() if k[2] == 0 or k[2] < k[1]})
    (_, a, b), (_, c, d), (_, e, f), (_, g, h) = seen
    # language: what goes has no clear language; texts stay as they are
    assert {r["text"] for r in b} <= {r["text"] for r in a} and not any(r["text"] in (None, "") for r in b)
    assert len(b) >= 0.9 * len([r for r in a if r["text"]])
    # near duplicates: one row for each group, the smallest id
    root = brute({shingles(r["text"]) for r in c})
    least = {}
    for r in c:
        k = root[shingles(r["text"])]
        least[k] = min(least.get(k, 1 << 60), 1 << 59 if r["doc_id"] is None else r["doc_id"])
    assert Counter(root[shingles(r["text"])] for r in d) == Counter(dict.fromkeys(least, 1))
    assert all((1 << 59 if r["doc_id"] is None else r["doc_id"]) == least[root[shingles(r["text"])]] for r in d)
    # passages
    got = Counter((r["doc_id"], hashlib.sha256(" ".join(words(r["text"])).encode()).hexdigest()) for r in f)
    assert got == want
    # mixture
    sizes = Counter()
    for r in g:
        sizes[r["source"]] += len(words(r["text"]))
    goal, took = targets(sizes), Counter()
    for r in h:
        took[r["source"]] += len(words(r["text"]))
    for s, t in goal.items():
        assert abs(took[s] - t) <= max(len(words(r["text"])) for r in g if r["source"] == s) + 1
    assert set(Counter((r["doc_id"], r["text"]) for r in h)) <= set((r["doc_id"], r["text"]) for r in g)


def test_extra_columns_keep_their_values(spark, docs):
    names = ["score", "lang_pred", "_text", "copies", "copy", "_row", "row", "_copy", "ids", "c0", "k0", "doc", "tag", "node", "root"]
    at = docs.select("*", *[F.xxhash64("doc_id", "source", F.lit(n)).alias(n) for n in names])
    for name, stage in P.STAGES[:-1]:
        out = common.written(stage(spark, at, ""))
        assert out.columns == at.columns and out.count() > 100, name
        assert not out.where(" or ".join(f"{n} <> xxhash64(doc_id, source, '{n}')" for n in names)).take(1), name
        at = out
    assert P.tokens(spark, at, "").count() == at.count()


def test_last_stage(spark, docs):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(queries.BYTE_BPE)
    got = P.tokens(spark, docs, "").collect()
    want = Counter((r["doc_id"], hashlib.sha256(np.array(tool.encode(r["text"] or "", add_special_tokens=False).ids, "<u4").tobytes()).hexdigest()) for r in docs.collect())
    assert Counter((r["doc_id"], r["ids_sha256"]) for r in got) == want
    assert all(hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest() == r["ids_sha256"] for r in got)


def test_empty(spark, docs):
    at = docs.limit(0)
    for _, stage in P.STAGES:
        at = stage(spark, at, "")
    assert at.count() == 0 and re.fullmatch(r"\w+", at.columns[0])
