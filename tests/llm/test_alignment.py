"""op11 against the libraries and a plain model of intervals."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folia.llm import alignment, common, queries
from folia.llm.bpe import byte_alphabet
from tests.llm.test_operators import awkward


def libraries():
    a = Tokenizer.from_file(queries.BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_BPE)


def spans(pieces):
    out, at = [], 0
    for i, p in pieces:
        out.append((i, at, at + len(p)))
        at += len(p)
    return out


def plain(texts):
    """Rows of figures and groups for each text, by comparing all tokens of a group."""
    a, b = libraries()
    byte, done, count = byte_alphabet(), [], Counter()
    for t in texts:
        ta = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + (t or ""), add_special_tokens=False).ids]
        tb = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(t or "")]
        want = (" " + (t or "")).encode()
        if not t or b"".join(x for _, x in ta) != want or b"".join(x for _, x in tb) != want:
            done.append(None)
            continue
        sa, sb = spans(ta), spans(tb)
        cuts = sorted({e for _, _, e in sa} & {e for _, _, e in sb})
        groups, links, i, j = [], [], 0, 0
        for c in cuts:
            ga, gb = [], []
            while i < len(sa) and sa[i][2] <= c:
                ga.append(sa[i])
                i += 1
            while j < len(sb) and sb[j][2] <= c:
                gb.append(sb[j])
                j += 1
            groups.append((ga, gb))
            links += [(x[0], y[0]) for x in ga for y in gb if x[1] < y[2] and y[1] < x[2]]
        count.update(links)
        done.append((sa, sb, groups, links))
    top = defaultdict(int)
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    out = []
    for d in done:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        sa, sb, groups, links = d
        form = ";".join(",".join(str(x[0]) for x in g) + "|" + ",".join(str(x[0]) for x in h) for g, h in groups)
        out.append((len(sa), len(sb), len(groups), len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links), form))
    return out


def held(rows):
    return [(*(r[c] for c in alignment.FIGURES), bytes(r["groups"]).decode()) for r in rows]


def odd_texts():
    rnd = random.Random(3)
    bits = [" ", " ", "\n", "\t", "\r", "a", "the", "é", "日", "12", ".", "'s", "\x1f", "\0", "<0x41>", "　", "{", "}", "😀", "<|endoftext|>", "</s>", "▁"]
    return ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 14))) for _ in range(400)] + ["a ", " ", "  a", "\n", "x\r\n y", "a \nb", "\n\n\nx"]


def test_whole_table(spark, tiny):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    want = dict(zip(docs, plain(docs.values())))
    got = queries.op11_token_alignment(spark, tiny).collect()
    assert len(got) == len(docs)
    for r in got:
        w = want[r["doc_id"]]
        assert tuple(r[c] for c in alignment.FIGURES) == w[:6]
        assert r["groups_sha256"] == (hashlib.sha256(w[6].encode()).hexdigest() if w[0] else "")


@pytest.mark.parametrize("pairs", [alignment.PAIRS, 700])
def test_awkward_rows_and_turns(spark, monkeypatch, pairs):
    """Nulls, empty and long texts, repeated rows, clashing columns; and pairs that are broadcast in several turns."""
    monkeypatch.setattr(alignment, "PAIRS", pairs)
    odd = awkward(spark)
    odd = common.written(odd.unionByName(spark.createDataFrame([(1000 + k, t) for k, t in enumerate(odd_texts())], "doc_id long, text string"), allowMissingColumns=True)
                         .withColumn("n_a", F.lit("mine")).withColumn("groups", F.col("text")))
    out = alignment.align_tokenizers(odd, queries.BYTE_BPE, queries.PIECE_BPE, keep=["doc_id", "text", "n_a"]).toDF("doc_id", "text", "mine", *alignment.FIGURES, "groups")
    rows = out.collect()
    assert len(rows) == odd.count() and {r["mine"] for r in rows} == {"mine"}
    assert held(rows) == plain([r["text"] for r in rows])


def test_whole_texts_as_words(spark, monkeypatch):
    """The way for models whose pieces go over the start of a word gives the same."""
    texts = odd_texts() + ["", None, "some words, twice"]
    tool = alignment.aligner(queries.BYTE_BPE, queries.PIECE_BPE)
    by_word = [tool.align(w) if (w := tool.cut(t)) else None for t in texts]
    monkeypatch.setattr(tool, "by_word", False)
    for t, x in zip(texts, by_word):
        whole = tool.align(tool.cut(t)) if t else None
        if x is None:
            assert whole is None or not whole["ok"][0] and whole["text"] == [b""]
        else:
            assert b"".join(x["text"]) == whole["text"][0] and sorted(x["pairs"]) == sorted(whole["pairs"]) and x["n_groups"].sum() == whole["n_groups"][0]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_tokenizers(none, queries.BYTE_BPE, queries.PIECE_BPE).count() == 0
