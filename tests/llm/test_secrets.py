"""op13 against a plain model on awkward rows; whole tables are held against SQL in tests/test_queries.py."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from folia.llm import common, queries, secrets
from tests.llm.test_operators import awkward

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
OWNED = "Zx9kQ2mLp0Wv7Rt4Yb6N"


def base(t):
    out = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), m[0]) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return out + [(m.start(), 2, m.end(), m[0]) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]


def plain(rows, max_owners=1):
    """rows: (repo, owner, text); spans of each with what is known of their values."""
    found, repos, owners = [], defaultdict(set), defaultdict(set)
    for repo, owner, t in rows:
        t = t or ""
        got = base(t)
        for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", t):
            v = m[0]
            looks = len(re.findall("[0-9]", v)) >= 3 and len(re.findall("[A-Za-z]", v)) >= 3 and len(set(v)) >= 10
            if looks and not any(s < m.end() and m.start() < e for s, _, e, _ in got if _ is not None):
                found_here = (m.start(), 3, m.end(), v)
                got = got + [found_here]
        found.append(got)
        for *_, v in got:
            repos[v].add(repo)
            owners[v].add(owner)
    return [sorted((s, k, e, len(repos[v]), len(owners[v])) for s, k, e, v in got if k < 3 or len(owners[v]) <= max_owners) for got in found]


def samples():
    r = random.Random(5)
    hexes = ["".join(r.choice("0123456789abcdef") for _ in range(n)) for n in (23, 24, 40, 64)]
    bits = ["password", "PassWD", "secret", "toKen", "api_key", "APIKEY", "apı_key", "ſecret", '"', "'", " ", "  ", ":", "=", "abcdef", "abcde", "x.y_z-1", "AKIA", "AKIA" + "A1" * 8, "AKIA" + "Z" * 15,
            OWNED, OWNED + "/q", "日本", "é", "\n", "\t", "\x01", ".", ",", *hexes]
    return ["".join(r.choice(bits) for _ in range(r.randint(1, 20))) for _ in range(300)]


@pytest.mark.parametrize("max_owners", [1, 3])
def test_awkward_rows(spark, max_owners):
    """Nulls, empty and long texts, texts that are not ASCII, repeated rows, clashing columns."""
    r = random.Random(6)
    more = [(3000 + k, t, r.choice(["a", "b", "c", None])) for k, t in enumerate(samples())]
    more += [(5000, "key " + OWNED[::-1], "only"), (5001, "é " + OWNED[::-1] + " again", "only"), (5002, "x" * 200_000 + " token=" + "ab12" * 5, "a"), more[3], more[3]]
    odd = awkward(spark).unionByName(spark.createDataFrame(more, "doc_id long, text string, source string"), allowMissingColumns=True)
    odd = common.written(odd.withColumns({"spans": F.lit("mine"), "row": F.lit(3), "owner": F.col("text"), "value": F.lit(None).cast("int")}))
    out = secrets.scan_secrets(odd, keep=["doc_id", "source", "text", "spans", "row"], max_owners=max_owners).toDF("doc_id", "source", "text", "mine", "row", "spans").collect()
    assert len(out) == odd.count() and {x["mine"] for x in out} == {"mine"}
    want = plain([(x["doc_id"], x["source"], x["text"]) for x in out], max_owners)
    assert [[tuple(s) for s in x["spans"]] for x in out] == want
    assert any(s[1] == 3 for x in want for s in x) and {s[1] for x in want for s in x} == {0, 1, 2, 3}


def test_copied_and_owned(spark):
    """A look-alike that one owner holds is added, one that several hold is not, however many rows hold it."""
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 1500, "one").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        F.when(F.col("id") < 1500, f"use {OWNED} here").otherwise(f"use {OWNED[::-1]} here").alias("text"))
    out = secrets.scan_secrets(docs).groupBy(F.col("doc_id") < 1500, "spans").count().collect()
    got = {r[0]: ([tuple(s) for s in r["spans"]], r["count"]) for r in out}
    assert got == {True: ([(4, 3, 24, 1500, 1)], 1500), False: ([], 1500)}


def test_query_digests(spark, tiny):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    want = dict(zip(docs, plain([(k, r["source"], r["text"]) for k, r in docs.items()])))
    got = queries.op13_secret_ownership(spark, tiny).collect()
    assert len(got) == len(docs)
    for r in got:
        form = [f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e, *_ in want[r["doc_id"]]]
        own = [x for x in form if not x.startswith("owned")]
        assert (r["spans"], r["base_sha256"]) == (",".join(form), hashlib.sha256(",".join(own).encode()).hexdigest())
        assert [r["n_assign"], r["n_access"], r["n_hex"], r["n_owned"]] == [sum(x.startswith(k) for x in form) for k in secrets.KINDS]


def test_empty_table(spark):
    assert secrets.scan_secrets(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
