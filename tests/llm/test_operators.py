"""Each operator against a plain model of its contract, on whole tables and on awkward rows."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from folia.llm import bpe, common, crosspolytope, huffman, langid, mixing, queries, repetition, sharding, simhash, substring_dedup, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, fp int, word string"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def awkward(spark, seed=0):
    """Nulls in every column, empty and very long texts, ties, copies, repeated rows, clashing extra columns."""
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(40)] + ["Ünï", "日本", "a b", "#$%", "<|endoftext|>", "it's", "don't", "x" * 50]
    passage = " ".join(r.choice(vocab) for _ in range(70))
    rows, texts = [], []
    for k in range(60):
        t = " ".join(r.choice(vocab) for _ in range(r.choice([1, 3, 10, 60, 200])))
        if k % 4 == 0:
            t = f"{t[:150]} {passage}  \n {t[150:]}"
        if k % 9 == 0 and texts:
            t = texts[-1]
        texts.append(t)
        rows.append((k, t, r.choice(["en", "fr", None]), r.choice(["a", "b", "c", None]), len(t), 1, 2, "z"))
    rows += [(60, None, "en", "a", None, None, None, None), (61, "", None, None, 0, 1, 1, "q"), (62, " \n\t ", "fr", "b", 4, 1, 1, "q")]
    rows += [(63, " ".join(r.choice(vocab) for _ in range(30000)), "en", "a", 1, 1, 1, None), (64, "la " * 500, "en", "c", 1, 1, 1, None)]
    rows += [rows[5], rows[5], (None, passage, None, None, None, None, None, None), (7, "another text under a known id " + passage, "en", "a", 1, 1, 1, "r")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return common.written(awkward(spark))


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_all_operators_take_empty_tables(spark, none):
    assert sharding.kd_shards(none, 4).count() == 0
    assert mixing.mix_sources(none).count() == 0
    assert langid.identify(none, langid.fit_dictionaries(none)).count() == 0
    assert repetition.quality_rules(none).count() == 0
    assert bpe.encode_decode(none, queries.BYTE_BPE).count() == 0
    assert substring_dedup.dedup_passages(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert huffman.tokens_to_files(none, queries.WORD_BPE).count() == 0
    assert warc.archive_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert crosspolytope.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def check_shards(rows, n, leeway):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    assert set(by) <= set(range(n))
    for k, v in by.items():
        assert sorted(x["slot"] for x in v) == list(range(len(v)))
    sums = [sum(x["size"] for x in by.get(k, [])) for k in range(n)]
    assert max(sums) - min(sums) <= leeway, sums


def test_shards(spark, tiny, odd):
    out = queries.op1_kd_shards(spark, tiny).collect()
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    assert len(out) == len(docs)
    for r in out:
        b = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(b) + 1, zlib.crc32(b), "bytes", None)
    check_shards(out, 16, 2 * max(r["size"] for r in out))
    out = sharding.kd_shards(odd, 4).collect()
    check_shards(out, 4, 2 * max(r["size"] for r in out))
    wide = [((k * 0x9E3779B97F4A7C15 + 5) % 2**64 - 2**63, "x" * (k % 50), "l", "s") for k in range(400)] + [(2**63 - 1, "a", "l", "s"), (-(2**63), "b", "l", "s"), (None, "c", None, None)]
    out = sharding.kd_shards(spark.createDataFrame(wide, "doc_id long, text string, lang string, source string"), 8).collect()
    assert len(out) == 403
    check_shards(out, 8, 300)
    # one id and size; sources that share their first 12 bytes make the widest dimension and are kept together
    named = [(1, "same", "l", f"common-prefix-{k % 4}") for k in range(80)]
    out = sharding.kd_shards(spark.createDataFrame(named, "doc_id long, text string, lang string, source string"), 4).collect()
    check_shards(out, 4, 0)
    same = spark.createDataFrame([(1, "same text", None, None)] * 40, "doc_id long, text string, lang string, source string")
    out = sharding.kd_shards(same, 4).collect()
    assert Counter(r["shard"] for r in out) == {k: 10 for k in range(4)}
    assert sharding.kd_shards(same, target_bytes=100).select("shard").distinct().count() == 4


def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, free, out = sum(sizes.values()), set(names), {}
    left = float(total)
    while free:
        w = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / w > 3 * sizes[s]}
        if not over:
            out |= {s: left * weight[s] / w for s in free}
            break
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


@pytest.mark.parametrize("which", ["tiny", "odd"])
def test_mix(spark, tiny, odd, which):
    docs = spark.read.parquet(f"{tiny}/documents.parquet") if which == "tiny" else odd
    rows = docs.select("doc_id", "text", "source").collect()
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += len(words(r["text"]))
    want = targets(sizes)
    out = mixing.mix_sources(docs).collect()
    assert len(out) == len(rows)
    assert sorted((r["doc_id"] or -1, r["size"], r["taken"]) for r in out) == sorted((r["doc_id"] or -1, r["size"], r["taken"]) for r in mixing.mix_sources(docs).collect())
    took, longest = Counter(), Counter()
    for r in out:
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        took[round(r["target"], 3)] += r["taken"]
        longest[round(r["target"], 3)] = max(longest[round(r["target"], 3)], r["size"])
    assert {round(x, 3) for x in want.values()} == set(took)
    n = Counter(round(x, 3) for x in want.values())
    for t, x in took.items():
        assert abs(x - t * n[t]) <= longest[t] * n[t] + 1


def test_flight_keeps_totals():
    rng = np.random.default_rng(3)
    size = rng.integers(1, 2000, 500)
    p = np.full(500, 0.37)
    out = mixing.fly(p, size, 5, False)
    open_ = (out > 0) & (out < 1)
    assert open_.sum() <= 2
    assert math.isclose(out.sum(), p.sum(), abs_tol=1e-6) and math.isclose((out * size).sum(), (p * size).sum(), rel_tol=1e-9)
    assert set(np.unique(mixing.fly(p, size, 5, True))) == {0.0, 1.0}


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = langid.fit_dictionaries(docs.where(~langid.held_out()))
    out = langid.identify(docs.select("doc_id", "text"), known).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out())
    got = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert got > 0.95
    bounds = out.agg(F.min("score"), F.max("score")).first()
    assert bounds[0] >= 0 and bounds[1] <= 1


def brute_language(text, known):
    """Smallest sum of compressed sizes, plainly; the margin to the second."""
    import zstandard

    w = re.sub(r"[^a-z\x80-\U0010ffff]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")).strip().encode()
    if not text or not any(map(str.isalpha, text)):
        return "und", 0.0
    sizes = []
    for k in sorted(known):
        tool = zstandard.ZstdCompressor(level=6, dict_data=zstandard.ZstdCompressionDict(known[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False)
        sizes.append((sum(len(tool.compress(w[i : i + 2048])) for i in range(0, max(1, len(w)), 2048)), k))
    sizes.sort()
    return sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0]


@pytest.mark.parametrize("which", ["tiny", "odd"])
def test_language_equals_brute_force(spark, tiny, odd, which):
    docs = spark.read.parquet(f"{tiny}/documents.parquet") if which == "tiny" else odd
    known = langid.fit_dictionaries(docs.where(~langid.held_out()))
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        want[r["doc_id"], *brute_language(r["text"], known)] += 1
    assert Counter(tuple(r) for r in langid.identify(docs, known).collect()) == want
    narrow = langid.identify(docs, known, margin=0.02).collect()
    assert Counter((r["doc_id"], r["lang_pred"], r["score"]) for r in narrow) == Counter({(d, k if s >= 0.02 else "und", s): n for (d, k, s), n in want.items()})


def test_language_fit_of_one_crowding_id(spark):
    rows = [(None, f"many words under a null id {k}", "big") for k in range(20000)] + [(k, f"altra lingua {k}", "small") for k in range(200)]
    known = langid.fit_dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_docs=50)
    assert set(known) == {"big", "small"} and known["small"].count(b"altra lingua") == 50 and known["big"].count(b"null id") == 50


def test_language_edges(odd):
    known = langid.fit_dictionaries(odd)
    got = {r["doc_id"]: r for r in langid.identify(odd, known).collect()}
    assert all(got[k]["lang_pred"] == "und" for k in (60, 61, 62))
    assert got[1]["lang_pred"] in known


def test_warc(spark, tiny):
    pages = spark.read.parquet(f"{tiny}/pages.parquet").select("page_id", "url", "html")
    extra = spark.createDataFrame([(9001, "http://a b/\r\nx", None), (9002, None, ""), (9003, "u", "same"), (9004, "u", "same"), (9004, "u", "same"), (None, "v", "same"), (9005, "w", "WARC/1.1\r\n\r\nfoo")], "page_id long, url string, html string")
    pages = common.written(pages.union(extra))
    rows = pages.collect()
    first = {}
    for r in rows:
        d = (r["html"] or "").encode()
        if r["page_id"] is not None:
            first[d] = min(first.get(d, 1 << 60), r["page_id"])
    want, seen = [], set()
    for r in sorted(rows, key=lambda r: (r["page_id"] is None, r["page_id"] or 0)):
        d = (r["html"] or "").encode()
        again = d in seen
        seen.add(d)
        want.append((r["page_id"], len(d), base64.b32encode(hashlib.sha1(d).digest()).decode(), "revisit" if again else "response", first[d] if again else None))
    path = common.shared_dir(spark)
    got = warc.archive_round_trip(pages, path).collect()
    key = lambda x: tuple(str(y) for y in x)
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=key) == sorted(want, key=key)
    some = warc.select_urls(spark, path, spark.createDataFrame([("u",), ("w",)], "url string")).collect()
    assert sorted(r["page_id"] for r in some) == [9003, 9004, 9004, 9005]
    assert {bytes(r["payload"]) for r in some if r["page_id"] == 9005} == {b"WARC/1.1\r\n\r\nfoo"}


def test_warc_by_bytes(spark, monkeypatch):
    """Payloads above the archive size, several archives of a chunk, gaps between wanted records."""
    r = random.Random(2)
    rows = [(k, f"u{k}", r.randbytes(40_000 if k == 7 else 900).hex()) for k in range(60)]
    pages = common.written(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2))
    path = common.shared_dir(spark)
    index = warc.write_archives(pages, path, archive_bytes=5000)
    assert index.select("path").distinct().count() > 10
    got = {x["page_id"]: x["payload"] for x in warc.read_records(index, gap_bytes=10).collect()}
    assert got == {k: h.encode() for k, _, h in rows}
    wanted = spark.createDataFrame([(f"u{k}",) for k in (1, 7, 8, 30, 59)], "url string")
    assert {x["page_id"] for x in warc.select_urls(spark, path, wanted).collect()} == {1, 7, 8, 30, 59}


def brute_repeats(w):
    longest = 0
    cover = [False] * len(w)
    for i in range(len(w)):
        best = 0
        for j in range(len(w)):
            if i != j:
                k = 0
                while max(i, j) + k < len(w) and w[i + k] == w[j + k]:
                    k += 1
                best = max(best, k)
        if best >= 8:
            longest = max(longest, best)
            for k in range(best):
                cover[i + k] = True
    return sum(cover), longest


@pytest.mark.parametrize("which", ["tiny", "odd"])
def test_repetition(spark, tiny, odd, which):
    docs = spark.read.parquet(f"{tiny}/documents.parquet") if which == "tiny" else odd
    rows = docs.select("doc_id", "text").collect()
    got = repetition.quality_rules(docs).collect()
    assert len(got) == len(rows)
    want = Counter()
    for r in rows:
        t = r["text"] or ""
        w = words(t)
        windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        spot = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if words(x)]
        bad = len(w) < 50 or 100 * len(spot) > 50 * len(w)
        want[r["doc_id"], len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(spot), bad] += 1
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got) == want
    by = {r["doc_id"]: r["text"] for r in rows}
    for r in got:
        if r["n_words"] < 700 and list(x["doc_id"] for x in rows).count(r["doc_id"]) == 1:
            cover, longest = brute_repeats(words(by[r["doc_id"]]))
            assert (sum(s["end"] - s["start"] for s in r["spans"]), r["longest_repeat"]) == (cover, longest)
            assert r["kept"] == (not r["base_failed"] and cover <= 0.3 * r["n_words"] and longest <= 60)


@pytest.mark.parametrize("which", ["tiny", "odd"])
def test_bpe_equals_the_library(spark, tiny, odd, which):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(queries.BYTE_BPE)
    docs = spark.read.parquet(f"{tiny}/documents.parquet") if which == "tiny" else odd
    extra = ["a  b", "a   b \n c", " \n \n x", "x\t\ty   z", "tail ", "\n\n", "aaaaaaaa aaa", "a <|endoftext|>b<|endoftext|>", "it's 123 4.5% naïve 🙂👍🏽", "é \x1c \x85 q", "foo\n \nbar", "I'LL we'll''s"]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(extra, 100000)), "doc_id long, text string"))
    rows = docs.collect()
    got = bpe.encode_decode(docs, queries.BYTE_BPE, with_text=True).collect()
    assert all(hashlib.sha256(r["decoded"].encode()).hexdigest() == r["decoded_sha256"] for r in got)
    assert len(got) == len(rows)
    want = Counter()
    for r in rows:
        ids = tool.encode(r["text"] or "", add_special_tokens=False).ids
        b = np.array(ids, "<u4").tobytes()
        want[r["doc_id"], len(ids), hashlib.sha256(b).hexdigest(), hashlib.sha256(tool.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want


def test_bpe_long_texts_in_stretches(monkeypatch):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(queries.BYTE_BPE)
    monkeypatch.setattr(bpe, "LONG", 40)
    monkeypatch.setattr(bpe, "IDS", 7)
    r = random.Random(5)
    texts = ["".join(r.choice(["word ", "a", " ", "  ", "'s", " x", "é", "日本 ", "\n", "1", "...", "<|endoftext|>", "🙂"]) for _ in range(400)) for _ in range(30)] + ["x" * 300, " " * 200, ""]
    e = bpe.Encoder(bpe.Vocabulary(queries.BYTE_BPE))
    monkeypatch.setattr(bpe, "MEMORY", 2000)
    ids = e.encode(texts)
    assert ids == [np.array(tool.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert [x.decode() for x in e.decode_all(ids)] == texts


def test_bpe_kept_columns_may_clash(spark):
    got = bpe.encode_decode(spark.createDataFrame([(1, "a b", 7, 8)], "n_tokens long, text string, ids int, k0 int"), queries.BYTE_BPE, keep=["n_tokens", "ids", "k0"])
    assert got.columns == ["n_tokens", "ids", "k0", "n_tokens", "ids_sha256", "decoded_sha256", "ids"] and list(got.collect()[0])[:4] == [1, 7, 8, 2]


def brute_passages(docs, n=20):
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    docs = [(*x[:2], x[3]) for x in sorted({(r["doc_id"] is None, r["doc_id"] or 0, r["h"], r["text"]) for r in rows}, key=lambda x: x[:3])]
    seen, out = set(), {}
    for d in docs:
        w = words(d[2])
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            k = tuple(w[i : i + n])
            if k in seen:
                gone[i : i + n] = [True] * n
            seen.add(k)
        out[d] = (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest())
    return Counter((r["doc_id"], *out[r["doc_id"] is None, r["doc_id"] or 0, r["text"]]) for r in rows)


@pytest.mark.parametrize("which", ["tiny", "odd"])
def test_passages(spark, tiny, odd, which):
    docs = spark.read.parquet(f"{tiny}/documents.parquet") if which == "tiny" else odd
    got = substring_dedup.dedup_passages(docs).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == brute_passages(docs)


def test_passages_of_null_and_repeated_ids(spark):
    r = random.Random(8)
    word = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    shared = word(30)
    rows = [(None if k % 4 else k % 9, word(25) + (" " + shared if k % 2 else "")) for k in range(1200)]
    rows += [(2**63 - 1, shared + " last"), (-(2**63), word(40)), (None, rows[3][1]), (None, None)]
    docs = common.written(spark.createDataFrame(rows, "doc_id long, text string"))
    got = substring_dedup.dedup_passages(docs).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == brute_passages(docs)
    assert Counter(r["n_removed"] for r in got)[30] == 601 and {r["n_removed"] for r in got} == {0, 30}


def test_difference_cover():
    c, p = substring_dedup.COVER, substring_dedup.PERIOD
    assert {(a - b) % p for a in c for b in c} == set(range(p))


def brute_fp(t, width=4):
    w = (t or "").encode().lower().split()
    sh = [b" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h)) if h else 0


def brute_groups(prints, limit=4):
    at = {p: p for p in prints}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for a, b in combinations(list(prints), 2):
        if (a ^ b).bit_count() <= limit:
            at[find(a)] = find(b)
    return {p: find(p) for p in prints}


@pytest.mark.parametrize("which", ["tiny", "odd"])
def test_simhash(spark, tiny, odd, which):
    docs = spark.read.parquet(f"{tiny}/documents.parquet") if which == "tiny" else odd
    rows = docs.select("doc_id", "text").collect()
    prints = [(r["doc_id"], brute_fp(r["text"])) for r in rows]
    root = brute_groups({p for _, p in prints})
    least = {}
    for d, p in prints:
        if d is not None:
            least[root[p]] = min(d, least.get(root[p], d))
    got = simhash.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got) == Counter((d, p, least.get(root[p])) for d, p in prints)


def test_simhash_links_no_pair_lost():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = set(base.tolist())
    for b in base.tolist():
        for _ in range(30):
            flips = rng.choice(64, rng.integers(1, 6), replace=False)
            fps.add(b ^ sum(1 << int(f) for f in flips))
    fp = np.array(sorted(fps), np.uint64)
    who, what = simhash.anchors(fp)
    links = simhash._links(what, fp[who], 4)
    at = {int(p): int(p) for p in fp}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for a, b in links.tolist():
        assert (a ^ b).bit_count() <= 4
        at[find(a)] = find(b)
    want = brute_groups({int(p) for p in fp})
    pairs = lambda f: {frozenset(x for x in at if f(x) == f(y)) for y in at}
    assert pairs(find) == pairs(want.__getitem__)


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(60)] + [(5, 5)]
    got = {x["node"]: x["root"] for x in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    at = {x: x for e in edges for x in e}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for a, b in edges:
        at[find(a)] = find(b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert set(got) == linked
    groups = lambda f: {frozenset(x for x in linked if f(x) == f(y)) for y in linked}
    assert groups(find) == groups(got.__getitem__)


@pytest.mark.parametrize("which", ["tiny", "odd"])
def test_huffman(spark, tiny, odd, which):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(queries.WORD_BPE)
    docs = spark.read.parquet(f"{tiny}/documents.parquet") if which == "tiny" else odd
    extra = ["ΣΑΣ ΟΔΟΣ", "é ́x", "İstanbul", "a\x1cb \x85 c d", "<|startoftext|>it's<|endoftext|>", "123 4.5"]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(extra, 100000)), "doc_id long, text string"))
    rows = docs.collect()
    encoded = [(r["doc_id"], [*tool.encode(r["text"] or "", add_special_tokens=False).ids, 2]) for r in rows]
    got = huffman.tokens_to_files(docs, queries.WORD_BPE).orderBy("start").collect()
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter((d, len(i), crc(i)) for d, i in encoded)
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert ids == sorted(ids)


def test_huffman_code():
    rng = np.random.default_rng(2)
    counts = np.zeros(60000, np.int64)
    counts[rng.choice(60000, 50000, replace=False)] = (1e6 / np.arange(1, 50001) ** 1.3).astype(np.int64) + 1
    lengths = huffman.code_lengths(counts)
    used = lengths[counts > 0]
    assert used.min() > 0 and used.max() <= 16 and sum(2.0 ** -int(x) for x in used) <= 1
    small = np.array([5, 9, 12, 13, 16, 45, 0])
    assert int((huffman.code_lengths(small) * small).sum()) == 224
    ids = rng.choice(np.flatnonzero(counts), 5000)
    bits, points = huffman.encode_bits(ids, huffman.canonical_codes(lengths), lengths)
    assert (huffman.decode_bits(bits, len(ids), points, huffman.decode_table(lengths)) == ids).all()


def test_neighbours(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.array([r["embedding"] for r in rows], np.float64)
    ids = np.array([r["vec_id"] for r in rows])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = defaultdict(list)
    for r in queries.op10_cross_polytope(spark, "/root/testdata/sf0.01").orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    hits = n = 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = unit @ unit[q]
        order = [k for k in np.lexsort((ids, -s)) if k != q][:5]
        mine = got[ids[q]]
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1))
        for _, v, sc in mine:
            assert math.isclose(sc, s[np.flatnonzero(ids == v)[0]], abs_tol=1e-12)
        hits += len({ids[k] for k in order} & {m[1] for m in mine})
        n += 5
    assert hits / n >= 0.9


def test_neighbours_edges(spark):
    base = [1.0, 0.0, 0.5]
    rows = [(k, base) for k in range(0, 60)] + [(100, None), (101, [0.0, 0.0, 0.0]), (102, [1.0, None, 2.0]), (150, [float("nan"), 1.0, 1.0]), (None, base), (50, base), (103, [1.0])]
    got = crosspolytope.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    by = defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        by[r["query_id"]].append(r["vec_id"])
    assert by == {0: [1, 2, 3, 4, 5], 50: [0, 1, 2, 3, 4]}
