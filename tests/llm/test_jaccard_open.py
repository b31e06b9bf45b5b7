"""What travels in the near-duplicate stage: sets that fine bitmaps leave open, and no more."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np

from folia.llm import common, jaccard


def test_open_pairs_lose_no_link():
    """Every pair of different roots that reaches 4/5 is open, at sizes on both sides of a length of the bitmap; unlike long sets are not."""
    r = np.random.default_rng(3)
    sets = []
    for n in (5, 900, 1023, 1025, 2000, 2100, 4000, 4200):
        s = r.integers(0, 1 << 63, n, np.uint64)
        sets += [np.unique(np.concatenate((s[int(n * cut) :], r.integers(0, 1 << 63, int(n * new), np.uint64)))) for cut, new in ((0, 0), (0.1, 0.1), (0.15, 0), (0, 0.2), (0.6, 0.6))]
    size, root = np.array([len(s) for s in sets]), np.arange(len(sets))
    got = {tuple(sorted(p)) for p in jaccard.open_pairs([jaccard.fine_map(s) for s in sets], size, root).tolist()}
    shared = lambda a, b: len(np.intersect1d(sets[a], sets[b]))
    alike = {(a, b) for a, b in combinations(range(len(sets)), 2) if jaccard._similar(shared(a, b), size[a], size[b])}
    far = {(a, b) for a, b in combinations(range(len(sets)), 2) if shared(a, b) < 0.5 * min(size[a], size[b]) and size[a] > 50}
    assert len(alike) > 20 and alike <= got and not far & got
    assert not len(jaccard.open_pairs([jaccard.fine_map(s) for s in sets], size, np.zeros(len(sets), np.int64)))


def test_crowded_key_of_unlike_texts_sends_no_sets(spark, monkeypatch):
    """Long texts that share a passage alone meet in crowded keys; their sets stay where they are, in parts too."""
    r, sent = random.Random(8), []
    word = lambda: f"w{r.randrange(50000)}"
    passage = " ".join(word() for _ in range(1000))
    texts = [passage + " " + " ".join(word() for _ in range(2500)) for _ in range(45)]
    docs = common.written(spark.createDataFrame([(k, k, t) for k, t in enumerate(texts)], "doc_id long, row long, text string"))
    plain = jaccard.stored

    def counted(*a):
        out = plain(*a)
        sent.append(0 if len(a) > 3 else out.count())
        return out

    monkeypatch.setattr(jaccard, "stored", counted)
    monkeypatch.setattr(jaccard, "CHUNK", 20)
    monkeypatch.setattr(jaccard, "COMMON", 0)
    named = jaccard.near_duplicates(docs, row_col="row").collect()
    assert len({x["root"] for x in named}) == len(texts) and sum(sent) == 0
