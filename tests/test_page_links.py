"""All links of all pages."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry


def test_every_link_comes_back(spark, tiny):
    pages = spark.read.parquet(f"{tiny}/pages.parquet").select("page_id", "html").collect()
    want = Counter((r["page_id"], k, x) for r in pages for k, x in enumerate(re.findall(r'href="([^"]*)"', r["html"] or ""), 1))
    assert max(k for _, k, _ in want) > 3
    assert Counter((r["page_id"], r["position"], r["link"]) for r in entry.queries()["page_links_all"](spark, tiny).collect()) == want


def test_anls_of_whole_turns(spark, tiny):
    """In characters, not bytes."""
    turns = {(r["conv_id"], r["turn"]): re.sub(r"\s+", " ", r["text"]) for r in spark.read.parquet(f"{tiny}/conversations.parquet").collect()}

    def distance(a, b):
        row = np.arange(len(b) + 1)
        other = np.array([ord(c) for c in b])
        for i, c in enumerate(a, 1):
            # a step from the left is a running minimum once the place is taken off
            best = np.minimum(row[1:] + 1, row[:-1] + (other != ord(c)))
            row = np.minimum.accumulate(np.concatenate(([i], best)) - np.arange(len(b) + 1)) + np.arange(len(b) + 1)
        return int(row[-1])

    got = {(r["conv_id"], r["turn"]): r["anls"] for r in entry.queries()["metric_anls"](spark, tiny).collect()}
    assert len(got) > 40
    for (conv, turn), x in got.items():
        a, b = (turns[conv, k].strip().lower() for k in (turn, turn + 1))
        s = 1 - distance(a, b) / max(len(a), len(b))
        assert x == pytest.approx(s if s > 0.1 else 0, abs=2e-6)
