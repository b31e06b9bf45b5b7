"""Lines without a word among others."""

from __future__ import annotations

from folia.functions import text as X
from tests.test_sql_edges import both


def test_line_flags_of_blank_lines(spark, tmp_path):
    """Empty and blank lines hold no acronym; a text of nothing else has zeros."""
    rows = [(0, "NASA said\n\nno 5\n  \t\nUN A 7\n"), (1, ""), (2, " \n\n"), (3, None), (4, "Ab\n\n")]
    got, want = both(spark, tmp_path, "line_flags", documents=("doc_id long, text string", rows))
    assert got == want and got[0] == "(0, 2, 2)" and len(got) == 4


def test_acronyms_of_blank_texts(spark):
    df = spark.createDataFrame([("",), (" \t",), (None,), ("UN x",)], "t string")
    assert [r[0] for r in df.select(X.is_acronym("t")).collect()] == [False, False, False, True]
