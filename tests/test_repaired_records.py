"""Records of an extraction are repaired in its row."""

from __future__ import annotations

from folia.operators import extracted


def test_no_shuffle_after_the_records_met(spark):
    """Once the records of an extraction are together nothing of them is shuffled again; nulls of keys and names as in joins."""
    ents = [("k", 2, "Abcdefghij", "a b", "y"), ("k", 1, " abcdefghij ", "A B", None), ("k", 3, None, "t", "z"), (None, 1, "solo name", "t", "d"), ("only", 1, "e", "t", "d")]
    rels = [("k", 2, "abcdefghiJ", "abcdefghix", "r", 2.0, "p"), ("k", 1, "abcdefghij", "abcdefghij", "r", 1.0, "q"), ("k", 3, None, "far", "r", 1.0, ""), (None, 1, "solo name", "solo name", "r", 1.0, ""), ("bare", 1, "u", "v", None, 1.0, "")]
    e, r = extracted.repair_records(
        spark.createDataFrame(ents, "k string, pos int, name string, type string, description string"), spark.createDataFrame(rels, "k string, pos int, src string, dst string, relation string, weight double, description string"), "k")
    assert "Exchange" not in e._jdf.queryExecution().executedPlan().toString() + r._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, r.collect())) == [("bare", "u", "v", None, 1.0, ""), ("k", "abcdefghij", "abcdefghij", "r", 1.0, "q")]
    assert sorted(map(str, map(tuple, e.collect()))) == sorted(map(str, [
        ("k", "abcdefghij", "A_B", " y"), ("k", None, "T", "z"), (None, "solo name", "T", "d"), ("only", "e", "T", "d"),
        ("k", None, "UNKNOWN", ""), ("k", "far", "UNKNOWN", ""), (None, "solo name", "UNKNOWN", ""), ("bare", "u", "UNKNOWN", ""), ("bare", "v", "UNKNOWN", "")]))
