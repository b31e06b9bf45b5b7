"""Queries held against their SQL on rows that engines read differently."""

from __future__ import annotations


import duckdb

import __spark_entry__ as entry


def both(spark, folder, name, **tables):
    """Rows of a query and of its SQL over tables (schema, rows)."""
    con = duckdb.connect()
    for t, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    df, sql = entry.queries()[name](spark, str(folder)), con.sql(entry.oracle_sql()[name])
    cols = sorted(df.columns)
    at = [sql.columns.index(c) for c in cols]
    return sorted(map(str, (tuple(r[c] for c in cols) for r in df.collect()))), sorted(map(str, (tuple(r[k] for k in at) for r in sql.fetchall())))


def test_words_end_at_letters_beyond_ascii(spark, tmp_path):
    """An acronym, code or number beside such a letter or digit stands alone; beside an underscore it does not."""
    edges = ["SSß", "überNO éNATOé", "x_ABC ABC_x", "٤777 777٤", "CÓ ́NO", "AB"]
    start = "we met Anna at x.y@z.org on é0123456789abcdef0ß and 123 "
    rows = [(k, start + e) for k, e in enumerate(edges)]
    got, want = both(spark, tmp_path, "gleaned_records", documents=("doc_id long, text string", rows))
    assert got == want and any("SS" in g for g in got) and not any("ABC" in g for g in got)


def test_halves_go_to_the_even_number(spark, tmp_path):
    """Columns of tables by values of a half: 2.5 has as many as 2, not as 3."""
    rows = [(user, 50 * k, v, "view") for user, values in enumerate([(2.5, 2.0, 3.0), (0.5, 0.0, 1.0), (3.5, 4.0, 3.0), (2.4999, 2.5001, 5.0)]) for k, v in enumerate(values)]
    got, want = both(spark, tmp_path, "split_tables", events=("user_id long, event_id long, value double, event_type string", rows))
    assert got == want and any("True" in g for g in got)
