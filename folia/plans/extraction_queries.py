"""Default extraction and parsing over documents and event properties."""

from __future__ import annotations

from pyspark.sql import functions as F

from folia.operators import extraction
from folia.plans.registry import query
from folia.session import table

_MENTIONS = """s AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?])[ \\t\\n\\x0B\\f\\r]+', '\\1' || chr(1), 'g'), chr(1))) AS s,
        generate_subscripts(string_split(regexp_replace(text, '([.!?])[ \\t\\n\\x0B\\f\\r]+', '\\1' || chr(1), 'g'), chr(1)), 1) AS k FROM documents),
    m AS (SELECT doc_id, k, lower(unnest(regexp_extract_all(s, '[a-z,;] ([A-Z][a-z]+)', 1))) AS name FROM s)"""


@query(f"WITH {_MENTIONS} SELECT doc_id, name, count(*) AS n, count(DISTINCT k) AS n_sentences FROM m GROUP BY 1, 2")
def default_mentions(spark, d):
    m = extraction.mentions(table(spark, d, "documents"), "doc_id", "text")
    return m.groupBy("doc_id", "name").agg(F.sum("n").alias("n"), F.count("*").alias("n_sentences"))


@query(f"WITH {_MENTIONS}, u AS (SELECT DISTINCT doc_id, k, name FROM m) SELECT x.name AS a, y.name AS b, count(*) AS weight FROM u x JOIN u y ON x.doc_id = y.doc_id AND x.k = y.k AND x.name < y.name GROUP BY 1, 2")
def co_mentions(spark, d):
    return extraction.co_mentions(extraction.mentions(table(spark, d, "documents"), "doc_id", "text"), "doc_id")


@query("""SELECT event_type, ((props::JSON->>'k')::BIGINT % 10)::BIGINT AS k, count(*) AS n FROM events GROUP BY ALL""")
def json_fields(spark, d):
    """A field of the JSON object in an answer with words around it."""
    answer = F.concat(F.lit("Here it is: "), "props", F.lit(" (end)"))
    k = F.get_json_object(extraction.first_object(answer), "$.k").cast("long") % 10
    return table(spark, d, "events").groupBy("event_type", k.alias("k")).agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, lower(o_orderstatus) AS status, o_orderpriority AS priority FROM orders""")
def key_value_lines(spark, d):
    text = F.concat(F.lit("Status : "), F.lower("o_orderstatus"), F.lit("\nnoise\nPriority:x\npriority:  "), "o_orderpriority")
    t = table(spark, d, "orders").select("o_orderkey", extraction.key_values(text).alias("m"))
    return t.select("o_orderkey", F.col("m")["status"].alias("status"), F.col("m")["priority"].alias("priority"))
