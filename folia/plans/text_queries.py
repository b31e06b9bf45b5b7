"""Text functions, chunks and record parsing over documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from folia.functions import text as X
from folia.operators import blocks
from folia.operators.chunking import sentence_chunks
from folia.plans.registry import query
from folia.session import table


@query("SELECT doc_id, len(string_split(regexp_replace(text, '([.!?])[ \\t\\n\\x0B\\f\\r]+', '\\1' || chr(1), 'g'), chr(1)))::INT AS n_sentences FROM documents")
def sentence_count(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(X.sentences("text")).alias("n_sentences"))


BUDGET = 128

_ITEMS = f"""
    s AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?])[ \\t\\n\\x0B\\f\\r]+', '\\1' || chr(1), 'g'), chr(1))) AS s,
                 generate_subscripts(string_split(regexp_replace(text, '([.!?])[ \\t\\n\\x0B\\f\\r]+', '\\1' || chr(1), 'g'), chr(1)), 1) AS k FROM documents),
    w AS (SELECT doc_id, k, len(list_filter(regexp_split_to_array(s, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) AS n FROM s),
    p AS (SELECT doc_id, k, j, least({BUDGET}, n - {BUDGET} * j) AS n FROM (SELECT *, unnest(range((n + {BUDGET - 1}) // {BUDGET})) AS j FROM w WHERE n > 0)),
    i AS (SELECT doc_id, n, row_number() OVER (PARTITION BY doc_id ORDER BY k, j) AS k FROM p)"""


@query(f"""
    WITH RECURSIVE {_ITEMS},
    r AS (SELECT doc_id, k, n, n AS held, 0 AS chunk_id FROM i WHERE k = 1
          UNION ALL
          SELECT i.doc_id, i.k, i.n, CASE WHEN r.held + i.n > {BUDGET} THEN i.n ELSE r.held + i.n END,
                 CASE WHEN r.held + i.n > {BUDGET} THEN r.chunk_id + 1 ELSE r.chunk_id END
          FROM r JOIN i ON i.doc_id = r.doc_id AND i.k = r.k + 1)
    SELECT doc_id, chunk_id, sum(n)::BIGINT AS n_words, count(*) AS n_sentences FROM r GROUP BY ALL""")
def chunk_pack(spark, d):
    return sentence_chunks(table(spark, d, "documents"), BUDGET).drop("text")


@query("SELECT doc_id, trim(regexp_replace(lower(regexp_replace(trim(text), '[\\x00-\\x1f\\x7f-\\x9f]', '', 'g')), '[^A-Za-z0-9 ]', ' ', 'g')) AS cleaned FROM documents")
def clean_string(spark, d):
    return table(spark, d, "documents").select("doc_id", X.clean_string("text").alias("cleaned"))


@query("""SELECT p_partkey, regexp_replace(trim(lower(p_name)), '\\s+', ' ', 'g') AS name, regexp_replace(trim(upper(p_type || ' ' || p_brand)), '\\s+', '_', 'g') AS type FROM part""")
def name_clean(spark, d):
    return table(spark, d, "part").select("p_partkey", X.clean_name("p_name").alias("name"), X.clean_type(F.concat_ws(" ", "p_type", "p_brand")).alias("type"))


@query("SELECT doc_id, md5(regexp_replace(text, '-\\s+', '-', 'g')) AS fixed FROM documents")
def hyphen_fix(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(X.fix_hyphens("text")).alias("fixed"))


@query("""SELECT page_id, md5(regexp_replace(html, '<[^>]+>', '', 'g')) AS stripped, regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1) AS heading FROM pages""")
def page_text(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(X.strip_tags("html")).alias("stripped"), F.regexp_extract("html", r"(?s)<h1[^>]*>(.*?)</h1>", 1).alias("heading"))


_LINES = "l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)"


def _lines(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("pos", F.col("pos") + 1)


# menus of pages as lines of contents: every item with leaders by its length, and its position for a page
_MENU = r"""i AS (SELECT page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1) AS i FROM pages),
    l AS (SELECT page_id, generate_subscripts(i, 1) AS pos, regexp_replace(unnest(i), '<[^>]+>', '', 'g') AS name FROM i),
    m AS (SELECT page_id, pos, name || repeat(' .', (length(name) % 6)::INT) || ' ' || pos AS line FROM l)"""


@query(rf"""WITH {_MENU}
    SELECT page_id, pos::INT AS pos FROM m WHERE length(line) > 0 AND (regexp_matches(line, '(\.\s*\..*?){{2,}}')
        OR (length(line) < 80 AND regexp_matches(line, '[.\s]{{2,}}\d') AND length(regexp_replace(line, '[^.\s]', '', 'g')) / length(line) > 0.25))""")
def toc_filter(spark, d):
    items = F.posexplode(F.regexp_extract_all("html", F.lit(r"<li>(.*?)</li>"), 1))
    t = table(spark, d, "pages").select("page_id", items.alias("pos", "name")).withColumns({"pos": F.col("pos") + 1, "name": X.strip_tags("name")})
    line = F.concat("name", F.expr("repeat(' .', length(name) % 6)"), F.lit(" "), F.col("pos").cast("string"))
    return t.where(X.is_contents(line)).select("page_id", "pos")


@query(r"""WITH t AS (SELECT 'document' AS of, doc_id::VARCHAR AS id, text FROM documents UNION ALL SELECT 'line', l_orderkey || '-' || l_linenumber || '-' || l_partkey, CASE WHEN l_quantity < 25 THEN l_orderkey || ' / ' || l_linenumber ELSE l_returnflag || ' ' || l_orderkey END FROM lineitem)
    SELECT of, id FROM t WHERE length(text) > 0 AND (len(regexp_extract_all(text, '(?:www\.\S+|https?://\S+|\S+@\S+\.\w{2,})')) >= 2
        OR (length(trim(text)) < 20 AND regexp_matches(trim(text), '^[\d\s/\\-]+$')))""")
def boilerplate_filter(spark, d):
    """Whole documents with two addresses or more, and page marks among order lines."""
    docs = table(spark, d, "documents").select(F.lit("document").alias("of"), F.col("doc_id").cast("string").alias("id"), "text")
    mark = F.when(F.col("l_quantity") < 25, F.concat_ws(" / ", "l_orderkey", "l_linenumber")).otherwise(F.concat_ws(" ", "l_returnflag", "l_orderkey"))
    marks = table(spark, d, "lineitem").select(F.lit("line").alias("of"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("id"), mark.alias("text"))
    return docs.unionByName(marks).where(X.is_boilerplate("text")).select("of", "id")


_STOP = ", ".join(f"'{w}'" for w in X.CONNECTORS)


@query(f"""WITH {_LINES}, t AS (SELECT doc_id, pos, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS t FROM l),
    b AS (SELECT *, regexp_replace(t, '[''"]+$', '') AS bare FROM t)
    SELECT doc_id, pos::INT AS pos FROM b
    WHERE len(list_filter(regexp_split_to_array(t, '\\s+'), lambda x: x <> '')) >= 5 AND length(t) >= 25
      AND (t LIKE '%-' OR regexp_matches(bare, '[,:;]$') OR NOT regexp_matches(bare, '[.!?]$')
           OR coalesce(lower(regexp_extract_all(bare, '\\w+')[-1]) IN ({_STOP}), false))""")
def incomplete_paragraph(spark, d):
    return _lines(spark, d).where(X.looks_incomplete("line")).select("doc_id", "pos")


@query("""WITH w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM documents),
    c AS (SELECT doc_id, text, w, list_filter(range(1, len(w) - 13), lambda i: len(list_filter(w[i:i+14], lambda x: length(x) = 1)) / 15 >= 0.9) AS hits FROM w)
    SELECT doc_id, md5(CASE WHEN len(hits) = 0 THEN text ELSE array_to_string(w[1:hits[1]-1], ' ') END) AS cut FROM c""")
def garbage_truncate(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(X.cut_garbage("text")).alias("cut"))


@query("""WITH r AS (SELECT p_partkey, 0 AS pos, p_name, p_type, p_brand, p_retailprice FROM part)
    SELECT p_partkey, 0 AS pos, 'entity' AS kind, lower(p_name) AS name, upper(p_type) AS type, NULL AS target, p_brand AS description, NULL::DOUBLE AS weight FROM r
    UNION ALL
    SELECT p_partkey, 1, 'relationship', lower(p_name), NULL, lower(p_brand), p_type, CASE WHEN p_partkey % 3 = 0 THEN 1.0 ELSE p_size::DOUBLE END FROM part""")
def record_parse(spark, d):
    mark = F.when(F.col("p_partkey") % 3 == 0, F.lit("strong")).otherwise(F.col("p_size").cast("string"))
    text = F.concat(
        F.lit('("entity"<|>'), "p_name", F.lit("<|>"), "p_type", F.lit("<|>"), "p_brand", F.lit(')##("relationship"<|>'), "p_name", F.lit("<|>"), "p_brand", F.lit("<|>"), "p_type", F.lit("<|>"), mark,
        F.lit(')##("entity"<|>broken)<|COMPLETE|>'),
    )
    return blocks.parse_records(table(spark, d, "part").withColumn("raw", text), ["p_partkey"], "raw")


@query("""SELECT doc_id, array_to_string(list_filter(list_transform(regexp_split_to_array(text, '\\n|, '), lambda x: trim(x, ' ')), lambda x: x <> ''), '|') AS parts FROM documents""")
def split_marks(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(X.split_any("text", ["\n", ", "]), "|").alias("parts"))


@query("""SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')[1:20], ' ') AS head FROM documents""")
def truncate_words(spark, d):
    return table(spark, d, "documents").select("doc_id", X.truncate_words("text", 20).alias("head"))


@query(f"""WITH {_LINES}, f AS (SELECT doc_id, pos, list_filter(regexp_split_to_array(line, '\\s+'), lambda x: x <> '')[1] AS w, line FROM l)
    SELECT doc_id, count(*) FILTER (WHERE length(w) > 1 AND upper(w) = w AND lower(w) <> w) AS n_acronyms, count(*) FILTER (WHERE regexp_matches(line, '\\d')) AS n_digit_lines FROM f GROUP BY doc_id""")
def line_flags(spark, d):
    return _lines(spark, d).groupBy("doc_id").agg(F.sum(X.is_acronym("line").cast("long")).alias("n_acronyms"), F.sum(X.has_digit("line").cast("long")).alias("n_digit_lines"))
