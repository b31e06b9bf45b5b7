"""Tables over pages and tables as graphs, from the lines of orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from folia.operators import table_graph
from folia.plans.registry import query
from folia.plans.runtime import dealt
from folia.session import table

# a table for each order: a header, where the order is even, and a row for each line; tables of forty orders are a document, two to a page at most
_GRID = """o AS (SELECT l_orderkey AS k, l_orderkey // 40 AS doc, l_orderkey % 40 AS pos, (l_orderkey % 40) // (1 + (l_orderkey // 40) % 2) AS page, (l_orderkey % 3 = 0)::INT AS wide,
        CASE WHEN l_orderkey % 7 = 0 THEN 'Lines of order ' || l_orderkey || ' as shipped by its suppliers in parts' ELSE '' END AS caption, CASE WHEN l_orderkey % 11 = 0 THEN 'sums in full' ELSE '' END AS footnote FROM lineitem GROUP BY ALL),
    r AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag || ' ' || l_linestatus) AS i,
        CASE WHEN row_number() OVER (PARTITION BY k ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag || ' ' || l_linestatus) = 1 AND k % 2 = 1 AND k % 7 <> 0 AND k % 11 <> 0 AND k % 5 < 3 THEN '' ELSE l_returnflag || ' ' || l_linestatus END AS c1,
        'supplier ' || l_suppkey AS c2, l_quantity::BIGINT::VARCHAR AS c3, wide FROM lineitem JOIN o ON k = l_orderkey),
    g AS (SELECT k, 0 AS i, 'Flag' AS c1, 'Who Ships' AS c2, 'Pieces' AS c3, wide FROM o WHERE k % 2 = 0 UNION ALL SELECT * FROM r)"""


def grids(spark, d):
    """(k, doc, pos, page, caption, footnote, grid) as _GRID has them; wide grids have a fourth column."""
    k = F.col("l_orderkey")
    li = table(spark, d, "lineitem").select(
        k.alias("k"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("flag")).alias("x"))
    o = dealt(li, li.count(), "k").groupBy("k").agg(F.sort_array(F.collect_list("x")).alias("x"))
    cut = (F.col("k") % 2 == 1) & (F.col("k") % 7 != 0) & (F.col("k") % 11 != 0) & (F.col("k") % 5 < 3)
    wide = F.col("k") % 3 == 0
    cells = lambda a, b, c: F.when(wide, F.array(a, b, c, F.lit("x"))).otherwise(F.array(a, b, c))
    body = F.transform("x", lambda e, i: cells(F.when((i == 0) & cut, F.lit("")).otherwise(e["flag"]), F.concat(F.lit("supplier "), e["l_suppkey"].cast("string")), e["l_quantity"].cast("long").cast("string")))
    head = F.array(cells(F.lit("Flag"), F.lit("Who Ships"), F.lit("Pieces")))
    doc, pos = F.floor(F.col("k") / 40), F.col("k") % 40
    return o.select(
        "k", doc.alias("doc"), pos.alias("pos"), F.floor(pos / (1 + doc % 2)).alias("page"),
        F.when(F.col("k") % 7 == 0, F.concat(F.lit("Lines of order "), F.col("k").cast("string"), F.lit(" as shipped by its suppliers in parts"))).otherwise("").alias("caption"),
        F.when(F.col("k") % 11 == 0, "sums in full").otherwise("").alias("footnote"), F.when(F.col("k") % 2 == 0, F.concat(head, body)).otherwise(body).alias("grid"))


@query(f"""WITH {_GRID}, p AS (SELECT *, caption = '' AND footnote = '' AND page > 0 AND lag(page) OVER w = page - 1 AND lag(wide) OVER w = wide AS goes_on FROM o WINDOW w AS (PARTITION BY doc ORDER BY pos)),
    h AS (SELECT *, max(CASE WHEN goes_on IS NOT TRUE THEN pos END) OVER (PARTITION BY doc ORDER BY pos) AS head FROM p),
    b AS (SELECT h.doc, h.head, h.pos, h.page, g.i, c1, c2, c3 FROM h JOIN g USING (k) WHERE NOT (h.pos <> h.head AND g.i = 0 AND (h.doc * 40 + h.head) % 2 = 0)),
    m AS (SELECT *, coalesce(nullif(c1, ''), CASE WHEN pos > head THEN last_value(nullif(c1, '') IGNORE NULLS) OVER (PARTITION BY doc, head ORDER BY pos, i) ELSE '' END, '') AS f FROM b)
    SELECT doc, head AS pos, count(DISTINCT pos)::INT AS n_parts, max(page) AS last_page, count(*)::INT AS n_rows, md5(string_agg(f || '|' || c2 || '|' || c3, chr(10) ORDER BY m.pos, i)) AS rows FROM m GROUP BY doc, head""")
def merged_tables(spark, d):
    """Tables that go on over pages, as one: repeated headers left out, cut spans filled in."""
    m = table_graph.merge_continued(grids(spark, d), ["doc"])
    rows = F.array_join(F.transform("grid", lambda r: F.array_join(F.slice(r, 1, 3), "|")), "\n")
    return m.select("doc", "pos", "n_parts", "last_page", F.size("grid").alias("n_rows"), F.md5(rows).alias("rows"))


_NAMED = f"""{_GRID}, w AS (SELECT *, trim(concat_ws(' ', caption, footnote)) AS said FROM o),
    n AS (SELECT *, 'Table: ' || CASE WHEN said <> '' THEN array_to_string(string_split(said, ' ')[1:8], ' ') ELSE 'Node ' || k END || '...' AS name FROM w),
    f AS (SELECT k, min(i) AS top FROM g GROUP BY 1), q AS (SELECT g.*, i = top AS head FROM g JOIN f USING (k)),
    c AS (SELECT k, head, i, j, lower(trim(v)) AS name, v FROM (SELECT k, head, i, unnest([1, 2, 3, 4]) AS j, unnest([c1, c2, c3, CASE WHEN wide = 1 THEN 'x' ELSE '' END]) AS v FROM q) WHERE trim(v) <> ''),
    t AS (SELECT b.k, b.i, b.j, b.name, CASE WHEN b.head THEN 'COLUMN' ELSE coalesce(upper(replace(trim(a.v), ' ', '_')), '') END AS type, CASE WHEN b.head THEN 0 ELSE 1 END AS later FROM c b LEFT JOIN c a ON a.k = b.k AND a.head AND a.j = b.j WHERE b.head OR try_cast(b.v AS DOUBLE) IS NULL),
    u AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY k, name ORDER BY later, i, j) = 1),
    e AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY later, i, j) AS place, name, type FROM u)"""


@query(f"WITH {_NAMED} SELECT k, 0 AS place, name, 'TABLE' AS type FROM n UNION ALL SELECT * FROM e")
def table_entities(spark, d):
    """The first row of each grid is taken for its header."""
    return table_graph.table_entities(grids(spark, d), "k").select("k", "place", "name", "type")


@query(f"WITH {_NAMED} SELECT n.k, n.name AS src, e.name AS dst, 9.0::DOUBLE AS weight, 'Table ''' || n.name || ''' contains data about ''' || e.name || '''.' AS description FROM n JOIN e USING (k)")
def table_relations(spark, d):
    return table_graph.table_relations(table_graph.table_entities(grids(spark, d), "k"), "k")


@query(f"""WITH RECURSIVE {_GRID}, f AS (SELECT k, min(i) AS top FROM g GROUP BY 1),
    x AS (SELECT k, c1 || ' | ' || c2 || ' | ' || c3 || CASE WHEN wide = 1 THEN ' | x' ELSE '' END AS r, row_number() OVER (PARTITION BY k ORDER BY i) AS n FROM g JOIN f USING (k) WHERE i > top),
    y AS (SELECT *, len(list_filter(string_split(r, ' '), lambda z: z <> '')) AS w FROM x),
    p AS (SELECT k, n, 0 AS batch, w AS held FROM y WHERE n = 1 UNION ALL SELECT y.k, y.n, batch + (held + w > 16)::INT, CASE WHEN held + w > 16 THEN w ELSE held + w END FROM p JOIN y ON y.k = p.k AND y.n = p.n + 1)
    SELECT k, batch::INT AS batch, count(*) AS n_rows, md5(string_agg(r, chr(10) ORDER BY n)) AS rows FROM p JOIN y USING (k, n) GROUP BY k, batch""")
def table_batches(spark, d):
    """Rows of each table in batches of 16 words."""
    return table_graph.batches_of(grids(spark, d), ["k"], 16).withColumn("rows", F.md5("rows"))
