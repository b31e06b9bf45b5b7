"""Page repair, tree building, reranking and routing over lines of documents and the order tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from folia.operators import bm25, repair, retrieval, tree
from folia.plans.graph_queries import _PPR, co_suppliers
from folia.plans.registry import query
from folia.plans.runtime import dealt
from folia.plans.search_queries import _BM25
from folia.session import table

_LINES = """b AS (SELECT doc_id, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS t FROM documents WHERE text IS NOT NULL)),
    n AS (SELECT *, (pos // 8)::INT AS page, len(list_filter(string_split(text, ' '), lambda x: x <> '')) AS w FROM b)"""


def lines(spark, d):
    """(doc_id, pos, page, type, text_level, text, w): a block for each line of a document, eight to a page; w counts its words."""
    b = table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    w = F.size(F.filter(F.split("text", " "), lambda x: x != ""))
    return b.select("doc_id", "pos", F.floor(F.col("pos") / 8).cast("int").alias("page"), F.lit("text").alias("type"), F.lit(None).cast("int").alias("text_level"), "text", w.alias("w"))


@query()
def page_continuations(spark, d):
    """Lines that end without a stop and what goes on from them; tests hold it against a plain scan."""
    out = repair.continuations(lines(spark, d), ["doc_id"], r"w > 0 and not text rlike '[.!?]\\s*$'")
    return out.select("doc_id", "pos", F.array_join(F.transform("picked", lambda x: x.cast("string")), ",").alias("picked"), F.md5("merged").alias("merged"))


_OUTLINE = f"""{_LINES}, o AS (SELECT doc_id, pos AS pdf_id, (w % 3 + 1)::INT AS text_level, coalesce(lead(pos) OVER (PARTITION BY doc_id ORDER BY pos), 1000000000) AS end_id FROM n WHERE w BETWEEN 1 AND 12),
    p AS (SELECT *, coalesce((SELECT max(q.pdf_id) FROM o q WHERE q.doc_id = o.doc_id AND q.pdf_id < o.pdf_id AND q.text_level < o.text_level), 0) AS parent_id FROM o),
    t AS (SELECT *, min(pdf_id) OVER (PARTITION BY doc_id) AS top FROM p),
    r AS (SELECT doc_id, pdf_id, end_id, CASE WHEN pdf_id = top THEN 0 ELSE text_level END AS text_level, CASE WHEN pdf_id <> top AND parent_id = 0 THEN top ELSE parent_id END AS parent_id FROM t)"""


def outline(spark, d):
    """Lines of one to twelve words as headings, their level by the number of words, with the parent and end of each; 0 where there is no parent."""
    o = lines(spark, d).where("w between 1 and 12").select("doc_id", F.col("pos").alias("pdf_id"), (F.col("w") % 3 + 1).alias("text_level"))
    o = tree.heading_parents(o, ["doc_id"], "pdf_id", "text_level", 3).withColumn("parent_id", F.coalesce("parent", F.lit(0))).drop("parent")
    end = F.coalesce(F.lead("pdf_id").over(Window.partitionBy("doc_id").orderBy("pdf_id")), F.lit(1000000000))
    return repair.refine_outline(o.withColumn("end_id", end), ["doc_id"])


@query(f"WITH {_OUTLINE} SELECT doc_id, pdf_id, text_level, parent_id FROM r")
def outline_refine(spark, d):
    return outline(spark, d).select("doc_id", "pdf_id", "text_level", "parent_id")


@query(f"""WITH {_OUTLINE}, m AS (SELECT doc_id, pdf_id AS spot, pdf_id, true AS outline_node, text_level, parent_id FROM r
        UNION ALL SELECT n.doc_id, r.pdf_id, n.pos, false, NULL, NULL FROM n JOIN r ON n.doc_id = r.doc_id AND n.pos > r.pdf_id AND n.pos < r.end_id),
    x AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY spot, outline_node DESC, pdf_id) AS index_id FROM m)
    SELECT x.doc_id, x.index_id::INT AS index_id, x.pdf_id, x.outline_node, CASE WHEN NOT x.outline_node THEN own.index_id WHEN x.text_level = 0 OR x.parent_id IS NULL THEN 0
        ELSE (SELECT max(y.index_id) FROM x y WHERE y.doc_id = x.doc_id AND y.pdf_id = x.parent_id) END::INT AS parent_index
    FROM x JOIN x own ON own.doc_id = x.doc_id AND own.spot = x.spot AND own.outline_node""")
def tree_build(spark, d):
    blocks = lines(spark, d).select("doc_id", F.col("pos").alias("pdf_id"))
    return repair.build_tree(blocks, outline(spark, d), ["doc_id"]).select("doc_id", "index_id", "pdf_id", "outline_node", "parent_index")


@query("""WITH k AS (SELECT p_partkey, p_name, p_brand, CASE p_partkey % 5 WHEN 0 THEN 'NodeType.TABLE' WHEN 1 THEN 'NodeType.IMAGE' WHEN 2 THEN 'NodeType.TITLE' WHEN 3 THEN 'NodeType.TEXT' ELSE 'root' END AS t, p_partkey % 3 = 0 AS bare FROM part)
    SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'table' WHEN 1 THEN 'image' WHEN 2 THEN 'title' ELSE 'text' END AS kind,
        CASE p_partkey % 5 WHEN 0 THEN NOT bare WHEN 1 THEN NOT bare WHEN 2 THEN length(p_name) > 3 WHEN 3 THEN length(p_name || ' ' || p_name || ' is a part') >= 20 ELSE false END AS valid FROM k""")
def valid_nodes(spark, d):
    k = F.col("p_partkey") % 5
    t = F.when(k == 0, "NodeType.TABLE").when(k == 1, "NodeType.IMAGE").when(k == 2, "NodeType.TITLE").when(k == 3, "NodeType.TEXT").otherwise("root")
    some = F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand"))
    content = F.when(k == 3, F.concat_ws(" ", "p_name", "p_name", F.lit("is a part"))).otherwise(F.col("p_name"))
    p = table(spark, d, "part").withColumn("t", t)
    return p.select("p_partkey", repair.chunk_type(F.col("t")).alias("kind"), repair.valid_node(F.col("t"), content, some, F.lit(None).cast("string"), F.lit("")).alias("valid"))


@query("""WITH p AS (SELECT a.conv_id, a.turn, trim(regexp_replace(a.text, '\\s+', ' ', 'g'), ' ') AS q, trim(regexp_replace(b.text, '\\s+', ' ', 'g'), ' ') AS r FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn + 1 = b.turn)
    SELECT conv_id, turn, length(q) >= 5 AND length(r) >= 5 AND q <> r AND (right(q, 1) IN ('？', '?', '。') OR length(q) >= 8) AS valid FROM p""")
def valid_pairs(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", F.regexp_replace("text", r"\s+", " ").alias("q"))
    p = c.join(c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("q").alias("r")), ["conv_id", "turn"])
    return p.select("conv_id", "turn", repair.valid_qa(F.col("q"), F.col("r")).alias("valid"))


@query("""SELECT l_orderkey, CASE WHEN count(l_linenumber) = 1 THEN (min(l_linenumber) + 1)::VARCHAR ELSE (min(l_linenumber) + 1) || '-' || (max(l_linenumber) + 1) END AS pages FROM lineitem GROUP BY 1""")
def page_ranges(spark, d):
    return repair.page_range(table(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("""WITH t AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: CASE WHEN right(x, 1) = '-' THEN left(x, length(x) - 1) ELSE x || ' ' END) AS t FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, md5(trim(array_to_string(t, ''), ' ')) AS merged FROM t""")
def stitch_lines(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.md5(repair.stitched(F.split("text", "\n"))).alias("merged"))


@query("""SELECT l_suppkey, l_returnflag, row_number() OVER (PARTITION BY l_suppkey ORDER BY min(l_orderkey * 8 + l_linenumber), l_returnflag)::INT AS place FROM lineitem GROUP BY 1, 2""")
def unique_in_order(spark, d):
    li = table(spark, d, "lineitem").withColumn("at", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    return retrieval.ordered_unique(li, ["l_suppkey"], "l_returnflag", "at")


@query("""WITH v AS (SELECT s_suppkey AS node FROM supplier WHERE s_nationkey < 20), e AS (SELECT DISTINCT l_suppkey AS src, (l_partkey % 100)::BIGINT AS dst FROM lineitem)
    SELECT src, dst, src IN (SELECT node FROM v) AND dst IN (SELECT node FROM v) AS good FROM e""")
def edge_endpoints(spark, d):
    v = table(spark, d, "supplier").where("s_nationkey < 20").select(F.col("s_suppkey").alias("node"))
    e = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("src"), (F.col("l_partkey") % 100).cast("long").alias("dst")).distinct()
    good, bad = retrieval.checked_edges(e, v)
    return good.withColumn("good", F.lit(True)).unionByName(bad.withColumn("good", F.lit(False)))


@query("""WITH p AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem), e AS (SELECT x.l_suppkey AS a, y.l_suppkey AS b, count(*) AS weight FROM p x JOIN p y ON x.l_orderkey = y.l_orderkey AND x.l_suppkey < y.l_suppkey GROUP BY ALL),
    m AS (SELECT CASE WHEN a % 5 = 0 THEN a + 1 ELSE a END AS a, CASE WHEN b % 5 = 0 THEN b + 1 ELSE b END AS b, weight FROM e)
    SELECT least(a, b) AS a, greatest(a, b) AS b, sum(weight)::BIGINT AS weight FROM m WHERE a <> b GROUP BY 1, 2""")
def renamed_edges(spark, d):
    """Every fifth supplier goes under the name of the next one."""
    s = table(spark, d, "supplier").where("s_suppkey % 5 = 0").select(F.col("s_suppkey").alias("old"), (F.col("s_suppkey") + 1).alias("new"))
    bridge = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("node"), F.col("l_suppkey").alias("entity"))
    return retrieval.rename_vertices(co_suppliers(spark, d), bridge, s, bridge.count())[0]


_LINKED_PPR = _PPR.replace("1.0 + s_suppkey % 3 AS mass", "((s_suppkey % 3) / 2.0 - 0.2 + 1) / 2 AS mass")


@query(_LINKED_PPR + """ SELECT p_partkey AS node, round(coalesce(score, 0), 5) AS score FROM part LEFT JOIN (SELECT l_partkey, sum(rank) AS score FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) JOIN r ON l_suppkey = r.node WHERE k = 10 GROUP BY 1) ON l_partkey = p_partkey""")
def graph_rerank(spark, d):
    """Parts by the PageRank of their suppliers, restarts at the suppliers of one nation by a similarity."""
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("node"), "s_nationkey")
    sims = s.where("s_nationkey = 3").select("node", ((F.col("node") % 3) / 2.0 - 0.2).alias("similarity"))
    bridge = table(spark, d, "lineitem").select(F.col("l_partkey").alias("node"), F.col("l_suppkey").alias("entity"))
    bridge = dealt(bridge, bridge.count(), "node").distinct()
    nodes = table(spark, d, "part").select(F.col("p_partkey").alias("node"))
    return retrieval.graph_rerank(s.select("node"), co_suppliers(spark, d), sims, bridge, nodes, rounds=10, fixed=True).withColumn("score", F.round("score", 5))


@query(f"""WITH {_BM25}, c AS (SELECT item_id, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 10),
    qt AS (SELECT DISTINCT item_id, term FROM q), dt AS (SELECT DISTINCT doc_id, term FROM t WHERE doc_id IN (SELECT doc_id FROM c)),
    m AS (SELECT c.item_id, c.doc_id, count(dt.term) AS hit, count(*) AS n FROM c JOIN qt ON qt.item_id = c.item_id LEFT JOIN dt ON dt.doc_id = c.doc_id AND dt.term = qt.term GROUP BY ALL)
    SELECT item_id, doc_id, round(hit / n, 6) AS score FROM m""")
def text_rerank(spark, d):
    docs, items = table(spark, d, "documents"), table(spark, d, "benchmark")
    hits = bm25.search(docs, items, 10).where("score > 0")
    docs = docs.join(hits.select("doc_id").distinct(), "doc_id", "left_semi")
    return retrieval.text_rerank(hits, items, docs, "item_id", "doc_id").withColumn("score", F.round("score", 6))


@query("""WITH h AS (SELECT l_suppkey AS query_id, l_partkey AS doc_uuid, min(l_extendedprice)::DOUBLE AS distance FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY 1, 2)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_uuid)::INT AS place FROM h) WHERE place <= 3""")
def routed_hits(spark, d):
    hits = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("query_id"), F.col("l_partkey").alias("file_name"), F.col("l_extendedprice").cast("double").alias("distance"))
    registry = table(spark, d, "part").where("p_size > 10").select(F.col("p_partkey").alias("doc_uuid"))
    hits = dealt(hits, hits.count(), "file_name")
    return retrieval.route_hits(hits, registry, 3).select("query_id", "doc_uuid", "distance", "place")


@query("""SELECT c_custkey, round(coalesce(cost, 0), 4) AS cost FROM customer LEFT JOIN (SELECT o_custkey, sum(o_totalprice)::DOUBLE AS cost FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def results_with_costs(spark, d):
    costs = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").cast("double").alias("cost"))
    return retrieval.with_costs(table(spark, d, "customer").select("c_custkey"), costs, ["c_custkey"]).withColumn("cost", F.round("cost", 4))


@query("""SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders) AS linked FROM customer""")
def linked_sections(spark, d):
    a, b = retrieval.split_linked(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")
    return a.withColumn("linked", F.lit(True)).unionByName(b.withColumn("linked", F.lit(False)))
