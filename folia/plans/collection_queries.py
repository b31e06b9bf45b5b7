"""Flat collections, evidence, graph stores and repaired extractions over parts, suppliers and the lines of orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from folia.operators import collections, datasets, extracted
from folia.plans.graph_queries import co_suppliers
from folia.plans.registry import query
from folia.plans.runtime import dealt
from folia.plans.table_queries import _GRID, grids
from folia.plans.tree_queries import _sql, hierarchy
from folia.session import scratch, table
from folia.sources import graphs

_NODES = """n AS (SELECT p_partkey AS node_id, p_brand AS doc, ['NodeType.ROOT', 'image', 'NodeType.TABLE', 'title', 'text', 'equation', 'other'][1 + (p_partkey % 7)::INT] AS type, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_name END AS content,
    CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_type END AS caption, p_brand AS footnote, CASE WHEN p_size > 20 THEN '<t>' || p_size || '</t>' END AS table_body, CASE WHEN p_size % 2 = 0 THEN 'img/' || p_partkey || '.png' END AS img_path,
    CASE WHEN p_size % 4 = 0 THEN ' ' WHEN p_size % 4 = 1 THEN NULL ELSE ' ' || p_type || ' ' END AS summary, 'a.b/' || p_brand || '.v1.pdf' AS file_path FROM part)"""


def nodes(spark, d):
    p, k, size = table(spark, d, "part"), F.col("p_partkey"), F.col("p_size")
    kinds = F.array(*map(F.lit, ("NodeType.ROOT", "image", "NodeType.TABLE", "title", "text", "equation", "other")))
    return p.select(
        k.alias("node_id"), F.col("p_brand").alias("doc"), F.element_at(kinds, (k % 7 + 1).cast("int")).alias("type"), F.when(k % 5 == 0, "").otherwise(F.col("p_name")).alias("content"),
        F.when(k % 3 != 0, F.col("p_type")).alias("caption"), F.col("p_brand").alias("footnote"), F.when(size > 20, F.concat(F.lit("<t>"), size.cast("string"), F.lit("</t>"))).alias("table_body"),
        F.when(size % 2 == 0, F.concat(F.lit("img/"), k.cast("string"), F.lit(".png"))).alias("img_path"), F.when(size % 4 == 0, " ").when(size % 4 > 1, F.concat(F.lit(" "), "p_type", F.lit(" "))).alias("summary"),
        F.concat(F.lit("a.b/"), "p_brand", F.lit(".v1.pdf")).alias("file_path"), F.lit(None).cast("string").alias("file_name"), size.alias("page_idx"))


@query(f"""WITH {_NODES} SELECT node_id, CASE WHEN type = 'image' THEN coalesce(caption, '') || footnote WHEN type = 'NodeType.TABLE' THEN content || coalesce(table_body, '') ELSE content END AS text
    FROM n WHERE type IN ('image', 'NodeType.TABLE') OR (type IN ('title', 'text', 'equation') AND content <> '')""")
def flat_collection(spark, d):
    return collections.flat_texts(nodes(spark, d)).select("node_id", "text")


@query(f"""WITH {_NODES}, m AS (SELECT node_id, doc, CASE WHEN content <> '' AND img THEN 'fused' WHEN content <> '' THEN 'text' WHEN img THEN 'image' END AS modality FROM (SELECT *, type IN ('image', 'NodeType.TABLE') AND img_path IS NOT NULL AS img FROM n WHERE type <> 'NodeType.ROOT'))
    SELECT node_id, modality, CASE WHEN modality IS NOT NULL THEN row_number() OVER (PARTITION BY doc, modality IS NULL ORDER BY CASE modality WHEN 'text' THEN 0 WHEN 'image' THEN 1 ELSE 2 END, node_id) - 1 END AS embedding_idx FROM m""")
def modality_numbers(spark, d):
    return collections.by_modality(nodes(spark, d), ["doc"], "node_id").select("node_id", "modality", "embedding_idx")


@query(f"""WITH {_NODES} SELECT doc, node_id, content AS title, trim(summary, ' ') AS summary, CASE WHEN doc IN (SELECT doc FROM n WHERE type = 'NodeType.ROOT') THEN doc || '.v1' ELSE '' END AS file_name FROM n WHERE type = 'title' AND trim(coalesce(summary, ''), ' ') <> ''""")
def title_collection(spark, d):
    return collections.title_summaries(nodes(spark, d), ["doc"])


@query(f"""WITH {_NODES}, a AS (SELECT c_custkey, unnest([c_custkey, c_custkey // 2, 1000000000, c_custkey + 1]) AS id, unnest([0, 1, 2, 3]) AS place FROM customer)
    SELECT c_custkey, place::INT AS place, node_id AS index_id, CASE type WHEN 'NodeType.TABLE' THEN 'table' WHEN 'NodeType.ROOT' THEN 'root' ELSE type END AS type, content, p_size AS page, CASE WHEN type IN ('image', 'NodeType.TABLE') THEN img_path END AS img_path,
        CASE WHEN type = 'NodeType.TABLE' THEN table_body END AS table_body, CASE WHEN type = 'NodeType.TABLE' THEN caption END AS caption, CASE WHEN type = 'NodeType.TABLE' THEN footnote END AS footnote FROM a JOIN n ON id = node_id JOIN part ON p_partkey = node_id""")
def evidence_rows(spark, d):
    k = F.col("c_custkey")
    asked = table(spark, d, "customer").select("c_custkey", F.array(k, F.floor(k / 2), F.lit(1000000000).cast("long"), k + 1).alias("ids"))
    return collections.evidence(asked, nodes(spark, d).withColumnRenamed("node_id", "index_id"), "c_custkey", "ids")


@query("""WITH w AS (SELECT s_suppkey % 40 AS id, s_name || repeat('x', (s_suppkey % 7)::INT) AS document FROM supplier), h AS (SELECT DISTINCT l_suppkey % 60 AS id FROM lineitem WHERE l_suppkey % 60 >= 20),
    o AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY id ORDER BY length(document) DESC, document) = 1)
    SELECT 'insert' AS what, id, document FROM o WHERE id NOT IN (SELECT id FROM h) UNION ALL SELECT 'delete', id, NULL FROM h WHERE id NOT IN (SELECT id FROM w)""")
def collection_update(spark, d):
    wanted = table(spark, d, "supplier").select((F.col("s_suppkey") % 40).alias("id"), F.concat("s_name", F.expr("repeat('x', cast(s_suppkey % 7 as int))")).alias("document"))
    present = table(spark, d, "lineitem").select((F.col("l_suppkey") % 60).alias("id")).where("id >= 20")
    put, gone = collections.update_plan(wanted, present, "id")
    return put.select(F.lit("insert").alias("what"), "id", "document").unionByName(gone.select(F.lit("delete").alias("what"), "id", F.lit(None).cast("string").alias("document")))


@query("""WITH p AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem), e AS (SELECT x.l_suppkey AS a, y.l_suppkey AS b, count(*) AS weight FROM p x JOIN p y ON x.l_orderkey = y.l_orderkey AND x.l_suppkey < y.l_suppkey GROUP BY ALL)
    SELECT a, b, weight, s_name AS name FROM e JOIN supplier ON s_suppkey = a""")
def graph_store(spark, d):
    """The graph of suppliers that share orders, saved as three tables and read back."""
    path = f"{scratch(spark)}/graph-{spark.sparkContext.applicationId}"
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    bridge = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("node"), F.col("l_suppkey").alias("entity"))
    graphs.save_graph(s, co_suppliers(spark, d), dealt(bridge, bridge.count(), "node").distinct(), path)
    v, e, _ = graphs.load_graph(spark, path)
    return e.join(v.withColumnRenamed("id", "a"), "a").select("a", "b", "weight", "name")


_REC = """t AS (SELECT l_orderkey AS k, l_linenumber * 100000000 + l_partkey * 1000 + l_suppkey % 1000 AS pos, p_name || ' ' || (l_partkey % 100) AS name, upper(replace(p_type || ' kind', ' ', '_')) AS type, l_returnflag AS d, p_name || ' ' || (l_partkey % 100) || CASE WHEN l_linenumber % 2 = 0 THEN 's' ELSE '' END AS src,
        'order ' || l_orderkey AS dst, l_quantity AS w FROM lineitem JOIN part ON p_partkey = l_partkey),
    e AS (SELECT k, name, type, string_agg(d, ' ' ORDER BY pos, d) AS description FROM t GROUP BY ALL), nm AS (SELECT DISTINCT k, name FROM e), q AS (SELECT DISTINCT k, src AS name FROM t UNION SELECT DISTINCT k, dst FROM t),
    s AS (SELECT q.k, q.name, nm.name AS known, 1 - levenshtein(q.name, nm.name) / greatest(length(q.name), length(nm.name)) AS sim FROM q JOIN nm ON q.k = nm.k),
    m AS (SELECT k, name, CASE WHEN sim >= 0.9 THEN known END AS match FROM s QUALIFY row_number() OVER (PARTITION BY k, name ORDER BY sim DESC, known) = 1),
    r AS (SELECT t.k, coalesce(a.match, src) AS src, coalesce(b.match, dst) AS dst, (list(w ORDER BY pos, w))[1] AS weight FROM t JOIN m a ON a.k = t.k AND a.name = src JOIN m b ON b.k = t.k AND b.name = dst GROUP BY 1, 2, 3)"""


def _records(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_type")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_quantity")
    n = li.count()
    t = dealt(li, n, "l_partkey").join(p, F.col("p_partkey") == F.col("l_partkey"))
    pos = F.col("l_linenumber") * 100000000 + F.col("l_partkey") * 1000 + F.col("l_suppkey") % 1000
    line = F.struct(pos.alias("pos"), "p_name", "p_type", (F.col("l_partkey") % 100).cast("int").alias("part"), (F.col("l_linenumber") % 2 == 0).alias("even"), "l_returnflag", "l_quantity")
    # an order is an extraction: its lines come together once
    t = dealt(t.select(F.col("l_orderkey").alias("k"), line.alias("x")), n, "k").groupBy("k").agg(F.collect_list("x").alias("x"))
    name = lambda x: F.concat(x["p_name"], F.lit(" "), x["part"].cast("string"))
    e = F.transform("x", lambda x: F.struct(x["pos"].alias("pos"), F.concat(F.lit("  "), F.upper(F.replace(name(x), F.lit(" "), F.lit("  ")))).alias("name"), F.concat(x["p_type"], F.lit(" kind")).alias("type"), x["l_returnflag"].alias("description")))
    r = F.transform("x", lambda x: F.struct(x["pos"].alias("pos"), F.concat(name(x), F.when(x["even"], "s").otherwise("")).alias("src"), F.concat(F.lit("Order "), F.col("k").cast("string")).alias("dst"),
                    F.lit("in").alias("relation"), x["l_quantity"].alias("weight"), F.lit("").alias("description")))
    return extracted.repair_grouped(t.select("k", e.alias("entities"), r.alias("relations")), "k")


@query(f"WITH {_REC} SELECT k, name, type, description FROM e UNION ALL SELECT k, name, 'UNKNOWN', '' FROM m WHERE match IS NULL")
def repaired_entities(spark, d):
    return _records(spark, d)[0]


@query(f"WITH {_REC} SELECT k, src, dst, weight FROM r")
def repaired_relations(spark, d):
    return _records(spark, d)[1].select("k", "src", "dst", "weight")


@query(_sql(False) + """ SELECT node_id, title, array_to_string(titles, '/') AS titles, previous, next FROM (SELECT node_id, title, lag(title) OVER w AS previous, lead(title) OVER w AS next, list_transform(path[1:len(path) - 1], lambda x: x) AS ids FROM t WHERE parent_id IS NOT NULL WINDOW w AS (PARTITION BY parent_id ORDER BY node_id)
    UNION ALL SELECT node_id, title, NULL, NULL, [] FROM t WHERE parent_id IS NULL) x JOIN LATERAL (SELECT coalesce(list(u.title ORDER BY u.depth), []) AS titles FROM t u WHERE u.node_id IN (SELECT unnest(x.ids))) ON true WHERE node_id NOT LIKE 'o%'""")
def title_contexts(spark, d):
    """Titles on the path of each region, nation and customer, and those of its neighbours."""
    from folia.operators import tree

    t = tree.with_paths(hierarchy(spark, d, False), [])
    return extracted.title_contexts(t, []).where("node_id not like 'o%'").select("node_id", "title", F.array_join("titles", "/").alias("titles"), "previous", "next")


_LETTER = "regexp_matches(v, '\\p{L}')"


@query(f"""WITH {_GRID}, c AS (SELECT k, i - min(i) OVER (PARTITION BY k) AS i, unnest([1, 2, 3, 4]) AS j, unnest([c1, c2, c3, CASE WHEN wide = 1 THEN 'x' END]) AS v FROM g),
    f AS (SELECT * FROM c WHERE v <> ''), h AS (SELECT k, 2 * count(*) FILTER (WHERE NOT {_LETTER}) >= count(*) AS heavy FROM f GROUP BY 1),
    a AS (SELECT k, list_sort(list(DISTINCT v) FILTER (WHERE i < 2)) AS across, list_sort(list(DISTINCT v) FILTER (WHERE j <= 2)) AS down, list_sort(list(DISTINCT v)) AS every FROM f WHERE {_LETTER} GROUP BY 1),
    l AS (SELECT *, list_sort(list_filter(every, lambda x: NOT list_contains(coalesce(across, []), x) AND NOT list_contains(coalesce(down, []), x))) AS other FROM a),
    s AS (SELECT x.k, x.i, 'Row ' || x.i || ': ' || coalesce(string_agg('''' || y.v || ''' is ''' || x.v || ''';', ' ' ORDER BY x.j) FILTER (WHERE x.v <> '' AND y.v <> ''), '') AS r FROM c x JOIN c y ON y.k = x.k AND y.j = x.j AND y.i = 0 WHERE x.i > 0 GROUP BY 1, 2),
    w AS (SELECT k, string_agg(rtrim(r, ' '), chr(10) ORDER BY i) AS rows FROM s GROUP BY 1)
    SELECT k, heavy, md5(concat_ws(chr(10), nullif('Table Caption: ' || caption, 'Table Caption: '), CASE WHEN heavy THEN 'Type: Data-heavy table (schema summary)' ELSE 'Type: Text-heavy table (full linearization)' END,
        CASE WHEN heavy AND len(across) > 0 THEN 'Column Labels: ' || array_to_string(across, ', ') END, CASE WHEN heavy AND len(down) > 0 THEN 'Row Labels: ' || array_to_string(down, ', ') END, CASE WHEN heavy AND len(other) > 0 THEN 'Other Labels: ' || array_to_string(other, ', ') END,
        CASE WHEN NOT heavy THEN rows END, nullif('Footnote: ' || footnote, 'Footnote: '))) AS text FROM o JOIN h USING (k) LEFT JOIN l USING (k) LEFT JOIN w USING (k)""")
def table_schemas(spark, d):
    """Tables as schema summaries where half of the cells and more hold no letter, else as sentences."""
    t = grids(spark, d)
    text = extracted.schema_summary(F.col("grid"), F.col("caption"), F.col("footnote"))
    return t.select("k", F.contains(text, F.lit("Type: Data-heavy")).alias("heavy"), F.md5(text).alias("text"))


@query(f"""WITH {_NODES}, i AS (SELECT l_orderkey AS g, list_sort(list(DISTINCT l_partkey))[1:4] AS ids FROM lineitem WHERE l_partkey IN (SELECT node_id FROM n) GROUP BY 1 HAVING count(DISTINCT l_partkey) >= 2),
    e AS (SELECT g, unnest(ids) AS id, generate_subscripts(ids, 1) AS at_ FROM i),
    x AS (SELECT g, at_, id, p_size + 1 AS page, CASE WHEN contains(lower(type), 'table') THEN 'table' WHEN contains(lower(type), 'image') THEN 'image' WHEN contains(lower(type), 'title') THEN 'title' ELSE 'text' END AS kind,
        CASE type WHEN 'NodeType.TABLE' THEN left(CASE WHEN coalesce(caption, '') <> '' THEN caption ELSE coalesce(table_body, '') END, 500) WHEN 'image' THEN left(coalesce(caption, '') || ' | ' || coalesce(summary, ''), 300) ELSE left(content, 500) END AS content FROM e JOIN n ON node_id = id JOIN part ON p_partkey = id)
    SELECT g AS group_id, o_orderstatus AS answer, count(*)::INT AS n_chunks, string_agg(id || '|' || kind || '|' || page || '|' || content, chr(10) ORDER BY at_) AS evidence FROM x JOIN orders ON o_orderkey = g GROUP BY 1, 2""")
def question_samples(spark, d):
    """Parts of an order as a group of chunks, with the order's status as the answer of its question."""
    n = nodes(spark, d).withColumnRenamed("node_id", "index_id")
    groups = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("group_id")).agg(F.sort_array(F.collect_set("l_partkey")).alias("ids"))
    qa = table(spark, d, "orders").select(F.col("o_orderkey").alias("group_id"), F.lit(" which status? ").alias("question"), F.concat(F.lit(" "), "o_orderstatus").alias("answer"))
    s = datasets.assemble_samples(datasets.valid_groups(groups, n), n, qa)
    line = F.transform("evidences", lambda e: F.concat_ws("|", e["chunk_id"].cast("string"), e["chunk_type"], e["page"].cast("string"), e["content"]))
    return s.select("group_id", "answer", F.size("chunk_ids").alias("n_chunks"), F.array_join(line, "\n").alias("evidence"))
