"""Entity graph queries: supplier co-occurrence in orders, copies of documents, part names."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from folia.operators import graph, ranking
from folia.plans.registry import query
from folia.plans.runtime import dealt
from folia.session import table

_EDGES = """p AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem),
    e AS (SELECT x.l_suppkey AS a, y.l_suppkey AS b, count(*) AS weight FROM p x JOIN p y ON x.l_orderkey = y.l_orderkey AND x.l_suppkey < y.l_suppkey GROUP BY ALL),
    arcs AS (SELECT a AS src, b AS dst, weight FROM e UNION ALL SELECT b, a, weight FROM e)"""


def co_suppliers(spark, d):
    """(a, b, weight): suppliers that share an order; an order has few lines, so pairs stay in proportion to lines."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    n = li.count()
    p = dealt(li, n, "l_orderkey").distinct()
    pairs = p.select("l_orderkey", F.col("l_suppkey").alias("src")).join(p.select("l_orderkey", F.col("l_suppkey").alias("dst")), "l_orderkey").where("src < dst")
    return graph.undirected(pairs.select("src", "dst"), rows=2 * n)


@query(f"WITH {_EDGES} SELECT src AS node, count(*) AS degree, sum(weight)::BIGINT AS strength FROM arcs GROUP BY 1")
def graph_degree(spark, d):
    return graph.degrees(co_suppliers(spark, d))


@query(f"WITH {_EDGES}, n AS (SELECT s_suppkey AS node FROM supplier WHERE s_nationkey < 8) SELECT a, b, weight FROM e WHERE a IN (SELECT node FROM n) AND b IN (SELECT node FROM n)")
def induced_subgraph(spark, d):
    nodes = table(spark, d, "supplier").where("s_nationkey < 8").select(F.col("s_suppkey").alias("node"))
    return graph.induced(co_suppliers(spark, d), nodes)


@query(f"WITH {_EDGES}, n AS (SELECT s_suppkey AS node FROM supplier WHERE s_nationkey = 3) SELECT DISTINCT dst AS node FROM arcs WHERE src IN (SELECT node FROM n) AND dst NOT IN (SELECT node FROM n)")
def one_hop(spark, d):
    return graph.one_hop(co_suppliers(spark, d), table(spark, d, "supplier").where("s_nationkey = 3").select(F.col("s_suppkey").alias("node")))


@query(f"WITH {_EDGES} SELECT p_partkey AS node FROM part WHERE p_partkey NOT IN (SELECT src FROM arcs)")
def isolates(spark, d):
    return graph.isolated(table(spark, d, "part").select(F.col("p_partkey").alias("node")), co_suppliers(spark, d))


_SEEDS = "s AS (SELECT s_suppkey AS node, 1.0 + s_suppkey % 3 AS mass FROM supplier WHERE s_nationkey = 3)"
_PPR = f"""WITH RECURSIVE {_EDGES}, {_SEEDS}, v AS (SELECT s_suppkey AS node FROM supplier), n AS (SELECT count(*) AS n FROM v),
    o AS (SELECT src, sum(weight) AS total FROM arcs GROUP BY 1), tr AS (SELECT src, dst, weight / total AS p FROM arcs JOIN o USING (src)),
    b AS (SELECT node, coalesce(mass / (SELECT sum(mass) FROM s), 0) AS home, node IN (SELECT src FROM o) AS linked FROM v LEFT JOIN s USING (node)),
    r AS (SELECT 0 AS k, node, home, linked, 1.0 / n AS rank FROM b, n
          UNION ALL
          SELECT k + 1, node, home, linked, 0.5 * (coalesce(got, 0) + lost * home) + 0.5 * home FROM (
              SELECT c.k, c.node, c.home, c.linked, g.got, (SELECT coalesce(sum(rank) FILTER (WHERE NOT linked), 0) FROM r) AS lost
              FROM r c LEFT JOIN (SELECT dst, sum(rank * p) AS got FROM r JOIN tr ON tr.src = r.node GROUP BY 1) g ON g.dst = c.node) WHERE k < 10)"""


def _ranks(spark, d):
    seeds = table(spark, d, "supplier").where("s_nationkey = 3").select(F.col("s_suppkey").alias("node"), (1.0 + F.col("s_suppkey") % 3).alias("mass"))
    return graph.pagerank(table(spark, d, "supplier").select(F.col("s_suppkey").alias("node")), co_suppliers(spark, d), seeds, rounds=10, fixed=True)


@query(_PPR + " SELECT node, round(rank, 6) AS rank FROM r WHERE k = 10")
def ppr_fixed_iter(spark, d):
    return _ranks(spark, d).withColumn("rank", F.round("rank", 6))


@query(_PPR + " SELECT l_partkey AS node, round(sum(rank), 5) AS score FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) JOIN r ON l_suppkey = r.node WHERE k = 10 GROUP BY 1")
def ppr_node_mass(spark, d):
    bridge = table(spark, d, "lineitem").select(F.col("l_partkey").alias("node"), F.col("l_suppkey").alias("entity"))
    bridge = dealt(bridge, bridge.count(), "node").distinct()
    return ranking.mass_per_node(_ranks(spark, d), bridge).withColumn("score", F.round("score", 5))


@query("""WITH s AS (SELECT label AS node, sum((list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) + 1) / 2) AS m
    FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q GROUP BY 1) SELECT node, round(m / sum(m) OVER (), 6) AS mass FROM s""")
def seed_mass(spark, d):
    from folia.operators.vector import cosine

    e = table(spark, d, "embeddings")
    q = e.where("vec_id = 0").select(F.col("embedding").alias("q"))
    sims = e.join(F.broadcast(q)).select(F.col("label").alias("node"), cosine(F.col("embedding"), F.col("q")).alias("similarity"))  # one row is broadcast
    return ranking.seed_mass(sims).withColumn("mass", F.round("mass", 6))


@query("""WITH RECURSIVE c AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY source, md5(text)) AS x, min(doc_id) OVER (PARTITION BY lang, length(text)) AS y FROM documents),
    e AS (SELECT doc_id AS a, x AS b FROM c WHERE doc_id <> x UNION SELECT doc_id, y FROM c WHERE doc_id <> y),
    arcs AS (SELECT a AS s, b AS d FROM e UNION SELECT b, a FROM e),
    r AS (SELECT DISTINCT s AS node, s AS root FROM arcs UNION SELECT arcs.s, r.root FROM r JOIN arcs ON arcs.d = r.node)
    SELECT node, min(root) AS root FROM r GROUP BY 1""")
def alias_components(spark, d):
    docs = table(spark, d, "documents")
    x, y = Window.partitionBy("source", F.md5("text")), Window.partitionBy("lang", F.length("text"))
    keyed = docs.select("doc_id", F.min("doc_id").over(x).alias("x"), F.min("doc_id").over(y).alias("y"))
    edges = keyed.select("doc_id", F.explode(F.array("x", "y")).alias("b")).select(F.col("doc_id").alias("a"), "b")
    return graph.smallest_reachable(edges)


@query("""SELECT lower(p_name) AS name, p_type AS type, string_agg(p_brand, '<SEP>' ORDER BY p_partkey, p_brand) AS description, string_agg(p_partkey, ',' ORDER BY p_partkey) AS source_ids FROM part GROUP BY 1, 2""")
def entity_exact_merge(spark, d):
    p = table(spark, d, "part").select(F.lower("p_name").alias("name"), F.col("p_type").alias("type"), "p_partkey", "p_brand")
    t = graph.merge_entities(p, ["name", "type"], "p_partkey", "p_brand", "p_partkey")
    return t.withColumn("source_ids", F.array_join(F.transform("source_ids", lambda x: x.cast("string")), ","))


@query("""SELECT source, arg_min(doc_id, (-length(text), doc_id)) AS doc_id, max(length(text)) AS n FROM documents GROUP BY 1""")
def entity_longest_desc(spark, d):
    docs = table(spark, d, "documents")
    best = docs.groupBy("source").agg(F.min(F.struct((-F.length("text")).alias("l"), "doc_id")).alias("m"))
    return best.select("source", "m.doc_id", (-F.col("m.l")).cast("long").alias("n"))


_NAMES = """a AS (SELECT DISTINCT p_type AS g, p_name || CASE WHEN p_partkey % 2 = 0 THEN 's' ELSE '' END AS name FROM part),
    k AS (SELECT DISTINCT p_type AS g, p_name AS known FROM part)"""


@query(f"""WITH {_NAMES}, s AS (SELECT g, name, known, 1 - levenshtein(name, known) / greatest(length(name), length(known)) AS sim FROM a JOIN k USING (g)),
    r AS (SELECT *, row_number() OVER (PARTITION BY g, name ORDER BY sim DESC, known) AS i FROM s)
    SELECT g, name, CASE WHEN sim >= 0.9 THEN known END AS match, round(sim, 6) AS similarity FROM r WHERE i = 1""")
def nearest_name_join(spark, d):
    p = table(spark, d, "part")
    name = F.concat("p_name", F.when(F.col("p_partkey") % 2 == 0, "s").otherwise(""))
    asked = p.select(F.col("p_type").alias("g"), name.alias("name")).distinct()
    known = p.select(F.col("p_type").alias("g"), F.col("p_name").alias("known")).distinct()
    return graph.nearest_names(asked, known, "g").withColumn("similarity", F.round("similarity", 6))


@query("""WITH v AS (SELECT label AS g, vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    x AS (SELECT g, vec_id AS a, lead(vec_id) OVER (PARTITION BY g ORDER BY vec_id) AS b FROM v), e AS (SELECT * FROM x WHERE b IS NOT NULL),
    p AS (SELECT x.g, x.vec_id AS a, y.vec_id AS b, list_cosine_similarity(x.v, y.v) AS sim, e.a IS NOT NULL AS old
          FROM v x JOIN v y ON x.g = y.g AND x.vec_id < y.vec_id LEFT JOIN e ON e.g = x.g AND e.a = x.vec_id AND e.b = y.vec_id),
    s AS (SELECT g, count(*) AS nv FROM v GROUP BY 1), o AS (SELECT g, count(*) AS ne, quantile_cont(sim, 0.85) AS bar FROM p WHERE old GROUP BY 1),
    t AS (SELECT g, coalesce(bar, 1.0) AS bar, greatest(1, ceil(2 * coalesce(ne, 0) / nv)) AS budget FROM s LEFT JOIN o USING (g)),
    r AS (SELECT p.*, budget, row_number() OVER (PARTITION BY p.g, a ORDER BY sim DESC, b) AS ra, row_number() OVER (PARTITION BY p.g, b ORDER BY sim DESC, a) AS rb FROM p JOIN t USING (g) WHERE NOT old AND sim > bar)
    SELECT g, a, b, round(sim, 6) AS similarity FROM r WHERE ra <= budget OR rb <= budget""")
def semantic_edges(spark, d):
    v = table(spark, d, "embeddings").select(F.col("label").alias("g"), F.col("vec_id").alias("node"), F.col("embedding").alias("v"))
    edges = v.select("g", F.col("node").alias("a"), F.lead("node").over(Window.partitionBy("g").orderBy("node")).alias("b")).where("b is not null")
    return graph.semantic_edges(v, edges, "g").withColumn("similarity", F.round("similarity", 6))
