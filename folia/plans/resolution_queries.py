"""Entity resolution, traversal, filters and clusters."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from folia.operators import clustering, resolution, sampling, tree
from folia.plans.registry import query
from folia.plans.tree_queries import _sql, hierarchy
from folia.session import table

_ENT = """e AS (SELECT p_partkey AS id, p_type AS t, p_brand AS b, p_name || ' model ' || (p_partkey % 11) AS name FROM part),
    n AS (SELECT t, b, name, min(id) AS first FROM e GROUP BY ALL),
    l AS (SELECT id, earlier FROM (SELECT x.first AS id, y.first AS earlier, row_number() OVER (PARTITION BY x.first ORDER BY 1 - levenshtein(x.name, y.name) / greatest(length(x.name), length(y.name)) DESC, y.first) AS r
        FROM n x JOIN n y ON x.t = y.t AND x.b = y.b AND y.first < x.first AND 1 - levenshtein(x.name, y.name) / greatest(length(x.name), length(y.name)) >= 0.9) WHERE r = 1),
    w AS (SELECT id, earlier AS up FROM l UNION ALL SELECT w.id, l.earlier FROM w JOIN l ON l.id = w.up),
    r AS (SELECT id, min(up) AS root FROM w GROUP BY 1)"""


def _entities(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("t"), F.col("p_brand").alias("b"), F.concat("p_name", F.lit(" model "), (F.col("p_partkey") % 11).cast("string")).alias("name"))


@query(f"WITH RECURSIVE {_ENT} SELECT e.id, coalesce(root, first) AS canonical FROM e JOIN n USING (t, b, name) LEFT JOIN r ON r.id = n.first")
def entity_resolution(spark, d):
    return resolution.resolve(_entities(spark, d), ["t", "b"])


@query(f"""WITH RECURSIVE {_ENT}, c AS (SELECT e.id, coalesce(root, first) AS canonical FROM e JOIN n USING (t, b, name) LEFT JOIN r ON r.id = n.first),
    x AS (SELECT l_partkey AS src, (l_partkey + l_suppkey) % (SELECT count(*) FROM part) AS dst, l_returnflag AS relation, l_quantity AS weight FROM lineitem)
    SELECT a.canonical AS a, z.canonical AS b, relation, max(weight) AS weight FROM x JOIN c a ON a.id = src JOIN c z ON z.id = dst WHERE a.canonical <> z.canonical GROUP BY ALL""")
def relation_rewrite(spark, d):
    parts = table(spark, d, "part")
    n = parts.agg(F.count("*").alias("n"))
    x = table(spark, d, "lineitem").join(F.broadcast(n)).select(  # one row is broadcast
        F.col("l_partkey").alias("src"), ((F.col("l_partkey") + F.col("l_suppkey")) % F.col("n")).alias("dst"), F.col("l_returnflag").alias("relation"), F.col("l_quantity").alias("weight"))
    from folia.plans.runtime import materialize

    return resolution.rewrite_relations(x, materialize(resolution.resolve(_entities(spark, d), ["t", "b"])))


_GATES = """WITH h AS (SELECT q.vec_id AS query_id, v.vec_id AS id, 1 - list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS distance, (v.vec_id % 10) / 10.0 AS score
        FROM embeddings q JOIN embeddings v ON q.label = v.label AND q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
    k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS r FROM h),
    g AS (SELECT *, min(distance) OVER (PARTITION BY query_id) AS d, max(score) OVER (PARTITION BY query_id) AS s FROM k WHERE r <= 10),
    o AS (SELECT *, coalesce(score >= 0.6 * lag(score) OVER (PARTITION BY query_id ORDER BY score DESC, id), true) AS ok FROM g WHERE d <= 0.7 AND s >= 0.5),
    r AS (SELECT query_id, id, score FROM (SELECT *, bool_and(ok) OVER (PARTITION BY query_id ORDER BY score DESC, id) AS keep FROM o) WHERE keep)"""


@query(f"{_GATES} SELECT * FROM r")
def candidate_gates(spark, d):
    from folia.operators.vector import cosine

    e = table(spark, d, "embeddings")
    q = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "label", F.col("embedding").alias("q"))
    s = e.select(F.col("vec_id").alias("id"), "label", "embedding").join(q, "label").where("id <> query_id")
    s = s.select("query_id", "id", (1 - cosine(F.col("q"), F.col("embedding"))).alias("distance"), ((F.col("id") % 10) / 10.0).alias("score"))
    return resolution.select_candidates(s, "query_id", far=0.7).select("query_id", "id", "score")


@query(f"{_GATES} SELECT query_id, id, score FROM r QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) = 1 AND score >= 0.9")
def match_decisions(spark, d):
    """The best candidate of each vector where its score is good enough."""
    return resolution.decide(candidate_gates(spark, d), "query_id", 0.9)


@query(_sql(False) + """, s AS (SELECT a AS node_id, round(sum(value), 2) AS total FROM (SELECT unnest(path) AS a, value FROM t) GROUP BY 1),
    b AS (SELECT parent_id, node_id FROM (SELECT t.parent_id, t.node_id, row_number() OVER (PARTITION BY t.parent_id ORDER BY total DESC, t.node_id) AS r FROM t JOIN s USING (node_id) WHERE t.parent_id IS NOT NULL) WHERE r = 1),
    w AS (SELECT node_id AS start, node_id AS here, 0 AS step FROM t WHERE depth = 1 UNION ALL SELECT start, b.node_id, step + 1 FROM w JOIN b ON b.parent_id = w.here)
    SELECT start, step::INT AS step, here FROM w""")
def tree_traverse(spark, d):
    """From each region down to a leaf, always to the child of largest total: the best child of every node is found once, the walk is a join for each level."""
    from folia.plans.runtime import materialize

    t = materialize(tree.with_paths(hierarchy(spark, d, False), []))
    total = tree.roll_up(t, [], "value").select("node_id", F.round("total", 2).alias("total"))
    best = t.where("parent_id is not null").join(total, "node_id").groupBy("parent_id").agg(F.min_by("node_id", F.struct((-F.col("total")).alias("v"), F.col("node_id").alias("i"))).alias("child"))
    best = materialize(best)
    at = t.where("depth = 1").select(F.col("node_id").alias("start"), F.lit(0).alias("step"), F.col("node_id").alias("here"))
    out, step = at, 0
    while True:
        step += 1
        at = materialize(at.join(best, at["here"] == best["parent_id"]).select("start", F.lit(step).alias("step"), F.col("child").alias("here")))
        if not at.take(1):
            return out
        out = out.unionByName(at)


@query(_sql(False) + """ SELECT node_id FROM t WHERE kind IN ('customer', 'order') AND (CASE WHEN kind = 'order' THEN true ELSE value = 0 END)
    AND lower(array_to_string(list_transform(path, lambda x: CASE WHEN x LIKE 'n%' THEN x ELSE '' END), '')) LIKE '%5%' AND TRY_CAST(substr(node_id, 2) AS BIGINT) BETWEEN 10 AND (SELECT max(c_custkey) FROM customer)""")
def node_filter(spark, d):
    """Nodes by type, by a range of numbers, and by a part of their section's name."""
    t = tree.with_paths(hierarchy(spark, d, False), [])
    top = table(spark, d, "customer").agg(F.max("c_custkey").alias("m")).first()["m"]
    section = F.lower(F.array_join(F.filter("path", lambda x: x.startswith("n")), ""))
    return t.where(F.col("kind").isin("customer", "order") & section.contains("5") & F.substring("node_id", 2, 8).try_cast("long").between(10, top)).select("node_id")


@query(_sql(False) + """, r AS (SELECT parent_id, node_id, row_number() OVER (PARTITION BY parent_id ORDER BY md5('9|' || node_id), node_id) - 1 AS k FROM t WHERE kind = 'order'),
    g AS (SELECT parent_id, k // 3 AS g, string_agg(node_id, ',' ORDER BY node_id) AS nodes, count(*) AS n FROM r GROUP BY ALL)
    SELECT parent_id, g::BIGINT AS g, nodes FROM g WHERE n >= 2""")
def sibling_groups(spark, d):
    """Groups of two or three siblings in pseudo-random order."""
    t = hierarchy(spark, d, False).where("kind = 'order'")
    w = Window.partitionBy("parent_id").orderBy(sampling.draw(9, "node_id"), "node_id")
    g = t.withColumn("g", F.floor((F.row_number().over(w) - 1) / 3).cast("long")).groupBy("parent_id", "g").agg(F.array_join(F.sort_array(F.collect_list("node_id")), ",").alias("nodes"), F.count("*").alias("n"))
    return g.where("n >= 2").select("parent_id", "g", "nodes")


_U = lambda key: f"('0x' || substr(md5({key}), 1, 13))::BIGINT / 4503599627370496.0"
_PAIRED = f"""pc AS (SELECT parent_id, parent_id || ',' || string_agg(node_id, ',' ORDER BY node_id) AS nodes FROM (SELECT parent_id, node_id, row_number() OVER (PARTITION BY parent_id ORDER BY md5('11|' || node_id), node_id) AS r FROM t WHERE kind = 'order')
    WHERE r <= 1 + floor({_U("'11|' || parent_id")} * 3) GROUP BY 1)"""
_CROSSED = f"""cn AS (SELECT node_id, parent_id FROM t WHERE kind = 'customer'), cg AS (SELECT unnest(range(least(20, 2 * (SELECT count(DISTINCT parent_id) FROM cn)))) AS g),
    cx AS (SELECT g, parent_id, node_id FROM (SELECT *, row_number() OVER (PARTITION BY g, parent_id ORDER BY md5('13|' || g || '|' || node_id), node_id) AS r FROM cn, cg) WHERE r = 1),
    cs AS (SELECT g::INT AS g, string_agg(node_id, ',' ORDER BY node_id) AS nodes FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY md5('14|' || g || '|' || parent_id), parent_id) AS r FROM cx) WHERE r <= 2 + floor({_U("'13|' || g")} * 2) GROUP BY 1)"""


def _joined(groups):
    return groups.withColumn("nodes", F.array_join("nodes", ","))


def _paired(spark, d):
    return sampling.parent_child_groups(hierarchy(spark, d, False).where("kind = 'order'"), "parent_id", "node_id", 11)


def _crossed(spark, d):
    return sampling.cross_section_groups(hierarchy(spark, d, False).where("kind = 'customer'"), "parent_id", "node_id", 13)


@query(_sql(False) + f", {_PAIRED} SELECT parent_id, nodes FROM pc")
def parent_child_groups(spark, d):
    """Every customer with one to three of the orders."""
    return _joined(_paired(spark, d))


@query(_sql(False) + f", {_CROSSED} SELECT g, nodes FROM cs")
def cross_section_groups(spark, d):
    """Customers of two or three nations in up to twenty groups."""
    return _joined(_crossed(spark, d))


@query(_sql(False) + f""", {_PAIRED}, {_CROSSED}, sr AS (SELECT parent_id, node_id, row_number() OVER (PARTITION BY parent_id ORDER BY md5('9|' || node_id), node_id) - 1 AS k FROM t WHERE kind = 'order'),
    sg AS (SELECT nodes FROM (SELECT parent_id, k // 3 AS g, string_agg(node_id, ',' ORDER BY node_id) AS nodes, count(*) AS n FROM sr GROUP BY ALL) WHERE n >= 2),
    u AS (SELECT 'sibling' AS method, nodes, 16 AS want FROM sg UNION ALL SELECT 'parent_child', nodes, 16 FROM pc UNION ALL SELECT 'cross_section', nodes, 18 FROM cs)
    SELECT method, nodes FROM (SELECT *, row_number() OVER (PARTITION BY method ORDER BY md5('17|' || method || '|' || nodes), nodes) AS r FROM u) WHERE r <= want""")
def mixed_groups(spark, d):
    """Fifty groups of nodes: siblings, parents with children, and across sections, in thirds."""
    siblings = sibling_groups(spark, d).select(F.split("nodes", ",").alias("nodes"))
    return _joined(sampling.mixed_groups({"sibling": siblings, "parent_child": _paired(spark, d), "cross_section": _crossed(spark, d)}, 50, 17))


@query()
def cluster_tree(spark, d):
    """Soft clusters of the vectors; an iterative fit, so rows alone are compared."""
    return clustering.soft_clusters(table(spark, d, "embeddings"), "vec_id", "embedding").select("vec_id", "cluster", F.round("p", 3).alias("p"))
