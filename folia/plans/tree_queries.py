"""Tree operators over the region, nation, customer, order, line hierarchy and over event sequences."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from folia.operators import blocks, tree
from folia.plans.registry import query
from folia.plans.runtime import dealt
from folia.session import table


def hierarchy(spark, d, lines: bool = True):
    """(node_id, parent_id, kind, title, value): regions stand under one root."""
    digits = lambda c: F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(0), 8 - F.length(c))), c)
    # of numbers below zero and nulls the general way writes what it did
    key = lambda p, c: F.concat(F.lit(p), F.when(F.col(c).cast("long") >= 0, digits(F.col(c).cast("long").cast("string"))).otherwise(F.format_string("%08d", F.col(c).cast("long"))))
    row = lambda df, i, up, kind, title, value: df.select(i.alias("node_id"), up.alias("parent_id"), F.lit(kind).alias("kind"), title.alias("title"), value.cast("double").alias("value"))
    r, n, c, o = (table(spark, d, t) for t in ("region", "nation", "customer", "orders"))
    root = spark.range(1).select(F.lit("root").alias("node_id"), F.lit(None).cast("string").alias("parent_id"), F.lit("root").alias("kind"), F.lit("root").alias("title"), F.lit(0.0).alias("value"))
    zero = F.lit(0.0)
    out = root.unionByName(row(r, key("r", "r_regionkey"), F.lit("root"), "region", F.col("r_name"), zero))
    out = out.unionByName(row(n, key("n", "n_nationkey"), key("r", "n_regionkey"), "nation", F.col("n_name"), zero))
    out = out.unionByName(row(c, key("c", "c_custkey"), key("n", "c_nationkey"), "customer", F.col("c_name"), zero))
    out = out.unionByName(row(o, key("o", "o_orderkey"), key("c", "o_custkey"), "order", F.col("o_orderstatus"), F.col("o_totalprice")))
    if lines:
        # a line equals no node of another kind; lines are told apart by their numbers, before they are written out
        li = table(spark, d, "lineitem")
        parts = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey")]
        place = F.when(reduce(and_, [c.isNotNull() for c in parts]), F.struct(*parts)).alias("place")
        li = dealt(li.select("l_orderkey", place, "l_returnflag", F.col("l_quantity").cast("double").alias("l_quantity")), li.count(), "l_orderkey").distinct()
        at = F.concat(key("l", "l_orderkey"), *[x for c in ("l_linenumber", "l_partkey", "l_suppkey") for x in (F.lit("-"), F.col(f"place.{c}").cast("string"))])
        return out.distinct().unionByName(row(li, at, key("o", "l_orderkey"), "line", F.col("l_returnflag"), F.col("l_quantity")))
    return out.distinct()


def _sql(lines: bool = True) -> str:
    k = lambda p, c: f"'{p}' || lpad({c}::BIGINT::VARCHAR, 8, '0')"
    parts = [
        "SELECT 'root' AS node_id, NULL AS parent_id, 'root' AS kind, 'root' AS title, 0.0::DOUBLE AS value",
        f"SELECT {k('r', 'r_regionkey')}, 'root', 'region', r_name, 0 FROM region",
        f"SELECT {k('n', 'n_nationkey')}, {k('r', 'n_regionkey')}, 'nation', n_name, 0 FROM nation",
        f"SELECT {k('c', 'c_custkey')}, {k('n', 'c_nationkey')}, 'customer', c_name, 0 FROM customer",
        f"SELECT {k('o', 'o_orderkey')}, {k('c', 'o_custkey')}, 'order', o_orderstatus, o_totalprice FROM orders",
    ]
    if lines:
        parts.append(f"SELECT {k('l', 'l_orderkey')} || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey, {k('o', 'l_orderkey')}, 'line', l_returnflag, l_quantity FROM lineitem")
    return (
        f"WITH RECURSIVE h AS ({' UNION '.join(parts)}), "
        "t AS (SELECT *, 0 AS depth, [node_id] AS path FROM h WHERE parent_id IS NULL "
        "UNION ALL SELECT h.*, t.depth + 1, list_append(t.path, h.node_id) FROM h JOIN t ON h.parent_id = t.node_id)"
    )


def _tree(spark, d, lines: bool = True):
    return tree.with_paths(hierarchy(spark, d, lines), [])


@query(_sql() + " SELECT depth::INT AS depth, kind, count(*) AS n FROM t GROUP BY ALL")
def tree_depth(spark, d):
    return _tree(spark, d).groupBy("depth", "kind").agg(F.count("*").alias("n"))


@query(_sql(False) + " SELECT node_id, array_to_string(path[2:], ' > ') AS path FROM t")
def tree_path(spark, d):
    return _tree(spark, d, False).select("node_id", F.array_join(F.slice("path", 2, F.greatest(F.lit(0), F.size("path") - 1)), " > ").alias("path"))


@query(_sql(False) + """, roots AS (SELECT node_id FROM t WHERE kind = 'nation' AND title LIKE '%5' OR kind = 'customer' AND title LIKE '%3')
    SELECT DISTINCT node_id, kind FROM t WHERE len(list_intersect(path, (SELECT list(node_id) FROM roots))) > 0""")
def tree_subtree(spark, d):
    t = _tree(spark, d, False)
    roots = t.where("kind = 'nation' and title like '%5' or kind = 'customer' and title like '%3'")
    return tree.subtree(t, roots, []).select("node_id", "kind")


@query(_sql(False) + """ SELECT node_id, count(*) OVER (PARTITION BY parent_id) - 1 AS n_siblings, lag(node_id) OVER (PARTITION BY parent_id ORDER BY node_id) AS previous,
    lead(node_id) OVER (PARTITION BY parent_id ORDER BY node_id) AS next FROM t WHERE parent_id IS NOT NULL""")
def tree_siblings(spark, d):
    return tree.siblings(_tree(spark, d, False), []).select("node_id", "n_siblings", "previous", "next")


@query(_sql(False) + " SELECT node_id, CASE WHEN depth >= 2 THEN path[3] END AS ancestor FROM t")
def tree_ancestor(spark, d):
    return tree.ancestor_at(_tree(spark, d, False), 2).select("node_id", "ancestor")


@query(_sql(False) + " SELECT node_id, title FROM t WHERE depth = 3")
def tree_nodes_at_depth(spark, d):
    return tree.at_depth(_tree(spark, d, False), 3).select("node_id", "title")


@query(_sql(False) + """ SELECT path[2] AS region, md5(string_agg(repeat('  ', depth) || title, chr(10) ORDER BY path)) AS outline FROM t WHERE depth BETWEEN 1 AND 3 GROUP BY 1""")
def tree_outline(spark, d):
    t = _tree(spark, d, False).where("depth between 1 and 3").withColumn("region", F.get("path", F.lit(1)))
    return tree.outline(t, ["region"], "title").select("region", F.md5("outline").alias("outline"))


@query(_sql(False) + """ SELECT parent_id AS node_id, count(*) AS n_children, md5(string_agg(title, chr(10) ORDER BY node_id)) AS children FROM t WHERE parent_id IS NOT NULL AND title <> '' GROUP BY 1""")
def tree_one_depth(spark, d):
    return tree.children_text(_tree(spark, d, False), [], "title").withColumn("children", F.md5("children"))


@query(_sql() + """ SELECT a AS node_id, count(*) AS n_nodes, round(sum(value), 2) AS total FROM (SELECT unnest(path) AS a, value FROM t) GROUP BY 1""")
def tree_bottom_up_rollup(spark, d):
    return tree.rolled_up(hierarchy(spark, d), [], "value").withColumn("total", F.round("total", 2))


@query(_sql(False) + """ SELECT parent_id AS node_id, count(*) FILTER (WHERE title = 'F') AS n_F, count(*) FILTER (WHERE title = 'O') AS n_O, count(*) FILTER (WHERE title = 'P') AS n_P
    FROM t WHERE kind = 'order' GROUP BY 1""")
def child_type_pivot(spark, d):
    return tree.child_counts(_tree(spark, d, False).where("kind = 'order'"), [], "title", ["F", "O", "P"])


_LEVEL = "CASE event_type WHEN 'signup' THEN 0 WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 ELSE 3 END"
_HEADS = f"h AS (SELECT user_id, event_id, ({_LEVEL})::INT AS level FROM events)"


def _heads(spark, d):
    return table(spark, d, "events").select("user_id", "event_id", F.expr(_LEVEL).alias("level"))


@query(f"WITH {_HEADS} SELECT event_id, (SELECT max(p.event_id) FROM h p WHERE p.user_id = h.user_id AND p.event_id < h.event_id AND p.level < h.level) AS parent FROM h")
def title_parent(spark, d):
    return tree.heading_parents(_heads(spark, d), ["user_id"], "event_id", "level", 3).select("event_id", "parent")


@query(f"""WITH {_HEADS} SELECT event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS end_next,
    (SELECT min(p.event_id) FROM h p WHERE p.user_id = h.user_id AND p.event_id > h.event_id AND p.level <= h.level) AS end_level FROM h""")
def section_ends(spark, d):
    return tree.section_ends(_heads(spark, d), ["user_id"], "event_id", "level", 3).select("event_id", "end_next", "end_level")


@query(f"WITH {_HEADS} SELECT event_id, (SELECT max(p.event_id) FROM h p WHERE p.user_id = h.user_id AND p.event_id <= h.event_id AND p.level = 0) AS section FROM h")
def range_join_sections(spark, d):
    h = _heads(spark, d).withColumn("is_title", F.col("level") == 0)
    return tree.sections_of(h, ["user_id"], "event_id", "is_title").select("event_id", "section")


@query("""WITH t AS (SELECT user_id, event_id, value, event_type, max(CASE WHEN event_type = 'error' THEN event_id END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_event_id FROM events)
    SELECT t.event_id, t.prev_event_id, e.value AS prev_value FROM t LEFT JOIN events e ON e.event_id = t.prev_event_id""")
def asof_prev_table(spark, d):
    t = blocks.previous_of(table(spark, d, "events").select("user_id", "event_id", "value", "event_type"), ["user_id"], "event_id", "event_type = 'error'", ["event_id", "value"])
    return t.select("event_id", "prev_event_id", "prev_value")


@query("""SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS pdf_id FROM events WHERE event_type <> 'error'""")
def drop_invalid(spark, d):
    e = table(spark, d, "events").withColumn("invalid", F.col("event_type") == "error")
    return blocks.drop_invalid(e, "user_id", "event_id").select("user_id", "event_id", F.col("pdf_id").cast("long").alias("pdf_id"))


@query("""WITH t AS (SELECT user_id, event_id AS pos, (event_id // 50) AS page, (value::INT % 3) AS n_cols, CASE WHEN event_type = 'signup' THEN 'x' ELSE '' END AS caption FROM events WHERE event_type IN ('view', 'signup')),
    p AS (SELECT *, lag(page) OVER w AS pp, lag(n_cols) OVER w AS pn FROM t WINDOW w AS (PARTITION BY user_id ORDER BY pos))
    SELECT pos, coalesce(pp = page - 1 AND pn = n_cols AND caption = '', false) AS continues FROM p""")
def split_tables(spark, d):
    t = table(spark, d, "events").where("event_type in ('view', 'signup')").select(
        "user_id", F.col("event_id").alias("pos"), F.floor(F.col("event_id") / 50).alias("page"), (F.rint("value").cast("int") % 3).alias("n_cols"), F.when(F.col("event_type") == "signup", "x").otherwise("").alias("caption"))
    return blocks.continued_tables(t, ["user_id"]).select("pos", "continues")
