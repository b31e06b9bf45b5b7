"""Queries over parsed pages, Markdown blocks, and event windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from folia.plans.registry import query
from folia.sources import html_tables, markdown
from folia.session import table


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents),
    t AS (SELECT doc_id, k, trim(line, ' ') AS t, CASE WHEN trim(line, ' ') = '' THEN 'blank' WHEN regexp_matches(trim(line, ' '), '^#{1,6}\\s') THEN 'title' WHEN regexp_matches(trim(line, ' '), '^!\\[[^\\]]*\\]\\([^)]*\\)$') THEN 'image'
        WHEN regexp_matches(trim(line, ' '), '^\\|.*\\|$') THEN 'table' ELSE 'text' END AS type FROM l),
    s AS (SELECT *, (type IS DISTINCT FROM lag(type) OVER (PARTITION BY doc_id ORDER BY k) OR type IN ('title', 'image'))::INT AS s FROM t),
    r AS (SELECT *, sum(s) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM s)
    SELECT doc_id, type, count(*) AS n_lines, count(DISTINCT run) AS n_blocks FROM r WHERE type <> 'blank' GROUP BY ALL""")
def markdown_blocks(spark, d):
    b = markdown.markdown_blocks(table(spark, d, "documents"), "doc_id", "text")
    n = F.size(F.split("text", "\n"))
    return b.groupBy("doc_id", "type").agg(F.sum(n).cast("long").alias("n_lines"), F.count("*").alias("n_blocks"))


@query("""SELECT page_id, len(regexp_extract_all(html, '<li>')) AS n_items, array_to_string(regexp_extract_all(html, 'href="([^"]*)"', 1), ' ') AS links FROM pages""")
def page_links(spark, d):
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)
    return table(spark, d, "pages").select("page_id", F.regexp_count("html", F.lit("<li>")).cast("long").alias("n_items"), F.array_join(links, " ").alias("links"))


@query("""WITH l AS (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages)
    SELECT page_id, unnest(l) AS link, generate_subscripts(l, 1) AS position FROM l""")
def page_links_all(spark, d):
    """Every link of each page, by position from 1."""
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)
    return table(spark, d, "pages").select("page_id", F.posexplode(links).alias("position", "link")).withColumn("position", F.col("position") + 1)


@query()
def html_grid(spark, d):
    """Grid, header rows and text of a table that each page's list items are laid into; tests hold the grid against cases by hand."""
    items = F.regexp_extract_all("html", F.lit(r"<li>(.*?)</li>"), 1)
    rows = F.array_join(F.transform(items, lambda x: F.concat(F.lit("<tr><td>"), x, F.lit("</td><td>"), F.length(x).cast("string"), F.lit("</td></tr>"))), "")
    t = table(spark, d, "pages").select("page_id", F.concat(F.lit("<table><tr><th>link</th><th>size</th></tr>"), rows, F.lit("</table>")).alias("html"))
    g = t.withColumn("grid", html_tables.table_grid("html"))
    return g.select("page_id", F.size("grid").alias("n_rows"), html_tables.header_rows(F.col("grid")).alias("n_header"), html_tables.table_text("grid", F.lit("Links"), F.lit("")).alias("text"))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, [l_returnflag, CASE WHEN l_orderkey % 5 = 0 THEN l_returnflag ELSE l_linestatus END, CASE WHEN l_linenumber <= l_orderkey % 4 THEN 'unit' ELSE l_quantity::BIGINT || '%' END,
        CASE WHEN l_linenumber <= l_orderkey % 3 THEN 'supplier ' || l_linenumber ELSE l_suppkey::VARCHAR END] AS r FROM lineitem),
    o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, r) - 1 AS i, count(*) OVER (PARTITION BY l_orderkey) AS n, lead(r) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, r) AS s FROM l),
    c AS (SELECT l_orderkey, i, n, generate_subscripts(r, 1) AS j, unnest(r) AS a, unnest(s) AS b FROM o WHERE i < least(3, n - 1)),
    m AS (SELECT *, a <> '' AND a = lead(a) OVER (PARTITION BY l_orderkey, i ORDER BY j) AS span, try_cast(replace(a, '%', '') AS DOUBLE) IS NOT NULL AS x, try_cast(replace(b, '%', '') AS DOUBLE) IS NOT NULL AS y FROM c),
    f AS (SELECT l_orderkey, i, coalesce(bool_or(span), false) OR 3 * count(*) FILTER (WHERE NOT x AND y) > 4 OR 2 * count(*) FILTER (WHERE x <> y) > 4
        OR (i = 0 AND NOT bool_or(x OR y) AND 2 * count(*) FILTER (WHERE a <> b) > 4) AS header FROM m GROUP BY l_orderkey, i)
    SELECT l_orderkey, max(n) AS n_rows, CASE WHEN max(n) = 1 THEN 1 ELSE coalesce(min(i) FILTER (WHERE NOT header), least(3, max(n) - 1)) END::INT AS n_header FROM o LEFT JOIN f USING (l_orderkey, i) GROUP BY 1""")
def table_headers(spark, d):
    """Header rows of a grid for each order, a row for each of its lines."""
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    cells = F.array(
        F.col("l_returnflag"),
        F.when(order % 5 == 0, F.col("l_returnflag")).otherwise(F.col("l_linestatus")),
        F.when(line <= order % 4, "unit").otherwise(F.concat(F.col("l_quantity").cast("long").cast("string"), F.lit("%"))),
        F.when(line <= order % 3, F.concat(F.lit("supplier "), line.cast("string"))).otherwise(F.col("l_suppkey").cast("string")),
    )
    g = table(spark, d, "lineitem").select("l_orderkey", F.struct(line.alias("k"), cells.alias("cells")).alias("x")).groupBy("l_orderkey").agg(F.sort_array(F.collect_list("x"))["cells"].alias("grid"))
    return g.select("l_orderkey", F.size("grid").cast("long").alias("n_rows"), html_tables.detected_headers(F.col("grid")).cast("int").alias("n_header"))


@query("""SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS hour_us, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL""")
def hourly_events(spark, d):
    """The batch form of the streaming window; tests run the stream over the same files."""
    e = table(spark, d, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return e.select(F.unix_micros(F.col("w.start").cast("timestamp")).alias("hour_us"), "event_type", "n", "total")
