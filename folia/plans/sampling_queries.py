"""Sampling, allocation, statistics and bookkeeping queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from folia.operators import dedup, sampling
from folia.plans.registry import query
from folia.session import table


@query("""WITH n AS (SELECT doc_id, md5(trim(regexp_replace(lower(text), '\\s+', ' ', 'g'))) AS k FROM documents WHERE trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) <> '') SELECT min(doc_id) AS doc_id FROM n GROUP BY k""")
def content_dedupe(spark, d):
    return sampling.first_by_content(table(spark, d, "documents"), "text", "doc_id").select("doc_id")


@query("""WITH t AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('7|' || doc_id), doc_id) AS rank FROM documents WHERE lang IN ('de', 'en', 'fr')),
    c AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1), q AS (SELECT unnest(['de', 'en', 'fr']) AS lang, unnest([40, 60, 100000]) AS quota),
    w AS (SELECT lang, CASE WHEN lang = 'en' THEN quota + (SELECT sum(greatest(0, quota - coalesce(n, 0))) FROM q LEFT JOIN c USING (lang) WHERE lang <> 'en') ELSE quota END AS quota FROM q)
    SELECT doc_id, lang, rank::INT AS rank FROM t JOIN w USING (lang) WHERE rank <= quota""")
def stratified_sample(spark, d):
    out = sampling.stratified(table(spark, d, "documents"), "lang", "doc_id", {"de": 40, "en": 60, "fr": 100000}, "en", 7)
    return out.select("doc_id", "lang", "rank")


@query("""WITH s AS (SELECT source, count(*) AS scale FROM documents GROUP BY 1), a AS (SELECT source, scale, greatest(3, round_even(scale * 137.0 / (SELECT sum(scale) FROM s), 0))::BIGINT AS n, row_number() OVER (ORDER BY scale DESC, source) AS r FROM s),
    g AS (SELECT 137 - sum(n) AS gap FROM a)
    SELECT source, scale, (n + CASE WHEN r <= abs(gap) AND (gap > 0 OR n > 3) THEN sign(gap) ELSE 0 END)::BIGINT AS n FROM a, g""")
def sample_allocation(spark, d):
    s = table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("scale"))
    return sampling.allocate(s, "source", "scale", 137, 3)


@query("""WITH c AS (SELECT 'lang' AS category, lang AS value FROM documents UNION ALL SELECT 'source', source FROM documents)
    SELECT category, value, n, round(n / sum(n) OVER (PARTITION BY category), 6) AS share FROM (SELECT category, value, count(*) AS n FROM c GROUP BY 1, 2)""")
def label_distribution(spark, d):
    return sampling.distribution(table(spark, d, "documents"), ["lang", "source"]).withColumn("share", F.round("share", 6))


@query("""WITH u AS (SELECT event_id, ('0x' || substr(md5('3|' || event_id), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM events)
    SELECT event_id, CASE WHEN u < 0.5 THEN 'easy' WHEN u < 0.8 THEN 'medium' ELSE 'hard' END AS difficulty FROM u""")
def weighted_labels(spark, d):
    u = sampling.uniform(3, "event_id")
    return table(spark, d, "events").select("event_id", sampling.weighted_label(u, {"easy": 5, "medium": 3, "hard": 2}).alias("difficulty"))


@query("""WITH k AS (SELECT doc_id, -ln(('0x' || substr(md5('5|' || doc_id), 1, 13))::BIGINT / 4503599627370496.0 + 1e-300) / n_chars AS k FROM documents WHERE n_chars > 0) SELECT doc_id FROM k ORDER BY k, doc_id LIMIT 50""")
def weighted_sample(spark, d):
    return sampling.weighted_sample(table(spark, d, "documents"), "doc_id", "n_chars", 50, 5).select("doc_id")


@query("""WITH k AS (SELECT DISTINCT source FROM documents), r AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS k, greatest(1, ceil(count(*) OVER () / 3))::BIGINT AS size FROM k)
    SELECT doc_id, (k // size + 1)::INT AS slice FROM documents JOIN r USING (source)""")
def split_slice(spark, d):
    return sampling.split_slices(table(spark, d, "documents"), "source", 3).select("doc_id", "slice")


@query("""WITH c AS (SELECT item_id, list_distinct(regexp_extract_all(lower(text), '(?s).')) AS s, md5(text) AS h FROM benchmark)
    SELECT a.item_id AS a, b.item_id AS b, round(len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))), 6) AS jaccard FROM c a JOIN c b ON a.item_id + 1 = b.item_id""")
def jaccard_chars(spark, d):
    b = table(spark, d, "benchmark").select("item_id", "text")
    nxt = b.select((F.col("item_id") - 1).alias("item_id"), F.col("item_id").alias("b"), F.col("text").alias("other"))
    return b.join(nxt, "item_id").select(F.col("item_id").alias("a"), "b", F.round(sampling.char_jaccard(F.col("text"), F.col("other")), 6).alias("jaccard"))


@query()
def greedy_distinct_turns(spark, d):
    """Turns of a conversation kept when unlike all kept before; sequential, so tests hold it against a plain loop."""
    c = table(spark, d, "conversations").select("conv_id", "turn", "text")
    return sampling.greedy_distinct(c, "conv_id", "turn", "text", 0.9).select("conv_id", "turn")


@query("""WITH s AS (SELECT user_id, event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id), 4) AS total FROM events)
    SELECT event_id, round(total - lag(total, 1, 0) OVER (PARTITION BY user_id ORDER BY event_id), 2) AS delta FROM s""")
def stage_delta(spark, d):
    """Use of each stage as the difference of running totals."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    s = table(spark, d, "events").withColumn("total", F.round(F.sum("value").over(w), 4))
    return s.select("event_id", F.round(F.col("total") - F.lag("total", 1, 0.0).over(w), 2).alias("delta"))


@query("""SELECT o_orderstatus AS method, count(*) AS n, round(sum(o_totalprice), 2) AS cost, count(DISTINCT o_custkey) AS n_docs FROM orders GROUP BY 1""")
def cost_rollup(spark, d):
    return table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("method")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("cost"), F.count_distinct("o_custkey").alias("n_docs"))


@query("""WITH a AS (SELECT o_custkey AS k, min(o_totalprice) AS t, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey AS k, min(o_totalprice) AS t, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
    SELECT coalesce(a.k, b.k) AS k, coalesce(a.t, b.t) AS t, CASE WHEN b.n > 0 AND b.n IS DISTINCT FROM a.n THEN b.n ELSE a.n END AS n FROM a FULL JOIN b ON a.k = b.k""")
def stats_merge(spark, d):
    """Merge on write: the first timing stays, counts give way to new ones that are not zero; one aggregate instead of a join of two scans."""
    o = table(spark, d, "orders")
    old, new = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O"
    t = o.where(old | new).groupBy(F.col("o_custkey").alias("k")).agg(
        F.min(F.when(old, F.col("o_totalprice"))).alias("ta"), F.min(F.when(new, F.col("o_totalprice"))).alias("tb"), F.count(F.when(old, 1)).alias("na"), F.count(F.when(new, 1)).alias("nb"))
    return t.select("k", F.coalesce("ta", "tb").alias("t"), F.when(F.col("nb") > 0, F.col("nb")).otherwise(F.col("na")).alias("n"))


@query("""SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations) WHERE r <= 3""")
def recent_messages(spark, d):
    w = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    return table(spark, d, "conversations").withColumn("r", F.row_number().over(w)).where("r <= 3").select("conv_id", "turn", "role")


@query("""WITH f AS (SELECT DISTINCT conv_id, md5(text) AS h FROM conversations WHERE turn = 0) SELECT c.conv_id, c.turn FROM conversations c ANTI JOIN f ON c.conv_id = f.conv_id AND md5(c.text) = f.h""")
def unseen_messages(spark, d):
    c = table(spark, d, "conversations").withColumn("h", F.md5("text"))
    return c.join(c.where("turn = 0").select("conv_id", "h").distinct(), ["conv_id", "h"], "left_anti").select("conv_id", "turn")


@query("""SELECT doc_id, lower(concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-5', substr(h, 14, 3), '-', printf('%x', (('0x' || substr(h, 17, 1))::INT & 3) | 8), substr(h, 18, 3), '-', substr(h, 21, 12))) AS uuid, source || '/' || doc_id || '.pdf' AS path
    FROM (SELECT doc_id, source, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || ('doc-' || doc_id)::BLOB) AS h FROM documents)""")
def stable_uuid(spark, d):
    """Name-based ids: SHA-1 of the public URL namespace and a name, with version and variant bits set."""
    name = F.concat(F.unhex(F.lit("6ba7b8119dad11d180b400c04fd430c8")), F.encode(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")), "UTF-8"))
    h = F.sha1(name)
    s = lambda a, n: F.substring(h, a, n)
    variant = F.lower(F.hex(F.conv(s(17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))))
    return table(spark, d, "documents").select(
        "doc_id", F.concat(s(1, 8), F.lit("-"), s(9, 4), F.lit("-5"), s(14, 3), F.lit("-"), variant, s(18, 3), F.lit("-"), s(21, 12)).alias("uuid"),
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("path"))


@query("""SELECT source, avg(n_words) AS words, CASE WHEN avg(n_words) < 300 AND count(*) > 2 THEN 'slides' ELSE 'report' END AS kind
    FROM (SELECT source, len(list_filter(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) AS n_words FROM documents) GROUP BY 1""")
def slide_deck(spark, d):
    from folia.functions.text import words

    t = table(spark, d, "documents").groupBy("source").agg(F.avg(F.size(words("text"))).alias("words"), F.count("*").alias("pages"))
    return t.select("source", "words", F.when((F.col("words") < 300) & (F.col("pages") > 2), "slides").otherwise("report").alias("kind"))


@query("""WITH RECURSIVE t AS (SELECT row_number() OVER (ORDER BY conv_id, turn) AS i, conv_id, turn, list_distinct(string_split(text, '')) AS s FROM conversations),
    r AS (SELECT 0::BIGINT AS i, []::VARCHAR[][] AS kept, false AS ok UNION ALL SELECT i, CASE WHEN dup THEN kept ELSE list_append(kept, s) END, NOT dup FROM (
        SELECT t.i, t.s, r.kept, len(list_filter(r.kept, lambda k: len(list_intersect(k, t.s))::DOUBLE / (len(k) + len(t.s) - len(list_intersect(k, t.s))) >= 0.7)) > 0 AS dup FROM r JOIN t ON t.i = r.i + 1))
    SELECT conv_id, turn FROM r JOIN t USING (i) WHERE ok""")
def distinct_turns(spark, d):
    """Turns of all conversations that are unlike every turn kept before, by their characters."""
    return dedup.distinct_in_order(table(spark, d, "conversations"), ["conv_id", "turn"], "text").select("conv_id", "turn")
