"""BM25, vectors, skylines and their composition into retrieval."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from folia.operators import bm25, ranking, skyline, vector
from folia.plans.registry import query
from folia.session import table

_TOKENS = "t AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) AS term FROM documents)"
_BM25 = f"""{_TOKENS},
    dl AS (SELECT doc_id, count(*) AS dl FROM t GROUP BY 1), n AS (SELECT count(*) AS n FROM documents), a AS (SELECT sum(dl) / (SELECT n FROM n) AS avgdl FROM dl),
    tf AS (SELECT term, doc_id, count(*) AS tf FROM t GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
    idf AS (SELECT term, df, ln((n - df + 0.5) / (df + 0.5) + 1) AS idf FROM df, n),
    q AS (SELECT item_id, unnest(list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) AS term FROM benchmark),
    s AS (SELECT item_id, doc_id, round(sum(idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 6) AS score FROM q JOIN idf USING (term) JOIN tf USING (term) JOIN dl USING (doc_id), a GROUP BY ALL)"""


@query(f"WITH {_BM25} SELECT item_id, doc_id, round(score, 6) AS score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 5")
def bm25_topk(spark, d):
    return bm25.search(table(spark, d, "documents"), table(spark, d, "benchmark"), 5).select("item_id", "doc_id", F.round("score", 6).alias("score"), "rank")


@query(f"WITH {_BM25} SELECT term, df, round(idf, 6) AS idf FROM idf")
def bm25_term_stats(spark, d):
    docs = table(spark, d, "documents")
    return bm25.term_stats(bm25.postings(docs), docs.count()).withColumn("idf", F.round("idf", 6))


_HITS = """h AS (SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS score
    FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
    k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM h)"""


def _hits(spark, d, k):
    v = table(spark, d, "embeddings")
    return vector.nearest(v.where("vec_id % 100 = 0"), v, k)


@query(f"WITH {_HITS} SELECT query_id, vec_id, round(score, 6) AS score, rank::INT AS rank FROM k WHERE rank <= 5")
def vector_topk(spark, d):
    return _hits(spark, d, 5).withColumn("score", F.round("score", 6))


@query(f"""WITH {_HITS}, b AS (SELECT query_id, vec_id, 1 - score AS distance FROM k WHERE rank = 1)
    SELECT query_id, vec_id, round(distance, 6) AS distance FROM b WHERE distance < 0.55
    UNION ALL SELECT query_id, vec_id, round(distance, 6) FROM b WHERE (SELECT min(distance) FROM b) >= 0.55 AND query_id = (SELECT query_id FROM b ORDER BY distance, query_id LIMIT 1)""")
def vector_threshold_map(spark, d):
    return vector.threshold_map(_hits(spark, d, 1), 0.55).select("query_id", "vec_id", F.round("distance", 6).alias("distance"))


@query(f"""WITH {_HITS}, g AS (SELECT *, coalesce(score >= 0.97 * lag(score) OVER (PARTITION BY query_id ORDER BY rank), true) AS ok FROM k WHERE rank <= 10)
    SELECT query_id, vec_id, rank::INT AS rank FROM (SELECT *, bool_and(ok) OVER (PARTITION BY query_id ORDER BY rank) AS keep FROM g) WHERE keep""")
def gradient_select(spark, d):
    return vector.gradient_cut(_hits(spark, d, 10), "query_id", "rank", "score", 0.97).select("query_id", "vec_id", "rank")


@query("""SELECT p_partkey, p_size, p_retailprice FROM part a WHERE NOT EXISTS (SELECT 1 FROM part b WHERE b.p_size >= a.p_size AND b.p_retailprice >= a.p_retailprice AND (b.p_size > a.p_size OR b.p_retailprice > a.p_retailprice))""")
def skyline_2d(spark, d):
    return skyline.skyline_2d(table(spark, d, "part"), "p_size", "p_retailprice").select("p_partkey", "p_size", "p_retailprice")


@query("""WITH s AS (SELECT s_suppkey, s_nationkey, s_acctbal, s_suppkey % 17 AS slot FROM supplier)
    SELECT s_suppkey, s_nationkey, s_acctbal, slot::INT AS slot FROM s a WHERE NOT EXISTS (SELECT 1 FROM s b WHERE b.s_nationkey >= a.s_nationkey AND b.s_acctbal >= a.s_acctbal AND b.slot >= a.slot
        AND (b.s_nationkey > a.s_nationkey OR b.s_acctbal > a.s_acctbal OR b.slot > a.slot))""")
def skyline_nd(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal", (F.col("s_suppkey") % 17).cast("int").alias("slot"))
    return skyline.skyline(s, ["s_nationkey", "s_acctbal", "slot"])


_FRONT = """f AS (SELECT p_partkey FROM part a WHERE NOT EXISTS (SELECT 1 FROM part b WHERE b.p_size >= a.p_size AND b.p_retailprice >= a.p_retailprice AND (b.p_size > a.p_size OR b.p_retailprice > a.p_retailprice)))"""


@query(f"""WITH {_FRONT} SELECT p_partkey FROM f
    UNION SELECT p_partkey FROM (SELECT p_partkey FROM part ORDER BY p_size DESC, p_partkey LIMIT 5) WHERE (SELECT count(*) FROM f) < 1000 AND (SELECT count(*) FROM part) >= 1000
    UNION SELECT p_partkey FROM (SELECT p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 5) WHERE (SELECT count(*) FROM f) < 1000 AND (SELECT count(*) FROM part) >= 1000""")
def skyline_fallback(spark, d):
    return ranking.select_front(table(spark, d, "part"), "p_partkey", "p_size", "p_retailprice", 1000).select("p_partkey")


@query("""SELECT doc_id, coalesce(n_chars, 0)::DOUBLE AS length_score, coalesce(quality, 0)::DOUBLE AS quality_score
    FROM (SELECT doc_id, n_chars FROM documents) FULL JOIN labels USING (doc_id)""")
def rank_merge(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.col("n_chars").alias("score"))
    return ranking.merge_scores({"length_score": docs, "quality_score": table(spark, d, "labels").select("doc_id", F.col("quality").alias("score"))}, "doc_id")


_LINKS = "b AS (SELECT DISTINCT l_orderkey AS node, l_partkey AS entity FROM lineitem), e AS (SELECT p_partkey AS entity FROM part WHERE p_brand = 'Brand#2')"


@query(f"""WITH {_LINKS} SELECT node, count(*) AS map_cnt, string_agg(entity, ',' ORDER BY entity) AS linked FROM b JOIN e USING (entity) GROUP BY node""")
def node_entity_link(spark, d):
    bridge = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("node"), F.col("l_partkey").alias("entity"))
    entities = table(spark, d, "part").where("p_brand = 'Brand#2'").select(F.col("p_partkey").alias("entity"))
    return ranking.linked_nodes(entities, bridge).select("node", "map_cnt", F.array_join(F.transform("linked", lambda x: x.cast("string")), ",").alias("linked"))


@query(f"""WITH {_LINKS} SELECT c_nationkey AS section, count(DISTINCT entity) AS n_entities, count(DISTINCT node) AS n_nodes
    FROM b JOIN e USING (entity) JOIN orders ON o_orderkey = node JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def section_link(spark, d):
    bridge = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("node"), F.col("l_partkey").alias("entity"))
    entities = table(spark, d, "part").where("p_brand = 'Brand#2'").select(F.col("p_partkey").alias("entity"))
    hits = bridge.join(entities, "entity", "left_semi").distinct()
    up = table(spark, d, "orders").select(F.col("o_orderkey").alias("node"), "o_custkey").join(table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("section")), "o_custkey")
    return hits.join(up, "node").groupBy("section").agg(F.count_distinct("entity").alias("n_entities"), F.count_distinct("node").alias("n_nodes"))


@query(f"""WITH {_BM25},
    best AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s),
    c AS (SELECT item_id, doc_id, score, coalesce(quality, 0) + coalesce(1 - toxic, 0) AS trust FROM best LEFT JOIN labels USING (doc_id) WHERE rank <= 20)
    SELECT item_id, doc_id, round(score, 6) AS score, trust::INT AS trust FROM c a WHERE NOT EXISTS (
        SELECT 1 FROM c b WHERE b.item_id = a.item_id AND b.score >= a.score AND b.trust >= a.trust AND (b.score > a.score OR b.trust > a.trust))""")
def hybrid_retrieval(spark, d):
    """For each question the best BM25 documents that no other beats in both score and trust (labels): a skyline for each question."""
    hits = bm25.search(table(spark, d, "documents"), table(spark, d, "benchmark"), 20)
    trust = table(spark, d, "labels").select("doc_id", (F.col("quality") + 1 - F.col("toxic")).cast("int").alias("trust"))
    c = hits.join(trust, "doc_id", "left").withColumn("trust", F.coalesce("trust", F.lit(0)))
    better = Window.partitionBy("item_id").orderBy(F.desc("trust")).rangeBetween(Window.unboundedPreceding, -1)
    level = Window.partitionBy("item_id", "trust")
    c = c.withColumn("top", F.max("score").over(level)).withColumn("above", F.max("score").over(better))
    return c.where("score = top and (above is null or score > above)").select("item_id", "doc_id", F.round("score", 6).alias("score"), "trust")


@query("""SELECT item_id, doc_id FROM (
    SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY doc_id) AS r FROM benchmark b JOIN documents d ON contains(d.text, b.text)) WHERE r <= 3""")
def route_documents(spark, d):
    """Documents that hold a question's text as a whole, three at most for each: routing by exact containment.

    A word before or after the text may be glued to it, so its inner words, eight at most, are the key of an equi-join, whatever their
    number; the containment test runs on what meets. Questions of two words and less have no inner word and are held against all documents."""
    words = F.filter(F.split("text", r"[ \n]"), lambda x: x != "")
    q = table(spark, d, "benchmark").select("item_id", F.col("text").alias("question"), words.alias("w"))
    q = q.withColumn("len", F.greatest(F.lit(0), F.least(F.lit(8), F.size("w") - 2)))
    docs = table(spark, d, "documents").select("doc_id", "text", words.alias("w"))
    key = lambda i, n: F.xxhash64(F.array_join(F.slice("w", i, n), " "))
    asked = q.where("len > 0").select("item_id", "len", key(F.lit(2), F.col("len")).alias("k"))
    pairs = None
    for n in [r["len"] for r in asked.select("len").distinct().collect()]:  # eight lengths at most
        spots = docs.where(F.size("w") >= n).select("doc_id", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: key(i, F.lit(n))))).alias("k"))
        part = spots.join(asked.where(F.col("len") == n).select("item_id", "k"), "k").select("item_id", "doc_id")
        pairs = part if pairs is None else pairs.union(part)
    short = q.where("len = 0").select("item_id", "question").join(docs.select("doc_id", "text"), F.contains("text", "question")).select("item_id", "doc_id")
    pairs = (short if pairs is None else pairs.union(short)).distinct()
    checked = pairs.join(docs.select("doc_id", "text"), "doc_id").join(q.select("item_id", "question"), "item_id").where(F.contains("text", "question"))
    r = F.row_number().over(Window.partitionBy("item_id").orderBy("doc_id"))
    return checked.withColumn("r", r).where("r <= 3").select("item_id", "doc_id")
