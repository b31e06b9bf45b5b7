"""Plans of questions, extraction in rounds, outlines in chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from folia.operators import gleaning, outlines, planning
from folia.plans.registry import query
from folia.plans.tree_queries import _HEADS, _heads
from folia.session import table


@query("""WITH RECURSIVE s AS (SELECT conv_id, turn::INT AS step, (turn // 2)::INT AS up, text FROM conversations),
    r AS (SELECT conv_id, step, 0 AS level, text AS asked, md5(text) AS answer FROM s WHERE step = 0
        UNION ALL SELECT s.conv_id, s.step, level + 1, s.text || ' (' || r.answer || ')', md5(s.text || ' (' || r.answer || ')') FROM s JOIN r ON r.conv_id = s.conv_id AND r.step = s.up WHERE s.step > 0)
    SELECT conv_id, step, level, answer FROM r""")
def plan_answers(spark, d):
    """Turns as steps that each wait on the turn of half their number; an answer is the digest of what was asked, with the answer before it filled in."""
    c = table(spark, d, "conversations").withColumn("step", F.col("turn").cast("int"))
    up = F.floor(F.col("step") / 2).cast("int")
    later = F.col("step") > 0
    question = F.when(later, F.concat("text", F.lit(" ({"), up.cast("string"), F.lit("})"))).otherwise(F.col("text"))
    steps = c.select("conv_id", "step", F.lit("retrieval").alias("type"), question.alias("question"), F.when(later, F.array(up)).otherwise(F.array().cast("array<int>")).alias("depends"))
    done, _ = planning.run_plans(steps, "conv_id", lambda t: t.withColumn("answer", F.md5("asked")))
    return done.select("conv_id", "step", "level", "answer")


_FOUND = lambda kind, pattern, of: f"SELECT DISTINCT doc_id, '{kind}' AS kind, unnest(regexp_extract_all(text, '{pattern}', 1)) AS record FROM documents WHERE text IS NOT NULL{of}"
_GLEAN = ", ".join(
    f"g{n} AS ({_FOUND(kind, pattern, '' if not n else f' AND doc_id IN (SELECT doc_id FROM g{n - 1})')})" for n, (kind, pattern) in enumerate(gleaning.ROUNDS)
)


@query(f"WITH {_GLEAN} " + " UNION ALL ".join(f"SELECT *, {n} AS round FROM g{n}" for n in range(len(gleaning.ROUNDS))))
def gleaned_records(spark, d):
    """Names, addresses, codes, numbers and acronyms of whole documents; a document goes on as long as its last round found something."""
    docs = table(spark, d, "documents").where("text is not null").select(F.col("doc_id").alias("chunk_id"), "text")
    return gleaning.glean(docs, most_rounds=len(gleaning.ROUNDS)).withColumnRenamed("chunk_id", "doc_id")


@query(f"""WITH {_HEADS}, n AS (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 10 AS run FROM h), f AS (SELECT user_id, run, min(event_id) AS first FROM n GROUP BY 1, 2),
    o AS (SELECT f.user_id, run, count(*) AS n_open FROM f JOIN h x ON x.user_id = f.user_id AND x.event_id < first
        AND NOT EXISTS (SELECT 1 FROM h y WHERE y.user_id = x.user_id AND y.event_id > x.event_id AND y.event_id < first AND y.level <= x.level) GROUP BY 1, 2)
    SELECT event_id, run, coalesce(n_open, 0) AS n_open, (SELECT max(p.event_id) FROM h p WHERE p.user_id = n.user_id AND p.event_id < n.event_id AND p.level < n.level) AS parent FROM n LEFT JOIN o USING (user_id, run)""")
def outline_chunks(spark, d):
    """Parents of headings found in chunks of ten, each given the headings that are open where it begins."""
    t = outlines.outline_in_chunks(_heads(spark, d), ["user_id"], "event_id", "level", 3, most=10, block=64)
    return t.select("event_id", F.col("chunk.run").alias("run"), F.size("context").cast("long").alias("n_open"), "parent")


@query(f"""WITH {_HEADS}, f AS (SELECT user_id, max(event_id) FILTER (WHERE level = 1) AS f FROM h GROUP BY 1),
    p AS (SELECT user_id, event_id, level, 0 AS part FROM h WHERE level = 0
        UNION ALL SELECT user_id, event_id, level, 1 FROM h WHERE level = 1 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) <= 3
        UNION ALL SELECT user_id, event_id, level, 2 FROM h WHERE level = 1 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 5
        UNION ALL SELECT user_id, event_id, level, 3 FROM h JOIN f USING (user_id) WHERE f IS NULL OR event_id >= f QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 5),
    d AS (SELECT user_id, event_id, level, min(part) AS part FROM p GROUP BY ALL)
    SELECT user_id, event_id, level, row_number() OVER (PARTITION BY user_id ORDER BY part, event_id) - 1 AS place FROM d""")
def outline_context(spark, d):
    """What of each user's outline a next chunk would be shown."""
    return outlines.outline_context(_heads(spark, d), ["user_id"], "event_id", "level")
