"""Answer metrics over pairs of texts from the tables: turns that follow each other."""

from __future__ import annotations

from pyspark.sql import functions as F

from folia.operators import evaluation, metrics
from folia.plans.registry import query
from folia.session import table


def pairs(spark, d):
    """(conv_id, turn, gold, predicted): each turn and the next, with single spaces."""
    c = table(spark, d, "conversations").select("conv_id", "turn", F.regexp_replace("text", r"\s+", " ").alias("gold"))
    return c.join(c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("gold").alias("predicted")), ["conv_id", "turn"])


_ONE = "regexp_replace({0}, '\\s+', ' ', 'g')"
_PAIRS = f"p AS (SELECT a.conv_id, a.turn, {_ONE.format('a.text')} AS gold, {_ONE.format('b.text')} AS predicted FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn + 1 = b.turn)"
_TOK = "list_filter(list_transform(string_split(regexp_replace(lower({0}), '[-\\s]+', ' ', 'g'), ' '), lambda x: regexp_replace(x, '[^\\p{{L}}\\p{{N}}]', '', 'g')), lambda x: x <> '' AND x NOT IN ('a', 'an', 'the'))"


@query()
def metric_anls(spark, d):
    """Edit similarity of whole turns in characters; the other engine counts bytes, so tests hold it against a plain model."""
    return pairs(spark, d).select("conv_id", "turn", F.round(metrics.anls(F.col("gold"), F.col("predicted"), 0.1), 6).alias("anls"))


@query(f"""WITH {_PAIRS}, t AS (SELECT conv_id, turn, {_TOK.format('gold')} AS g, {_TOK.format('predicted')} AS q FROM p),
    m AS (SELECT conv_id, turn, len(g) AS ng, len(q) AS nq, list_sum(list_transform(list_distinct(g), lambda x: least(len(list_filter(g, lambda y: y = x)), len(list_filter(q, lambda y: y = x))))) AS shared FROM t)
    SELECT conv_id, turn, round(CASE WHEN ng = 0 OR nq = 0 THEN (ng = nq)::INT::DOUBLE ELSE 2 * coalesce(shared, 0) / (ng + nq) END, 6) AS f1 FROM m""")
def metric_token_f1(spark, d):
    g, p = metrics.normal_tokens(F.col("gold")), metrics.normal_tokens(F.col("predicted"))
    t = pairs(spark, d).select("conv_id", "turn", g.alias("g"), p.alias("p"))
    return t.select("conv_id", "turn", F.round(metrics.token_f1(F.col("g"), F.col("p")), 6).alias("f1"))


@query(f"""WITH {_PAIRS}, t AS (SELECT conv_id, turn, list_distinct({_TOK.format('gold')}) AS g, list_distinct({_TOK.format('predicted')}) AS q FROM p)
    SELECT conv_id, turn, round(CASE WHEN len(g) + len(q) = 0 THEN 1 ELSE 2 * len(list_intersect(g, q)) / (len(g) + len(q)) END, 6) AS f1, (len(g) = len(q) AND list_sort(g) = list_sort(q))::INT::DOUBLE AS em FROM t""")
def metric_em_f1(spark, d):
    g, p = metrics.normal_tokens(F.col("gold")), metrics.normal_tokens(F.col("predicted"))
    t = pairs(spark, d).select("conv_id", "turn", F.array_distinct(g).alias("g"), F.array_distinct(p).alias("p"))
    return t.select("conv_id", "turn", F.round(metrics.set_f1(F.col("g"), F.col("p")), 6).alias("f1"), metrics.list_exact(F.col("g"), F.col("p")).alias("em"))


_JOINED = "j AS (SELECT lang, quality, (quality = 1) AS answerable, (toxic = 0) AS answered, n_chars % 5 / 4.0 AS score FROM documents JOIN labels USING (doc_id))"


@query(f"""WITH {_JOINED}, s AS (SELECT lang, avg(score) AS accuracy, coalesce(sum(score) FILTER (WHERE answerable), 0) AS hit, count(*) FILTER (WHERE answerable) AS na, count(*) FILTER (WHERE answered) AS nb FROM j GROUP BY 1),
    r AS (SELECT lang, accuracy, CASE WHEN na > 0 THEN hit / na ELSE 0 END AS recall, CASE WHEN nb > 0 THEN hit / nb ELSE 0 END AS precision FROM s)
    SELECT lang, round(accuracy, 6) AS accuracy, round(recall, 6) AS recall, round(precision, 6) AS precision, round(CASE WHEN recall + precision > 0 THEN 2 * recall * precision / (recall + precision) ELSE 0 END, 6) AS f1 FROM r""")
def metric_acc_f1(spark, d):
    j = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select("lang", (F.col("quality") == 1).alias("answerable"), (F.col("toxic") == 0).alias("answered"), (F.col("n_chars") % 5 / 4.0).alias("score"))
    t = metrics.accuracy_f1(j, ["lang"], "score", "answerable", "answered")
    return t.select("lang", *[F.round(c, 6).alias(c) for c in ("accuracy", "recall", "precision", "f1")])


_NEAR = "(abs({0} - l) <= 0.01 * greatest(abs({0}), abs(l)))"


@query(f"""SELECT o_orderkey, coalesce({_NEAR.format('o_totalprice')} OR {_NEAR.format('o_totalprice / 100')} OR {_NEAR.format('o_totalprice * 100')}, false) AS equal
    FROM orders JOIN (SELECT l_orderkey, max(l_extendedprice) AS l FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def metric_numbers(spark, d):
    top = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_extendedprice").alias("l"))
    return table(spark, d, "orders").join(top, "o_orderkey").select("o_orderkey", metrics.numbers_equal(F.col("o_totalprice"), F.col("l")).alias("equal"))


@query()
def metric_aligned_f1(spark, d):
    """List F1 under the best alignment of spans; tests hold it against small cases."""
    p = pairs(spark, d).select("conv_id", "turn", F.split("gold", r"[,.]\s*").alias("g"), F.split("predicted", r"[,.]\s*").alias("p"))
    return p.select("conv_id", "turn", metrics.aligned_f1("g", "p").alias("f1"))


_CLEAN = "trim(regexp_replace(trim(regexp_replace(trim(regexp_replace(trim(regexp_replace(trim(lower({0})), '\\s*\\([^)]*\\)', '', 'g')), '^[''\"]|[''\"]$', '', 'g')), '^\\$+', '')), '%+$', ''))"


@query(f"""WITH a AS (SELECT o_orderkey, '(' || o_orderstatus || ') $' || o_totalprice || '%' AS x, CASE o_orderkey % 4 WHEN 0 THEN 'page ' || o_custkey WHEN 1 THEN o_orderdate::DATE::VARCHAR WHEN 2 THEN '"mail' || o_custkey || '@a.example"' ELSE 'text "' || o_custkey END AS y FROM orders),
    c AS (SELECT o_orderkey, {_CLEAN.format('x')} AS x, {_CLEAN.format('y')} AS y FROM a)
    SELECT o_orderkey, x, y, regexp_matches(y, '^page|^\\d{{4}}[-\\s]\\d{{2}}[-\\s]\\d{{2}}$|^[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}$') AS exact FROM c""")
def metric_clean_answer(spark, d):
    k = F.col("o_orderkey") % 4
    cust = F.col("o_custkey").cast("string")
    y = F.when(k == 0, F.concat(F.lit("page "), cust)).when(k == 1, F.col("o_orderdate").cast("date").cast("string")).when(k == 2, F.concat(F.lit('"mail'), cust, F.lit('@a.example"'))).otherwise(F.concat(F.lit('text "'), cust))
    x = F.concat(F.lit("("), "o_orderstatus", F.lit(") $"), F.col("o_totalprice").cast("string"), F.lit("%"))
    t = table(spark, d, "orders").select("o_orderkey", metrics.clean_answer(x).alias("x"), metrics.clean_answer(y).alias("y"))
    return t.withColumn("exact", metrics.exact_only(F.col("y")))


_NORM = """array_to_string(list_filter(string_split(regexp_replace(regexp_replace(lower({0}), '[!"#$%&''()*+,\\-./:;<=>?@\\[\\\\\\]^_`{{|}}~]', '', 'g'), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'), ' '), lambda x: x NOT IN ('', 'a', 'an', 'the')), ' ')"""
_W3 = "list_filter(string_split({0}, ' '), lambda x: x <> '')[1:3]"
# golds of a turn: two spans and its whole text, but for turns that are a multiple of four, which have none, and yes for those after
_GOLDS = f"""{_PAIRS}, gd AS (SELECT conv_id, turn, predicted, 'extractive' AS type, array_to_string({_W3.format('gold')}, ' ') || ', ' || right(gold, 12) AS answer, [array_to_string({_W3.format('gold')}, ' '), right(gold, 12)] AS raw FROM p WHERE turn % 4 <> 0
    UNION ALL SELECT conv_id, turn, predicted, 'abstractive', gold, [gold] FROM p WHERE turn % 4 NOT IN (0, 1)
    UNION ALL SELECT conv_id, turn, predicted, 'boolean', 'Yes', ['Yes'] FROM p WHERE turn % 4 = 1
    UNION ALL SELECT conv_id, turn, predicted, 'none', 'Not answerable', ['Not answerable'] FROM p WHERE turn % 4 = 0),
    nm AS (SELECT conv_id, turn, type, {_NORM.format('predicted')} AS q, {_NORM.format('answer')} AS g, list_transform(raw, lambda r: {_NORM.format('r')}) AS raw FROM gd),
    tk AS (SELECT *, list_filter(string_split(q, ' '), lambda x: x <> '') AS qt, list_filter(string_split(g, ' '), lambda x: x <> '') AS gt FROM nm),
    sh AS (SELECT *, coalesce(list_sum(list_transform(list_distinct(gt), lambda x: least(len(list_filter(gt, lambda y: y = x)), len(list_filter(qt, lambda y: y = x))))), 0) AS same FROM tk),
    sc AS (SELECT conv_id, turn, max((len(list_filter(raw, lambda r: contains(q, r))) > 0)::INT::DOUBLE) AS accuracy, max(CASE WHEN same = 0 THEN 0 ELSE 2.0 * same / (len(qt) + len(gt)) END) AS f1, count(*) AS n_golds, bool_or(type <> 'none') AS answerable FROM sh GROUP BY 1, 2)"""


def _scored(spark, d):
    p = pairs(spark, d)
    first = F.array_join(F.slice(F.filter(F.split("gold", " "), lambda x: x != ""), 1, 3), " ")
    no, k = F.lit(None), F.col("turn") % 4
    info = lambda un, spans, free, yes: F.struct(un.alias("unanswerable"), spans.cast("array<string>").alias("extractive_spans"), free.cast("string").alias("free_form_answer"), yes.cast("boolean").alias("yes_no"), F.array().cast("array<string>").alias("evidence"))
    spans = F.array(first, F.expr("right(gold, 12)"))
    infos = F.when(k == 0, F.array(info(F.lit(True), spans, F.col("gold"), no))).when(k == 1, F.array(info(F.lit(False), spans, no, no), info(F.lit(False), no, no, F.lit(True)))).otherwise(
        F.array(info(F.lit(False), spans, no, no), info(F.lit(False), F.array(), F.col("gold"), no)))
    results = p.select("conv_id", "turn", F.col("predicted").alias("prediction"))
    return evaluation.evaluate(results, p.select("conv_id", "turn", infos.alias("infos")), ["conv_id", "turn"])


@query(f"WITH {_GOLDS} SELECT conv_id, turn, accuracy, round(f1, 6) AS f1, n_golds::INT AS n_golds, answerable FROM sc")
def answer_scores(spark, d):
    """Each next turn against several gold answers of the turn: the best containment and token F1."""
    return _scored(spark, d).select("conv_id", "turn", "accuracy", F.round("f1", 6).alias("f1"), "n_golds", "answerable")


@query(f"WITH {_GOLDS} SELECT role, count(*) AS n, count(*) FILTER (WHERE answerable) AS n_answerable, round(avg(accuracy), 6) AS accuracy, round(avg(f1), 6) AS f1, round(avg(accuracy) FILTER (WHERE answerable), 6) AS answerable_accuracy, round(avg(f1) FILTER (WHERE answerable), 6) AS answerable_f1 FROM sc JOIN (SELECT conv_id, turn, role FROM conversations) USING (conv_id, turn) GROUP BY 1")
def answer_report(spark, d):
    roles = table(spark, d, "conversations").select("conv_id", "turn", "role")
    out = evaluation.report(_scored(spark, d).join(roles, ["conv_id", "turn"]), ["role"])
    return out.select("role", "n", "n_answerable", *[F.round(c, 6).alias(c) for c in ("accuracy", "f1", "answerable_accuracy", "answerable_f1")])


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'Failed to extract' ELSE o_orderpriority || ': ' || o_orderstatus END AS extracted, CASE WHEN o_orderkey % 3 = 0 THEN 'Failed to extract' ELSE 'Str' END AS format,
    CASE WHEN o_orderkey % 7 = 0 THEN 0 WHEN o_orderkey % 7 = 1 THEN 0 ELSE (o_orderkey % 4) / 4.0 END::DOUBLE AS score FROM orders""")
def judge_scores(spark, d):
    """Answers of a judge as lines of keys and values, some of them missing or odd."""
    k = F.col("o_orderkey")
    text = F.concat(
        F.lit("I compared both. \n"), F.when(k % 5 != 0, F.concat(F.lit(" Extracted Results :  "), "o_orderpriority", F.lit(": "), "o_orderstatus", F.lit(" \n"))).otherwise(""),
        F.when(k % 3 != 0, "Format: Int\nnote: none\nFORMAT:Str\n").otherwise(""), F.when(k % 7 == 0, "").when(k % 7 == 1, "Score: high").otherwise(F.concat(F.lit("score: "), ((k % 4) / 4.0).cast("string"))))
    return table(spark, d, "orders").select("o_orderkey", evaluation.judge_answer(text).alias("j")).select("o_orderkey", "j.*")


@query("""WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ['Int', 'Float', 'Str', 'List'][1 + (l_orderkey % 4)::INT] AS kind, l_quantity AS q, l_extendedprice AS x, l_linenumber AS n, lower(p_name) AS name, lower(p_type) AS type FROM lineitem JOIN part ON p_partkey = l_partkey),
    f AS (SELECT *, round(x * (1 + n * 0.004), 2) AS y FROM t), s AS (SELECT *, 1 - levenshtein(name, name || ' ' || type) / length(name || ' ' || type) AS a, 1 - levenshtein(type, name) / greatest(length(type), length(name)) AS b FROM f)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE kind WHEN 'Int' THEN (n % 2 = 0)::INT::DOUBLE
        WHEN 'Float' THEN (abs(x - y) <= 0.01 * greatest(x, y) OR round_even(x * 100, 0) = round_even(y * 100, 0))::INT::DOUBLE
        WHEN 'Str' THEN CASE WHEN a > 0.5 THEN round(a, 6) ELSE 0 END
        ELSE CASE WHEN n % 3 = 0 THEN 0 WHEN n % 3 = 1 THEN 1 ELSE 0.0 END END AS score FROM s""")
def typed_scores(spark, d):
    """Scores by answer format: whole numbers, numbers within a percent, texts, and lists of one or several items."""
    li = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey"))
    n, kind = F.col("l_linenumber"), F.element_at(F.array(*map(F.lit, ("Int", "Float", "Str", "List"))), (F.col("l_orderkey") % 4 + 1).cast("int"))
    q, x, name = F.col("l_quantity").cast("long"), F.col("l_extendedprice").cast("double"), F.col("p_name")
    both = F.to_json(F.array("p_name", F.lit("the very last one")))
    gold = F.when(kind == "Int", q.cast("string")).when(kind == "Float", x.cast("string")).when(kind == "Str", name).otherwise(both)
    guess = (
        F.when(kind == "Int", F.concat((q + n % 2).cast("string"), F.lit(".7"))).when(kind == "Float", F.round(x * (1 + n * 0.004), 2).cast("string")).when(kind == "Str", F.concat_ws(" ", name, "p_type"))
        .when(n % 3 == 0, name).when(n % 3 == 1, F.to_json(F.array(F.lit("The very last one"), F.upper("p_name")))).otherwise(F.to_json(F.array("p_name", F.lit("zzzz"))))
    )
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(metrics.typed_score(kind, gold, guess), 6).alias("score"))
