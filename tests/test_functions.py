"""Small cases by hand, and plain models of the sequential operators."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from folia.functions import text as X
from folia.operators import blocks, chunking, graph, metrics, sampling, skyline, tree, vector
from folia.sources import html_tables, markdown, tables


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expr.alias("x")).first()["x"]


def test_text_predicates(spark):
    t = lambda f, s: one(spark, f("c"), s)
    assert t(X.is_contents, "Introduction . . . . . 12") and not t(X.is_contents, "A plain sentence here.")
    assert t(X.is_boilerplate, "see www.a.org or mail x@y.org") and t(X.is_boilerplate, " 12 / 30 ") and not t(X.is_boilerplate, "see www.a.org")
    assert t(X.looks_incomplete, "Rows that share a key are sent to one place because")
    assert t(X.looks_incomplete, "Every shuffle of these rows costs time, network and.")
    assert t(X.looks_incomplete, "Half of the ledger went to the ware-")
    assert not t(X.looks_incomplete, 'On the wall stood: "Mind the open hatch."') and not t(X.looks_incomplete, "Too short") and not t(X.looks_incomplete, "")
    assert t(X.is_acronym, "NASA went") and not t(X.is_acronym, "A thing") and not t(X.is_acronym, "12 things")
    assert t(X.clean_string, " A&amp;B\x07 é! ") == "a b"
    assert t(lambda c: X.split_any(c, ["##", "|"]), "4a## b |  |5c") == ["4a", "b", "5c"]
    assert t(X.is_float, "1.5e3") and not t(X.is_float, "x1")
    assert t(X.fix_hyphens, "exam- ple") == "exam-ple"


def test_garbage(spark):
    good = " ".join(f"word{k}" for k in range(20))
    bad = " ".join("tktktktktktktktkt")
    assert one(spark, X.cut_garbage("c"), f"{good} {bad}").startswith("word0 word1")
    assert one(spark, X.garbage_start("c"), f"{good} {bad}") in (18, 19, 20)
    assert one(spark, X.cut_garbage("c"), bad) == "" and one(spark, X.cut_garbage("c"), good) == good


def test_packing(spark):
    r = random.Random(1)
    rows = [(k, [r.randrange(1, 60) for _ in range(r.randrange(0, 40))]) for k in range(50)]
    got = {x["k"]: x["p"] for x in spark.createDataFrame(rows, "k int, s array<int>").select("k", X.pack_greedy("s", F.lit(100)).alias("p")).collect()}
    for k, sizes in rows:
        chunk, held, want = 0, 0, []
        for n in sizes:
            if held and held + n > 100:
                chunk, held = chunk + 1, 0
            held += n
            want.append(chunk)
        assert got[k] == want
    docs = spark.createDataFrame([(1, "One two. Three four five! Six?"), (2, ""), (3, "a " * 25)], "doc_id int, text string")
    out = sorted((x["doc_id"], x["chunk_id"], x["n_words"], x["n_sentences"], x["text"]) for x in chunking.sentence_chunks(docs, 5).collect())
    assert out[:2] == [(1, 0, 5, 2, "One two. Three four five!"), (1, 1, 1, 1, "Six?")] and len([x for x in out if x[0] == 3]) == 5


def test_headings(spark):
    r = random.Random(3)
    rows = [(d, k, r.randrange(4)) for d in range(8) for k in range(30)]
    df = spark.createDataFrame(rows, "d int, k int, level int")
    got = {(x["d"], x["k"]): x["parent"] for x in tree.heading_parents(df, ["d"], "k", "level", 3).collect()}
    ends = {(x["d"], x["k"]): x["end_level"] for x in tree.section_ends(df, ["d"], "k", "level", 3).collect()}
    for d in range(8):
        stack = []
        mine = [x for x in rows if x[0] == d]
        for _, k, level in mine:
            while stack and stack[-1][1] >= level:
                stack.pop()
            assert got[d, k] == (stack[-1][0] if stack else None)
            stack.append((k, level))
            assert ends[d, k] == next((j for _, j, v in mine if j > k and v <= level), None)


def test_tree(spark):
    rows = [("a", 0, None), ("a", 1, 0), ("a", 2, 0), ("a", 3, 1), ("b", 0, None), ("b", 9, 7)]
    t = tree.with_paths(spark.createDataFrame(rows, "doc string, node_id int, parent_id int"), ["doc"])
    assert sorted((x["doc"], x["node_id"], x["depth"], x["path"]) for x in t.collect()) == [("a", 0, 0, [0]), ("a", 1, 1, [0, 1]), ("a", 2, 1, [0, 2]), ("a", 3, 2, [0, 1, 3]), ("b", 0, 0, [0])]
    sub = tree.subtree(t, spark.createDataFrame([("a", 1), ("a", 3)], "doc string, node_id int"), ["doc"])
    assert sorted(x["node_id"] for x in sub.collect()) == [1, 3]


def test_skylines(spark):
    r = random.Random(5)
    rows = [(k, r.randrange(30), r.randrange(30), r.randrange(5)) for k in range(300)]
    df = spark.createDataFrame(rows, "id int, a int, b int, c int")

    def front(dims):
        v = [tuple(x[i] for i in dims) for x in rows]
        return {x[0] for x, p in zip(rows, v) if not any(all(s >= t for s, t in zip(q, p)) and q != p for q in v)}

    assert {x["id"] for x in skyline.skyline_2d(df, "a", "b").collect()} == front((1, 2))
    assert {x["id"] for x in skyline.skyline(df, ["a", "b", "c"]).collect()} == front((1, 2, 3))
    assert skyline.skyline_2d(df.limit(0), "a", "b").count() == 0


def test_pagerank_mass(spark):
    edges = spark.createDataFrame([(1, 2, 1.0), (2, 3, 2.0), (1, 3, 1.0)], "a int, b int, weight double")
    nodes = spark.createDataFrame([(k,) for k in range(1, 6)], "node int")
    got = {x["node"]: x["rank"] for x in graph.pagerank(nodes, edges, spark.createDataFrame([(1, 1.0), (5, 1.0)], "node int, mass double")).collect()}
    assert abs(sum(got.values()) - 1) < 1e-6 and got[4] < 1e-6 and got[1] > got[2]


def test_components(spark):
    e = spark.createDataFrame([(k, k + 1) for k in range(20)] + [(50, 51)], "a int, b int")
    got = {x["node"]: x["root"] for x in graph.smallest_reachable(e).collect()}
    assert set(got.values()) == {0, 50} and len(got) == 23


def test_vectors(spark):
    v = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0]), (3, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    got = vector.nearest(v.where("vec_id = 0"), v, 2).orderBy("rank").collect()
    assert [x["vec_id"] for x in got] == [1, 2]
    far = vector.threshold_map(vector.nearest(v.where("vec_id = 3"), v, 1), 0.2).collect()
    assert [x["vec_id"] for x in far] == [2]
    e = spark.createDataFrame([("a b",), ("a b",), ("",)], "t string").select(vector.hashing_embedder(8)("t").alias("v")).collect()
    assert e[0]["v"] == e[1]["v"] and not any(e[2]["v"])


def test_records(spark):
    raw = '("entity"<|>Tall  Tower<|>big place<|>It is tall)##("relationship"<|>A<|>B<|>near<|>strong)##("relationship"<|>A<|>B<|>near<|>3.5)##("entity"<|>short)<|COMPLETE|>'
    got = blocks.parse_records(spark.createDataFrame([(1, raw)], "id int, raw string"), ["id"], "raw").orderBy("pos").collect()
    assert [(x["kind"], x["name"], x["type"], x["target"], x["weight"]) for x in got] == [("entity", "tall tower", "BIG_PLACE", None, None), ("relationship", "a", None, "b", 1.0), ("relationship", "a", None, "b", 3.5)]


def test_html_grid(spark):
    html = "<table><tr><th rowspan=2>K</th><th colspan=2>Size</th></tr><tr><th>w</th><th>h</th></tr><tr><td>a</td><td>1</td><td>2</td></tr><tr><td>b</td></tr></table>"
    assert html_tables.grid(html) == [["K", "Size", "Size"], ["K", "w", "h"], ["a", "1", "2"], ["b", "", ""]]
    assert html_tables.grid("") == []
    df = spark.createDataFrame([(html,)], "h string").withColumn("g", html_tables.table_grid("h"))
    x = df.select(html_tables.header_rows(F.col("g")).alias("n"), html_tables.column_names(F.col("g"), html_tables.header_rows(F.col("g"))).alias("c"), html_tables.table_text("g", F.lit("Cap"), F.lit(None).cast("string")).alias("t")).first()
    assert x["n"] == 2 and x["c"] == ["K", "Size > w", "Size > h"] and x["t"].splitlines() == ["Cap", "K, Size > w, Size > h", "| a | 1 | 2 |", "| b |  |  |"]


def test_markdown(spark):
    md = "# One\n\npara <b>x</b>\nmore\n\n![alt](p.png)\n### Three\n| a | b |\n| 1 | 2 |\n"
    got = markdown.markdown_blocks(spark.createDataFrame([(1, md)], "id int, text string"), "id", "text").orderBy("pdf_id").collect()
    assert [(x["type"], x["text"], x["text_level"], x["img_path"]) for x in got] == [("title", "One", 1, None), ("text", "para x\nmore", None, None), ("image", "alt", None, "p.png"), ("title", "Three", 3, None), ("table", "| a | b |\n| 1 | 2 |", None, None)]


def test_metrics(spark):
    x = spark.createDataFrame([("Int", "12", "12.2"), ("Float", "0.5", "50%"), ("Str", "abcd", "abce"), ("List", '["a","b"]', '["B","A"]'), ("List", '["a"]', '["a","b"]'), ("Str", "abc", "xyz")], "k string, g string, p string")
    assert [r["s"] for r in x.select(metrics.typed_score(F.col("k"), F.col("g"), F.col("p")).alias("s")).collect()] == [1.0, 1.0, 0.75, 1.0, 0.0, 0.0]
    y = spark.createDataFrame([(["paris", "london town"], ["london town", "paris"]), (["a"], []), ([], [])], "g array<string>, p array<string>")
    assert [r["f"] for r in y.select(metrics.aligned_f1("g", "p").alias("f")).collect()] == [1.0, 0.0, 1.0]
    z = spark.createDataFrame([("The twenty-one 1,000 dogs!",)], "t string").select(metrics.normal_tokens(F.col("t")).alias("t")).first()["t"]
    assert z == ["20", "1", "1000", "dogs"]


def test_sampling(spark):
    t = sampling.allocate(spark.createDataFrame([("a", 100), ("b", 50), ("c", 0)], "k string, n0 long"), "k", "n0", 30, 2).collect()
    assert sum(x["n"] for x in t) in (30, 31, 32) and all(x["n"] >= 1 for x in t)
    g = sampling.greedy_distinct(spark.createDataFrame([(1, 0, "abc"), (1, 1, "cab"), (1, 2, "xyz"), (2, 0, "abc")], "g int, o int, t string"), "g", "o", "t")
    assert sorted((x["g"], x["o"]) for x in g.collect()) == [(1, 0), (1, 2), (2, 0)]


def test_sinks(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, output string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "id int, output string")
    assert sorted((x["id"], x["output"]) for x in tables.upsert(old, new, ["id"]).collect()) == [(1, "a"), (2, "c"), (3, "d")]
    assert [x["id"] for x in tables.without_done(new, old, ["id"]).collect()] == [3]
    ok, bad = tables.quarantine(old, "case when id = 1 then 'one' end")
    assert ok.count() == 1 and bad.first()["error"] == "one"
    (tmp_path / "t.json").write_text('{"nodes":[{"index_id":0,"type":"root"},{"index_id":1,"parent_id":0,"type":"NodeType.TEXT","meta_info":{"content":"x"}}]}')
    n = tables.read_trees(spark, str(tmp_path / "t.json")).orderBy("index_id").collect()
    assert [(x["index_id"], x["type"]) for x in n] == [(0, "root"), (1, "text")]


def test_streaming(spark, tiny, tmp_path):
    from folia.streaming import incremental

    src = spark.read.parquet(f"{tiny}/events.parquet")
    src.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = incremental.landing(spark, str(tmp_path / "in"), src.schema, 1)
    q = incremental.windowed_counts(stream, "ts", "event_type", late="1000 days").writeStream.outputMode("complete").format("memory").queryName("win").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c1")).start()
    q.awaitTermination(120)
    got = {(r["window"]["start"], r["event_type"]): r["n"] for r in spark.table("win").collect()}
    want = {(r["w"]["start"], r["event_type"]): r["count"] for r in src.groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour").alias("w"), "event_type").count().collect()}
    assert got == want
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text")
    docs.repartition(2).write.parquet(str(tmp_path / "docs"))
    incremental.index_documents(incremental.landing(spark, str(tmp_path / "docs"), docs.schema, 1), str(tmp_path / "idx"), str(tmp_path / "c2")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "idx/lengths")).count() == docs.count()


def test_extraction(spark):
    from folia.operators import extraction as E

    df = spark.createDataFrame([('ok: {"a": 1,} done', "x [1, 2] y", "K: 1\nk: 2\nnone"), ("{'a': 2}", "no", ""), ("none", "no", "")], "j string, l string, kv string")
    got = df.select(F.get_json_object(E.repaired_json("j"), "$.a").alias("a"), E.first_array("l").alias("l"), E.key_values("kv").alias("m")).collect()
    assert [x["a"] for x in got] == ["1", "2", None] and got[0]["l"] == "[1, 2]" and got[0]["m"] == {"k": "2"}
    m = E.mentions(spark.createDataFrame([(1, "The tower of Pisa leans. With Rome near Pisa too.")], "id int, t string"), "id", "t").collect()
    assert sorted((x["sentence"], x["name"], x["n"]) for x in m) == [(0, "pisa", 1), (1, "pisa", 1)] or sorted((x["sentence"], x["name"]) for x in m) == [(0, "pisa"), (1, "pisa"), (1, "rome")]


def test_detected_headers(spark):
    grids = [
        ([], 0), ([["a", "b"]], 1), ([["k", "size"], ["x", "1"], ["y", "2"]], 1), ([["k", "k"], ["name", "n"], ["x", "3"]], 2),
        ([["1", "2"], ["3", "4"]], 0), ([["name", "town"], ["Ann", "Rome"], ["Bo", "Rome"]], 1), ([["a", "a"]] * 6, 3), ([["x", "y"], ["x", "y"]], 0), ([["share"], ["(1,234%)"]], 1), ([["n"], ["1d"]], 1),
    ]
    df = spark.createDataFrame([(k, g) for k, (g, _) in enumerate(grids)] + [(len(grids), None)], "k int, g array<array<string>>")
    got = {r["k"]: r["n"] for r in df.select("k", html_tables.detected_headers(F.col("g")).alias("n")).collect()}
    assert got == {k: n for k, (_, n) in enumerate(grids)} | {len(grids): 0}
