"""Trees of summaries, prompts, answers and ordered merges against plain models."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from folia.operators import answers, merging, summaries


def cut(t, n):
    return " ".join((t or "").split()[:n])


def test_tree_summaries(spark):
    """Random trees with blank nodes and one node of very many children, in two documents."""
    r = random.Random(2)
    rows = []
    for doc in (1, 2):
        for k in range(160):
            parent = None if k == 0 else (0 if r.random() < 0.6 else r.randrange(k))
            depth = 0 if parent is None else next(x[3] for x in rows if x[0] == doc and x[1] == parent) + 1
            words = r.choice([None, "", " \n", "one", "a b c", " ".join(f"w{r.randrange(9)}" for _ in range(r.choice([4, 12, 30])))])
            rows.append((doc, k, parent, depth, r.choice(["text", "table", "odd", None]), words))
    df = spark.createDataFrame(rows, "doc int, node_id int, parent_id int, depth int, kind string, content string")
    got = {(x["doc"], x["node_id"]): x for x in summaries.tree_summaries(df, ["doc"], budget=20, summarize=summaries.first_words(7)).collect()}
    assert len(got) == len(rows)
    below, made = defaultdict(list), {}
    for doc, node, parent, depth, kind, content in sorted(rows, key=lambda x: (-x[3], x[0], x[1])):
        lines = sorted(below[doc, node])
        text, own = "\n".join(x for _, x in lines), content or ""
        room = 20 - len(own.split())
        if room <= 0:
            prompt = cut(own, 20)
        else:
            rest = text if len(text.split()) <= room else cut(text, room)
            prompt = "\n".join(x for x in (own, rest) if x)
        summary = cut(prompt, 7)
        made[doc, node] = (depth, len(lines), len(prompt.split()), summary)
        if summary and parent is not None:
            below[doc, parent].append((node, {"text": "Text: ", "table": "Table: "}.get(kind, "") + summary))
    assert {k: tuple(x)[2:] for k, x in got.items()} == made


def test_cluster_summary_tree(spark):
    """Clusters that overlap, by numbers in the texts; levels, links and texts against a loop."""
    r = random.Random(4)
    texts = {k: " ".join(f"t{r.randrange(60)}" for _ in range(r.choice([1, 5, 40]))) for k in range(300)} | {300: "", 301: None}
    of = lambda i, t: {i // 3 % 1000, (i + 7) // 4 % 1000} if (t or "").strip() else set()

    def cluster(t):
        ids = F.when(F.length(F.trim(F.coalesce("text", F.lit("")))) > 0, F.array((F.floor(F.col("chunk_id") / 3) % 1000), (F.floor((F.col("chunk_id") + 7) / 4) % 1000))).otherwise(F.array().cast("array<long>"))
        return t.select("chunk_id", F.explode(F.array_distinct(ids)).alias("cluster"))

    df = spark.createDataFrame(list(texts.items()), "chunk_id long, text string")
    levels, links = summaries.cluster_summary_tree(df, cluster, few=5, budget=50, summarize=summaries.first_words(20))
    here, want, arcs, level, top = dict(texts), {(0, k, t) for k, t in texts.items()}, set(), 0, max(texts)
    while len(here) > 5:
        groups = defaultdict(list)
        for i, t in sorted(here.items()):
            for c in of(i, t):
                groups[c].append(i)
        if not groups or len(groups) >= len(here):
            break
        level += 1
        new = {}
        for n, c in enumerate(sorted(groups), 1):
            new[top + n] = cut("\n".join(here[i] for i in groups[c]), 20)
            arcs |= {(level, top + n, i) for i in groups[c]}
        top += len(groups)
        here = new
        want |= {(level, k, t) for k, t in new.items()}
    assert level >= 2
    assert {tuple(x) for x in levels.collect()} == want and {tuple(x) for x in links.collect()} == arcs
    assert summaries.cluster_summary_tree(df.limit(0), cluster)[0].count() == 0


def plain_packs(items, budget):
    """Chunks of written items, long ones cut first."""
    out = []
    for kind, page, content in items:
        form = lambda c: f"Type: {kind or 'text'} in Page: {-1 if page is None else page}\nContent: {c}\n"  # noqa: B023, E731
        whole, w = form(content or ""), (content or "").split()
        out += [whole] if len(whole.split()) <= budget else [form(" ".join(w[i : i + budget])) for i in range(0, max(len(w), 1), budget)]
    packs, held = [], 0
    for t in out:
        n = len(t.split())
        if packs and held + n <= budget:
            packs[-1].append(t)
            held += n
        else:
            packs.append([t])
            held = n
    return packs


@pytest.mark.parametrize("budget", [9, 25])
def test_pack_prompts(spark, budget):
    r = random.Random(budget)
    items = {q: [(r.choice(["table", None, "text"]), r.choice([None, 3]), r.choice([None, "", " ".join(f"w{i}" for i in range(r.choice([1, 4, 24, 60])))])) for _ in range(r.randint(1, 9))] for q in range(12)}
    df = spark.createDataFrame([(q, k, *x) for q, v in items.items() for k, x in enumerate(v)], "q int, k int, type string, page int, content string")
    got = defaultdict(dict)
    for x in answers.pack_prompts(df.repartition(5), "q", "k", budget).collect():
        got[x["q"]][x["chunk"]] = (x["n_items"], x["n_words"], x["text"])
    for q, v in items.items():
        packs = plain_packs(v, budget)
        assert got[q] == {k: (len(p), sum(len(t.split()) for t in p), answers.SEPARATOR.join(p)) for k, p in enumerate(packs)}
        assert all(len(p) == 1 or sum(len(t.split()) for t in p) <= budget for p in packs)


def plain_sentence(question, text):
    import re

    q, best = set(question.lower().split()), (-1, "")
    for line in text.split("\n"):
        for s in re.split(r"(?<=[.!?])\s+", line):
            if s.split() and len(q & set(s.lower().split())) > best[0]:
                best = (len(q & set(s.lower().split())), s)
    return best[1]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 9, 40])
def test_reduce_answers(spark, n):
    """Rounds go on until one answer is left, whatever the layout of the rows."""
    r = random.Random(n)
    partials = [" ".join(r.choice("what is the red cat doing. here now! and then".split()) for _ in range(r.randint(0, 14))) for _ in range(n)]
    question, budget = "what is the Red cat", 30
    df = spark.createDataFrame([(5, k, f"Text Chunk {k + 1}", t) for k, t in enumerate(partials)], "q int, k int, source string, content string").withColumn("place", F.struct(F.lit(0).alias("kind"), F.col("k").cast("long").alias("at")))
    asked = spark.createDataFrame([(5, question), (6, "other")], "q int, text string")
    here, rounds = [(f"Text Chunk {k + 1}", t) for k, t in enumerate(partials)], 0
    while len(here) > 1:
        groups: list[list[str]] = []
        for source, t in here:
            form = f"### Analysis from {source}\n{t}\n---"
            if groups and (len(groups[-1]) < 2 or sum(len(x.split()) for x in groups[-1]) + len(form.split()) <= budget):
                groups[-1].append(form)
            else:
                groups.append([form])
        if len(groups) > 1 and len(groups[-1]) == 1:
            groups[-2] += groups.pop()
        here = [(f"Text Chunk {k + 1}", plain_sentence(question, "\n".join(g))) for k, g in enumerate(groups)]
        rounds += 1
    want = here[0][1] if here else answers.NOTHING
    for layout in (df, df.repartition(4, "k")):
        got = {x["q"]: tuple(x)[1:] for x in answers.reduce_answers(asked, layout, "q", "text", budget).collect()}
        assert got == {5: (want, n, rounds), 6: (answers.NOTHING, 0, 0)}


def test_partials_of_images_and_steps(spark):
    asked = spark.createDataFrame([(1, "red cat")], "q int, text string")
    evidence = spark.createDataFrame([(1, 0, "text", 0, "A dog. The red cat sits."), (1, 1, "image", 4, "a red cat on a mat"), (1, 2, "image", 5, "no path")], "q int, order int, type string, page int, content string")
    text, images = answers.split_evidence(evidence)
    images = images.withColumn("img_path", F.when(F.col("page") == 5, "x.png"))
    got = answers.partial_answers(asked, answers.pack_prompts(text, "q", "order", 50), images, "q", "text").collect()
    assert sorted((x["place"]["kind"], x["source"], x["content"]) for x in got) == [(0, "Text Chunk 1", "The red cat sits."), (1, "Image 1", "An image in Page: 5, Caption: a red cat on a mat")]
    steps = spark.createDataFrame([(1, 0, "which cat?", "the red cat"), (1, 1, "where?", "on a mat")], "q int, step int, question string, answer string")
    assert answers.complex_answers(asked, steps, "q", "text", 100).first()["answer"] == "the red cat"
    assert answers.complex_answers(asked, steps.limit(0), "q", "text", 100).first()["answer"] == answers.NOTHING_COMPLEX


def replay(entities, merges):
    """Merges one after the other: what names stand for, and which entities are one."""
    up, names, stands, made_last = {}, dict(entities), {n: i for i, n in entities}, {}

    def find(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for seq, old, new, name in sorted(merges):
        node = -1 - seq
        take = {find(stands[x]) for x in (old, new) if x in stands}
        # the last merge that had the name made it, or no merge had it
        if name in stands and made_last.get(name, name) == name:
            take.add(find(stands[name]))
        for t in take:
            up[t] = node
        names[node] = name
        for x in (old, new, name):
            stands[x], made_last[x] = node, name
    groups = defaultdict(list)
    for i, _ in entities:
        groups[find(i)].append(i)
    return {(i, min(v), names[g]) for g, v in groups.items() for i in v}


@pytest.mark.parametrize("seed", range(4))
def test_merges_equal_a_replay(spark, seed):
    """Chains, third parties, names that were given up and taken again, unknown names."""
    r = random.Random(seed)
    entities = [(k, f"n{k}") for k in range(60)]
    merges = [(s, *(f"n{r.randrange(75)}" for _ in range(3))) for s in r.sample(range(30_000), 25 + 5 * seed)]
    merges += [(50_000, "n1", "n2", "fresh"), (50_001, "fresh", "n3", "n1"), (50_002, "n4", "n4", "n4"), (50_003, "gone", "lost", "made")]
    e = spark.createDataFrame(entities, "id long, name string")
    m = spark.createDataFrame(merges, "seq long, old string, new string, name string")
    got = merging.merged_entities(e, m)
    assert {tuple(x) for x in got.collect()} == replay(entities, merges)
    text = {x["canonical"]: x["description"] for x in merging.merged_descriptions(e.withColumn("description", F.concat(F.lit("about "), "name")), got, most_words=5).collect()}
    for c in {x[1] for x in replay(entities, merges)}:
        ids = sorted(x[0] for x in replay(entities, merges) if x[1] == c)
        assert text[c] == cut("<SEP>".join(f"about n{i}" for i in ids), 5)


def test_renamed_ends(spark):
    e = spark.createDataFrame([(1, 2, 1.0), (2, 3, 2.0), (3, 1, 4.0), (1, 9, 8.0)], "a long, b long, weight double")
    merged = spark.createDataFrame([(1, 1, "x"), (2, 1, "x"), (3, 3, "y")], "id long, canonical long, name string")
    assert [tuple(x) for x in merging.renamed_ends(e, merged).collect()] == [(1, 3, 6.0)]


def test_row_before_by_blocks(spark):
    rows = [(f"k{k % 3}" if k % 2 else "hot", k * 7, k) for k in range(400)]
    got = merging.last_before(spark.createDataFrame(rows, "key string, at long, v int"), "key", "at", "v", block=50).collect()
    last, want = {}, {}
    for key, at, v in sorted(rows, key=lambda x: x[1]):
        want[v] = last.get(key)
        last[key] = v
    assert {x["v"]: x["previous"] for x in got} == want
