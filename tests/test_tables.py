"""Tables over pages and as graphs, against plain models on random grids."""

from __future__ import annotations

import random

from folia.operators import table_graph


def numeric(c):
    try:
        float("".join(x for x in c if x not in "$€£%(), \t"))
        return True
    except ValueError:
        return False


def header(g):
    if len(g) <= 1:
        return 0
    first = next((i for i, r in enumerate(g) if any(numeric(c) for c in r)), -1)
    return 1 if first <= 0 else min(first, 3)


def plain(tables):
    out, chain = [], None
    for pos, page, g, caption, foot in tables:
        goes = chain and page and page > 0 and chain["page"] == page - 1 and g and chain["last"] and max(map(len, g)) == max(map(len, chain["last"])) > 0 and not caption and not foot
        if not goes:
            chain = {"pos": pos, "grid": [list(r) for r in g or []] if g is not None else None, "head": g, "n": 0, "caption": caption, "foot": foot}
            out.append(chain)
        else:
            h = header(chain["head"])
            rows = [list(r) for r in g]
            if h and rows[:h] == [list(r) for r in chain["head"][:h]]:
                rows = rows[h:]
            if rows:
                for i, c in enumerate(rows[0]):
                    if c or not any(rows[0]):
                        break
                    if i < len(chain["grid"][-1]):
                        rows[0][i] = chain["grid"][-1][i]
                chain["grid"] += rows
        chain["page"], chain["last"], chain["n"] = page, g, chain["n"] + 1
    return {c["pos"]: (c["n"], c["page"], c["caption"], c["foot"], c["grid"]) for c in out}


def test_merged_chains(spark):
    r = random.Random(8)
    docs = {}
    for d in range(25):
        page, rows = 0, []
        for pos in range(r.randint(1, 12)):
            page += r.choice([0, 1, 1, 1, 2])
            w = r.choice([2, 2, 2, 3])
            g = [[r.choice(["", "a", "b", "7", "1,5"]) for _ in range(w)] for _ in range(r.randint(1, 4))]
            if r.random() < 0.6:
                g = [["name", "size", "more"][:w], *g]
            if r.random() < 0.06:
                g = r.choice([[], None])
            rows.append((pos * 3, page, g, r.choice(["", "", "", None, "Cap"]), r.choice(["", "", None, "note"]) if r.random() < 0.4 else ""))
        docs[d] = rows
    df = spark.createDataFrame([(d, *x) for d, v in docs.items() for x in v], "doc int, pos int, page int, grid array<array<string>>, caption string, footnote string")
    got = {}
    for x in table_graph.merge_continued(df, ["doc"]).collect():
        got.setdefault(x["doc"], {})[x["pos"]] = (x["n_parts"], x["last_page"], x["caption"], x["footnote"], None if x["grid"] is None else [list(y) for y in x["grid"]])
    assert got == {d: plain(v) for d, v in docs.items()}
    assert max(x[0] for v in got.values() for x in v.values()) >= 3


def test_table_of_three_pages(spark):
    rows = [("d", 1, 1, [["city", "size"], ["Ulm", "12"], ["Bonn", "7"]], "Cities", ""), ("d", 2, 2, [["city", "size"], ["", "8"], ["Rom", "3"]], "", ""), ("d", 3, 3, [["Oslo", "5"]], None, None)]
    df = spark.createDataFrame(rows, "doc string, pos int, page int, grid array<array<string>>, caption string, footnote string")
    one = table_graph.merge_continued(df, ["doc"]).collect()
    assert len(one) == 1 and one[0]["n_parts"] == 3 and one[0]["last_page"] == 3 and one[0]["caption"] == "Cities"
    assert one[0]["grid"] == [["city", "size"], ["Ulm", "12"], ["Bonn", "7"], ["Bonn", "8"], ["Rom", "3"], ["Oslo", "5"]]


def test_table_graph(spark):
    rows = [
        (1, [["City", "Head Count"], ["Ulm", "12"], ["  ulm ", "n/a"], ["", "City"]], "Sizes of a few old towns in the whole south", "rounded"),
        (2, [["a"]], None, None), (3, [], "", ""), (4, None, "Bare", None),
    ]
    df = spark.createDataFrame(rows, "k int, grid array<array<string>>, caption string, footnote string")
    e = table_graph.table_entities(df, "k")
    got = {k: [(x["place"], x["name"], x["type"]) for x in sorted(e.where(f"k = {k}").collect(), key=lambda x: x["place"])] for k in (1, 2, 3, 4)}
    name = "Table: Sizes of a few old towns in the..."
    assert got[1] == [(0, name, "TABLE"), (1, "city", "COLUMN"), (2, "head count", "COLUMN"), (3, "ulm", "CITY"), (4, "n/a", "HEAD_COUNT")]
    assert got[2] == [(0, "Table: Node 2...", "TABLE"), (1, "a", "COLUMN")] and got[3] == [(0, "Table: Node 3...", "TABLE")] and got[4] == [(0, "Table: Bare...", "TABLE")]
    rel = sorted((x["k"], x["src"], x["dst"], x["weight"]) for x in table_graph.table_relations(e, "k").collect())
    assert rel == [(1, name, x, 9.0) for x in ("city", "head count", "n/a", "ulm")] + [(2, "Table: Node 2...", "a", 9.0)]
    assert e.where("k = 1 and place = 0").first()["description"] == "A data table described as: Sizes of a few old towns in the whole south rounded"
    batches = sorted((x["k"], x["batch"], x["n_rows"], x["rows"]) for x in table_graph.batches_of(df, ["k"], 5).collect())
    assert batches == [(1, 0, 1, "Ulm | 12"), (1, 1, 2, "ulm | n/a\n | City")]
