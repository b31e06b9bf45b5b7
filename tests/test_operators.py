"""Skylines and soft clusters against plain models."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from folia.operators import clustering, places, sampling, skyline, tree


def test_skyline_equals_brute_force(spark):
    r = random.Random(2)
    rows = [(k, r.choice([None, *range(12)]), r.randrange(-5, 9), r.choice([float("nan"), float("inf"), r.random(), 0.5]), "x") for k in range(400)]
    rows += [(1000 + k, a, 8 - a, 0.25, None) for k, a in enumerate([*range(9)] * 3)]  # a front that runs against itself, with ties
    whole = [x for x in rows if x[1] is not None and x[3] == x[3]]
    want = [x[0] for x in whole if not any(all(p >= q for p, q in zip(y[1:4], x[1:4])) and y[1:4] != x[1:4] for y in whole)]
    df = spark.createDataFrame(rows, "id long, a int, b long, c double, note string").repartition(3)
    for cells in (4096, 4):
        got = skyline.skyline(df, ["a", "b", "c"], cells)
        assert got.columns == df.columns and sorted(x["id"] for x in got.collect()) == sorted(want)
    assert skyline.skyline(df.limit(0), ["a", "b"]).count() == 0
    wide = spark.createDataFrame([(2**53 + k, -k) for k in range(3)] + [(2**53, -1)], "a long, b long")
    assert sorted(tuple(x) for x in skyline.skyline(wide, ["a", "b"]).collect()) == [(2**53 + k, -k) for k in range(3)]


def test_cluster_counts():
    assert clustering.cluster_counts(7) == [1] and clustering.cluster_counts(95) == list(range(1, 10))
    assert clustering.cluster_counts(2000) == list(range(1, 51)) and clustering.cluster_counts(70000) == [700, 701]
    for n in (1, 2, 9, 50):
        for best in range(1, n + 1):
            assert clustering.smallest_at(list(range(1, n + 1)), lambda k: abs(k - best)) == best


def test_soft_clusters(spark):
    r = random.Random(4)
    one = [(k, [r.gauss(0, 1) for _ in range(8)]) for k in range(300)]
    seven = [(k, [r.gauss(40 * (k % 7 == d), 1) for d in range(8)]) for k in range(420)]
    make = lambda x: clustering.soft_clusters(spark.createDataFrame(x, "id long, v array<double>"), "id", "v")
    assert {(x["cluster"], x["p"]) for x in make(one).collect()} == {(0, 1.0)}
    got = make([*seven, (999, None)]).collect()
    assert {x["id"] for x in got} == set(range(420)) and len({x["cluster"] for x in got}) > 4
    assert [x["cluster"] for x in make(seven[:5]).collect()] == [0] * 5


def test_places_and_slices(spark):
    """Places over ranges; slices of keys; shares with their residual, as in a plain list."""
    rows = [(k * 7919 % 1000, f"k{k % 37}") for k in range(1000)]
    df = spark.createDataFrame(rows, "v int, g string")
    got = {r["v"]: r["place"] for r in places.placed(df, [F.desc("v"), F.asc("g")]).collect()}
    assert got == {v: i for i, v in enumerate(sorted({v for v, _ in rows}, reverse=True))}
    sliced = {(r["g"], r["slice"]) for r in sampling.split_slices(df, "g", 4).collect()}
    keys = sorted({g for _, g in rows})
    assert sliced == {(g, i // 10 + 1) for i, g in enumerate(keys)}
    shares = {r["g"]: r["n"] for r in sampling.allocate(df.groupBy("g").agg(F.sum("v").alias("s")), "g", "s", 100, 1).collect()}
    assert sum(shares.values()) == 100


def test_front_of_a_hard_case(spark):
    """Points that none beats, with ties, infinities and a crowd at one place."""
    pts = [(float(k), float(500 - k), k) for k in range(500)] + [(float("inf"), -1.0, 900), (3.0, 497.0, 901), (3.0, 10.0, 902), (-5.0, 1e9, 903)] + [(7.5, 1.0, 1000 + k) for k in range(300)]
    df = spark.createDataFrame(pts, "a double, b double, i int")
    got = sorted(r["i"] for r in skyline.skyline_2d(df, "a", "b", 16).collect())
    want = sorted(i for a, b, i in pts if not any(x >= a and y >= b and (x > a or y > b) for x, y, _ in pts))
    assert got == want and len(want) > 500


def test_roll_up_by_levels(spark):
    rows = [(d, k, None if k == 0 else (k - 1) // 3, None if k % 5 == 0 else float(k)) for d in (1, 2) for k in range(40)]
    t = tree.with_paths(spark.createDataFrame(rows, "d int, node_id int, parent_id int, v double"), ["d"])
    got = {(r["d"], r["node_id"]): (r["n_nodes"], r["total"]) for r in tree.roll_up(t, ["d"], "v").collect()}

    def below(k):
        return [k] + [x for c in range(3 * k + 1, 3 * k + 4) if c < 40 for x in below(c)]

    for d in (1, 2):
        for k in range(40):
            v = [float(x) for x in below(k) if x % 5]
            assert got[d, k] == (len(below(k)), sum(v) if v else None)
