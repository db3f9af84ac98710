"""Graph operators, running totals, ranks and set functions against plain Python."""

import random
from collections import Counter

import pytest
from loamwork.functions import text as T
from loamwork.operators import graph as G
from loamwork.operators import relational as R
from pyspark.sql import functions as F


def brute(edges, rounds, d=0.85):
    nodes = sorted({x for e in edges for x in e})
    out = Counter(a for a, _ in edges)
    rank = {n: 1 / len(nodes) for n in nodes}
    for _ in range(rounds):
        lost = sum(rank[n] for n in nodes if not out[n])
        new = {n: (1 - d) / len(nodes) + d * lost / len(nodes) for n in nodes}
        for a, b in edges:
            new[b] += d * rank[a] / out[a]
        rank = new
    return rank


def test_pagerank_and_degrees(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(12), rng.randrange(12)) for _ in range(40)] + [(3, 20), (3, 20)]
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r["n"]: r["rank"] for r in G.pagerank(df, 6).collect()}
    assert got == {n: pytest.approx(v, abs=1e-12) for n, v in brute(edges, 6).items()}
    assert sum(got.values()) == pytest.approx(1)
    degree = {r["n"]: (r["out_degree"], r["in_degree"]) for r in G.degrees(df).collect()}
    assert degree[20] == (0, 2) and sum(o for o, _ in degree.values()) == len(edges)
    assert G.pagerank(df.limit(0), 2).count() == 0


def test_jaccard_and_box_cox(spark):
    df = spark.createDataFrame([(["a", "b", "b"], ["b", "c"], 4.0), ([], [], 0.0), (None, ["x"], None)], "a array<string>, b array<string>, x double")
    a, b, c = df.select(T.jaccard(F.col("a"), F.col("b")).alias("j"), T.box_cox(F.col("x"), 0.5).alias("p"), T.box_cox(F.col("x"), 0).alias("l")).collect()
    assert a["j"] == pytest.approx(1 / 3) and a["p"] == pytest.approx(2) and a["l"] == pytest.approx(1.3862943611)
    assert b["j"] is None and b["p"] is None and c["j"] is None and c["p"] is None


def test_running_total_and_ranks(spark):
    rows = random.Random(8).sample(range(10_000), 500)
    df = spark.createDataFrame([(k, k % 7, k % 3) for k in rows], "k long, v long, w long").repartition(5)
    got = {r["k"]: (r["upto_v"], r["upto_w"]) for r in R.running_total(df, "k", ["v", "w"]).collect()}
    v = w = 0
    for k in sorted(rows):
        v, w = v + k % 7, w + k % 3
        assert got[k] == (v, w)
    assert R.running_total(df.limit(0), "k", ["v"]).count() == 0
    x = spark.createDataFrame([(3.0, 1), (3.0, 0), (1.0, 0), (None, 1)], "s double, y int")
    assert sorted((r["s"], r["rank"]) for r in R.mean_rank(x, "s").collect()) == [(1.0, 1.0), (3.0, 2.5), (3.0, 2.5)]
    assert R.auc(x, "s", "y").first()["auc"] == 0.75
