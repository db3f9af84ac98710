"""Recursion, state, logs, near neighbours, communities, spectra, trees, budgets and laws: against plain Python."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from loamwork.functions import laws as X
from loamwork.operators import graph as G
from loamwork.operators import models as P
from loamwork.operators import neighbours as N
from loamwork.operators import privacy as Q
from loamwork.operators import relational as R
from loamwork.plans import catalogue
from loamwork.sources import log as L
from loamwork.streaming import events as E
from loamwork.streaming import state as Z
from pyspark.sql import functions as F


def parts(nodes, links):
    """The least node of each node's component."""
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_reached_with_cycles(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(12), rng.randrange(12)) for _ in range(18)] + [(3, 3), (None, 1), (1, None)]
    want = {}
    for s in {a for a, _ in edges if a is not None}:
        front, seen = {s}, {s: 0}
        for k in range(1, 5):
            front = {b for a, b in edges if a in front and b is not None} - set(seen)
            seen |= dict.fromkeys(front, k)
        want |= {(s, n): k for n, k in seen.items() if k}
    df = spark.createDataFrame(edges * 2, "src long, dst long")
    assert {(r["src"], r["n"]): r["hops"] for r in G.reached(df, 4).collect()} == want
    assert G.reached(df.limit(0), 3).count() == 0


def test_running_sessions_go_on_after_a_restart(spark, tmp_path):
    rng = random.Random(5)
    rows = [(e, rng.randrange(4), 1_700_000_000 + 600 * e + rng.randrange(500), rng.choice([None, 1.5, 2.0])) for e in range(300) if not 100 < e < 180]
    df = spark.createDataFrame(rows, "event_id long, user_id long, s long, value double").select("event_id", "user_id", F.timestamp_seconds("s").alias("ts"), "value")
    at = f"file://{tmp_path}"
    for k, (lo, hi) in enumerate([(0, 90), (90, 210), (210, 300)]):
        df.where(f"event_id >= {lo} and event_id < {hi}").write.mode("append").parquet(f"{at}/in")
        out = Z.drain_state(Z.running_sessions(E.event_stream(spark, f"{at}/in", 9), 3 * 3600, "1 hour"), f"{at}/out", f"{at}/check")
        assert out.count() == sum(r[0] < hi for r in rows), k
    want, state = {}, {}
    for e, u, s, v in sorted(rows, key=lambda r: (r[2], r[0])):
        last, n, total = state.get(u, (s, 0, 0.0))
        n, total = (0, 0.0) if s - last > 3 * 3600 else (n, total)
        state[u] = (s, n + 1, total + (v or 0))
        want[e] = (u, n + 1, total + (v or 0))
    assert {r["event_id"]: (r["user_id"], r["n"], r["total"]) for r in out.collect()} == want


def test_log_restart_reads_nothing_twice_and_replays(spark, tmp_path):
    at = f"file://{tmp_path}"
    rows = lambda a, b: spark.createDataFrame([(i, f"k{i % 7}" if i % 11 else None) for i in range(a, b)], "i long, k string")
    schema = rows(0, 1).schema
    read = lambda **o: E.drain(L.log_stream(spark, f"{at}/log", schema, **o), checkpoint=f"{at}/check", path=f"{at}/out")
    L.append(rows(0, 50), f"{at}/log", "k", ["i"], 3)
    assert read().count() == 50 and read().count() == 50
    L.append(rows(50, 90), f"{at}/log", "k", ["i"], 3)
    L.append(rows(90, 120), f"{at}/log", "k", ["i"], 3)
    assert read(most=1).count() == 90
    got = read(most=1).collect()
    assert sorted(r["i"] for r in got) == list(range(120)) and {r["log_segment"] for r in got} == {0, 1, 2}
    assert all(len(p) == 1 for p in _by(got, "k", "log_partition").values())
    again = E.drain(L.log_stream(spark, f"{at}/log", schema, start={0: 1, 1: 1, 2: 2}))
    assert sorted(r["i"] for r in again.collect()) == sorted(r["i"] for r in got if r["log_segment"] >= (2 if r["log_partition"] == 2 else 1))


def _by(rows, key, value):
    out = defaultdict(set)
    for r in rows:
        out[r[key]].add(r[value])
    return out


def test_split_late_adds_up(spark, tmp_path):
    at = f"file://{tmp_path}"
    base = 1_700_000_000
    for k, times in enumerate([[0, 50, 1000], [10, 400, 950, 2000, None], [1500, 1400, 2500]]):
        df = spark.createDataFrame([(10 * k + i, t and base + t) for i, t in enumerate(times)], "event_id long, s long").select("event_id", F.timestamp_seconds("s").alias("ts"))
        df.coalesce(1).write.mode("append").parquet(f"{at}/in")
        on, late = Z.split_late(E.event_stream(spark, f"{at}/in"), "500 seconds", f"{at}/split", f"{at}/check")
    assert {r["event_id"] for r in late.collect()} == {10, 11, 21}
    assert sorted(r["event_id"] for r in on.collect()) == [0, 1, 2, 12, 13, 14, 20, 22]


def near_copies(rng, n):
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    docs = []
    for _ in range(n):
        base = [rng.choice(words) for _ in range(rng.choice([3, 20, 60, 90]))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = rng.choice(words)
            docs.append(" ".join(w))
    return docs


def test_minhash_recall_and_components(spark):
    texts = near_copies(random.Random(1), 90) + ["", " \n", None, "One", "one"]
    docs = list(enumerate(texts))
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = parts(sets, links)
    got = {r["doc_id"]: r for r in N.minhash_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    found = sum(got[a]["component"] == got[b]["component"] for a, b in links)
    assert len(links) > 100 and found >= 0.9 * len(links)
    assert all(want[r["component"]] == want[i] for i, r in got.items())
    assert N.minhash_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    few = N.minhash_components(spark.createDataFrame([(5, "a b c d e f")] * 3 + [(None, "a b c d e f")], "doc_id long, text string"))
    assert [(r["n_shingles"], r["component"]) for r in few.collect()] == [(2, 5)] * 4


def brute_dbscan(rows, eps, least):
    pts = {k: p for k, *p in rows if None not in p and not any(math.isnan(v) for v in p)}
    near = {k: [j for j, q in pts.items() if (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= eps * eps] for k, p in pts.items()}
    core = {k for k in pts if len(near[k]) >= least}
    name = parts(core, [(k, j) for k in core for j in near[k] if j in core])
    return {k: (k in core, name[k] if k in core else min((name[j] for j in near.get(k, ()) if j in core), default=None)) for k, *_ in rows}


@pytest.mark.parametrize("seed", range(3))
def test_dbscan_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.gauss(c, 1.2), rng.gauss(3 * c, 1.2)) for i, c in enumerate(rng.choices([0, 3, 9], k=160))]
    rows += [(1000 + i, rng.uniform(-8, 20), rng.uniform(-8, 40)) for i in range(60)] + [(2000 + i, 5.0, 5.0) for i in range(9)] + [(3000, None, 1.0), (3001, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "k long, x double, y double")
    for eps, least in ((0.8, 4), (2.0, 9)):
        assert {r["k"]: (r["core"], r["cluster"]) for r in N.dbscan(df, "k", "x", "y", eps, least).collect()} == brute_dbscan(rows, eps, least)


def test_density_clusters_of_parts(spark, sf):
    rows = [(r["p_partkey"], r["p_retailprice"] / 10, float(r["p_size"])) for r in spark.read.parquet(f"{sf}/part.parquet").collect()]
    got = {r["p_partkey"]: (r["core"], r["cluster"]) for r in catalogue.QUERIES["density_clusters"](spark, sf).collect()}
    assert got == brute_dbscan(rows, 1.0, 4)


@pytest.mark.parametrize("blocks", [None, 1, 3, 40])
def test_kendall_against_all_pairs(spark, blocks):
    rng = random.Random(blocks)
    rows = [(rng.choice([1.0, rng.randrange(30), None]), rng.choice([2.5, rng.random()])) for _ in range(400)]
    known = [r for r in rows if r[0] is not None]
    sign = lambda v: (v > 0) - (v < 0)
    s = sum(sign(a[0] - b[0]) * sign(a[1] - b[1]) for a, b in itertools.combinations(known, 2))
    got = N.kendall(spark.createDataFrame([(None if a is None else float(a), b) for a, b in rows], "a double, b double"), "a", "b", blocks).first()["tau"]
    assert got == pytest.approx(2 * s / (len(known) * (len(known) - 1)), abs=1e-12)


def test_communities_and_modularity(spark):
    groups = [range(0, 8), range(8, 16), range(16, 24)]
    edges = [(a, b, 1.0) for g in groups for a, b in itertools.combinations(g, 2)] + [(0, 8, 0.5), (9, 17, 0.5), (4, 4, 9.0)]
    df = spark.createDataFrame(edges, "src long, dst long, weight double")
    label = G.communities(df, 6)
    got = {r["n"]: r["community"] for r in label.collect()}
    assert [len({got[n] for n in g}) for g in groups] == [1, 1, 1] and len(set(got.values())) == 3
    weight = Counter()
    for a, b, w in edges:
        if a != b:
            weight[a, b] += w
            weight[b, a] += w
    all_ = sum(weight.values())
    degree = Counter()
    for (a, _), w in weight.items():
        degree[a] += w
    want = sum(w for (a, b), w in weight.items() if got[a] == got[b]) / all_ - sum(degree[a] * degree[b] for a in got for b in got if got[a] == got[b]) / all_**2
    assert G.modularity(df, label).first()["modularity"] == pytest.approx(want)


def test_edges_are_summed_once(spark):
    """Pairs of nodes are one row whichever way their edges point, and labels from them are the same."""
    rng = random.Random(12)
    rows = [(rng.randrange(30), rng.randrange(30), float(rng.randint(1, 5))) for _ in range(200)]
    df = spark.createDataFrame(rows, "src long, dst long, weight double")
    once = G.undirected(df)
    want = {}
    for a, b, w in rows:
        if a != b:
            want[min(a, b), max(a, b)] = want.get((min(a, b), max(a, b)), 0) + w
    assert {(r["src"], r["dst"]): r["weight"] for r in once.collect()} == want
    label = G.communities(df, 4)
    assert sorted(map(tuple, G.communities(once, 4, summed=True).collect())) == sorted(map(tuple, label.collect()))
    assert G.modularity(once, label).first()["modularity"] == pytest.approx(G.modularity(df, label).first()["modularity"])


def test_baskets_are_dealt_by_size(spark, sf):
    """The pairs that one task counts hang on a number of tasks that grows with the lines, not on the planner's guess."""
    from loamwork.plans import catalogue

    assert catalogue.QUERIES["basket_lift"](spark, sf)._jdf.queryExecution().toString().count("RepartitionByExpression [a") > 0



def test_singular_values_equal_numpy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = P.term_rows(docs, 512).cache()
    dense = np.zeros((rows.count(), 512))
    for i, r in enumerate(rows.collect()):
        dense[i, r["at"]] = r["tf"]
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"].lower())) for r in docs.collect())
    assert dense.sum() == words
    values, vectors = P.singular_values(rows, 512, 5)
    want = np.linalg.svd(dense, compute_uv=False)[:5]
    assert np.allclose(values, want, rtol=1e-6) and np.allclose(np.linalg.norm(dense @ vectors, axis=0), want, rtol=1e-6)


def test_tree_grid_is_out_of_fold_and_stable(spark):
    rng = random.Random(4)
    rows = [(i, rng.random(), rng.choice([None, rng.random()]), rng.random() < 0.5) for i in range(600)]
    df = spark.createDataFrame([(i, a, b, int((a > 0.5) != flip if rng.random() < 0.1 else a > 0.5), int(flip)) for i, a, b, flip in rows], "k long, a double, b double, y int, noise int")
    got = sorted(map(tuple, P.tree_grid(df, ["a", "b"], "y", "k", 4, [1, 4], [1, 20]).collect()))
    again = sorted(map(tuple, P.tree_grid(df.repartition(7), ["a", "b"], "y", "k", 4, [1, 4], [1, 20]).collect()))
    assert [pytest.approx(g, abs=1e-9) for g in got] == again
    assert [g[:2] for g in got] == [(1, 1), (1, 20), (4, 1), (4, 20)] and all(0.85 < g[2] < 1 for g in got)
    noise = P.tree_grid(df, ["b"], "noise", "k", 4, [8], [1]).first()  # in fold a deep tree would seem to know noise
    assert abs(noise["auc"] - 0.5) < 0.12


def test_divided_clusters(spark, sf):
    got = catalogue.QUERIES["divided_clusters"](spark, sf).collect()
    assert len(got) == 6 and sum(r["n"] for r in got) == 150


def test_ledger_refuses_and_noise_follows_its_law(spark, tmp_path):
    ledger = Q.Ledger(spark, f"file://{tmp_path}/ledger", 1.0)
    df = spark.createDataFrame([(u, u % 3) for u in range(90)] + [(7, 1)] * 5000 + [(None, 1), (8, None)], "u long, k long")
    keys = spark.createDataFrame([(0,), (1,), (2,), (5,)], "k long")
    ask = lambda name, epsilon, **o: {r["k"]: r["n"] for r in Q.private_counts(df, "k", "u", 1, epsilon, ledger, keys, name, "s", **o).collect()}
    first = ask("a", 0.6)
    assert first == ask("a", 0.6) and ledger.spent() == pytest.approx(0.6) and set(first) == {0, 1, 2, 5}
    assert ask("b", 0.4) and ledger.spent() == pytest.approx(1.0)
    for name, epsilon in (("c", 0.01), ("a", 0.7)):
        with pytest.raises(Q.Overspent):
            ask(name, epsilon)
    assert Q.Ledger(spark, f"file://{tmp_path}/ledger", 1.0).spent() == pytest.approx(1.0)
    free = Q.Ledger(spark, f"file://{tmp_path}/free", 1e9)
    exact = {r["k"]: r["n"] for r in Q.private_counts(df, "k", "u", 1, 1e7, free, keys, "x", "s").collect()}
    assert exact == {0: pytest.approx(30, abs=0.01), 1: pytest.approx(30, abs=0.01), 2: pytest.approx(30, abs=0.01), 5: pytest.approx(0, abs=0.01)}
    draws = np.sort([r[0] for r in spark.range(20_000).select(Q.laplace(2.0, Q.uniform(F.col("id"), F.lit("k")))).collect()])
    law = np.where(draws < 0, 0.5 * np.exp(draws / 2), 1 - 0.5 * np.exp(-draws / 2))
    assert np.abs(law - (np.arange(20_000) + 0.5) / 20_000).max() < 1.63 / math.sqrt(20_000)


# Entries of published tables (z, t, chi-square) and exact fractions.
LAWS = lambda: [
    (X.normal_cdf(F.lit(1.959963984540054)), 0.975), (X.normal_cdf(F.lit(-2.5758293035489004)), 0.005), (X.normal_cdf(F.lit(0.0)), 0.5), (X.normal_cdf(F.lit(-9.0)), 0.0),
    (X.t_cdf(F.lit(12.706204736432095), F.lit(1.0)), 0.975), (X.t_cdf(F.lit(2.2281388519649385), F.lit(10.0)), 0.975), (X.t_cdf(F.lit(1.0), F.lit(2.0)), 0.5 + 1 / math.sqrt(12)),
    (X.chi_square_cdf(F.lit(3.841458820694124), F.lit(1.0)), 0.95), (X.chi_square_cdf(F.lit(18.307038053275146), F.lit(10.0)), 0.95), (X.chi_square_cdf(F.lit(2.0), F.lit(2.0)), 1 - math.exp(-1)), (X.chi_square_cdf(F.lit(0.0), F.lit(3.0)), 0.0),
    (X.binomial_cdf(F.lit(3.0), F.lit(10.0), F.lit(0.5)), 176 / 1024), (X.binomial_cdf(F.lit(10.0), F.lit(10.0), F.lit(0.5)), 1.0), (X.binomial_cdf(F.lit(-1.0), F.lit(10.0), F.lit(0.5)), 0.0), (X.binomial_cdf(F.lit(0.0), F.lit(5.0), F.lit(0.2)), 0.8**5),
    (X.poisson_cdf(F.lit(2.0), F.lit(3.0)), math.exp(-3) * 8.5), (X.poisson_cdf(F.lit(-1.0), F.lit(3.0)), 0.0), (X.poisson_cdf(F.lit(4.0), F.lit(0.0)), 1.0),
]


def test_laws_against_tables(spark):
    got = spark.range(1).select(*(c.alias(f"c{i}") for i, (c, _) in enumerate(LAWS()))).first()
    assert list(got) == [pytest.approx(v, abs=1e-8) for _, v in LAWS()]
    assert spark.range(1).select(X.normal_cdf(F.lit(None).cast("double")), X.t_cdf(F.lit(None).cast("double"), F.lit(3.0))).first() == (None, None)


@pytest.mark.parametrize("n", [7, 200, 1500])
def test_laws_against_sums(spark, n):
    k = spark.range(0, n + 1, max(1, n // 40)).select(F.col("id").cast("double").alias("k"))
    got = k.select("k", X.binomial_cdf(F.col("k"), F.lit(float(n)), F.lit(0.3)).alias("b"), X.poisson_cdf(F.col("k"), F.lit(n / 3)).alias("p"), X.log_gamma(F.col("k") + 0.5).alias("g")).collect()
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(0.3) + (n - i) * math.log(0.7) for i in range(n + 1)]
    rare = [-n / 3 + i * math.log(n / 3) - math.lgamma(i + 1) for i in range(n + 1)]
    for r in got:
        i = int(r["k"]) + 1
        assert r["b"] == pytest.approx(math.fsum(map(math.exp, logs[:i])), abs=1e-8) and r["p"] == pytest.approx(math.fsum(map(math.exp, rare[:i])), abs=1e-8)
        assert r["g"] == pytest.approx(math.lgamma(r["k"] + 0.5), abs=1e-9, rel=1e-12)


def test_recent_values_of_a_hot_key(spark):
    from loamwork.operators import relational as R

    rng = random.Random(8)
    rows = [(i, rng.choice(["hot", "hot", "a", None]), 1_700_000_000 + rng.randrange(40 * 86_400), rng.choice([None, 1.0, 2.0, 3.0])) for i in range(400)]
    df = spark.createDataFrame(rows, "i long, k string, s long, v double").select("i", "k", F.when(F.col("i") % 50 != 0, F.timestamp_seconds("s")).alias("ts"), "v")
    for k, ahead in ((1, False), (3, False), (2, True)):
        want = {}
        for key in {r[1] for r in rows}:
            own = sorted((r for r in rows if r[1] == key), key=lambda r: (r[0] % 50 != 0, r[2] if r[0] % 50 else 0, r[0]), reverse=ahead)
            want |= {r[0]: [x[3] for x in own[max(0, n - k) : n]] for n, r in enumerate(own)}
        got = R.with_recent(df, "k", ["ts", "i"], "v", k, ahead=ahead)
        assert got.columns == ["i", "k", "ts", "v", "recent"] and {r["i"]: r["recent"] for r in got.collect()} == want


def test_units_citations_and_definitions(spark):
    from loamwork.operators import corpus as C
    from loamwork.operators import rewrite as V

    docs = spark.createDataFrame([(1, "skip Part two: B is b, A is a. . . . 9 A"), (2, "no opening A"), (3, None), (4, "Part")], "doc_id long, text string")
    got = [(r["doc_id"], r["unit"], r["title"], r["text"]) for r in C.titled_units(docs, ["A", "B", "C"], "Part", r"( \.){2,}").orderBy("doc_id", "unit").collect()]
    assert got == [(1, 1, "B", "B is b, "), (1, 2, "A", "A is a."), (2, 1, "A", "A")]
    line = spark.createDataFrame([("Origin: x; y (z)",), ("Origin: x",), ("Other: a; b",), ("Origin: x y ; (q) ; z",)], "t string").select(C.one_citation(F.col("t"), "Origin").alias("t"))
    assert [r["t"] for r in line.collect()] == ["Origin: x (z)", "Origin: x", "Other: a; b", "Origin: x y ; (q) ; z"]
    assert V.wrap_defined(["B: no", "A: is", "more", "", "A: again", "B: x", "C: y"], ["A", "B", "C"]) == (["B: no", "::: definition", "A: is", "more", ":::", "", "A: again", "::: definition", "B: x", ":::", "::: definition", "C: y", ":::"], 3)
    x = V.defined_callouts(spark.createDataFrame([(1, "A: b", None), (2, None, ["A"])], "doc_id int, text string, terms array<string>"))
    assert [(r["text"], r["n_found"]) for r in x.orderBy("doc_id").collect()] == [("A: b", 0), (None, 0)]
    with pytest.raises(Exception, match="no value for b"):
        C.rendered(spark.createDataFrame([("x",)], "a string"), {"p": "{{a}} {{b}}"}).collect()


def word_texts(rng, n):
    common, rare = ["the", "Über", "straße", "aé", "zz", "İx"], ["".join(rng.choice("abcdeé") for _ in range(rng.choice([2, 7, 12]))) for _ in range(300)]
    return [" ".join(rng.choice(common if rng.random() < 0.5 else rare) + rng.choice(["", ",", " 12", "-"]) for _ in range(rng.choice([0, 1, 3, 40, 200]))) for _ in range(n)]


@pytest.mark.parametrize("most", [2_000_000, 60, 5])
def test_top_terms_are_those_of_tf_idf(spark, most):
    """Whether all, few or hardly any frequencies are broadcast; rows of one doc_id, also null, are one document."""
    texts = word_texts(random.Random(3), 120) + ["", None, "12 34", "a b c d e f g h", "b a"]
    rows = list(enumerate(texts)) + [(4, "the the zz"), (4, "zz new"), (None, "the q"), (None, "q r s t u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    every = R.tf_idf(docs).withColumn("tfidf", F.round("tfidf", 6)).collect()
    want = {}
    for r in sorted(every, key=lambda r: (-r["tfidf"], r["term"].encode())):
        want.setdefault(r["doc_id"], []).append((r["term"], r["tfidf"]))
    got = {}
    for r in sorted(R.top_terms(docs, 3, common=most).collect(), key=lambda r: (-r["tfidf"], r["term"].encode())):
        got.setdefault(r["doc_id"], []).append((r["term"], r["tfidf"]))
    assert got == {d: x[:3] for d, x in want.items()} and None in got
    assert R.top_terms(docs.limit(0), 3).count() == 0


def test_top_terms_query_shuffles_no_row_a_word(spark, sf):
    x = catalogue.QUERIES["tfidf_top_terms"](spark, sf)
    assert "Generate" not in x._jdf.queryExecution().executedPlan().toString()
    assert x.groupBy("doc_id").count().where("count > 3").count() == 0


def test_minhash_keeps_only_sets_that_meet_others(spark, monkeypatch):
    rng, kept, write = random.Random(2), [], N.checkpointed

    def watched(df):
        out = write(df)
        if "shingles" in out.columns:
            kept.append(out.count())
        return out

    monkeypatch.setattr(N, "checkpointed", watched)
    texts = [" ".join(str(rng.random()) for _ in range(40)) for _ in range(80)]
    texts += [texts[0] + " one more", texts[7], texts[7], "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component"]) for r in N.minhash_components(docs).collect()}
    assert got[80] == (38, 0) and got[81] == got[82] == (36, 7) and got[83] == (0, 83) and got[84] == (0, 84)
    assert sum(kept) == 2


def test_minhash_when_more_meet_than_are_broadcast(spark):
    docs = spark.createDataFrame(list(enumerate(near_copies(random.Random(4), 30) + ["", None])), "doc_id long, text string").repartition(3)
    few, many = (sorted(map(tuple, N.minhash_components(docs, most=most).collect())) for most in (5_000_000, 0))
    assert few == many


def test_minhash_sketches_pass_over_no_link(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(4000)]
    base = rng.sample(words, 300)
    texts = [" ".join(rng.choice(words) if rng.random() < p else w for w in base) for p in (0, 0.01, 0.02, 0.03, 0.05, 0.1, 0.3) for _ in range(3)]
    texts += [" ".join(t.split()[: len(t.split()) * 4 // 5]) for t in texts[:4]] + ["one"]
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in (t.split() for t in dict.fromkeys(texts))]
    rows = N._sets(spark.createDataFrame(list(enumerate(dict.fromkeys(texts))), "doc_id long, text string").coalesce(1), 5, None)
    h = [r["h"] for r in rows.collect()]
    pairs = list(itertools.combinations(range(len(h)), 2))
    left = N._may_link(spark.createDataFrame([(h[i], h[k]) for i, k in pairs], "a long, b long"), rows, 75).collect()
    left = {(r["a"], r["b"]) for r in left}
    like = {(h[i], h[k]) for i, k in pairs if 100 * len(sets[i] & sets[k]) >= 75 * len(sets[i] | sets[k])}
    half = {(h[i], h[k]) for i, k in pairs if 100 * len(sets[i] & sets[k]) < 50 * len(sets[i] | sets[k])}
    assert like and like <= left and half and not half & left
