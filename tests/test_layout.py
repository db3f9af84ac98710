"""Layout operators, models and shared helpers on small fixtures."""

import math

import pytest
from loamwork.functions import text as T
from loamwork.operators import corpus as C
from loamwork.operators import graph as G
from loamwork.operators import layout as L
from loamwork.operators import measures as M
from loamwork.operators import models as P
from loamwork.operators import relational as R
from loamwork.plans import catalogue
from loamwork.sources import files as D
from pyspark.sql import functions as F


def lines(spark, text):
    return spark.createDataFrame([(1, i + 1, x) for i, x in enumerate(text.split("\n"))], "doc_id long, line_no int, line string")


def test_classes(spark):
    want = ["heading", "badge", "choice", "verdict", "list", "fact", "comment", "quote", "callout", "fence", "table", "table", "blank", "entry", "field", "text"]
    x = lines(spark, "# A\n**Deep dive**\n(A) b\nAnswer: C\n12. x\nFrom: y\n<!-- z -->\n> q\n::: w\n```py\n| a |\n---|---\n  \nDeck DK-4\nOrigins\nplain")
    assert [r["c"] for r in x.orderBy("line_no").select(L.line_class(F.col("line")).alias("c")).collect()] == want


def test_merging_rules(spark):
    wide = "word " * 17
    x = lines(spark, f"{wide}:\nnext\nshort\nend, but\nshort,\nwent on.\nnew {wide}\n(A) option\nstem\nWhich of these?")
    got = [r["joins"] for r in L.merges(x).orderBy("line_no").collect()]
    assert got == [True, False, False, False, True, False, False, False, True, False]


def test_table_caps(spark):
    rows = ["a  b"] + ["x"] * 3 + ["c  d"] + ["x", "x", "e  f"] * 7
    got = [(r["first"], r["n_lines"], r["n_absorbed"]) for r in L.table_blocks(lines(spark, "\n".join(rows))).orderBy("first").collect()]
    # two singles in a row, then a break; twelve in all, then a break
    assert got == [(1, 3, 2), (5, 19, 12), (26, 1, 0)]


def test_long_lines(spark):
    plain, columns, dots = "word " * 30_000, "word  " * 500, ". " * 30_000
    x = lines(spark, f"{plain}\n{columns}\n{dots}")
    got = x.orderBy("line_no").select(F.size(L.segments(F.col("line"))).alias("n"), L.dot_leader(F.col("line")).alias("d"), F.element_at(L.segments(F.col("line")), -1)["first"].alias("last")).collect()
    assert [(r["n"], r["d"], r["last"]) for r in got] == [(1, False, 0), (500, False, 6 * 499), (1, True, 0)]
    assert [(r["first"], r["n_lines"], r["n_absorbed"]) for r in L.table_blocks(x).collect()] == [(2, 1, 0)]


def test_own_style(spark):
    own = L.Style(badges=("Hot (new) one",), asks="Now what")
    x = lines(spark, "Hot (new) one\nBasics\nstem\nNow what is it?")
    assert [r["joins"] for r in L.merges(x, own).orderBy("line_no").collect()] == [False, False, True, False]
    assert [r["kind"] for r in L.residuals(x, own).orderBy("line_no").collect()] == ["badge", "text", "text"]


def test_inline_code(spark):
    x = L.inline_code(lines(spark, "`df.x` df.yy and $df.zz$ {{df.ww}} df.drop_rows() axis = 1 my_name, e.g. this\nnone\n`all.code`"))
    r = x.first()
    assert x.count() == 1 and r["line"] == "`df.x` `df.yy` and $df.zz$ {{df.ww}} `df.drop_rows()` `axis = 1` `my_name`, e.g. this"
    assert [t["kind"] for t in r["tokens"]] == ["path", "call", "setting", "name"]


def test_first_difference(spark):
    rows = [("abc", "abd", 2), ("ab", "abc", 2), ("", "x", 0), ("same", "same", None), (None, "x", None)]
    x = spark.createDataFrame(rows, "a string, b string, w int").select("w", T.first_difference(F.col("a"), F.col("b")).alias("g"))
    assert all(r["w"] == r["g"] for r in x.collect())


def test_spacing_skips_tags(spark):
    x = spark.createDataFrame([("中a<b>中</b>1",)], "t string").select(T.cjk_spacing(F.col("t")).alias("t"))
    assert x.first()["t"] == "中 a<b>中</b>1"


def test_quantiles_against_sorted(spark):
    v = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, None]
    got = M.exact_quantiles(spark.createDataFrame([(x,) for x in v], "v double"), "v", [0.0, 0.3, 0.5, 1.0], ["a", "b", "c", "d"]).first()
    s = sorted(x for x in v if x is not None)
    q = lambda p: s[int(p * 6)] + (p * 6 - int(p * 6)) * (s[min(6, int(p * 6) + 1)] - s[int(p * 6)])
    assert list(got) == pytest.approx([q(p) for p in (0.0, 0.3, 0.5, 1.0)])
    assert list(M.exact_quantiles(spark.createDataFrame([], "v double"), "v", [0.5], ["a"]).first()) == [None]


def test_ntiles_of_a_hot_part(spark):
    rows = [("h", i) for i in range(103)] + [("k", i) for i in range(3)] + [(None, 1)]
    got = R.ntiles(spark.createDataFrame(rows, "p string, o int"), "p", ["o"], 4).collect()
    tiles = {}
    for r in got:
        tiles.setdefault(r["p"], []).append((r["o"], r["tile"]))
    assert [sum(t == k for _, t in tiles["h"]) for k in (1, 2, 3, 4)] == [26, 26, 26, 25]
    assert all(a <= b for (_, a), (_, b) in zip(sorted(tiles["h"]), sorted(tiles["h"])[1:]))
    assert sorted(tiles["k"]) == [(0, 1), (1, 2), (2, 3)] and tiles[None] == [(1, 1)]


def test_nearest_in_blocks(spark):
    rows = [(i, [math.cos(i), math.sin(i), 0.1 * i]) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, e array<double>")
    got = {(r["q"], r["r"]): r["v"] for r in R.nearest(df, df.where("k % 10 = 0"), "k", "e", 3, blocks=3).collect()}
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    for q, e in rows[::10]:
        best = sorted((-round(cos(e, f), 6), v) for v, f in rows if v != q)[:3]
        assert [got[q, i + 1] for i in range(3)] == [v for _, v in best]


def test_bootstrap_draws_in_compiled_code(spark):
    df = spark.range(500).selectExpr("id", "id % 7 as v")
    out = P.bootstrap_mean(df, "v", "id", 50)
    assert "lambdafunction" not in out._jdf.queryExecution().optimizedPlan().toString()
    r = out.first()
    assert r["lo"] < r["mean"] < r["hi"] and r["hi"] - r["lo"] < 0.6


def test_nearest_of_copies_nulls_and_names(spark):
    rows = [(f"r{i:05}", [1.0, 2.0]) for i in range(6_000)] + [("b", [2.0, 1.0]), ("n", None), (None, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "k string, e array<double>").repartition(3)
    got = sorted(map(tuple, R.nearest(df, df.where("k in ('r00000', 'b', 'n') or k is null"), "k", "e", 2).collect()), key=str)
    assert got == [("b", "r00000", 0.8, 1), ("b", "r00001", 0.8, 2), ("n", "b", None, 1), ("n", "r00000", None, 2), ("r00000", "r00001", 1.0, 1), ("r00000", "r00002", 1.0, 2)]
    few = spark.createDataFrame([(1, [1.0]), (2, None), (3, [-1.0])], "k int, e array<double>")
    assert [tuple(r) for r in R.nearest(few, few.where("k = 1"), "k", "e", 5).collect()] == [(1, 3, -1.0, 1), (1, 2, None, 2)]
    assert R.nearest(few, few.where("k = 9"), "k", "e", 5).isEmpty()


def test_bucketed_join_exchanges_nothing(spark):
    a, b = spark.range(50).withColumnRenamed("id", "test_ka"), spark.range(30).withColumnRenamed("id", "test_kb")
    x = R.bucketed_join(a, "test_ka", b, "test_kb", 3)
    assert x.count() == 30 and "Exchange" not in x._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    for n in ("loamwork_by_test_ka", "loamwork_by_test_kb"):
        spark.sql(f"drop table {n}")


def test_graph_rounds(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (7, 8), (9, 8)], "src int, dst int")
    assert {r["n"]: r["hops"] for r in G.hops(e, spark.createDataFrame([(1,)], "n int"), 9).collect()} == {1: 0, 2: 1, 3: 2, 4: 3}
    assert {r["n"]: r["component"] for r in G.connected(e).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7, 9: 7}
    assert G.connected(e.limit(0)).count() == 0


def test_raises(spark):
    rows = spark.createDataFrame([(["Kind: a", "Odd: b"],)], "r array<string>")
    with pytest.raises(Exception, match="unknown row"):
        rows.select(C.card_table(F.col("r"), ["Kind"])).collect()


def test_markdown_pads(spark):
    rows = spark.createDataFrame([(1, 1, ["a", "b|c"]), (1, 2, ["d"])], "k int, o int, cells array<string>")
    assert D.markdown_table(rows, "k", "o").first()["table"] == "| a | b\\|c |\n|---|---|\n| d |  |"


def test_models(spark, sf):
    sizes = catalogue.QUERIES["kmeans_sizes"](spark, sf).collect()
    assert len(sizes) == 4 and sum(r["n"] for r in sizes) == spark.read.parquet(f"{sf}/customer.parquet").count()
    assert 0.5 <= catalogue.QUERIES["logistic_cv"](spark, sf).first()["auc"] <= 1
    r = catalogue.QUERIES["bootstrap_interval"](spark, sf).first()
    assert r["lo"] < r["mean"] < r["hi"] < r["mean"] * 1.2
    true = {x["event_type"]: x["count"] for x in spark.read.parquet(f"{sf}/events.parquet").groupBy("event_type").count().collect()}
    noisy = catalogue.QUERIES["private_counts"](spark, sf).collect()
    assert all(0 < abs(x["n"] - true[x["event_type"]]) < 60 for x in noisy)


def test_udtf_groups(spark):
    P.register(spark)
    got = spark.sql("select * from find_all('a1 b22', '([a-z])([0-9]+)')").collect()
    assert [(r["first"], r["past"], r["found"], r["groups"]) for r in got] == [(0, 2, "a1", ["a", "1"]), (3, 6, "b22", ["b", "22"])]
    assert spark.sql("select * from find_all(cast(null as string), 'x')").count() == 0
