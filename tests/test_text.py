"""Scalar functions and the survey's worked numbers, on invented text."""

import random

import pytest
from loamwork.functions import text as T
from loamwork.operators import corpus as C
from loamwork.operators import relational as R
from pyspark.sql import functions as F


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first()["x"] if values else spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text, want", [("　a­b \t c　", "ab c"), ("", ""), ("   ", ""), ("x", "x")])
def test_norm_line(spark, text, want):
    assert one(spark, T.norm_line(F.col("t")), t=text) == want


def test_nulls_stay_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    for f in (T.ustrip, T.norm_line, T.norm_layout, T.norm_integrity, T.display_width, T.cjk_spacing, T.slug, T.strip_tags, T.mask_pii, T.truncate):
        assert df.select(f(F.col("t")).alias("x")).first()["x"] is None


def test_functions(spark):
    assert one(spark, T.display_width(F.col("t")), t="ab中文") == 6
    assert one(spark, T.cjk_spacing(F.col("t")), t="中a1文") == "中\u200aa1\u200a文"
    assert one(spark, T.join_lines(F.col("a"), F.col("b")), a="one", b="two") == "one two"
    assert one(spark, T.join_lines(F.col("a"), F.col("b")), a="中", b="文") == "中文"
    assert one(spark, T.full_to_half(F.col("t")), t="ＡＤ") == "AD"
    assert one(spark, T.hyphens(F.col("t")), t="a‑b–c") == "a-b-c"
    assert one(spark, T.strip_tags(F.col("t")), t="<p>a &amp;lt; b</p>") == "a &lt; b"
    assert one(spark, T.slug(F.col("t")), t=" a, b! ") == "a_b"
    assert one(spark, T.norm_layout(F.col("t")), t="a\tb  ") == "a    b"
    assert one(spark, T.shingles(F.split("t", " "), 2), t="a b c") == ["a b", "b c"]
    assert one(spark, T.shingles(F.split("t", " "), 4), t="a b c") == []


def test_worked_numbers(spark):
    assert one(spark, T.npv(F.array(F.lit(-100.0), F.lit(110.0)), 0.1)) == pytest.approx(0)
    assert one(spark, T.iou([F.lit(v) for v in (0.0, 0.0, 2.0, 2.0)], [F.lit(v) for v in (1.0, 0.0, 3.0, 2.0)])) == pytest.approx(1 / 3)
    r = R.fences(spark.createDataFrame([(float(v),) for v in (20, 20, 20, 40, 40)], "x double"), "x").first()
    assert (r["lo"], r["hi"]) == (-10, 70)
    assert one(spark, F.bround(F.lit(2.5))) == 2.0


def test_auc_ties_and_nothing(spark):
    x = spark.createDataFrame([(1.0, 0), (1.0, 1), (2.0, 1)], "s double, y int")
    assert R.auc(x, "s", "y").first()["auc"] == pytest.approx(0.75)
    assert R.auc(x.where("y = 1"), "s", "y").first()["auc"] is None


def test_asof_ties_and_misses(spark):
    a = spark.createDataFrame([(1, 5, 1), (2, 1, 1), (3, 5, 2)], "event_id int, ts int, u int")
    b = spark.createDataFrame([(10, 5, 1), (11, 5, 1), (12, 4, 1)], "pid int, ts int, u int")
    got = {r["event_id"]: r["asof_pid"] for r in R.asof(a, b, "u", "ts", "pid", ["pid"]).collect()}
    assert got == {1: 11, 2: None, 3: None}


def test_asof_against_brute_force(spark):
    rng = random.Random(6)
    some = lambda top: None if rng.random() < 0.05 else rng.randrange(top)
    a = [(i, some(400), some(3) if i % 3 else 0) for i in range(150)]
    b = [(1000 + i, some(400), some(3) if i % 3 else 0) for i in range(60)]
    want = {}
    for i, ts, u in a:
        fits = [(t, p) for p, t, v in b if None not in (ts, u, t, v) and v == u and t <= ts]
        want[i] = max(fits)[1] if fits else None
    x, y = spark.createDataFrame(a, "event_id int, ts int, u int"), spark.createDataFrame(b, "pid int, ts int, u int")
    for width in (7, 100_000):
        assert {r["event_id"]: r["asof_pid"] for r in R.asof(x, y, "u", "ts", "pid", ["pid"], width=width).collect()} == want
    at = lambda df: df.withColumn("ts", F.timestamp_seconds(F.col("ts") * 7200))
    assert {r["event_id"]: r["asof_pid"] for r in R.asof(at(x), at(y), "u", "ts", "pid", ["pid"]).collect()} == want
    assert R.asof(x, y.limit(0), "u", "ts", "pid", ["pid"]).where("asof_pid is null").count() == len(a)
    assert R.asof(x.limit(0), y, "u", "ts", "pid", ["pid"]).count() == 0


def test_multiset_difference_saturates(spark):
    a, b = spark.createDataFrame([("x",), ("x",), ("y",)], "k string"), spark.createDataFrame([("x",), ("y",), ("y",), ("z",)], "k string")
    assert {r["k"]: r["n"] for r in C.multiset_diff(a, b, "k").collect()} == {"x": 1}
    assert {r["k"]: r["n"] for r in C.multiset_diff(b, a, "k").collect()} == {"y": 1, "z": 1}


def test_anchor_is_strictly_before(spark):
    x = spark.createDataFrame([(1, 1, None), (1, 2, 7), (1, 3, None)], "d int, n int, v int")
    got = [r["a"] for r in C.fill_forward(x, "d", "n", F.col("v"), "a", before=True).orderBy("n").collect()]
    assert got == [None, None, 7]


def test_salted_sum_equals_plain(spark):
    x = spark.range(1000).select((F.col("id") % 3).alias("k"), "id", F.lit(1.0).alias("v"))
    got = {r["k"]: (r["n"], r["total"]) for r in R.salted_sum(x, "k", "v", "id").collect()}
    assert got == {0: (334, 334.0), 1: (333, 333.0), 2: (333, 333.0)}
