"""Expansion and rewriting on invented lines."""

import pytest
from loamwork.operators import corpus as C
from loamwork.operators import neighbours as N
from loamwork.operators import rewrite as V
from pyspark.sql import functions as F


def lines(spark, *texts):
    return C.lines(spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string"))


def test_includes(spark):
    files = spark.createDataFrame([("a", "one\n<!-- include: b -->")], "name string, text string")
    got = V.expand_includes(lines(spark, "x\n<!-- include: a -->\ny"), files).orderBy("line_no", "sub_no")
    assert [r["line"] for r in got.collect()] == ["x", "one", "<!-- include: b -->", "y"]
    with pytest.raises(Exception, match="missing include"):
        V.expand_includes(lines(spark, "<!-- include: zz -->"), files).collect()


def test_titles_look_ahead(spark):
    x = lines(spark, "Chapter 1\nlong, with stops\nShort\nz", "Chapter 2\nChapter 3", "Chapter 4\n\nLate")
    got = {(r["doc_id"], r["line"]): r["title"] for r in V.title_after(x, F.col("line").startswith("Chapter")).collect()}
    assert got == {(1, "Chapter 1"): "Short", (2, "Chapter 2"): None, (2, "Chapter 3"): None, (3, "Chapter 4"): "Late"}


def test_repeated_headings_go(spark):
    got = V.drop_repeated_headings(lines(spark, "# a\n\n# a\nx\n# a")).orderBy("line_no").collect()
    assert [r["line"] for r in got] == ["", "# a", "x", "# a"]


def test_folding_and_breaks(spark):
    x = V.best_prefix(lines(spark, "k1 a\nmore\nk10 b"), ["k1", "k10"])
    assert [(r["label"], r["text"]) for r in V.fold_labelled(x, F.col("label")).orderBy("row").collect()] == [("k1", "k1 a more"), ("k10", "k10 b")]
    assert V.paragraph_breaks(lines(spark, "One.\nTwo.\nthree")).count() == 4


def test_rewrites(spark):
    assert V.tidy_parentheses("f( x * y ) and ( ( z ) )") == "f(x*y) and ((z))"
    assert V.wrap_callouts(["a", "Note: b", "c", "", "d"]) == ["a", "::: callout", "Note: b", "c", ":::", "", "d"]
    docs = spark.createDataFrame([(1, "Tip x"), (2, None)], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in V.rewrite_documents(docs).collect()} == {1: "::: callout\nTip x\n:::", 2: None}
    got = V.replace_all(docs, [("t", "T", "t"), ("q", "q", "")]).orderBy("doc_id").collect()
    assert (got[0]["text"], got[0]["log"], got[1]["text"]) == ("tip x", ["t"], None)


def test_kendall_and_adjusted(spark):
    x = spark.createDataFrame([(1, 1), (2, 3), (3, 2)], "a int, b int")
    assert N.kendall(x, "a", "b").first()["tau"] == pytest.approx(1 / 3)
    a, b = spark.createDataFrame([("x",)] * 3, "k string"), spark.createDataFrame([("x",)], "k string")
    assert [r["n"] for r in V.adjusted_difference(a, b, spark.createDataFrame([("x", 1)], "k string, times int"), "k").collect()] == [1]
