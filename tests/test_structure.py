"""Structure operators and sinks on invented text."""

import random

from loamwork.functions.text import norm_integrity
from loamwork.operators import corpus as C
from loamwork.operators import structure as S
from loamwork.sources import sinks, tables


def test_headings_and_toc(spark):
    docs = spark.createDataFrame([(1, "# A\nx\n## s1\ny\n# B\nz"), (2, None), (3, "")], "doc_id long, text string")
    got = {(r["doc_id"], r["chapter"]): (r["first"], r["n_lines"], r["n_sections"]) for r in S.toc(C.lines(docs)).collect()}
    assert got == {(1, "A"): (1, 4, 1), (1, "B"): (5, 2, 0)}


def test_unwrap(spark):
    docs = spark.createDataFrame([(1, "a" * 45 + "\nand more.\nnext"), (2, None), (3, "")], "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_merged"]) for r in S.unwrap(docs).collect()}
    assert got == {1: ("a" * 45 + " and more.\nnext", 1), 2: (None, 0), 3: ("", 0)}


def test_unwrap_is_one_expression(spark):
    """No Python worker holds texts, and each line is joined as by the rule for lines."""
    rng = random.Random(3)
    starts = ["", "and", "- x", "12) x", "1.x", "```", " x", "# h", "é", "x", "。"]
    texts = ["\n".join(rng.choice(starts) + rng.choice("a.,é; ") * rng.choice([0, 38, 40, 60]) + rng.choice(["", ".", ":", "\r", "\u2028", ",", "é", "！"]) for _ in range(rng.randint(1, 9))) for _ in range(200)]
    x = S.unwrap(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert "InPandas" not in x._jdf.queryExecution().toString() and "InArrow" not in x._jdf.queryExecution().toString()
    for r in x.collect():
        lines = S.fold_lines(texts[r["doc_id"]].split("\n"))
        assert (r["text"], r["n_merged"]) == ("\n".join(lines), texts[r["doc_id"]].count("\n") + 1 - len(lines))


def test_tables_lose_nothing(spark):
    raw = ["name      size      note", "apple     10        red one", "                    and sweet", "pear      2         green"]
    rows, confidence = S.recover_table(raw)
    assert confidence == "high" and rows[1] == ["apple", "10", "red one and sweet"] and len(rows) == 3
    assert S.recover_table(["just text", "more"])[1] == "low"
    df = spark.createDataFrame([(1, raw), (2, [])], "block_id int, raw array<string>")
    assert {r["block_id"]: len(r["rows"]) for r in S.tables(df).collect()} == {1: 3, 2: 0}


def test_questions_and_matches(spark):
    text = "intro\n1. What is it?\n(A) one\n(B) two\nAnswer: B\n2. And now\ngo on?\n(A) x"
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    a, b = S.questions(docs).orderBy("number").collect()
    assert (a["stem"], a["answer"], [o["label"] for o in a["options"]]) == ("What is it?", "B", ["A", "B"])
    assert (b["stem"], b["answer"]) == ("And now\ngo on?", None)
    got = [(r["first"], r["found"], r["line_no"]) for r in S.find_all(docs, r"go \w+", "go").collect()]
    assert got == [(text.index("go on"), "go on", 7)]


def test_sinks_round_trip_and_gate(spark):
    docs = spark.createDataFrame([(1, "b | c\nd"), (2, "é")], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in sinks.render(C.lines(docs)).collect()} == {1: "b | c\nd", 2: "é"}
    assert sinks.changed(docs, docs).count() == 0
    assert {r["n_bytes"] for r in sinks.manifest(docs).collect()} == {7, 2}
    base = C.integrity(docs)
    ok, bad = sinks.gated(spark.createDataFrame([(1, "b c d"), (2, "e")], "doc_id long, text string"), base, norm_integrity)
    assert [r["doc_id"] for r in ok.collect()] == [1] and [r["doc_id"] for r in bad.collect()] == [2]


def test_sources(spark, tmp_path):
    pages = spark.createDataFrame([("x", '["one", "two"]'), ("y", None), ("z", "broken")], "doc_id string, value string")
    assert [(r["page_no"], r["text"]) for r in tables.page_array(pages).orderBy("page_no").collect()] == [(1, "one"), (2, "two")]
    ff = spark.createDataFrame([(1, "a\fb")], "doc_id long, text string")
    assert tables.form_feed_pages(ff).count() == 2
    (tmp_path / "m.csv").write_text("﻿code,page\nA,1\nB,2\nA,3\n", encoding="utf-8")
    assert {r["code"]: r["page"] for r in tables.csv_dict(spark, f"file://{tmp_path}/m.csv", "code").collect()} == {"A": "3", "B": "2"}
    (tmp_path / "a.tsv").write_text("volume\tcheck\tfound\tcontext_regex\treason\n# note\n\n*\turl\tx\n", encoding="utf-8")
    got = tables.allow_list(spark, f"file://{tmp_path}/a.tsv").collect()
    assert [(r["rule_order"], r["volume"], r["check"], r["found"], r["reason"]) for r in got] == [(1, "*", "url", "x", "")]
    for k in range(9):  # long files are read in many splits, in any order
        (tmp_path / f"b{k}.tsv").write_text("".join(f"v\tc\t{k}-{i}\n\n" for i in range(200 * (9 - k))), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    got = [r["found"] for r in tables.allow_list(spark, f"file://{tmp_path}/b*.tsv").orderBy("rule_order").collect()]
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [f"{k}-{i}" for k in range(9) for i in range(200 * (9 - k))]


def test_text_copy(spark, tmp_path):
    from loamwork.sources import files

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a b.txt").write_text("\ufeffone\n\ufefftwo\n\nthree\n", encoding="utf-8")
    (tmp_path / "in" / "c.txt").write_text("four\n", encoding="utf-8")
    got = sorted((r["relpath"], r["line"]) for r in files.text_copy(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out").collect())
    assert got == sorted([("a b.txt", "one"), ("a b.txt", "\ufefftwo"), ("a b.txt", ""), ("a b.txt", "three"), ("c.txt", "four")])


def test_text_copy_by_the_tasks_that_read(spark, tmp_path):
    """A long file is copied in as many parts as it is read in, without its mark."""
    from loamwork.sources import files

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\ufeff" + "".join(f"line {k}\n" for k in range(4000)), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    got = [r["line"] for r in files.text_copy(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out").collect()]
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got) == sorted(f"line {k}" for k in range(4000))
    assert len(list((tmp_path / "out" / "relpath=a.txt").glob("part-*"))) > 3
