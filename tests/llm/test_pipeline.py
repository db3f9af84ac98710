"""The pipeline's stages, each on its own input, and the operators' SQL."""

import random

import corpus_pipeline
import duckdb
import pytest
from loamwork.llm import queries
from loamwork.llm.common import materialize, table
from loamwork.llm.quality_rules import quality_rules


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs, out = table(spark, sf, "documents"), []
    for name, f in corpus_pipeline.STAGES:
        after = materialize(f(spark, docs, sf))
        out.append((name, docs, after))
        docs = after
    return out


def test_stages(spark, sf, stages):
    columns = table(spark, sf, "documents").columns
    assert [n for n, _, _ in stages] == ["quality_rules", "line_dedup", "near_duplicates", "decontaminate", "mix"]
    for _, before, after in stages[:-1]:
        assert after.columns == columns and 0 < after.count() <= before.count()
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    _, before, after = stages[0]
    assert ids(after) == {r["doc_id"] for r in quality_rules(before).where("kept").collect()}
    _, before, after = stages[1]
    assert ids(before) == ids(after)
    _, before, after = stages[3]
    assert ids(before) - ids(after) == {r["doc_id"] for r in queries.contaminated(before, table(spark, sf, "benchmark")).collect()}
    _, before, after = stages[4]
    assert ids(after) <= ids(before)
    size = sum(len((r["text"] or "").split()) for r in before.collect())
    assert abs(sum(r["n_words"] for r in after.collect()) - size) <= 0.05 * size


def test_near_duplicate_stage_against_brute_force(stages):
    from test_operators import brute_components, brute_sets

    _, before, after = stages[2]
    want = brute_components(brute_sets([(r["doc_id"], r["text"]) for r in before.collect()]))
    assert {r["doc_id"] for r in after.collect()} == {i for i, c in want.items() if i == c}


def test_line_stage_against_brute_force(stages):
    """What the stage cuts stands in an earlier place, line for line, and no line in a repeat of 50 words by itself is left."""
    from test_operators import WORD, brute_lines

    _, before, after = stages[1]
    old, new = ({r["doc_id"]: r["text"] for r in x.collect()} for x in (before, after))
    lines = {d: t.split("\n") for d, t in old.items()}
    small = [(d, t) for d, t in old.items() if len(t) < 6000]  # all pairs of lines of all texts would take long
    long_lines = {x for t in old.values() if len(t) >= 6000 for x in t.split("\n")}
    may, sure = brute_lines(small, 25), brute_lines(small, 50)
    words = lambda text: [x for x in text if WORD.search(x)]
    assert len(sure) > 5
    for d, _ in small:
        left = new[d].split("\n")
        assert not new[d] or set(left) <= set(lines[d])
        if not long_lines & set(lines[d]):
            assert len(words(lines[d])) - len(words(left)) <= len(may.get(d, ()))
        alone = [k for k in sure.get(d, ()) if len(WORD.findall(lines[d][k])) >= 50]
        assert all(lines[d][k] not in left or lines[d].count(lines[d][k]) > len(alone) for k in alone)


def test_mix_stage(stages):
    """Every source comes near its target, no document exceeds three times its size, and slots hold the words they name."""
    from test_operators import WORD, plain_targets

    _, before, after = stages[4]
    docs = {r["doc_id"]: (r["source"], WORD.findall(r["text"] or "")) for r in before.collect()}
    size, taken, by_doc = {}, {}, {}
    for s, w in docs.values():
        size[s] = size.get(s, 0) + len(w)
    for r in after.collect():
        source, words = docs[r["doc_id"]]
        assert r["source"] == source and len(r["text"].split(" ")) == r["n_words"]
        run = r["text"].split(" ")
        assert any(words[i : i + len(run)] == run for i in range(len(words) - len(run) + 1))
        taken[source] = taken.get(source, 0) + r["n_words"]
        by_doc[r["doc_id"]] = by_doc.get(r["doc_id"], 0) + r["n_words"]
    want = dict(zip(size, plain_targets(list(size.items()))))
    assert all(abs(taken.get(s, 0) - want[s]) <= 0.05 * want[s] + 64 for s in size)
    assert all(n <= 3 * len(docs[d][1]) for d, n in by_doc.items())


def test_run_repeats(spark, sf):
    a, b = (sorted(map(str, corpus_pipeline.run(spark, sf).collect())) for _ in range(2))
    assert a == b


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, sf, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        c.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    want = c.sql(f"select {', '.join(columns)} from ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(tuple, df.select(*columns).collect()), key=str) == sorted(want, key=str)


def test_every_query_runs(spark, sf):
    random.seed(1)
    for name, f in queries.QUERIES.items():
        assert {"op3_html_extract": "page_id", "op13_conversation_repair": "conv_id"}.get(name, "doc_id") in f(spark, sf).columns
