"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest
from loamwork.plans import catalogue
from loamwork.sources.tables import TABLES


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


def rows(found):
    clean = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(clean(v) for v in r) for r in found), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, duck, sf, name):
    df = catalogue.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    want = duck.sql(catalogue.ORACLES[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert rows(df.select(*columns).collect()) == rows(tuple(r[i] for i in at) for r in want.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_ewma(spark, sf):
    got = {r["user_id"]: r["level"] for r in catalogue.QUERIES["ewma"](spark, sf).collect()}
    want = {}
    for r in spark.read.parquet(f"{sf}/events.parquet").orderBy("ts", "event_id").collect():
        k = r["user_id"]
        want[k] = r["value"] if k not in want else 0.3 * r["value"] + 0.7 * want[k]
    assert got == {k: pytest.approx(v, abs=1e-5) for k, v in want.items()}


def test_greedy_spans(spark, sf):
    got = {r["doc_id"]: r["n"] for r in catalogue.QUERIES["greedy_spans"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        spans = [(i, i + 1 + len(w) % 3) for i, w in enumerate(r["text"].split(" "))]
        end, n = -1, 0
        for a, b in sorted((s for s in spans if s[1] > s[0] + 1), key=lambda s: (s[0], -s[1])):
            if a >= end:
                end, n = b, n + 1
        assert got[r["doc_id"]] == n
