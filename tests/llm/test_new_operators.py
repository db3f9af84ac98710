"""Personal data, lexical search and conversation repair: against brute force, and on odd rows."""

import hashlib
import heapq
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from loamwork.llm import conversations, lexical_search, pii, queries
from loamwork.llm.common import table

ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "a b c d e f g"), (5, "one"), (5, "one"), (6, "x y " * 30_000), (7, "É è ß\n\n" * 9)]

# --- 11 -------------------------------------------------------------------------------------------------------------


def plain_spans(t):
    """The base kinds by their patterns, and plain checks of what they match."""
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 12 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0:
            found.append(("card", m))
    found += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(((k, *m.span()) for k, m in found), key=lambda x: (x[1], pii.KINDS.index(x[0])))


@pytest.mark.parametrize("signs", ["@.a1-+ ", "0123456789 -.+", "+1 (2).-", "a@b.c1é", "1.2", "12 -", "0.255 "])
def test_base_spans_against_patterns(signs):
    rng, anchors = random.Random(signs), pii.automaton()
    for _ in range(4000):
        t = "".join(rng.choice(signs) for _ in range(rng.randint(0, 60)))
        assert [x for x in pii.spans(t, anchors) if x[0] in pii.BASE] == plain_spans(t)


def test_added_spans():
    t = (
        "é joe.doe (at) example [dot] com, https://u:p@h.org/x and http://plain.org/a@b tel:+1-202-555-0100 IBAN: DE89 3704 0044 0532 0130 00 "
        "iban DE88370400440532013000 account no. 1234567890 discount 123456789 SSN 123-45-6789 ssn 000-12-3456 token = \"681c09b8e90e7e8c\" password: hunter2hunter the secret: something"
    )
    got = [(k, t[a:b]) for k, a, b in pii.spans(t, pii.automaton()) if k in pii.ADDED]
    assert got == [
        ("obscured", "joe.doe (at) example [dot] com"), ("login", "https://u:p@h.org"), ("tel", "tel:+1-202-555-0100"), ("iban", "DE89 3704 0044 0532 0130 00"),
        ("account", "1234567890"), ("ssn", "123-45-6789"), ("secret", "681c09b8e90e7e8c"), ("secret", "hunter2hunter"),
    ]


@pytest.mark.parametrize("t", ["1 " * 200_000, "1." * 200_000, "a@" * 200_000, "+1" * 200_000, "+" + "1 " * 200_000, "://" * 100_000, "IBAN AA11" + "A" * 300_000, "9" * 400_000])
def test_spans_of_long_runs(t):
    small, anchors = t[: len(t) // 100], pii.automaton()
    assert [x for x in pii.spans(small, anchors) if x[0] in pii.BASE] == plain_spans(small)
    pii.spans(t, anchors)


def test_pii_whole_query(spark, sf):
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, sf, "documents").collect()}
    for r in queries.QUERIES["op11_pii"](spark, sf).collect():
        want = plain_spans(docs[r["doc_id"]])
        n = Counter(k for k, _, _ in want)
        assert [r["n_" + k] for k in pii.BASE] == [n[k] for k in pii.BASE]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        listed = [s.split(":") for s in r["spans"].split(",") if s]
        assert [tuple(s) for s in listed if s[0] in pii.BASE] == [(k, str(a), str(b)) for k, a, b in want]


def test_pii_odd_rows(spark):
    docs = spark.createDataFrame([(*x, 1.5) for x in [*ODD, (9, "🎉 a@b.c +49 (30) 123 456-7"), (9, "ip 1.2.3.4 4929 1234 5678 9012")]], "doc_id int, text string, spans double")
    got = sorted(map(tuple, pii.pii(docs).collect()), key=str)
    empty = hashlib.sha256(b"").hexdigest()
    assert len(got) == len(ODD) + 2 and sum(r[5] == empty and r[6] == "" for r in got) == len(ODD)
    assert {r[6] for r in got} >= {"email:2:7,phone:8:26"}
    with pytest.raises(ValueError, match="spans"):
        pii.find_spans(docs)
    clean = {(r["doc_id"], r["text"], r["spans"]) for r in pii.redact(docs).collect()}
    assert (9, "🎉 <email> <phone>", 1.5) in clean and (1, None, 1.5) in clean and (2, "", 1.5) in clean
    assert pii.pii(docs.limit(0)).count() == 0
    over = spark.createDataFrame([(1, "see https://me:a@b.org now"), (2, "1.2.3.4")], "doc_id int, text string")
    assert [r["text"] for r in pii.redact(over).orderBy("doc_id").collect()] == ["see <login> now", "<ip>"]
    assert [r["text"] for r in pii.redact(over, ["email"]).orderBy("doc_id").collect()] == ["see https://me:<email> now", "1.2.3.4"]


# --- 12 -------------------------------------------------------------------------------------------------------------


def plain_search(docs, items, k):
    """Ranks by plain dictionaries and Python's whole numbers."""
    parts = lambda t: ["".join(c.lower() if c.isascii() else c for c in w) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
    tfs = [(d, Counter(w), len(w)) for d, w in ((d, parts(t)) for d, t in docs) if w]
    n_docs, words = len(tfs), sum(n for _, _, n in tfs)
    df, out, by_item = Counter(t for _, c, _ in tfs for t in c), [], defaultdict(set)
    for i, t in items:
        by_item[i] |= set(parts(t))
    for i, ts in by_item.items():
        scores = []
        for d, c, n in tfs:
            m = 100 - 90 + 90 * n * n_docs // words
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if c[t])
            if s > 0:
                scores.append((-s, d is None, d if d is not None else 0, d))
        out += [(i, r + 1, x[3], -x[0]) for r, x in enumerate(heapq.nsmallest(k, scores, key=lambda x: x[:3]))]
    return sorted(out, key=str)


@pytest.mark.parametrize("triples", [2_000_000, 50])
def test_search_against_brute_force(spark, monkeypatch, triples):
    monkeypatch.setattr(lexical_search, "TRIPLES_AT_ONCE", triples)  # tasks run here take the value with their code
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 3))) for _ in range(150)]
    docs = [(d if d % 17 else None, rng.choice(" -\n").join(rng.choice(words[: rng.choice((10, 150))]).title() for _ in range(rng.randint(0, 60)))) for d in range(400)]
    docs += [(1000 - d, docs[5][1]) for d in range(60)] + ODD
    items = [(i if i else None, " ".join(rng.choice(words) for _ in range(rng.randint(0, 12)))) for i in range(25)] + [(3, "éé ab"), (90, None), (91, "zzzzz"), (92, "..")]
    df, it = spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, lexical_search.search(df, it, 7).collect()), key=str) == plain_search(docs, items, 7)


def test_search_in_passes_and_odd_tables(spark, monkeypatch):
    rng = random.Random(6)
    docs = [(d, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 9)))) for d in range(90)]
    items = [(f"i{i}", " ".join(rng.sample("abcdefgh", 3)), 1.5) for i in range(30)]
    df, it = spark.createDataFrame(docs, "score int, body string"), spark.createDataFrame(items, "rank string, body string, doc double")
    want = plain_search(docs, [x[:2] for x in items], 4)
    monkeypatch.setattr(lexical_search, "ITEMS_AT_ONCE", 7)
    monkeypatch.setattr(lexical_search, "PIECE", 3)
    got = lexical_search.search(df, it, 4, doc="score", item="rank", text="body")
    assert got.columns == ["rank", "rank_", "score", "score_"] and sorted(map(tuple, got.collect()), key=str) == want
    assert lexical_search.search(df.limit(0), it, doc="score", item="rank", text="body").count() == 0
    assert lexical_search.search(df, it.limit(0), doc="score", item="rank", text="body").count() == 0


def test_radix_order_and_lengths():
    rng = np.random.default_rng(2)
    for bits in (3, 16, 17, 40, 62):
        keys = rng.integers(0, 1 << bits, 5000)
        assert (lexical_search.radix_order(keys, bits) == np.argsort(keys, kind="stable")).all()
    n = np.array([1, 7, 10**7])
    assert lexical_search._lengths(n, 10**11, 10**14).tolist() == [10 + 90 * int(x) * 10**11 // 10**14 for x in n]


# --- 13 -------------------------------------------------------------------------------------------------------------


@pytest.fixture
def many_tasks(spark):
    """Small shuffles stay in as many tasks as large ones have."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plain_repairs(rows):
    """Every sequence of edits up to a bound of cost, by exhaustive search with Dijkstra on (cost, audit) itself."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, shape, lines = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", shape):
            return cost, audit, "\n".join(lines)
        tail = shape[-2:] if shape[-2:] != "s" else shape
        if (i, tail, cost, audit) in seen or not re.fullmatch("s?(ua)*u?", shape):
            continue
        seen.add((i, tail, cost, audit))
        for r in ("user", "assistant"):
            heapq.heappush(heap, (cost + 2, audit + "I", i, shape + r[0], (*lines, r + ":")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, shape, lines))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                heapq.heappush(heap, (cost + extra, audit + "K", i + 1, shape + (role[:1] or "-"), (*lines, f"{role}:{text}")))
                for r in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 2 + extra, audit + "R", i + 1, shape + r[0], (*lines, f"{r}:{text}")))


def plain_conversations(rows):
    out = {}
    for c in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in (r for r in rows if r[0] == c):
            d = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
            kept += [(turn, "user" if d == 4 else role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
        kept.sort(key=lambda x: (x[0] is not None, x[0] or 0, f"{x[1]}:{x[2]}".encode(), x[1].encode()))
        seen, judged = set(), []
        for _, role, text in kept:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            judged.append((role, text, "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""))
            seen.add((role, text))
        turns = [t for t, _, _ in kept if t is not None]
        n = Counter(f for _, _, f in judged)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(judged))
        cost, audit, text = plain_repairs(judged)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[c] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def made_up(rng, n):
    said = ["Yes.", "No!", "So it is?", "cut off", " ", "", None, "é ü.\n ", "Ends here. \t", "a: b.", "x\x0b"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "uncle", "a:"]
    return [(rng.choice([*range(n // 5), None]), rng.choice([*range(8), 11, None]), rng.choice(roles), rng.choice(said)) for _ in range(n)]


@pytest.mark.parametrize("hold", [(20_000, 8_000_000), (2, 40)])
def test_conversations_against_brute_force(spark, many_tasks, monkeypatch, hold):
    monkeypatch.setattr(conversations, "HOLD_TURNS", hold[0])
    monkeypatch.setattr(conversations, "HOLD_CHARS", hold[1])
    rows = made_up(random.Random(hold[0]), 150)
    rows += [r for r in rows[:20]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    want = plain_conversations(rows)
    got = {r[0]: tuple(r)[1:] for r in conversations.diagnose(conversations.damage(df)).collect()}
    assert got == want
    steps = defaultdict(list)
    for r in conversations.repair(conversations.damage(df)).orderBy("place").collect():
        steps[r["conv_id"]].append(r)
    for c, x in want.items():
        assert "".join(r["edit"] for r in steps[c]) == x[6]
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in steps[c] if r["edit"] != "D").encode()).hexdigest() == x[7]


def test_one_long_conversation_over_many_tasks(spark, many_tasks, monkeypatch):
    monkeypatch.setattr(conversations, "HOLD_TURNS", 50)
    rng = random.Random(3)
    rows = [("hot", t, rng.choice(("user", "assistant")), rng.choice(("Yes.", f"No {t}!", f"cut {t}"))) for t in range(1500)] + [(f"c{t % 40}", t, "user", "Hm.") for t in range(200)]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string").selectExpr("*", "1 as code", "2 as piece").repartition(4)
    written = conversations._streamed(*conversations._prepared(df, "conv_id"), False)
    assert written.where("kind = 'part' and conv = 'hot'").select("piece").distinct().count() > 1
    got = {r["conv_id"]: r for r in conversations.diagnose(df).collect()}
    codes, seen = bytearray(), set()
    for _, _, role, text in rows[:1500]:
        codes.append(" ua".index(role[0]) * 4 + (3 if (role, text) in seen else text[-1] not in ".!?"))
        seen.add((role, text))
    codes = bytes(codes)
    dist = conversations.distances(codes)
    assert len(got) == 41 and got["hot"]["cost"] == dist[0] and got["hot"]["audit"] == "".join(e for _, e, _ in conversations.repair_steps(codes, dist))
    lines = [f"{r or rows[i][2]}:{'' if e == 'I' else rows[i][3]}" for i, e, r in conversations.repair_steps(codes, dist) if e != "D"]
    assert got["hot"]["repaired_sha256"] == hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_conversations_odd_tables(spark):
    empty = spark.createDataFrame([], "conv_id int, turn int, role string, text string")
    assert conversations.diagnose(conversations.damage(empty)).count() == 0 and conversations.repair(empty).count() == 0
    same = spark.createDataFrame([(1, 5, "user", "Well.")] * 30 + [(None, None, None, None)] * 3, "conv_id int, turn int, role string, text string")
    got = {r["conv_id"]: r for r in conversations.diagnose(same).collect()}
    assert got[1]["duplicate"] == 29 and got[1]["cost"] == 29 * 3 + 2 and got[1]["audit"] == "K" + "D" * 29 + "I"
    assert got[None]["blank"] == 3 and got[None]["audit"] == "DDD" and got[None]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_repair_sql_on_odd_rows(spark):
    """The DuckDB query says the same of odd rows as brute force."""
    import pandas as pd

    rows = list(dict.fromkeys(made_up(random.Random(9), 120)))
    con = duckdb.connect()
    con.register("raw", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    con.sql("create table conversations as select conv_id::bigint as conv_id, turn::bigint as turn, role, text from raw")
    got = {r[0]: r[1:] for r in con.sql(f"select conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 from ({queries.REPAIR_SQL})").fetchall()}
    assert got == plain_conversations(rows)
