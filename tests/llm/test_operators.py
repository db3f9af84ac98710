"""The training-data operators on small fixtures: against brute force, and on odd rows."""

import html
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from loamwork.llm import decontaminate, html_extract, jaccard_join, langid, line_dedup, mixing, quality_classifier, quality_rules, token_counts, toxicity
from loamwork.llm.common import table
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "a b c d e f g"), (5, "one"), (5, "one"), (6, "x y " * 30_000), (7, "É è ß\n\n" * 9)]


def made(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def vocabulary(n, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(3, 8))) for _ in range(n)]


def prose(n, rng, words):
    return [rng.choice(words) for _ in range(n)]


# --- 1 --------------------------------------------------------------------------------------------------------------


def distance(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_edit_search_is_exact():
    rng = random.Random(3)
    for _ in range(300):
        a, b = [rng.randrange(4) for _ in range(rng.randint(1, 9))], [rng.randrange(4) for _ in range(rng.randint(0, 14))]
        assert decontaminate.edit_search(a, b)[0] == distance(a, b)


def test_decontaminate_against_brute_force(spark):
    rng, words = random.Random(5), vocabulary(4000)
    items = [(i, " ".join(prose(rng.randint(12, 60), rng, words))) for i in range(40)]
    docs, planted = [], set()
    for d in range(120):
        text = prose(rng.randint(0, 300), rng, words)
        if d % 3 == 0:
            i, t = items[rng.randrange(len(items))]
            w = t.split()
            for _ in range(rng.randint(0, int(0.2 * len(w)))):
                p, kind = rng.randrange(len(w)), rng.random()
                w[p : p + (kind < 0.7)] = [rng.choice(words).upper()] if kind < 0.5 or kind >= 0.7 else []
            at = rng.randint(0, len(text))
            text[at:at] = w
            planted.add((d, i))
        docs.append((d, ", ".join(text)))
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontaminate.contaminated(made(spark, docs), made(spark, items, "item_id long, text string")).collect()}
    want = {}
    for d, t in docs:
        w = t.lower().split(", ")
        for i, x in items:
            k = distance(x.split(), w)
            if k <= int(0.2 * len(x.split())):
                want[d, i] = k
    assert planted <= set(want) and set(got) <= set(want)
    assert len(set(got)) >= 0.97 * len(want)
    assert all(got[p] == want[p] for p in got)
    kept = decontaminate.decontaminate(made(spark, docs).withColumn("low", F.lit("x")), made(spark, items, "item_id long, text string"))
    assert {(r["doc_id"], r["text"], r["low"]) for r in kept.collect()} == {(d, t, "x") for d, t in docs if d not in {x for x, _ in got}}


def test_recall_by_length():
    """Items with as many edits as they may have, on edits that the index has not seen: by class of lengths."""
    lost, tried = Counter(), Counter()
    for seed in range(12):
        rng, words = random.Random(seed), vocabulary(3000)
        items = [(i, prose(rng.randint(10, 120), rng, words)) for i in range(40)]
        known = [w.hash[w.ptr[d] : w.ptr[d + 1]] for _, w in decontaminate._chunks(pa.array([" ".join(t) for _, t in items])) for d in range(40)]
        index, texts = decontaminate.Index(list(enumerate(known)), 0.2, 0.99), []
        for _, w in items:
            w = list(w)
            for _ in range(int(0.2 * len(w))):
                p, kind = rng.randrange(len(w)), rng.random()
                w[p : p + (kind < 0.7)] = [rng.choice(words)] if kind < 0.5 or kind >= 0.7 else []
            texts.append(" ".join(prose(30, rng, words) + w + prose(30, rng, words)))
        found = {(a + d, i) for a, w in decontaminate._chunks(pa.array(texts)) for d, i, _, _ in index.search(w)}
        for i, (_, w) in enumerate(items):
            tried[len(w).bit_length()] += 1
            lost[len(w).bit_length()] += (i, i) not in found
    assert sum(lost.values()) <= 0.01 * sum(tried.values()) and all(lost[c] <= 1 + 0.01 * tried[c] for c in tried)


def test_decontaminate_odd_rows(spark):
    items = made(spark, [(1, None), (2, "zz yy"), (3, "p q r s t u v w"), (4, "天地玄黄，宇宙洪荒。日月"), (5, " .,! ")], "item_id int, text string")
    rows = [*ODD, (9, "so P, q r s t u v w!"), (None, "P “q” r\u00a0s—t u v w"), (11, "甲乙天地玄黄宇宙洪荒日月丙丁"), (12, "xx zz, YY"), (12, "zz x yy")]
    docs = spark.createDataFrame([(d, t, 1.5) for d, t in rows], "doc_id smallint, text string, item_id double")
    got = decontaminate.contaminated(docs, items).collect()
    assert sorted((str(r["doc_id"]), r["item_id"], r["distance"]) for r in got) == [("11", 4, 0), ("12", 2, 0), ("9", 3, 0), ("None", 3, 0)]
    kept = decontaminate.decontaminate(docs, items)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    assert sorted(map(str, kept.collect())) == sorted(map(str, [*docs.limit(len(ODD)).collect(), *docs.where("text = 'zz x yy'").collect()]))
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0 and decontaminate.decontaminate(docs, items.limit(0)).count() == len(rows)


def test_decontaminate_in_passes_and_recall(spark, monkeypatch):
    rng, words = random.Random(8), vocabulary(900)
    items = [(i, " ".join(prose(rng.randint(2, 40), rng, words))) for i in range(30)]
    docs = made(spark, [(d, " ".join(prose(20, rng, words) + items[d % 30][1].split() + prose(20, rng, words))) for d in range(60)])
    items = made(spark, items, "item_id long, text string")
    whole = sorted(map(str, decontaminate.contaminated(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "ITEMS_AT_ONCE", 7)
    assert sorted(map(str, decontaminate.contaminated(docs, items).collect())) == whole
    assert decontaminate.decontaminate(docs, items).count() == 0
    monkeypatch.setattr(decontaminate, "MAX_TABLES", 1)
    with pytest.raises(ValueError, match="tables"):
        decontaminate.contaminated(docs, items)


# --- 2 --------------------------------------------------------------------------------------------------------------


def plain_targets(sizes):
    """Shares by weights 1, 2, 3 in code-point order, null last, found by halving on the common rate instead of refilling."""
    order = sorted((s for s, _ in sizes if s is not None), key=lambda s: s.encode()) + [None] * any(s is None for s, _ in sizes)
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    total, lo, hi = sum(n for _, n in sizes), 0.0, 1e18
    for _ in range(200):
        rate = (lo + hi) / 2
        lo, hi = (rate, hi) if sum(min(3 * n, weight[s] * rate) for s, n in sizes) < total else (lo, rate)
    return [min(3 * n, weight[s] * lo) for s, n in sizes]


def test_targets_fill_up():
    sizes = [("b", 10), ("a", 100), (None, 100), ("c", 1000)]
    t = mixing.targets(sizes)
    # weights a 1, b 2, c 3, null 1; b stops at 30 and the rest, 1180, goes 1 : 3 : 1
    assert t == pytest.approx([30, 236, 236, 708]) and t == pytest.approx(plain_targets(sizes))
    rng = random.Random(5)
    for _ in range(50):
        sizes = [(s, rng.choice([0, 1, 5, 1000, 10**7])) for s in rng.sample(["a", "b", "é", "Z", "zz", "", None], rng.randint(1, 7))]
        t = mixing.targets(sizes)
        assert t == pytest.approx(plain_targets(sizes), rel=1e-6, abs=1e-6) and sum(t) == pytest.approx(sum(n for _, n in sizes))


def test_mix(spark):
    rng, words = random.Random(1), vocabulary(500)
    rows = [(d, " ".join(prose(rng.randint(0, 200), rng, words)), ["a", "b", None, "é"][min(d % 7, 3)]) for d in range(300)]
    rows += [(None, "only these few words", "a"), (7, rows[7][1], rows[7][2]), (400, None, "z")]
    docs = made(spark, rows, "doc_id long, text string, source string")
    got = mixing.mixed_counts(docs).collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, mixing.mixed_counts(docs).collect()))
    per = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        x = per.setdefault(r["source"], [0, 0, r["target"]])
        x[0] += r["size"]
        x[1] += r["taken"]
    sizes = [(s, n) for s, (n, _, _) in per.items()]
    for (s, n), t in zip(sizes, plain_targets(sizes)):
        assert per[s][2] == pytest.approx(t)
        assert abs(per[s][1] - t) <= 96
    pieces, _ = mixing.mix(docs)
    texts = {(r[0], r[1]) for r in rows}
    out = pieces.collect()
    assert sum(len(p["text"].split()) for p in out) == sum(r["taken"] for r in got)
    assert all(any(p["text"] in " ".join((t or "").split()) for d, t in texts if d == p["doc_id"]) for p in out[:300])
    assert mixing.mixed_counts(docs.limit(0)).count() == 0


def test_mix_is_the_same_in_short_slot_runs(spark, monkeypatch):
    rng, words = random.Random(2), vocabulary(300)
    docs = made(spark, [(d, " ".join(prose(rng.randint(0, 900), rng, words)), "ab"[d % 10 == 0]) for d in range(200)], "doc_id long, text string, source string")
    whole = sorted(map(str, mixing.mix(docs)[0].collect()))
    monkeypatch.setattr(mixing, "SLOT_RUN", 7)
    assert sorted(map(str, mixing.mix(docs)[0].collect())) == whole


def test_rows_that_repeat_are_dealt_out(spark):
    docs = spark.range(60_000).selectExpr("cast(null as long) as doc_id", "'one two three' as text", "'s' as source")
    docs = docs.unionByName(made(spark, [(d, "a b", "s" if d % 2 else None) for d in range(3000)] * 2, "doc_id long, text string, source string"))
    got = mixing.numbered(docs).select("__key", "__group", "__row", "__from", "__to").toPandas()
    assert len(got) == 66_000 and not got.duplicated(["__key", "__group", "__row"]).any()
    assert got.groupby(["__key", "__group"]).size().max() < 1.3 * mixing.GROUP_ROWS
    for _, own in got.sort_values("__from").groupby("__key"):
        assert own["__from"].iloc[0] == 0 and (own["__from"].to_numpy()[1:] == own["__to"].to_numpy()[:-1]).all()


def test_permutation_is_one():
    for n in (1, 2, 3, 10, 1000, 4097):
        x = mixing._permuted(np.arange(n), np.full(n, n), np.full(n, 77))
        assert sorted(x) == list(range(n))


# --- 3 --------------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a < b) "</p>"</script></head><body class="home">
<header><h1>Site</h1></header><nav><ul><li><a href=x>Menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
<div id="wrap7"><div class="post-{n} content"><h1>Title &amp; more</h1><p>First <b>par</b>agraph&nbsp;of   text<br>and more &lt;here&gt;.
<p>Second &#8212; one.<ul><li>item one<li>item two</ul><div class="ad-slot">Buy!</div><form>Subscribe</form></div>
<aside>Aside</aside><div class="sidebar">Links</div><section id="comments"><p>A reader's comment, long enough to count as text of its own here.</section></div><footer>&copy; me</footer></body></html>"""
WANT = "Title & more First paragraph of text and more <here>. Second — one. item one item two"


def test_html_page():
    assert html_extract.extract(PAGE) == WANT


def test_html_class_of_a_wrapper_drops_no_article():
    text = "<body><div class='page with-sidebar'><div class=sidebar><p>Links here</p></div><article><h1>A</h1><p>Body text.</p><div id=comments><article class=comment><p>No!</p></article></div></article></div></body>"
    assert html_extract.extract(text) == "A Body text."


def test_html_class_words():
    text = "<body><article><p>One.<section class='social-history'><p>Kept.</section><blockquote class=alert>Quote.</blockquote><div class='ad-slot x'>Buy</div><div id=postShare>S</div><div class='side-effects'>Too.</div></article></body>"
    assert html_extract.extract(text) == "One. Kept. Quote. Too."


def test_html_long_attributes_and_quotes():
    long = "x > y " * 30_000
    assert html_extract.extract(f"<body><article><div data-j='{long}'><p>One.</div><p title=\"{long}\">Two.</article></body>") == "One. Two."
    assert html_extract.extract("<body><article><p it's>One.<p title=\"open>Two.</p><p class=b>Three.</article></body>") == "One. Two. Three."
    assert html_extract.extract("<body><article><p title= 'a > b'>One.<img alt=\"c > d\" >Two.</article></body>") == "One. Two."


def test_html_case_that_changes_length():
    assert html_extract.extract("<body><article><p>\u0130 one.<SCRIPT>if (a) b</SCRIPT><p>Two.<script>x</scripty></script ><STYLE>c</sTyLe></article></body>") == "\u0130 one. Two."


def test_html_body_of_parts():
    assert html_extract.extract("<body><nav>Menu</nav><div class=intro>" + "Some words to begin with. " * 4 + "</div><div class=rest>" + "And very much more of them. " * 9 + "</div><footer>f</footer></body>") == ("Some words to begin with. " * 4 + "And very much more of them. " * 9).strip()
    assert html_extract.extract("<body><div class=intro><p>Short.</p></div><div class=rest>" + "<p>And more.</p>" * 9 + "</div><div>site line</div></body>") == "And more. " * 8 + "And more."


@pytest.mark.parametrize("name", ["discussion", "legal", "notice", "reply", "related", "alert-box", "disclaimer"])
def test_html_sections_of_an_article_stay(name):
    kept = f"<body><article><h1>T</h1><p>One.</p><section class='{name}'><h2>H</h2><p>Its own words.</p></section><p>Two.</p></article><div class='{name}'><p>Outside.</p></div></body>"
    assert html_extract.extract(kept) == "T One. H Its own words. Two."
    links = f"<body><article><h1>T</h1><p>One.</p><div class='{name}'><ul><li><a href=x>A first link</a><li><a href=y>A second</a></ul></div><div class='comments'><div class='{name}'><p>Some reader.</p></div></div></article></body>"
    assert html_extract.extract(links) == "T One."


def test_html_formulas():
    assert html_extract.extract("<body><article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds, <object>as drawn</object> here.</article></body>") == "So x=2 holds, as drawn here."


@pytest.mark.parametrize("n", [20, 4000])
def test_html_article_in_parts(n):
    two = f"<body><nav>Menu</nav><div class=wrap><div class=intro><p>{'in tro ' * 50}</p></div><div class=rest>{'<p>rest of it</p>' * n}</div><div class=links><ul>{'<li><a href=x>a link</a>' * 9}</ul></div></div><div>footer line</div></body>"
    assert html_extract.extract(two.replace("<div class=links>", "<aside>").replace("</ul></div>", "</ul></aside>")) == ("in tro " * 50 + "rest of it " * n).strip()
    head = f"<body><article><h1>The head</h1><div class=content>{'<p>rest of it</p>' * n}</div><p>Tail.</article></body>"
    assert html_extract.extract(head) == "The head " + "rest of it " * n + "Tail."


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "x", "<a \"" * 50_000, "<div>" * 20_000 + "</b>" * 50_000, "<b>t" * 50_000, "<div class=ad>t" * 30_000, "<b>" * 30_000 + "<hr>" * 30_000, "<dl><dt><dl>" + "<b>" * 20_000 + "<dt>x</dt>" * 20_000, "<ul>" + "<li><b>x" * 50_000, "<table>" + "<tr><td>x" * 50_000, "<" * 200_000, "<a b=\"" * 50_000, "<a b=\">" * 50_001, "<a b='" * 50_000 + ">", "<script>" * 50_000, "<article>" + "<p>some words &amp; " * 250_000])
def test_html_takes_time_in_proportion(page):
    began = time.process_time()
    html_extract.extract(page)
    assert time.process_time() - began < 30


def test_html_votes_against_plain_sums(spark):
    rng = random.Random(2)
    rows = [(i, f"https://h{i % 4}.org/{i}", f"<body><div class=a{i}>{'one two ' * rng.randint(0, 60)}</div><div class='b c'>{'three ' * rng.randint(1, 60)}<section><p>more text</section></div></body>") for i in range(60)]
    want = {}
    for _, url, page in rows:
        own = {p: s for p, (s, _) in html_extract._weigh(html_extract.parse(page)).items()}
        best = sorted(own.items(), key=lambda x: (-x[1], x[0]))[: html_extract.PATHS]
        for p, s in best:
            k = (url.split("/")[2], p)
            want[k] = want.get(k, 0.0) + s * s / sum(t * t for _, t in best)
    pages = made(spark, rows, "page_id long, url string, html string")
    voted = html_extract.votes(pages)
    assert {(r["host"], r["path"]): r["votes"] for r in voted.collect()} == pytest.approx(want, abs=1e-5)
    for r in html_extract.winning_paths(voted).collect():
        mine = sorted(((-v, p) for (h, p), v in want.items() if h == r["host"]))
        assert r["paths"][0] == mine[0][1] and len(r["paths"]) <= html_extract.PATHS
    paths = {r["host"]: r["paths"] for r in html_extract.winning_paths(voted).collect()}
    got = {r["page_id"]: r["text"] for r in html_extract.html_extract(pages).collect()}
    assert all(got[i] == html_extract.extract(page, paths[url.split("/")[2]]) for i, url, page in rows)


def test_html_hosts_and_odd_rows(spark):
    rows = [(i, f"https://h{i % 3}.org/{i}", PAGE.replace("{n}", str(i))) for i in range(30)]
    rows += [(100, None, None), (101, "x", ""), (102, "https://h1.org/z", "<p>unclosed <b>bits"), (103, "https://h1.org/y", "plain &amp; simple"), (None, "https://h2.org", "<div><p>a</div><div>b")]
    got = html_extract.html_extract(made(spark, rows, "page_id long, url string, html string")).collect()
    text = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows) and all(text[i] == WANT for i in range(30))
    assert (text[100], text[101], text[102], text[103]) == ("", "", "unclosed bits", "plain & simple")
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_extract.html_extract(made(spark, [], "page_id long, url string, html string")).count() == 0


def test_html_fixture(spark, sf):
    for r, h in ((r, r["html"]) for r in html_extract.html_extract(table(spark, sf, "pages")).join(table(spark, sf, "pages").select("page_id", "html"), "page_id").collect()):
        body = h[h.find("<article>") : h.find("</article>")]
        assert r["text"] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", body)).split())


# --- 4 --------------------------------------------------------------------------------------------------------------


def test_resample(spark, sf):
    docs, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    got = {r["doc_id"]: r for r in quality_classifier.resample(docs, labels).collect()}
    assert {i: r["kept"] for i, r in got.items()} == {r["doc_id"]: r["kept"] for r in quality_classifier.resample(docs, labels).collect()}
    q = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rate = lambda v: np.mean([got[i]["kept"] for i in q if q[i] == v])
    assert rate(1) > 0.85 > rate(0) + 0.2
    key = sorted((r["gumbel_key"] for r in got.values()), reverse=True)
    n = sum(r["kept"] for r in got.values())
    assert all(r["kept"] == (r["gumbel_key"] >= key[n - 1] - 1e-6) for r in got.values())
    odd = quality_classifier.resample(made(spark, ODD), labels, share=0.5).collect()
    assert len(odd) == len(ODD)
    assert quality_classifier.resample(docs.limit(0), labels).count() == 0
    assert quality_classifier.resample(made(spark, ODD), labels.limit(0)).count() == len(ODD)


def test_weights_against_brute_force(spark):
    rng, words = random.Random(3), vocabulary(40)
    rows = [(d, " ".join(prose(rng.randint(0, 12), rng, words))) for d in range(50)] + [(60, None), (61, ""), (62, "a b"), (62, "a b")]
    label = {d: d % 2 for d in range(0, 40, 3)}
    feature = lambda t: [quality_classifier._features(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]))[0].tolist()][0]
    wanted, every = np.ones(quality_classifier.BUCKETS), np.ones(quality_classifier.BUCKETS)
    for d, t in rows:
        f = feature(t)
        w = (t or "").split()
        assert len(f) == len(w) + max(0, len(w) - 1)
        for x in f:
            every[x] += 1
            wanted[x] += label.get(d) == 1
    ratio = np.log(wanted / wanted.sum()) - np.log(every / every.sum())
    got = quality_classifier.resample(made(spark, rows), made(spark, list(label.items()), "doc_id long, quality int"), share=0.3).collect()
    for r in got:
        text = [t for d, t in rows if d == r["doc_id"]][0]
        assert r["log_weight"] == pytest.approx(sum(ratio[x] for x in feature(text)), abs=1e-9) and r["n_features"] == len(feature(text))
    # the largest keys stay, ties together; the noise is that of the standard Gumbel law
    key = sorted((r["gumbel_key"] for r in got), reverse=True)
    least = key[int(np.ceil(0.3 * len(rows))) - 1]
    assert all(r["kept"] == (r["gumbel_key"] >= least - 1e-6) for r in got) and len({(r["gumbel_key"], r["kept"]) for r in got if r["doc_id"] == 62}) == 1
    noise = sorted(r["gumbel_key"] - r["log_weight"] for r in quality_classifier.resample(made(spark, [(d, None) for d in range(2000)]), made(spark, [], "doc_id long, quality int")).collect())
    assert max(abs(np.exp(-np.exp(-x)) - (i + 0.5) / 2000) for i, x in enumerate(noise)) < 0.05


def test_kth_largest(spark):
    rng = random.Random(2)
    v = [rng.choice([rng.randint(-(1 << 63), (1 << 63) - 1), rng.randint(-5, 5)]) for _ in range(200)]
    df = spark.createDataFrame([(x,) for x in v] + [(None,)], "v long")
    for k in (1, 2, 77, 200):
        assert quality_classifier.kth_largest(df, k) == sorted(v, reverse=True)[k - 1]
    assert quality_classifier.kth_largest(df, 201) is None


# --- 5 --------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [3, 64, 1 << 18])
def test_token_counts(spark, block):
    rows = ODD + [(10 + i, "word " * (i % 11)) for i in range(60)]
    got = token_counts.token_counts(made(spark, rows, "doc_id short, text string").repartition(3), block=block).collect()
    enc = token_counts._encoding(token_counts.TOKENIZER)
    want = sorted((str(i), len(enc.encode_ordinary(t or ""))) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == want
    assert token_counts.token_counts(made(spark, [])).count() == 0


def test_flat_files(spark, tmp_path):
    end = token_counts.END
    np.array([1, 2, end, end, 5, 6, 7, 8, 9, end, 4], "<u2").tofile(tmp_path / "a.bin")
    np.array([end], "<u2").tofile(tmp_path / "b.bin")
    (tmp_path / "c.bin").write_bytes(b"")
    (tmp_path / "d.bin").write_bytes(np.array([3, 3], "<u2").tobytes() + b"x")
    for block in (1, 2, 4, 100):
        got = token_counts.scan(token_counts.read_flat(spark, f"file://{tmp_path}", block=block)).collect()
        files = {}
        for r in sorted(got, key=lambda r: r["ordinal"]):
            files.setdefault(r["file"], []).append(r["n_tokens"])
        assert files == {"a.bin": [2, 0, 5, 1], "b.bin": [0], "d.bin": [2]}


def test_flat_round_trip(spark, tmp_path):
    rows = [(1, "some words <|endoftext|>"), (2, None), (3, "é" * 50), (4, "")]
    ids = token_counts.write_flat(made(spark, rows).repartition(1).sortWithinPartitions("doc_id"), f"file://{tmp_path}/flat").collect()
    assert [(r["file"], r["ordinal"], r["doc_id"]) for r in ids] == [("part-000000.bin", k, k + 1) for k in range(4)]
    t = np.fromfile(tmp_path / "flat" / "part-000000.bin", "<u2")
    enc = token_counts._encoding(token_counts.TOKENIZER)
    parts = np.split(t, np.flatnonzero(t == token_counts.END) + 1)
    assert [enc.decode(p[:-1].tolist()) for p in parts[:-1]] == [x or "" for _, x in rows] and not len(parts[-1])


# --- 6 --------------------------------------------------------------------------------------------------------------


def test_language_id(spark, sf):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    got = {r["doc_id"]: r for r in langid.language_id(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r["held_out"]} == set(held)
    assert np.mean([got[i]["lang_pred"] == truth[i] for i in held]) > 0.97
    model = langid.fit(docs)
    letters = [(40, "a"), (41, "é"), (42, "I"), (43, "1a2"), (44, "中"), (45, "\U00010020"), (46, " ß ")]
    odd = {(r["doc_id"], r["lang_pred"]) for r in langid.identify(made(spark, [*ODD, (8, "12 34 %%"), *letters]), model).collect()}
    assert {i for i, p in odd if p == "und"} == {1, 2, 3, 8}
    none = langid.language_id(docs.limit(0))
    assert none.count() == 0
    assert {r["lang_pred"] for r in langid.language_id(docs.withColumn("lang", F.lit(None).cast("string"))).limit(5).collect()} == {"und"}


def brute_kneser_ney(texts):
    """A function of (history, character): interpolated Kneser-Ney by recursion over plain dictionaries."""
    grams = [{} for _ in range(5)]
    for t in texts:
        t = "   " + " ".join(re.findall(r"[^\W\d_]+", t.lower())) + " "
        for i in range(len(t) - 3):
            grams[4][t[i : i + 4]] = grams[4].get(t[i : i + 4], 0) + 1
    for k in (3, 2, 1):
        for g in grams[k + 1]:
            grams[k][g[1:]] = grams[k].get(g[1:], 0) + 1
    d = []
    for k in range(5):
        one, two = (sum(v == n for v in grams[k].values()) for n in (1, 2))
        d.append(min(max(one / (one + 2 * two) if one and two else 0.5, 0.1), 0.95))

    def p(history, c):
        k = len(history) + 1
        below = p(history[1:], c) if history else 1 / (len(grams[1]) + 50)
        after = {g: n for g, n in grams[k].items() if g[:-1] == history}
        if not after:
            return below
        return (max(after.get(history + c, 0) - d[k], 0) + d[k] * len(after) * below) / sum(after.values())

    return p


@pytest.mark.parametrize("at_once", [langid.TERMS_AT_ONCE, 40])
def test_kneser_ney_against_brute_force(spark, at_once):
    train = [(1, "The small house, the old house", "en"), (2, "a house; THE HOUSES?", "en"), (3, "das kleine Haus", "de"), (4, "häuser und 3 mäuse", "de"), (5, None, "en"), (6, "ohne", None)]
    model = langid.fit(made(spark, train, "doc_id long, text string, lang string"), terms_at_once=at_once)
    assert model.langs == ("de", "en") and (model.passes > 1) == (at_once == 40)
    asked = [(1, "the mouse houses"), (2, "kleine mäuse"), (3, "x"), (4, "zzz qq 中"), (5, "the small house"), (6, "12"), (7, None)]
    got = {r["doc_id"]: r for r in langid.entropies(made(spark, asked), model).collect()}
    for j, lang in enumerate(model.langs):
        p = brute_kneser_ney([t for _, t, x in train if x == lang and t])
        for i, t in asked:
            w = "   " + " ".join(re.findall(r"[^\W\d_]+", (t or "").lower())) + " "
            if w.strip():
                want = -np.mean([np.log(p(w[k : k + 3], w[k + 3])) for k in range(len(w) - 3)])
                assert got[i]["ce"][j] == pytest.approx(want, rel=1e-4) and got[i]["runs"] == len(w) - 3
            else:
                assert got[i]["runs"] == 0


def test_runs_of_long_texts_come_in_pieces():
    rng = random.Random(3)
    for most in (1, 5, 40):
        texts = ["".join(rng.choice("abÉ ß \n1.İΣ") for _ in range(rng.choice([0, 3, 30, 200]))).replace("Σ", "s" if most < 9 else "Σ") for _ in range(120)]
        want, got = [[] for _ in texts], [[] for _ in texts]
        for t, g in zip(*langid._runs(texts)[::-1]):
            want[t].append(int(g))
        for a, _, g, doc in langid._batches(texts, most):
            for t, x in zip(doc, g):
                got[a + t].append(int(x))
        assert got == want


def test_identify_keeps_clashing_columns(spark):
    docs = spark.createDataFrame([(i, "ab cd " * 9 if i % 2 else "xy zw " * 9, "pq"[i % 2], 7, "r") for i in range(40)], "doc_id long, text string, lang string, ce int, runs string")
    got = langid.identify(docs.select("doc_id", "text", "ce", "runs"), langid.fit(docs)).collect()
    assert all(r["ce"] == 7 and r["runs"] == "r" and r["lang_pred"] == "pq"[r["doc_id"] % 2] for r in got)


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGS", 1)
    with pytest.raises(ValueError, match="languages"):
        langid.fit(made(spark, [(1, "the small house", "en"), (2, "das kleine haus", "de")], "doc_id long, text string, lang string"))


# --- 7 --------------------------------------------------------------------------------------------------------------


def brute_lines(rows, words):
    """Line numbers that stand in an equal run of `words` or more in an earlier place, by comparing all pairs of lines."""
    docs = [(i, t.split("\n")) for i, t in sorted(rows)]
    docs = [(i, [(k, x, len(WORD.findall(x))) for k, x in enumerate(t) if WORD.search(x)]) for i, t in docs]
    out = {}
    for a in range(len(docs)):
        for b in range(a + 1):
            i, x = docs[a]
            y = docs[b][1]
            for shift in range(-len(x), len(y)):
                if a == b and shift >= 0:
                    continue
                run = []
                for j in range(len(x) + 1):
                    same = j < len(x) and 0 <= j + shift < len(y) and x[j][1] == y[j + shift][1]
                    if same:
                        run.append(j)
                    elif run:
                        if sum(x[r][2] for r in run) >= words:
                            out.setdefault(i, set()).update(x[r][0] for r in run)
                        run = []
    return out


def test_line_dedup_against_brute_force(spark):
    rng, words = random.Random(9), vocabulary(300)
    pool = [" ".join(prose(rng.choice([3, 8, 20, 60]), rng, words)) for _ in range(25)]
    rows = []
    for d in range(60):
        text = []
        for _ in range(rng.randint(0, 8)):
            text += pool[(k := rng.randrange(20)) : k + rng.randint(1, 4)] if rng.random() < 0.4 else [" ".join(prose(rng.randint(0, 30), rng, words))]
        rows.append((d, "\n".join(text)))
    got = {r["doc_id"]: r for r in line_dedup.line_dedup(made(spark, rows)).collect()}
    sure, may = brute_lines(rows, 50), brute_lines(rows, 25)
    for d, t in rows:
        lines, cut = t.split("\n"), got[d]["cut"] or []
        gone = {k for k in range(len(lines)) if any(r["first"] <= k <= r["last"] for r in cut)}
        real = {k for k in gone if WORD.search(lines[k])}
        assert real <= may.get(d, set())
        assert got[d]["text"] == "\n".join(x for k, x in enumerate(lines) if k not in gone)
    left = [(d, got[d]["text"]) for d, _ in rows]
    # of what surely repeats nothing is left whole: no passage of 50 words has an earlier copy in the old texts
    for d, t in rows:
        lines, run = t.split("\n"), 0
        gone = {k for k in range(len(lines)) if any(r["first"] <= k <= r["last"] for r in got[d]["cut"] or [])}
        assert not any(len(WORD.findall(lines[k])) >= 50 and k in sure.get(d, set()) and k not in gone for k in range(len(lines)))
    assert len(left) == len(rows)


def test_line_dedup_with_hot_lines_in_passages(spark):
    rng, words = random.Random(4), vocabulary(2000)
    line = lambda n: " ".join(prose(n, rng, words))
    hot = [line(30) for _ in range(4)]
    rows = [(d, f"{line(9)}\n{hot[d % 4]}\n{line(9)}") for d in range(20)]
    for k in range(30):
        passage = [line(rng.randint(8, 20)) for _ in range(rng.randint(2, 6))]
        passage.insert(rng.randint(0, len(passage)), hot[k % 4])
        rows += [(100 + 3 * k + x, "\n".join([line(9), *passage[x % 2 :], line(9)])) for x in range(3)]
    got = {r["doc_id"]: {i for c in r["cut"] or [] for i in range(c["first"], c["last"] + 1)} for r in line_dedup.line_dedup(made(spark, rows)).collect()}
    sure, may = brute_lines(rows, 50), brute_lines(rows, 25)
    assert len(sure) > 40
    for d, _ in rows:
        assert sure.get(d, set()) <= got[d] <= may.get(d, set())


def test_line_dedup_odd_rows(spark):
    long = " ".join(vocabulary(60))
    rows = [*ODD, (20, long), (21, f"mine\n{long}\nhers"), (21, f"mine\n{long}\nhers"), (22, f"{long}\n\n{long}")]
    docs = made(spark, rows).withColumns({c: F.lit(c) for c in ("cut", "t", "d", "u", "gone", "__t", "G")})
    got = line_dedup.line_dedup(docs).collect()
    assert len(got) == len(rows)
    text = {}
    for r in got:
        text.setdefault(r["doc_id"], []).append(r["text"])
        assert all(r[c] == c for c in ("t", "d", "u", "gone", "__t", "G"))
    assert text[20] == [long] and text[21] == ["mine\nhers"] * 2 and text[22] == [""] and text[1] == [None] and text[5] == ["one", "one"]
    assert line_dedup.line_dedup(made(spark, [])).count() == 0


def test_line_dedup_of_very_many_equal_lines(spark):
    rows = [(1, "\n".join(["ha ha ha"] * 20_000)), (2, "\n".join(["ha ha ha"] * 300 + ["bo"])), (3, "\n".join(["tick a b c d e", "tock f g h i j"] * 4000))]
    got = {r["doc_id"]: r for r in line_dedup.line_dedup(made(spark, rows)).collect()}
    assert got[1]["text"] == "ha ha ha" and got[1]["n_cut_lines"] == 19_999 and [tuple(c) for c in got[1]["cut"]] == [(1, 19_999)]
    assert got[2]["text"] == "bo" and got[3]["text"] == "tick a b c d e\ntock f g h i j"


def test_line_dedup_of_lines_from_many_documents(spark):
    """A document of n lines from n others costs in proportion to n, whether its lines are windows or short runs."""
    rng, words = random.Random(7), vocabulary(3000)
    took = {}
    for n in (1000, 8000):
        lines = [" ".join(prose(30 + 30 * (k % 2), rng, words)) for k in range(n)]
        rows = [(k, f"{x}\nmine {k}") for k, x in enumerate(lines)] + [(n + 1, "\n".join(f"{x}\nbetween {k}" for k, x in enumerate(lines)))]
        docs = made(spark, rows).repartition(4)
        began = time.perf_counter()
        got = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(docs).collect()}
        took[n] = time.perf_counter() - began
        left = got[n + 1].split("\n")  # lines of 60 words are sure to go, those of 30 may stay
        assert [x for x in left if x.startswith("between")] == [f"between {k}" for k in range(n)] and not set(left) & set(lines[1::2]) and all(got[k] == rows[k][1] for k in range(n))
    assert took[8000] < 8 * took[1000] + 5


def test_line_dedup_of_a_passage_in_half_of_all(spark):
    rng, words = random.Random(1), vocabulary(300)
    hot = "\n".join(" ".join(prose(12, rng, words)) for _ in range(6))
    rows = [(d, "\n".join([" ".join(prose(9, rng, words)), *([hot] if d % 2 else []), " ".join(prose(9, rng, words))])) for d in range(400)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(made(spark, rows)).collect()}
    assert got[1] == rows[1][1]
    assert all(got[d] == t.replace(hot + "\n", "") for d, t in rows if d != 1)


# --- 8 --------------------------------------------------------------------------------------------------------------


def brute_quality(text):
    t = text or ""
    w, lines = WORD.findall(t), t.split("\n")
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    at = {}
    for i, x in enumerate(tri):
        at.setdefault(x, []).append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
    full = [x for x in lines if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(full) - len(set(full)), len(covered)


def test_quality_measures_against_brute_force(spark):
    rng = random.Random(4)
    rows = ODD + [(100 + i, "".join(rng.choice("ab \n\t|#é\x0b") for _ in range(rng.randint(0, 120)))) for i in range(150)]
    for r in quality_rules.quality_rules(made(spark, rows).withColumn("n_words", F.lit("clash"))).collect():
        want = brute_quality(r["text"])
        assert tuple(r[k] for k in quality_rules.MEASURES) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["kept"] and r["base_failed"])


def test_repeats_rule_sorts_only_what_its_bound_leaves_open(spark, monkeypatch):
    """The rule says what the measure says, and a text of few equal windows is not sorted for it."""
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdefgh"[: rng.randint(2, 8)]) for _ in range(rng.randint(0, 90))) for _ in range(120)]
    docs = made(spark, list(enumerate(texts))).select("text", quality_rules._half_repeats(F.col("text"), F.regexp_count("text", F.lit(quality_rules.WORD))).alias("half"))
    got = docs.collect()
    assert {r["half"] for r in got} == {False, True}
    assert all(r["half"] == (100 * (m := brute_quality(r["text"]))[4] > 50 * m[0]) for r in got)
    monkeypatch.setattr(quality_rules, "_covered_by_repeats", lambda h: F.raise_error(F.lit("sorted")).cast("long"))
    plain = made(spark, [(1, " ".join(map(str, range(500)))), (2, "a b c " + " ".join(map(str, range(99))) + " a b c")])
    assert quality_rules.kept_rows(plain, rules=[], sample_rows=0).count() == 2


def test_repeats_of_texts_too_long_to_pack(spark, monkeypatch):
    rng = random.Random(6)
    docs = made(spark, [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60)))) for i in range(60)])
    for bits in (3, 24):
        monkeypatch.setattr(quality_rules, "_PLACE", bits)
        for r in quality_rules.quality_rules(docs, sample_rows=0).collect():
            assert r["n_repeat_words"] == brute_quality(r["text"])[4]


def test_cascade_order_changes_no_verdict(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text").unionByName(made(spark, ODD))
    rules = quality_rules.default_rules()
    a = sorted((str(r["doc_id"]), r["kept"]) for r in quality_rules.quality_rules(docs).collect())
    assert a == sorted((str(r["doc_id"]), r["kept"]) for r in quality_rules.quality_rules(docs, rules=rules[::-1], sample_rows=0).collect())
    kept = sorted(i for i, k in a if k)
    assert 0 < len(kept) < len(a)
    for x in (quality_rules.kept_rows(docs), quality_rules.kept_rows(docs, rules=rules[::-1], sample_rows=0)):
        assert x.columns == docs.columns and sorted(str(r["doc_id"]) for r in x.collect()) == kept
    every = [*quality_rules.base_rules(), *rules]
    order = [r.name for r in quality_rules.plan_cascade(docs, "text", every)]
    assert sorted(order) == sorted(r.name for r in every) and order == [r.name for r in quality_rules.plan_cascade(docs, "text", every)]
    assert order.index("few_words") < order.index("repeats")
    assert quality_rules.quality_rules(docs.limit(0)).count() == 0 and quality_rules.kept_rows(docs.limit(0)).count() == 0


def test_cascade_asks_dear_measures_last(spark):
    """A text that a cheap rule rejects is not worked on by a dear one."""
    boom = quality_rules.Rule("boom", lambda m, t: F.raise_error(F.concat(F.lit("asked "), t)).cast("boolean"), lambda m, t: 1e9 * F.length(t))
    docs = made(spark, [(1, "few words"), (2, None)])
    order = [*quality_rules.base_rules(), boom]
    assert quality_rules.kept_rows(docs, rules=[boom], sample_rows=0).count() == 0 and order[0].name == "few_words"


# --- 9 --------------------------------------------------------------------------------------------------------------


def brute_sets(rows):
    out = {}
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def brute_components(sets):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a, x in enumerate(ids):
        for y in ids[a + 1 :]:
            both = len(sets[x] & sets[y])
            if both and 100 * both >= 75 * (len(sets[x]) + len(sets[y]) - both):
                p, q = find(x), find(y)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def near_copies(n, seed=6):
    rng, words, rows = random.Random(seed), vocabulary(800), []
    common = prose(40, rng, words)
    for d in range(n):
        if rows and rng.random() < 0.6:
            w = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, 3)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(words)
        else:
            w = prose(rng.choice([0, 2, 5, 30, 120]), rng, words) + (common if rng.random() < 0.5 else [])
        rows.append((d, " ".join(w)))
    return rows


@pytest.mark.parametrize("common", [1000, 8])
def test_jaccard_against_brute_force(spark, monkeypatch, common):
    monkeypatch.setattr(jaccard_join, "COMMON", common)
    rows = near_copies(250)
    sets = brute_sets(rows)
    want = brute_components(sets)
    got = jaccard_join.jaccard_classes(made(spark, rows)).collect()
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in sets.items()}
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_jaccard_short_texts_of_common_shingles(spark):
    n = jaccard_join.COMMON + 50
    rows = [(0, "A B C D E F G"), (1, "p q r s t u v w")] + [(2 + i, f"A B C D E F G x{i}") for i in range(n)] + [(2 + n + i, f"y{i} p q r s t u v w") for i in range(n)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_classes(made(spark, rows)).collect()}
    assert got == {i: 0 if i == 0 or 2 <= i < 2 + n else 1 for i, _ in rows}


def test_jaccard_short_texts_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "COMMON", 8)
    rng, words = random.Random(3), vocabulary(400)
    cores = [prose(n, rng, words) for n in (7, 8, 9, 12, 16, 20, 24)]
    rows = [(7 * k + d, " ".join(prose(rng.randint(0, 2), rng, words) + c[rng.randint(0, 1) :] + prose(rng.randint(0, 3), rng, words))) for k in range(40) for d, c in enumerate(cores)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_classes(made(spark, rows)).collect()}
    assert got == brute_components(brute_sets(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_tree_bounds_lose_no_link(seed):
    rows = near_copies(300, seed)
    data = [np.frombuffer(t.encode(), np.uint8) for _, t in rows]
    offs = np.concatenate([[0], np.cumsum([len(x) for x in data])])
    h, ptr = jaccard_join.shingles(np.concatenate(data), offs)
    sets = [h[a:b] for a, b in zip(ptr[:-1], ptr[1:])]
    keep = [i for i, s in enumerate(sets) if len(s)]
    links = jaccard_join.tree_links(np.array(keep), [sets[i] for i in keep])
    root = {i: i for i in keep}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    want = brute_components({i: s for i, s in brute_sets(rows).items() if s})
    assert {i: find(i) for i in keep} == want


def test_tree_verifies_few_pairs(monkeypatch):
    """Texts of one form (half of each is alike) and near copies: links as by brute force, and few sets are met in full."""
    rng = np.random.default_rng(5)
    draw = lambda n: rng.integers(0, 1 << 64, n, dtype=np.uint64)
    form, base = draw(200), draw(400)
    sets = [np.unique(np.concatenate([form, draw(200)])) for _ in range(300)]
    sets += [np.unique(np.concatenate([base[rng.permutation(400)[:380]], draw(20)])) for _ in range(300)]
    sets += [np.unique(np.concatenate([x[rng.permutation(len(x))[:360]], draw(40)])) for x in sets[:40]]
    met, plain = [0], np.intersect1d
    monkeypatch.setattr(np, "intersect1d", lambda *a, **k: (met.__setitem__(0, met[0] + 1), plain(*a, **k))[1])
    links = jaccard_join.tree_links(np.arange(len(sets)), sets)
    met = met[0]
    comp = np.arange(len(sets))
    for a, b in links:
        comp[comp == comp[b]] = comp[a]
    want = np.arange(len(sets))
    for a in range(len(sets)):
        for b in range(a):
            i = len(plain(sets[a], sets[b], assume_unique=True))
            if 100 * i >= 75 * (len(sets[a]) + len(sets[b]) - i):
                want[want == want[b]] = want[a]
                assert comp[a] == comp[b]
    assert len(set(comp)) == len(set(want)) == 301 and len(links) == len(sets) - 301
    assert met < 3 * len(sets)


@pytest.mark.parametrize("pivots", [32, 2, 0])
def test_jaccard_chunks_lose_no_link(spark, monkeypatch, pivots):
    monkeypatch.setattr(jaccard_join, "CHUNK", 7)
    monkeypatch.setattr(jaccard_join, "PIVOTS", pivots)
    rng, words = random.Random(pivots), vocabulary(500)
    rows = near_copies(100, 8)
    core = prose(150, rng, words)
    # sizes that run over several bands, each linked to the next
    rows += [(len(rows) + k, " ".join(core[: 30 + 6 * k])) for k in range(20)]
    for g in range(2):  # chains: each is near the one before, ends are not near each other
        w = prose(60, rng, words)
        for _ in range(40):
            w[rng.randrange(60)] = rng.choice(words)
            rows.append((len(rows), " ".join(w)))
    want = brute_components(brute_sets(rows))
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_classes(made(spark, rows)).collect()}
    assert got == want
    if pivots == 32:
        kept = jaccard_join.jaccard_dedup(made(spark, rows))
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, c in want.items() if i == c)


def test_jaccard_chunks_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK_BYTES", 5000)
    rows = near_copies(150, 9)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_classes(made(spark, rows)).collect()}
    assert got == brute_components(brute_sets(rows))


def test_jaccard_odd_rows(spark):
    odd = {(str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_classes(made(spark, ODD)).collect()}
    assert {("1", 0, 1), ("2", 0, 2), ("3", 0, 3), ("5", 1, 5), ("6", 2, 6), ("None", 3, None)} <= odd
    assert jaccard_join.jaccard_classes(made(spark, [])).count() == 0
    same = "a b c d e f g h"
    rows = [*ODD, (None, same), (None, same), (30, same), (30, same), (30, "x " + same), (31, None), (31, None)]
    docs = made(spark, rows).withColumns({c: F.lit(c) for c in ("t", "d", "u", "n", "r", "cls", "comp", "__d", "__n")})
    kept = jaccard_join.jaccard_dedup(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r["doc_id"]), str(r["text"])[:9]) for r in kept.collect())
    first = "a b c d e" if jaccard_join.jaccard_dedup(made(spark, [(30, same), (30, "x " + same)])).first()["text"] == same else "x a b c d"
    want = [(str(i), str(t)[:9]) for i, t in [*(r for r in ODD[:3]), (5, "one"), *ODD[6:], (31, None), (31, None), (30, first)]]
    # the null row of seven words is 0.75 like the eight and more words of 30
    assert got == sorted(want)
    assert jaccard_join.jaccard_dedup(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    e = [(rng.randrange(-200, 200), rng.randrange(-200, 200)) for _ in range(150)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5)]
    root = {v: v for x in e for v in x}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in e:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    got = {r["node"]: r["comp"] for r in jaccard_join.components(spark.createDataFrame(e, "u long, v long")).collect()}
    assert all(got.get(i, i) == find(i) for i in root)


# --- 10 -------------------------------------------------------------------------------------------------------------


def test_segments_are_all_maximal():
    rng = random.Random(2)
    for _ in range(200):
        s = [rng.choice([2.0, 1.0, -0.5, -1.75]) for _ in range(rng.randint(1, 25))]
        at = np.array([i for i, v in enumerate(s) if v > 0], int)
        sums = np.concatenate([[0.0], np.cumsum(s)])
        got = toxicity.segments(at, sums[at], sums[at + 1])

        def brute(a, b):
            if a >= b:
                return []
            best = max(((sum(s[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
            if best is None or best[0] <= 0:
                return []
            return brute(a, best[3]) + [(best[3], best[4], best[0])] + brute(best[4], b)

        assert sorted(round(x[2], 6) for x in got) == sorted(round(x[2], 6) for x in brute(0, len(s)))


def test_toxic_words_and_scores_against_brute_force(spark, monkeypatch):
    rng, clean, foul = random.Random(7), vocabulary(60), [f"foul{k}" for k in range(6)]
    rows = [(d, " ".join(prose(rng.randint(0, 40), rng, clean) + (prose(rng.randint(2, 6), rng, foul) if d % 4 == 0 else ["calm", "mild"] * 6) + prose(rng.randint(0, 20), rng, clean))) for d in range(240)]
    rows += [(300, None), (301, ""), (302, "foul1 foul1 foul2")]
    label = {d: int(d % 4 == 0) for d, _ in rows if d % 3 and d < 240}
    docs, labels = made(spark, rows), made(spark, list(label.items()), "doc_id long, toxic int")
    counts = toxicity.word_counts(docs.join(labels, "doc_id", "left").select("text", F.col("toxic").alias("mark")))
    total = counts.agg(*(F.sum(c).alias(c) for c in ("c0", "t0", "c1", "t1", "every"))).first().asDict()
    words, gain = toxicity._gains(counts, total, (0, 1), 1.0, None)
    n = [{}, {}, {}]
    for d, t in rows:
        for w in (t or "").split():
            for k in {2, label.get(d, 2)}:
                n[k][w] = n[k].get(w, 0) + 1
    size, want = [sum(x.values()) for x in n], {}
    for w, all_ in n[2].items():
        c, t, prior = n[0].get(w, 0), n[1].get(w, 0), all_ * size[1] / size[2]
        if c + t:
            lo = np.log((t + prior) / (2 * size[1] - t - prior)) - np.log((c + prior) / (size[0] + size[1] - c - prior))
            se = np.sqrt(1 / (t + prior) + 1 / (c + prior))
            if lo - se >= 1:
                want[w] = lo - se
            elif lo + se < toxicity.BASE:
                want[w] = max(lo + se, toxicity.FLOOR)
    hashed = {int(toxicity.Words(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)])).hash[0]): g for w, g in want.items()}
    assert {int(h): g for h, g in zip(words, gain)} == pytest.approx(hashed) and min(want.values()) < 0 < max(want.values())

    model = toxicity._from(words, gain, 1.0)
    model = toxicity.Model(model.words, model.gain, model.base, 0.9, 0.05, (-3.0, 2.5))
    for r in toxicity.score(docs, model).collect():
        s = [want.get(w, toxicity.BASE) for w in (dict(rows)[r["doc_id"]] or "").split()]

        def best(a, b):
            top = max(((sum(s[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
            return best(a, top[3]) + [top[0]] + best(top[4], b) if top[0] > 0 else []

        e = 0.0
        for x in best(0, len(s)):
            p = 1 - np.exp(-0.05 * len(s) * np.exp(-0.9 * x))
            e -= np.log10(max(p, 1e-300)) if p < 0.5 else 0
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-(-3 + 2.5 * np.log1p(min(e, 300))))), abs=0.03)
        assert r["predicted"] == int(r["score"] >= 0.7)


def test_toxicity(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")
    labels = table(spark, "/root/testdata/sf0.1", "labels")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i]["held_out"] for i in held)
    tp = sum(got[i]["predicted"] for i in held if truth[i])
    fp = sum(got[i]["predicted"] for i in held if not truth[i])
    assert tp >= 0.75 * sum(truth[i] for i in held) and fp <= 0.1 * tp
    bad, good = ([got[i]["score"] for i in held if truth[i] == k] for k in (1, 0))
    assert sum((a > b) + (a == b) / 2 for a in bad for b in good) >= 0.94 * len(bad) * len(good)
    model = toxicity.fit(docs, labels)
    with pytest.MonkeyPatch.context() as patch, pytest.raises(ValueError, match="words"):
        patch.setattr(toxicity, "MAX_WORDS", 10)
        toxicity.fit(docs, labels)
    odd = toxicity.score(made(spark, ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r["score"] <= 1 and r["predicted"] == 0 for r in odd)
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert {r["predicted"] for r in toxicity.toxicity(made(spark, ODD), labels.limit(0)).collect()} == {0}


def test_language_calibrates_on_every_row(spark, monkeypatch):
    seen, plain = [], langid.entropies
    monkeypatch.setattr(langid, "entropies", lambda docs, *a: (seen.append(docs.count()), plain(docs, *a))[1])
    langid.fit(spark.range(20_100).selectExpr("id as doc_id", "if(id % 2 = 0, 'the cat', 'le chat') as text", "if(id % 2 = 0, 'en', 'fr') as lang"))
    assert seen == [20_100]
