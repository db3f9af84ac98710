"""Corpus operators: lines, classes, findings, anchors, integrity."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import norm_integrity
from ..sources.tables import sized


def lines(docs: DataFrame, text: str = "text", *keep: str) -> DataFrame:
    """doc_id, kept columns, line_no (from 1), line: a row for each line; order is explicit from here on."""
    return docs.select("doc_id", *keep, F.posexplode(F.split(text, "\n", -1)).alias("i", "line")).select("doc_id", *keep, (F.col("i") + 1).alias("line_no"), "line")


def line_class(line: Column) -> Column:
    """The first class that fits a line."""
    rules = [("blank", r"^\s*$"), ("fence", r"^```"), ("heading", r"^#{1,6} "), ("quote", r"^>"), ("list", r"^[-*+] "), ("numbered", r"^[0-9]+[.)] "), ("table", r" \| "), ("licence", r"^Licensed under"), ("shout", r"!!"), ("sentence", r"[.!?]$")]
    out = F.when(F.lit(False), F.lit(""))
    for name, pattern in rules:
        out = out.when(line.rlike(pattern), F.lit(name))
    return out.otherwise("other")


def toggled(line_df: DataFrame, marker: Column, name: str = "inside") -> DataFrame:
    """Whether an odd number of markers stands up to and with a line: fence parity, in one window a document."""
    w = W.partitionBy("doc_id").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    return line_df.withColumn(name, F.sum(marker.cast("int")).over(w) % 2 == 1)


#: Checks: name, severity, pattern (in what Java and RE2 share).
RULES = [
    ("email", "error", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    ("url", "warn", r"https?://[^ \n]+"),
    ("long_number", "warn", r"[0-9]{4,}"),
    ("shouting", "info", r"[A-Z]{4,}"),
    ("symbol_run", "warn", r"[#$%&*]{3}"),
    ("licence", "info", r"Licensed under"),
]
SEVERITY = {"error": 0, "warn": 1, "info": 2}


def findings(docs: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """doc_id, check, severity, n: how often each rule's pattern is found in a document (only where it is).

    The rules are plan constants, so a document is scanned once and no rule table is joined; a document in which the
    alternation of all patterns finds nothing is dropped before they are counted one by one."""
    some = docs.where(F.col("text").rlike("|".join(f"(?:{p})" for _, _, p in rules)))
    counted = F.array(*(F.struct(F.lit(c).alias("check"), F.lit(s).alias("severity"), F.regexp_count("text", F.lit(p)).cast("long").alias("n")) for c, s, p in rules))
    return some.select("doc_id", *(c for c in ("source", "lang") if c in docs.columns), F.explode(counted).alias("f")).select("doc_id", *(c for c in ("source", "lang") if c in docs.columns), "f.*").where("n > 0")


def severity_rank(c: Column) -> Column:
    """error, warn, info; others last (9)."""
    out = F.when(F.lit(False), F.lit(0))
    for k, v in SEVERITY.items():
        out = out.when(c == k, v)
    return out.otherwise(9)


def allowed(found: DataFrame, rules: DataFrame) -> DataFrame:
    """found with `allowed`: the reason of the first rule (by rule_order) whose check and source fit ('*' fits all); only
    warnings can be allowed. rules: rule_order, check, source, reason; broadcast where they are few."""
    r = sized(rules.withColumnsRenamed({"check": "r_check", "source": "r_source"}))
    fits = (F.col("severity") == "warn") & F.col("r_check").isin("*") | (F.col("severity") == "warn") & (F.col("r_check") == F.col("check"))
    hit = found.join(r, fits & ((F.col("r_source") == "*") | (F.col("r_source") == F.col("source"))), "left")
    # a finding has few rules: the first is a grouped minimum, not a sort
    return hit.groupBy(*found.columns).agg(F.min_by("reason", "rule_order").alias("allowed"))


def integrity(docs: DataFrame) -> DataFrame:
    """doc_id, sha256 and n of the normalised text."""
    t = norm_integrity(F.col("text"))
    return docs.select("doc_id", F.sha2(t, 256).alias("sha256"), F.length(t).cast("long").alias("n"))


def integrity_diff(base: DataFrame, now: DataFrame) -> DataFrame:
    """doc_id, status (ok, mismatch, missing, new) of two snapshots of integrity()."""
    a, b = base.select("doc_id", F.col("sha256").alias("a")), now.select("doc_id", F.col("sha256").alias("b"))
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "new").when(F.col("a") == F.col("b"), "ok").otherwise("mismatch")
    return a.join(b, "doc_id", "full_outer").select("doc_id", status.alias("status"))


def fill_forward(df: DataFrame, part: str, order: str, value: Column, name: str, before: bool = False) -> DataFrame:
    """The last non-null value up to (or, with before, strictly before) a row: forward fill and as-of anchors."""
    w = W.partitionBy(part).orderBy(order).rowsBetween(W.unboundedPreceding, -1 if before else 0)
    return df.withColumn(name, F.last(value, True).over(w))


def segments(df: DataFrame, part: str, order: str, starts: Column) -> DataFrame:
    """Starts and, half open, ends of segments: a segment ends where the next begins, the last at null."""
    s = df.where(starts).select(part, F.col(order).alias("first"))
    return s.withColumn("past", F.lead("first").over(W.partitionBy(part).orderBy("first")))


def greedy_spans(spans: Column) -> Column:
    """Of an array of structs (first, past): those taken greedily by first, then longest, that overlap none before."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["first"].alias("first"), (-s["past"]).alias("neg"))))
    empty = F.array().cast("array<struct<first: int, neg: int>>")
    done = F.aggregate(ordered, empty, lambda out, s: F.when((F.size(out) == 0) | (s["first"] >= -F.element_at(out, -1)["neg"]), F.concat(out, F.array(s))).otherwise(out))
    return F.transform(done, lambda s: F.struct(s["first"].alias("first"), (-s["neg"]).alias("past")))


def multiset_diff(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key, n: how often more a key is in a than in b, where it is (counts saturate at 0)."""
    x = a.groupBy(key).agg(F.count("*").alias("x"))
    y = b.groupBy(key).agg(F.count("*").alias("y"))
    return x.join(y, key, "left").select(key, (F.col("x") - F.coalesce("y", F.lit(0))).alias("n")).where("n > 0")


def checked_cards(cards: DataFrame, pages: DataFrame, card: str, code: str, source: str) -> DataFrame:
    """cards with status: `no source` (no source row in the card's text), `unknown code` (none that pages has), `mismatch`
    (the source row lacks what pages expects of the code), else `ok`.

    code and source are patterns with one group; pages: code, expected, one row a code, broadcast where they are few."""
    x = cards.withColumn("__s", F.regexp_extract(card, source, 1)).withColumn("__c", F.regexp_extract(card, code, 1))
    x = x.join(sized(pages.select(F.col("code").alias("__c"), F.col("expected").alias("__e"))), "__c", "left")
    status = F.when(F.col("__s") == "", "no source").when(F.col("__e").isNull(), "unknown code").when(~F.contains("__s", "__e"), "mismatch").otherwise("ok")
    return x.withColumn("status", status).drop("__s", "__c", "__e")


def allowed_by(found: DataFrame, rules: list[tuple[str, str, str, str, str]]) -> DataFrame:
    """found (check, source, severity, found, context) with `allowed`, the reason of the first rule that fits, else null.

    rules in order: check, source, found ('*' fits all), a pattern that the context must fit ('' fits all), reason. Only
    warnings can be allowed. Rules are plan constants, so nothing is joined and the first is the first branch."""
    out = F.when(F.col("severity") != "warn", F.lit(None).cast("string"))
    for check, source, what, pattern, reason in rules:
        fits = F.lit(True)
        for column, want in (("check", check), ("source", source), ("found", what)):
            fits = fits if want == "*" else fits & (F.col(column) == want)
        out = out.when(fits & F.col("context").rlike(pattern) if pattern else fits, F.lit(reason))
    return found.withColumn("allowed", out)


def claimed_pages(pages: DataFrame, labels: list[tuple[str, str]]) -> DataFrame:
    """label, place (its priority, from 1), page: the first page (page, text) that fits each label's pattern and that no
    label before it has claimed; null if there is none.

    Each label looks at so many of its first pages as there are labels, which is as many as can be claimed before it."""
    hits = F.array_compact(F.array(*(F.when(F.col("text").rlike(p), F.lit(i + 1)) for i, (_, p) in enumerate(labels))))
    x = pages.select("page", F.explode(hits).alias("place"))
    first = x.withColumn("r", F.row_number().over(W.partitionBy("place").orderBy("page"))).where(F.col("r") <= len(labels)).collect()
    taken, out = set(), []
    for i, (label, _) in enumerate(labels):
        page = next((p for p in sorted(r["page"] for r in first if r["place"] == i + 1) if p not in taken), None)
        taken.add(page)
        out.append((label, i + 1, page))
    return pages.sparkSession.createDataFrame(out, f"label string, place int, page {dict(pages.dtypes)['page']}")


def card_table(rows: Column, keys: list[str]) -> Column:
    """Rows `Key: value` as lines of a two-column Markdown table; a row of none of the keys fails the query."""
    known = "|".join(keys)
    cell = lambda r: F.when(r.rlike(f"^({known}): "), F.concat(F.lit("| "), F.regexp_extract(r, f"^({known}): ", 1), F.lit(" | "), F.regexp_replace(r, f"^({known}): ", ""), F.lit(" |"))).otherwise(F.raise_error(F.concat(F.lit("unknown row "), r)))
    return F.array_join(F.transform(rows, cell), "\n")


def heading_depth(line: Column) -> Column:
    """A numbered heading with as many # as its number has parts (three or four); other lines as they are."""
    parts = F.size(F.split(F.regexp_extract(line, r"^#+ ([0-9.]+)", 1), r"\."))
    return F.when(line.rlike(r"^#+ [0-9]+(\.[0-9]+){2,3} "), F.concat(F.repeat(F.lit("#"), parts), F.regexp_replace(line, "^#+", ""))).otherwise(line)


def units(line_df: DataFrame, opens: Column) -> DataFrame:
    """Lines from a document's first opening on, with unit: the number of the opening that they stand under."""
    w = W.partitionBy("doc_id").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    return line_df.withColumn("unit", F.sum(opens.cast("int")).over(w)).where("unit > 0")


def filled(text: Column, values: dict[str, str]) -> Column:
    """text with each {{key}} replaced by its value; a key that values lacks fails the query. values: plan constants."""
    for k, v in values.items():
        text = F.replace(text, F.lit("{{" + k + "}}"), F.lit(v))
    left = F.regexp_extract(text, r"\{\{([^}]*)\}\}", 1)
    return F.when(left == "", text).otherwise(F.raise_error(F.concat(F.lit("no value for "), left)))


def one_citation(line: Column, label: str) -> Column:
    """A line `label: a; b; c (remark)` with its first citation and the remark at its end alone; other lines as they are."""
    pattern = rf"^({label}: )([^;()]*[^;() ])[^()]*?( \([^()]*\))?$"
    return F.when(line.rlike(pattern), F.regexp_replace(line, pattern, "$1$2$3")).otherwise(line)


def titled_units(docs: DataFrame, titles: list[str], opens: str, leader: str) -> DataFrame:
    """doc_id, unit (from 1), title, text: a text from its first `opens` on (all of it if there is none) up to its first
    `leader` (a pattern), cut at the first place of each known title that it has. What stands before the first title is left
    out; titles that begin at one place are units in their order, all but the last empty. Null texts have no units."""
    at = F.instr("text", F.lit(opens))
    body = F.regexp_replace(F.when(at > 0, F.substr("text", at)).otherwise(F.col("text")), f"(?s){leader}.*$", "")
    x = docs.select("doc_id", body.alias("__b"))
    places = F.array_compact(F.array(*(F.when(F.instr("__b", F.lit(t)) > 0, F.struct(F.instr("__b", F.lit(t)).alias("a"), F.lit(t).alias("title"))) for t in titles)))
    x = x.withColumn("__p", F.sort_array(places))
    end = lambda i: F.coalesce(F.get(F.col("__p"), i + 1)["a"], F.length("__b") + 1)
    cut = F.transform("__p", lambda p, i: F.struct((i + 1).alias("unit"), p["title"].alias("title"), F.substr("__b", p["a"], end(i) - p["a"]).alias("text")))
    return x.select("doc_id", F.inline(cut))


def rendered(rows: DataFrame, pages: dict[str, str]) -> DataFrame:
    """The first column of rows, page, text: every page made for every row, {{column}} replaced by the row's value; a place
    that no column fills fails the query. pages: plan constants."""
    made = []
    for name, page in pages.items():
        text = F.lit(page)
        for c in rows.columns:
            text = F.replace(text, F.lit("{{" + c + "}}"), F.coalesce(F.col(c).cast("string"), F.lit("")))
        left = F.regexp_extract(F.lit(re.sub("|".join(re.escape("{{" + c + "}}") for c in rows.columns), "", page)), r"\{\{([^}]*)\}\}", 1)
        made.append(F.struct(F.lit(name).alias("page"), F.when(left == "", text).otherwise(F.raise_error(F.concat(F.lit("no value for "), left))).alias("text")))
    return rows.select(rows.columns[0], F.inline(F.array(*made)))


def appendix(parts: list[DataFrame], key: str) -> DataFrame:
    """key, text, sections: the lines of all parts (part, o, line, key) by part and then o, one text a key."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    lines = F.sort_array(F.collect_list(F.struct("part", "o", "line")))
    return every.groupBy(key).agg(F.array_join(F.transform(lines, lambda p: p["line"]), "\n").alias("text"), F.count_distinct("part").alias("sections"))
