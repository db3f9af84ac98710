"""Expansion, reconciliation and rewriting of lines: includes, ordinal joins, prefixes, folding, breaks, callouts, ranks."""

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..sources.tables import ship


def expand_includes(lines: DataFrame, files: DataFrame, pattern: str = r"^<!-- include: (\S+) -->$") -> DataFrame:
    """doc_id, line_no, sub_no, line: include lines replaced by the lines of the named file, one level deep.

    files: name, text. An include that no file answers fails the query; a nested include stays as it is."""
    name = F.when(F.col("line").rlike(pattern), F.regexp_extract("line", pattern, 1))
    x = lines.withColumn("__n", name).join(files.select(F.col("name").alias("__n"), F.col("text").alias("__t")), "__n", "left")
    body = F.when(F.col("__n").isNull(), F.array("line")).when(F.col("__t").isNull(), F.raise_error(F.concat(F.lit("missing include "), "__n"))).otherwise(F.split("__t", "\n", -1))
    return x.select("doc_id", "line_no", F.posexplode(body).alias("sub_no", "line"))


def ordinal_join(a: DataFrame, b: DataFrame, part: str, order_a: str, order_b: str) -> DataFrame:
    """part, k, a, b: the k-th row of either side by its order, null where one side is longer."""
    x = a.withColumn("k", F.row_number().over(W.partitionBy(part).orderBy(order_a))).select(part, "k", F.col(order_a).alias("a"))
    y = b.withColumn("k", F.row_number().over(W.partitionBy(part).orderBy(order_b))).select(part, "k", F.col(order_b).alias("b"))
    return x.join(y, [part, "k"], "full_outer")


def best_prefix(lines: DataFrame, labels: list[str], column: str = "line") -> DataFrame:
    """lines with `label`, the longest label that the line starts with (and a space after it), else null."""
    out = F.lit(None).cast("string")
    for x in sorted(labels, key=len):  # later branches wrap earlier ones, so the longest is asked first
        out = F.when(F.col(column).startswith(x + " "), F.lit(x)).otherwise(out)
    return lines.withColumn("label", out)


def fold_labelled(lines: DataFrame, label: Column, strict: bool = False) -> DataFrame:
    """doc_id, row, label, text: rows that a labelled line opens, with the lines after it that have no label joined on.

    Lines before the first label make row 0 of a null label, or with strict fail the query."""
    w = W.partitionBy("doc_id").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    x = lines.withColumn("__l", label).withColumn("row", F.count("__l").over(w))
    if strict:
        x = x.withColumn("row", F.when(F.col("row") > 0, F.col("row")).otherwise(F.raise_error(F.concat(F.lit("line before the first label: "), "line")).cast("long")))
    parts = F.sort_array(F.collect_list(F.struct("line_no", "line")))
    return x.groupBy("doc_id", "row").agg(F.max("__l").alias("label"), F.array_join(F.transform(parts, lambda p: p["line"]), " ").alias("text"))


def drop_repeated_headings(lines: DataFrame) -> DataFrame:
    """lines without a heading whose next line with text is the same heading."""
    w = W.partitionBy("doc_id").orderBy("line_no").rowsBetween(1, W.unboundedFollowing)
    nxt = F.first(F.when(F.col("line") != "", F.col("line")), True).over(w)
    return lines.withColumn("__n", nxt).where(~(F.col("line").startswith("#") & F.col("line").eqNullSafe(F.col("__n")))).drop("__n")


def section_headers(rows: DataFrame, part: str, order: str, title: str) -> DataFrame:
    """rows with `opens`: whether the title differs from the row before it."""
    before = F.lag(title).over(W.partitionBy(part).orderBy(order))
    return rows.withColumn("opens", ~F.col(title).eqNullSafe(before))


def paragraph_breaks(lines: DataFrame) -> DataFrame:
    """doc_id, line_no, sub_no, line: a blank line put between neighbours that both end a sentence."""
    ends = lambda c: F.coalesce(c.rlike(r"[.!?。！？]$"), F.lit(False))
    nxt = F.lead("line").over(W.partitionBy("doc_id").orderBy("line_no"))
    return lines.withColumn("__n", nxt).select("doc_id", "line_no", F.posexplode(F.when(ends(F.col("line")) & ends(F.col("__n")), F.array("line", F.lit(""))).otherwise(F.array("line"))).alias("sub_no", "line"))


def title_after(lines: DataFrame, marker: Column, most: int = 60) -> DataFrame:
    """Marker lines with `title`: the first of the next three lines that is short and has no inner stop, before another marker."""
    w = W.partitionBy("doc_id").orderBy("line_no")
    x = lines.withColumn("__m", marker)
    ahead = F.array(*(F.struct(F.lead("line", k).over(w).alias("t"), F.coalesce(F.lead("__m", k).over(w), F.lit(True)).alias("stop")) for k in (1, 2, 3)))
    zero = F.struct(F.lit(None).cast("string").alias("t"), F.lit(False).alias("done"))
    fits = lambda s: (F.length(s["t"]) <= most) & (s["t"] != "") & ~s["t"].rlike("[,;。，；]")
    step = lambda a, s: F.when(a["done"], a).when(s["stop"], F.struct(a["t"].alias("t"), F.lit(True).alias("done"))).when(fits(s), F.struct(s["t"].alias("t"), F.lit(True).alias("done"))).otherwise(a)
    return x.withColumn("__a", ahead).where("__m").select("doc_id", "line_no", "line", F.aggregate("__a", zero, step, lambda a: a["t"]).alias("title"))


def adjusted_difference(a: DataFrame, b: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """key, n: how often more a key is in a than in b once `expected` (key, times) additions are taken off, not below 0."""
    count = lambda df, name: df.groupBy(key).agg(F.count("*").alias(name))
    x = count(a, "x").join(count(b, "y"), key, "left").join(expected.groupBy(key).agg(F.sum("times").alias("t")), key, "left")
    left = F.greatest(F.col("x") - F.coalesce("t", F.lit(0)), F.lit(0)) - F.coalesce("y", F.lit(0))
    return x.select(key, left.alias("n")).where("n > 0")


def tidy_parentheses(text: str, passes: int = 3) -> str:
    """Spaces inside parentheses and around simple operators taken out, until nothing changes, in at most `passes` passes."""
    for _ in range(passes):
        new = re.sub(r"(?<=\() +| +(?=\))", "", re.sub(r"(?<=\w) *([*/^]) *(?=\w)", r"\1", text))
        if new == text:
            break
        text = new
    return text


def wrap_callouts(lines: list[str], opens: str = r"^(Note|Warning|Tip)\b") -> list[str]:
    """Callouts fenced by `:::`: from a line that opens one to the next blank line, heading or opening."""
    out, inside = [], False
    for line in lines:
        if inside and (not line.strip() or line.startswith("#") or re.match(opens, line)):
            out.append(":::")
            inside = False
        if re.match(opens, line):
            out.append("::: callout")
            inside = True
        out.append(line)
    return out + [":::"] * inside


def rewrite_documents(docs: DataFrame, callouts: bool = True) -> DataFrame:
    """docs (doc_id, text) with parentheses tidied and callouts wrapped; null texts stay null."""
    ship(docs.sparkSession)

    def run(frames):
        for x in frames:
            done = [None if t is None else "\n".join(wrap_callouts([tidy_parentheses(v) for v in t.split("\n")]) if callouts else [tidy_parentheses(v) for v in t.split("\n")]) for t in x["text"]]
            yield pd.DataFrame({"doc_id": x["doc_id"], "text": done})

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {dict(docs.dtypes)['doc_id']}, text string")


def replace_all(docs: DataFrame, rules: list[tuple[str, str, str]], text: str = "text") -> DataFrame:
    """docs with ordered (name, pattern, replacement) rules applied and `log`, the names of those that changed the text."""
    log = F.array().cast("array<string>")
    out = docs
    for i, (name, pattern, new) in enumerate(rules):
        c = F.regexp_replace(text, pattern, new)
        out = out.withColumn(f"__{i}", F.when(c != F.col(text), F.lit(name))).withColumn(text, c)
    names = F.array_compact(F.array(*(F.col(f"__{i}") for i in range(len(rules))))) if rules else log
    return out.withColumn("log", names).drop(*(f"__{i}" for i in range(len(rules))))


def wrap_defined(lines: list[str], terms: list[str], stops: str = r"^\s*$|^#|^```") -> tuple[list[str], int]:
    """(lines, how many terms were found): each term's definition, a line that begins with the term and a colon, fenced by
    `:::` up to the next stop, or the next definition. Terms are looked for in their order: a line that defines a later one,
    or one that had its turn, is an ordinary line."""
    out, at, inside = [], 0, False
    for line in lines:
        opens = at < len(terms) and line.startswith(terms[at] + ":")
        if inside and (opens or re.search(stops, line)):
            out.append(":::")
            inside = False
        if opens:
            out.append("::: definition")
            at, inside = at + 1, True
        out.append(line)
    return out + [":::"] * inside, at


def defined_callouts(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_found of docs (doc_id, text, terms: an array in the order of the definitions). The cursor runs through a
    document's lines, so a document is one unit of state. Null texts stay null, null terms are none."""
    ship(docs.sparkSession)

    def run(frames):
        for x in frames:
            got = [(None, 0) if t is None else wrap_defined(t.split("\n"), [] if k is None else list(k)) for t, k in zip(x["text"], x["terms"])]
            yield pd.DataFrame({"doc_id": x["doc_id"], "text": [None if g is None else "\n".join(g) for g, _ in got], "n_found": [n for _, n in got]})

    return docs.select("doc_id", "text", "terms").mapInPandas(run, f"doc_id {dict(docs.dtypes)['doc_id']}, text string, n_found int")
