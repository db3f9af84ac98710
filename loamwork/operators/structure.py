"""Document structure: headings, folding of wrapped lines, tables by layout, question items, callouts.

What hangs on sequential state with early exits runs as one pandas function a document; a document's lines are the
unit of state, so no group grows with the corpus.
"""

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..sources.tables import ship

#: How far apart column starts count as one, and the least width of a column.
TOLERANCE, LEAST_WIDTH = 3, 6


def headings(lines: DataFrame) -> DataFrame:
    """lines (doc_id, line_no, line) with chapter and section, filled forward: `# ...` opens a chapter, `## ...` a section."""
    w = W.partitionBy("doc_id").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    chapter, section = (F.when(F.col("line").rlike(p), F.regexp_extract("line", p, 1)) for p in ("^# +(.+)$", "^## +(.+)$"))
    x = lines.withColumn("chapter", F.last(chapter, True).over(w)).withColumn("__c", F.count(chapter).over(w))
    per = W.partitionBy("doc_id", "__c").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    return x.withColumn("section", F.last(section, True).over(per)).drop("__c")


def toc(lines: DataFrame) -> DataFrame:
    """doc_id, chapter, first (its line), n_lines, n_sections of each chapter."""
    x = headings(lines).where("chapter is not null")
    return x.groupBy("doc_id", "chapter").agg(F.min("line_no").alias("first"), F.count("*").alias("n_lines"), F.countDistinct("section").alias("n_sections"))


def fold_lines(lines: list[str], width: int = 40) -> list[str]:
    """Hard-wrapped lines joined: a line goes on if its last physical line is at least `width` long and ends no sentence."""
    out: list[str] = []
    last = ""
    for line in lines:
        open_ = out and last and len(last) >= width and not re.search(r"[.!?:。！？：]$", last)
        if open_ and line and not re.match(r"\s|[-*+>#|]|\d+[.)]|```", line):
            glue = " " if re.search(r"[A-Za-z0-9,;]$", out[-1]) and re.match(r"[A-Za-z0-9]", line) else ""
            out[-1] += glue + line
        else:
            out.append(line)
        last = line
    return out


def unwrap(docs: DataFrame, width: int = 40) -> DataFrame:
    """docs (doc_id, text) with text unwrapped and n_merged, the number of joined lines; null texts stay null.

    Whether a line is joined, and with a space, hangs on it and the line before it alone, so this is one expression."""

    def goes_on(last: Column, line: Column) -> Column:
        return (F.length(last) >= width) & (line != "") & ~last.rlike(r"[.!?:。！？：]\z") & ~line.rlike(r"^([\t\n\f\r ]|[-*+>#|]|[0-9]+[.)]|```)")

    def joined(last: Column, line: Column) -> Column:
        glue = F.when(last.rlike(r"[A-Za-z0-9,;]\z") & line.rlike("^[A-Za-z0-9]"), F.lit(" ")).otherwise(F.lit(""))
        return F.when(goes_on(last, line), F.concat(glue, line)).otherwise(F.concat(F.lit("\n"), line))

    def body(lines: Column) -> Column:
        return F.array_join(F.transform(lines, lambda x, i: F.when(i == 0, x).otherwise(joined(F.get(lines, i - 1), x))), "")

    text = F.transform(F.array(F.split("text", "\n", -1)), body)[0]
    breaks = lambda t: F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit("")))
    x = docs.select("doc_id", F.col("text").alias("__t"), F.when(F.col("text").isNotNull(), text).alias("text"))
    return x.select("doc_id", "text", F.coalesce(breaks(F.col("__t")) - breaks(F.col("text")), F.lit(0)).cast("long").alias("n_merged"))


def recover_table(raw: list[str]) -> tuple[list[list[str]], str]:
    """(rows, confidence) of a block of column-aligned lines, columns parted by two or more spaces.

    Starts that two lines vote for are columns; a line that lacks the first column continues the row above. If a piece
    of the block is lost in the rows, the block is returned as it is, with confidence `low`."""
    parts = [[(m.start(), m[0]) for m in re.finditer(r"\S+(?: \S+)*", line)] for line in raw]
    votes: dict[int, int] = {}
    for p in parts:
        for start, _ in p:
            votes[start] = votes.get(start, 0) + 1
    starts: list[int] = []
    for s in sorted(votes):
        near = sum(n for t, n in votes.items() if abs(t - s) <= TOLERANCE)
        if near >= 2 and (not starts or s - starts[-1] >= LEAST_WIDTH):
            starts.append(s)
    if len(starts) < 2:
        return [[line] for line in raw], "low"
    rows: list[list[str]] = []
    for p in parts:
        cells = [""] * len(starts)
        for s, word in p:
            k = max([i for i, b in enumerate(starts) if s >= b - TOLERANCE], default=0)
            cells[k] = f"{cells[k]} {word}".strip()
        if rows and not cells[0] and any(cells):
            rows[-1] = [f"{a} {b}".strip() for a, b in zip(rows[-1], cells)]
        elif any(cells):
            rows.append(cells)
    flat = sorted(w for r in rows for c in r for w in c.split())
    if flat != sorted(w for line in raw for w in line.split()):
        return [[line] for line in raw], "low"
    return rows, "high"


def tables(blocks: DataFrame) -> DataFrame:
    """blocks (block_id, raw: array of lines) as block_id, rows (array of arrays), confidence."""
    ship(blocks.sparkSession)

    def run(frames):
        for x in frames:
            got = [recover_table(list(r) if r is not None else []) for r in x["raw"]]
            yield pd.DataFrame({"block_id": x["block_id"], "rows": [g[0] for g in got], "confidence": [g[1] for g in got]})

    return blocks.select("block_id", "raw").mapInPandas(run, f"block_id {dict(blocks.dtypes)['block_id']}, rows array<array<string>>, confidence string")


def markdown_row(cells):
    """A Markdown table row of an array column; bars escaped."""
    return F.concat(F.lit("| "), F.array_join(F.transform(cells, lambda c: F.replace(c, F.lit("|"), F.lit("\\|"))), " | "), F.lit(" |"))


def questions(docs: DataFrame) -> DataFrame:
    """doc_id, number, stem, options (label, text), answer of items `1. stem`, `(A) option`, `Answer: A`, by expressions."""
    items = F.split(F.concat(F.lit("\n"), "text"), r"\n(?=[0-9]+\. )")
    x = docs.select("doc_id", F.posexplode(items).alias("i", "item")).where("i > 0")
    option = r"(?m)^\(([A-D])\) *(.*)$"
    labels, texts = F.regexp_extract_all("item", F.lit(option), F.lit(1)), F.regexp_extract_all("item", F.lit(option), F.lit(2))
    return x.select(
        "doc_id",
        F.regexp_extract("item", r"^([0-9]+)\. ", 1).cast("int").alias("number"),
        F.trim(F.regexp_extract("item", r"(?s)^[0-9]+\. (.*?)(?=\n\([A-D]\)|\nAnswer:|$)", 1)).alias("stem"),
        F.arrays_zip(labels.alias("label"), texts.alias("text")).alias("options"),
        F.nullif(F.regexp_extract("item", r"(?m)^Answer: *([A-D])", 1), F.lit("")).alias("answer"),
    )


def find_all(docs: DataFrame, pattern: str, name: str) -> DataFrame:
    """doc_id, check, first, past, found, line_no: every match with its place in code points and its line."""
    ship(docs.sparkSession)
    rx = re.compile(pattern)

    def run(frames):
        for x in frames:
            rows = [(d, name, m.start(), m.end(), m[0], t.count("\n", 0, m.start()) + 1) for d, t in zip(x["doc_id"], x["text"]) if t is not None for m in rx.finditer(t)]
            yield pd.DataFrame(rows, columns=["doc_id", "check", "first", "past", "found", "line_no"])

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {dict(docs.dtypes)['doc_id']}, check string, first int, past int, found string, line_no int")
