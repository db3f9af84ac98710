"""Line dedup by winnowing (native).

The symbols are whole lines, weighed by their words. A run of lines of NOISE words or more, the shortest from its first
line, has a hash; of the runs inside each shortest window of GUARANTEE words or more, the one with the least hash is
taken, so that any two equal passages of GUARANTEE words share a fingerprint. The windows themselves are fingerprints
too, the shortest from each line and the shortest up to each line: together they cover every line of a passage, and a
window's first place holds all of it, wherever the runs in it stand first. Each fingerprint's places are joined to its
first place. A window with an earlier place goes as it is; any other fingerprint's match is extended both ways along its
diagonal, by GUARANTEE lines at most (what matches further is full of windows of its own), so that a match costs the same
however long its two documents are. Later runs are deleted. Of a fingerprint's places
in one document only the first is joined: the later ones repeat it where they stand, so that a document of n equal lines
has one place to join and n to delete.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import WORD, let, materialize, unused

NOISE, GUARANTEE = 25, 50


def _lines(text: Column) -> Column:
    """Lines with a word: i (its number), h (hash of the line as it is), w (words)."""
    split = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    made = F.transform(split, lambda x, i: F.struct(i.alias("i"), F.xxhash64(x).alias("h"), F.regexp_count(x, F.lit(WORD)).alias("w")))
    return F.filter(made, lambda x: x["w"] > 0)


def _run(lines: Column, j: Column, words: int) -> Column:
    """The shortest run from line j (from 0) of at least so many words: w, n (lines), g (hash)."""
    zero = F.struct(F.lit(0).alias("w"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("g"))
    step = lambda a, x: F.when(a["w"] >= words, a).otherwise(F.struct((a["w"] + x["w"]).alias("w"), (a["n"] + 1).alias("n"), F.xxhash64(a["g"], x["h"]).alias("g")))
    return F.aggregate(F.slice(lines, j + 1, words), zero, step)


def _picks(lines: Column, noise: int, guarantee: int) -> Column:
    """Fingerprints: distinct g (hash), p (first line), e (line past the end) and win (whether it has the words of a window) of
    the least run in each window, and of the windows, in this order."""

    def of(runs: Column) -> Column:
        # runs[j]: g, p = j, e = line past its end, and past: line past the end of the window from j (null: none)
        def least(x: Column) -> Column:
            inside = F.filter(F.slice(runs, x["p"] + 1, x["past"] - x["p"]), lambda y: y["ok"] & (y["e"] <= x["past"]))
            return F.array_min(F.transform(inside, lambda y: F.struct(y["g"].alias("g"), y["p"].alias("p"), y["e"].alias("e"), y["win"].alias("win"))))

        ends = F.filter(runs, lambda x: x["past"].isNotNull())
        ahead = F.transform(ends, lambda x: F.struct(x["whole"].alias("g"), x["p"].alias("p"), x["past"].alias("e"), F.lit(True).alias("win")))
        every = F.sort_array(F.concat(F.transform(ends, least), ahead, back(runs)))
        return let(every, lambda s: F.filter(s, lambda x, i: (i == 0) | (x != F.get(s, i - 1))))

    def back(runs: Column) -> Column:
        # of the windows up to a line, those that are not the window from their first line
        def window(rev: Column, j: Column) -> Column:
            past = F.size(lines) - j
            return let(_run(rev, j, guarantee), lambda r: F.struct((r["w"] >= guarantee).alias("ok"), F.bitwise_not(r["g"]).alias("g"), (past - r["n"]).alias("p"), past.alias("past")))

        all_ = let(F.reverse(lines), lambda rev: F.transform(rev, lambda _, j: window(rev, j)))
        more = F.filter(all_, lambda x: x["ok"] & (F.get(runs, x["p"])["past"] != x["past"]))
        return F.transform(more, lambda x: F.struct(x["g"].alias("g"), x["p"].alias("p"), x["past"].alias("e"), F.lit(True).alias("win")))

    def run(x: Column, j: Column) -> Column:
        small, large = _run(lines, j, noise), _run(lines, j, guarantee)
        return let(
            F.struct(small.alias("a"), large.alias("b")),
            lambda r: F.struct(r["a"]["g"].alias("g"), j.alias("p"), (j + r["a"]["n"]).alias("e"), (r["a"]["w"] >= noise).alias("ok"), (r["a"]["w"] >= guarantee).alias("win"), F.when(r["b"]["w"] >= guarantee, j + r["b"]["n"]).alias("past"), r["b"]["g"].alias("whole")),
        )

    return let(F.transform(lines, run), of)


def _parted(lines: Column, picks: Column) -> Column:
    """picks as first (those at their hash's first place in the text: g, p, n lines from number a to b, win) and again (the
    others' line numbers)."""
    number = lambda j: F.get(lines, j)["i"]
    once = lambda s, x, i: (i == 0) | (x["g"] != F.get(s, i - 1)["g"])
    return let(
        picks,
        lambda s: F.struct(
            F.transform(F.filter(s, lambda x, i: once(s, x, i)), lambda x: F.struct(x["g"].alias("g"), x["p"].alias("p"), (x["e"] - x["p"]).alias("n"), number(x["p"]).alias("a"), number(x["e"] - 1).alias("b"), x["win"].alias("win"))).alias("first"),
            F.transform(F.filter(s, lambda x, i: ~once(s, x, i)), lambda x: F.struct(number(x["p"]).alias("first"), number(x["e"] - 1).alias("last"))).alias("again"),
        ),
    )


def _islands(mine: Column, other: Column, shift: Column, noise: int) -> Column:
    """Maximal runs of at least `noise` words where mine[j] equals other[j + shift], as first and last line numbers."""
    none = F.lit(None).cast("int")
    kind = "struct<first: int, last: int, w: int, out: array<struct<first: int, last: int>>>"
    zero = F.struct(none.alias("first"), none.alias("last"), F.lit(0).alias("w"), F.array().cast("array<struct<first: int, last: int>>").alias("out")).cast(kind)
    closed = lambda a: F.when(a["w"] >= noise, F.concat(a["out"], F.array(F.struct(a["first"].alias("first"), a["last"].alias("last"))))).otherwise(a["out"])
    marked = F.transform(mine, lambda x, j: F.struct(x["i"].alias("i"), x["w"].alias("w"), ((j + shift >= 0) & F.coalesce(F.get(other, F.greatest(j + shift, F.lit(0)))["h"] == x["h"], F.lit(False))).alias("eq")))

    def step(a: Column, x: Column) -> Column:
        on = F.struct(F.coalesce(a["first"], x["i"]).alias("first"), x["i"].alias("last"), (a["w"] + x["w"]).alias("w"), a["out"].alias("out"))
        off = F.struct(none.alias("first"), none.alias("last"), F.lit(0).alias("w"), closed(a).alias("out"))
        return F.when(x["eq"], on).otherwise(off)

    return F.aggregate(marked, zero, step, closed)


def _numbers(runs: Column) -> Column:
    """The line numbers of runs, each once, in order."""
    return F.sort_array(F.array_distinct(F.flatten(F.transform(runs, lambda r: F.sequence(r["first"], r["last"])))))


def _around(base: DataFrame, places: DataFrame, reach: int) -> DataFrame:
    """doc_id, t, p, n, lines, ahead: for each place (n lines from line p of a document) its lines and up to `reach` lines on
    either side; `ahead` of them stand before it. A document's lines are read once for all its places."""
    asked = places.groupBy(F.col("doc_id").alias("d"), F.col("t").alias("u")).agg(F.collect_set(F.struct("p", "n")).alias("places"))
    ahead = lambda x: F.least(F.lit(reach), x["p"])
    cut = lambda x: F.struct(x["p"].alias("p"), x["n"].alias("n"), F.slice("lines", x["p"] - ahead(x) + 1, ahead(x) + x["n"] + reach).alias("lines"), ahead(x).alias("ahead"))
    found = asked.join(base, asked["d"].eqNullSafe(base["doc_id"]) & (asked["u"] == base["t"]))
    return found.select("doc_id", "t", F.explode(F.transform("places", cut)).alias("x")).select("doc_id", "t", "x.*")


def repeated_runs(docs: DataFrame, noise: int = NOISE, guarantee: int = GUARANTEE) -> DataFrame:
    """doc_id, t (hash of the text) and gone: the numbers of a document's lines that are in a later repeated run."""
    made = let(_lines(F.col("text")), lambda x: F.struct(x.alias("lines"), _parted(x, _picks(x, noise, guarantee)).alias("picks")))
    base = docs.select("doc_id", F.xxhash64("text").alias("t"), made.alias("x")).select("doc_id", "t", "x.lines", "x.picks.first", "x.picks.again")
    base = materialize(base.where(F.size("first") > 0).dropDuplicates(["doc_id", "t"]))
    at = base.select("doc_id", "t", F.explode("first").alias("x")).select("doc_id", "t", "x.*").withColumn("at", F.struct("doc_id", "t", "p"))
    first = materialize(at.groupBy("g").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").select("g", "first"))
    hits = at.join(first, "g").where("at != first")
    # how far windows reach that begin at or before a match: what ends within needs no extension
    reach = F.max(F.when(F.col("win"), F.col("b"))).over(W.partitionBy("doc_id", "t").orderBy("a", F.desc("win")).rowsBetween(W.unboundedPreceding, 0))
    hits = hits.select("doc_id", "t", "p", "n", "a", "b", "win", "first", reach.alias("reach"))
    runs = F.collect_list(F.when(F.col("win"), F.struct(F.col("a").alias("first"), F.col("b").alias("last"))))
    rest = F.collect_list(F.when(~F.col("win") & F.coalesce(F.col("reach") < F.col("b"), F.lit(True)), F.struct("p", "n", F.col("first.doc_id").alias("doc0"), F.col("first.t").alias("t0"), F.col("first.p").alias("p0"))))
    met = materialize(hits.groupBy("doc_id", "t").agg(runs.alias("runs"), rest.alias("rest")))
    rest = met.select("doc_id", "t", F.explode("rest").alias("x")).select("doc_id", "t", "x.*")
    near = materialize(_around(base, rest.select("doc_id", "t", "p", "n").unionByName(rest.select(F.col("doc0").alias("doc_id"), F.col("t0").alias("t"), F.col("p0").alias("p"), "n")), guarantee))
    mine = near.select(F.col("doc_id").alias("d"), F.col("t").alias("u"), F.col("p").alias("q"), F.col("n").alias("m"), "lines", "ahead")
    other = near.select(F.col("doc_id").alias("e"), F.col("t").alias("v"), F.col("p").alias("r"), F.col("n").alias("k"), F.col("lines").alias("lines0"), F.col("ahead").alias("ahead0"))
    both = rest.join(mine, rest["doc_id"].eqNullSafe(mine["d"]) & (rest["t"] == mine["u"]) & (rest["p"] == mine["q"]) & (rest["n"] == mine["m"]))
    both = both.join(other, F.col("doc0").eqNullSafe(other["e"]) & (F.col("t0") == other["v"]) & (F.col("p0") == other["r"]) & (F.col("n") == other["k"]))
    cut = both.select("doc_id", "t", _islands(F.col("lines"), F.col("lines0"), F.col("ahead0") - F.col("ahead"), noise).alias("cut")).where(F.size("cut") > 0)
    cut = cut.unionByName(met.where(F.size("runs") > 0).select("doc_id", "t", F.col("runs").alias("cut")))
    cut = cut.unionByName(base.where(F.size("again") > 0).select("doc_id", "t", F.col("again").alias("cut")))
    return cut.groupBy("doc_id", "t").agg(_numbers(F.flatten(F.collect_list("cut"))).alias("gone"))


def line_dedup(docs: DataFrame, noise: int = NOISE, guarantee: int = GUARANTEE) -> DataFrame:
    """docs with the later repeated runs of lines cut out of text, and n_cut_lines and cut (runs as first and last line
    numbers of the old text; null if none) added; columns of docs of these names are replaced, all others stay. All rows
    stay; a text may become empty.

    A repeated passage of `guarantee` words or more, in whole lines, is always found and deleted whole; what is deleted is
    at least `noise` words long and stands, line for line, in an earlier place: a smaller doc_id (null first), then hash of
    the text, then line. A run of equal lines in one document counts too. Lines without a word don't part a run and go with it. Rows
    that repeat both doc_id and text are one document: all keep the same text. Null texts stay null, empty ones empty."""
    docs = docs.drop("n_cut_lines", "cut")
    t, d, u, gone = unused([*docs.columns, "n_cut_lines", "cut"], "t", "d", "u", "gone")
    cut = repeated_runs(docs.select("doc_id", "text"), noise, guarantee).toDF(d, u, gone)
    keyed = docs.withColumn(t, F.xxhash64("text"))
    x = keyed.join(cut, keyed["doc_id"].eqNullSafe(cut[d]) & (keyed[t] == cut[u]), "left")
    lines = F.split("text", "\n", -1)
    kept = lambda x: F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col(gone))
    text = let(lines, lambda x: F.array_join(F.transform(kept(x), lambda i: F.get(x, i)), "\n"))
    # runs of numbers that follow each other
    ends = lambda step: F.filter(gone, lambda x, i: F.coalesce(F.get(F.col(gone), i + step) != x + step, F.lit(True)))
    runs = F.zip_with(ends(-1), ends(1), lambda a, b: F.struct(a.alias("first"), b.alias("last")))
    out = x.withColumns({"n_cut_lines": F.coalesce(F.size(gone), F.lit(0)).cast("long"), "cut": F.when(F.col(gone).isNotNull(), runs), "text": F.when(F.col(gone).isNull(), F.col("text")).otherwise(text)})
    return out.select(*(f"`{c}`" for c in [*docs.columns, "n_cut_lines", "cut"]))
