"""Quality rules as a short-circuit cascade (native).

Each rule has a cost, counted as work on a text, and a selectivity; both are summed over a random sample in one pass, and
the cascade asks the rules in order of rejections per cost. CASE stops at the first rule that rejects, and what a rule
alone needs (the sort of a text's three-word windows above all) is worked out only where the cascade reaches it. The
order moves time only, never a verdict.
"""

import re
from dataclasses import dataclass
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GAP, WORD, let, unused

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\f\r"
#: Work of a step, in steps of a plain pass over a text's characters: a regular expression's step at a character, and a
#: word hashed and sorted into place.
REGEX, WINDOW = 8, 40


@dataclass(frozen=True)
class Rule:
    """rejects(m, t): whether the rule rejects the text t; m gives a measure's column by name. Null counts as no.

    work(m, t): steps that it takes, beside the words and their characters, which are counted for every text."""

    name: str
    rejects: Callable[[Callable[[str], Column], Column], Column]
    work: Callable[[Callable[[str], Column], Column], Column]


def _without(text: Column, characters: str) -> Column:
    """text without some ASCII characters: each is searched as a byte, which is faster than a look at every character."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), characters, text)


def _words(t: Column) -> Column:
    return F.filter(F.split(t, GAP), lambda w: w != "")


#: Bits of a packed window that hold its place; longer texts sort whole structs.
_PLACE = 24


def _covered(windows: Column) -> Column:
    """Words in windows (h, i) whose h another one has."""

    def count(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i + 1)["h"]) | (x["h"] == F.get(s, i - 1)["h"]))
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    return let(F.sort_array(windows), count)


def _windows(w: Column) -> Column:
    """The hashes of the three-word windows of words, in order."""
    return F.slice(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))), 1, F.greatest(F.size(w) - 2, F.lit(0)))


def _repeats(words: Column) -> Column:
    """Words in three-word windows that occur twice or more in the text.

    A window's hash and place are packed into one integer, as integers sort several times faster than structs; those whose
    leading bits meet another's, few more than the repeated ones, are then compared by their whole hashes."""
    return let(words, lambda w: let(_windows(w), _covered_by_repeats))


def _covered_by_repeats(hashes: Column) -> Column:
    low = (1 << _PLACE) - 1

    def packed(h: Column) -> Column:
        lead = lambda x: F.shiftright(x, _PLACE)
        place = lambda x: x.bitwiseAND(F.lit(low)).cast("int")
        near = lambda s: F.filter(s, lambda x, i: (lead(x) == lead(F.get(s, i + 1))) | (lead(x) == lead(F.get(s, i - 1))))
        made = F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))))
        return let(made, lambda s: _covered(F.transform(near(s), lambda x: F.struct(F.get(h, place(x)).alias("h"), place(x).alias("i")))))

    def plain(h: Column) -> Column:
        return _covered(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    return F.when(F.size(hashes) <= low, packed(hashes)).otherwise(plain(hashes)).cast("long")


def _half_repeats(t: Column, n_words: Column) -> Column:
    """Whether over half of the words are in windows that occur twice or more.

    Of k windows with d different hashes at most 2 (k - d) are repeated, with three words each; only where that bound
    leaves it open are the windows sorted."""
    few = lambda h: 100 * 6 * (F.size(h) - F.size(F.array_distinct(h))).cast("long") <= 50 * n_words
    return let(_words(t), lambda w: let(_windows(w), lambda h: F.when(few(h), False).otherwise(100 * _covered_by_repeats(h) > 50 * n_words)))


def _dup_lines(t: Column) -> Column:
    full = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0)
    return let(full, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _count(t: Column, characters: str) -> Column:
    """How many characters of t are one of these ASCII characters."""
    if len(characters) == 1:
        return (F.length(t) - F.length(_without(t, characters))).cast("long")
    return F.regexp_count(t, F.lit(f"[{re.escape(characters)}]")).cast("long")


#: Measures that any text gets first, and those that are worked out where they are asked for.
CHEAP = {"n_words": lambda t: F.regexp_count(t, F.lit(WORD)).cast("long"), "word_chars": lambda t: F.length(_without(t, WHITE)).cast("long")}
DEAR = {"n_symbols": lambda t: _count(t, SYMBOLS), "n_dup_lines": _dup_lines, "n_repeat_words": lambda t: _repeats(_words(t))}
MEASURES = (*CHEAP, *DEAR)


def measures(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (long) of a whole text.

    Null and empty texts: all 0. Three-word windows are compared by a 64-bit hash within one text; repeats come from
    one sort of a text's windows, n log n for any length."""
    t = F.coalesce(text, F.lit(""))
    of_words = let(_words(t), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeats(w).alias("n_repeat_words")))
    rest = ("word_chars", "n_symbols", "n_dup_lines")
    return let(of_words, lambda w: F.struct(w["n_words"].alias("n_words"), w["n_repeat_words"].alias("n_repeat_words"), *((CHEAP | DEAR)[k](t).alias(k) for k in rest)))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def base_rules() -> list[Rule]:
    """The two halves of base_failed."""
    return [
        Rule("few_words", lambda m, t: m("n_words") < 50, lambda m, t: F.lit(1)),
        Rule("repeats", lambda m, t: _half_repeats(t, m("n_words")), lambda m, t: F.length(t) * REGEX + m("n_words") * WINDOW),
    ]


def default_rules() -> list[Rule]:
    size = lambda m, t: F.length(t)
    return [
        Rule("symbols", lambda m, t: m("n_symbols") * 10 > m("n_words"), size),
        Rule("word_length", lambda m, t: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 12 * m("n_words")), lambda m, t: F.lit(1)),
        Rule("dup_lines", lambda m, t: m("n_dup_lines") * 10 > 6 * F.size(F.split(t, "\n", -1)), lambda m, t: 4 * F.length(t)),
        Rule("exclaims", lambda m, t: _count(t, "!") * 10 > 3 * m("n_words"), size),
        Rule("few_letters", lambda m, t: F.length(F.regexp_replace(t, r"[^\p{L}]+", "")) * 2 < m("word_chars"), lambda m, t: F.length(t) * REGEX),
        Rule("shouts", lambda m, t: (F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", ""))) * 2 > m("word_chars"), lambda m, t: F.length(t) * REGEX),
    ]


def _cheap(t: Column) -> Column:
    return F.struct(*(f(t).alias(k) for k, f in CHEAP.items()))


def _asked(cheap: Column, t: Column) -> Callable[[str], Column]:
    return lambda k: cheap[k] if k in CHEAP else DEAR[k](t)


def plan_cascade(df: DataFrame, text: str, rules: list[Rule], sample_rows: int = 2000) -> list[Rule]:
    """The rules by rejections per step of their work on about `sample_rows` random rows, the best first; ties by name.

    The sample, a documented bound, only estimates costs: every row is judged by every rule that it takes. Work is
    counted, not timed, so that the order hangs on the sample alone. One pass reads the texts' column for the sample."""
    n = df.count()
    if not n:
        return sorted(rules, key=lambda r: r.name)
    t = F.coalesce(F.col(text), F.lit(""))
    some = df.select(t.alias("t")).sample(False, min(1.0, sample_rows / n), 1)
    m = _asked(_cheap(F.col("t")), F.col("t"))
    found = some.agg(
        *(F.sum(r.work(m, F.col("t")).cast("double")).alias(f"w{i}") for i, r in enumerate(rules)),
        *(F.count_if(F.coalesce(r.rejects(m, F.col("t")), F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules)),
    ).first()
    gain = {r.name: (found[f"r{i}"] + 0.5) / ((found[f"w{i}"] or 0.0) + 1) for i, r in enumerate(rules)}
    return sorted(rules, key=lambda r: (-gain[r.name], r.name))


def _first_that_rejects(rules: list[Rule], m: Callable[[str], Column], t: Column) -> Column:
    """True where a rule rejects, asked in this order; else null."""
    by = F.when(F.lit(False), True)
    for r in rules:
        by = by.when(F.coalesce(r.rejects(m, t), F.lit(False)), True)
    return by


def quality_rules(df: DataFrame, text: str = "text", rules: list[Rule] | None = None, sample_rows: int = 2000) -> DataFrame:
    """df with the measures, base_failed and kept (boolean).

    base_failed: fewer than 50 words, or over half of the words in repeated three-word windows. kept is false for
    those, else whether no rule rejects. A null text fails as an empty one. Repeated rows are judged alike; an empty
    table gives an empty one; other columns pass through, and those named as the new ones are replaced."""
    rules = default_rules() if rules is None else rules
    ordered = plan_cascade(df, text, rules, sample_rows) if sample_rows else rules
    t = F.coalesce(F.col(text), F.lit(""))
    held, = unused([*df.columns, *MEASURES, "base_failed", "kept"], "verdict")

    def verdict(m: Column) -> Column:
        failed = base_failed(m)
        kept = F.when(failed, False).when(_first_that_rejects(ordered, lambda k: m[k], t), False).otherwise(True)
        return F.struct(m.alias("m"), failed.alias("failed"), kept.alias("kept"))

    # one expression, so that a filter on the verdict that is moved below works the measures out once
    out = df.withColumn(held, let(measures(F.col(text)), verdict))
    out = out.withColumns({k: F.col(f"{held}.m.{k}") for k in MEASURES} | {"base_failed": F.col(f"{held}.failed"), "kept": F.col(f"{held}.kept")})
    return out.drop(held)


def kept_rows(df: DataFrame, text: str = "text", rules: list[Rule] | None = None, sample_rows: int = 2000) -> DataFrame:
    """The rows of df that quality_rules() keeps, as they are.

    Only words and characters are counted of every text; the base conditions stand in the cascade with the rules, so that
    a text's lines, symbols and windows are looked at only if no rule before has rejected it."""
    rules = [*base_rules(), *(default_rules() if rules is None else rules)]
    ordered = plan_cascade(df, text, rules, sample_rows) if sample_rows else rules
    t = F.coalesce(F.col(text), F.lit(""))
    return df.where(let(_cheap(t), lambda m: _first_that_rejects(ordered, _asked(m, t), t).isNull()))
