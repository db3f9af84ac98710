"""Measures over whole tables: exact quantiles, sketches, drift, ranking, fairness, information and test statistics."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import ratio, running_total


def exact_quantiles(df: DataFrame, column: str, shares: list[float], names: list[str]) -> DataFrame:
    """One row: the quantiles of a column (linear between neighbours, nulls aside), null for an empty column.

    Values are counted, the distinct ones dealt by range and summed up in many tasks; no task holds them all."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    upto = running_total(counts, "v", ["n"])
    n = df.agg(F.count(column)).first()[0]

    def at(k: int) -> Column:  # the k-th value, from 0
        return F.min(F.when(F.col("upto_n") > k, F.col("v")))

    picks = []
    for share, name in zip(shares, names):
        place = share * max(n - 1, 0)
        lo, hi = math.floor(place), math.ceil(place)
        picks.append((at(lo) + (place - lo) * (at(hi) - at(lo))).cast("double").alias(name))
    return upto.agg(*picks)


def count_min(df: DataFrame, key: str, width: int = 2048, depth: int = 5) -> DataFrame:
    """row, cell, hits: a count-min sketch of the values of key; depth times width counts, however large df is.

    Sketches of parts add up cell by cell."""
    cells = F.array(*(F.struct(F.lit(k).alias("row"), F.pmod(F.xxhash64(key, F.lit(k)), F.lit(width)).alias("cell")) for k in range(depth)))
    return df.select(key).select(F.inline(cells)).groupBy("row", "cell").agg(F.count("*").alias("hits"))


def count_min_estimates(asked: DataFrame, key: str, sketch: DataFrame, width: int = 2048, depth: int = 5) -> DataFrame:
    """asked with estimate: the least of a value's cells, never below its count."""
    cells = F.array(*(F.struct(F.lit(k).alias("row"), F.pmod(F.xxhash64(key, F.lit(k)), F.lit(width)).alias("cell")) for k in range(depth)))
    x = asked.select(*asked.columns, F.inline(cells)).join(F.broadcast(sketch), ["row", "cell"], "left")
    return x.groupBy(*asked.columns).agg(F.min(F.coalesce("hits", F.lit(0))).alias("estimate"))


def divergences(df: DataFrame, bin_: Column, expected: Column) -> DataFrame:
    """One row: kl (of the expected half's shares against the other's) and js, over bins, half a count in empty cells, natural log."""
    half = lambda c: F.greatest(F.count_if(c).cast("double"), F.lit(0.5))
    c = df.groupBy(bin_.alias("b")).agg(half(expected).alias("e"), half(~expected).alias("a"))
    t = c.agg(F.sum("e").alias("te"), F.sum("a").alias("ta")).first()
    if t["te"] is None:
        return c.agg(F.lit(None).cast("double").alias("kl"), F.lit(None).cast("double").alias("js"))
    p, q = F.col("e") / t["te"], F.col("a") / t["ta"]
    m = (p + q) / 2
    return c.agg(F.sum(p * F.log(p / q)).alias("kl"), (F.sum(p * F.log(p / m) + q * F.log(q / m)) / 2).alias("js"))


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row, ap: the area under the precision-recall steps, rows of one score taken together (null without label 1)."""
    c = df.groupBy((-F.col(score)).alias("o")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count("*").alias("n"))
    x = running_total(c, "o", ["p", "n"])
    return x.agg((F.sum(F.col("p") * F.col("upto_p") / F.col("upto_n")) / F.nullif(F.sum("p"), F.lit(0))).alias("ap"))


def fairness(df: DataFrame, group: str, pred: Column, label: Column) -> DataFrame:
    """group, n, selected (share predicted 1), tpr, fpr and ppv of each group: the terms of statistical parity, equal
    opportunity, equalised odds and predictive parity; 0 where a share has no rows."""
    c = df.groupBy(group).agg(F.count("*").alias("n"), F.count_if(pred).alias("s"), F.count_if(label).alias("p"), F.count_if(pred & label).alias("tp"), F.count_if(pred & ~label).alias("fp"))
    return c.select(group, "n", ratio(F.col("s"), F.col("n")).alias("selected"), ratio(F.col("tp"), F.col("p")).alias("tpr"), ratio(F.col("fp"), F.col("n") - F.col("p")).alias("fpr"), ratio(F.col("tp"), F.col("s")).alias("ppv"))


def entropy(shares: list[Column]) -> Column:
    """Bits; shares of 0 add nothing."""
    return sum((F.when(p > 0, -p * F.log2(p)).otherwise(0.0) for p in shares), F.lit(0.0))


def information_gain(df: DataFrame, feature: str, label: Column) -> DataFrame:
    """One row, gain: bits that a feature tells of a boolean label."""
    c = df.groupBy(feature).agg(F.count("*").alias("n"), F.count_if(label).alias("p"))
    share = F.col("p") / F.col("n")
    within = F.sum(F.col("n") * entropy([share, 1 - share]))
    whole = F.sum("p") / F.sum("n")
    return c.agg((entropy([whole, 1 - whole]) - within / F.sum("n")).alias("gain"))


def z_one_sample(mean: Column, mu: float, sigma: float, n: Column) -> Column:
    return (mean - mu) / (F.lit(sigma) / F.sqrt(n))


def z_two_shares(k1: Column, n1: Column, k2: Column, n2: Column) -> Column:
    """The statistic of two shares under a pooled share."""
    pooled = (k1 + k2) / (n1 + n2)
    return (k2 / n2 - k1 / n1) / F.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n2))


def binomial(n: int, p: float, k: Column) -> Column:
    """The chance of k successes in n trials, for k from 0 to n."""
    return F.factorial(F.lit(n)).cast("double") / (F.factorial(k) * F.factorial(F.lit(n) - k)) * F.pow(F.lit(p), k) * F.pow(F.lit(1 - p), F.lit(n) - k)


def payback(flows: Column) -> Column:
    """The first period (from 0) at which the sum of cash flows is not below 0; null if it never is."""
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("found"))

    def step(done, flow):
        total = done["sum"] + flow
        found = F.coalesce(done["found"], F.when(total >= 0, done["at"]))
        return F.struct(total.alias("sum"), (done["at"] + 1).alias("at"), found.alias("found"))

    return F.aggregate(flows, start, step, lambda done: done["found"])


def growth(first: Column, last: Column, years: Column) -> Column:
    """The yearly rate that takes first to last."""
    return F.pow(last / first, 1 / years) - 1
