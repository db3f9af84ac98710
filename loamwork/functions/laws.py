"""Distribution functions as column expressions, by series of positive terms; nulls in give nulls.

Sums run inside one expression (an aggregate over a sequence as long as the terms need), so no Python runs and columns may
hold another parameter in every row. Errors are below 1e-10 where the parameters are below some thousands."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Coefficients of Stirling's series, 1/12 z, 1/360 z^3 and so on, from Bernoulli's numbers.
_STIRLING = [1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188]


def log_gamma(z: Column) -> Column:
    """ln of the gamma function for z > 0: Stirling's series at z + 10, brought back by the product in between."""
    up = z + 10
    series = sum((c / F.pow(up, 2 * k + 1) for k, c in enumerate(_STIRLING)), F.lit(0.0))
    back = F.ln(z)
    for k in range(1, 10):
        back = back + F.ln(z + k)
    return (up - 0.5) * F.ln(up) - up + 0.5 * math.log(2 * math.pi) + series - back


def _let(body, **values: Column) -> Column:
    """body of the values, each computed once."""
    return F.transform(F.array(F.struct(*(v.cast("double").alias(k) for k, v in values.items()))), lambda s: body(*(s[k] for k in values)))[0]


def _terms(count: Column, ratio) -> Column:
    """1 + r_1 + r_1 r_2 + ... with r_k = ratio(k), up to `count` terms."""
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(done, k):
        term = done["term"] * ratio(k.cast("double"))
        return F.struct(term.alias("term"), (done["sum"] + term).alias("sum"))

    return F.aggregate(F.sequence(F.lit(1), count.cast("int")), start, step, lambda done: done["sum"])


def gamma_share(a: Column, x: Column) -> Column:
    """The regularised lower incomplete gamma function P(a, x), for a > 0 (0 for x <= 0, null for null)."""

    def body(a, x):
        y = F.greatest(F.lit(0.0), F.least(x, a + 40 * F.sqrt(a) + 200))  # beyond, it is 1 to the last digit
        count = F.ceil(y + 12 * F.sqrt(y) + 40)
        return F.when(a.isNull() | x.isNull(), F.lit(None).cast("double")).when(x <= 0, 0.0).otherwise(F.least(F.lit(1.0), F.exp(a * F.ln(y) - y - log_gamma(a + 1)) * _terms(count, lambda k: y / (a + k))))

    return _let(body, a=a, x=x)


def beta_share(a: Column, b: Column, x: Column) -> Column:
    """The regularised incomplete beta function I_x(a, b), for a, b > 0; from the side on which the series is short."""

    def series(a, b, x):
        count = F.ceil(40 * (a + b + 2) / (b + 1) + 6 * F.sqrt(a + b) + 60)
        front = F.exp(log_gamma(a + b) - log_gamma(a + 1) - log_gamma(b) + a * F.ln(x) + b * F.ln(1 - x))
        return front * _terms(count, lambda k: x * (a + b + k - 1) / (a + k))

    def body(a, b, x):
        other = x > (a + 1) / (a + b + 2)
        part = _let(series, a=F.when(other, b).otherwise(a), b=F.when(other, a).otherwise(b), x=F.when(other, 1 - x).otherwise(x))
        inside = F.when(other, 1 - part).otherwise(part)
        return F.when(x.isNull() | a.isNull() | b.isNull(), F.lit(None).cast("double")).when(x <= 0, 0.0).when(x >= 1, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), inside)))

    return _let(body, a=a, b=b, x=x)


def normal_cdf(z: Column) -> Column:
    half = gamma_share(F.lit(0.5), z * z / 2) / 2
    return F.when(z < 0, 0.5 - half).otherwise(0.5 + half)


def chi_square_cdf(x: Column, degrees: Column) -> Column:
    return gamma_share(degrees / 2, x / 2)


def poisson_cdf(k: Column, mean: Column) -> Column:
    """The chance of at most k events (0 for k < 0)."""
    return F.when(k < 0, 0.0).when(mean <= 0, 1.0).otherwise(1 - gamma_share(F.floor(k) + 1, mean))


def t_cdf(t: Column, degrees: Column) -> Column:
    """Student's law."""
    tail = beta_share(degrees / 2, F.lit(0.5), degrees / (degrees + t * t)) / 2
    return F.when(t < 0, tail).otherwise(1 - tail)


def binomial_cdf(k: Column, n: Column, p: Column) -> Column:
    """The chance of at most k of n (0 for k < 0)."""
    return F.when(k < 0, 0.0).when(k >= n, 1.0).otherwise(beta_share(n - F.floor(k), F.floor(k) + 1, 1 - p))


def two_sided(cdf: Column) -> Column:
    """The two-sided p-value of a symmetric law's distribution function at the statistic."""
    return 2 * F.least(cdf, 1 - cdf)
