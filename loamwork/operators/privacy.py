"""Private counts under a budget: contributions are clipped, noise comes from hashes, and a ledger refuses over-spending."""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Overspent(ValueError):
    """A query would spend more than is left of the budget."""


class Ledger:
    """What the queries over one table have spent: their epsilons add up, and none may bring the sum above the budget.

    Entries are small files in a folder that all executors share, so the ledger outlives a session; one driver spends at a
    time. A name that has been spent before is answered once more without new cost only if its epsilon and its seed are the same, as its noise is."""

    def __init__(self, spark: SparkSession, path: str, budget: float):
        self.spark, self.path, self.budget = spark, path, budget

    def entries(self) -> DataFrame:
        return self.spark.read.schema("name string, epsilon double, seed bigint").json(self.path)

    def spent(self) -> float:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return 0.0
        return float(self.entries().distinct().agg(F.coalesce(F.sum("epsilon"), F.lit(0.0))).first()[0])

    def spend(self, name: str, epsilon: float, seed: int = 0) -> None:
        if not epsilon > 0:
            raise ValueError("epsilon must be above 0")
        spent = self.spent()
        if spent and not self.entries().where((F.col("name") == name) & (F.col("epsilon") == epsilon) & (F.col("seed") == seed)).isEmpty():
            return
        if spent + epsilon > self.budget * (1 + 1e-12):
            raise Overspent(f"{name} asks for {epsilon}, {self.budget - spent:.6g} of {self.budget} is left")
        entry = self.spark.createDataFrame([(name, float(epsilon), seed)], "name string, epsilon double, seed bigint")
        entry.coalesce(1).write.mode("append").json(self.path)


def uniform(*key: Column | str) -> Column:
    """A number within (0, 1) that hangs on the key alone: reruns and other layouts give the same."""
    return (F.pmod(F.xxhash64(*key), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def laplace(scale: float, u: Column) -> Column:
    """A draw of Laplace's law from a uniform one."""
    return -scale * F.signum(u - 0.5) * F.log1p(-2 * F.abs(u - 0.5))


def private_counts(df: DataFrame, key: str, who: str, most: float, epsilon: float, ledger: Ledger, keys: DataFrame, name: str | None = None, secret: str | None = None, seed: int = 0) -> DataFrame:
    """key, n: noisy counts by key, in which each `who` weighs `most` rows at most.

    A `who` of more rows has each of them count in proportion, so that one more or less moves all counts together by `most` at
    most: noise of Laplace's law has the scale most / epsilon. keys: the keys to report, whether they occur or not (which
    keys occur would itself tell of somebody). Rows with a null `who` or key are not counted. Whoever knows `secret` (by
    default a new random one) can take the noise off; with a secret, name and seed that are kept, reruns agree."""
    name = name or f"counts by {key}"
    ledger.spend(name, epsilon, seed)
    by = df.where(F.col(key).isNotNull() & F.col(who).isNotNull()).groupBy(who, key).agg(F.count("*").alias("__k"))
    total = by.groupBy(who).agg(F.sum("__k").alias("__t"))
    clipped = by.join(total, who).withColumn("__w", F.col("__k") * F.least(F.lit(1.0), F.lit(float(most)) / F.col("__t")))
    sums = clipped.groupBy(F.col(key).alias("__key")).agg(F.sum("__w").alias("__s"))
    noise = laplace(most / epsilon, uniform(F.col(key), F.lit(name), F.lit(seed), F.lit(secret or uuid.uuid4().hex)))
    return keys.select(key).distinct().join(sums, F.col(key).eqNullSafe(F.col("__key")), "left").select(key, (F.coalesce("__s", F.lit(0.0)) + noise).alias("n"))
