"""Models by Spark's own library, fitted on training rows only, and a registered table function."""

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register(spark: SparkSession) -> None:
    """Registers find_all(text, pattern) as a table function: first, past (code points), found, groups."""

    @F.udtf(returnType="first int, past int, found string, groups array<string>")
    class FindAll:
        def eval(self, text: str, pattern: str):
            for m in re.finditer(pattern, text or ""):
                yield m.start(), m.end(), m[0], list(m.groups())

    spark.udtf.register("find_all", FindAll)


def _assembled(df: DataFrame, columns: list[str], scaled: bool = True, centred: bool = True) -> DataFrame:
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    x = VectorAssembler(inputCols=columns, outputCol="__v", handleInvalid="skip").transform(df)
    if not scaled:
        return x.withColumnRenamed("__v", "__f")
    return StandardScaler(inputCol="__v", outputCol="__f", withMean=centred).fit(x).transform(x).drop("__v")


def itemsets(baskets: DataFrame, items: str, support: float) -> DataFrame:
    """items, freq of sets in at least a share `support` of baskets, by FP-growth."""
    from pyspark.ml.fpm import FPGrowth

    return FPGrowth(itemsCol=items, minSupport=support).fit(baskets).freqItemsets


def kmeans(df: DataFrame, columns: list[str], k: int, seed: int = 1) -> DataFrame:
    """df with cluster, by k-means over scaled columns; rows with nulls in them are left out."""
    from pyspark.ml.clustering import KMeans

    x = _assembled(df, columns)
    return KMeans(featuresCol="__f", predictionCol="cluster", k=k, seed=seed).fit(x).transform(x).drop("__f")


def pca_shares(df: DataFrame, columns: list[str], train=None) -> DataFrame:
    """component, share, falls (no more than the one before), sums (all are 1 together): variance by principal component, of
    the rows for which `train` (a condition; default: all) holds."""
    from pyspark.ml.feature import PCA

    fitted = df if train is None else df.where(train)
    shares = PCA(k=len(columns), inputCol="__f", outputCol="__c").fit(_assembled(fitted, columns)).explainedVariance.toArray().tolist()
    rows = [(i + 1, s, i == 0 or s <= shares[i - 1] + 1e-12, abs(sum(shares) - 1) < 1e-9) for i, s in enumerate(shares)]
    return df.sparkSession.createDataFrame(rows, "component int, share double, falls boolean, sums boolean")


def cross_validated(df: DataFrame, columns: list[str], label: str, key: str, folds: int) -> DataFrame:
    """One row: auc, the mean over folds (by a hash of key, so that reruns agree) of a logistic model's AUC out of fold."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    x = _assembled(df.withColumn("__k", F.pmod(F.xxhash64(key), F.lit(folds)).cast("int")).withColumn("label", F.col(label).cast("double")), columns)
    model = LogisticRegression(featuresCol="__f", maxIter=20)
    cv = CrossValidator(estimator=model, estimatorParamMaps=ParamGridBuilder().addGrid(model.regParam, [0.01]).build(), evaluator=BinaryClassificationEvaluator(), numFolds=folds, foldCol="__k")
    return df.sparkSession.createDataFrame([(float(cv.fit(x).avgMetrics[0]),)], "auc double")


def bootstrap_mean(df: DataFrame, column: str, key: str, rounds: int, seed: int = 1) -> DataFrame:
    """One row: mean, lo, hi: the middle 95 % of means over Poisson resamples, in one pass: each row draws its times in
    every round from a hash of the round, the seed and its key, so nothing is copied and other layouts give the same."""
    law, cut = [], 0.0  # of a Poisson variate of mean 1
    for k in range(8):
        cut += math.exp(-1) / math.factorial(k)
        law.append(cut)

    x = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"), F.col(key).alias("u"))
    # rows are exploded before they are drawn: compiled code hashes a row once a round, a function over an array once a cut
    each = x.select("v", "u", F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("__r"))
    each = each.withColumn("p", F.pmod(F.xxhash64("u", "__r", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30))
    drawn = each.select("v", (F.col("__r") - 1).alias("r"), sum((F.when(F.col("p") >= c, 1).otherwise(0) for c in law), F.lit(0)).alias("k")).where("k > 0")
    means = drawn.groupBy("r").agg((F.sum(F.col("k") * F.col("v")) / F.sum("k")).alias("m"))
    whole = x.agg(F.avg("v").alias("mean"))
    spread = means.agg(F.sort_array(F.collect_list("m")).alias("a"))  # a value a round
    return whole.crossJoin(spread).select("mean", F.get("a", F.lit(int(0.025 * rounds))).alias("lo"), F.get("a", F.lit(int(0.975 * rounds) - 1)).alias("hi"))


def private_counts(df: DataFrame, key: str, epsilon: float, seed: int = 1) -> DataFrame:
    """key, n: counts with Laplace noise of scale 1 / epsilon, a hash of key and seed. Budgets and clipping: privacy.py."""
    from .privacy import laplace, uniform

    return df.groupBy(key).agg(F.count("*").alias("c")).select(key, (F.col("c") + laplace(1 / epsilon, uniform(F.col(key), F.lit(seed)))).alias("n"))


def term_rows(docs: DataFrame, buckets: int) -> DataFrame:
    """doc_id, at, tf: each text's words counted in `buckets` hashed columns (sparse: the columns that occur, ascending).
    Texts without words have no row."""
    from .relational import counted

    word = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    column = F.transform(word, lambda w: F.format_string("%09d", F.pmod(F.xxhash64(w), F.lit(buckets))))
    x = docs.select("doc_id", counted(column).alias("c")).where("size(c) > 0")
    return x.select("doc_id", F.transform("c", lambda v: v["value"].cast("int")).alias("at"), F.transform("c", lambda v: v["n"].cast("double")).alias("tf"))


def singular_values(rows: DataFrame, columns: int, k: int, extra: int = 12, rounds: int = 60, tolerance: float = 1e-9, seed: int = 1):
    """(values, vectors): the k largest singular values of a sparse matrix (rows: at, tf) and its right vectors (columns x k).

    A random range of k + extra directions (Halko, Martinsson, Tropp) is multiplied by the matrix and back, round after round,
    until the values stand still. A round is one pass over the rows: each task adds up its own part of a columns x (k + extra)
    table, and Spark sums the parts by column; the table (columns are hashed, so its size is fixed) is all that the driver has."""
    import numpy as np
    import pandas as pd

    from ..sources.tables import ship

    spark, width = rows.sparkSession, k + extra
    ship(spark)
    width = min(width, columns)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(columns, width)))[0]
    before = None
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(q)

        def run(batches, shared=shared):
            q, out = shared.value, np.zeros((columns, width))
            for x in batches:
                for at, tf in zip(x["at"], x["tf"]):
                    at, tf = np.asarray(at, np.int64), np.asarray(tf, float)
                    out[at] += np.outer(tf, tf @ q[at])
            some = np.flatnonzero(out.any(axis=1))
            yield pd.DataFrame({"c": some.astype("int32"), "v": list(out[some])})

        parts = rows.select("at", "tf").mapInPandas(run, "c int, v array<double>")
        summed = parts.select("c", F.posexplode("v").alias("i", "v")).groupBy("c", "i").agg(F.sum("v").alias("v")).toPandas()
        z = np.zeros((columns, width))
        z[summed["c"], summed["i"]] = summed["v"]
        shared.destroy()
        small, turn = np.linalg.eigh((q.T @ z + z.T @ q) / 2)
        values, vectors = np.sqrt(np.maximum(small[::-1][:k], 0)), (q @ turn)[:, ::-1][:, :k]
        if before is not None and np.all(np.abs(values - before) <= tolerance * np.maximum(values[0], 1e-300)):
            break
        before, q = values, np.linalg.qr(z)[0]
    return values, vectors


def tree_grid(df: DataFrame, columns: list[str], label: str, key: str, folds: int, depths: list[int], leaves: list[int], seed: int = 1) -> DataFrame:
    """depth, least_rows, auc, spread: out-of-fold AUC (mean and standard deviation over folds) of a decision tree at every
    point of the grid.

    A row's fold is a hash of its key, so reruns and other layouts agree; missing values are filled with the median of the
    training folds by a stage of the pipeline, which is fitted on them alone. Rows without a label are left out."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import Imputer, VectorAssembler
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    x = df.where(F.col(label).isNotNull()).select(F.pmod(F.xxhash64(key), F.lit(folds)).cast("int").alias("__k"), F.col(label).cast("double").alias("label"), *(F.col(c).cast("double").alias(c) for c in columns))
    tree = DecisionTreeClassifier(featuresCol="__f", seed=seed)
    steps = Pipeline(stages=[Imputer(strategy="median", inputCols=columns, outputCols=[f"__{c}" for c in columns]), VectorAssembler(inputCols=[f"__{c}" for c in columns], outputCol="__f"), tree])
    grid = ParamGridBuilder().addGrid(tree.maxDepth, depths).addGrid(tree.minInstancesPerNode, leaves).build()
    fitted = CrossValidator(estimator=steps, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(), numFolds=folds, foldCol="__k", collectSubModels=False).fit(x)
    rows = [(g[tree.maxDepth], g[tree.minInstancesPerNode], float(a), float(s)) for g, a, s in zip(grid, fitted.avgMetrics, fitted.stdMetrics)]
    return df.sparkSession.createDataFrame(rows, "depth int, least_rows int, auc double, spread double")


def divided(df: DataFrame, columns: list[str], k: int, seed: int = 1) -> DataFrame:
    """df with cluster: k clusters by dividing the largest in two again and again (bisecting k-means over scaled columns);
    rows with nulls in them are left out."""
    from pyspark.ml.clustering import BisectingKMeans

    x = _assembled(df, columns, centred=False)  # centres are parted by noise in proportion to them: none may be the origin
    return BisectingKMeans(featuresCol="__f", predictionCol="cluster", k=k, seed=seed).fit(x).transform(x).drop("__f")
