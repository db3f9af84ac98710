"""Sessions, tables and the document sources: page arrays, overlays, rules and allow-lists."""

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def session(app: str = "loamwork", **conf: str) -> SparkSession:
    """A session with UTC time, adaptive plans and Arrow; conf overrides (dots as double underscores)."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.execution.arrow.pyspark.enabled", "true")
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Sends the package to the Python workers, once a context, unless it is on their path."""
    root, context = Path(__file__).resolve().parents[2], spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_loamwork_sent", False):
        return
    to = tempfile.mkdtemp(prefix="loamwork-")
    context.addPyFile(shutil.make_archive(f"{to}/loamwork", "zip", root, "loamwork"))
    context._loamwork_sent = True


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of sf_dir as a parquet scan (columns and filters are pushed into it)."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sized(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """df, to be broadcast if it has at most so many rows (it reads no more than it must to tell)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def page_array(df: DataFrame, json: str = "value", doc: str = "doc_id") -> DataFrame:
    """doc_id, page_no (from 1), text: a row for each page of a JSON array of pages. Null or broken JSON has none."""
    return df.select(doc, F.posexplode(F.from_json(json, "array<string>")).alias("p", "text")).select(doc, (F.col("p") + 1).alias("page_no"), "text")


def form_feed_pages(df: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """doc_id, page_no, text: pages of text parted by form feeds."""
    return df.select(doc, F.posexplode(F.split(text, "\f", -1)).alias("p", "text")).select(doc, (F.col("p") + 1).alias("page_no"), "text")


def overlay(layers: list[DataFrame], key: str) -> DataFrame:
    """The rows of layers by name, a later layer's row in place of an earlier one's; columns by name."""
    every = None
    for i, x in enumerate(layers):
        x = x.withColumn("__p", F.lit(i))
        every = x if every is None else every.unionByName(x)
    return every.withColumn("__r", F.row_number().over(W.partitionBy(key).orderBy(F.desc("__p")))).where("__r = 1").drop("__p", "__r")


def _placed(df: DataFrame) -> DataFrame:
    """df, read from files, with __at: a row's place by file, split and line. A task reads a split from its first row to its
    last, so numbers that grow within a task follow the lines of a split."""
    return df.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n")).alias("__at"))


def csv_dict(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A headed CSV keyed by `key`; of rows with one key the last counts (files go by name), and a byte-order mark is not part
    of a name."""
    df = spark.read.option("header", True).csv(path)
    names = [c.lstrip("﻿") for c in df.columns]
    rows = _placed(df).toDF(*names, "__at")
    return rows.groupBy(key).agg(F.max_by(F.struct(*(f"`{c}`" for c in names if c != key)), "__at").alias("__v")).select(*(F.col(key) if c == key else F.col(f"__v.`{c}`") for c in names))


def allow_list(spark: SparkSession, path: str) -> DataFrame:
    """rule_order (from 1, by file and line) and five columns of TSV allow-lists; blank lines, # comments and headers are left
    out, short rows padded. A split is numbered by itself, behind what the splits before it hold."""
    x = _placed(spark.read.text(path)).where("trim(value) <> '' and not startswith(value, '#') and not startswith(value, 'volume\t')")
    split = [F.col("__at.file"), F.col("__at.start")]
    counts = x.groupBy(split[0].alias("__f"), split[1].alias("__s")).agg(F.count("*").alias("__n"))
    before = counts.select("__f", "__s", F.coalesce(F.sum("__n").over(W.orderBy("__f", "__s").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__b"))  # a row a split
    x = x.withColumn("__r", F.row_number().over(W.partitionBy(*split).orderBy("__at.n"))).join(before, (split[0] == F.col("__f")) & (split[1] == F.col("__s")))
    part = F.split("value", "\t", -1)
    names = ("volume", "check", "found", "context_regex", "reason")
    return x.select((F.col("__r") + F.col("__b")).alias("rule_order"), *(F.coalesce(F.get(part, F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)))
