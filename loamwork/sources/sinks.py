"""Sinks: documents, TSV reports, writes that are skipped, gated or idempotent, and tables between rounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import scratch


def render(lines: DataFrame, order: str = "line_no", line: str = "line") -> DataFrame:
    """doc_id, text: a document's lines in order, one text each."""
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(line).alias("t"))))
    return lines.groupBy("doc_id").agg(F.array_join(F.transform(parts, lambda p: p["t"]), "\n").alias("text"))


def tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("sep", "\t").option("header", True).csv(path)


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, sha256, n_bytes, n_chars, n_lines of each text."""
    return docs.select("doc_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("n_bytes"), F.length("text").cast("long").alias("n_chars"), F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"))


def changed(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of new (doc_id, text) whose text differs from old's or that old lacks: what an idempotent write writes."""
    a = old.select("doc_id", F.sha2("text", 256).alias("__h"))
    return new.join(a, "doc_id", "left").where(F.col("__h").isNull() | (F.col("__h") != F.sha2("text", 256))).drop("__h")


def gated(docs: DataFrame, baseline: DataFrame, normal) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): docs whose normalised text hashes as in baseline (doc_id, sha256), and the others."""
    x = docs.join(baseline.select("doc_id", F.col("sha256").alias("__b")), "doc_id", "left").withColumn("__ok", F.coalesce(F.col("__b") == F.sha2(normal(F.col("text")), 256), F.lit(False)))
    return x.where("__ok").drop("__ok", "__b"), x.where("not __ok").drop("__ok", "__b")


def checkpointed(df: DataFrame) -> DataFrame:
    """df as a written table in the folder that all executors share (spark.checkpoint.dir): its lineage ends here, a lost
    executor costs no earlier work, and the planner sees the sizes of files (a checkpoint keeps estimates, which multiply from
    round to round)."""
    path = scratch(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
