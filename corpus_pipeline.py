"""A training-data pipeline over `documents`: rules, line dedup, near-duplicate join, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; what is between stages is written
as Parquet in the shared folder and read again. All stages but the last return the columns of `documents`; the last
returns the mixed corpus, a row for each part of a document in a slot of an output shard.
"""

from pyspark.sql import DataFrame, SparkSession

from loamwork.llm.common import materialize, release, table
from loamwork.llm.decontaminate import decontaminate
from loamwork.llm.jaccard_join import jaccard_dedup
from loamwork.llm.line_dedup import line_dedup
from loamwork.llm.mixing import mix
from loamwork.llm.quality_rules import kept_rows


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that every quality rule keeps."""
    return kept_rows(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeated runs of lines; n_chars follows the text."""
    out = line_dedup(docs)
    if "n_chars" in docs.columns:
        out = out.selectExpr(*("cast(length(text) as bigint) as n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones."""
    return jaccard_dedup(docs).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: shard, slot_key, source, block, piece, doc_id, n_words, text."""
    pieces, _ = mix(docs)
    return pieces.select("shard", "slot_key", "source", "block", "piece", "doc_id", "n_words", "text")


STAGES = [("quality_rules", rules), ("line_dedup", lines), ("near_duplicates", near_duplicates), ("decontaminate", benchmark), ("mix", mixture)]
#: SQL can't express winnowing or the mix; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs)
            if before is not None:
                release(before)
            before = docs
    return docs
