"""Token counts by a separator scan.

A flat token file is nothing but identifiers, documents one after the other, each closed by an end-of-document
identifier; there is no index. Files are read by ranges of bytes, a block a range; each block is searched for the separator
at once, and a prefix scan over the blocks' summaries (separators seen, tokens after the last) stitches documents across
blocks. Neither a file nor a row need fit in memory, only a block.
"""

import base64
import functools
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import arrow_field, materialize, shared_dir, ship

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary's end-of-document identifier and the width of an identifier in bytes.
END, WIDTH = 50256, 2
#: Tokens of a block.
BLOCK = 1 << 18
_TYPES = {2: np.dtype("<u2"), 4: np.dtype("<u4")}


@functools.cache
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("flat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _fs(path: str):
    """(file system, its own path) of a path or URI that Arrow can open: local and shared folders, HDFS, S3, GCS, Azure."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or not path.startswith("file:") else "file://" + path[5:])


def write_flat(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end: int = END) -> DataFrame:
    """Writes the documents (doc_id, text) as flat token files in the folder path, one for each input partition, and returns
    file (its name), ordinal, doc_id: whose tokens stand where. The files hold identifiers alone.

    path must be a folder that all executors share. A file is written beside its name and then moved to it, so that a task
    that is run again writes over its own file. Null and empty texts are a lone separator. Texts are encoded whole; strings
    of special tokens are ordinary text. The table that is returned must be written once (see materialize) for the files to
    be there. Which document is in which file follows the input's partitions."""
    ship(docs.sparkSession)
    arrow = arrow_field(docs, "doc_id")

    def run(batches):
        from pyspark import TaskContext

        enc, task = _encoding(tokenizer), TaskContext.get()
        system, base = _fs(path)
        system.create_dir(base, recursive=True)
        name, number = f"part-{task.partitionId():06d}.bin", 0
        beside = f"{base}/_{name}-{task.taskAttemptId()}"
        with system.open_output_stream(beside) as out:
            for batch in batches:
                for text in batch.column("text").to_pylist():
                    out.write(np.array(enc.encode_ordinary(text or "") + [end], _TYPES[WIDTH]).tobytes())
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), pa.array(np.arange(number, number + n)), batch.column("doc_id").cast(arrow)], ["file", "ordinal", "doc_id"])
                number += n
        if number:
            system.move(beside, f"{base}/{name}")
        else:
            system.delete_file(beside)

    return docs.select("doc_id", "text").mapInArrow(run, f"file string, ordinal long, doc_id {docs.schema['doc_id'].dataType.simpleString()}")


def read_flat(spark: SparkSession, path: str, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """Flat token files (*.bin) in the folder path as rows: file (its name), block, data. Each row is one range of bytes,
    read by itself; the driver and the plan hold names and sizes only. Bytes after the last whole identifier are left out."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(path).select("path", F.floor(F.col("length") / width).alias("n")).where("n > 0")
    ranges = files.select("path", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / block))).alias("block"))
    parts = max(1, ranges.count() // 16)
    ranges = ranges.repartition(parts, "path", "block")

    def run(batches):
        for batch in batches:
            for uri, n, k in zip(*(batch.column(c).to_pylist() for c in ("path", "n", "block"))):
                system, own = _fs(uri)
                with system.open_input_file(own) as f:
                    data = f.read_at(min(block, n - k * block) * width, k * block * width)
                yield pa.RecordBatch.from_arrays([pa.array([own.rsplit("/", 1)[-1]]), pa.array([k], pa.int64()), pa.array([data], pa.binary())], ["file", "block", "data"])

    return ranges.mapInArrow(run, "file string, block long, data binary")


def scan(blocks: DataFrame, end: int = END, width: int = WIDTH) -> DataFrame:
    """file, ordinal (from 0), n_tokens (without the separator) of each document in blocks (file, block, data).

    Blocks of one file that follow each other must be numbered so; their sizes may differ.

    Tokens after a file's last separator are a document too, unless there are none. Empty blocks and null data hold
    nothing; an empty table gives an empty one."""
    ship(blocks.sparkSession)
    kind = dict(blocks.dtypes)["file"]

    def run(batches):
        for batch in batches:
            first, inner, last = [], [], []
            for data in batch.column("data").to_pylist():
                t = np.frombuffer(data or b"", _TYPES[width])
                at = np.flatnonzero(t == end)
                first.append(int(at[0]) if len(at) else None)
                inner.append((np.diff(at) - 1).tolist())
                last.append(len(t) - 1 - int(at[-1]) if len(at) else len(t))
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), pa.array(first, pa.int64()), pa.array(inner, pa.list_(pa.int64())), pa.array(last, pa.int64())], ["file", "block", "first", "inner", "last"])

    s = materialize(blocks.select("file", F.col("block").cast("long").alias("block"), "data").mapInArrow(run, f"file {kind}, block long, first long, inner array<long>, last long"))
    upto = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    small = s.select("file", "block", F.col("first").isNotNull().alias("has"), F.when(F.col("first").isNull(), 0).otherwise(F.size("inner") + 1).alias("closed"), "last")
    # within a run of blocks since the last one with a separator, what is open adds up
    small = small.withColumn("run", F.coalesce(F.sum(F.col("has").cast("int")).over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, 0)), F.lit(0)))
    since = W.partitionBy("file", "run").orderBy("block").rowsBetween(W.unboundedPreceding, 0)
    small = small.withColumn("open", F.sum("last").over(since)).withColumn("base", F.coalesce(F.sum("closed").over(upto), F.lit(0)))
    order = W.partitionBy("file").orderBy("block")
    small = small.select("file", "block", "base", F.coalesce(F.lag("open").over(order), F.lit(0)).alias("carry"), F.lead("block").over(order).isNull().alias("final"), "open", "has", "closed")
    x = s.join(small, ["file", "block"])
    head = F.when(F.col("has"), F.array(F.col("carry") + F.col("first"))).otherwise(F.array().cast("array<long>"))
    tail = F.when(F.col("final") & (F.col("open") > 0), F.array("open")).otherwise(F.array().cast("array<long>"))
    return x.select("file", "base", F.posexplode(F.concat(head, F.coalesce("inner", F.array().cast("array<long>")), tail)).alias("i", "n_tokens")).select("file", (F.col("base") + F.col("i")).cast("long").alias("ordinal"), "n_tokens")


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, end: int = END, block: int = BLOCK) -> DataFrame:
    """doc_id, file, ordinal, n_tokens: documents written as flat token files in the shared folder, and what the scan of
    those files counts.

    A row for each row of docs (doc_id, text), repeated rows too; null and empty texts have 0 tokens."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/loamwork-flat-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(at)
    system.deleteOnExit(at)
    ids = materialize(write_flat(docs, path, tokenizer, end))
    found = scan(read_flat(spark, path, WIDTH, block), end)
    return found.join(ids, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "n_tokens")
