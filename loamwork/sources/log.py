"""A replayable, partitioned log: appended in numbered segments, read as a stream with an offset for each partition.

A segment is one file of one partition, `p=<partition>/<segment>.parquet`; its rows keep the order in which they were
appended. Files are reached through Arrow's file systems (local and network folders, HDFS, S3, GCS, Azure)."""

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .tables import ship

# Spark plans sources in a Python process that files added to the context don't reach, so the classes go by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _at(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}" if path.startswith("/") and not path.startswith("file:") else path.replace("file:/", "file:///", 1))


def append(df: DataFrame, path: str, key: str, order: list[str], partitions: int) -> None:
    """Appends df as the next segment of each of the log's partitions: rows go by a hash of key (nulls to one partition) and
    lie in `order` within a segment. A partition without rows gets an empty segment, so that all have equally many.

    A task writes its partition's segment in pieces under a hidden name and then gives it its number, so a task that runs
    again leaves no second copy. There is one writer at a time."""
    ship(df.sparkSession)
    number, fields = segments(path, 0), df.schema
    dealt = df.withColumn("__p", F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int"))
    every = df.sparkSession.range(partitions).select(F.col("id").cast("int").alias("__p"), F.lit(True).alias("__none"))
    dealt = every.unionByName(dealt.withColumn("__none", F.lit(False)), allowMissingColumns=True)
    dealt = dealt.repartition(partitions, "__p").sortWithinPartitions("__p", F.desc("__none"), *order).select("__p", "__none", *(f"`{f.name}`" for f in fields))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        try_, out, now = TaskContext.get().taskAttemptId(), None, None
        files, base = _at(path)

        def close():
            if out is not None:
                out.close()
                files.move(f"{base}/p={now}/.{number}-{try_}", f"{base}/p={now}/{number:09d}.parquet")

        for batch in batches:
            part = batch.column(0).to_numpy()
            cuts = [0, *(i for i in range(1, len(part)) if part[i] != part[i - 1]), len(part)]
            for a, b in zip(cuts, cuts[1:]):
                rows = batch.slice(a, b - a)
                if part[a] != now:
                    close()
                    now = int(part[a])
                    files.create_dir(f"{base}/p={now}", recursive=True)
                    out = pq.ParquetWriter(files.open_output_stream(f"{base}/p={now}/.{number}-{try_}"), pa.schema(list(rows.schema)[2:]))
                rows = rows.filter(pa.compute.invert(rows.column(1)))
                out.write_table(pa.Table.from_batches([rows.select(range(2, rows.num_columns))]))
        close()
        yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32())], ["n"])

    dealt.mapInArrow(write, "n int").count()


def segments(path: str, partition: int) -> int:
    """How many segments a partition has."""
    files, base = _at(path)
    found = files.get_file_info(pafs.FileSelector(f"{base}/p={partition}", allow_not_found=True))
    return sum(f.base_name.endswith(".parquet") and not f.base_name.startswith(".") for f in found)


class _Span(InputPartition):
    def __init__(self, partition: int, first: int, past: int):
        self.partition, self.first, self.past = partition, first, past


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.most = options["path"], int(options.get("maxsegments", 0))
        self.start = {int(k): int(v) for k, v in json.loads(options.get("startingoffsets", "{}")).items()}
        files, base = _at(self.path)
        self.parts = sorted(int(f.base_name[2:]) for f in files.get_file_info(pafs.FileSelector(base, allow_not_found=True)) if f.base_name.startswith("p="))
        self.now: dict[int, int] | None = None

    def initialOffset(self) -> dict:
        return {str(p): self.start.get(p, 0) for p in self.parts}

    def latestOffset(self) -> dict:
        """What there is; with maxSegments, at most so many segments a partition beyond what was read."""
        end = {p: segments(self.path, p) for p in self.parts}
        if self.most:
            at = self.now if self.now is not None else {p: self.start.get(p, 0) for p in self.parts}
            end = {p: min(n, at.get(p, 0) + self.most) for p, n in end.items()}
        return {str(p): n for p, n in end.items()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.now = {int(p): n for p, n in end.items()}
        return [_Span(int(p), start.get(p, 0), n) for p, n in end.items() if n > start.get(p, 0)]

    def read(self, partition: _Span) -> Iterator[pa.RecordBatch]:
        files, base = _at(self.path)
        for k in range(partition.first, partition.past):
            with files.open_input_file(f"{base}/p={partition.partition}/{k:09d}.parquet") as f:
                for batch in pq.ParquetFile(f).iter_batches(10_000):
                    n = batch.num_rows
                    extra = [pa.array([partition.partition] * n, pa.int32()), pa.array([k] * n, pa.int64())]
                    yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "log_partition", "log_segment"])

    def commit(self, end: dict) -> None:
        pass


class LogSource(DataSource):
    """format("loamwork_log"): options path, fields (a schema in JSON), startingOffsets (JSON, by partition), maxSegments."""

    @classmethod
    def name(cls) -> str:
        return "loamwork_log"

    def schema(self) -> StructType:
        return StructType([*StructType.fromJson(json.loads(self.options["fields"])), StructField("log_partition", IntegerType()), StructField("log_segment", LongType())])

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Reader(dict(self.options))


def log_stream(spark: SparkSession, path: str, schema: StructType, start: dict[int, int] | None = None, most: int = 0) -> DataFrame:
    """A stream of the log's rows with log_partition and log_segment, from `start` (segments to pass over, by partition; not
    named: none), at most `most` segments of a partition a batch (0: all there are; a run over what is available now is one batch). The offsets of what was read are in the
    query's checkpoint: a restart goes on behind them, and a new query with the same start reads the same rows again."""
    ship(spark)
    spark.dataSource.register(LogSource)
    x = spark.readStream.format("loamwork_log").option("path", path).option("fields", schema.json())
    return x.option("startingOffsets", json.dumps({str(k): v for k, v in (start or {}).items()})).option("maxSegments", most).load()
