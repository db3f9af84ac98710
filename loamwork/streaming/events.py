"""Structured Streaming over event tables: event-time windows, watermarks, late rows and incremental dedup."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import scratch


def event_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A file stream of the parquet files under path (a folder or a glob; a lone file as a glob). ts becomes a TIMESTAMP: watermarks reject TIMESTAMP_NTZ."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, size: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Counts and sums by event type and window, behind a watermark."""
    x = events.withWatermark("ts", late) if late else events
    x = x.groupBy("event_type", F.window("ts", size).alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return x.select("event_type", F.col("w.start").alias("start"), "n", "total")


def sliding(events: DataFrame, size: str = "1 hour", step: str = "30 minutes", late: str = "1 day") -> DataFrame:
    x = events.withWatermark("ts", late).groupBy(F.window("ts", size, step).alias("w")).agg(F.count("*").alias("n"))
    return x.select(F.col("w.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    x = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return x.select("user_id", F.col("w.start").alias("start"), "n")


def first_seen(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Rows without those whose event_id came before, as far back as the watermark keeps."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def side_output(events: DataFrame, newest, late: str) -> tuple[DataFrame, DataFrame]:
    """(events on time, late ones): those older than `late` before the newest event time seen, which a watermark would drop."""
    behind = F.col("ts") < newest - F.expr(f"interval {late}")
    return events.where(~behind), events.where(behind)


def drain(stream: DataFrame, mode: str = "append", checkpoint: str | None = None, path: str | None = None) -> DataFrame:
    """Runs a stream over all that there is now and returns what it put out, as written files: nothing is on the driver.

    path: a folder that all executors share (default: a new one). Append writes each batch's rows; complete and update
    write each batch to its own folder, of which complete keeps the last."""
    path = path or scratch(stream.sparkSession, "drained")
    checkpoint = checkpoint or scratch(stream.sparkSession, "state")
    if mode == "append":
        w = stream.writeStream.format("parquet").option("path", path).outputMode(mode)
    else:
        w = stream.writeStream.foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(path if mode == "complete" else f"{path}/batch={number}")).outputMode(mode)
    w.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def upsert_batches(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Writes each micro-batch to its own folder under path, so that a batch run again overwrites itself: exactly once."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
