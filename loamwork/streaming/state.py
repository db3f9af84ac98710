"""Keyed state with timers, and streams split against their own watermark."""

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..sources.files import scratch
from ..sources.tables import ship

# Spark plans state in a Python process that files added to the context don't reach, so the processor goes by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STORE = "spark.sql.streaming.stateStore.providerClass"


class Running(StatefulProcessor):
    """The running count and total of a key's sessions, which end after `idle` seconds without an event.

    State is one row a key, which a timer of event time clears when the key has been idle; a key that comes back later
    begins anew either way, so what is put out doesn't hang on when timers fire."""

    def __init__(self, idle: int):
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("running", "last long, n long, total double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        x = pd.concat(list(rows)).sort_values(["ts", "event_id"], kind="stable")
        last, n, total = self.state.get() if self.state.exists() else (None, 0, 0.0)
        counts, totals = [], []
        for ms, value in zip(x["ts"].astype("datetime64[ms]").astype("int64"), x["value"].fillna(0.0)):
            ms = int(ms)
            if last is not None and ms - last > 1000 * self.idle:
                n, total = 0, 0.0
            last, n, total = ms, n + 1, total + float(value)
            counts.append(n)
            totals.append(total)
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.state.update((last, n, total))
        self.handle.registerTimer(last + 1000 * self.idle + 1)
        yield pd.DataFrame({"user_id": [key[0]] * len(x), "event_id": x["event_id"], "n": counts, "total": totals})

    def handleExpiredTimer(self, key, timer_values, expired) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


def running_sessions(events: DataFrame, idle: int, late: str = "1 day") -> DataFrame:
    """user_id, event_id, n, total: for each event of a stream, how many its session has so far and the sum of their values.

    events: user_id, event_id, ts (a timestamp), value (null adds nothing). Within a micro-batch a user's events go by time
    and event_id; one micro-batch of a user is held at once, so `maxFilesPerTrigger` bounds it. Drain it with drain_state()."""
    ship(events.sparkSession)
    x = events.select("user_id", "event_id", "ts", "value").withWatermark("ts", late)
    return x.groupBy("user_id").transformWithStateInPandas(statefulProcessor=Running(idle), outputStructType="user_id long, event_id long, n long, total double", outputMode="Append", timeMode="EventTime")


def drain_state(stream: DataFrame, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Like events.drain() in append mode, with the state store that keyed state needs. The same path and checkpoint go on
    where an earlier run, ended or killed, has stopped."""
    spark = stream.sparkSession
    path, checkpoint = path or scratch(spark, "drained"), checkpoint or scratch(spark, "state")
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(_STORE, before)
    return spark.read.schema(stream.schema).parquet(path)


def split_late(stream: DataFrame, late: str, path: str, checkpoint: str, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """(rows on time, late rows) of a stream, as written under path: late rows are those older than `late` before the newest
    event time of all earlier micro-batches, which is where the batch's own watermark stands; a watermark would drop them.

    Every batch writes its two parts and its newest time to folders of its own number and reads only lower numbers, so a
    batch that runs again writes the same once more. Rows without a time are on time."""
    spark, fields = stream.sparkSession, stream.schema

    def newest_before(number: int):
        if number == 0:
            return None
        seen = spark.read.schema("newest timestamp, batch int").parquet(f"{path}/newest")
        return seen.where(F.col("batch") < number).agg(F.max("newest")).first()[0]

    def put(batch: DataFrame, number: int) -> None:
        newest = newest_before(number)
        behind = F.coalesce(F.col(ts) < F.lit(newest) - F.expr(f"interval {late}"), F.lit(False)) if newest else F.lit(False)
        marked = batch.withColumn("__late", behind).persist()  # the two parts read the source once
        marked.where("not __late").drop("__late").write.mode("overwrite").parquet(f"{path}/on/batch={number}")
        marked.where("__late").drop("__late").write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        marked.agg(F.max(ts).alias("newest")).write.mode("overwrite").parquet(f"{path}/newest/batch={number}")
        marked.unpersist()

    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return tuple(spark.read.schema(fields).parquet(f"{path}/{part}") for part in ("on", "late"))
