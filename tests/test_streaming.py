"""Streams over files drained to the end equal the batch result."""

from loamwork.streaming import events as S
from pyspark.sql import functions as F


def write(spark, path, rows):
    df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double").withColumn("ts", F.to_timestamp_ntz("ts"))
    df.coalesce(1).write.mode("append").parquet(path)


def test_tumbling_equals_batch(spark, sf, tmp_path):
    path = f"file://{tmp_path}/e"
    spark.read.parquet(f"{sf}/events.parquet").repartitionByRange(3, "ts").write.parquet(path)
    got = S.drain(S.tumbling(S.event_stream(spark, path, 10), late="100 days"), "complete")
    want = S.tumbling(spark.read.parquet(path).withColumn("ts", F.col("ts").cast("timestamp")), late="")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 0


def test_late_rows_drop_and_duplicates_go(spark, tmp_path):
    path = f"file://{tmp_path}/e"
    write(spark, path, [(1, "2024-01-01 00:00:00", 1, "a", 1.0), (2, "2024-01-01 05:00:00", 1, "a", 1.0)])
    checkpoint = f"file://{tmp_path}/c"
    out = f"file://{tmp_path}/out"
    run = lambda: S.upsert_batches(S.tumbling(S.event_stream(spark, path), late="10 minutes"), out, checkpoint)
    run()
    write(spark, path, [(3, "2024-01-01 00:30:00", 1, "a", 1.0), (4, "2024-01-01 09:00:00", 1, "a", 1.0)])
    run()
    got = {str(r["start"]): r["n"] for r in spark.read.parquet(out).collect()}
    assert got == {"2024-01-01 00:00:00": 1, "2024-01-01 05:00:00": 1}
    twice = f"file://{tmp_path}/t"
    write(spark, twice, [(1, "2024-01-01 00:00:00", 1, "a", 1.0)] * 2 + [(2, "2024-01-01 00:00:01", 1, "a", 1.0)])
    assert S.drain(S.first_seen(S.event_stream(spark, twice))).count() == 2


def test_sessions_and_sliding(spark, tmp_path):
    path = f"file://{tmp_path}/e"
    write(spark, path, [(1, "2024-01-01 00:00:00", 1, "a", 1.0), (2, "2024-01-01 01:00:00", 1, "a", 1.0), (3, "2024-01-02 00:00:00", 1, "a", 1.0)])
    got = S.drain(S.sessions(S.event_stream(spark, path), late="30 days"), "complete").collect()
    assert sorted(r["n"] for r in got) == [1, 2]
    assert sum(r["n"] for r in S.drain(S.sliding(S.event_stream(spark, path), late="30 days"), "complete").collect()) == 6
