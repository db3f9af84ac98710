"""Mixing sources to target weights.

Each source's words, document after document, are packed into blocks of a fixed length. Every output shard draws
multinomial counts of slots per source; a source's k-th slot is mapped through that source's pseudorandom
permutation of its blocks (a new one for each pass over them), and blocks are joined to slots by index.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import GAP, WORD, materialize

#: So many sources at most: they are the mix's own configuration, and their sums are worked out on the driver.
MAX_SOURCES = 100_000
#: Documents of a source that one task numbers.
GROUP_ROWS = 20_000
#: Rows that repeat and are numbered together, at most.
COPIES = 1_000
#: Slots that one row is spread to at a time: a hot source's slots in a shard are many such runs, in many tasks.
SLOT_RUN = 100_000
#: Slots that one task makes, about; their number sets the tasks, as the few bytes they are made from would give one.
SLOTS_A_TASK = 500_000


def targets(sizes: list[tuple[str | None, int]], total: int | None = None, most: float = 3.0) -> list[float]:
    """Words to take from each (source, size): by weights 1, 2, 3, 1, ... over sources by code point, null last.

    They sum to `total` (default: all sizes), none above `most` times its size; what a source can't take is shared
    again by weight until none is above."""
    order = sorted(range(len(sizes)), key=lambda i: (sizes[i][0] is None, (sizes[i][0] or "").encode()))
    weight = [0.0] * len(sizes)
    for k, i in enumerate(order):
        weight[i] = 1.0 + k % 3
    left, open_, out = float(sum(n for _, n in sizes) if total is None else total), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        all_w = sum(weight[i] for i in sorted(open_))
        share = {i: left * weight[i] / all_w for i in open_}
        over = [i for i in open_ if share[i] > most * sizes[i][1]]
        if not over:
            for i in open_:
                out[i] = share[i]
            break
        for i in sorted(over):
            out[i] = most * sizes[i][1]
            left -= out[i]
            open_.remove(i)
    return out


def _draw(counts: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Slots per shard and source: each shard draws multinomially from what is left, so that columns sum to counts."""
    rng, left, out = np.random.default_rng(seed), counts.astype(np.int64).copy(), np.zeros((shards, len(counts)), np.int64)
    for k in range(shards):
        room = int(left.sum()) // (shards - k)
        if k == shards - 1:
            out[k] = left
        elif room:
            got = np.minimum(rng.multinomial(room, left / left.sum()), left)
            while (short := room - int(got.sum())) > 0:
                rest = left - got
                got += np.minimum(rng.multinomial(short, rest / rest.sum()), rest)
            out[k] = got
        left -= out[k]
    return out


def _permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """index under a pseudorandom permutation of range(n) that key chooses: four Feistel rounds, walked until inside."""
    u = np.uint64
    index, n, key = index.astype(u), n.astype(u), key.astype(u)
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n.astype(float), 2)) / 2)).astype(u)
    low = (u(1) << half) - u(1)
    out, todo = index.copy(), np.arange(len(index))
    with np.errstate(over="ignore"):
        while len(todo):
            x, h, m, k = out[todo], half[todo], low[todo], key[todo]
            a, b = x >> h, x & m
            for r in range(4):
                f = (b + k + u(r + 1) * u(0x9E3779B97F4A7C15)) * u(0xD6E8FEB86659FD93)
                f = (f ^ (f >> u(31))) * u(0xA0761D6478BD642F)
                a, b = b, a ^ ((f >> u(33)) & m)
            out[todo] = (a << h) | b
            todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def _source_key():
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))


def numbered(docs: DataFrame) -> DataFrame:
    """A light row for each document: doc_id, source, __key (its source's), size, __from and __to (its words' place
    in its source), __group and __row (which identify the row). Ends lineage.

    Places are a prefix sum in two steps: within groups of about GROUP_ROWS documents by hash, then over the groups. Rows that
    repeat are counted first and dealt out in chunks of at most COPIES, each in a group of its own hash."""
    light = docs.select("doc_id", "source", _source_key().alias("__key"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64("text").alias("__t"))
    light = materialize(light.groupBy("doc_id", "source", "__key", "size", "__t").agg(F.count("*").alias("__c")))
    groups = max(1, -(-(light.agg(F.sum("__c")).first()[0] or 0) // GROUP_ROWS))
    chunks = light.withColumn("__at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__c") - 1, F.lit(COPIES).cast("long"))))
    chunks = chunks.withColumn("__n", F.least(F.lit(COPIES).cast("long"), F.col("__c") - F.col("__at")))
    w = W.partitionBy("__key", "__group").orderBy(F.col("doc_id").asc_nulls_last(), "__t", "__at").rowsBetween(W.unboundedPreceding, 0)
    light = (
        chunks.withColumn("__group", F.pmod(F.xxhash64("doc_id", "__t", "__at", F.lit(7)), F.lit(groups)).cast("int"))
        .withColumn("__rows", F.sum("__n").over(w) - F.col("__n"))
        .withColumn("__upto", F.sum(F.col("size") * F.col("__n")).over(w) - F.col("size") * F.col("__n"))
    )
    light = materialize(light.drop("__c", "__at"))
    before = light.groupBy("__key", "__group").agg(F.sum(F.col("size") * F.col("__n")).alias("__s"))
    before = before.select("__key", "__group", (F.sum("__s").over(W.partitionBy("__key").orderBy("__group")) - F.col("__s")).alias("__before"))
    out = light.join(before, ["__key", "__group"]).withColumn("__i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)))
    start = F.col("__before") + F.col("__upto") + F.col("__i") * F.col("size")
    row = (F.col("__rows") + F.col("__i") + 1).alias("__row")
    return out.select("doc_id", "source", "__key", "__t", "__group", row, "size", start.alias("__from"), (start + F.col("size")).alias("__to"))


def mix(docs: DataFrame, block_words: int = 32, shards: int = 64, seed: int = 1, with_text: bool = True) -> tuple[DataFrame, DataFrame]:
    """(pieces, plan). docs: doc_id, text, source; other columns are left alone.

    pieces, a row for each part of a document in a slot: shard, slot_key (the order in the shard), source, block, piece
    (the order in the slot), doc_id, n_words, and text if asked for. plan, a row for each document: doc_id, source, size,
    source_size, target and the columns that identify it. A null or empty text has no words and no piece; a null source
    is a source; rows that repeat count each; an empty table gives empty ones. The same input and seed give the same mix.
    No block is used over ceil(3) times: counts of slots are rounded targets in blocks of the source's mean length."""
    spark = docs.sparkSession
    light = materialize(numbered(docs))
    sums = light.groupBy("__key").agg(F.first("source").alias("source"), F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(sums) > MAX_SOURCES:
        raise ValueError(f"over {MAX_SOURCES} sources")
    sums.sort(key=lambda r: r["__key"])
    want = targets([(r["source"], r["n"]) for r in sums])
    blocks = [-(-r["n"] // block_words) for r in sums]
    counts = np.array([min(3 * b, round(t * b / r["n"])) if r["n"] else 0 for r, t, b in zip(sums, want, blocks)], np.int64)
    rows = [(r["__key"], int(r["n"]), float(t), int(b)) for r, t, b in zip(sums, want, blocks)]
    plan_of = spark.createDataFrame(rows or [("", 0, 0.0, 0)], "__key string, source_size long, target double, __blocks long")
    plan = light.join(F.broadcast(plan_of), "__key")

    drawn = _draw(counts, shards, seed) if len(counts) else np.zeros((0, 0), np.int64)
    first = np.cumsum(drawn, axis=0) - drawn if drawn.size else drawn
    k, of = np.nonzero(drawn)
    column = lambda i, kind: pa.array([r[i] for r in rows], kind).take(pa.array(of))
    cells = pa.table({"shard": pa.array(k, pa.int32()), "__key": column(0, pa.string()), "first": pa.array(first[k, of], pa.int64()), "n": pa.array(drawn[k, of], pa.int64()), "blocks": column(3, pa.int64()), "s": pa.array(of, pa.int32())})
    slots = spark.createDataFrame(cells, "shard int, __key string, first long, n long, blocks long, s int")
    past = F.col("first") + F.col("n")
    slots = slots.select("shard", "__key", "blocks", "s", past.alias("past"), F.explode(F.sequence("first", past - 1, F.lit(SLOT_RUN).cast("long"))).alias("at")).repartition(max(1, -(-int(counts.sum()) // SLOTS_A_TASK)), "shard", "__key", "at")
    slots = slots.select("shard", "__key", "blocks", "s", F.explode(F.sequence("at", F.least(F.col("at") + SLOT_RUN, "past") - 1)).alias("k"))

    def place(frames):
        for x in frames:
            turn = x.k // x.blocks
            key = (x.s.to_numpy().astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F) + turn.to_numpy().astype(np.uint64) * np.uint64(0x165667B19E3779F9) + np.uint64(seed)
            block = _permuted((x.k % x.blocks).to_numpy(), x.blocks.to_numpy(), key)
            yield pd.DataFrame({"shard": x["shard"], "slot_key": x.k, "__key": x["__key"], "block": block})

    slots = slots.mapInPandas(place, "shard int, slot_key long, __key string, block long").withColumn("slot_key", F.xxhash64("__key", "slot_key", F.lit(seed)))

    parts = light.where("size > 0").withColumn("block", F.explode(F.expr(f"sequence(__from div {block_words}, (__to - 1) div {block_words})")))
    lo = F.greatest(F.col("block") * block_words, F.col("__from"))
    hi = F.least((F.col("block") + 1) * block_words, F.col("__to"))
    parts = parts.select("__key", "block", "source", "doc_id", "__t", "__group", "__row", (lo - F.col("block") * block_words).cast("int").alias("piece"), (lo - F.col("__from")).alias("__at"), (hi - lo).cast("long").alias("n_words"))
    if with_text:
        # the words of a document are cut once; each of its parts is a slice of them. Rows that repeat are groups of their own
        texts = docs.select("doc_id", F.xxhash64("text").alias("__t"), "text")
        if light.groupBy("doc_id", "__t").count().where("count > 1").limit(1).count():
            texts = texts.dropDuplicates(["doc_id", "__t"])
        row = ["__key", "__group", "__row"]
        cut = parts.groupBy("doc_id", "__t", *row).agg(F.collect_list(F.struct("block", "source", "piece", "__at", "n_words")).alias("p"))
        words = F.filter(F.split("text", GAP), lambda w: w != "")
        texts = cut.join(texts, cut["doc_id"].eqNullSafe(texts["doc_id"]) & (cut["__t"] == texts["__t"])).select(cut["doc_id"], *row, "p", words.alias("w"))
        sliced = F.transform("p", lambda p: F.struct(p["block"].alias("block"), p["source"].alias("source"), p["piece"].alias("piece"), p["n_words"].alias("n_words"), F.array_join(F.slice("w", (p["__at"] + 1).cast("int"), p["n_words"].cast("int")), " ").alias("text")))
        parts = texts.select("doc_id", *row, F.explode(sliced).alias("p")).select("doc_id", *row, "p.*")
    # what mapInPandas returns looks tiny to the planner, so it is told not to broadcast it
    return slots.hint("merge").join(parts, ["__key", "block"]), plan


def mixed_counts(docs: DataFrame, block_words: int = 32, shards: int = 64, seed: int = 1) -> DataFrame:
    """A row for each document: doc_id, source, size, source_size, target, taken (its words in the mix, repeats counted)."""
    pieces, plan = mix(docs, block_words, shards, seed, with_text=False)
    taken = pieces.groupBy("__key", "__group", "__row").agg(F.sum("n_words").alias("taken"))
    out = plan.join(taken, ["__key", "__group", "__row"], "left")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
