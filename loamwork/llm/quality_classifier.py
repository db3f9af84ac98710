"""Quality by importance resampling.

Two generative models over hashed one- and two-word features, one of target text (labelled good) and one of all
text, give each document a log importance weight; Gumbel noise added to it and the k largest sums kept draw k documents
without replacement in proportion to their weights.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.textkernel import Words, chunks
from .common import materialize, ship
from .toxicity import bounded_labels

BUCKETS = 10_000
#: Steps of a unit of log weight that the selection tells apart.
STEPS = 1e6


def _features(data, offs):
    """(bucket, document) of every one- and two-word run."""
    w = Words(data, offs)
    h2, d2, _ = w.grams(2)
    h, doc = np.concatenate([w.hash, h2]), np.concatenate([w.doc(), d2])
    return (h % np.uint64(BUCKETS)).astype(np.int64), doc


def feature_counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts by bucket of target text (target = 1) and of all text, over docs (text, target): every row, whole texts."""

    def run(batches):
        total, wanted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            good = batch.column("target").fill_null(0).to_numpy(zero_copy_only=False) == 1
            for a, b, data, offs in chunks(batch.column("text")):
                f, doc = _features(data, offs)
                total += np.bincount(f, minlength=BUCKETS)
                wanted += np.bincount(f[good[a:b][doc]], minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(wanted), pa.array(total)], ["f", "wanted", "every"])

    got = docs.select("text", "target").mapInArrow(run, "f long, wanted long, every long").groupBy("f").agg(F.sum("wanted").alias("wanted"), F.sum("every").alias("every")).collect()
    wanted, total = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in got:
        wanted[r["f"]], total[r["f"]] = r["wanted"], r["every"]
    return wanted, total


def kth_largest(values: DataFrame, k: int) -> int | None:
    """The k-th largest long in the only column of values (nulls aside), by radix: 4 counts of at most 65,536 groups."""
    name = values.columns[0]
    flip = F.col(name).bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    x, prefix = values.where(F.col(name).isNotNull()).select(flip.alias("v")), 0
    for level in range(4):
        digit = F.shiftrightunsigned("v", 48 - 16 * level).bitwiseAND(F.lit(0xFFFF))
        here = x if not level else x.where(F.shiftrightunsigned("v", 64 - 16 * level) == prefix)
        counts = here.groupBy(digit.alias("d")).count().collect()
        for d, n in sorted(((r["d"], r["count"]) for r in counts), reverse=True):
            if k <= n:
                prefix = (prefix << 16) | d
                break
            k -= n
        else:
            return None
    out = prefix ^ (1 << 63)
    return out - (1 << 64) if out >= 1 << 63 else out


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 1) -> DataFrame:
    """doc_id, n_features, log_weight, gumbel_key, kept for every row of docs (doc_id, text).

    Target text: documents labelled quality 1. kept marks `share` of all rows (default: the labelled share of quality 1)
    with the largest log_weight plus noise; rows that tie at the border are kept together. The noise hangs on seed,
    doc_id and text alone, so reruns agree and repeated rows fare alike. Null and empty texts have no features and weight
    0 (log). Without labels all weights are 0 and the draw is even. An empty table gives an empty one."""
    ship(docs.sparkSession)
    known = bounded_labels(labels, label="quality")
    rate = known.agg(F.avg("quality")).first()[0]
    wanted, total = feature_counts(docs.join(F.broadcast(known), "doc_id", "left").select("text", F.col("quality").alias("target")))
    if wanted.sum():
        ratio = np.log((wanted + 1) / (wanted.sum() + BUCKETS)) - np.log((total + 1) / (total.sum() + BUCKETS))
    else:
        ratio = np.zeros(BUCKETS)

    def run(batches):
        for batch in batches:
            n, s = [], []
            for a, b, data, offs in chunks(batch.column("text")):
                f, doc = _features(data, offs)
                n.append(np.bincount(doc, minlength=b - a))
                s.append(np.bincount(doc, weights=ratio[f], minlength=b - a))
            cat = lambda x, t: pa.array(np.concatenate(x) if x else np.zeros(0), t)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), cat(n, pa.int64()), cat(s, pa.float64()), batch.column("u")], ["doc_id", "n_features", "log_weight", "u"])

    u = (F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    scored = docs.select("doc_id", "text", u.alias("u")).mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_features long, log_weight double, u double")
    scored = materialize(scored.select("doc_id", "n_features", "log_weight", (F.col("log_weight") - F.log(-F.log("u"))).alias("gumbel_key")))
    k = math.ceil((rate if share is None and rate is not None else 1.0 if share is None else share) * scored.count())
    key = F.round(F.col("gumbel_key") * STEPS).cast("long")
    least = kth_largest(scored.select(key.alias("v")), k) if k else None
    return scored.withColumn("kept", key >= least if least is not None else F.lit(False))
