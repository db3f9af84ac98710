"""Toxicity by maximum-scoring segments.

Words get log-odds of toxic against clean labelled text under a Dirichlet prior in proportion to all words' counts.
A linear scan finds every maximal scoring segment of a text; a segment's chance in clean text follows an extreme-value
law (Karlin and Altschul) whose parameters come from the clean rows, and a text's segments are summed up as one
chance, which a logistic curve, fitted on the labelled rows, turns into a probability.
"""

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.textkernel import Words, chunks
from .common import crc_mod, materialize, rows_at_most, ship

#: Labelled rows that a model is fitted on, at most (the lowest hashes of their doc_id).
MAX_LABELS = 400_000
#: Words that a model may have (16 bytes each, broadcast); more are an error. Only words that the labelled rows prove
#: something of are kept, and of those rows there are MAX_LABELS at most.
MAX_WORDS = 8_000_000
#: Score of a word that nothing is proved of, and the least score of one that is proved clean.
BASE, FLOOR = -0.5, -4.0


@dataclass(frozen=True)
class Model:
    """words: sorted hashes; gain: their scores, above 0 or below base; base: any other word's score; decay and scale: the
    extreme-value law's lambda and K; curve: intercept and slope of the logistic curve over a text's evidence."""

    words: np.ndarray
    gain: np.ndarray
    base: float
    decay: float = 1.0
    scale: float = 0.1
    curve: tuple[float, float] = (-6.0, 2.0)


def bounded_labels(labels: DataFrame, doc_col: str = "doc_id", label: str = "toxic", rows: int = MAX_LABELS) -> DataFrame:
    """doc_id and label (0 or 1, the highest of a document's) of about `rows` labelled documents at most, chosen by a hash
    of doc_id where there are more; nulls are no labels."""
    one = labels.where(F.col(label).isin(0, 1) & F.col(doc_col).isNotNull()).groupBy(doc_col).agg(F.max(label).cast("int").alias(label))
    n = one.count()
    return one if n <= rows else one.where(F.pmod(F.xxhash64(doc_col), F.lit(1_000_000)) < int(1_000_000 * rows / n))


def segments(at: np.ndarray, before: np.ndarray, through: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, past the last, score), by Ruzzo and Tompa's linear scan.

    at: the places of words that score above 0; before and through: the sums of all scores up to and with each of them."""
    found: list[list] = []  # first, end, sum before, sum through
    for new in zip(at.tolist(), (at + 1).tolist(), before.tolist(), through.tolist()):
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j -= 1
            if j < 0 or found[j][3] >= new[3]:
                found.append(new)
                break
            new = (found[j][0], new[1], found[j][2], new[3])
            del found[j:]
    return [(a, b, end - start) for a, b, start, end in found]


def _scan(*models: Model):
    """Of Arrow texts: for each row its words and, for each model, its segments; only words above 0 are visited singly."""

    def of(texts: pa.Array):
        for a, b, data, offs in chunks(texts):
            w = Words(data, offs)
            seen = []
            for m in models:
                own = np.full(len(w.hash), m.base)
                if len(m.words):
                    k = np.minimum(np.searchsorted(m.words, w.hash), len(m.words) - 1)
                    own = np.where(m.words[k] == w.hash, m.gain[k], own)
                sums, at = np.concatenate([[0.0], np.cumsum(own)]), np.flatnonzero(own > 0)
                seen.append((at, sums[at], sums[at + 1], np.searchsorted(at, w.ptr)))
            for i in range(b - a):
                yield int(w.ptr[i + 1] - w.ptr[i]), [segments(at[cut[i] : cut[i + 1]] - w.ptr[i], before[cut[i] : cut[i + 1]], through[cut[i] : cut[i + 1]]) if cut[i + 1] > cut[i] else [] for at, before, through, cut in seen]

    return of


def _evidence(n: int, found: list[tuple[int, int, float]], model: Model) -> float:
    """Minus the log10 of the chance that clean text of n words has segments as good: Fisher's sum over significant ones."""
    out = 0.0
    for _, _, s in found:
        e = model.scale * max(n, 1) * math.exp(-min(model.decay * s, 600.0))  # expected number of segments as good
        p = -math.expm1(-e)
        if p < 0.5:
            out -= math.log10(max(p, 1e-300))
    return min(out, 300.0)


#: Least scores of a word that are tried, the best by held-in log loss kept.
GAINS = (1.0, 1.5, 2.0, 2.5, 3.0)


def word_counts(docs: DataFrame) -> DataFrame:
    """word (hash) and its times in c0, t0, c1, t1 (clean and toxic texts of either half) and every text.

    docs: text, mark (0 to 3 for these four, null without a label)."""

    def count(batches):
        for batch in batches:
            label = batch.column("mark").fill_null(4).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b, data, offs in chunks(batch.column("text")):
                w = Words(data, offs)
                mark = np.repeat(label[a:b], np.diff(w.ptr))
                h, back = np.unique(w.hash, return_inverse=True)
                n = np.bincount(back * 5 + mark, minlength=5 * len(h)).reshape(-1, 5)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), *(pa.array(n[:, k]) for k in range(4)), pa.array(n.sum(axis=1))], ["word", "c0", "t0", "c1", "t1", "every"])

    out = docs.select("mark", "text").mapInArrow(count, "word long, c0 long, t0 long, c1 long, t1 long, every long")
    return out.groupBy("word").agg(*(F.sum(c).alias(c) for c in ("c0", "t0", "c1", "t1", "every")))


def _gains(counts: DataFrame, total: dict, halves: tuple[int, ...], least: float, prior_words: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and scores of words from these halves' counts: the log-odds of toxic against clean text, one standard
    error nearer to 0, so that rare words prove nothing. Kept are those of `least` or more and those below BASE."""
    toxic, clean = (sum((F.col(f"{k}{h}") for h in halves), F.lit(0)) for k in "tc")
    n_toxic, n_clean = (sum(total[f"{k}{h}"] for h in halves) for k in "tc")
    if not n_toxic or not n_clean:
        return np.zeros(0, np.uint64), np.zeros(0)
    weight = float(prior_words or n_toxic)
    prior = F.col("every") * (weight / total["every"])
    odds = lambda c, n: F.log((c + prior) / (n + weight - c - prior))
    delta, error = odds(toxic, n_toxic) - odds(clean, n_clean), F.sqrt(1 / (toxic + prior) + 1 / (clean + prior))
    seen = counts.where(toxic + clean > 0).select("word", (delta - error).alias("up"), F.greatest(delta + error, F.lit(FLOOR)).alias("down"))
    best = seen.select("word", F.when(F.col("up") >= least, F.col("up")).when(F.col("down") < BASE, F.col("down")).alias("gain")).where("gain is not null")
    if not rows_at_most(best, MAX_WORDS):
        raise ValueError(f"over {MAX_WORDS} words: fit on fewer labelled rows, or raise the bound")
    best = best.toArrow()
    h = best.column("word").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], best.column("gain").to_numpy().astype(float)[order]


def _from(words: np.ndarray, gain: np.ndarray, least: float) -> Model:
    """A model of the words that score `least` or more, and of all clean ones."""
    keep = (gain >= least) | (gain < 0)
    return Model(words[keep], gain[keep], BASE)


def fit(docs: DataFrame, labels: DataFrame, prior_words: float | None = None, gains: tuple[float, ...] = GAINS) -> Model:
    """A model from documents (doc_id, text) and labels (doc_id, toxic). The prior counts every text, labelled or not, and
    weighs as much as prior_words words (default: the words of toxic rows).

    The labelled rows fall into two halves by a hash of doc_id: words learned on one calibrate the law, the curve and
    the least score on the other; the words themselves are then learned on both. Without labelled rows of both kinds
    the model finds nothing and scores every text alike."""
    ship(docs.sparkSession)
    half = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2))
    known = F.broadcast(bounded_labels(labels).withColumn("mark", (half * 2 + F.col("toxic")).cast("int")))
    counts = materialize(word_counts(docs.join(known, "doc_id", "left").select("text", "mark")))
    total = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("c0", "t0", "c1", "t1", "every"))).first().asDict()
    words, gain = _gains(counts, total, (0, 1), min(gains), prior_words)
    if not (gain > 0).any():
        return Model(words, gain, BASE)
    learned = _gains(counts, total, (0,), min(gains), prior_words)
    tried = [_from(*learned, g) for g in gains]
    held = docs.join(known.where("mark >= 2"), "doc_id").select("text", F.col("toxic"))
    fitted, losses = _calibrate(held, tried)
    k = int(np.argmin(losses))
    final = _from(words, gain, gains[k])
    return Model(final.words, final.gain, BASE, fitted[k].decay, fitted[k].scale, fitted[k].curve)


def _calibrate(labelled: DataFrame, models: list[Model]) -> tuple[list[Model], list[float]]:
    """Each model with the law of the clean rows' best segments and the curve over all rows' evidence, and its log loss.

    Two passes over labelled (text, toxic) for all models; what comes to the driver is histograms."""

    def best(batches):
        of = _scan(*models)
        for batch in batches:
            rows = [(k, n, max((s for _, _, s in found), default=0.0)) for n, all_ in of(batch.column("text")) for k, found in enumerate(all_)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([float(r[2]) for r in rows], pa.float64())], ["k", "n", "s"])

    clean = labelled.where("toxic = 0").select("text").mapInArrow(best, "k int, n long, s double")
    law = {r["k"]: r for r in clean.groupBy("k").agg(F.avg("n").alias("n"), F.avg(F.when(F.col("s") > 0, F.col("s"))).alias("s"), F.avg((F.col("s") > 0).cast("int")).alias("p")).collect()}
    fitted = []
    for k, m in enumerate(models):
        # best segments of clean rows: an exponential tail of rate 1 / mean, and K from how often any is seen
        r = law.get(k)
        seen, mean, n = (r["p"], r["s"] or 0.0, r["n"]) if r else (0.0, 0.0, 1.0)
        fitted.append(Model(m.words, m.gain, m.base, 1.0 / max(mean, 0.5), max(-math.log1p(-min(seen, 0.99)), 1e-4) / max(n, 1.0)))

    def binned(batches):
        of = _scan(*fitted)
        for batch in batches:
            label = batch.column("toxic").to_pylist()
            rows = [(k, label[i], round(_evidence(n, found, fitted[k]) * 10)) for i, (n, all_) in enumerate(of(batch.column("text"))) for k, found in enumerate(all_)]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int32()) for j in range(3)], ["k", "toxic", "bin"])

    seen = labelled.select("text", "toxic").mapInArrow(binned, "k int, toxic int, bin int").groupBy("k", "toxic", "bin").count().toPandas()
    out, losses = [], []
    for k, m in enumerate(fitted):
        own = seen[seen["k"] == k]
        x, y, n = np.log1p(own["bin"].to_numpy() / 10.0), own["toxic"].to_numpy().astype(float), own["count"].to_numpy().astype(float)
        b, loss = _logistic(x, y, n)
        out.append(Model(m.words, m.gain, m.base, m.decay, m.scale, (float(b[0]), float(max(b[1], 0.0)))))
        losses.append(loss)
    return out, losses


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Intercept and slope of y on x with weights n, by Newton steps with a weak ridge, and the log loss."""
    b = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(b[0] + b[1] * x, -30, 30)))
        g = np.array([np.sum(n * (y - p)), np.sum(n * (y - p) * x)]) - 0.01 * b
        v = n * p * (1 - p)
        hess = np.array([[v.sum(), (v * x).sum()], [(v * x).sum(), (v * x * x).sum()]]) + 0.01 * np.eye(2)
        b = b + np.clip(np.linalg.solve(hess, g), -2, 2)
    p = np.clip(1 / (1 + np.exp(-np.clip(b[0] + b[1] * x, -30, 30))), 1e-6, 1 - 1e-6)
    return b, float(-np.sum(n * (y * np.log(p) + (1 - y) * np.log(1 - p))))


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from the threshold on), segments (first word, end word, score of each toxic
    passage) for every row of docs (doc_id, text). Null and empty texts have no segment and the lowest score. Rows that
    repeat are scored alike; an empty table gives an empty one; other columns are left out."""

    def run(batches):
        of = _scan(model)
        for batch in batches:
            scores, spans = [], []
            for n, (found,) in of(batch.column("text")):
                e = round(_evidence(n, found, model) * 10) / 10.0
                scores.append(1 / (1 + math.exp(-max(-700.0, min(700.0, model.curve[0] + model.curve[1] * math.log1p(e))))))
                spans.append([{"first": a, "end": b, "score": float(s)} for a, b, s in found])
            kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array([int(x >= threshold) for x in scores], pa.int32()), pa.array(spans, kind)], ["doc_id", "score", "predicted", "segments"])

    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double, predicted int, segments array<struct<first: long, end: long, score: double>>")


def toxicity(docs: DataFrame, labels: DataFrame, fold: int = 1, folds: int = 3) -> DataFrame:
    """Scores every document by a model of labels outside the held-out fold: crc32(doc_id as text) mod folds = fold."""
    model = fit(docs, labels.where(crc_mod(F.col("doc_id"), folds) != fold))
    return score(docs, model).withColumn("held_out", F.coalesce(crc_mod(F.col("doc_id"), folds) == fold, F.lit(False)))
