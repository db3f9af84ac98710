"""Language identification by interpolated Kneser-Ney character models.

A language's model of order 4 is worked out in Spark from the counts of every run of its texts. What a character costs
after its history is a sum: each seen run of 1 to 4 characters adds a term, and so does each seen history, which is
where a model backs off. So a language is one sorted array of hashed runs and histories with a term each, a text's
cross-entropy is a sum of terms looked up in it, and a model of any size can be used piece by piece.
"""

import functools
import math
import unicodedata
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.textkernel import mix
from .common import crc_mod, materialize, release, ship, unused

ORDER = 4
#: Terms of a model that one pass over the texts holds in memory; a larger model takes more passes, with the same result.
TERMS_AT_ONCE = 6_000_000
#: Languages of a model, at most: their names and limits are on the driver. More are an error.
MAX_LANGS = 5000
#: Sums (runs times languages) that a worker keeps, so that a run it has met is looked up once.
MEMO_CELLS = 8_000_000
#: Steepness of the confidence: the one of least log loss on the rows learned from is taken.
HEATS = (0.02, 0.05, 0.1, 0.2, 0.5, 1.0, 2.0)
_BITS = 16  # of a character's code within a run
_SLOT_BITS = 20
_U = np.uint64


@functools.cache
def _letters() -> np.ndarray:
    """By code point: a 16-bit code if it is a letter or a mark, else a space.

    Letters beyond the basic plane share the 6400 codes of its private area."""
    out = np.full(0x110000, 32, np.uint16)
    for i in range(0x110000):
        if not 0xD800 <= i <= 0xDFFF and unicodedata.category(chr(i))[0] in "LM":
            out[i] = i if i < 0x10000 else 0xE000 + i % 6400
    return out


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts and each one's text: lower case, runs of others as one space, three spaces before a text
    and one after it."""
    joined = "\n" + "\n\n".join(texts) + "\n"
    lowered = joined.lower()
    if len(lowered) == len(joined):
        size = np.array([len(t) + 2 for t in texts], np.int64)
    else:
        parts = [t.lower() for t in texts]
        lowered, size = "\n" + "\n\n".join(parts) + "\n", np.array([len(t) + 2 for t in parts], np.int64)
    raw = _letters()[np.frombuffer(lowered.encode("utf-32-le", "replace"), np.uint32)]
    doc = np.repeat(np.arange(len(texts)), size)
    times = np.ones(len(raw), np.int64)
    first = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64) if len(texts) else np.zeros(0, np.int64)
    times[1:] = (raw[1:] != 32) | (raw[:-1] != 32)
    times[first] = ORDER - 1
    return np.repeat(raw, times).astype(np.uint64), np.repeat(doc, times)


def _runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Every run of ORDER characters as one integer, and its text. A text with neither letter nor mark has none."""
    c, doc = _codes(texts)
    n = len(c) - ORDER + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(n, np.uint64)
    for k in range(ORDER):
        out = (out << _U(_BITS)) | c[k : n + k]
    ok = doc[:n] == doc[ORDER - 1 :]
    return out[ok], doc[:n][ok]


def _long_runs(text: str, most: int):
    """What _runs gives for one text, in pieces of about `most` characters. Pieces end before white space where there is any
    in the next half, so that no word is lowered in parts; three characters are handed on."""
    carry, at, letters = np.full(ORDER - 1, 32, np.uint64), 0, _letters()
    while at < len(text):
        end = at + most
        if end < len(text):
            end = next((i for i in range(end, min(end + most // 2, len(text))) if text[i].isspace()), end)
        raw = letters[np.frombuffer(text[at:end].lower().encode("utf-32-le", "replace"), np.uint32)].astype(np.uint64)
        before = np.concatenate([carry[-1:], raw[:-1]])
        c = np.concatenate([carry, raw[(raw != 32) | (before != 32)]])
        at = end
        if at >= len(text) and c[-1] != 32:
            c = np.append(c, np.uint64(32))
        n = len(c) - ORDER + 1
        if n > 0:
            out = np.zeros(n, np.uint64)
            for k in range(ORDER):
                out = (out << _U(_BITS)) | c[k : n + k]
            yield out
        carry = c[-(ORDER - 1) :]


def _batches(texts: list[str], most: int = 1_000_000):
    """(first text, texts, runs, the text of each run, counted from the first) of texts of about `most` characters; a longer
    text comes by itself, again and again, with a piece of its runs each time."""
    a, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield a, i - a, *_runs(texts[a:i])
            a, size = i, 0
        if len(t) > most:
            for g in _long_runs(t, most):
                yield i, 1, g, np.zeros(len(g), np.int64)
            a = i + 1
            continue
        size += len(t)
    if a < len(texts):
        yield a, len(texts) - a, *_runs(texts[a:])


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, run (its four characters as one integer), n: over whole texts of all rows of docs (text, lang)."""

    def count(batches):
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts = batch.column("text").to_pylist()
            for lang in sorted(set(langs)):
                mine = [texts[i] or "" for i in np.flatnonzero(langs == lang)]
                for _, _, g, _ in _batches(mine):
                    g, n = np.unique(g, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(n)], ["lang", "run", "n"])

    return docs.select("text", "lang").mapInArrow(count, "lang string, run long, n long").groupBy("lang", "run").agg(F.sum("n").alias("n"))


def terms(counts: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """(lang, kind, run, term: a row for each seen run of k characters (kind k) and history of k - 1 (kind 10 + k); each
    language's base, which every character adds), from counts (lang, run, n) of four-character runs.

    Interpolated Kneser-Ney: absolute discounts n1 / (n1 + 2 n2) by language and order (0.5 where there is no n1 or n2),
    and below the highest order a run counts as many times as there are characters before it. The lowest order is
    interpolated with an even share among the language's characters and 50 unseen ones."""
    level = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        shorter = F.col("run").bitwiseAND(F.lit((1 << (_BITS * k)) - 1))
        level[k] = materialize(level[k + 1].groupBy("lang", shorter.alias("run")).agg(F.count("*").alias("n")))
    every = None
    for k, x in level.items():
        one = x.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"), F.count("*").alias("kinds"), F.sum("n").alias("all")).withColumn("k", F.lit(k))
        every = one if every is None else every.unionByName(one)
    stats = {(r["lang"], r["k"]): r for r in every.collect()}
    d = {key: min(max(r["n1"] / (r["n1"] + 2 * r["n2"]) if r["n1"] and r["n2"] else 0.5, 0.1), 0.95) for key, r in stats.items()}
    langs = sorted({lang for lang, _ in stats})
    even = {lang: 1.0 / (stats[lang, 1]["kinds"] + 50) for lang in langs}
    base = {lang: math.log(even[lang]) + math.log(d[lang, 1] * stats[lang, 1]["kinds"] / stats[lang, 1]["all"]) for lang in langs}
    spark, out, below = counts.sparkSession, None, None
    for k in range(1, ORDER + 1):
        of = F.broadcast(spark.createDataFrame([(lang, d[lang, k], even[lang]) for lang in langs], "lang string, d double, even double"))
        x = level[k].join(of, "lang").withColumn("h", F.shiftrightunsigned("run", _BITS))
        hist = x.groupBy("lang", "h").agg(F.sum("n").alias("all"), (F.first("d") * F.count("*") / F.sum("n")).alias("gamma"))
        x = x.join(hist, ["lang", "h"])
        if below is None:
            x = x.withColumn("low", F.col("even"))
        else:
            x = x.withColumn("low_run", F.col("run").bitwiseAND(F.lit((1 << (_BITS * (k - 1))) - 1))).join(below, ["lang", "low_run"])
        p = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("all") + F.col("gamma") * F.col("low")
        x = materialize(x.select("lang", "run", p.alias("p"), F.log(p / F.col("low") / F.col("gamma")).alias("term")))
        here = x.select("lang", F.lit(k).alias("kind"), "run", "term")
        if k > 1:
            here = here.unionByName(hist.select("lang", F.lit(10 + k).alias("kind"), F.col("h").alias("run"), F.log("gamma").alias("term")))
        out = here if out is None else out.unionByName(here)
        below = x.select("lang", F.col("run").alias("low_run"), F.col("p").alias("low"))
    return out, base


@dataclass(frozen=True)
class Model:
    """langs, by code point; base: of each language; terms: a written table of lang, kind, run, term; passes: pieces that
    the terms are used in; heat: of the confidence; limits: of rejection, by language."""

    langs: tuple[str, ...]
    base: tuple[float, ...]
    terms: DataFrame | None
    passes: int = 1
    heat: float = 0.2
    limits: tuple[float, ...] = ()


def _hashed(kind, run: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(run ^ (_U(kind) * _U(0x9E3779B97F4A7C15)))


def _piece(model: Model, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each language's sorted hashes and terms, of the k-th piece of the model."""
    some = model.terms if model.passes == 1 else model.terms.where(F.pmod(F.xxhash64("kind", "run", F.lit(5)), F.lit(model.passes)) == k)
    place = F.array_position(F.lit(list(model.langs)), F.col("lang")).cast("int").alias("lang")
    got = some.select(place, "kind", "run", F.col("term").cast("float").alias("term")).toArrow()
    lang, kind, run, term = (got.column(c).to_numpy() for c in ("lang", "kind", "run", "term"))
    h = np.empty(len(run), np.uint64)
    for one in np.unique(kind):
        h[kind == one] = _hashed(int(one), run[kind == one].astype(np.int64).view(np.uint64))
    order = np.lexsort((h, lang))
    cut = np.searchsorted(lang[order], np.arange(1, len(model.langs) + 2))
    return [(h[order[a:b]], term[order[a:b]]) for a, b in zip(cut[:-1], cut[1:])]


class Scorer:
    """Sums of terms by run and language, remembered for runs that were asked for before."""

    def __init__(self, arrays: list[tuple[np.ndarray, np.ndarray]]):
        self.arrays = arrays
        self.keys, self.sums = np.zeros(0, np.uint64), np.zeros((0, len(arrays)), np.float32)
        self.slots = np.zeros(1 << _SLOT_BITS, np.int32)  # by a hash of the run: the place of one run that falls there

    def slot(self, runs: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((runs * _U(0x9E3779B97F4A7C15)) >> _U(64 - _SLOT_BITS)).astype(np.int64)

    def look(self, runs: np.ndarray) -> np.ndarray:
        out = np.zeros((len(runs), len(self.arrays)), np.float32)
        kinds = [(k, runs & _U((1 << (_BITS * k)) - 1) if k < ORDER else runs) for k in range(1, ORDER + 1)]
        kinds += [(10 + k, (runs >> _U(_BITS)) & _U((1 << (_BITS * (k - 1))) - 1)) for k in range(2, ORDER + 1)]
        for kind, part in kinds:
            h = _hashed(kind, part)
            for j, (keys, term) in enumerate(self.arrays):
                if len(keys):
                    i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    out[:, j] += np.where(keys[i] == h, term[i], np.float32(0))
        return out

    def __call__(self, runs: np.ndarray) -> np.ndarray:
        """Places of runs in self.sums."""
        if not len(self.keys):
            self.learn(np.unique(runs))
        i = self.slots[self.slot(runs)]
        off = np.flatnonzero(self.keys[i] != runs)
        if len(off):
            rest = runs[off]
            at = np.minimum(np.searchsorted(self.keys, rest), len(self.keys) - 1)
            miss = self.keys[at] != rest
            if miss.any():
                new = np.unique(rest[miss])
                if (len(self.keys) + len(new)) * max(1, len(self.arrays)) > MEMO_CELLS:
                    new, self.keys, self.sums = np.unique(runs), self.keys[:0], self.sums[:0]
                self.learn(new)
                return np.searchsorted(self.keys, runs)
            i[off] = at
        return i

    def learn(self, new: np.ndarray) -> None:
        keys = np.concatenate([self.keys, new])
        order = np.argsort(keys, kind="stable")
        self.keys, self.sums = keys[order], np.concatenate([self.sums, self.look(new)])[order]
        self.slots[self.slot(self.keys)] = np.arange(len(self.keys), dtype=np.int32)


_scorers: dict[str, Scorer] = {}


def text_sums(scorer: Scorer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(sum of terms by text and language, number of runs by text)."""
    langs = len(scorer.arrays)
    out, size = np.zeros((len(texts), langs)), np.zeros(len(texts), np.int64)
    for a, n, g, doc in _batches(texts, max(10_000, min(1_000_000, MEMO_CELLS // max(1, langs)))):
        if not len(g):
            continue
        size[a : a + n] += np.bincount(doc, minlength=n)
        at = scorer(g)
        for j in range(langs):
            out[a : a + n, j] += np.bincount(doc, weights=scorer.sums[:, j][at], minlength=n)
    return out, size


def entropies(docs: DataFrame, model: Model, ce: str = "ce", runs: str = "runs") -> DataFrame:
    """docs without text, with ce (nats a character by language of the model, in its order) and runs (how many characters
    were scored) added under these names, which docs must not have. One pass over the texts for a piece of the model."""
    ship(docs.sparkSession)
    rest = [c for c in docs.columns if c != "text"]
    if not model.langs:
        return docs.select(*rest, F.array().cast("array<double>").alias(ce), F.lit(0).cast("long").alias(runs))
    x, before = docs, None
    for k in range(model.passes):
        last = k == model.passes - 1
        shared, name = docs.sparkSession.sparkContext.broadcast(_piece(model, k)), uuid.uuid4().hex
        keep = rest if last else [*rest, "text"]

        def run(batches, shared=shared, name=name, keep=keep, first=k == 0):
            scorer = _scorers.get(name)
            if scorer is None:
                _scorers.clear()
                scorer = _scorers[name] = Scorer(shared.value)
            for batch in batches:
                sums, size = text_sums(scorer, [t or "" for t in batch.column("text").to_pylist()])
                if not first:
                    sums += np.array(batch.column(ce).to_pylist(), float).reshape(sums.shape)
                flat = pa.array(sums.ravel())
                offsets = pa.array(np.arange(0, sums.size + 1, max(1, sums.shape[1]), dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.ListArray.from_arrays(offsets, flat), pa.array(size)], [*keep, ce, runs])

        fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
        scored = x.select(*rest, "text", *([] if k == 0 else [ce])).mapInArrow(run, ", ".join([*fields, f"`{ce}` array<double>", f"`{runs}` long"]))
        if not last:
            scored = materialize(scored)
            if before is not None:
                release(before)
            before = scored
        x = scored
    base = F.lit(list(model.base))
    per = F.transform(ce, lambda s, j: -(s / F.greatest(F.col(runs), F.lit(1)) + F.get(base, j)))
    return x.withColumn(ce, per)


def _confidence(ce, runs, heat: float):
    """Of the best language: as if at most 200 characters were independent evidence, tempered."""
    low = F.array_min(ce)
    weight = F.least(runs, F.lit(200)) * heat
    return 1 / F.aggregate(ce, F.lit(0.0), lambda a, x: a + F.exp(-(x - low) * weight))


def fit(docs: DataFrame, terms_at_once: int = TERMS_AT_ONCE) -> Model:
    """A model of every row's whole text by its lang (rows of null text or lang teach nothing). Nothing is cut from it.

    Confidence and limits of rejection come from all of them too, by one more pass over their texts."""
    ship(docs.sparkSession)
    known = docs.where("lang is not null and text is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    counts = materialize(gram_counts(known))
    if counts.select("lang").distinct().limit(MAX_LANGS + 1).count() > MAX_LANGS:
        raise ValueError(f"over {MAX_LANGS} languages")
    made, base = terms(counts)
    langs = tuple(sorted(base))
    if not langs:
        return Model((), (), None)
    made = materialize(made)
    model = Model(langs, tuple(base[x] for x in langs), made, max(1, -(-made.count() // terms_at_once)))

    seen = materialize(entropies(known.select("text", "lang"), model).where("runs > 0").withColumn("at", F.array_position(F.lit(list(langs)), F.col("lang")).cast("int")))
    seen = seen.withColumn("own", F.get("ce", F.col("at") - 1))

    def loss(heat):
        weight = F.least("runs", F.lit(200)) * heat
        p = F.exp(-(F.col("own") - F.array_min("ce")) * weight) * _confidence(F.col("ce"), F.col("runs"), heat)
        return F.sum(-F.log(F.greatest(p, F.lit(1e-9))))

    losses = seen.agg(*(loss(h).alias(f"l{i}") for i, h in enumerate(HEATS))).first()
    heat = HEATS[min(range(len(HEATS)), key=lambda i: losses[i] if losses[i] is not None else 0.0)]
    right = seen.where("own = array_min(ce)").groupBy("lang").agg(F.avg("own").alias("m"), F.stddev("own").alias("s")).collect()
    spread = {r["lang"]: r["m"] + 4 * (r["s"] or 0.5) for r in right}
    return Model(model.langs, model.base, made, model.passes, heat, tuple(spread.get(x, math.inf) for x in langs))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs without text, with lang_pred, score (confidence, 0 to 1), cross_entropy and accepted (docs: doc_id, text and
    what else passes through; columns of those names are replaced).

    A null text, or one without letters: lang_pred `und`, score 0, cross_entropy null, accepted false; any other text gets
    a language of the model. accepted is false too where cross_entropy is over the language's limit (four standard
    deviations above its texts' mean). Ties go to the first language by code point. Repeated rows are alike; an empty
    table gives an empty one."""
    letters, ce, runs = unused(docs.columns, "letters", "ce", "runs")
    x = entropies(docs.withColumn(letters, F.coalesce(F.regexp_like("text", F.lit(r"\p{L}")), F.lit(False))), model, ce, runs)
    ok = F.col(letters) & (F.col(runs) > 0)
    low = F.array_min(ce)
    best = F.array_position(ce, low).cast("int") - 1
    some = F.lit(list(model.langs)) if model.langs else F.array().cast("array<string>")
    limit = F.get(F.lit(list(model.limits)), best) if model.limits else F.lit(0.0)
    x = x.withColumns(
        {
            "lang_pred": F.coalesce(F.when(ok, F.get(some, best)), F.lit("und")),
            "score": F.coalesce(F.when(ok, _confidence(F.col(ce), F.col(runs), model.heat)), F.lit(0.0)),
            "cross_entropy": F.when(ok, low),
            "accepted": F.coalesce(ok & (low <= limit), F.lit(False)),
        }
    )
    return x.drop(letters, ce, runs)


def language_id(docs: DataFrame, fold: int = 2, folds: int = 4) -> DataFrame:
    """Identifies every document by a model of those outside the held-out fold: crc32(doc_id as text) mod folds = fold."""
    held = F.coalesce(crc_mod(F.col("doc_id"), folds) == fold, F.lit(False))
    return identify(docs.select("doc_id", "text"), fit(docs.where(~held))).withColumn("held_out", held)
