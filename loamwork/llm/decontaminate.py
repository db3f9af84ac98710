"""Benchmark decontamination by CGK embeddings.

Words are the symbols. A random walk (Chakraborty, Goldenberg, Koucky) embeds an item, and every item-sized window of a
text, so that few edits become few differing positions; sampled positions, in as many tables as a target recall takes,
key a hash index of the items; what meets in a table is verified by the exact edit distance (Myers' bit vectors).

A window is embedded only where it can match at all: with at most k edits, one of the k + 1 pieces of an item of W words
between its edits has ceil((W - k) / (k + 1)) words or more, so such a run of words must occur in the text as it is.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..functions.textkernel import Words, chunks, mix
from .common import arrow_field, materialize, ship

_U = np.uint64
#: Items, and words of items, that one pass over the texts looks for, at most; more take more passes.
ITEMS_AT_ONCE, WORDS_AT_ONCE = 20_000, 2_000_000
#: Tables, at most: if they don't reach the recall, it is an error.
MAX_TABLES = 400
#: Edited copies of items of each class of lengths that the recall is measured on, and tables that are tried first.
TRIALS, TRIAL_TABLES = 300, 192


def edit_search(item: list[int], text: list[int]) -> tuple[int, int]:
    """(least edit distance of item to any run of text, the end of the first such run), by Myers' bit vectors."""
    m = len(item)
    peq: dict[int, int] = {}
    for i, w in enumerate(item):
        peq[w] = peq.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, now, best, end = full, 0, m, m, 0
    for j, w in enumerate(text):
        eq = peq.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & full, pv & xh
        if ph & top:
            now += 1
        elif mh & top:
            now -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv, mv = mh | ~(xv | ph) & full, ph & xv
        if now < best:
            best, end = now, j + 1
    return best, end


def embed(rows: np.ndarray, length: int, steps: int, walk: int) -> np.ndarray:
    """CGK embedding of each row (its first `length` symbols) in `steps` symbols; 0 beyond a row's end.

    At each step the symbol under the pointer is written, and a random bit of (walk, step, symbol) moves the pointer."""
    out, at, n = np.zeros((len(rows), steps), np.uint64), np.zeros(len(rows), np.int64), np.arange(len(rows))
    with np.errstate(over="ignore"):
        for j in range(steps):
            inside = at < length
            s = np.where(inside, rows[n, np.minimum(at, length - 1)], _U(0))
            out[:, j] = s
            bit = mix(s ^ (_U(walk + 1) * _U(0x9E3779B97F4A7C15) + _U(j + 1) * _U(0xC2B2AE3D27D4EB4F))) & _U(1)
            at += bit.astype(np.int64)
    return out


class Index:
    """Items, their runs for the window filter, and their LSH tables by length."""

    def __init__(self, items: list[tuple[int, np.ndarray]], max_edit: float, recall: float, bits: int = 2, walks: int = 8, seed: int = 1):
        self.items, self.max_edit, self.bits, self.walks = items, max_edit, bits, walks
        self.k = [int(max_edit * len(w)) for _, w in items]
        self.by_run: dict[int, tuple] = {}
        runs: dict[int, list] = {}
        for i, (_, w) in enumerate(items):
            q = -(-(len(w) - self.k[i]) // (self.k[i] + 1))
            h, _, at = _grams(w, q)
            runs.setdefault(q, []).append((h, np.full(len(h), i), at))
        for q, found in runs.items():
            h, i, o = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(h, kind="stable")
            self.by_run[q] = (h[order], i[order], o[order])
        rng = np.random.default_rng(seed)
        self.lengths: dict[int, tuple] = {}
        steps = {n: max(bits, n + n // 2) for n in {len(w) for _, w in items}}
        picks = {n: [(t % walks, np.sort(rng.choice(steps[n], bits, replace=False))) for t in range(MAX_TABLES)] for n in sorted(steps)}
        for n in picks:  # for trials
            self.lengths[n] = (steps[n], [], *self._table(n, steps[n], []))
        #: Tables of each class of lengths: those of as many binary digits.
        self.tables: dict[int, int] = {}
        for size in sorted({n.bit_length() for n in picks}):
            own = [n for n in picks if n.bit_length() == size]
            for tried in sorted({min(t, MAX_TABLES) for t in (TRIAL_TABLES, MAX_TABLES)}):
                for n in own:
                    self.lengths[n] = (steps[n], picks[n][:tried], *self._table(n, steps[n], picks[n][:tried]))
                need = self._least_tables(own, tried, recall, rng)
                if need <= MAX_TABLES:
                    break
            else:
                raise ValueError(f"{MAX_TABLES} tables find fewer than {recall} of the edited items of {min(own)} to {max(own)} words")
            self.tables[size] = need
            for n in own:
                self.lengths[n] = (steps[n], picks[n][:need], *self._table(n, steps[n], picks[n][:need]))

    def _table(self, length: int, steps: int, picks: list) -> tuple[np.ndarray, np.ndarray]:
        """The keys of all items of this length, sorted, and each one's item."""
        mine = [i for i, (_, w) in enumerate(self.items) if len(w) == length]
        keys = self._keys(np.array([self.items[i][1] for i in mine], np.uint64), length, steps, picks)
        flat, who = keys.ravel(), np.repeat(mine, keys.shape[1])
        order = np.argsort(flat, kind="stable")
        return flat[order], who[order]

    def _least_tables(self, lengths: list[int], tried: int, recall: float, rng) -> int:
        """Tables by which the search finds `recall` of edited items of these lengths, MAX_TABLES + 1 if that many don't.

        TRIALS items, each with as many random edits as are allowed (a half of them replacements) and in the midst of other
        words, are searched with the `tried` tables that the index has now. A trial of which a share p of the tables finds the
        item is missed by n tables with a chance of (1 - p)^n; that is convex in p, so what is measured is no less than the
        truth. The mean of all trials, and twice its standard error, must stay within 1 - recall."""
        new = lambda n: rng.integers(1, 1 << 62, n)
        mine, texts, chosen = [i for i, (_, w) in enumerate(self.items) if len(w) in lengths], [], []
        for _ in range(TRIALS):
            i = mine[int(rng.integers(len(mine)))]
            w = self.items[i][1]
            x = w.tolist()
            for _ in range(self.k[i]):
                p, kind = int(rng.integers(len(x))), rng.random()
                x[p : p + (kind < 0.75)] = new(1).tolist() if kind < 0.5 or kind >= 0.75 else []
            texts.append(np.concatenate([new(2 * len(w)).astype(np.uint64), np.array(x, np.uint64), new(2 * len(w)).astype(np.uint64)]))
            chosen.append(i)
        words = Words.__new__(Words)
        words.hash, words.ptr = np.concatenate(texts), np.cumsum([0, *map(len, texts)])
        met = self._meet(words)
        missed = np.ones(TRIALS)
        for d, i in enumerate(chosen):
            at = met.get((d, i), [])
            right = {s: self._verify(words, d, i, [s]) is not None for s in {s for s, _ in at}}
            missed[d] -= len({t for s, t in at if right[s]}) / tried
        if not missed.any():
            return 1

        def enough(n: int) -> bool:
            lost = missed**n
            return lost.mean() + 2 * lost.std() / TRIALS**0.5 <= 1 - recall

        return next((n for n in range(1, MAX_TABLES + 1) if enough(n)), MAX_TABLES + 1)

    def _keys(self, rows: np.ndarray, length: int, steps: int, picks: list) -> np.ndarray:
        out = np.zeros((len(rows), len(picks)), np.uint64)
        with np.errstate(over="ignore"):
            for walk in range(self.walks):
                e = embed(rows, length, steps, walk)
                for t, (w, at) in enumerate(picks):
                    if w == walk:
                        h = np.full(len(rows), t + 1, np.uint64)
                        for j in at:
                            h = mix(h * _U(0xD6E8FEB86659FD93) + e[:, j])
                        out[:, t] = h
        return out

    def _meet(self, words: Words) -> dict[tuple[int, int], list[tuple[int, int]]]:
        """By (document of the chunk, item): starts of windows that share a table's key with it, and the table."""
        doc, sizes = words.doc(), np.array([len(w) for _, w in self.items])
        starts: dict[int, list] = {}
        for q, (keys, item, offset) in self.by_run.items():
            h, _, at = words.grams(q)
            lo = np.searchsorted(keys, h)
            n = np.where((lo < len(keys)) & (keys[np.minimum(lo, len(keys) - 1)] == h), np.searchsorted(keys, h, "right") - lo, 0)
            hit = np.flatnonzero(n)
            if not len(hit):
                continue
            rep = np.repeat(hit, n[hit])
            which = np.repeat(lo[hit], n[hit]) + np.arange(len(rep)) - np.repeat(np.cumsum(n[hit]) - n[hit], n[hit])
            first, size = at[rep] - offset[which], sizes[item[which]]
            d = doc[at[rep]]
            for length in np.unique(size):
                m = size == length
                starts.setdefault(int(length), []).append(np.stack([d[m], first[m]]))
        found: dict[tuple[int, int], list] = {}
        for length, parts in starts.items():
            windows = np.unique(np.concatenate(parts, axis=1), axis=1)
            steps, picks, keys, who = self.lengths[length]
            for a in range(0, windows.shape[1], max(1, 400_000 // length)):
                d, s = windows[:, a : a + max(1, 400_000 // length)]
                grid = s[:, None] + np.arange(length)
                inside = (grid >= words.ptr[d][:, None]) & (grid < words.ptr[d + 1][:, None])
                rows = np.where(inside, words.hash[np.clip(grid, 0, max(0, len(words.hash) - 1))], _U(1) << _U(63))
                k = self._keys(rows, length, steps, picks)
                lo = np.searchsorted(keys, k)
                for r, t in zip(*np.nonzero((lo < len(keys)) & (keys[np.minimum(lo, len(keys) - 1)] == k))):
                    i = lo[r, t]
                    while i < len(keys) and keys[i] == k[r, t]:
                        found.setdefault((int(d[r]), int(who[i])), []).append((int(s[r]), int(t)))
                        i += 1
        return found

    def _verify(self, words: Words, d: int, i: int, at: list[int]) -> tuple[int, int] | None:
        """(distance, end word) of the best match of item i near these starts, if it is within the item's edits."""
        k, w = self.k[i], self.items[i][1]
        best = None
        spans: list[list[int]] = []
        for s in sorted(set(at)):
            lo, hi = max(int(words.ptr[d]), s - 2 * k), min(int(words.ptr[d + 1]), s + len(w) + 2 * k)
            if spans and lo <= spans[-1][1]:
                spans[-1][1] = max(hi, spans[-1][1])
            else:
                spans.append([lo, hi])
        for lo, hi in spans:
            dist, end = edit_search(w.tolist(), words.hash[lo:hi].tolist())
            if dist <= k and (best is None or dist < best[0]):
                best = (dist, lo + end - int(words.ptr[d]))
        return best

    def search(self, words: Words):
        """(document of the chunk, item, distance, end word) of each item that a document has within its edits."""
        for (d, i), at in sorted(self._meet(words).items()):
            best = self._verify(words, d, i, [s for s, _ in at])
            if best:
                yield d, i, *best


def _grams(w: np.ndarray, q: int):
    x = Words.__new__(Words)
    x.hash, x.ptr = w, np.array([0, len(w)])
    return x.grams(q)


#: Bytes that part words here: all of ASCII but letters and digits.
_PARTS = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def _words(data: np.ndarray, offs: np.ndarray) -> Words:
    """Words of UTF-8 bytes: parted at ASCII other than letters and digits and at the signs of Latin-1, General
    Punctuation, CJK punctuation and full-width ASCII; kana and Han characters are a word each."""
    data, cuts = np.where(_PARTS[data], np.uint8(32), data), None
    lead = np.flatnonzero((data == 0xC2) | (data >= 0xE2) & (data < 0xF0))
    if len(lead):
        one, two = data[lead], data[np.minimum(lead + 1, len(data) - 1)]
        three = data[np.minimum(lead + 2, len(data) - 1)]
        sign = (one == 0xE2) & ((two == 0x80) | (two == 0x81)) | (one == 0xE3) & (two == 0x80)
        sign |= (one == 0xEF) & (two == 0xBC) & ((three < 0x90) | (three >= 0x9A) & (three <= 0xA0))
        latin = (one == 0xC2) & ~np.isin(two, (0xAA, 0xB5, 0xBA))
        at = np.concatenate([lead[sign], lead[sign] + 1, lead[sign] + 2, lead[latin], lead[latin] + 1])
        alone = lead[(one == 0xE3) & (two > 0x80) | (one >= 0xE4) & (one <= 0xE9)]
        data[at[at < len(data)]] = 32
        cuts = np.concatenate([alone, alone + 3])
    return Words(data, offs, cuts=cuts)


def _chunks(texts: pa.Array):
    """Words of runs of rows: first row, words."""
    for a, _, data, offs in chunks(pc.utf8_lower(texts), 1_000_000):
        yield a, _words(data, offs)


def _indexes(items: DataFrame, max_edit: float, recall: float, min_words: int):
    """An index for each pass, made when its turn comes, of at most ITEMS_AT_ONCE items and about WORDS_AT_ONCE words."""
    words = F.coalesce(F.sum(F.octet_length("text") / 4), F.lit(0))
    n, size = items.agg(F.count("*"), words.cast("long")).first()
    passes = max(1, -(-n // ITEMS_AT_ONCE), -(-size // WORDS_AT_ONCE))
    for k in range(passes):
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).select("item_id", "text").collect() if passes > 1 else items.select("item_id", "text").collect()
        texts = pa.array([r["text"] for r in some], pa.string())
        known = [(some[a + d]["item_id"], w.hash[w.ptr[d] : w.ptr[d + 1]]) for a, w in _chunks(texts) for d in range(len(w.ptr) - 1)]
        yield passes, Index([x for x in known if len(x[1]) >= max(1, min_words)], max_edit, recall)


def contaminated(docs: DataFrame, items: DataFrame, max_edit: float = 0.2, recall: float = 0.99, min_words: int = 1) -> DataFrame:
    """doc_id, item_id, distance, item_words, end_word: each benchmark item that a document has with at most max_edit of
    the item's words edited (inserted, deleted or replaced), at its best place.

    Words are runs of letters and digits in lower case, and single Han and kana characters. docs: doc_id, text; items:
    item_id, text; ids of any type. Null and empty texts match nothing; items of fewer than min_words words are not looked
    for (default: only those without a word); where max_edit allows a short item no edit, its words must stand as they are.
    Repeated rows of documents give repeated rows, repeated items count each; either table may be empty. Whole texts are
    searched, in one pass for ITEMS_AT_ONCE items. An error is raised if MAX_TABLES tables don't reach the recall."""
    ship(docs.sparkSession)
    kinds = [("doc_id", arrow_field(docs, "doc_id")), ("item_id", arrow_field(items, "item_id")), ("distance", pa.int32()), ("item_words", pa.int32()), ("end_word", pa.int64())]
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("item_id", items.schema["item_id"].dataType), StructField("distance", IntegerType()), StructField("item_words", IntegerType()), StructField("end_word", LongType())])
    out = None
    for passes, index in _indexes(items, max_edit, recall, min_words):
        if not index.items:
            continue
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                at, found = [], []
                for a, words in _chunks(batch.column("text")):
                    for d, i, dist, end in index.search(words):
                        at.append(a + d)
                        found.append((index.items[i][0], dist, len(index.items[i][1]), end))
                if at:
                    rest = [pa.array([r[j] for r in found], kind) for j, (_, kind) in enumerate(kinds[1:])]
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at, pa.int64())), *rest], [k for k, _ in kinds])

        found = docs.select("doc_id", "text").mapInArrow(run, schema)
        if passes > 1:  # one index at a time is on the driver and the executors
            found = materialize(found)
            shared.destroy()
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def decontaminate(docs: DataFrame, items: DataFrame, max_edit: float = 0.2, recall: float = 0.99, min_words: int = 1) -> DataFrame:
    """docs, with all columns, without the rows whose text has a benchmark item as contaminated() finds them.

    Each row is judged by its own text, whatever its doc_id (null and repeated ones too); nothing is shuffled."""
    ship(docs.sparkSession)
    out = docs
    for passes, index in _indexes(items, max_edit, recall, min_words):
        if not index.items:
            continue
        shared, place = docs.sparkSession.sparkContext.broadcast(index), docs.columns.index("text")

        def run(batches, shared=shared, place=place):
            index = shared.value
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for a, words in _chunks(batch.column(place)):
                    for d, *_ in index.search(words):
                        clean[a + d] = False
                yield batch.filter(pa.array(clean))

        out = out.mapInArrow(run, docs.schema)
        if passes > 1:
            out = materialize(out)
            shared.destroy()
    return out
