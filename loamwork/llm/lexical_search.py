"""Ranked lexical search by sort-based accumulation.

Every text becomes one row of postings (its length and the counts of the items' terms in it), written once. A second pass
concatenates the matched (item, document, impact) arrays of a run of documents, radix-sorts their packed keys, sums equal
keys by numpy's reduceat and keeps each item's best by heap. A document's postings are in one row, so its sums are whole
where they are made: only each task's best documents are shuffled, range-partitioned by item.
"""

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window as W

from .common import arrow_field, materialize, release, ship, unused

#: Items, and bytes of their texts, that one pass over the documents looks for, at most (one item is never parted). Items
#: are numbered in 16 bits.
ITEMS_AT_ONCE, BYTES_AT_ONCE = 20_000, 8_000_000
#: Triples that are sorted at once, about: one document's are never parted.
TRIPLES_AT_ONCE = 2_000_000
#: Bytes of a text that are parted at once.
PIECE = 4_000_000
#: Every byte as it counts in a term: ASCII letters in lower case, digits and all of non-ASCII; anything else parts terms.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms(text: str | bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of a bounded size."""
    raw, at = (text.encode() if isinstance(text, str) else text or b"").translate(_FOLD), 0
    while at < len(raw):
        end = raw.find(b" ", at + PIECE)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


@dataclass
class Items:
    """The items of a pass: their ids; the number of each term; the items of term t are which[first[t] : first[t + 1]]."""

    ids: list
    number: dict[bytes, int]
    first: np.ndarray
    which: np.ndarray


def _numbered(rows: Iterable) -> Items:
    """Rows of one id are one item that has all their terms."""
    by_id: dict = {}
    for item, text in rows:
        own = by_id.setdefault(item, set())
        for some in terms(text):
            own.update(some)
    number: dict[bytes, int] = {}
    pairs = [(number.setdefault(t, len(number)), i) for i, own in enumerate(by_id.values()) for t in sorted(own)]
    term, item = np.array(pairs, np.int64).reshape(-1, 2).T
    order = np.argsort(term, kind="stable")
    return Items(list(by_id), number, np.searchsorted(term[order], np.arange(len(number) + 1)), item[order].astype(np.uint16))


def _passes(items: DataFrame, item: str, text: str) -> Iterator[Items]:
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    passes = max(1, -(-n // ITEMS_AT_ONCE), -(-size // BYTES_AT_ONCE))
    # 1.5 times as many passes as would do if all were full, as hashes don't deal them out evenly
    passes = passes if passes == 1 else passes + passes // 2 + 1
    for k in range(passes):
        some = items.select(item, text)
        some = some if passes == 1 else some.where(F.pmod(F.xxhash64(F.col(item)), F.lit(passes)) == k)
        yield _numbered(some.collect())


def _posted(docs: DataFrame, found: Items, doc: str, text: str) -> DataFrame:
    """doc, n, term, tf: a text's number of terms, and the items' terms in it with their counts. Texts without terms are left out."""
    shared, place = docs.sparkSession.sparkContext.broadcast(found.number), 1
    schema = StructType([StructField("doc", docs.schema[doc].dataType), *StructType.fromDDL("n bigint, term array<int>, tf array<bigint>")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            at, ns, ends, ids, tfs = [], [], [0], [], []
            for i, x in enumerate(batch.column(place)):
                n, got = 0, Counter()
                for some in terms(x.as_py()):
                    n += len(some)
                    for t, c in Counter(some).items():
                        k = number.get(t)
                        if k is not None:
                            got[k] += c
                if n:
                    at.append(i)
                    ns.append(n)
                    ids += sorted(got)
                    tfs += [got[k] for k in sorted(got)]
                    ends.append(len(ids))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, kind)) for v, kind in ((ids, pa.int32()), (tfs, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(ns, pa.int64()), *lists], ["doc", "n", "term", "tf"])

    return docs.select(doc, text).mapInArrow(run, schema)


def radix_order(keys: np.ndarray, bits: int) -> np.ndarray:
    """The stable order of keys of so many bits: least digit first, 16 bits at a time (numpy sorts 16-bit keys by radix)."""
    order = np.argsort((keys & 0xFFFF).astype(np.uint16), kind="stable")
    for shift in range(16, bits, 16):
        order = order[np.argsort((keys[order] >> shift & 0xFFFF).astype(np.uint16), kind="stable")]
    return order


def accumulate(item: np.ndarray, doc: np.ndarray, impact: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, document, sum of impacts) of each pair, by item and then document."""
    if not len(item):
        return item, doc, impact
    keys = item.astype(np.int64) * docs + doc
    order = radix_order(keys, int(keys.max()).bit_length())
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first] // docs, keys[first] % docs, np.add.reduceat(impact[order], first)


def _lengths(n: np.ndarray, docs: int, words: int) -> np.ndarray:
    """10 + (90 n docs) div words, in whole numbers of any size."""
    if len(n) and 90 * int(n.max()) * docs >= 1 << 63:
        return np.array([10 + 90 * int(x) * docs // words for x in n], np.int64)
    return 10 + 90 * n * docs // words


class _Best:
    """Each item's k best documents so far, as heaps of (score, -null id, -id)."""

    def __init__(self, items: int, k: int):
        self.heaps, self.k, self.least = [[] for _ in range(items)], k, np.ones(items, np.int64)

    def add(self, item: np.ndarray, ids: np.ndarray, null: np.ndarray, score: np.ndarray) -> None:
        """Rows by item. Scores below an item's least are not looked at; of a row of ties only the first ids."""
        keep = score >= self.least[item]
        item, ids, null, score = item[keep], ids[keep], null[keep], score[keep]
        edges = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1], [True]])) if len(item) else []
        for a, b in zip(edges[:-1], edges[1:]):
            rows = np.arange(a, b)
            if b - a > self.k:
                rows = rows[score[a:b] >= np.partition(score[a:b], b - a - self.k)[b - a - self.k]]
                rows = rows[np.lexsort((ids[rows], null[rows], -score[rows]))[: self.k]]
            heap = self.heaps[item[a]]
            for r in rows:
                entry = (int(score[r]), -int(null[r]), -int(ids[r]))
                if len(heap) < self.k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.least[item[a]] = heap[0][0]


def _scored(posted: DataFrame, found: Items, weight: np.ndarray, docs: int, words: int, k: int, item_kind: tuple) -> DataFrame:
    """item, doc, score: each task's k best documents of each item."""
    shared = posted.sparkSession.sparkContext.broadcast((found.ids, found.first, found.which, weight))
    schema = StructType([StructField("item", item_kind[0]), StructField("doc", LongType()), StructField("score", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, first, which, weight = shared.value
        best = _Best(len(ids), k)
        for batch in batches:
            own, n = batch.column("doc"), batch.column("n").to_numpy()
            null, own = own.is_null().to_numpy(zero_copy_only=False), own.fill_null(0).to_numpy()
            m = _lengths(n, docs, words)
            per_doc = np.diff(batch.column("term").offsets.to_numpy())
            term, tf = batch.column("term").flatten().to_numpy(), batch.column("tf").flatten().to_numpy()
            doc = np.repeat(np.arange(len(n)), per_doc)
            impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
            fan = first[term + 1] - first[term]
            through = np.cumsum(np.bincount(doc, fan, len(n))).astype(np.int64)
            a = 0
            while a < len(n):  # runs of documents
                b = max(a + 1, int(np.searchsorted(through, (through[a - 1] if a else 0) + TRIPLES_AT_ONCE)))
                lo, hi = np.searchsorted(doc, [a, b])
                f = fan[lo:hi]
                post = np.repeat(np.arange(lo, hi), f)
                item = which[np.repeat(first[term[lo:hi]] - (np.cumsum(f) - f), f) + np.arange(len(post))]
                who, d, score = accumulate(item, doc[post] - a, impact[post], b - a)
                best.add(who, own[a + d], null[a + d], score)
                a = b
        out = [(ids[i], None if e[1] else -e[2], e[0]) for i, heap in enumerate(best.heaps) for e in heap]
        for a in range(0, len(out), 10_000):
            i, d, s = zip(*out[a : a + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(i, item_kind[1]), pa.array(d, pa.int64()), pa.array(s, pa.int64())], ["item", "doc", "score"])

    return posted.mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """item, rank, doc, score: each item's k documents of the highest scores above 0, equal scores by ascending doc, null last.

    Terms are runs of ASCII letters and digits and of non-ASCII signs, A-Z in lower case. A term's weight is
    floor(1000 ln((2 N + 2) / (2 df + 1))), a document's length m is 10 + (90 n N) div L, and its score sums
    w * ((10^9 tf) div (1000 tf + 8 m)) over an item's different terms. Counts go over all documents and whole texts.

    docs: doc (whole numbers) and text; items: item (any type) and text; other columns are not read. Null and empty texts have no terms:
    such documents are not counted, such items get no rows. Rows with one doc are documents of their own; rows with one item
    (null too) are one item with all their terms. Either table may be empty. Items that one pass can't hold are searched for in several."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(doc).cast("bigint").alias("doc"), F.col(text).alias("text"))
    kind = (items.schema[item].dataType, arrow_field(items, item))
    out, counts = None, None
    for found in _passes(items, item, text):
        if not found.number:
            continue
        posted = materialize(_posted(docs, found, "doc", "text"))
        docs_words = counts = counts or posted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(found.number), np.int64)
        for t, n in posted.select(F.explode("term").alias("term")).groupBy("term").count().toLocalIterator():
            df[t] = n
        weight = np.array([math.floor(1000 * math.log((2 * docs_words[0] + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        tops = materialize(_scored(posted, found, weight, *docs_words, k, kind))
        release(posted)
        out = tops if out is None else out.unionByName(tops)
    if out is None:
        out = spark.createDataFrame([], StructType([StructField("item", kind[0]), StructField("doc", LongType()), StructField("score", LongType())]))
    best = [F.desc("score"), F.asc_nulls_last("doc")]
    # as many tasks' best of an item meet in 64 groups first, then in one
    some = out.withColumn("slot", F.pmod(F.xxhash64("doc"), F.lit(64)))
    some = some.withColumn("rank", F.row_number().over(W.partitionBy("item", "slot").orderBy(*best))).where(F.col("rank") <= k)
    ranked = some.repartitionByRange("item").withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*best)).cast(IntegerType()))
    rank, score = unused([doc, item], "rank", "score")
    return ranked.where(F.col("rank") <= k).select(F.col("item").alias(item), F.col("rank").alias(rank), F.col("doc").alias(doc), F.col("score").alias(score))
