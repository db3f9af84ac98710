"""N-gram Jaccard join by count-vector R-trees.

A text's set is its distinct shingles of five words. The shingles are hashed into groups, and the counts by group are a
point; two sets overlap by at most the sum over groups of the smaller count, and a tree node's overlap with a point is
bounded by its largest corner. Pairs that no bound excludes, neither that of the counts nor a closer one of bitmaps, are
verified on the sets.

One tree over all points would not split well in so many dimensions, nor fit one machine, so there is a forest: a tree
for each set of texts that share one of their least shingle hashes. Texts with one set are one class throughout.
Two sets of similarity s have none of their SKETCH least shingles in common with a chance of about (1 - s) ** SKETCH
(4e-10 at 0.75, in the order of a clash of 64-bit hashes), and sets of under 4 * SKETCH shingles always share one.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.textkernel import chunks, mix, set_ids, shingles
from .common import WORD, materialize, release, rows_at_most, ship, unused

GROUPS, SKETCH = 64, 16
#: Similarity as a fraction, so that every test is one of integers.
NUM, DEN = 75, 100
#: Classes that share a shingle from this number on make it a common one, which moves work and never a link. The common
#: ones are broadcast, so at most MAX_COMMON are (40 MB): from 300 million classes on the number is raised in proportion.
COMMON, MAX_COMMON = 1000, 5_000_000
#: Points and bytes of sets of one tree, about; larger trees are cut into chunks, which share about PIVOTS points.
CHUNK, CHUNK_BYTES, PIVOTS, LEAF = 4000, 32_000_000, 32, 16
#: A factor between sizes of sets that no link spans: somewhat over DEN / NUM. Larger trees are cut by it into bands first.
BAND = 1.35
BROADCAST_IDS = 500_000
_U = np.uint64


def needed(a, b):
    """Least intersection that links sets of sizes a and b: DEN * i >= NUM * (a + b - i)."""
    return -(-NUM * (a + b) // (NUM + DEN))


def _points(h: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    doc = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    flat = np.bincount(doc * GROUPS + (h >> _U(58)).astype(np.int64), minlength=(len(ptr) - 1) * GROUPS)
    # the narrowest type that holds the counts: a bound reads 64 of them
    kind = next(t for t in ("<u1", "<u2", "<u4") if t == "<u4" or flat.max(initial=0) <= np.iinfo(t).max)
    return np.minimum(flat, 0xFFFFFFFF).astype(kind).reshape(-1, GROUPS)


def _marks(h: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a bitmap of each set, by low bits of its hashes; how many of its members share a bit with an earlier one).

    Bitmaps have about 8 to 16 bits a member of a set of mean size, 512 at least: an eighth to a quarter of the sets' bytes."""
    n = np.diff(ptr)
    bits = max(512, 1 << int(8 * max(1, len(h) // max(1, len(n))) - 1).bit_length())
    at, out, twice, rows = (h & _U(bits - 1)).astype(np.int64), [], [], max(1, (1 << 23) // bits)
    for x in range(0, len(n), rows):
        y = min(x + rows, len(n))
        flags = np.zeros((y - x) * bits, bool)
        flags[np.repeat(np.arange(y - x) * bits, n[x:y]) + at[ptr[x] : ptr[y]]] = True
        flags = flags.reshape(y - x, bits)
        out.append(np.packbits(flags, axis=1).view(np.uint64))
        twice.append(n[x:y] - flags.sum(axis=1))
    return np.concatenate(out), np.concatenate(twice)


def _common_at_most(marks: np.ndarray, twice: np.ndarray, i: np.ndarray, k: np.ndarray, step: int = 20_000) -> np.ndarray:
    """What sets i and k share at most, for many pairs: bits that both have, and members of either that share a bit."""
    out = np.minimum(twice[i], twice[k])
    for x in range(0, len(i), step):
        out[x : x + step] += np.bitwise_count(marks[i[x : x + step]] & marks[k[x : x + step]]).sum(axis=1, dtype=np.int64)
    return out


def _sets(docs: DataFrame) -> DataFrame:
    """docs without text, with cls, n and keys (the SKETCH least hashes) of each row; cls and keys are null without a word."""
    rest = [c for c in docs.columns if c != "text"]

    def run(batches):
        for batch in batches:
            cls, n, keys = [], [], []
            for a, b, data, offs in chunks(batch.column("text")):
                h, ptr = shingles(data, offs)
                cls.append(set_ids(h, ptr))
                n.append(np.diff(ptr))
                keys += [h[x : min(y, x + SKETCH)].view(np.int64) if y > x else None for x, y in zip(ptr[:-1], ptr[1:])]
            n = np.concatenate(n) if n else np.zeros(0, np.int64)
            c = pa.array(np.concatenate(cls).view(np.int64) if cls else np.zeros(0, np.int64), mask=n == 0)
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in rest), c, pa.array(n, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], [*rest, "cls", "n", "keys"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest)
    return docs.mapInArrow(run, f"{fields}, cls long, n long, keys array<long>")


def _full_keys(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """cls, keys of texts with a common shingle among their SKETCH least: the SKETCH least that are not common, or more.

    A text has its full prefix when common shingles come last, if four or more of its SKETCH least are common or if under
    SKETCH of all are not common, as in a short text. The prefix has n - needed + 1 shingles. All of it that is not common
    is kept; where it reaches common ones, the SKETCH least of those are: two sets that share common ones alone are still
    as similar on these."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches):
        common = shared.value
        for batch in batches:
            cls, keys = [], []
            for a, b, data, offs in chunks(batch.column("text")):
                h, ptr = shingles(data, offs)
                ids = set_ids(h, ptr)
                hot = common[np.minimum(np.searchsorted(common, h), len(common) - 1)] == h
                sums = np.concatenate([[0], np.cumsum(hot)])
                least = sums[np.minimum(ptr[:-1] + SKETCH, ptr[1:])] - sums[ptr[:-1]]
                plain = np.diff(ptr) - (sums[ptr[1:]] - sums[ptr[:-1]])
                # a text that is passed over has no common key, so SKETCH plain ones or nothing else
                for i in np.flatnonzero(least):
                    mine, flag = h[ptr[i] : ptr[i + 1]], hot[ptr[i] : ptr[i + 1]]
                    size = len(mine) - -(-NUM * len(mine) // DEN) + 1
                    rare = mine[~flag]
                    if least[i] < 4 and plain[i] >= SKETCH:
                        k = rare[:SKETCH]
                    else:
                        k = rare[: max(size, SKETCH)] if len(rare) >= size else np.concatenate([rare, mine[flag][:SKETCH]])
                    cls.append(ids[i])
                    keys.append(k.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.array(cls, np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64()))], ["cls", "keys"])

    return docs.select("text").mapInArrow(run, "cls long, keys array<long>").dropDuplicates(["cls"])


class Tree:
    """An R-tree over points (rows of counts) with sizes n: bulk-loaded by halving at the widest group, leaves of LEAF."""

    def __init__(self, points: np.ndarray, n: np.ndarray):
        self.points, self.n = points, n
        parts, levels = [np.arange(len(n))], []
        while max(map(len, parts)) > LEAF:
            new = []
            for p in parts:
                if len(p) <= LEAF:
                    new.append(p)
                    continue
                x = points[p].astype(np.int64)
                spread = x.max(axis=0) - x.min(axis=0)
                by = n[p] if 4 * (n[p].max() - n[p].min()) > len(spread) * spread.max() else x[:, int(spread.argmax())]
                p = p[np.argsort(by, kind="stable")]
                new += [p[: len(p) // 2], p[len(p) // 2 :]]
            levels.append((parts, new))
            parts = new
        self.leaves = parts
        self.order, self.starts = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]])
        self.top = np.stack([points[p].max(axis=0) for p in parts])
        self.least, self.most = np.array([n[p].min() for p in parts]), np.array([n[p].max() for p in parts])
        # inner nodes: every run of 2 ** k leaves, bottom up
        self.levels = [(self.top, self.least, self.most)]
        while len(self.levels[-1][1]) > 1:
            t, a, b = self.levels[-1]
            at = np.arange(0, len(a), 8)
            self.levels.append((np.maximum.reduceat(t, at), np.minimum.reduceat(a, at), np.maximum.reduceat(b, at)))

    def _joined(self, comp: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """The least and the greatest component of each node's points, level by level."""
        c = comp[self.order]
        out = [(np.minimum.reduceat(c, self.starts), np.maximum.reduceat(c, self.starts))]
        for _ in self.levels[1:]:
            lo, hi = out[-1]
            at = np.arange(0, len(lo), 8)
            out.append((np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)))
        return out

    def search(self, points: np.ndarray, n: np.ndarray, labels):
        """(query, point, bound of the overlap) that no bound excludes, for each block of queries.

        labels() gives the components of the tree's points and of the queries at that time: pairs within one, and nodes all
        of whose points are in the query's, are passed over."""
        root = len(self.levels[-1][1])
        for a in range(0, len(n), 64):
            comp, own = labels()
            same, own = self._joined(comp), own[a : a + 64]
            q, m = points[a : a + 64], n[a : a + 64]
            i, k = np.repeat(np.arange(len(m)), root), np.tile(np.arange(root), len(m))
            for depth in range(len(self.levels) - 1, -1, -1):
                (top, least, most), (lo, hi) = self.levels[depth], same[depth]
                ok = (DEN * most[k] >= NUM * m[i]) & (DEN * m[i] >= NUM * least[k]) & ((lo[k] != own[i]) | (hi[k] != own[i]))
                i, k = i[ok], k[ok]
                small = np.maximum(least[k], -(-NUM * m[i] // DEN))
                ok = _overlap(q, i, top, k) >= needed(m[i], small)
                i, k = i[ok], k[ok]
                if depth:
                    width = len(self.levels[depth - 1][1])
                    i, k = np.repeat(i, 8), (k[:, None] * 8 + np.arange(8)).ravel()
                    i, k = i[k < width], k[k < width]
            if not len(i):
                continue
            size = np.array([len(self.leaves[x]) for x in k])
            i, p = np.repeat(i, size), np.concatenate([self.leaves[x] for x in k])
            ok = (comp[p] != own[i]) & (DEN * np.minimum(m[i], self.n[p]) >= NUM * np.maximum(m[i], self.n[p]))
            i, p = i[ok], p[ok]
            bound = _overlap(q, i, self.points, p)
            ok = bound >= needed(m[i], self.n[p])
            yield i[ok] + a, p[ok], bound[ok]


def _overlap(a: np.ndarray, i: np.ndarray, b: np.ndarray, k: np.ndarray, step: int = 20_000) -> np.ndarray:
    """Sum over groups of the smaller of a[i] and b[k], for many pairs, in pieces that stay small in memory."""
    out = np.zeros(len(i), np.int64)
    for x in range(0, len(i), step):
        out[x : x + step] = np.minimum(a[i[x : x + step]], b[k[x : x + step]]).sum(axis=1, dtype=np.int64)
    return out


def tree_links(cls: np.ndarray, sets: list[np.ndarray], side: np.ndarray | None = None, joined: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join up, as a forest, what the sets' pairs of similarity NUM / DEN or more connect.

    side (0 or 1): only pairs across count. A pair whose ends are joined already, by a link found here or by the same
    value in joined, is not verified."""
    ptr = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    flat = np.concatenate(sets)
    points, n = _points(flat, ptr), np.diff(ptr)
    a = np.arange(len(sets)) if side is None else np.flatnonzero(side == 0)
    b = a if side is None else np.flatnonzero(side == 1)
    if not len(a) or not len(b):
        return []
    comp = np.arange(len(sets)) if joined is None else np.unique(joined, return_inverse=True)[1]
    tree, out = Tree(points[a], n[a]), []
    marks, twice = _marks(flat, ptr)

    def verify(me: int, it: int) -> None:
        i = len(np.intersect1d(sets[me], sets[it], assume_unique=True))
        if DEN * i >= NUM * (n[me] + n[it] - i):
            out.append((int(cls[me]), int(cls[it])))
            comp[comp == comp[it]] = comp[me]

    if side is None:  # neighbours in the tree first: most of a group of near copies is one component from then on
        near = a[tree.order]
        q, p = near[:-1], near[1:]
        ok = _common_at_most(marks, twice, q, p) >= needed(n[q], n[p])
        for me, it in zip(q[ok], p[ok]):
            if comp[me] != comp[it]:
                verify(me, it)
    for q, p, bound in tree.search(points[b], n[b], lambda: (comp[a], comp[b])):
        q, p = b[q], a[p]
        ok = q > p if side is None else np.ones(len(q), bool)
        q, p = q[ok], p[ok]
        bound = np.minimum(bound[ok], _common_at_most(marks, twice, q, p))
        ok = bound >= needed(n[q], n[p])
        q, p, bound = q[ok], p[ok], bound[ok]
        order = np.lexsort((-bound, q))
        q, p = q[order], p[order]
        cut = np.flatnonzero(np.diff(q, prepend=-1))
        for x, y in zip(cut, np.append(cut[1:], len(q))):
            me, others = q[x], p[x:y]
            while len(others := others[comp[others] != comp[me]]):
                it, others = others[0], others[1:]
                verify(me, it)
    return out


def components(edges: DataFrame) -> DataFrame:
    """node, comp (the least node of its component) of the nodes of edges (u, v: longs), by large and small stars.

    Each round is a few grouped minima and joins on written tables; nothing of the graph comes to the driver."""
    pairs = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        old, least = pairs, both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = materialize(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        pairs = materialize(small.where("u <> v").select("u", "v").distinct())
        release(old, large)
        now = pairs.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if now == seen:
            break
        seen = now
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(pairs.select(F.col("v").alias("node"), F.col("v").alias("comp"))).distinct()


def _shared(keys: DataFrame) -> DataFrame:
    """key, m (classes that have it), size (of their sets) and what tells sets of classes apart, of keys that classes share."""
    per = keys.groupBy("key").agg(F.count("*").alias("m"), F.sum("n").alias("size"), F.min("cls").alias("lo"), F.max("cls").alias("hi"), F.sum(F.xxhash64("cls").cast("decimal(38,0)")).alias("mark"))
    return materialize(per.where("m > 1"))


def _solve(blocks: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v: links within the blocks (cls, block, part, comp; part 0: all pairs, 1 and 2: pairs across)."""
    full = blocks.join(sets, "cls").repartition("block").sortWithinPartitions("block")

    def link(batches):
        def solve(rows):
            cls, part, comp = (np.array([r[j] for r in rows], np.int64) for j in (0, 1, 2))
            return tree_links(cls, [np.frombuffer(r[3], "<u8") for r in rows], None if (part == 0).all() else part - 1, comp)

        now, rows, out = None, [], []
        for batch in batches:
            for block, *row in zip(*(batch.column(k).to_pylist() for k in ("block", "cls", "part", "comp", "set"))):
                if block != now:
                    if len(rows) > 1:
                        out += solve(rows)
                    now, rows = block, []
                rows.append(row)
        if len(rows) > 1:
            out += solve(rows)
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["u", "v"])

    return full.select("block", "cls", "part", "comp", "set").mapInArrow(link, "u long, v long").distinct()


def _links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """u, v: links between classes (cls, rep, n, keys) that connect all that are similar.

    A tree of over CHUNK points is cut into bands of size and those into chunks that share some pivots. Links within chunks,
    and to the pivots, make one component of most of a group of near copies; only the points outside a tree's largest
    component are then searched for, among each other and in it. Pairs inside a component need no search, and no link
    spans more than two neighbouring bands, so no link between two is lost."""
    keys = classes.select("cls", "n", F.explode("keys").alias("key"))
    many = _shared(keys)
    bound = max(COMMON, -(-SKETCH * classes.count() // MAX_COMMON))
    common = many.where(F.col("m") >= bound).select("key").toArrow().column("key").to_numpy()
    if len(common):
        # texts with common keys have their full prefix, or uncommon keys instead of them; others keep their keys
        full = _full_keys(docs, np.sort(common.astype(np.int64).view(np.uint64))).withColumnRenamed("keys", "more")
        keys = classes.join(full, "cls", "left").select("cls", "n", F.explode(F.array_distinct(F.coalesce("more", "keys"))).alias("key"))
        keys = materialize(keys)
        release(many)
        many = _shared(keys)
    # shingles that the same classes share make one tree
    trees = many.groupBy("m", "size", "lo", "hi", "mark").agg(F.min("key").alias("key")).select("key", _chunks(F.col("m"), F.col("size")).alias("c"))
    members = materialize(keys.join(trees, "key").select("key", "c", "cls", "n"))

    # the sets of members only, once each
    wanted = members.select("cls").distinct().join(classes.select("cls", "rep"), "cls").select("rep").distinct()
    wanted = F.broadcast(wanted) if rows_at_most(wanted, BROADCAST_IDS) else wanted
    some = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["rep"])).select("text")

    def cut(batches):
        for batch in batches:
            cls, sets = [], []
            for a, b, data, offs in chunks(batch.column("text")):
                h, ptr = shingles(data, offs)
                cls += set_ids(h, ptr).view(np.int64).tolist()
                sets += [h[x:y].astype("<u8").tobytes() for x, y in zip(ptr[:-1], ptr[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(sets, pa.binary())], ["cls", "set"])

    sets = some.mapInArrow(cut, "cls long, set binary").dropDuplicates(["cls"])
    hot = not trees.where("c > 1").limit(1).isEmpty()
    whole = members.where("c = 1").select("cls", F.xxhash64("key").alias("block"), F.lit(0).alias("part"), F.col("cls").alias("comp"))
    if not hot:
        return _solve(whole, sets)
    sets = materialize(sets, "lz4")
    large = materialize(_banded(members.where("c > 1")))
    links = materialize(_solve(whole.unionByName(_first_blocks(large)), sets))
    return links.unionByName(_solve(_rest_blocks(large, links), sets))


def _chunks(rows, size):
    return F.greatest(F.ceil(rows / CHUNK), F.ceil(size * 8 / CHUNK_BYTES)).cast("int")


def _beside(units: DataFrame, *counts: str) -> DataFrame:
    """units (key, band, counts) with <count>_down and <count>_up: those of the bands next to it, 0 where there is none."""
    w, out = W.partitionBy("key").orderBy("band"), units
    for c in counts:
        at = lambda f, d, c=c: F.coalesce(F.when(f("band").over(w) == F.col("band") + d, f(c).over(w)), F.lit(0))
        out = out.withColumns({f"{c}_down": at(F.lag, -1), f"{c}_up": at(F.lead, 1)})
    return out


def _banded(members: DataFrame) -> DataFrame:
    """members of large trees with band (of their set's size), m (of the tree's points in it), c (chunks of it) and c_up."""
    x = members.withColumn("band", F.floor(F.log("n") / float(np.log(BAND))).cast("int"))
    units = x.groupBy("key", "band").agg(F.count("*").alias("m"), F.sum("n").alias("size"))
    units = _beside(units.select("key", "band", "m", F.least(_chunks(F.col("m"), F.col("size")), "m").cast("int").alias("c")), "c")
    return x.select("key", "band", "cls", "n").join(units, ["key", "band"]).select("key", "band", "cls", "n", "m", "c", "c_up")


def _to(count, block, part) -> object:
    """An array of blocks and parts, one for each o below count."""
    kind = "array<struct<block: bigint, part: int>>"
    every = F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda o: F.struct(block(o).alias("block"), part(o).cast("int").alias("part")))
    return F.when(count > 0, every).otherwise(F.array().cast(kind))


def _first_blocks(large: DataFrame) -> DataFrame:
    """Each point in its own chunk, and a band's pivots in all of its chunks and those of the next band."""
    mine = F.pmod(F.xxhash64("cls", "key"), F.col("c")).cast("int")
    pivot = F.pmod(F.xxhash64("cls", "key", F.lit(3)), F.col("m")) < PIVOTS
    block = lambda band: lambda o: F.xxhash64("key", band, o)
    own = F.array(F.struct(block(F.col("band"))(F.col("mine")).alias("block"), F.lit(0).alias("part")))
    spread = F.concat(_to(F.col("c"), block(F.col("band")), lambda o: F.lit(0)), _to(F.col("c_up"), block(F.col("band") + 1), lambda o: F.lit(0)))
    x = large.withColumn("mine", mine).withColumn("to", F.when(pivot, spread).otherwise(own))
    return x.select("cls", F.inline("to"), F.col("cls").alias("comp"))


def _rest_blocks(large: DataFrame, links: DataFrame) -> DataFrame:
    """Of each large tree, the points outside its largest component against each other and against that component, within
    the bands that a link can span."""
    x = large.join(components(links).withColumnRenamed("node", "cls"), "cls", "left").select("key", "band", "cls", "n", F.coalesce("comp", "cls").alias("comp"))
    top = x.groupBy("key", "comp").count().groupBy("key").agg(F.max_by("comp", F.struct("count", "comp")).alias("top"), F.count("*").alias("comps")).where("comps > 1")
    x = materialize(x.join(top, "key").select("key", "band", "cls", "n", "comp", (F.col("comp") != F.col("top")).alias("rest")))
    count = lambda c: _chunks(F.count_if(c), F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)))
    units = x.groupBy("key", "band").agg(count(F.col("rest")).alias("r"), count(~F.col("rest")).alias("t"))
    x = x.join(_beside(units, "r", "t"), ["key", "band"])
    i = F.pmod(F.xxhash64("cls", "key", F.lit(4)), F.greatest(F.when(F.col("rest"), F.col("r")).otherwise(F.col("t")), F.lit(1))).cast("int")
    x = x.withColumn("i", i)
    name = lambda tag, band, a, b: F.xxhash64("key", F.lit(tag), band, a, b)
    band, i, one, two = F.col("band"), F.col("i"), lambda o: F.lit(1), lambda o: F.lit(2)
    rest = F.concat(
        _to(F.col("r"), lambda o: name(0, band, F.least(i, o), F.greatest(i, o)), lambda o: F.when(i == o, 0).when(i < o, 1).otherwise(2)),
        _to(F.col("r_up"), lambda o: name(1, band, i, o), one),
        _to(F.col("r_down"), lambda o: name(1, band - 1, o, i), two),
        _to(F.col("t"), lambda o: name(2, band, i, o), one),
        _to(F.col("t_up"), lambda o: name(3, band, i, o), one),
        _to(F.col("t_down"), lambda o: name(4, band, i, o), one),
    )
    others = F.concat(
        _to(F.col("r"), lambda o: name(2, band, o, i), two),
        _to(F.col("r_down"), lambda o: name(3, band - 1, o, i), two),
        _to(F.col("r_up"), lambda o: name(4, band + 1, o, i), two),
    )
    return x.select("cls", F.inline(F.when(F.col("rest"), rest).otherwise(others)), "comp")


def _components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows: docs without text, with cls and n; cls, comp and rep, the least doc_id, of each class)."""
    ship(docs.sparkSession)
    rows = materialize(_sets(docs))
    classes = materialize(rows.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys")))
    comps = materialize(components(_links(docs.select("doc_id", "text"), classes)))
    named = classes.select("cls", "rep").join(comps, F.col("cls") == F.col("node"), "left").select("cls", "rep", F.coalesce("comp", "cls").alias("comp"))
    return rows.drop("keys"), named


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs (doc_id, text): the least doc_id that links reach.

    Words are lower-cased A-Z; two sets link from a similarity of 0.75. Null and empty texts, and texts without words, have
    no shingle, link with nothing and are their own component. A null doc_id counts for the links, not for the least
    doc_id (null if a component has no other). Repeated rows are one class; an empty table gives an empty one."""
    rows, named = _components(docs.select("doc_id", "text"))
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    of = named.select("cls", "comp").join(least, "comp").select("cls", "component_id")
    return rows.join(of, "cls", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def jaccard_dedup(docs: DataFrame) -> DataFrame:
    """docs, with all columns, with one row of each component: that of the least doc_id (nulls last), then of the least
    hash of the text; of rows that repeat both, one. Rows without a word link with nothing and all stay."""
    t, d, u, n, r = unused(docs.columns, "t", "d", "u", "n", "r")
    rows, named = _components(docs.select("doc_id", F.xxhash64("text").alias("t"), "text"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "t")
    one = rows.join(named.select("cls", "comp"), "cls").groupBy("comp", "doc_id", "t").agg(F.count("*").alias("n"))
    stay = materialize(one.groupBy("comp").agg(F.min_by(F.struct("doc_id", "t", "n"), order).alias("x")).select(F.col("x.doc_id").alias(d), F.col("x.t").alias(u), F.col("x.n").alias(n)))
    side = F.broadcast(stay) if rows_at_most(stay, BROADCAST_IDS) else stay
    keyed = docs.withColumn(t, F.xxhash64("text"))
    words = F.regexp_like(F.coalesce("text", F.lit("")), F.lit(WORD))
    kept = keyed.join(side, keyed["doc_id"].eqNullSafe(side[d]) & (keyed[t] == side[u]), "left").where(F.col(n).isNotNull() | ~words)
    if not stay.where(F.col(n) > 1).limit(1).isEmpty():
        first = F.row_number().over(W.partitionBy("doc_id", t).orderBy(F.lit(1)))
        twice = kept.where(F.col(n) > 1).withColumn(r, first).where(F.col(r) == 1).drop(r)
        kept = kept.where(F.col(n).isNull() | (F.col(n) == 1)).unionByName(twice)
    return kept.drop(t, d, u, n)
