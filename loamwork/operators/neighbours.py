"""Near neighbours: MinHash components of texts and density clusters of points, without a pair for every two of a group."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.textkernel import chunks, set_ids, shingles
from ..sources.sinks import checkpointed
from ..sources.tables import ship
from .graph import connected


def _signed(docs: DataFrame, words: int, bands: int, rows: int, seed: int) -> DataFrame:
    """doc_id, n, h, keys: how many different runs of so many words (A-Z in lower case) a text has, a hash of their set and
    the buckets of its MinHash signature, one a band. A text of fewer words is one run; one without words (or null) has none,
    a null hash and no bucket."""
    rng = np.random.default_rng(seed)
    odd = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    fold = rng.integers(0, 1 << 63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches):
        for batch in batches:
            for a, b, data, offs in chunks(batch.column(1)):
                flat, ptr = shingles(data, offs, words)
                n = np.diff(ptr)
                first = ptr[:-1][n > 0]
                sig = np.empty((len(first), bands * rows), np.uint64)
                with np.errstate(over="ignore"):
                    for k, by in enumerate(odd if len(first) else ()):  # a permutation: multiplied by an odd number, high bits folded down
                        x = flat * by
                        sig[:, k] = np.minimum.reduceat((x ^ (x >> np.uint64(29))) * by, first)
                    keys = (sig.reshape(-1, bands, rows) * fold).sum(axis=2) + np.arange(bands, dtype=np.uint64) * fold[0]
                upto = np.concatenate([[0], np.cumsum(n > 0) * bands])
                lists = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(keys.ravel().view(np.int64)))
                h = pa.array(set_ids(flat, ptr).view(np.int64), mask=n == 0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), h, lists], ["doc_id", "n", "h", "keys"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, h long, keys array<long>")


def _sets(docs: DataFrame, words: int, wanted: np.ndarray | None) -> DataFrame:
    """h, n, sketch, shingles: the sets whose hash is in `wanted` (ascending; None: all), at most one of a hash from each task if
    given. A sketch counts members by their high bits, in as many bytes as a set has members, rounded up to a power of two;
    it is empty if a count is over 255."""

    def sketch(members):
        bits = max(1, (len(members) - 1).bit_length())
        count = np.bincount((members >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        return count.astype(np.uint8).tobytes() if count.max() <= 255 else b""

    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        wanted = shared.value
        seen = None if wanted is None else np.zeros(len(wanted), bool)
        for batch in batches:
            for _, _, data, offs in chunks(batch.column(1)):
                flat, ptr = shingles(data, offs, words)
                h = set_ids(flat, ptr).view(np.int64)
                x = np.flatnonzero(np.diff(ptr))
                if seen is not None:
                    at = np.searchsorted(wanted, h)
                    x = x[at[x] < len(wanted)]
                    x = x[(wanted[at[x]] == h[x]) & ~seen[at[x]]]
                    x = x[np.unique(at[x], return_index=True)[1]]
                    seen[at[x]] = True
                if len(x):
                    sets = pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(flat.view(np.int64))).take(pa.array(x))
                    sketches = pa.array([sketch(flat[ptr[i] : ptr[i + 1]]) for i in x], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(h[x]), pa.array(np.diff(ptr)[x], pa.int64()), sketches, sets], ["h", "n", "sketch", "shingles"])

    return docs.mapInArrow(run, "h long, n long, sketch binary, shingles array<long>")


def _may_link(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) but those that cannot be as similar: sets share at most the sum of the lesser counts of their sketches."""

    def common(x, y):
        x, y = sorted((np.frombuffer(v, np.uint8) for v in (x, y)), key=len)
        return int(np.minimum(x, y.reshape(len(x), -1).sum(axis=1)).sum())

    def run(batches):
        for batch in batches:
            a, b, n, x, m, y = (c.to_pylist() for c in batch.columns)
            keep = [not u or not v or (100 + percent) * common(u, v) >= percent * (i + k) for i, u, k, v in zip(n, x, m, y)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    x, y = (classes.select(F.col("h").alias(k), F.col("n").alias(f"n{k}"), F.col("sketch").alias(f"s{k}")) for k in "ab")
    return checkpointed(pairs.join(x, "a").join(y, "b").select("a", "b", "na", "sa", "nb", "sb").mapInArrow(run, "a long, b long"))


def _linked(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """src, dst of pairs (a, b) whose sets are as similar."""
    a, b = classes.select(F.col("h").alias("a"), F.col("shingles").alias("x")), classes.select(F.col("h").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return checkpointed(_may_link(pairs, classes, percent).join(a, "a").join(b, "b").where(100 * both >= percent * (F.size("x") + F.size("y") - both)).select(F.col("a").alias("src"), F.col("b").alias("dst")))


def minhash_components(docs: DataFrame, percent: int = 75, words: int = 5, bands: int = 20, rows: int = 4, seed: int = 1, most: int = 5_000_000) -> DataFrame:
    """doc_id, n_shingles, component: the least doc_id that a text is linked to by texts of at least `percent` similarity.

    Equal sets are one class from the start. Classes that share a band meet in its bucket: first all of a bucket are held
    against its least class, which joins most of a group of near copies; then only those that are not in the bucket's
    largest component are held against the others. No candidate pair is left out but between classes that are joined
    already. Two sets of similarity s share a band with a chance of 1 - (1 - s^rows)^bands: 0.9995 at 0.75.

    Sets are not kept: those of classes that share a bucket are made from the texts once more, where these are read; up to
    `most` hashes of such classes are broadcast for that, and if there are more, all sets are shuffled to meet them. Pairs are
    first held against each other by sketches, an eighth to a quarter of a set, which pass over no link; only what these
    leave open gets whole sets.

    Texts without words are alone; null doc_ids are rows of their own class by text (their component is the least id that is
    not null, if there is one); repeated rows are equal sets; an empty table gives an empty one."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    signed = checkpointed(_signed(docs, words, bands, rows, seed))
    some = signed.where("n > 0")
    members = some.select("h", "n", "keys").dropDuplicates(["h"]).select(F.explode("keys").alias("bucket"), "h", "n")
    shared = members.groupBy("bucket").agg(F.count("*").alias("c"), F.min(F.struct("h", "n")).alias("p")).where("c > 1").select("bucket", "p")
    members = checkpointed(members.join(shared, "bucket"))
    wanted = checkpointed(members.select("h").distinct())
    if wanted.count() <= most:
        sets = _sets(docs, words, np.sort(wanted.toArrow()["h"].to_numpy()))
    else:
        sets = _sets(docs, words, None).join(wanted, "h", "left_semi")
    classes = checkpointed(sets.dropDuplicates(["h"]))
    ratio = lambda m, n: 100 * F.least(m, n) >= percent * F.greatest(m, n)
    star = members.where((F.col("h") != F.col("p.h")) & ratio(F.col("n"), F.col("p.n"))).select(F.col("p.h").alias("a"), F.col("h").alias("b")).distinct()
    links = _linked(star, classes, percent)
    labels = connected(links).select(F.col("n").alias("h"), "component")
    placed = members.select("bucket", "h", "n").join(labels, "h", "left").select("bucket", "h", "n", F.coalesce("component", "h").alias("c"))
    sizes = placed.groupBy("bucket", "c").count().groupBy("bucket").agg(F.max_by("c", F.struct("count", "c")).alias("big"), F.count("*").alias("k")).where("k > 1")
    placed = checkpointed(placed.join(sizes.select("bucket", "big"), "bucket"))
    rest = placed.where("c <> big").select("bucket", F.col("h").alias("x"), F.col("n").alias("m"), F.col("c").alias("d"))
    pairs = rest.join(placed, "bucket").where((F.col("c") != F.col("d")) & ratio(F.col("n"), F.col("m"))).select(F.least("x", "h").alias("a"), F.greatest("x", "h").alias("b")).distinct()
    labels = connected(links.unionByName(_linked(pairs, classes, percent))).select(F.col("n").alias("h"), "component")
    named = some.select("doc_id", "h").join(labels, "h", "left").withColumn("c", F.coalesce("component", "h"))
    least = named.groupBy("c").agg(F.min("doc_id").alias("component"))
    own = named.select("h", "c").distinct().join(least, "c").select("h", "component")
    return signed.join(own, "h", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component"))


def _near(x: Column, y: Column, u: Column, v: Column, eps: float) -> Column:
    return (x - u) * (x - u) + (y - v) * (y - v) <= eps * eps


def _around(df: DataFrame, reach: int, x: str = "cx", y: str = "cy") -> DataFrame:
    """df with a row for each cell up to `reach` away: ax, ay."""
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    return df.withColumn("__dx", F.explode(steps)).withColumn("__dy", F.explode(steps)).withColumn("ax", F.col(x) + F.col("__dx")).withColumn("ay", F.col(y) + F.col("__dy")).drop("__dx", "__dy")


def dbscan(df: DataFrame, key: str, x: str, y: str, eps: float, least: int) -> DataFrame:
    """key, core, cluster: density clusters of points in the plane. A point is core if `least` points, itself included, are
    within eps; core points within eps of each other are one cluster, named by the least key of its core points; another
    point takes the least cluster of a core point within eps, or none.

    Points lie in cells of side eps / sqrt(2), so a cell with `least` points has only core points, all of one cluster: only
    points of thin cells are counted one by one, against the 24 cells around. Cells are linked by boxes of a finer grid, and
    only boxes that might be within reach are opened. Equal points are one point with a weight. Rows with a null or NaN
    coordinate are in no cluster; an empty table gives an empty one."""
    side = eps / 2**0.5
    rows = df.select(F.col(key).alias("key"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    known = F.coalesce(~F.isnan("x") & ~F.isnan("y"), F.lit(False))
    cell = lambda c, s: F.floor(F.col(c) / s)
    points = rows.where(known).groupBy("x", "y").agg(F.count("*").alias("n"), F.min("key").alias("key")).withColumns({"cx": cell("x", side), "cy": cell("y", side)})
    thick = points.groupBy("cx", "cy").agg((F.sum("n") >= least).alias("thick"))
    points = checkpointed(points.join(thick, ["cx", "cy"]))
    others = points.select(F.col("cx").alias("ax"), F.col("cy").alias("ay"), F.col("x").alias("u"), F.col("y").alias("v"), F.col("n").alias("m"))
    met = _around(points.where("not thick"), 2).join(others, ["ax", "ay"]).where(_near(F.col("x"), F.col("y"), F.col("u"), F.col("v"), eps))
    counted = met.groupBy("x", "y").agg((F.sum("m") >= least).alias("__core"))
    points = checkpointed(points.join(counted, ["x", "y"], "left").withColumn("core", F.col("thick") | F.coalesce("__core", F.lit(False))).withColumn("cell", F.xxhash64("cx", "cy")).drop("__core"))
    core = points.where("core").withColumns({"bx": cell("x", side / 8), "by": cell("y", side / 8)})
    boxes = checkpointed(core.groupBy("cx", "cy", "cell", "bx", "by").agg(*(f(c).alias(f"{c}{k}") for c in ("x", "y") for k, f in ((0, F.min), (1, F.max)))))
    far = [F.col(c).alias(f"_{c}") for c in ("cell", "bx", "by", "x0", "x1", "y0", "y1")]
    met = _around(boxes, 2).join(boxes.select(F.col("cx").alias("ax"), F.col("cy").alias("ay"), *far), ["ax", "ay"]).where("cell < _cell")
    gap = lambda c: F.greatest(F.lit(0.0), F.col(f"_{c}0") - F.col(f"{c}1"), F.col(f"{c}0") - F.col(f"_{c}1"))
    span = lambda c: F.greatest(F.col(f"_{c}1") - F.col(f"{c}0"), F.col(f"{c}1") - F.col(f"_{c}0"))
    met = met.withColumn("sure", span("x") * span("x") + span("y") * span("y") <= eps * eps).where(gap("x") * gap("x") + gap("y") * gap("y") <= eps * eps)
    met = checkpointed(met.select("cell", "_cell", "bx", "by", "_bx", "_by", "sure"))
    sure = met.where("sure").select(F.col("cell").alias("src"), F.col("_cell").alias("dst")).distinct()
    open_ = met.join(sure.select(F.col("src").alias("cell"), F.col("dst").alias("_cell")), ["cell", "_cell"], "left_anti")
    a = core.select("bx", "by", "x", "y")
    b = core.select(F.col("bx").alias("_bx"), F.col("by").alias("_by"), F.col("x").alias("u"), F.col("y").alias("v"))
    opened = open_.join(a, ["bx", "by"]).join(b, ["_bx", "_by"]).where(_near(F.col("x"), F.col("y"), F.col("u"), F.col("v"), eps)).select(F.col("cell").alias("src"), F.col("_cell").alias("dst")).distinct()
    parts = connected(sure.unionByName(opened)).select(F.col("n").alias("cell"), "component")
    core = points.where("core").join(parts, "cell", "left").withColumn("c", F.coalesce("component", "cell"))
    names = core.groupBy("c").agg(F.min("key").alias("cluster"))
    core = checkpointed(core.join(names, "c").select("x", "y", "cx", "cy", "cluster"))
    edge = _around(points.where("not core").select("x", "y", "cx", "cy"), 2).join(core.select(F.col("cx").alias("ax"), F.col("cy").alias("ay"), F.col("x").alias("u"), F.col("y").alias("v"), "cluster"), ["ax", "ay"])
    edge = edge.where(_near(F.col("x"), F.col("y"), F.col("u"), F.col("v"), eps)).groupBy("x", "y").agg(F.min("cluster").alias("cluster"), F.lit(False).alias("core"))
    named = core.select("x", "y", "cluster", F.lit(True).alias("core")).unionByName(edge)
    got = rows.where(known).join(named, ["x", "y"], "left").select("key", F.coalesce("core", F.lit(False)).alias("core"), "cluster")
    none = rows.where(~known).select("key", F.lit(False).alias("core"), F.lit(None).cast(got.schema["cluster"].dataType).alias("cluster"))
    return got.unionByName(none).withColumnRenamed("key", key)


def signed_pairs(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> float:
    """The sum of n_i n_j sign(y_j - y_i) over pairs with x_i < x_j. x must ascend. Halves are split between two values of x and
    meet by sorted search, so time is in proportion to size times the square of its logarithm."""
    cuts = np.flatnonzero(x[1:] != x[:-1]) + 1 if len(x) else x
    if not len(cuts):
        return 0.0
    at = int(cuts[np.argmin(np.abs(cuts - len(x) // 2))])
    order = np.argsort(y[:at], kind="stable")
    low, sums = y[:at][order], np.concatenate([[0.0], np.cumsum(n[:at][order].astype(float))])
    less, upto = sums[np.searchsorted(low, y[at:], "left")], sums[np.searchsorted(low, y[at:], "right")]
    cross = float(((less - (sums[-1] - upto)) * n[at:]).sum())
    return cross + signed_pairs(x[:at], y[:at], n[:at]) + signed_pairs(x[at:], y[at:], n[at:])


def kendall(df: DataFrame, x: str, y: str, blocks: int | None = None) -> DataFrame:
    """One row: tau, the share of concordant less discordant pairs among all pairs of rows without nulls (null for fewer than 2).

    Rows are counted by cell (x, y); x and y are each dealt into blocks of like weight, by a running total over their values.
    Pairs in one block of x are counted there, pairs of two blocks of x but one of y in that block of y, and all others from
    the table of blocks, of at most 2,000 a side. A value that outweighs a block is a block of its own, which has no pairs."""
    from .relational import running_total

    ship(df.sparkSession)
    cells = df.where(f"`{x}` is not null and `{y}` is not null").groupBy(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).agg(F.count("*").alias("n"))
    cells = checkpointed(cells)
    count, rows = cells.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if rows < 2:
        return df.sparkSession.createDataFrame([(None,)], "tau double")
    blocks = blocks or int(min(2_000, max(8, count // 100_000)))

    def dealt(c: str) -> DataFrame:
        by = running_total(cells.groupBy(c).agg(F.count("*").alias("k")), c, ["k"])
        heavy = F.col("k") * blocks > count
        return by.select(c, (2 * F.floor((F.col("upto_k") - F.col("k")) * blocks / count) + heavy.cast("long")).alias(f"b{c}"))

    cells = checkpointed(cells.join(dealt("x"), "x").join(dealt("y"), "y"))

    def within(by: str, across: str):
        def run(group):
            group = group.sort_values(across, kind="stable")
            import pandas as pd

            return pd.DataFrame({"s": [signed_pairs(group[across].to_numpy(), group["y"].to_numpy(), group["n"].to_numpy())]})

        mixed = cells.groupBy(by).agg(F.min(across).alias("lo"), F.max(across).alias("hi")).where("lo < hi").select(by)
        return cells.join(mixed, by).select(by, *dict.fromkeys([across, "y", "n"])).groupBy(by).applyInPandas(run, "s double")

    near = within("bx", "x").unionByName(within("by", "bx")).agg(F.coalesce(F.sum("s"), F.lit(0.0))).first()[0]
    table = cells.groupBy("bx", "by").agg(F.sum("n").alias("n")).toPandas()  # at most the square of blocks
    far = 0.0
    if len(table):
        a, b = (np.unique(table[c], return_inverse=True)[1] for c in ("bx", "by"))
        grid = np.zeros((a.max() + 1, b.max() + 1))
        grid[a, b] = table["n"]
        before = np.vstack([np.zeros(grid.shape[1]), grid.cumsum(axis=0)[:-1]])  # weight of earlier blocks of x, by block of y
        less = np.hstack([np.zeros((len(grid), 1)), before.cumsum(axis=1)[:, :-1]])
        far = float((grid * (less - (before.sum(axis=1, keepdims=True) - less - before))).sum())
    return df.sparkSession.createDataFrame([(2 * (near + far) / (rows * (rows - 1.0)),)], "tau double")
