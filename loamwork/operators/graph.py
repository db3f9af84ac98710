"""Graphs as edge tables (src, dst): degrees and PageRank by joins and grouped sums."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import checkpointed


def degrees(edges: DataFrame) -> DataFrame:
    """n, out_degree, in_degree of each node of edges; one grouped count over both ends."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("src").alias("n"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("dst").alias("n"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("e"))
    return ends.select("e.*").groupBy("n").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))


def pagerank(edges: DataFrame, rounds: int = 10, damping: float = 0.85) -> DataFrame:
    """n, rank (ranks sum to 1) after so many rounds; what nodes without successors hold is shared by all.

    Every round is one join on src and one grouped sum with partial sums; its result is written to shared storage, so that
    lineage does not grow and a lost executor costs no earlier round. Repeated edges count each; no edges give no rows."""
    edges = checkpointed(edges.join(edges.groupBy("src").agg(F.count("*").alias("k")), "src"))
    nodes = checkpointed(degrees(edges).select("n", (F.col("out_degree") == 0).alias("sink")))
    count = nodes.count()
    ranks = nodes.select("n", "sink", F.lit(1.0 / max(count, 1)).alias("rank"))
    for _ in range(rounds):
        lost = ranks.where("sink").agg(F.sum("rank")).first()[0] or 0.0
        got = ranks.join(edges, F.col("n") == F.col("src")).groupBy(F.col("dst").alias("__n")).agg(F.sum(F.col("rank") / F.col("k")).alias("got"))
        new = F.lit((1 - damping) / max(count, 1)) + damping * (F.coalesce("got", F.lit(0.0)) + F.lit(lost / max(count, 1)))
        ranks = checkpointed(nodes.join(got, F.col("n") == F.col("__n"), "left").select("n", "sink", new.alias("rank")))
    return ranks.select("n", "rank")


def hops(edges: DataFrame, starts: DataFrame, most: int) -> DataFrame:
    """n, hops: the least number of edges (src, dst) from a start (n) to each node that `most` hops or fewer reach.

    Each round joins only the nodes that the round before was the first to reach; cycles end by themselves."""
    seen = checkpointed(starts.select("n").distinct().withColumn("hops", F.lit(0)))
    front = seen
    for k in range(1, most + 1):
        new = front.join(edges, F.col("n") == F.col("src")).select(F.col("dst").alias("n")).distinct().join(seen.select("n"), "n", "left_anti")
        front = checkpointed(new.withColumn("hops", F.lit(k)))
        if front.isEmpty():
            break
        seen = checkpointed(seen.unionByName(front))
    return seen


def connected(edges: DataFrame) -> DataFrame:
    """n, component: the least node that n is joined to by edges, whichever way they point.

    Labels spread to neighbours and then jump to their label's label, until a round changes nothing; each round is a
    grouped minimum and two joins on written tables."""
    both = checkpointed(edges.select("src", "dst").union(edges.select(F.col("dst"), F.col("src"))).distinct())
    label = checkpointed(both.groupBy(F.col("src").alias("n")).agg(F.least(F.min("dst"), F.col("src")).alias("component")))
    while True:
        near = both.join(label.select(F.col("n").alias("dst"), "component"), "dst").groupBy(F.col("src").alias("n")).agg(F.min("component").alias("m"))
        step = label.join(near, "n").select("n", F.least("component", "m").alias("c"), F.col("component").alias("old"))
        jump = label.select(F.col("n").alias("c"), F.col("component").alias("j"))
        new = checkpointed(step.join(jump, "c", "left").select("n", F.least("c", F.coalesce("j", "c")).alias("component"), "old"))
        if new.where("component <> old").isEmpty():
            return new.select("n", "component")
        label = new.select("n", "component")


def reached(edges: DataFrame, depth: int) -> DataFrame:
    """src, n, hops: what each source reaches in 1 to `depth` steps and in how few, by one recursive plan; a path never comes
    back to a node that it has, so cycles end. Paths are kept one by one: for graphs of many paths take hops(), which keeps
    nodes. Repeated edges count once; nulls lead nowhere."""
    edges.where("src is not null and dst is not null").select("src", "dst").distinct().createOrReplaceTempView("loamwork_edges")
    return edges.sparkSession.sql(f"""
        with recursive walk(src, n, hops, path) max recursion level {depth + 1} as (
          select src, dst, 1, array(src, dst) from loamwork_edges where src <> dst
          union all
          select w.src, e.dst, w.hops + 1, array_append(w.path, e.dst) from walk w join loamwork_edges e on e.src = w.n where w.hops < {depth} and not array_contains(w.path, e.dst))
        select src, n, min(hops) as hops from walk group by src, n""")


def undirected(edges: DataFrame) -> DataFrame:
    """src, dst, weight: one row for each pair of joined nodes, src the lesser, weights summed; no edges from a node to itself."""
    x = edges.where("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), "weight")
    return checkpointed(x.groupBy("src", "dst").agg(F.sum("weight").alias("weight")))


def communities(edges: DataFrame, rounds: int = 5, summed: bool = False) -> DataFrame:
    """n, community: labels that spread for so many rounds. edges: src, dst (whole numbers), weight, whichever way they point;
    summed: they come from undirected().

    Nodes of even and of odd numbers take turns (all at once would swap labels to and fro where the graph has two sides): a
    node takes the label that weighs most among its neighbours, of equals the least. A label's weights are summed by partial
    sums before one row a (node, label) is compared, so a node of many edges is not sorted; each round is written to shared
    storage. Edges from a node to itself don't count."""
    once = edges if summed else undirected(edges)
    both = once.select("src", "dst", "weight").union(once.select("dst", "src", "weight"))
    label = both.select(F.col("src").alias("n"), F.col("src").alias("community")).distinct()
    for k in range(rounds):
        near = both.where(F.pmod("src", F.lit(2)) == k % 2).join(label.select(F.col("n").alias("dst"), "community"), "dst").groupBy("src", "community").agg(F.sum("weight").alias("w"))
        best = F.max_by("community", F.struct("w", -F.col("community")))
        new = near.groupBy(F.col("src").alias("n")).agg(best.alias("new"))
        label = checkpointed(label.join(new, "n", "left").select("n", F.coalesce("new", "community").alias("community")))
    return label


def modularity(edges: DataFrame, label: DataFrame) -> DataFrame:
    """One row: modularity of communities (n, community) over edges (src, dst, weight), whichever way they point.

    An edge meets the labels once and then counts for both of its ends."""
    own = edges.where("src <> dst").join(label.select(F.col("n").alias("src"), F.col("community").alias("a")), "src").join(label.select(F.col("n").alias("dst"), F.col("community").alias("b")), "dst")
    inside = F.when(F.col("a") == F.col("b"), F.col("weight")).otherwise(0)
    ends = own.select(F.explode(F.array("a", "b")).alias("a"), inside.alias("inside"), "weight")
    parts = ends.groupBy("a").agg(F.sum("inside").alias("inside"), F.sum("weight").alias("ends"))
    all_ = F.sum("ends")
    return parts.agg((F.sum("inside") / all_ - F.sum(F.col("ends") * F.col("ends")) / (all_ * all_)).alias("modularity"))
