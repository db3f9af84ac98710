"""Queries of recursion, stateful streams, logs, near duplicates, clusters, communities, spectra, trees, budgets and laws."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import laws as X
from ..operators import graph as G
from ..operators import models as P
from ..operators import neighbours as N
from ..operators import privacy as Q
from ..sources import files as D
from ..sources import log as L
from ..sources.sinks import checkpointed
from ..streaming import events as E
from ..streaming import state as Z
from .catalogue import query

# --- recursion ------------------------------------------------------------------------------------------------------

_NEXT = """f as (select user_id as src, lead(user_id) over (order by ts, event_id) as dst from events), g as (select src, dst, count(*) as n from f where dst is not null and src <> dst group by all),
 e as (select src, dst from (select *, row_number() over (partition by src order by n desc, dst) as r from g) where r = 1)"""


def _followers(t):
    """Each user's edge to the user whose events follow theirs most often: one edge a user, so there are cycles."""
    minute = t.events.select("user_id", "ts", "event_id")
    # neighbours in time without a global window: days are numbered, and only a day's first event looks back across
    day = F.to_date("ts")
    w = W.partitionBy("day").orderBy("ts", "event_id")
    x = minute.withColumn("day", day).withColumn("dst", F.lead("user_id").over(w))
    ends = x.groupBy("day").agg(F.min_by("user_id", F.struct("ts", "event_id")).alias("first"))
    turns = ends.withColumn("dst_", F.lead("first").over(W.orderBy("day")))  # a row a day
    last = x.where("dst is null").join(turns.select("day", "dst_"), "day").select(F.col("user_id").alias("src"), F.col("dst_").alias("dst"))
    pairs = x.where("dst is not null").select(F.col("user_id").alias("src"), "dst").unionByName(last).where("dst is not null and src <> dst")
    n = pairs.groupBy("src", "dst").agg(F.count("*").alias("n"))
    return n.groupBy("src").agg(F.max_by("dst", F.struct("n", -F.col("dst"))).alias("dst"))


@query(f"""with recursive {_NEXT}, walk as (select src, dst as n, 1 as hops, [src, dst] as path from e union all select w.src, e.dst, hops + 1, list_append(path, e.dst) from walk w join e on e.src = w.n where hops < 6 and not list_contains(path, e.dst))
 select src, n, min(hops)::int as hops from walk group by src, n""")
def followers_closure(t):
    """Whom a user's followers lead to within six steps, by a recursive plan."""
    return G.reached(_followers(t), 6)


# --- streams --------------------------------------------------------------------------------------------------------


@query("""with g as (select *, case when ts - lag(ts) over w <= interval '6 hours' then 0 else 1 end as new from events window w as (partition by user_id order by ts, event_id)),
 s as (select *, sum(new) over (partition by user_id order by ts, event_id) as session from g)
 select user_id, event_id, row_number() over w::bigint as n, round(sum(value) over w, 4) as total from s window w as (partition by user_id, session order by ts, event_id rows unbounded preceding)""")
def running_session_features(t):
    """What a user's session holds up to each event, by keyed state with timers over a stream of files in order of time."""
    path = D.scratch(t.spark, "ordered")
    t.events.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(path)
    days = t.events.agg(F.max("ts") - F.min("ts")).first()[0].days + 1  # files may come in any order: no row is late
    out = Z.drain_state(Z.running_sessions(E.event_stream(t.spark, path, 1_000), 6 * 3600, f"{days} days"))
    return out.select("user_id", "event_id", "n", F.round("total", 4).alias("total"))


@query("""with b as (select *, event_id % 3 as b from events), m as (select a.b, max(c.ts) as newest from (select distinct b from b) a left join b c on c.b < a.b group by a.b)
 select case when ts < newest - interval '5 days' then 'late' else 'on time' end as kind, event_type, count(*)::bigint as n from b join m using (b) group by all""")
def late_rows_of_a_stream(t):
    """Rows behind the watermark of their own micro-batch, kept apart; three files make three batches."""
    path = D.scratch(t.spark, "batches")
    for k in range(3):
        t.events.where(F.col("event_id") % 3 == k).coalesce(1).write.mode("append").parquet(path)
    on, late = Z.split_late(E.event_stream(t.spark, path, 1), "5 days", D.scratch(t.spark, "split"), D.scratch(t.spark, "state"))
    x = on.select(F.lit("on time").alias("kind"), "event_type").unionByName(late.select(F.lit("late").alias("kind"), "event_type"))
    return x.groupBy("kind", "event_type").agg(F.count("*").alias("n"))


@query("""select event_type, count(*)::bigint as n, round(sum(value), 4) as total, count(distinct user_id)::bigint as users, true as one_partition_a_user from events group by 1""")
def replayed_log(t):
    """A partitioned log appended twice, read by a stream that stops after each segment, and read again from the start."""
    path, out, state = D.scratch(t.spark, "log"), D.scratch(t.spark, "drained"), D.scratch(t.spark, "state")
    fields = t.events.schema
    for k in range(2):
        L.append(t.events.where(F.col("event_id") % 2 == k), path, "user_id", ["ts", "event_id"], 4)
        E.drain(L.log_stream(t.spark, path, fields, most=1), path=out, checkpoint=state)
    again = E.drain(L.log_stream(t.spark, path, fields))
    users = again.groupBy("event_type", "user_id").agg(F.count_distinct("log_partition").alias("p")).groupBy("event_type").agg(F.count("*").alias("users"), (F.max("p") == 1).alias("one_partition_a_user"))
    first = t.spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return first.join(users, "event_type")


# --- near duplicates, clusters, communities -------------------------------------------------------------------------


@query(r"""with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
 s as (select distinct doc_id, unnest(case when len(w) < 5 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) end) as k from d where len(w) > 0),
 n as (select doc_id, count(*) as n from s group by 1), o as (select a.doc_id as x, b.doc_id as y, count(*) as i from s a join s b using (k) where a.doc_id <> b.doc_id group by all),
 e as (select x, y from o join n p on p.doc_id = x join n q on q.doc_id = y where 100 * i >= 75 * (p.n + q.n - i)),
 r as (select doc_id as x, doc_id as y from documents union select r.x, e.y from r join e on e.x = r.y)
 select doc_id, coalesce(any_value(n.n), 0)::bigint as n_shingles, min(r.y) as component from d left join n using (doc_id) join r on r.x = d.doc_id group by doc_id""")
def minhash_components(t):
    """Components of texts of like shingles, by banded MinHash signatures and exact verification."""
    return N.minhash_components(t.documents.select("doc_id", "text"))


@query()
def density_clusters(t):
    """Parts by price and size in density clusters. Checked against brute force in tests."""
    x = t.part.select("p_partkey", (F.col("p_retailprice") / 10).alias("x"), F.col("p_size").cast("double").alias("y"))
    return N.dbscan(x, "p_partkey", "x", "y", 1.0, 4)


@query()
def divided_clusters(t):
    """Customers in clusters that were divided in two again and again. Checked in tests."""
    return P.divided(t.customer, ["c_acctbal", "c_nationkey"], 6).groupBy("cluster").agg(F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 2).alias("mean"))


_SUPPLY = "g as (select l_partkey * 2 as src, l_suppkey * 2 + 1 as dst, sum(l_quantity) as weight from lineitem group by all), b as (select src, dst, weight from g union all select dst, src, weight from g), l0 as (select distinct src as n, src as community from b)"
_ROUND = """u{k} as (select src as n, arg_max(community, (w, -community)) as new from (select src, community, sum(weight) as w from b join l{j} on l{j}.n = dst where src % 2 = {j} % 2 group by all) group by src),
 l{k} as (select l{j}.n, coalesce(new, community) as community from l{j} left join u{k} on u{k}.n = l{j}.n)"""


def _supply(t):
    """Edges of parts and suppliers by quantity, a row a line: who takes them sums them."""
    return t.lineitem.select((F.col("l_partkey") * 2).alias("src"), (F.col("l_suppkey") * 2 + 1).alias("dst"), F.col("l_quantity").alias("weight"))


@query(f"with {_SUPPLY}, {', '.join(_ROUND.format(k=k, j=k - 1) for k in range(1, 5))} select n, community from l4")
def supply_communities(t):
    """Parts and suppliers by the labels that four rounds of propagation give them."""
    return G.communities(_supply(t), 4)


@query(f"""with {_SUPPLY}, {', '.join(_ROUND.format(k=k, j=k - 1) for k in range(1, 5))}, p as (select x.community as a, coalesce(sum(weight) filter (x.community = y.community), 0) as inside, sum(weight) as ends from b join l4 x on x.n = src join l4 y on y.n = dst group by 1)
 select round(sum(inside) / sum(ends) - sum(ends * ends) / (sum(ends) * sum(ends)), 8) as modularity, count(*)::bigint as communities from p""")
def community_modularity(t):
    """How much of the weight lies inside communities, beyond what chance would put there."""
    edges = G.undirected(_supply(t))
    label = G.communities(edges, 4, summed=True)
    return G.modularity(edges, label).select(F.round("modularity", 8).alias("modularity")).crossJoin(label.agg(F.count_distinct("community").alias("communities")))


# --- spectra, trees, budgets, laws ----------------------------------------------------------------------------------


@query()
def term_spectrum(t):
    """The largest singular values of documents by hashed words. Checked against a dense decomposition in tests."""
    rows = checkpointed(P.term_rows(t.documents.select("doc_id", "text"), 512))
    values, _ = P.singular_values(rows, 512, 5)
    return t.spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(values)], "component int, value double")


@query()
def tree_grid_scores(t):
    """Out-of-fold scores of decision trees for labelled quality at every point of a grid. Checked in tests."""
    words = F.size(F.split("text", r"\s+"))
    x = t.documents.select("doc_id", F.length("text").alias("size"), F.size(F.split("text", "\n")).alias("n_lines"), words.alias("n_words"), F.regexp_count("text", F.lit("[#*$%&|<>!]")).alias("n_signs"))
    return P.tree_grid(x.join(t.labels, "doc_id"), ["size", "n_lines", "n_words", "n_signs"], "quality", "doc_id", 4, [2, 5], [1, 10])


@query()
def budgeted_counts(t):
    """Private counts by type of event, five rows a user at most, under a ledger. Checked in tests."""
    ledger = Q.Ledger(t.spark, D.scratch(t.spark, "ledger"), 1.0)
    keys = t.events.select("event_type").distinct()
    a = Q.private_counts(t.events, "event_type", "user_id", 5, 0.6, ledger, keys, "first", "stated for reruns").select("event_type", F.col("n").alias("first"))
    b = Q.private_counts(t.events, "event_type", "user_id", 5, 0.4, ledger, keys, "second", "stated for reruns").select("event_type", F.col("n").alias("second"))
    return a.join(b, "event_type")


#: Simpson's rule over a density f(x), from lo to hi in 2,000 steps, as a DuckDB expression.
_SIMPSON = "((({hi}) - ({lo})) / 6000 * list_sum(list_transform(range(0, 2001), lambda i: (case when i in (0, 2000) then 1 when i % 2 = 1 then 4 else 2 end) * {f})))"


def _integral(f: str, lo: str, hi: str) -> str:
    return _SIMPSON.format(lo=lo, hi=hi, f=f.replace("@", f"(({lo}) + i * (({hi}) - ({lo})) / 2000)"))


@query(f"""with s as (select n_nationkey as k, count(*)::double as n, avg(c_acctbal) as m, stddev_samp(c_acctbal) as d from customer join nation on c_nationkey = n_nationkey group by 1), x as (select k, n, (m - 4500) / (d / sqrt(n)) as t from s where n > 2 and d > 0)
 select k, round(t, 6) as t, round(2 * (0.5 - {_integral("exp(-(@) * (@) / 2) / sqrt(2 * pi())", "0", "abs(t)")}), 7) as p_normal,
  round(2 * (0.5 - {_integral("exp(lgamma(n / 2) - lgamma((n - 1) / 2)) / sqrt((n - 1) * pi()) * pow(1 + (@) * (@) / (n - 1), -n / 2)", "0", "abs(t)")}), 7) as p_student from x""")
def mean_balance_p(t):
    """Whether a nation's mean balance is other than 4,500: p-values by the normal law and by Student's."""
    s = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").cast("double").alias("n"), F.avg("c_acctbal").alias("m"), F.stddev_samp("c_acctbal").alias("d")).where("n > 2 and d > 0")
    x = s.select("k", "n", ((F.col("m") - 4500) / (F.col("d") / F.sqrt("n"))).alias("t"))
    return x.select("k", F.round("t", 6).alias("t"), F.round(X.two_sided(X.normal_cdf(F.col("t"))), 7).alias("p_normal"), F.round(X.two_sided(X.t_cdf(F.col("t"), F.col("n") - 1)), 7).alias("p_student"))


@query(f"""with c as (select c_nationkey as k, count(distinct c_mktsegment) as kinds, count(*) as n from customer group by 1), o as (select c_nationkey as k, c_mktsegment as s, count(*)::double as o from customer group by all),
 x as (select k, any_value(kinds)::double - 1 as df, sum((o - n / kinds) ** 2 / (n / kinds)) as chi2 from o join c using (k) group by k)
 select k, round(chi2, 6) as chi2, round(1 - {_integral("2 * pow(@, df - 1) * exp(-(@) * (@) / 2 - lgamma(df / 2)) / pow(2, df / 2)", "0", "sqrt(chi2)")}, 6) as p from x where df > 2""")
def even_segments_p(t):
    """Whether a nation's customers are spread evenly over segments: Pearson's statistic and its p-value."""
    n = t.customer.groupBy(F.col("c_nationkey").alias("k"), "c_mktsegment").agg(F.count("*").cast("double").alias("o"))
    x = n.groupBy("k").agg((F.count("*") - 1).cast("double").alias("df"), (F.sum(F.col("o") * F.col("o")) * F.count("*") / F.sum("o") - F.sum("o")).alias("chi2"))
    return x.where("df > 2").select("k", F.round("chi2", 6).alias("chi2"), F.round(1 - X.chi_square_cdf(F.col("chi2"), F.col("df")), 6).alias("p"))


@query("""with s as (select l_suppkey as k, count(*) as n, count(*) filter (l_returnflag = 'R') as r from lineitem group by 1), p as (select sum(r) / sum(n) as p from s)
 select k, n::bigint as n, r::bigint as returned, round(list_sum(list_transform(range(0, r + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(p) + (n - i) * ln(1 - p)))), 8) as at_most,
  round(list_sum(list_transform(range(0, r + 1), lambda i: exp(-n * p + i * ln(n * p) - lgamma(i + 1)))), 8) as at_most_rare from s, p""")
def supplier_returns_p(t):
    """How likely a supplier has so few returns, if all had the same share: by the binomial law and by Poisson's."""
    s = t.lineitem.groupBy(F.col("l_suppkey").alias("k")).agg(F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("returned"))
    p = s.agg((F.sum("returned") / F.sum("n")).alias("p"))  # a row
    at = F.col("returned").cast("double"), F.col("n").cast("double")
    return s.crossJoin(F.broadcast(p)).select("k", "n", "returned", F.round(X.binomial_cdf(*at, F.col("p")), 8).alias("at_most"), F.round(X.poisson_cdf(at[0], at[1] * F.col("p")), 8).alias("at_most_rare"))


@query()
def kendall_tau_of_prices(t):
    """Kendall's tau of two columns of many values. Checked against all pairs in tests."""
    return N.kendall(t.lineitem, "l_quantity", "l_extendedprice")
