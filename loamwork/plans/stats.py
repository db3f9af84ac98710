"""Queries of joins by validity and card, sets, samples, measures, streams, models and graphs."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as T
from ..operators import corpus as C
from ..operators import graph as G
from ..operators import measures as M
from ..operators import models as P
from ..operators import relational as R
from ..operators import rewrite as V
from ..operators import structure as S
from ..sources import files as D
from ..streaming import events as E
from .catalogue import _LINES, query
from .more import _trade

# --- filters and projections ----------------------------------------------------------------------------------------


@query("select round(avg(o_totalprice), 4) as mean_price, count(*)::bigint as n from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'O'")
def masked_mean(t):
    x = t.orders.where("o_orderpriority = '1-URGENT' and o_orderstatus = 'O'")
    return x.agg(F.round(F.avg("o_totalprice"), 4).alias("mean_price"), F.count("*").alias("n"))


_HOLES = "select event_id, nullif(value, value * (event_id % 5 = 0)::int) as value, case when event_id % 7 <> 0 then event_type end as event_type from events"


def _holes(t):
    """Events of which every fifth lacks its value and every seventh its type."""
    return t.events.select("event_id", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"), F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("event_type"))


@query("""select 'any' as how, count(*)::bigint as n from events where event_id % 5 <> 0 and event_id % 7 <> 0 union all select 'subset', count(*)::bigint from events where event_id % 7 <> 0 union all select 'all', count(*)::bigint from events where event_id % 5 <> 0 or event_id % 7 <> 0""")
def dropped_nulls(t):
    x = _holes(t)
    ways = [("any", x.na.drop("any")), ("subset", x.na.drop("any", subset=["event_type"])), ("all", x.na.drop("all", subset=["value", "event_type"]))]
    out = [d.agg(F.count("*").alias("n")).select(F.lit(how).alias("how"), "n") for how, d in ways]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("""select count(*)::bigint as n, 0::bigint as event_id_missing, count(*) filter (event_id % 5 = 0)::bigint as value_missing, count(*) filter (event_id % 7 = 0)::bigint as event_type_missing from events""")
def missing_by_column(t):
    """Nulls of every column in one pass; NaN is a value."""
    x = _holes(t)
    return x.agg(F.count("*").alias("n"), *(F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in x.columns))


@query("select c_nationkey, c_mktsegment, c_acctbal from customer")
def without_identifiers(t):
    return t.customer.drop("c_custkey", "c_name")


# --- joins ----------------------------------------------------------------------------------------------------------

_CARDS = """c as (select s_suppkey, case s_suppkey % 5 when 0 then '| Code | X |' else '| Code | N' || s_nationkey || ' |' end as code_row, case when s_suppkey % 7 = 3 then '' else '| Source | see ' || case when s_suppkey % 3 = 0 then 'Nowhere' else n_name end || ' pages |' end as source_row from supplier join nation on n_nationkey = s_nationkey)"""


@query(rf"""with {_CARDS}, k as (select *, regexp_extract(code_row, '\| Code \| (N[0-9]+) \|', 1) as code, regexp_extract(source_row, '\| Source \|(.+)\|', 1) as source from c),
 j as (select k.*, n_name as expected from k left join nation on 'N' || n_nationkey = k.code)
 select case when source = '' then 'no source' when expected is null then 'unknown code' when not contains(source, expected) then 'mismatch' else 'ok' end as status, count(*)::bigint as n, min(s_suppkey) as first_card from j group by 1""")
def card_sources(t):
    """Cards (here made of suppliers) whose source row must name what a page map (here nations) has for their code."""
    nation = t.nation.select("n_nationkey", "n_name")
    name = F.when(F.col("s_suppkey") % 3 == 0, "Nowhere").otherwise(F.col("n_name"))
    cards = t.supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey",
        F.concat_ws(
            "\n",
            F.when(F.col("s_suppkey") % 5 == 0, "| Code | X |").otherwise(F.concat(F.lit("| Code | N"), "s_nationkey", F.lit(" |"))),
            F.when(F.col("s_suppkey") % 7 != 3, F.concat(F.lit("| Source | see "), name, F.lit(" pages |"))),
        ).alias("card"),
    )
    pages = nation.select(F.concat(F.lit("N"), "n_nationkey").alias("code"), F.col("n_name").alias("expected"))
    return C.checked_cards(cards, pages, "card", r"\| Code \| (N[0-9]+) \|", r"\| Source \|(.+)\|").groupBy("status").agg(F.count("*").alias("n"), F.min("s_suppkey").alias("first_card"))


@query("""with f as (select doc_id, source, len(regexp_extract_all(text, '[0-9]{4,}')) as n, text from documents), r as (select * from f where n > 0)
 select case when source = 'src0' and regexp_matches(text, 'Licensed') then 'licence text' when regexp_matches(text, '[0-9]{8,}') then 'long number' end as allowed, count(*)::bigint as n from r group by 1""")
def context_allowed(t):
    """Findings that a rule allows by source and by a pattern of their surroundings; the first rule in order counts."""
    found = t.documents.where(F.col("text").rlike("[0-9]{4,}")).select("doc_id", "source", F.lit("long_number").alias("check"), F.lit("warn").alias("severity"), F.lit("digits").alias("found"), F.col("text").alias("context"))
    rules = [("long_number", "src0", "*", "Licensed", "licence text"), ("*", "*", "digits", "[0-9]{8,}", "long number"), ("mail", "*", "*", "", "never")]
    return C.allowed_by(found, rules).groupBy("allowed").agg(F.count("*").alias("n"))


@query("""select c_mktsegment, count(*)::bigint as n, round(sum(o_totalprice), 2) as total from orders join customer on o_custkey = c_custkey group by 1""")
def bucketed_join(t):
    """Two tables bucketed and sorted by their key, and joined without an exchange of either."""
    return R.bucketed_join(t.orders.select("o_custkey", "o_totalprice"), "o_custkey", t.customer.select("c_custkey", "c_mktsegment"), "c_custkey", 4).groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""with v as (select user_id, ts as valid_from, lead(ts) over (partition by user_id order by ts, event_id) as valid_to, value from events where event_type = 'view'), e as (select event_id, user_id, ts from events where event_type = 'purchase')
 select e.event_id, v.value from e left join v on v.user_id = e.user_id and e.ts >= v.valid_from and (e.ts < v.valid_to or v.valid_to is null) and v.valid_from is distinct from v.valid_to""")
def valid_at(t):
    """A slowly changing value as it was at a purchase: half-open periods, the last one open."""
    views = R.with_recent(t.events.where("event_type = 'view'").select("user_id", "ts", "event_id", "value"), "user_id", ["ts", "event_id"], "ts", 1, "next", ahead=True)
    v = views.select("user_id", F.col("ts").alias("valid_from"), F.get("next", F.lit(0)).alias("valid_to"), "value")
    return R.scd_join(t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), v, "user_id", "ts").select("event_id", "value")


_EDGES = "e as (select distinct n_nationkey as src, (n_nationkey * 7 + n_regionkey + 3) % 25 as dst from nation)"


def _ring(t):
    return t.nation.select(F.col("n_nationkey").alias("src"), ((F.col("n_nationkey") * 7 + F.col("n_regionkey") + 3) % 25).alias("dst")).distinct()


@query(f"""with recursive {_EDGES}, r as (select 1 as n, 0 as d union select e.dst, r.d + 1 from r join e on e.src = r.n where r.d < 12) select n::int as n, min(d)::int as hops from r group by 1""")
def shortest_hops(t):
    """Hops from one node to all that it reaches, over edges that form cycles."""
    return G.hops(_ring(t), t.spark.range(1).select(F.lit(1).alias("n")), 12)


@query(f"""with recursive {_EDGES}, u as (select src as a, dst as b from e union select dst, src from e), r as (select distinct a as n, a as m from u union select r.n, u.b from r join u on u.a = r.m) select n::int as n, min(m)::int as component from r group by 1""")
def connected_nations(t):
    return G.connected(_ring(t))


_PR = "with e as (select distinct c_nationkey as src, s_nationkey as dst from orders join lineitem on l_orderkey = o_orderkey join customer on c_custkey = o_custkey join supplier on s_suppkey = l_suppkey where c_nationkey <> s_nationkey), k as (select src, dst, count(*) over (partition by src) as k from e), v as (select distinct n, n in (select src from e) as open from (select src as n from e union select dst from e)), r0 as (select n, open, 1.0::double / (select count(*) from v) as rank from v)"
for _i in range(10):
    _PR += f", r{_i + 1} as (select v.n, v.open, 0.15 / (select count(*) from v) + 0.85 * (coalesce(g.got, 0) + coalesce((select sum(rank) from r{_i} where not open), 0) / (select count(*) from v)) as rank from v left join (select dst, sum(rank / k) as got from r{_i} join k on src = n group by 1) g on g.dst = v.n)"


@query(_PR + " select n, round(rank, 8) as rank from r10")
def pagerank(t):
    """Ten rounds of PageRank over nations that trade."""
    return G.pagerank(_trade(t), rounds=10).select("n", F.round("rank", 8).alias("rank"))


# --- sets, sorts, samples -------------------------------------------------------------------------------------------


@query("""select c_nationkey as k from customer where c_acctbal < 0 union select s_nationkey from supplier""")
def distinct_union(t):
    return t.customer.where("c_acctbal < 0").select(F.col("c_nationkey").alias("k")).unionByName(t.supplier.select(F.col("s_nationkey").alias("k"))).distinct()


@query("""with a as (select c_nationkey as k, count(*) as n from customer where c_custkey % 2 = 0 group by 1), b as (select c_nationkey as k, count(*) as n from customer where c_custkey % 2 = 1 group by 1), j as (select coalesce(a.k, b.k) as k, coalesce(a.n, 0) - coalesce(b.n, 0) as d from a full join b using (k))
 select k, case when d > 0 then 'left' else 'right' end as more_in, abs(d)::bigint as n from j where d <> 0""")
def multiset_both_ways(t):
    a, b = (t.customer.where(f"c_custkey % 2 = {i}").select(F.col("c_nationkey").alias("k")) for i in (0, 1))
    one = a.exceptAll(b).groupBy("k").agg(F.count("*").alias("n")).withColumn("more_in", F.lit("left"))
    return one.unionByName(b.exceptAll(a).groupBy("k").agg(F.count("*").alias("n")).withColumn("more_in", F.lit("right"))).select("k", "more_in", "n")


@query("select count(*)::bigint as n, min(doc_id) as first_doc, sum(doc_id)::bigint as total from (select min(doc_id) as doc_id from documents group by text having count(*) = 1)")
def dedup_keep_none(t):
    """Documents whose text no other has: all of a repeated text go."""
    x = t.documents.select("doc_id", F.xxhash64("text").alias("h")).groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")).where("n = 1")
    return x.agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"), F.sum("doc_id").alias("total"))


@query("select event_type, count(*)::bigint as n, round(sum(value), 4) as total from events group by 1")
def split_hot_union(t):
    """The hottest key summed apart, in parts, and put back by a union."""
    hot = t.events.groupBy("event_type").count().orderBy(F.desc("count"), "event_type").limit(1).select(F.col("event_type").alias("h"))
    x = t.events.join(F.broadcast(hot), F.col("event_type") == F.col("h"), "left")
    rest = x.where("h is null").groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    parts = R.salted_sum(x.where("h is not null"), "event_type", "value", "event_id")
    return rest.unionByName(parts).select("event_type", "n", F.round("total", 4).alias("total"))


@query("select p_type, string_agg(p_partkey::varchar, ',' order by p_retailprice desc, p_partkey) as first_eight, max(substr(p_name, 1, 9)) as head from (select *, row_number() over (partition by p_type order by p_retailprice desc, p_partkey) as r from part) where r <= 8 group by 1 order by p_type")
def previews(t):
    """The first eight keys of each type, as a slice of a bounded ranking, in order of the type."""
    r = F.row_number().over(W.partitionBy("p_type").orderBy(F.desc("p_retailprice"), "p_partkey"))
    x = t.part.withColumn("r", r).where("r <= 8").groupBy("p_type").agg(F.sort_array(F.collect_list(F.struct("r", "p_partkey"))).alias("a"), F.max(F.substring("p_name", 1, 9)).alias("head"))
    return x.select("p_type", F.array_join(F.transform("a", lambda v: v["p_partkey"].cast("string")), ",").alias("first_eight"), "head").orderBy("p_type")


@query("""select label, place, min(page)::bigint as page from (values (1, 'mail', '@'), (2, 'number', '[0-9]{4,}'), (3, 'licence', 'Licensed')) as l(place, label, p), (select doc_id as page, text from documents where doc_id < 300) d where false group by 1, 2
 union all select 'mail', 1, (select min(doc_id) from documents where regexp_matches(text, '@'))
 union all select 'number', 2, (select min(doc_id) from documents where regexp_matches(text, '[0-9]{4,}') and doc_id is distinct from (select min(doc_id) from documents where regexp_matches(text, '@')))
 union all select 'licence', 3, (select min(doc_id) from documents where contains(text, 'Licensed under') and doc_id is distinct from (select min(doc_id) from documents where regexp_matches(text, '@')) and doc_id is distinct from (select min(doc_id) from documents where regexp_matches(text, '[0-9]{4,}') and doc_id is distinct from (select min(doc_id) from documents where regexp_matches(text, '@'))))""")
def first_pages_claimed(t):
    """The first page of each label, by priority: a page that a label has claimed is not free for the next."""
    return C.claimed_pages(t.documents.select(F.col("doc_id").alias("page"), "text"), [("mail", "@"), ("number", "[0-9]{4,}"), ("licence", "Licensed under")])


@query("select o_orderpriority, count(*)::bigint as of_all, true as near from orders group by 1")
def sampled_strata(t):
    """A tenth of each priority, by a hash: near its share in all strata, and the same in reruns."""
    x = t.orders.withColumn("s", F.pmod(F.xxhash64("o_orderkey", F.lit(5)), F.lit(10)) == 0)
    near = F.abs(F.count_if("s") - F.count("*") * 0.1) <= 5 * F.sqrt(F.count("*") * 0.09) + 1
    return x.groupBy("o_orderpriority").agg(F.count("*").alias("of_all"), near.alias("near"))


@query("select 8::bigint as shards, count(*)::bigint as n, true as one_place, true as in_order from orders")
def sharded_orders(t):
    """Orders dealt to eight shards by a hash of the customer, and by ranges of the date."""
    one = R.sharded(t.orders, 8, "o_custkey").groupBy("o_custkey").agg(F.countDistinct("shard").alias("k"))
    by_range = t.orders.repartitionByRange(8, "o_orderdate").groupBy(F.spark_partition_id().alias("p")).agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    ordered = by_range.withColumn("ok", F.coalesce(F.lag("hi").over(W.orderBy("p")) <= F.col("lo"), F.lit(True))).agg(F.every("ok").alias("in_order"))
    x = R.sharded(t.orders, 8, "o_custkey").agg(F.countDistinct("shard").alias("shards"), F.count("*").alias("n"))
    return x.crossJoin(one.agg(F.every(F.col("k") == 1).alias("one_place"))).crossJoin(ordered)  # three single rows


# --- measures -------------------------------------------------------------------------------------------------------


@query("select quantile_cont(l_extendedprice, 0.01) as p1, quantile_cont(l_extendedprice, 0.5) as p50, quantile_cont(l_extendedprice, 0.999) as p999 from lineitem")
def exact_quantiles(t):
    x = M.exact_quantiles(t.lineitem, "l_extendedprice", [0.01, 0.5, 0.999], ["p1", "p50", "p999"])
    return x


@query("select user_id, count(*)::bigint as n, true as covered from events group by 1")
def count_min_bound(t):
    """Estimates of a count-min sketch: never below the count, and above it by at most a share of all rows."""
    sketch, n = M.count_min(t.events, "user_id"), t.events.groupBy("user_id").agg(F.count("*").alias("n"))
    x = M.count_min_estimates(n, "user_id", sketch)
    return x.select("user_id", "n", ((F.col("estimate") >= F.col("n")) & (F.col("estimate") <= F.col("n") + 0.01 * t.events.count())).alias("covered"))


@query("""with c as (select event_type as b, greatest(count(*) filter (event_id % 3 = 0), 0.5)::double as e, greatest(count(*) filter (event_id % 3 <> 0), 0.5)::double as a from events group by 1), p as (select e / sum(e) over () as p, a / sum(a) over () as q from c)
 select round(sum(p * ln(p / q)), 8) as kl, round(sum(p * ln(2 * p / (p + q)) + q * ln(2 * q / (p + q))) / 2, 8) as js from p""")
def drift_divergences(t):
    x = M.divergences(t.events, F.col("event_type"), F.col("event_id") % 3 == 0)
    return x.select(F.round("kl", 8).alias("kl"), F.round("js", 8).alias("js"))


@query("""with s as (select d.n_chars as score, l.toxic as y from documents d join labels l using (doc_id)), c as (select score, sum(y) as p, count(*) as n from s group by 1), u as (select p, sum(p) over (order by score desc) as up, sum(n) over (order by score desc) as un from c) select round(sum(p * up / un) / sum(p), 8) as ap from u""")
def pr_auc(t):
    x = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id")
    return M.average_precision(x, "n_chars", "toxic").select(F.round("ap", 8).alias("ap"))


@query("""with s as (select d.lang, d.n_chars > 1000 as pred, l.quality = 1 as y from documents d join labels l using (doc_id))
 select lang, count(*)::bigint as n, round(avg(pred::int), 8) as selected, round(coalesce(count(*) filter (pred and y) / nullif(count(*) filter (y), 0), 0), 8) as tpr, round(coalesce(count(*) filter (pred and not y) / nullif(count(*) filter (not y), 0), 0), 8) as fpr, round(coalesce(count(*) filter (pred and y) / nullif(count(*) filter (pred), 0), 0), 8) as ppv from s group by 1""")
def fairness_terms(t):
    x = t.documents.select("doc_id", "lang", "n_chars").join(t.labels, "doc_id")
    f = M.fairness(x, "lang", F.col("n_chars") > 1000, F.col("quality") == 1)
    return f.select("lang", "n", *(F.round(c, 8).alias(c) for c in ("selected", "tpr", "fpr", "ppv")))


@query("""with c as (select lang, count(*)::double as n, count(*) filter (quality = 1)::double as p from documents join labels using (doc_id) group by 1), h as (select n, p / n as s from c), w as (select sum(p) / sum(n) as s, sum(n) as n from c)
 select round((select -s * log2(s) - (1 - s) * log2(1 - s) from w) - sum(n * (case when s > 0 then -s * log2(s) else 0 end + case when s < 1 then -(1 - s) * log2(1 - s) else 0 end)) / (select n from w), 8) as gain from h""")
def information_gain(t):
    x = t.documents.select("doc_id", "lang").join(t.labels, "doc_id")
    return M.information_gain(x, "lang", F.col("quality") == 1).select(F.round("gain", 8).alias("gain"))


@query("""with m as (select l_returnflag as y, case when l_quantity > 30 then 'A' when l_quantity > 15 then 'N' else 'R' end as p from lineitem), c as (select k, count(*) filter (y = k and p = k) as tp, count(*) filter (y <> k and p = k) as fp, count(*) filter (y = k and p <> k) as fn from m, (select distinct l_returnflag as k from lineitem) group by 1)
 select round(avg(case when 2 * tp + fp + fn = 0 then 0 else 2 * tp / (2 * tp + fp + fn) end), 8) as macro, round(sum((tp + fn) * 2 * tp / (2 * tp + fp + fn)) / sum(tp + fn), 8) as weighted, round(2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 8) as micro from c""")
def f1_averages(t):
    p = F.when(F.col("l_quantity") > 30, "A").when(F.col("l_quantity") > 15, "N").otherwise("R")
    m = t.lineitem.groupBy(F.col("l_returnflag").alias("y"), p.alias("p")).agg(F.count("*").alias("n"))
    each = m.select(F.inline(F.when(F.col("y") == F.col("p"), F.array(F.struct(F.col("y").alias("k"), F.col("n").alias("tp"), F.lit(0).alias("fp"), F.lit(0).alias("fn")))).otherwise(F.array(F.struct(F.col("p").alias("k"), F.lit(0).alias("tp"), F.col("n").alias("fp"), F.lit(0).alias("fn")), F.struct(F.col("y").alias("k"), F.lit(0).alias("tp"), F.lit(0).alias("fp"), F.col("n").alias("fn"))))))
    c = each.groupBy("k").agg(*(F.sum(x).alias(x) for x in ("tp", "fp", "fn")))
    f1 = R.ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return c.agg(F.round(F.avg(f1), 8).alias("macro"), F.round(F.sum((F.col("tp") + F.col("fn")) * f1) / F.sum(F.col("tp") + F.col("fn")), 8).alias("weighted"), F.round(2 * F.sum("tp") / (2 * F.sum("tp") + F.sum("fp") + F.sum("fn")), 8).alias("micro"))


@query("""select c_mktsegment, round((avg(c_acctbal) - 4500) / (2900 / sqrt(count(*))), 6) as z, round((avg((c_nationkey < 10)::int) - 0.4) / sqrt(0.4 * 0.6 / count(*)), 6) as z_share from customer group by 1""")
def z_statistics(t):
    n = F.count("*")
    return t.customer.groupBy("c_mktsegment").agg(F.round(M.z_one_sample(F.avg("c_acctbal"), 4500.0, 2900.0, n), 6).alias("z"), F.round((F.avg((F.col("c_nationkey") < 10).cast("int")) - 0.4) / F.sqrt(F.lit(0.24) / n), 6).alias("z_share"))


@query("""with c as (select count(*) filter (l_returnflag = 'R' and l_linenumber = 1) as a, count(*) filter (l_linenumber = 1) as n, count(*) filter (l_returnflag = 'R' and l_linenumber = 2) as b, count(*) filter (l_linenumber = 2) as m from lineitem)
 select round((b / m - a / n) / sqrt(((a + b) / (n + m)) * (1 - (a + b) / (n + m)) * (1.0 / n + 1.0 / m)), 6) as z from c""")
def two_share_z(t):
    line, back = lambda k: F.col("l_linenumber") == k, F.col("l_returnflag") == "R"
    c = t.lineitem.agg(F.count_if(back & line(1)).alias("a"), F.count_if(line(1)).alias("n"), F.count_if(back & line(2)).alias("b"), F.count_if(line(2)).alias("m"))
    return c.select(F.round(M.z_two_shares(F.col("a"), F.col("n"), F.col("b"), F.col("m")), 6).alias("z"))


@query("""select l_linenumber::int as k, count(*)::bigint as n, round(factorial(12) / (factorial(l_linenumber::int) * factorial(12 - l_linenumber::int)) * pow(0.3, l_linenumber) * pow(0.7, 12 - l_linenumber), 8) as pmf from lineitem group by l_linenumber""")
def binomial_pmf(t):
    """How often a line number occurs, beside the chance of as many successes in twelve trials."""
    n = t.lineitem.groupBy(F.col("l_linenumber").cast("int").alias("k")).agg(F.count("*").alias("n"))
    return n.select("k", "n", F.round(M.binomial(12, 0.3, F.col("k")), 8).alias("pmf"))


@query("""select p_partkey, round((100 - p_retailprice / 20) / (p_retailprice / 20), 6) as roi, case when p_size = 0 then 0 else least(ceil(p_retailprice / 20 / p_size), 99)::int end as payback, round(pow(100 / (p_retailprice / 20), 1 / 5.0) - 1, 8) as growth from part""")
def investment_terms(t):
    """Return, payback and yearly growth of parts taken as investments that pay their size each year."""
    cost, size = F.col("p_retailprice") / 20, F.col("p_size")
    flows = F.concat(F.array(-cost), F.array_repeat(size.cast("double"), 99))
    return t.part.select("p_partkey", F.round((100 - cost) / cost, 6).alias("roi"), M.payback(flows).alias("payback"), F.round(M.growth(cost, F.lit(100.0), F.lit(5.0)), 8).alias("growth"))


@query("""with s as (select avg(p_retailprice) as m, stddev_pop(p_retailprice) as d from part where p_partkey % 5 <> 0), f as (select p_partkey, p_retailprice, case when p_partkey % 9 = 0 then null else p_retailprice end as x from part), i as (select avg(x) as fill from f where p_partkey % 5 <> 0)
 select p_partkey, round((p_retailprice - m) / d, 6) as z, round(coalesce(x, fill), 6) as filled from f, s, i""")
def train_only_fits(t):
    """Scaling and filling by the training part's own mean and deviation; test rows add nothing to them."""
    x = t.part.select("p_partkey", "p_retailprice", F.when(F.col("p_partkey") % 9 != 0, F.col("p_retailprice")).alias("x"))
    s = x.where("p_partkey % 5 <> 0").agg(F.avg("p_retailprice").alias("m"), F.stddev_pop("p_retailprice").alias("d"), F.avg("x").alias("fill")).first()
    return x.select("p_partkey", F.round((F.col("p_retailprice") - s["m"]) / s["d"], 6).alias("z"), F.round(F.coalesce("x", F.lit(s["fill"])), 6).alias("filled"))


@query("""select event_type, count(*) filter (abs(value - m) > 2 * d)::bigint as n_out, count(*)::bigint as n from events join (select event_type, avg(value) as m, stddev_samp(value) as d from events group by 1) using (event_type) group by 1""")
def z_outliers(t):
    s = t.events.groupBy("event_type").agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("d"))
    x = t.events.join(F.broadcast(s), "event_type")  # a row a type
    return x.groupBy("event_type").agg(F.count_if(F.abs(F.col("value") - F.col("m")) > 2 * F.col("d")).alias("n_out"), F.count("*").alias("n"))


@query("""select event_type, datediff('hour', max(ts), (select max(ts) from events)) <= 24 as timely, count(*)::bigint as n, max(ts) as newest from events group by 1""")
def timeliness(t):
    last = t.events.agg(F.max("ts")).first()[0]
    x = t.events.groupBy("event_type").agg(F.count("*").alias("n"), F.max("ts").alias("newest"))
    hours = F.timestamp_diff("HOUR", F.date_trunc("hour", "newest"), F.date_trunc("hour", F.lit(last).cast("timestamp_ntz")))
    return x.select("event_type", (hours <= 24).alias("timely"), "n", "newest")


@query("""select count(*)::bigint as n, count(*) filter (abs(o_totalprice - s) > 1000)::bigint as n_wrong from orders join (select l_orderkey, sum(l_extendedprice) as s from lineitem group by 1) on l_orderkey = o_orderkey""")
def compared_with_source(t):
    """Totals against what the lines, taken as the authority, add up to."""
    s = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("s"))
    x = t.orders.select("o_orderkey", "o_totalprice").join(s, F.col("l_orderkey") == F.col("o_orderkey"))
    return x.agg(F.count("*").alias("n"), F.count_if(F.abs(F.col("o_totalprice") - F.col("s")) > 1000).alias("n_wrong"))


# --- text templates -------------------------------------------------------------------------------------------------


@query("""select n_nationkey, 'ch' || lpad(n_nationkey::varchar, 2, '0') as code, ['I','II','III','IV','V'][n_regionkey + 1] as roman from nation""")
def padded_codes(t):
    roman = F.array(*map(F.lit, ("I", "II", "III", "IV", "V")))
    return t.nation.select("n_nationkey", F.concat(F.lit("ch"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("code"), F.get(roman, F.col("n_regionkey")).alias("roman"))


@query("""with c as (select o_orderstatus as s, count(*) as n from orders group by 1) select string_agg(s || ' ' || n || ' (' || round(100.0 * n / (select sum(n) from c))::int || ' %)', ', ' order by n desc, s) as density from c""")
def density_line(t):
    """Counts and shares as one line, by count and then key."""
    c = t.orders.groupBy(F.col("o_orderstatus").alias("s")).agg(F.count("*").alias("n"))
    total = t.orders.count()
    cell = F.concat("s", F.lit(" "), "n", F.lit(" ("), F.round(100.0 * F.col("n") / total).cast("int"), F.lit(" %)"))
    return c.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "s", cell.alias("c")))), lambda v: v["c"]), ", ").alias("density"))


@query("""select n_nationkey, '| Nation | ' || n_name || ' |' || chr(10) || '| Region | ' || n_regionkey || ' |' as card from nation""")
def cards_from_rows(t):
    """Rows `Key: value` made a table of two columns; a key that is not known fails the query."""
    rows = t.nation.select("n_nationkey", F.array(F.concat(F.lit("Nation: "), "n_name"), F.concat(F.lit("Region: "), F.col("n_regionkey").cast("string"))).alias("rows"))
    return rows.select("n_nationkey", C.card_table(F.col("rows"), ["Nation", "Region"]).alias("card"))


@query(r"""with h as (select s_suppkey, '## ' || s_nationkey || '.' || s_suppkey % 7 || '.' || s_suppkey % 3 || case when s_suppkey % 2 = 0 then '.' || s_suppkey % 5 else '' end || ' ' || s_name as h from supplier)
 select s_suppkey, case when s_suppkey % 2 = 0 then '####' else '###' end || substr(h, 3) as heading from h""")
def renumbered_headings(t):
    """A heading's depth made from the parts of its number: three or four."""
    number = F.concat_ws(".", "s_nationkey", F.col("s_suppkey") % 7, F.col("s_suppkey") % 3, F.when(F.col("s_suppkey") % 2 == 0, F.col("s_suppkey") % 5))
    return t.supplier.select("s_suppkey", C.heading_depth(F.concat(F.lit("## "), number, F.lit(" "), "s_name")).alias("heading"))


@query("""select s_suppkey, 'Origin: ' || s_name || case when s_suppkey % 3 = 0 then ' (' || s_nationkey || ')' else '' end as line from supplier""")
def kept_citations(t):
    """Lines that name their origins: the first one stays, with the remark in parentheses at the end if there is one."""
    more = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("; Nation "), "s_nationkey", F.lit("; a third"))).otherwise("")
    remark = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit(" ("), "s_nationkey", F.lit(")"))).otherwise("")
    return t.supplier.select("s_suppkey", C.one_citation(F.concat(F.lit("Origin: "), "s_name", more, remark), "Origin").alias("line"))


_TITLES = ["on", "er", "de", "th", "nowhere"]
_FRONT = "b as (select doc_id, case when strpos(text, 'e') > 0 then substr(text, strpos(text, 'e')) else text end as t from documents), f as (select doc_id, regexp_replace(t, '(?s)!!.*$', '') as t from b)"


@query(f"""with {_FRONT}, p as (select doc_id, t, unnest({_TITLES}) as title from f), q as (select doc_id, t, title, strpos(t, title) as a from p where strpos(t, title) > 0),
 z as (select doc_id, t, title, a, row_number() over w as unit, lead(a) over w as e from q window w as (partition by doc_id order by a, title)) select doc_id, unit::int as unit, title, sha256(substr(t, a, coalesce(e, length(t) + 1) - a)) as sha256 from z""")
def titled_units(t):
    """Front text cut into units at the first place of each known title, behind its opening and before its first leader."""
    x = C.titled_units(t.documents.select("doc_id", "text"), _TITLES, "e", "!!")
    return x.select("doc_id", "unit", "title", F.sha2("text", 256).alias("sha256"))


@query(f"""with {_LINES}, f as (select doc_id, line_no, line, sum((line_no % 4 = 2)::int) over (partition by doc_id order by line_no rows unbounded preceding) as u from l)
 select doc_id, u::bigint as unit, count(*)::bigint as n_lines, min(line) filter (line_no % 4 = 2) as title from f where u > 0 group by 1, 2""")
def named_units(t):
    """Front text cut at each title line, from the first one on."""
    x = C.lines(t.documents.select("doc_id", "text"))
    return C.units(x, F.col("line_no") % 4 == 2).groupBy("doc_id", "unit").agg(F.count("*").alias("n_lines"), F.min(F.when(F.col("line_no") % 4 == 2, F.col("line"))).alias("title"))


#: Pages that are made for every region. Places are columns of what _regions() gives.
_PAGES = {
    "cover": "# {{name}}\nA volume of {{n_nations}} nations.",
    "route": "## How to read {{name}}\nBegin with {{first}} and end with {{last}}.",
    "rules": "## Rules\nEvery nation of {{name}} has {{n_suppliers}} suppliers or fewer.",
    "dates": "## Dates\n{{name}} was counted with {{n_nations}} nations and {{n_suppliers}} suppliers.",
    "map": "## Map\n{{names}}",
    "plan": "## Plan\n1. {{first}}\n2. the others\n3. {{last}}",
}
_REGIONS = "r as (select r_regionkey, r_name as name, count(distinct n_nationkey)::varchar as n_nations, count(distinct s_suppkey)::varchar as n_suppliers, min(n_name) as first, max(n_name) as last, string_agg(distinct n_name, ', ' order by n_name) as names from region left join nation on n_regionkey = r_regionkey left join supplier on s_nationkey = n_nationkey group by 1, 2)"


def _regions(t):
    x = t.region.join(t.nation, F.col("n_regionkey") == F.col("r_regionkey"), "left").join(t.supplier, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    many = lambda c: F.count_distinct(c).cast("string")
    return x.groupBy("r_regionkey", F.col("r_name").alias("name")).agg(many("n_nationkey").alias("n_nations"), many("s_suppkey").alias("n_suppliers"), F.min("n_name").alias("first"), F.max("n_name").alias("last"), F.array_join(F.sort_array(F.collect_set("n_name")), ", ").alias("names"))


def _filled_sql(page: str) -> str:
    out = "'" + page.replace("\n", "' || chr(10) || '") + "'"
    for c in ("name", "n_nations", "n_suppliers", "first", "last", "names"):
        out = out.replace("{{" + c + "}}", f"' || {c} || '")
    return out


@query(f"with {_REGIONS} " + " union all ".join(f"select r_regionkey, '{k}' as page, {_filled_sql(v)} as text from r" for k, v in _PAGES.items()))
def filled_templates(t):
    """Six pages a region, each from the template of its name; what an earlier run has written is replaced."""
    path = D.scratch(t.spark, "pages")
    C.rendered(_regions(t), _PAGES).write.partitionBy("page").parquet(path)  # of an earlier run
    C.rendered(_regions(t), _PAGES).write.mode("overwrite").partitionBy("page").parquet(path)
    return t.spark.read.schema("r_regionkey int, text string, page string").parquet(path).select("r_regionkey", "page", "text")


@query("""with s as (
 select n_nationkey as k, 1 as part, 0 as place, '## ' || n_name as line, '' as o from nation
 union all select s_nationkey, 2, 0, '- ' || s_name, s_name from supplier
 union all select c_nationkey, 3, 0, '- ' || c_mktsegment || ': ' || count(*), c_mktsegment from customer group by 1, c_mktsegment
 union all select n_nationkey, 4, 0, 'In ' || r_name || '.', '' from nation join region on r_regionkey = n_regionkey
 union all select a.n_nationkey, 5, 0, 'Beside ' || b.n_name || '.', b.n_name from nation a join nation b on a.n_regionkey = b.n_regionkey and a.n_nationkey <> b.n_nationkey
 union all select c_nationkey, 6, 0, 'Balance: ' || case when sum(c_acctbal) < 0 then 'owed' else 'held' end || '.', '' from customer group by 1)
 select k, string_agg(line, chr(10) order by part, o) as text, count(distinct part)::bigint as sections from s group by 1""")
def generated_appendix(t):
    """An appendix of six sections made from four tables, lines in the order of their part and name."""
    line = lambda df, part, text, key, order=F.lit(""): df.select(F.lit(part).alias("part"), order.alias("o"), text.alias("line"), F.col(key).alias("k"))
    own, other = t.nation, t.nation.select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("r"), F.col("n_nationkey").alias("n"))
    segments = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    balance = t.customer.groupBy("c_nationkey").agg(F.when(F.sum("c_acctbal") < 0, "owed").otherwise("held").alias("b"))
    beside = own.join(other, (F.col("n_regionkey") == F.col("r")) & (F.col("n_nationkey") != F.col("n")))
    parts = [
        line(own, 1, F.concat(F.lit("## "), "n_name"), "n_nationkey"),
        line(t.supplier, 2, F.concat(F.lit("- "), "s_name"), "s_nationkey", F.col("s_name")),
        line(segments, 3, F.concat(F.lit("- "), "c_mktsegment", F.lit(": "), "n"), "c_nationkey", F.col("c_mktsegment")),
        line(own.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")), 4, F.concat(F.lit("In "), "r_name", F.lit(".")), "n_nationkey"),
        line(beside, 5, F.concat(F.lit("Beside "), "name", F.lit(".")), "n_nationkey", F.col("name")),
        line(balance, 6, F.concat(F.lit("Balance: "), "b", F.lit(".")), "c_nationkey"),
    ]
    return C.appendix(parts, "k")


@query("""select p_partkey, p_partkey::int as number, 'Which is ' || p_name || '?' as stem, 4::int as n_options, p_brand as second, ['A', 'B', 'C', 'D'][p_partkey % 4 + 1] as answer from part""")
def question_items(t):
    """Questions, options and answers parsed out of text that was put together from parts."""
    text = F.concat_ws("\n", F.concat("p_partkey", F.lit(". Which is "), "p_name", F.lit("?")), F.concat(F.lit("(A) "), "p_type"), F.concat(F.lit("(B) "), "p_brand"), F.lit("(C) both"), F.lit("(D) none"), F.concat(F.lit("Answer: "), F.substring(F.lit("ABCD"), (F.col("p_partkey") % 4 + 1).cast("int"), F.lit(1))))
    q = S.questions(t.part.select(F.col("p_partkey").alias("doc_id"), text.alias("text")))
    return q.select(F.col("doc_id").alias("p_partkey"), "number", "stem", F.size("options").alias("n_options"), F.get("options", F.lit(1))["text"].alias("second"), "answer")


@query("select n_regionkey, count(*)::bigint as n_rows, 'high' as confidence, string_agg(n_name || '|' || n_nationkey || '|' || n_regionkey, ';' order by n_name) as cells from nation group by 1")
def recovered_tables(t):
    """Tables by layout: rows written in columns of fixed width and got back as cells."""
    line = F.concat(F.rpad("n_name", 24, " "), F.rpad(F.col("n_nationkey").cast("string"), 12, " "), F.col("n_regionkey").cast("string"))
    blocks = t.nation.groupBy(F.col("n_regionkey").alias("block_id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("n_name", line.alias("l")))), lambda v: v["l"]).alias("raw"))
    x = S.tables(blocks)
    return x.select(F.col("block_id").alias("n_regionkey"), F.size("rows").cast("long").alias("n_rows"), "confidence", F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), ";").alias("cells"))


@query(r"""select doc_id, unnest(regexp_extract_all(text, '[0-9]{4,}')) as found from documents""")
def udtf_matches(t):
    """All matches of a pattern by a registered table function."""
    P.register(t.spark)
    t.documents.createOrReplaceTempView("loamwork_documents")
    return t.spark.sql("select d.doc_id, m.found from loamwork_documents d, lateral find_all(d.text, '[0-9]{4,}') m")


# --- streams --------------------------------------------------------------------------------------------------------


def _drained(t, stream, mode="append"):
    return E.drain(stream, mode, path=D.scratch(t.spark, "drained"), checkpoint=D.scratch(t.spark, "state"))


@query("select user_id, count(distinct event_id)::bigint as n from events group by 1")
def stream_dedup(t):
    """A stream read twice, in which each event comes again, without what was seen within the watermark."""
    s = E.event_stream(t.spark, f"{t.sf_dir}/events.parque[t]")
    return _drained(t, E.first_seen(s.unionByName(s), late="60 days")).groupBy("user_id").agg(F.count("*").alias("n"))


@query("select event_type, time_bucket(interval '1 day', ts) as start, count(*)::bigint as n from events where time_bucket(interval '1 day', ts) + interval '1 day' <= (select max(ts) from events) - interval '20 days' group by all")
def watermarked_windows(t):
    """Daily counts that a watermark of ten days has closed, of those that ended twenty days before the stream's last event."""
    s = E.tumbling(E.event_stream(t.spark, f"{t.sf_dir}/events.parque[t]"), "1 day", "10 days")
    last = t.events.agg(F.max("ts")).first()[0]
    got = _drained(t, s).select("event_type", F.col("start").cast("timestamp_ntz").alias("start"), "n")
    bound = F.lit(last).cast("timestamp_ntz")
    return got.where(F.col("start") + F.expr("interval 1 day") <= bound - F.expr("interval 20 days"))


@query("""select case when ts < (select max(ts) from events) - interval '5 days' then 'late' else 'on time' end as kind, count(*)::bigint as n from events group by 1""")
def late_side_output(t):
    """Rows that come later than a watermark allows, kept beside the others instead of dropped."""
    last = t.events.agg(F.max("ts")).first()[0]
    on, late = E.side_output(t.events, F.lit(last).cast("timestamp_ntz"), "5 days")
    x = on.select(F.lit("on time").alias("kind")).unionByName(late.select(F.lit("late").alias("kind")))
    return x.groupBy("kind").agg(F.count("*").alias("n"))


@query("select event_type, count(*)::bigint as n, round(sum(value), 4) as total from events group by 1")
def exactly_once_sink(t):
    """A stream written by batch number, twice from the start: the second run writes over the first."""
    path = D.scratch(t.spark, "sink")
    for _ in range(2):
        E.upsert_batches(E.event_stream(t.spark, f"{t.sf_dir}/events.parque[t]"), path, D.scratch(t.spark, "state"))
    return t.spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("""with o as (select user_id, event_type, lag(event_type) over (partition by user_id order by ts, event_id) as before from events) select before, event_type, count(*)::bigint as n from o where before is not null group by 1, 2""")
def ordered_by_key(t):
    """Steps from one event of a user to the next: keyed by user, in order of time within the key."""
    x = R.with_recent(t.events.select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"], "event_type", 1)
    x = x.select("event_type", F.get("recent", F.lit(0)).alias("before")).where("before is not null")
    return x.groupBy("before", "event_type").agg(F.count("*").alias("n"))


@query("""select user_id, time_bucket(interval '1 day', ts) as day, count(*)::bigint as n, sum(json_extract_string(props, '$.k')::bigint)::bigint as k_sum, max(json_extract_string(props, '$.k')::bigint)::bigint as k_max from events group by 1, 2""")
def window_features(t):
    """Features by user and day out of nested logs."""
    k = F.get_json_object("props", "$.k").cast("long")
    x = t.events.groupBy("user_id", F.window(F.col("ts").cast("timestamp"), "1 day").alias("w")).agg(F.count("*").alias("n"), F.sum(k).alias("k_sum"), F.max(k).alias("k_max"))
    return x.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("day"), "n", "k_sum", "k_max")


# --- models ---------------------------------------------------------------------------------------------------------


@query("""with b as (select distinct user_id, ts::date as day, event_type as x from events), n1 as (select [x] as items, count(*) as n from b group by x), n2 as (select [a.x, c.x] as items, count(*) as n from b a join b c using (user_id, day) where a.x < c.x group by a.x, c.x), n3 as (select [a.x, c.x, d.x] as items, count(*) as n from b a join b c using (user_id, day) join b d using (user_id, day) where a.x < c.x and c.x < d.x group by a.x, c.x, d.x),
 k as (select count(*) as k from (select distinct user_id, day from b)) select array_to_string(items, ',') as items, n::bigint as n from (select * from n1 union all select * from n2 union all select * from n3), k where n >= ceil(0.01 * k)""")
def frequent_itemsets(t):
    """Types of events that a user has on one day, by FP-growth, up to three in a set."""
    baskets = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.collect_set("event_type").alias("items"))
    return P.itemsets(baskets, "items", 0.01).where("size(items) <= 3").select(F.array_join(F.sort_array("items"), ",").alias("items"), F.col("freq").alias("n"))


@query()
def kmeans_sizes(t):
    """Customers in four clusters by balance and nation. Checked in tests."""
    return P.kmeans(t.customer, ["c_acctbal", "c_nationkey"], 4).groupBy("cluster").agg(F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 2).alias("mean"))


@query("select 1::int as component, true as falls, true as sums from (select 1) union all select 2, true, true union all select 3, true, true")
def pca_variances(t):
    """Shares of variance by component, fitted on the training part: falling, and 1 in all."""
    return P.pca_shares(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"], F.col("l_orderkey") % 5 != 0).select("component", "falls", "sums")


@query()
def logistic_cv(t):
    """Mean AUC over five folds by a hash, of a logistic model of quality by lengths. Checked in tests."""
    x = t.documents.select("doc_id", F.length("text").alias("size"), F.size(F.split("text", "\n")).alias("n_lines")).join(t.labels, "doc_id")
    return P.cross_validated(x, ["size", "n_lines"], "quality", "doc_id", 5)


@query()
def bootstrap_interval(t):
    """The middle 95 % of 200 resampled means of a value. Checked in tests."""
    return P.bootstrap_mean(t.events, "value", "event_id", 200)


@query()
def private_counts(t):
    """Counts with Laplace noise of a stated budget. Checked in tests."""
    return P.private_counts(t.events, "event_type", 0.5)


@query("""with n as (select lang, quality, count(*) as n from documents join labels using (doc_id) group by 1, 2) select lang, sum(n)::bigint as n, round(coalesce(sum(n) filter (quality = 1), 0) / sum(n), 8) as good from n group by 1""")
def quality_by_language(t):
    """Labelled quality by language: what a rule score is judged against."""
    x = t.documents.select("doc_id", "lang").join(t.labels, "doc_id")
    return x.groupBy("lang").agg(F.count("*").alias("n"), F.round(F.avg(F.col("quality").cast("double")), 8).alias("good"))


_RULES_OF = {
    "shouting": r"10 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(regexp_replace(text, '[^A-Za-z]', '', 'g'))",
    "symbols": r"10 * length(regexp_replace(text, '[^#$%&*!]', '', 'g')) > length(text)",
    "short": "length(text) < 200",
}


@query(
    "with d as (select documents.*, toxic, quality from documents join labels using (doc_id)), r as ("
    + " union all ".join(f"select '{n}' as rule, {p} as hit, toxic, quality from d" for n, p in _RULES_OF.items())
    + """) select rule, count(*) filter (hit)::bigint as hits, count(*) filter (hit and toxic = 1)::bigint as toxic_hits, count(*) filter (hit and quality = 0)::bigint as poor_hits,
 round(count(*) filter (hit and toxic = 1) / nullif(count(*) filter (toxic = 1), 0), 8) as toxic_recall, round(count(*) filter (hit and quality = 0) / nullif(count(*) filter (quality = 0), 0), 8) as poor_recall from r group by rule"""
)
def rules_against_labels(t):
    """Score rules as columns, each held against the labels of toxicity and of quality."""
    part = lambda kept: F.length(F.regexp_replace("text", kept, ""))
    rules = {"shouting": 10 * part("[^A-Z]") > 3 * part("[^A-Za-z]"), "symbols": 10 * part("[^#$%&*!]") > F.length("text"), "short": F.length("text") < 200}
    x = t.documents.select("doc_id", F.array(*(F.struct(F.lit(n).alias("rule"), c.alias("hit")) for n, c in rules.items())).alias("r")).join(t.labels, "doc_id")
    x = x.select("toxic", "quality", F.inline("r"))
    toxic, poor = F.col("toxic") == 1, F.col("quality") == 0
    share = lambda kind: F.count_if(F.col("hit") & kind) / F.nullif(F.count_if(kind), F.lit(0))
    return x.groupBy("rule").agg(F.count_if("hit").alias("hits"), F.count_if(F.col("hit") & toxic).alias("toxic_hits"), F.count_if(F.col("hit") & poor).alias("poor_hits"), F.round(share(toxic), 8).alias("toxic_recall"), F.round(share(poor), 8).alias("poor_recall"))


# --- expansion and rewriting ----------------------------------------------------------------------------------------


@query("""select p_partkey, '(' || p_size || '*' || p_partkey || ') and f(' || p_size || ')' as text from part""")
def tidied_formulas(t):
    """Spaces inside parentheses and around operators taken out of text put together from parts."""
    text = F.concat(F.lit("( "), "p_size", F.lit(" * "), "p_partkey", F.lit(" ) and f( "), "p_size", F.lit("  )"))
    x = V.rewrite_documents(t.part.select(F.col("p_partkey").alias("doc_id"), text.alias("text")), callouts=False)
    return x.select(F.col("doc_id").alias("p_partkey"), "text")


@query("""select n_nationkey, '::: callout' || chr(10) || 'Note ' || n_name || chr(10) || 'more' || chr(10) || ':::' || chr(10) || chr(10) || 'rest' || chr(10) || '::: callout' || chr(10) || 'Tip ' || n_regionkey || chr(10) || ':::' as text from nation""")
def wrapped_callouts(t):
    """Callouts fenced up to the next blank line, or the end."""
    text = F.concat(F.lit("Note "), "n_name", F.lit("\nmore\n\nrest\nTip "), F.col("n_regionkey").cast("string"))
    return V.rewrite_documents(t.nation.select(F.col("n_nationkey").alias("doc_id"), text.alias("text"))).select(F.col("doc_id").alias("n_nationkey"), "text")


@query("""select r_regionkey, string_agg('::: definition' || chr(10) || n_name || ': a nation' || chr(10) || 'of ' || n_nationkey || chr(10) || ':::' || chr(10) || chr(10) || n_name || ': again', chr(10) order by n_name) as text, count(*)::int as n_found from region join nation on n_regionkey = r_regionkey group by 1""")
def defined_callouts(t):
    """Definitions of a region's nations in their order, fenced up to a blank line; a second one of the same is left as it is."""
    part = F.concat("n_name", F.lit(": a nation\nof "), "n_nationkey", F.lit("\n\n"), "n_name", F.lit(": again"))
    x = t.nation.groupBy(F.col("n_regionkey").alias("doc_id")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n_name", part.alias("p")))), lambda r: r["p"]), "\n").alias("text"), F.sort_array(F.collect_list("n_name")).alias("terms"))
    return V.defined_callouts(x).select(F.col("doc_id").alias("r_regionkey"), "text", "n_found")


@query("""with l as (select n_nationkey as doc_id, 1 as line_no, 'In:' as line, 0 as k, null as r from nation union all select n_nationkey, 2, null, 1, n_regionkey from nation),
 f as (select r_regionkey as r, unnest(string_split(r_name, ' ')) as line, generate_subscripts(string_split(r_name, ' '), 1) - 1 as sub_no from region)
 select doc_id, line_no, 0 as sub_no, line from l where k = 0 union all select doc_id, line_no, f.sub_no::int, f.line from l join f on f.r = l.r where k = 1""")
def included_files(t):
    """Include lines replaced by the lines of the file they name; a file that is not there fails the query."""
    line = F.array(F.lit("In:"), F.concat(F.lit("<!-- include: r"), "n_regionkey", F.lit(" -->")))
    lines = t.nation.select(F.col("n_nationkey").alias("doc_id"), F.posexplode(line).alias("i", "line")).select("doc_id", (F.col("i") + 1).alias("line_no"), "line")
    files = t.region.select(F.concat(F.lit("r"), "r_regionkey").alias("name"), F.replace("r_name", F.lit(" "), F.lit("\n")).alias("text"))
    return V.expand_includes(lines, files)


@query("""select n_nationkey, 'Of ' || (select count(*) from nation) || ' nations, ' || (select count(*) from customer) || ' customers: ' || n_name as text from nation""")
def stats_placeholders(t):
    """Dotted keys in text replaced by what a JSON document of statistics holds; a key that it lacks fails the query."""
    path = D.scratch(t.spark, "stats")
    counts = t.nation.agg(F.count("*").alias("nations")).crossJoin(t.customer.agg(F.count("*").alias("customers")))  # a row each
    counts.select(F.struct("nations", "customers").alias("counts")).write.json(path)
    stats = t.spark.read.schema("counts struct<nations: long, customers: long>").json(path).first()["counts"].asDict()
    text = F.concat(F.lit("Of {{counts.nations}} nations, {{counts.customers}} customers: "), "n_name")
    return t.nation.select("n_nationkey", C.filled(text, {f"counts.{k}": str(v) for k, v in stats.items()}).alias("text"))


@query(f"""with {_LINES} select doc_id, count(*) filter (len(w) >= 2 and list_max(list_transform(w, lambda x: length(x))) <= 12)::bigint as n from (select doc_id, regexp_extract_all(line, '[^ ]+') as w from l) group by 1""")
def tabular_lines(t):
    """Lines that could be cells of a table: two words or more, none of them long."""
    words = F.regexp_extract_all("line", F.lit("[^ ]+"), F.lit(0))
    x = C.lines(t.documents.select("doc_id", "text")).select("doc_id", words.alias("w"))
    return x.groupBy("doc_id").agg(F.count_if((F.size("w") >= 2) & (F.array_max(F.transform("w", lambda v: F.length(v))) <= 12)).alias("n"))
