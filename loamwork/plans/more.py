"""More registered queries: reference cards, encodings, sampling, layouts, sketches and graphs, each beside its SQL."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as T
from ..operators import corpus as C
from ..operators import graph as G
from ..operators import relational as R
from .catalogue import _LINES, _median, _recent, query

# --- reconciliation -------------------------------------------------------------------------------------------------


@query("""with a as (select c_nationkey as k, count(*) as n from customer group by 1), b as (select s_nationkey as k, count(*) as n from supplier group by 1)
 select n_nationkey as k, coalesce(a.n, 0)::bigint as expected, coalesce(b.n, 0)::bigint as actual from nation left join a on a.k = n_nationkey left join b on b.k = n_nationkey where coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def count_mismatches(t):
    a = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("a"))
    b = t.supplier.groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("b"))
    x = t.nation.select(F.col("n_nationkey").alias("k")).join(a, "k", "left").join(b, "k", "left")
    return x.select("k", F.coalesce("a", F.lit(0)).alias("expected"), F.coalesce("b", F.lit(0)).alias("actual")).where("expected <> actual")


@query("""select regexp_extract(p_type, '^([A-Za-z]+)', 1) as code, count(distinct p_partkey)::bigint as n, count(*) filter (starts_with(p_brand, 'Brand#1'))::bigint as n_first from part group by 1""")
def counts_by_code_prefix(t):
    return t.part.groupBy(F.regexp_extract("p_type", "^([A-Za-z]+)", 1).alias("code")).agg(F.countDistinct("p_partkey").alias("n"), F.count_if(F.startswith("p_brand", F.lit("Brand#1"))).alias("n_first"))


@query(f"""with {_LINES}, x as (select doc_id, line_no, line, row_number() over (partition by doc_id order by line_no desc) as r from l where line <> '') select doc_id, max(line_no)::int as last_line, count(*) filter (regexp_matches(line, '^[A-Z]'))::bigint as n_capital from x where r <= 3 group by doc_id""")
def page_tails(t):
    """Of the last three lines with text: where they end and how many begin with a capital."""
    x = C.lines(t.documents).where("line <> ''").withColumn("r", F.row_number().over(W.partitionBy("doc_id").orderBy(F.desc("line_no")))).where("r <= 3")
    return x.groupBy("doc_id").agg(F.max("line_no").alias("last_line"), F.count_if(F.col("line").rlike("^[A-Z]")).alias("n_capital"))


@query("""with r as (select n_regionkey, n_name, row_number() over (partition by n_regionkey order by n_name) - 1 as i from nation)
 select n_regionkey, (i // 2)::bigint as row, max(n_name) filter (i % 2 = 0) as left_cell, max(n_name) filter (i % 2 = 1) as right_cell from r group by 1, 2""")
def two_per_row(t):
    r = t.nation.withColumn("i", F.row_number().over(W.partitionBy("n_regionkey").orderBy("n_name")) - 1)
    cell = lambda k: F.max(F.when(F.col("i") % 2 == k, F.col("n_name")))
    return r.groupBy("n_regionkey", F.floor(F.col("i") / 2).alias("row")).agg(cell(0).alias("left_cell"), cell(1).alias("right_cell"))


@query("""select p_brand, max(length(p_name))::bigint as widest, round(greatest(sqrt(avg(length(p_name))) * 3, 8), 6) as weight from part group by 1""")
def column_widths(t):
    w = T.display_width(F.col("p_name"))
    return t.part.groupBy("p_brand").agg(F.max(w).cast("long").alias("widest"), F.round(F.greatest(F.sqrt(F.avg(w)) * 3, F.lit(8.0)), 6).alias("weight"))


# --- quality, encodings, sampling -----------------------------------------------------------------------------------


@query("""with r as (select event_type, avg((value > 50)::int) as rate from events group by 1) select event_type, case when rate < 0.05 then 'fill' when rate <= 0.5 then 'model' else 'drop' end as policy from r""")
def missing_policy(t):
    """What to do with a column by its share of missing values; values of over 50 stand for missing ones."""
    gone = t.events.select("event_type", F.when(F.col("value") <= 50, F.col("value")).alias("v"))
    rate = gone.groupBy("event_type").agg(F.avg(F.col("v").isNull().cast("int")).alias("r"))
    return rate.select("event_type", F.when(F.col("r") < 0.05, "fill").when(F.col("r") <= 0.5, "model").otherwise("drop").alias("policy"))


@query("""with c as (select quality as y, n_chars > 800 as p from labels join documents using (doc_id)), k as (select unnest([0, 1]) as k),
 m as (select k, count(*) filter (y = k and p = (k = 1)) as tp, count(*) filter (y <> k and p = (k = 1)) as fp, count(*) filter (y = k and p <> (k = 1)) as fn from c, k group by k)
 select round(avg(case when 2 * tp + fp + fn = 0 then 0 else 2 * tp / (2 * tp + fp + fn) end), 8) as macro_f1 from m""")
def f1_macro(t):
    x = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select((F.col("quality") == 1).alias("y"), (F.col("n_chars") > 800).alias("p"))
    c = x.agg(*R.confusion(F.col("p"), F.col("y")))
    f1 = lambda tp: R.ratio(2.0 * tp, 2 * tp + F.col("fp") + F.col("fn"))
    return c.select(F.round((f1(F.col("tp")) + f1(F.col("tn"))) / 2, 8).alias("macro_f1"))


@query("select l_returnflag, round(sum(ln(1 + l_quantity)), 4) as log1p, round(sum((sqrt(l_quantity) - 1) / 0.5), 4) as box_cox from lineitem group by 1")
def power_transforms(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.sum(F.log1p("l_quantity")), 4).alias("log1p"), F.round(F.sum(T.box_cox(F.col("l_quantity"), 0.5)), 4).alias("box_cox"))


@query("""select p_partkey, round((100 - least(p_size, 99)) / 100 * 525600, 6) as downtime, round(600 - 20 / ln(2.0) * ln(p_size::double), 6) as score from part""")
def downtime_and_score(t):
    return t.part.select("p_partkey", F.round(T.availability_downtime(F.least("p_size", F.lit(99))), 6).alias("downtime"), F.round(T.credit_score(F.col("p_size").cast("double"), 600, 20), 6).alias("score"))


@query("""with c as (select conv_id, turn, list_distinct(string_split(text, ' ')) as a, lead(list_distinct(string_split(text, ' '))) over (partition by conv_id order by turn) as b from conversations)
 select conv_id, turn, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 8) as jaccard from c where b is not null""")
def next_turn_jaccard(t):
    x = t.conversations.select("conv_id", "turn", F.array_distinct(F.split("text", " ")).alias("a"))
    x = x.withColumn("b", F.lead("a").over(W.partitionBy("conv_id").orderBy("turn"))).where("b is not null")
    return x.select("conv_id", "turn", F.round(T.jaccard(F.col("a"), F.col("b")), 8).alias("jaccard"))


@query("""with x as (select user_id, event_id, value, quantile_cont(value, 0.5) over (partition by user_id order by ts, event_id rows between 4 preceding and current row) as m from events) select user_id, count(*)::bigint as n, round(sum(value - m), 4) as drift from x group by 1""")
def rolling_median(t):
    recent = _recent(t, "value", 4).select("user_id", "value", F.concat("recent", F.array("value")).alias("v"))
    x = recent.select("user_id", "value", _median(F.col("v")).alias("m"))
    return x.groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum(F.col("value") - F.col("m")), 4).alias("drift"))


@query("""with a as (select *, ntile(5) over (partition by c_mktsegment order by c_custkey) as fold from customer) select c_mktsegment, fold::int as fold, count(*)::bigint as n from a group by all""")
def stratified_folds(t):
    x = R.ntiles(t.customer.select("c_mktsegment", "c_custkey"), "c_mktsegment", ["c_custkey"], 5, "fold")
    return x.groupBy("c_mktsegment", "fold").agg(F.count("*").alias("n"))


@query("""select toxic, (count(*) * case when toxic = 1 then 4 else 1 end)::bigint as n from labels where doc_id % 5 <> 0 group by toxic""")
def oversampled_train(t):
    """The training part with each row of the rare class four times; the test part (a fifth) is left as it is."""
    train = t.labels.where("doc_id % 5 <> 0")
    times = F.when(F.col("toxic") == 1, 4).otherwise(1)
    return train.select("toxic", F.explode(F.sequence(F.lit(1), times))).groupBy("toxic").agg(F.count("*").alias("n"))


@query("""with k as (select toxic, count(*) as n from labels where doc_id % 5 <> 0 and toxic is not null group by 1), r as (select toxic, row_number() over (partition by toxic order by md5(doc_id::varchar), doc_id) as r from labels where doc_id % 5 <> 0 and toxic is not null)
 select toxic, count(*)::bigint as n from r where r <= (select min(n) from k) group by 1""")
def undersampled_train(t):
    """The training part with as many rows of each class as the rarest has, chosen by a hash; test rows are left out."""
    train = t.labels.where("doc_id % 5 <> 0 and toxic is not null").withColumn("h", F.md5(F.col("doc_id").cast("string")))
    least = train.groupBy("toxic").agg(F.count("*").alias("n")).agg(F.min("n").alias("least"))  # a row
    x = R.dealt_ranks(train.select("toxic", "h", "doc_id"), "toxic", ["h", "doc_id"], "r").crossJoin(F.broadcast(least))
    return x.where("r <= least").groupBy("toxic").agg(F.count("*").alias("n"))


# --- sketches (bounds, not values) and graphs -----------------------------------------------------------------------


@query("select true as within")
def kll_quantile_bound(t):
    """The median by a KLL sketch has between 45 and 55 % of the values at or below it."""
    x = t.events.agg(F.expr("kll_sketch_get_quantile_double(kll_sketch_agg_double(value), 0.5d)").alias("a"))
    share = F.avg((F.col("value") <= F.col("a")).cast("int"))
    return t.events.select("value").crossJoin(F.broadcast(x)).agg(((share >= 0.45) & (share <= 0.55)).alias("within"))


@query("""with e as (select distinct c_nationkey as a, s_nationkey as b from orders join lineitem on l_orderkey = o_orderkey join customer on c_custkey = o_custkey join supplier on s_suppkey = l_suppkey where c_nationkey <> s_nationkey)
 select n, count(*) filter (side = 1)::bigint as out_degree, count(*) filter (side = 2)::bigint as in_degree from (select a as n, 1 as side from e union all select b, 2 from e) group by n""")
def degrees(t):
    return G.degrees(_trade(t))


def _trade(t):
    """Distinct pairs (src, dst) of a customer's nation and a supplier's, other than itself."""
    x = t.lineitem.select("l_orderkey", "l_suppkey").join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    x = x.join(t.customer.select("c_custkey", F.col("c_nationkey").alias("src")), F.col("o_custkey") == F.col("c_custkey"))
    return x.join(t.supplier.select("s_suppkey", F.col("s_nationkey").alias("dst")), F.col("l_suppkey") == F.col("s_suppkey")).where("src <> dst").select("src", "dst").distinct()
