"""The registered queries, each beside the DuckDB SQL that says the same."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as T
from ..operators import corpus as C
from ..operators import measures as M
from ..operators import neighbours as N
from ..operators import relational as R
from ..operators import rewrite as V
from ..operators import structure as S
from ..sources import sinks as K
from ..sources.tables import load, overlay
from ..streaming import events as E

QUERIES: dict = {}
ORACLES: dict = {}


class Tables:
    """Tables of one folder by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name)


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = lambda spark, sf_dir, f=f: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


_LINES = "l as (select doc_id, source, lang, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as line_no from documents)"
_NORM = r"trim(regexp_replace(replace(line, chr(173), ''), '[ \t\x{3000}]+', ' ', 'g'))"

# --- corpus ---------------------------------------------------------------------------------------------------------


@query(f"with {_LINES}, n as (select doc_id, {_NORM} as t from l) select doc_id, count(*)::bigint as n_lines, sum(length(t))::bigint as n_chars from n where t <> '' group by doc_id")
def doc_lines_normalised(t):
    x = C.lines(t.documents).select("doc_id", T.norm_line(F.col("line")).alias("t")).where("t <> ''")
    return x.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("t")).cast("long").alias("n_chars"))


_CLASS = r"""case when regexp_matches(line, '^\s*$') then 'blank' when regexp_matches(line, '^```') then 'fence' when regexp_matches(line, '^#{1,6} ') then 'heading' when regexp_matches(line, '^>') then 'quote'
 when regexp_matches(line, '^[-*+] ') then 'list' when regexp_matches(line, '^[0-9]+[.)] ') then 'numbered' when regexp_matches(line, ' \| ') then 'table' when regexp_matches(line, '^Licensed under') then 'licence'
 when regexp_matches(line, '!!') then 'shout' when regexp_matches(line, '[.!?]$') then 'sentence' else 'other' end"""


@query(f"with {_LINES} select {_CLASS} as class, count(*)::bigint as n, count(distinct doc_id)::bigint as n_docs from l group by 1")
def line_class_counts(t):
    x = C.lines(t.documents).select("doc_id", C.line_class(F.col("line")).alias("class"))
    return x.groupBy("class", "doc_id").agg(F.count("*").alias("n")).groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("n_docs"))


@query(f"with {_LINES}, w as (select doc_id, line, sum(contains(line, ' | ')::int) over (partition by doc_id order by line_no rows unbounded preceding) % 2 = 1 as inside from l) select doc_id, count(*) filter (inside)::bigint as n_inside, count(*)::bigint as n_lines from w group by doc_id")
def fenced_or_boilerplate_flag(t):
    x = C.toggled(C.lines(t.documents), F.col("line").contains(" | "))
    return x.groupBy("doc_id").agg(F.count_if("inside").alias("n_inside"), F.count("*").alias("n_lines"))


_FOUND = " union all ".join(f"select doc_id, source, lang, '{c}' as \"check\", '{s}' as severity, len(regexp_extract_all(text, '{p}'))::bigint as n from documents" for c, s, p in C.RULES)
_FOUND = f"f as (select * from ({_FOUND}) where n > 0)"


@query(f'with {_FOUND} select doc_id, "check", severity, n from f')
def pattern_findings(t):
    return C.findings(t.documents.select("doc_id", "text"))


@query(f'with {_FOUND} select "check", severity, count(*)::bigint as n_docs, sum(n)::bigint as n_findings from f group by all')
def findings_by_rule(t):
    x = C.findings(t.documents.select("doc_id", "text")).groupBy("check", "severity").agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_findings"))
    return x.orderBy(C.severity_rank(F.col("severity")), "check")


@query(f"""with {_FOUND}, r as (select * from (values (1, 'url', 'src0', 'hot source'), (2, '*', 'src1', 'reviewed'), (3, 'symbol_run', '*', 'junk')) as v(o, c, s, reason)),
 h as (select f.doc_id, f."check", f.severity, f.source, arg_min(r.reason, r.o) as allowed from f left join r on f.severity = 'warn' and (r.c = '*' or r.c = f."check") and (r.s = '*' or r.s = f.source) group by all)
 select "check", severity, allowed, count(*)::bigint as n from h group by all""")
def findings_allowlisted(t):
    rules = t.spark.createDataFrame([(1, "url", "src0", "hot source"), (2, "*", "src1", "reviewed"), (3, "symbol_run", "*", "junk")], "rule_order int, check string, source string, reason string")
    found = C.findings(t.documents.select("doc_id", "text", "source"))
    return C.allowed(found, rules).groupBy("check", "severity", "allowed").agg(F.count("*").alias("n"))


@query(f"with {_LINES} select doc_id, count(*)::bigint as n from l where regexp_matches(line, '[0-9]{{4,}}') and not regexp_matches(line, 'https?://') group by doc_id")
def findings_guarded(t):
    x = C.lines(t.documents).where(F.col("line").rlike("[0-9]{4,}") & ~F.col("line").rlike("https?://"))
    return x.groupBy("doc_id").agg(F.count("*").alias("n"))


_INTEGRITY = r"regexp_replace(regexp_replace(regexp_replace(text, '(?m)^[|\s:-]+$', '', 'g'), '(?m)^:::.*$|^#+|[|`]', '', 'g'), '\s+', '', 'g')"


@query(f"select doc_id, sha256(t) as sha256, length(t)::bigint as n from (select doc_id, {_INTEGRITY} as t from documents)")
def doc_integrity_hash(t):
    return C.integrity(t.documents)


@query(f"""with b as (select doc_id, {_INTEGRITY} as t, row_number() over (partition by text order by doc_id) as r from documents),
 s as (select case when r > 1 then 'missing' when t = regexp_replace(t, '[0-9]', '', 'g') then 'ok' else 'mismatch' end as status from b) select status, count(*)::bigint as n from s group by 1""")
def integrity_diff(t):
    docs = t.documents
    first = docs.groupBy(F.sha2("text", 256).alias("h")).agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    now = docs.join(first, "doc_id", "left_semi").withColumn("text", F.regexp_replace("text", "[0-9]", ""))
    return C.integrity_diff(C.integrity(docs), C.integrity(now)).groupBy("status").agg(F.count("*").alias("n"))


@query("""with c as (select lang, unnest(string_split(text, '')) as ch from documents where lang in ('en', 'fr')), n as (select lang, ch, count(*) as n from c group by all)
 select a.ch, (a.n - coalesce(b.n, 0))::bigint as n from (select * from n where lang = 'fr') a left join (select * from n where lang = 'en') b using (ch) where a.n > coalesce(b.n, 0) and a.ch <> ''""")
def char_multiset_diff_by_lang(t):
    c = t.documents.where("lang in ('en', 'fr')").select("lang", F.explode(F.split("text", "")).alias("ch")).where("ch <> ''")
    return C.multiset_diff(c.where("lang = 'fr'"), c.where("lang = 'en'"), "ch")


@query("""with a as (select conv_id, turn, role, last_value(case when role = 'user' then turn end ignore nulls) over (partition by conv_id order by turn rows unbounded preceding) as anchor from conversations) select role, anchor, count(*)::bigint as n from a group by all""")
def heading_forward_fill(t):
    x = C.fill_forward(t.conversations.select("conv_id", "turn", "role"), "conv_id", "turn", F.when(F.col("role") == "user", F.col("turn")), "anchor")
    return x.groupBy("role", "anchor").agg(F.count("*").alias("n"))


@query("""select conv_id, turn, last_value(case when role = 'user' then turn end ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding) as anchor from conversations""")
def nearest_anchor(t):
    x = C.fill_forward(t.conversations.select("conv_id", "turn", "role"), "conv_id", "turn", F.when(F.col("role") == "user", F.col("turn")), "anchor", before=True)
    return x.select("conv_id", "turn", "anchor")


@query("""select conv_id, turn as first, lead(turn) over (partition by conv_id order by turn) as past from conversations where role = 'user'""")
def segment_bounds(t):
    return C.segments(t.conversations, "conv_id", "turn", F.col("role") == "user")


@query("select conv_id, max(turn) as turn, arg_max(role, turn) as role from conversations group by conv_id")
def last_turn_per_conv(t):
    return t.conversations.groupBy("conv_id").agg(F.max("turn").alias("turn"), F.max_by("role", "turn").alias("role"))


@query("select lang, doc_id, n_chars from (select *, row_number() over (partition by lang order by n_chars desc, doc_id) as r from documents) where r <= 3")
def top3_docs_per_lang(t):
    w = W.partitionBy("lang").orderBy(F.desc("n_chars"), "doc_id")
    return t.documents.select("lang", "doc_id", "n_chars").withColumn("r", F.row_number().over(w)).where("r <= 3").drop("r")


@query("select text, count(*)::bigint as n, min(doc_id) as first_doc from documents group by text having count(*) > 1")
def duplicate_keys(t):
    # texts are grouped by a hash; only the first document of a group of two or more is read again for its text
    some = t.documents.select("doc_id", F.sha2("text", 256).alias("h")).groupBy("h").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")
    return some.join(t.documents.select("doc_id", "text"), F.col("first_doc") == F.col("doc_id")).select("text", "n", "first_doc")


@query("select source, count(*)::bigint as n, round_even(100.0 * count(*) / sum(count(*)) over (), 0)::bigint as pct from documents group by source")
def source_share_pct(t):
    n = t.documents.groupBy("source").agg(F.count("*").alias("n"))
    total = n.agg(F.greatest(F.sum("n"), F.lit(1)).alias("t"))
    return n.crossJoin(F.broadcast(total)).select("source", "n", F.bround(100 * F.col("n") / F.col("t")).cast("long").alias("pct")).orderBy(F.desc("n"), "source")


@query("""with w as (select doc_id, string_split(text, ' ') as w from documents), s as (select doc_id, list_filter(list_transform(range(0, len(w)), lambda i: {'first': i, 'past': i + 1 + length(w[i + 1]) % 3, 'last': 0, 'n': 0}), lambda x: x.past > x.first + 1) as s from w)
 select doc_id, list_reduce(list_prepend({'first': 0, 'past': 0, 'last': 0, 'n': 0}, s), lambda a, x: case when x.first >= a.last then {'first': 0, 'past': 0, 'last': x.past, 'n': a.n + 1} else a end).n::bigint as n from s""")
def greedy_spans(t):
    """Spans of words by their lengths in each document, those kept that overlap none before."""
    words = F.split("text", " ")
    at = F.transform(words, lambda w, i: F.struct(i.alias("first"), (i + 1 + F.pmod(F.length(w), F.lit(3))).cast("int").alias("past")))
    spans = C.greedy_spans(F.filter(at, lambda s: s["past"] > s["first"] + 1))
    return t.documents.select("doc_id", F.size(spans).cast("long").alias("n"))


@query("""select n_nationkey as k, coalesce(s.who, c.who) as who from nation left join (select c_nationkey, 'customer ' || min(c_name) as who from customer group by 1) c on c_nationkey = n_nationkey
 left join (select s_nationkey, 'supplier ' || min(s_name) as who from supplier group by 1) s on s_nationkey = n_nationkey where coalesce(s.who, c.who) is not null""")
def overlay_union(t):
    low = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.concat(F.lit("customer "), F.min("c_name")).alias("who"))
    high = t.supplier.groupBy(F.col("s_nationkey").alias("k")).agg(F.concat(F.lit("supplier "), F.min("s_name")).alias("who"))
    return overlay([low, high], "k")


@query("""with k as (select 'docs.' || lang as key, count(*)::varchar as v from documents group by lang), tpl as (select * from (values (1, 'docs.en'), (2, 'docs.fr'), (3, 'docs.de')) as x(i, key)) select i, 'There are ' || v || ' texts under ' || key as line from tpl join k using (key)""")
def template_expand(t):
    stats = t.documents.groupBy("lang").agg(F.count("*").cast("string").alias("v")).select(F.concat(F.lit("docs."), "lang").alias("key"), "v")
    tpl = t.spark.createDataFrame([(1, "docs.en"), (2, "docs.fr"), (3, "docs.de")], "i int, key string")
    return F.broadcast(tpl).join(stats, "key").select("i", F.concat(F.lit("There are "), "v", F.lit(" texts under "), "key").alias("line"))


@query("select doc_id, len(list_filter(string_split(text, '. '), lambda x: x <> ''))::bigint as n_items, list_max(list_transform(string_split(text, '. '), lambda x: length(x)))::bigint as longest from documents")
def split_items(t):
    parts = F.split("text", r"\. ", -1)
    return t.documents.select("doc_id", F.size(F.filter(parts, lambda x: x != "")).cast("long").alias("n_items"), F.array_max(F.transform(parts, lambda x: F.length(x))).cast("long").alias("longest"))


@query(r"""select page_id, regexp_replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g') as text from pages""")
def html_to_text(t):
    return t.pages.select("page_id", F.regexp_replace(T.strip_tags(F.col("html")), r"\s+", " ").alias("text"))


@query("select regexp_extract(url, '^https?://([^/]+)', 1) as host, count(*)::bigint as n from pages group by 1")
def url_host_counts(t):
    return t.pages.groupBy(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host")).agg(F.count("*").alias("n"))


@query(r"select source, sum(len(regexp_extract_all(m, '<email>')))::bigint as n_email, sum(len(regexp_extract_all(m, '<number>')))::bigint as n_number from (select source, regexp_replace(regexp_replace(text, '" + T.EMAIL + r"', '<email>', 'g'), '[0-9]{4,}', '<number>', 'g') as m from documents) group by source")
def pii_masked_counts(t):
    m = t.documents.select("source", T.mask_pii(F.col("text")).alias("m"))
    return m.groupBy("source").agg(F.sum(F.regexp_count("m", F.lit("<email>"))).cast("long").alias("n_email"), F.sum(F.regexp_count("m", F.lit("<number>"))).cast("long").alias("n_number"))


@query(r"""with w as (select doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) as term from documents), tf as (select doc_id, term, count(*) as tf from w where term <> '' group by all),
 df as (select term, count(*) as df from tf group by term), x as (select doc_id, term, round(tf * log10((select count(*) from documents) / df), 6) as tfidf from tf join df using (term))
 select doc_id, term, tfidf from (select *, row_number() over (partition by doc_id order by tfidf desc, term) as r from x) where r <= 3""")
def tfidf_top_terms(t):
    return R.top_terms(t.documents, 3)


@query("""with b as (select item_id, string_split(text, ' ') as w from benchmark), s as (select distinct array_to_string(w[i : i + 7], ' ') as k from (select w, unnest(range(1, len(w) - 6)) as i from b where len(w) >= 8)),
 d as (select doc_id, string_split(text, ' ') as w from documents), x as (select doc_id, array_to_string(w[i : i + 7], ' ') as k from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from d where len(w) >= 8))
 select doc_id, count(distinct k)::bigint as n from x semi join s using (k) group by doc_id""")
def contamination_hits(t):
    # a document's distinct runs as 64-bit hashes; the benchmark's are broadcast only up to a count
    runs = lambda df, *keep: df.select(*keep, F.explode(F.array_distinct(F.transform(T.shingles(F.split("text", " "), 8), lambda k: F.xxhash64(k)))).alias("k"))
    wanted = runs(t.benchmark).distinct()
    wanted = F.broadcast(wanted) if wanted.limit(2_000_001).count() <= 2_000_000 else wanted
    return runs(t.documents, "doc_id").join(wanted, "k", "left_semi").groupBy("doc_id").agg(F.count("*").alias("n"))


# --- joins and reconciliation ---------------------------------------------------------------------------------------


@query("""with d as (select distinct o_orderpriority as p from orders), m as (select distinct o_orderdate as d from orders) select p, count(*)::bigint as n_missing from (select p, d from d cross join m except select distinct o_orderpriority, o_orderdate from orders) group by p""")
def missing_keys_grid(t):
    x = t.orders.select(F.col("o_orderdate").alias("d"), F.col("o_orderpriority").alias("p"))
    return R.missing_grid(x, "d", "p").groupBy("p").agg(F.count("*").alias("n_missing"))


@query("""select 'lineitem' as side, count(*)::bigint as n from lineitem anti join orders on l_orderkey = o_orderkey union all select 'orders', count(*) from orders anti join customer on o_custkey = c_custkey union all select 'customer', count(*) from customer anti join orders on o_custkey = c_custkey""")
def orphan_fk(t):
    parts = [("lineitem", t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")), ("orders", t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left_anti")), ("customer", t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left_anti"))]
    out = [x.agg(F.count("*").alias("n")).select(F.lit(k).alias("side"), "n") for k, x in parts]
    return out[0].union(out[1]).union(out[2])


@query("""with l as (select l_orderkey, count(*) as n, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) as total from lineitem group by 1)
 select o_orderstatus, count(*)::bigint as n, count(*) filter (l.n is null)::bigint as n_missing, count(*) filter (abs(total - o_totalprice) > 1)::bigint as n_off from orders left join l on l_orderkey = o_orderkey group by 1""")
def reconcile_totals(t):
    line = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("k"), F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("total"))
    x = t.orders.join(line, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return x.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count_if(F.col("k").isNull()).alias("n_missing"), F.count_if(F.abs(F.col("total") - F.col("o_totalprice")) > 1).alias("n_off"))


@query("""with s as (select unnest(range(1992, 2031)) as y), b as (select make_date(y, 1, 1)::timestamp as lo, make_date(y + 1, 1, 1)::timestamp as hi, y from s) select y::int as year, count(*)::bigint as n, round(sum(o_totalprice), 2) as total from orders join b on o_orderdate >= lo and o_orderdate < hi group by y""")
def range_join_buckets(t):
    years = t.spark.range(1992, 2032).select(F.col("id").cast("int").alias("year"), F.make_date("id", F.lit(1), F.lit(1)).cast("timestamp_ntz").alias("lo"))
    b = years.withColumn("hi", F.lead("lo").over(W.orderBy("lo"))).where("hi is not null")
    x = t.orders.join(F.broadcast(b), (F.col("o_orderdate") >= F.col("lo")) & (F.col("o_orderdate") < F.col("hi")))
    return x.groupBy("year").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""select n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, count(*)::bigint as n from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by n_name""")
def star_join_revenue(t):
    x = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    return x.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@query("select k as n_orders, count(*)::bigint as n from (select c_custkey, count(o_orderkey) as k from customer left join orders on o_custkey = c_custkey group by 1) group by k")
def left_join_counts(t):
    per = t.customer.select("c_custkey").join(t.orders.groupBy("o_custkey").agg(F.count("*").alias("k")), F.col("o_custkey") == F.col("c_custkey"), "left")
    return per.groupBy(F.coalesce("k", F.lit(0)).alias("n_orders")).agg(F.count("*").alias("n"))


@query("select r_name, count(*)::bigint as n, round(avg(s_acctbal), 4) as mean from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by r_name")
def broadcast_dim(t):
    dim = F.broadcast(t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name"))
    return t.supplier.join(dim, F.col("s_nationkey") == F.col("n_nationkey")).groupBy("r_name").agg(F.count("*").alias("n"), F.round(F.avg("s_acctbal"), 4).alias("mean"))


@query("""with e as (select event_id, user_id, ts from events where event_type = 'error'), p as (select user_id, ts, arg_max(event_id, event_id) as pid from events where event_type = 'purchase' group by 1, 2)
 select e.event_id, p.pid as asof_pid from e asof left join p on e.user_id = p.user_id and e.ts >= p.ts""")
def asof_purchase_before_error(t):
    e = t.events.where("event_type = 'error'").select("event_id", "user_id", "ts")
    p = t.events.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("pid"))
    return R.asof(e, p, "user_id", "ts", "pid", ["pid"]).select("event_id", "asof_pid")


@query("""with b as (select l_orderkey as o, l_partkey as p from lineitem group by all), n as (select count(distinct o) as n from b), s as (select p, count(*) as s from b group by p),
 pr as (select x.p as a, y.p as b, count(*) as k from b x join b y on x.o = y.o and x.p < y.p group by all)
 select a, b, k::bigint as support, round(k / sa.s, 6) as confidence, round(k * n.n / (sa.s * sb.s), 6) as lift from pr join s sa on sa.p = a join s sb on sb.p = b, n where k >= 2""")
def basket_lift(t):
    # dealt by order and then by pair, in as many tasks as the lines ask for: what a task counts doesn't grow with the table
    tasks = t.lineitem.count() // 150_000 + 1
    b = t.lineitem.select(F.col("l_orderkey").alias("o"), F.col("l_partkey").alias("p")).repartition(tasks, "o").distinct()
    n, s = b.agg(F.countDistinct("o").alias("n")), b.groupBy("p").agg(F.count("*").alias("s"))
    pairs = b.join(b.select("o", F.col("p").alias("q")), "o").where("p < q").select(F.col("p").alias("a"), F.col("q").alias("b"))
    pairs = pairs.repartition(tasks, "a", "b").groupBy("a", "b").agg(F.count("*").alias("k")).where("k >= 2")
    x = pairs.join(s.select(F.col("p").alias("a"), F.col("s").alias("sa")), "a").join(s.select(F.col("p").alias("b"), F.col("s").alias("sb")), "b").crossJoin(F.broadcast(n))
    return x.select("a", "b", F.col("k").alias("support"), F.round(F.col("k") / F.col("sa"), 6).alias("confidence"), F.round(F.col("k") * F.col("n") / (F.col("sa") * F.col("sb")), 6).alias("lift"))


# --- descriptive statistics -----------------------------------------------------------------------------------------


@query("select count(l_quantity)::bigint as n, round(avg(l_quantity), 6) as mean, round(stddev_samp(l_quantity), 6) as std, min(l_quantity) as least, quantile_cont(l_quantity, 0.25) as q1, quantile_cont(l_quantity, 0.5) as q2, quantile_cont(l_quantity, 0.75) as q3, max(l_quantity) as most from lineitem")
def numeric_summary(t):
    return R.describe(t.lineitem, "l_quantity").withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query("with q as (select quantile_cont(value, 0.25) as a, quantile_cont(value, 0.75) as b from events) select event_type, count(*)::bigint as n from events, q where value < a - 1.5 * (b - a) or value > b + 1.5 * (b - a) group by 1")
def iqr_outliers(t):
    x = t.events.select("event_type", "value").crossJoin(F.broadcast(R.fences(t.events, "value"))).where("value < lo or value > hi")
    return x.groupBy("event_type").agg(F.count("*").alias("n"))


@query("select event_type, round(skewness(value) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1.0)), 5) as skew, round(kurtosis_pop(value), 5) as kurt, round(var_pop(value), 5) as vp, round(var_samp(value), 5) as vs, round(stddev_samp(value) / avg(value), 6) as cv from events group by 1")
def skew_kurtosis(t):
    return t.events.groupBy("event_type").agg(F.round(F.skewness("value"), 5).alias("skew"), F.round(F.kurtosis("value"), 5).alias("kurt"), F.round(F.var_pop("value"), 5).alias("vp"), F.round(F.var_samp("value"), 5).alias("vs"), F.round(F.stddev_samp("value") / F.avg("value"), 6).alias("cv"))


@query("select round(corr(l_quantity, l_extendedprice), 8) as r from lineitem")
def corr_pearson(t):
    return t.lineitem.agg(F.round(F.corr("l_quantity", "l_extendedprice"), 8).alias("r"))


@query("with r as (select rank() over (order by l_quantity) + (count(*) over (partition by l_quantity) - 1) / 2 as a, rank() over (order by l_discount) + (count(*) over (partition by l_discount) - 1) / 2 as b from lineitem) select round(corr(a, b), 8) as rho from r")
def corr_spearman(t):
    x = R.mean_rank(t.lineitem.select("l_quantity", "l_discount"), "l_quantity").withColumnRenamed("rank", "a")
    return R.mean_rank(x, "l_discount").agg(F.round(F.corr("a", "rank"), 8).alias("rho"))


@query("select l_returnflag, round(var_samp(l_quantity), 6) as merged, round(var_samp(l_quantity), 6) as direct from lineitem group by 1")
def variance_partials_equal(t):
    q = F.col("l_quantity")
    part = t.lineitem.groupBy("l_returnflag", "l_linenumber").agg(F.count("*").alias("n"), F.sum(q).alias("s"), F.sum(q * q).alias("ss"), F.var_samp(q).alias("v"))
    merged = part.groupBy("l_returnflag").agg(F.round((F.sum("ss") - F.sum("s") * F.sum("s") / F.sum("n")) / (F.sum("n") - 1), 6).alias("merged"))
    return merged.join(t.lineitem.groupBy("l_returnflag").agg(F.round(F.var_samp(q), 6).alias("direct")), "l_returnflag")


@query("select user_id, count(*)::bigint as n, round(sum(value), 4) as total from events group by 1")
def salted_equals_plain(t):
    return R.salted_sum(t.events, "user_id", "value", "event_id").withColumn("total", F.round("total", 4))


@query("select o_custkey, round(sum(o_totalprice), 2) as total from orders group by 1 order by total desc, o_custkey limit 10")
def topn_customers_by_sum(t):
    return t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total")).orderBy(F.desc("total"), "o_custkey").limit(10)


@query("select event_type, count(value)::bigint as n, round(exp(avg(ln(value)) ), 6) as geo, round(count(value) / sum(1 / value), 6) as harm from events where value > 0 group by 1")
def other_means(t):
    x = t.events.where("value > 0")
    return x.groupBy("event_type").agg(F.count("value").alias("n"), F.round(F.exp(F.avg(F.log("value"))), 6).alias("geo"), F.round(F.count("value") / F.sum(1 / F.col("value")), 6).alias("harm"))


@query("with c as (select event_type, floor(value)::bigint as v, count(*) as n from events group by all) select event_type, v as mode, n::bigint as n from (select *, row_number() over (partition by event_type order by n desc, v) as r from c) where r = 1")
def mode_by_type(t):
    c = t.events.groupBy("event_type", F.floor("value").cast("long").alias("mode")).agg(F.count("*").alias("n"))
    return c.groupBy("event_type").agg(F.max(F.struct("n", (-F.col("mode")).alias("m"))).alias("x")).select("event_type", (-F.col("x.m")).alias("mode"), "x.n")


@query("select r_name, c_mktsegment, count(*)::bigint as n, round(sum(c_acctbal), 2) as bal from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by cube (r_name, c_mktsegment)")
def cube_revenue(t):
    x = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    return x.cube("r_name", "c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("bal"))


@query("select l_returnflag, l_linestatus, count(*)::bigint as n, round(sum(l_quantity), 2) as qty from lineitem group by rollup (l_returnflag, l_linestatus)")
def rollup_revenue(t):
    return t.lineitem.rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("select l_returnflag, round(avg(l_discount), 6) as grouped, (select round(avg(l_discount), 6) from lineitem) as pooled from lineitem group by 1")
def simpson_check(t):
    pooled = t.lineitem.agg(F.round(F.avg("l_discount"), 6).alias("pooled"))
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.avg("l_discount"), 6).alias("grouped")).crossJoin(F.broadcast(pooled))


# --- dedup, windows, time -------------------------------------------------------------------------------------------


@query("select count(*)::bigint as n, count(distinct text)::bigint as n_texts from documents")
def dedup_exact(t):
    kept = t.documents.select(F.sha2("text", 256).alias("h")).dropDuplicates()
    return t.documents.agg(F.count("*").alias("n")).crossJoin(kept.agg(F.count("*").alias("n_texts")))


@query("select user_id, event_type, event_id from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as r from events) where r = 1")
def dedup_subset_keep_latest(t):
    return t.events.groupBy("user_id", "event_type").agg(F.max(F.struct("ts", "event_id")).alias("x")).select("user_id", "event_type", "x.event_id")


_BY_USER = "over (partition by user_id order by ts, event_id"


def _recent(t, value, k):
    """Events with the values of a user's k events before them; a user of very many is dealt by day."""
    return R.with_recent(t.events.select("user_id", "ts", "event_id", "event_type", "value"), "user_id", ["ts", "event_id"], value, k)


def _mean(values):
    """Of an array's values that are not null; null if there are none."""
    some = F.filter(values, lambda v: v.isNotNull())
    return F.when(F.size(some) > 0, F.aggregate(some, F.lit(0.0), lambda a, v: a + v) / F.size(some))


def _median(values):
    """Of an array's values that are not null; null if there are none."""
    some = F.sort_array(F.filter(values, lambda v: v.isNotNull()))
    half = lambda k: F.get(some, F.floor((F.size(some) - k) / 2).cast("int"))
    return F.when(F.size(some) > 0, (half(1) + half(0)) / 2)


@query(f"select event_id, round(avg(value) {_BY_USER} rows between 3 preceding and 1 preceding), 6) as prior3 from events")
def rolling_avg(t):
    x = _recent(t, "value", 3)
    return x.select("event_id", F.round(_mean(F.col("recent")), 6).alias("prior3"))


@query(f"select event_id, round(value - lag(value) {_BY_USER}), 6) as d1, round(value - lag(value, 7) {_BY_USER}), 6) as d7 from events")
def lag_diff(t):
    x = _recent(t, "value", 7)
    back = lambda k: F.when(F.size("recent") >= k, F.get("recent", F.size("recent") - k))
    return x.select("event_id", F.round(F.col("value") - back(1), 6).alias("d1"), F.round(F.col("value") - back(7), 6).alias("d7"))


@query(f"select event_id, round(avg(value) {_BY_USER} rows between 4 preceding and current row), 6) as ma5, round(median(value) {_BY_USER} rows between 4 preceding and current row), 6) as med5 from events")
def moving_average(t):
    x = _recent(t, "value", 4).select("event_id", F.concat("recent", F.array("value")).alias("v"))
    return x.select("event_id", F.round(_mean(F.col("v")), 6).alias("ma5"), F.round(_median(F.col("v")), 6).alias("med5"))


@query("""with o as (select user_id, value, row_number() over (partition by user_id order by ts, event_id) as i, count(*) over (partition by user_id) as n, first_value(value) over (partition by user_id order by ts, event_id) as x from events) select user_id, round(sum(0.3 * pow(0.7, n - i) * value) + max(pow(0.7, n) * x), 5) as level from o group by 1""")
def ewma(t):
    """Exponential smoothing (0.3) of each user's values in order of time."""
    return R.smoothed(t.events, "user_id", ["ts", "event_id"], "value", 0.3).select("user_id", F.round("level", 5).alias("level"))


@query("select event_id, round(value - avg(value) over (partition by user_id), 3) as off from events")
def person_baseline(t):
    return t.events.select("event_id", F.round(F.col("value") - F.avg("value").over(W.partitionBy("user_id")), 3).alias("off"))


@query(f"select event_id, last_value(case when event_type = 'purchase' then value end ignore nulls) {_BY_USER} rows between 5 preceding and current row) as filled, event_type <> 'purchase' as was_missing from events")
def bounded_fill(t):
    v = F.when(F.col("event_type") == "purchase", F.col("value"))
    x = R.with_recent(t.events.select("user_id", "ts", "event_id", "event_type", v.alias("v")), "user_id", ["ts", "event_id"], "v", 5)
    known = F.filter(F.concat("recent", F.array("v")), lambda a: a.isNotNull())
    return x.select("event_id", F.when(F.size(known) > 0, F.get(known, F.size(known) - 1)).alias("filled"), (F.col("event_type") != "purchase").alias("was_missing"))


@query("""with d as (select distinct user_id, ts::date as d from events), g as (select user_id, d, d - (row_number() over (partition by user_id order by d))::int as island from d) select user_id, min(d) as first, max(d) as last, count(*)::bigint as days from g group by user_id, island having count(*) >= 2""")
def day_islands(t):
    d = t.events.select("user_id", F.to_date("ts").alias("d")).distinct()
    g = d.withColumn("island", F.date_sub("d", F.row_number().over(W.partitionBy("user_id").orderBy("d"))))
    return g.groupBy("user_id", "island").agg(F.min("d").alias("first"), F.max("d").alias("last"), F.count("*").alias("days")).where("days >= 2").drop("island")


@query("select event_type, count(*) filter (ts < timestamp '2024-01-15')::bigint as before, count(*) filter (ts >= timestamp '2024-01-15')::bigint as after from events group by 1")
def time_cutoff_split_counts(t):
    cut = F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00"))
    return t.events.groupBy("event_type").agg(F.count_if(F.col("ts") < cut).alias("before"), F.count_if(F.col("ts") >= cut).alias("after"))


@query("select event_type, time_bucket(interval '1 hour', ts) as start, count(*)::bigint as n, round(sum(value), 4) as total from events group by all")
def tumbling_counts(t):
    x = t.events.groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return x.select("event_type", F.col("w.start").alias("start"), "n", "total")


@query("""with s as (select time_bucket(interval '30 minutes', ts) - to_minutes(30 * k) as start, value from events, (select unnest(range(0, 2)) as k)) select start, count(*)::bigint as n, round(avg(value), 6) as mean from s group by start""")
def sliding_avg(t):
    x = t.events.groupBy(F.window("ts", "1 hour", "30 minutes").alias("w")).agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"))
    return x.select(F.col("w.start").alias("start"), "n", "mean")


@query("""with o as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval '6 hours' then 0 else 1 end as new from events), g as (select user_id, ts, sum(new) over (partition by user_id order by ts range unbounded preceding) as s from o)
 select user_id, min(ts) as start, count(*)::bigint as n from g group by user_id, s""")
def session_counts(t):
    x = t.events.groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n"))
    return x.select("user_id", F.col("w.start").alias("start"), "n")


# --- privacy, quality, encoding, scaling ----------------------------------------------------------------------------


@query("select count(*) filter (null_value)::bigint as n_value, round(avg(null_value::int), 6) as rate, case when avg(null_value::int) < 0.05 then 'fill' when avg(null_value::int) <= 0.5 then 'model' else 'drop' end as policy from (select event_type = 'error' or value is null as null_value from events)")
def missing_rate(t):
    v = F.when(F.col("event_type") != "error", F.col("value"))
    x = t.events.agg(F.count_if(v.isNull()).alias("n_value"), F.avg(v.isNull().cast("int")).alias("rate"))
    return x.select("n_value", F.round("rate", 6).alias("rate"), F.when(F.col("rate") < 0.05, "fill").when(F.col("rate") <= 0.5, "model").otherwise("drop").alias("policy"))


@query("select c_nationkey, c_mktsegment, floor(c_acctbal / 1000)::bigint as band, count(*)::bigint as n from customer group by all having count(*) < 5")
def kanon_violations(t):
    return t.customer.groupBy("c_nationkey", "c_mktsegment", F.floor(F.col("c_acctbal") / 1000).cast("long").alias("band")).agg(F.count("*").alias("n")).where("n < 5")


@query("select c_nationkey, c_mktsegment, case when count(*) >= 10 then count(*)::bigint end as n from customer group by all")
def small_cell_suppression(t):
    x = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    return x.withColumn("n", F.when(F.col("n") >= 10, F.col("n")))


@query("select year(o_orderdate)::int as year, left(o_orderpriority, 1) as p, sha256(o_orderstatus) as s, floor(o_totalprice / 50000)::bigint as band, count(*)::bigint as n from orders group by all")
def generalised_dates(t):
    return t.orders.groupBy(F.year("o_orderdate").alias("year"), F.substring("o_orderpriority", 1, 1).alias("p"), F.sha2("o_orderstatus", 256).alias("s"), F.floor(F.col("o_totalprice") / 50000).cast("long").alias("band")).agg(F.count("*").alias("n"))


@query("with s as (select avg(p_retailprice) as m, stddev_pop(p_retailprice) as d, min(p_retailprice) as lo, max(p_retailprice) as hi, quantile_cont(p_retailprice, 0.5) as q2, quantile_cont(p_retailprice, 0.75) - quantile_cont(p_retailprice, 0.25) as iqr from part) select p_partkey, round((p_retailprice - m) / d, 6) as z, round((p_retailprice - lo) / (hi - lo), 6) as unit, round((p_retailprice - q2) / iqr, 6) as robust, round(ln(1 + p_retailprice), 6) as log1p from part, s")
def scaling(t):
    p = F.col("p_retailprice")
    s = t.part.agg(F.avg(p).alias("m"), F.stddev_pop(p).alias("d"), F.min(p).alias("lo"), F.max(p).alias("hi"), F.lit(0).alias("x"))
    s = s.crossJoin(M.exact_quantiles(t.part, "p_retailprice", [0.25, 0.5, 0.75], ["q1", "q2", "q3"]))  # a row each
    x = t.part.select("p_partkey", p).crossJoin(F.broadcast(s))
    return x.select("p_partkey", F.round((p - F.col("m")) / F.col("d"), 6).alias("z"), F.round((p - F.col("lo")) / (F.col("hi") - F.col("lo")), 6).alias("unit"), F.round((p - F.col("q2")) / (F.col("q3") - F.col("q1")), 6).alias("robust"), F.round(F.log1p(p), 6).alias("log1p"))


@query("select p_brand, ntile(4) over (partition by p_brand order by p_retailprice, p_partkey)::int as q, p_partkey from part")
def bins_ntile(t):
    return R.ntiles(t.part.select("p_brand", "p_retailprice", "p_partkey"), "p_brand", ["p_retailprice", "p_partkey"], 4, "q").select("p_brand", "q", "p_partkey")


@query("select floor(c_acctbal / 1000)::bigint as x, floor(c_custkey / 100)::bigint as y, count(*)::bigint as n from customer group by all")
def grid_bins(t):
    return t.customer.groupBy(F.floor(F.col("c_acctbal") / 1000).cast("long").alias("x"), F.floor(F.col("c_custkey") / 100).cast("long").alias("y")).agg(F.count("*").alias("n"))


@query("select o_orderkey, (o_orderstatus = 'O')::int as s_o, (o_orderstatus = 'F')::int as s_f, (o_orderstatus = 'P')::int as s_p from orders")
def one_hot(t):
    return t.orders.select("o_orderkey", *((F.col("o_orderstatus") == k).cast("int").alias(f"s_{k.lower()}") for k in "OFP"))


@query("select p_partkey, (count(*) over (partition by p_brand))::bigint as freq, round(count(*) over (partition by p_brand) / (select count(*) from part), 6) as share from part")
def frequency_encode(t):
    n, all_ = t.part.groupBy("p_brand").agg(F.count("*").alias("freq")), t.part.agg(F.count("*").alias("t"))
    return t.part.select("p_partkey", "p_brand").join(n, "p_brand").crossJoin(F.broadcast(all_)).select("p_partkey", "freq", F.round(F.col("freq") / F.col("t"), 6).alias("share"))


@query("select l_linestatus, m as metric, round(sum(v), 2) as total from (select l_linestatus, unnest(['qty', 'price', 'tax']) as m, unnest([l_quantity, l_extendedprice, l_tax]) as v from lineitem) group by all")
def unpivot_metrics(t):
    x = t.lineitem.select("l_linestatus", F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"), F.col("l_tax").alias("tax")).unpivot("l_linestatus", ["qty", "price", "tax"], "metric", "v")
    return x.groupBy("l_linestatus", "metric").agg(F.round(F.sum("v"), 2).alias("total"))


@query("select user_id, count(*) filter (event_type = 'purchase')::bigint as purchase, count(*) filter (event_type = 'error')::bigint as error from events group by 1")
def pivot_counts(t):
    return t.events.groupBy("user_id").pivot("event_type", ["purchase", "error"]).count().na.fill(0, ["purchase", "error"])


@query("select count(*) filter (doc_id is null)::bigint as null_keys, (count(*) - count(distinct doc_id))::bigint as repeated_keys, count(*) filter (not regexp_matches(source, '^src[0-9]+$'))::bigint as invalid_source, count(*) filter (n_chars <> length(text))::bigint as wrong_length from documents")
def quality_dimensions(t):
    return t.documents.agg(F.count_if(F.col("doc_id").isNull()).alias("null_keys"), (F.count("*") - F.countDistinct("doc_id")).alias("repeated_keys"), F.count_if(~F.col("source").rlike("^src[0-9]+$")).alias("invalid_source"), F.count_if(F.col("n_chars") != F.length("text")).alias("wrong_length"))


@query("select props, json_extract_string(props, '$.k')::bigint as k from (select distinct props from events)")
def nested_json(t):
    return t.events.select("props").distinct().select("props", F.get_json_object("props", "$.k").cast("long").alias("k"))


# --- metrics, drift, ranking ----------------------------------------------------------------------------------------

_P = "case when b = 0 then 0 else a / b end"


@query("""with c as (select lang, count(*) filter (n_chars > 500 and quality = 1) as tp, count(*) filter (n_chars > 500 and quality = 0) as fp, count(*) filter (n_chars <= 500 and quality = 1) as fn, count(*) filter (n_chars <= 500 and quality = 0) as tn from documents join labels using (doc_id) group by lang)
 select lang, tp::bigint as tp, fp::bigint as fp, fn::bigint as fn, tn::bigint as tn, round(case when tp + fp = 0 then 0 else tp / (tp + fp) end, 6) as precision, round(case when tp + fn = 0 then 0 else tp / (tp + fn) end, 6) as recall, round(case when 2 * tp + fp + fn = 0 then 0 else 2 * tp / (2 * tp + fp + fn) end, 6) as f1, round(case when tn + fp = 0 then 0 else tn / (tn + fp) end, 6) as specificity from c""")
def quality_confusion(t):
    x = t.documents.select("doc_id", "lang", "n_chars").join(t.labels, "doc_id")
    c = x.groupBy("lang").agg(*R.confusion(F.col("n_chars") > 500, F.col("quality") == 1))
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    return c.select("lang", "tp", "fp", "fn", "tn", F.round(R.ratio(tp, tp + fp), 6).alias("precision"), F.round(R.ratio(tp, tp + fn), 6).alias("recall"), F.round(R.ratio(2 * tp, 2 * tp + fp + fn), 6).alias("f1"), F.round(R.ratio(tn, tn + fp), 6).alias("specificity"))


@query("""with x as (select n_chars > 500 as p, quality = 1 as y, lang from documents join labels using (doc_id)) select lang, round(avg(p::int), 6) as positive_rate, round(count(*) filter (p and y) / nullif(count(*) filter (y), 0), 6) as tpr, round(count(*) filter (p and not y) / nullif(count(*) filter (not y), 0), 6) as fpr from x group by lang""")
def parity_by_lang(t):
    x = t.documents.select("doc_id", "lang", "n_chars").join(t.labels, "doc_id").select("lang", (F.col("n_chars") > 500).alias("p"), (F.col("quality") == 1).alias("y"))
    over = lambda a, b: F.when(F.count_if(b) > 0, F.count_if(a & b) / F.count_if(b))
    return x.groupBy("lang").agg(F.round(F.avg(F.col("p").cast("int")), 6).alias("positive_rate"), F.round(over(F.col("p"), F.col("y")), 6).alias("tpr"), F.round(over(F.col("p"), ~F.col("y")), 6).alias("fpr"))


@query("""with x as (select n_chars, quality, rank() over (order by n_chars) + (count(*) over (partition by n_chars) - 1) / 2 as r from documents join labels using (doc_id)), a as (select sum(r) filter (quality = 1) as s, count(*) filter (quality = 1) as p, count(*) filter (quality = 0) as n from x) select round((s - p * (p + 1) / 2) / (p * n), 8) as auc from a""")
def auc_from_scores(t):
    x = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id")
    return R.auc(x, "n_chars", "quality").select(F.round("auc", 8).alias("auc"))


@query("""with c as (select floor(value / 20) as b, count(*) filter (ts < timestamp '2024-01-15') as e, count(*) filter (ts >= timestamp '2024-01-15') as a from events group by 1), s as (select sum(e) as te, sum(a) as ta from c), x as (select greatest(e, 0.5) / te as pe, greatest(a, 0.5) / ta as pa from c, s) select round(sum((pa - pe) * ln(pa / pe)), 8) as psi from x""")
def psi_halves(t):
    early = F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00"))
    return R.psi(t.events, F.floor(F.col("value") / 20), early).select(F.round("psi", 8).alias("psi"))


@query("""with v as (select value, count(*) filter (ts < timestamp '2024-01-15') as e, count(*) filter (ts >= timestamp '2024-01-15') as a from events group by 1), s as (select sum(e) over (order by value) / sum(e) over () as fe, sum(a) over (order by value) / sum(a) over () as fa from v) select round(max(abs(fe - fa)), 8) as ks from s""")
def ks_two_sample(t):
    early = F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00"))
    v = t.events.groupBy("value").agg(F.count_if(early).alias("e"), F.count_if(~early).alias("a"))
    total = v.agg(F.sum("e").alias("te"), F.sum("a").alias("ta"))
    s = R.running_total(v, "value", ["e", "a"]).select(F.col("upto_e").alias("e"), F.col("upto_a").alias("a")).crossJoin(F.broadcast(total))
    return s.agg(F.round(F.max(F.abs(F.col("e") / F.col("te") - F.col("a") / F.col("ta"))), 8).alias("ks"))


@query("""with c as (select least(floor(n_chars / 1000), 5)::bigint as bin, count(*) filter (quality = 1) + 0.5 as g, count(*) filter (quality = 0) + 0.5 as b from documents join labels using (doc_id) group by 1), s as (select sum(g) as tg, sum(b) as tb from c) select bin, round(ln((g / tg) / (b / tb)), 6) as woe, round((g / tg - b / tb) * ln((g / tg) / (b / tb)), 6) as iv from c, s""")
def woe_iv(t):
    x = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id")
    c = x.groupBy(F.least(F.floor(F.col("n_chars") / 1000), F.lit(5)).cast("long").alias("bin")).agg((F.count_if(F.col("quality") == 1) + 0.5).alias("g"), (F.count_if(F.col("quality") == 0) + 0.5).alias("b"))
    c = c.crossJoin(F.broadcast(c.agg(F.sum("g").alias("tg"), F.sum("b").alias("tb"))))
    g, b = F.col("g") / F.col("tg"), F.col("b") / F.col("tb")
    return c.select("bin", F.round(F.log(g / b), 6).alias("woe"), F.round((g - b) * F.log(g / b), 6).alias("iv"))


@query("with c as (select o_orderstatus, o_orderpriority, count(*) as n from orders group by all), p as (select o_orderstatus, n / sum(n) over (partition by o_orderstatus) as p from c) select o_orderstatus, round(1 - sum(p * p), 8) as gini, round(-sum(p * log2(p)), 8) as entropy from p group by 1")
def gini_entropy(t):
    c = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    p = c.withColumn("p", F.col("n") / F.sum("n").over(W.partitionBy("o_orderstatus")))
    return p.groupBy("o_orderstatus").agg(F.round(1 - F.sum(F.col("p") * F.col("p")), 8).alias("gini"), F.round(-F.sum(F.col("p") * F.log2("p")), 8).alias("entropy"))


@query("with x as (select l_extendedprice as y, l_quantity * 1000 as f from lineitem), m as (select avg(y) as m from x) select round(avg(abs(y - f)), 4) as mae, round(sqrt(avg((y - f) ** 2)), 4) as rmse, round(avg(abs((y - f) / nullif(y, 0))), 6) as mape, round(1 - sum((y - f) ** 2) / sum((y - m) ** 2), 6) as r2 from x, m")
def regression_metrics(t):
    x = t.lineitem.select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1000).alias("f")).crossJoin(F.broadcast(t.lineitem.agg(F.avg("l_extendedprice").alias("m"))))
    d = F.col("y") - F.col("f")
    return x.agg(F.round(F.avg(F.abs(d)), 4).alias("mae"), F.round(F.sqrt(F.avg(d * d)), 4).alias("rmse"), F.round(F.avg(F.abs(d / F.nullif(F.col("y"), F.lit(0.0)))), 6).alias("mape"), F.round(1 - F.sum(d * d) / F.sum(F.pow(F.col("y") - F.col("m"), 2)), 6).alias("r2"))


_COS = "list_cosine_similarity(e.embedding::double[], q.embedding::double[])"


@query(f"""with q as (select vec_id, embedding from embeddings where vec_id % 50 = 0), s as (select q.vec_id as q, e.vec_id as v, round({_COS}, 6) as sim from q, embeddings e where e.vec_id <> q.vec_id) select q, v, sim from (select *, row_number() over (partition by q order by sim desc, v) as r from s) where r <= 5""")
def cosine_topk(t):
    """The five nearest vectors of every row whose id is divisible by 50, against all rows, in blocks of both."""
    return R.nearest(t.embeddings, t.embeddings.where("vec_id % 50 = 0"), "vec_id", "embedding", 5).select("q", "v", "sim")


@query("""with a as (select o_custkey as k, row_number() over (order by sum(o_totalprice) desc, o_custkey) as r from orders group by 1), b as (select o_custkey as k, row_number() over (order by count(*) desc, o_custkey) as r from orders group by 1)
 select k, round(sum(1 / (60 + r)), 8) as rrf from (select * from a where r <= 50 union all select * from b where r <= 50) group by k""")
def rrf_fusion(t):
    per = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.sum("o_totalprice").alias("s"), F.count("*").alias("n"))
    ranks = [per.orderBy(F.desc(c), "k").limit(50).select("k", F.row_number().over(W.orderBy(F.desc(c), "k")).alias("r")) for c in ("s", "n")]
    return ranks[0].union(ranks[1]).groupBy("k").agg(F.round(F.sum(1 / (60 + F.col("r"))), 8).alias("rrf"))


@query("select p_partkey, round(-p_retailprice / 20 + p_size / 1.05 + p_size / pow(1.05, 2) + p_size / pow(1.05, 3), 6) as npv from part")
def npv_ladder(t):
    """Net present value of parts taken as investments that pay their size for three years, at 5 %."""
    flows = F.concat(F.array(-F.col("p_retailprice") / 20), F.array_repeat(F.col("p_size").cast("double"), 3))
    return t.part.select("p_partkey", F.round(F.aggregate(F.transform(flows, lambda v, k: v / F.pow(F.lit(1.05), k)), F.lit(0.0), lambda s, v: s + v), 6).alias("npv"))


@query("""select a.p_partkey as a, b.p_partkey as b, round(greatest(least(a.p_size + 10.0, b.p_size + 10.0) - greatest(a.p_size, b.p_size), 0) / (20.0 - greatest(least(a.p_size + 10.0, b.p_size + 10.0) - greatest(a.p_size, b.p_size), 0)), 6) as iou from part a join part b on b.p_partkey = a.p_partkey + 1""")
def iou_pairs(t):
    a = t.part.select(F.col("p_partkey").alias("a"), F.col("p_size").cast("double").alias("x"))
    b = t.part.select(F.col("p_partkey").alias("b"), F.col("p_size").cast("double").alias("y"), (F.col("p_partkey") - 1).alias("a"))
    one, zero = F.lit(1.0), F.lit(0.0)
    return a.join(b, "a").select("a", "b", F.round(T.iou([F.col("x"), zero, F.col("x") + 10, one], [F.col("y"), zero, F.col("y") + 10, one]), 6).alias("iou"))


# --- sketches and samples (bounds, not values) ----------------------------------------------------------------------


@query("select true as within")
def approx_distinct_bound(t):
    x = t.events.agg(F.approx_count_distinct("user_id", 0.02).alias("a"), F.countDistinct("user_id").alias("n"), F.hll_sketch_estimate(F.hll_sketch_agg("user_id")).alias("h"))
    return x.select(((F.abs(F.col("a") - F.col("n")) <= 0.1 * F.col("n")) & (F.abs(F.col("h") - F.col("n")) <= 0.1 * F.col("n"))).alias("within"))


@query("select true as within")
def approx_quantile_bound(t):
    x = t.events.agg(F.percentile_approx("value", 0.5, 1000).alias("a"))
    return t.events.crossJoin(F.broadcast(x)).agg((F.abs(F.avg((F.col("value") <= F.col("a")).cast("int")) - 0.5) <= 0.01).alias("within"))


@query("select count(*)::bigint as n, 5::bigint as folds from events")
def group_folds(t):
    x = R.folds(t.events, "user_id", 5)
    per = x.groupBy("user_id").agg(F.countDistinct("fold").alias("k"), F.count("*").alias("n"))
    return per.agg(F.sum("n").alias("n"), F.when(F.max("k") == 1, 5).cast("long").alias("folds"))


# --- structure and streams (checked in tests, or against SQL where it can say them) --------------------------------------


@query(f"with {_LINES}, x as (select doc_id, line, lead(line) over (partition by doc_id order by line_no) as nxt from l) select doc_id, count(*) filter (length(line) >= 40 and not regexp_matches(line, '[.!?:]$') and nxt <> '')::bigint as n_open from x group by doc_id")
def residual_wraps(t):
    x = C.lines(t.documents).withColumn("nxt", F.lead("line").over(W.partitionBy("doc_id").orderBy("line_no")))
    return x.groupBy("doc_id").agg(F.count_if((F.length("line") >= 40) & ~F.col("line").rlike("[.!?:]$") & (F.col("nxt") != "")).alias("n_open"))


@query(r"""with l as (select doc_id, list_transform(string_split(text, chr(10)), lambda x: {'done': '', 'line': x, 'last': x, 'n': 0}) as l from documents),
 u as (select doc_id, list_reduce(l, lambda a, x: case when x.line <> '' and length(a.last) >= 40 and not regexp_matches(a.last, '[.!?:。！？：]$') and not regexp_matches(x.line, '^(\s|[-*+>#|]|[0-9]+[.)]|```)')
   then {'done': a.done, 'line': a.line || case when regexp_matches(a.line, '[A-Za-z0-9,;]$') and regexp_matches(x.line, '^[A-Za-z0-9]') then ' ' else '' end || x.line, 'last': x.last, 'n': a.n + 1}
   else {'done': a.done || a.line || chr(10), 'line': x.line, 'last': x.last, 'n': a.n} end) as u from l)
 select doc_id, sha256(u.done || u.line) as sha256, u.n::bigint as n_merged from u""")
def unwrapped_documents(t):
    return S.unwrap(t.documents.select("doc_id", "text")).select("doc_id", F.sha2("text", 256).alias("sha256"), "n_merged")


@query(r"with x as (select doc_id, unnest(regexp_extract_all(text, '" + T.EMAIL + r"')) as found from documents) select found, count(*)::bigint as n, count(distinct doc_id)::bigint as n_docs from x group by found")
def located_emails(t):
    found = S.find_all(t.documents.where(F.col("text").contains("@")), T.EMAIL, "email")
    return found.groupBy("found").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_docs"))


@query("select doc_id, sha256(text) as sha256, strlen(text)::bigint as n_bytes, length(text)::bigint as n_chars, len(string_split(text, chr(10)))::bigint as n_lines from documents")
def document_manifest(t):
    return K.manifest(t.documents)


@query("select conv_id, string_agg(role || ': ' || text, chr(10) order by turn) as text from conversations group by conv_id")
def rendered_conversations(t):
    x = t.conversations.select(F.col("conv_id").alias("doc_id"), "turn", F.concat("role", F.lit(": "), "text").alias("line"))
    return K.render(x, "turn").select(F.col("doc_id").alias("conv_id"), "text")


@query("select event_type, time_bucket(interval '1 hour', ts) as start, count(*)::bigint as n, round(sum(value), 4) as total from events group by all")
def stream_equals_batch(t):
    """The windowed counts of a file stream drained to its end."""
    got = E.drain(E.tumbling(E.event_stream(t.spark, f"{t.sf_dir}/events.parque[t]"), late="3650 days"), "complete")
    return got.select("event_type", F.col("start").cast("timestamp_ntz").alias("start"), "n", "total")


@query("select doc_id, i::bigint as chunk, substring(text, (i * 400 + 1)::int, 500) as piece from (select doc_id, text, unnest(range(0, greatest(1, ceil((length(text) - 100) / 400.0))::int)) as i from documents)")
def overlapping_chunks(t):
    n = F.greatest(F.ceil((F.length("text") - 100) / 400), F.lit(1))
    x = t.documents.select("doc_id", "text", F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))).alias("i"))
    return x.select("doc_id", F.col("i").cast("long").alias("chunk"), F.substring("text", F.col("i") * 400 + 1, F.lit(500)).alias("piece"))


@query("select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as sum_qty, round(sum(l_extendedprice), 2) as sum_base, round(sum(l_extendedprice * (1 - l_discount)), 2) as sum_disc, round(avg(l_quantity), 6) as avg_qty, count(*)::bigint as n from lineitem where l_shipdate <= timestamp '1998-09-02' group by all")
def pricing_summary(t):
    x = t.lineitem.where(F.col("l_shipdate") <= F.to_timestamp_ntz(F.lit("1998-09-02 00:00:00")))
    return x.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc"), F.round(F.avg("l_quantity"), 6).alias("avg_qty"), F.count("*").alias("n"))


@query("""with e as (select user_id, event_type, value, row_number() over (partition by event_type order by event_id) % 5 as fold from events), m as (select event_type, fold, sum(value) as s, count(*) as n from e group by all), a as (select event_type, sum(s) as s, sum(n) as n from m group by 1)
 select event_type, fold::int as fold, round((a.s - m.s) / (a.n - m.n), 8) as out_of_fold_mean from m join a using (event_type) where a.n > m.n""")
def target_encoding(t):
    f = R.dealt_ranks(t.events.select("event_type", "event_id", "value"), "event_type", ["event_id"]).withColumn("fold", (F.col("rank") % 5).cast("int"))
    m = f.groupBy("event_type", "fold").agg(F.sum("value").alias("s"), F.count("*").alias("n"))
    a = m.groupBy("event_type").agg(F.sum("s").alias("ts"), F.sum("n").alias("tn"))
    return m.join(a, "event_type").where("tn > n").select("event_type", "fold", F.round((F.col("ts") - F.col("s")) / (F.col("tn") - F.col("n")), 8).alias("out_of_fold_mean"))


@query("""select c_custkey, (select count(*) from orders where o_custkey = c_custkey)::bigint as n_orders from customer where exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F')""")
def semi_join_exists(t):
    n = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.bool_or(F.col("o_orderstatus") == "F").alias("any_f")).where("any_f")
    return t.customer.join(n, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "n_orders")


@query("""with f as (select distinct o_custkey as a, l_suppkey as b from orders join lineitem on l_orderkey = o_orderkey), h as (select distinct a, s_nationkey as nation from f join supplier on s_suppkey = b) select a as c_custkey, count(*)::bigint as n_nations from h group by a""")
def two_hop_reach(t):
    f = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("a"), F.col("l_suppkey").alias("b")).distinct()
    h = f.join(t.supplier, F.col("s_suppkey") == F.col("b")).select("a", "s_nationkey").distinct()
    return h.groupBy(F.col("a").alias("c_custkey")).agg(F.count("*").alias("n_nations"))


@query("""with a as (select o_custkey as k, o_orderkey as a, row_number() over (partition by o_custkey order by o_orderkey) as r from orders where o_orderstatus = 'F'), b as (select o_custkey as k, o_orderkey as b, row_number() over (partition by o_custkey order by o_orderkey) as r from orders where o_orderstatus <> 'F')
 select k as o_custkey, r::int as k, a, b from a full join b using (k, r)""")
def ordinal_pairs(t):
    f = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    return V.ordinal_join(f.where("o_orderstatus = 'F'"), f.where("o_orderstatus <> 'F'"), "o_custkey", "o_orderkey", "o_orderkey")


@query(f"with {_LINES}, x as (select case when starts_with(line, 'Licensed under CC ') then 'Licensed under CC' when starts_with(line, 'Licensed under ') then 'Licensed under' when starts_with(line, 'The ') then 'The' end as label from l) select label, count(*)::bigint as n from x group by label")
def longest_prefix(t):
    x = V.best_prefix(C.lines(t.documents), ["The", "Licensed under", "Licensed under CC"])
    return x.groupBy("label").agg(F.count("*").alias("n"))


@query("""with x as (select conv_id, turn, role, text, count(*) filter (role = 'user') over (partition by conv_id order by turn rows unbounded preceding) as r from conversations)
 select conv_id, r::bigint as row, sha256(string_agg(text, ' ' order by turn)) as sha256 from x group by all""")
def folded_turns(t):
    x = t.conversations.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("line_no"), F.col("text").alias("line"), "role")
    f = V.fold_labelled(x, F.when(F.col("role") == "user", F.lit("user")))
    return f.select(F.col("doc_id").alias("conv_id"), "row", F.sha2("text", 256).alias("sha256"))


@query("select conv_id, turn, role, lag(role) over (partition by conv_id order by turn) is distinct from role as opens from conversations")
def role_changes(t):
    return V.section_headers(t.conversations.select("conv_id", "turn", "role"), "conv_id", "turn", "role")


@query(f"with {_LINES}, x as (select doc_id, line, lead(line) over (partition by doc_id order by line_no) as nxt from l) select doc_id, (count(*) + count(*) filter (regexp_matches(line, '[.!?]$') and regexp_matches(nxt, '[.!?]$')))::bigint as n from x group by doc_id")
def paragraph_breaks(t):
    return V.paragraph_breaks(C.lines(t.documents)).groupBy("doc_id").agg(F.count("*").alias("n"))


@query("""with a as (select l_shipdate::date as d, count(*) as n from lineitem group by 1), b as (select o_orderdate::date as d, count(*) as n from orders group by 1) select a.d, (greatest(a.n - 1, 0) - coalesce(b.n, 0))::bigint as n from a left join b using (d) where greatest(a.n - 1, 0) - coalesce(b.n, 0) > 0""")
def adjusted_multiset(t):
    a, b = t.lineitem.select(F.to_date("l_shipdate").alias("d")), t.orders.select(F.to_date("o_orderdate").alias("d"))
    return V.adjusted_difference(a, b, a.distinct().withColumn("times", F.lit(1)), "d")


@query("""with d as (select doc_id, regexp_replace(text, '[0-9]+', '#', 'g') as a from documents), e as (select doc_id, a, regexp_replace(a, '  +', ' ', 'g') as b from d) select doc_id, sha256(e.b) as sha256, ((e.a <> documents.text)::int + (e.b <> e.a)::int)::int as n_changes from e join documents using (doc_id)""")
def ordered_rewrites(t):
    x = V.replace_all(t.documents.select("doc_id", "text"), [("digits", "[0-9]+", "#"), ("spaces", "  +", " ")])
    return x.select("doc_id", F.sha2("text", 256).alias("sha256"), F.size("log").alias("n_changes"))


@query("""with c as (select l_linenumber as x, l_tax as y, count(*) as n from lineitem group by all) select round(2 * sum(sign(b.y - a.y) * a.n * b.n) / ((select count(*) from lineitem) * ((select count(*) from lineitem) - 1.0)), 8) as tau from c a join c b on a.x < b.x""")
def kendall_tau(t):
    return N.kendall(t.lineitem, "l_linenumber", "l_tax").select(F.round("tau", 8).alias("tau"))


@query("""with n as (select conv_id, turn, role, lead(role) over (partition by conv_id order by turn) as nxt from conversations) select nxt, count(*) filter (role = 'user')::bigint as after_user, count(*) filter (role = 'system')::bigint as after_system, count(*)::bigint as n from n group by nxt""")
def next_turn_counts(t):
    x = t.conversations.withColumn("nxt", F.lead("role").over(W.partitionBy("conv_id").orderBy("turn")))
    return x.groupBy("nxt").agg(F.count_if(F.col("role") == "user").alias("after_user"), F.count_if(F.col("role") == "system").alias("after_system"), F.count("*").alias("n"))


@query("""with v as (select c_nationkey, count(*) as n, avg(c_acctbal) as m, var_samp(c_acctbal) as s from customer group by 1), a as (select avg(c_acctbal) as m0 from customer) select c_nationkey, round((m - m0) / sqrt(s / n), 6) as t from v, a where n > 1 and s > 0""")
def t_statistics(t):
    v = t.customer.groupBy("c_nationkey").agg(F.count("*").alias("n"), F.avg("c_acctbal").alias("m"), F.var_samp("c_acctbal").alias("s")).where("n > 1 and s > 0")
    return v.crossJoin(F.broadcast(t.customer.agg(F.avg("c_acctbal").alias("m0")))).select("c_nationkey", F.round((F.col("m") - F.col("m0")) / F.sqrt(F.col("s") / F.col("n")), 6).alias("t"))


@query("""with o as (select o_orderstatus as a, o_orderpriority as b, count(*) as n from orders group by all), r as (select a, sum(n) as ra from o group by a), c as (select b, sum(n) as cb from o group by b), t as (select sum(n) as t from o)
 select round(sum((coalesce(n, 0) - ra * cb / t) ** 2 / (ra * cb / t)), 6) as chi2 from r cross join c cross join t left join o using (a, b)""")
def chi_square(t):
    o = t.orders.groupBy(F.col("o_orderstatus").alias("a"), F.col("o_orderpriority").alias("b")).agg(F.count("*").alias("n"))
    # n * (sum of n_ij^2 / (r_i * c_j) - 1): only cells that occur, so no grid of all pairs
    r, c, all_ = o.groupBy("a").agg(F.sum("n").alias("ra")), o.groupBy("b").agg(F.sum("n").alias("cb")), o.agg(F.sum("n").alias("t"))
    share = o.join(r, "a").join(c, "b").agg(F.sum(F.col("n") * F.col("n") / (F.col("ra") * F.col("cb"))).alias("s"))
    return share.crossJoin(all_).select(F.round(F.col("t") * (F.col("s") - 1), 6).alias("chi2"))


@query("""with k as (select k, (l.l ** k) * exp(-l.l) / factorial(k::int) as p from (select unnest(range(0, 8)) as k), (select count(*) / count(distinct l_orderkey) as l from lineitem) l) select k::bigint as k, round(p, 8) as pmf, round(sum(p) over (order by k), 8) as cdf from k""")
def poisson_fit(t):
    lam = t.lineitem.agg((F.count("*") / F.countDistinct("l_orderkey")).alias("l"))
    k = t.spark.range(8).withColumnRenamed("id", "k").crossJoin(F.broadcast(lam))
    p = k.withColumn("p", F.pow("l", "k") * F.exp(-F.col("l")) / F.factorial(F.col("k").cast("int")))
    return p.select("k", F.round("p", 8).alias("pmf"), F.round(F.sum("p").over(W.orderBy("k").rowsBetween(W.unboundedPreceding, 0)), 8).alias("cdf"))
