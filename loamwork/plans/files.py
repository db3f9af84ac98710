"""Queries that write files to the shared folder and read them again, and what sinks write."""

import json

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions import text as T
from ..operators import corpus as C
from ..sources import files as D
from ..sources import sinks as K
from ..sources import tables as B
from .catalogue import _LINES, query


@query(f"with {_LINES} select doc_id, line_no::int as page_no, line as text from l")
def json_page_array(t):
    """Pages of a document, here its lines, kept as one JSON array."""
    path = D.scratch(t.spark, "pages")
    t.documents.select("doc_id", F.to_json(F.split("text", "\n", -1)).alias("value")).write.json(path)
    return B.page_array(t.spark.read.schema("doc_id long, value string").json(path))


@query(f"with {_LINES} select doc_id, line_no::int as page_no, line as text from l")
def form_feed_pages(t):
    return B.form_feed_pages(t.documents.select("doc_id", F.replace("text", F.lit("\n"), F.lit("\f")).alias("text")))


@query("""select line, count(*)::bigint as n from (select unnest(string_split('head' || chr(10) || text, chr(10))) as line from documents) group by 1""")
def copied_texts(t):
    """Texts in files that begin with a byte-order mark, copied without it: every line, and how often it stands."""
    path = D.scratch(t.spark, "marked")
    t.documents.select(F.concat(F.lit("\ufeffhead\n"), "text").alias("v")).write.text(path)
    lines = D.text_copy(t.spark, path, D.scratch(t.spark, "copied"))
    # only a file's own beginning loses its mark; the other texts of a file keep theirs
    return lines.groupBy(F.regexp_replace("line", "^\ufeffhead$", "head").alias("line")).agg(F.count("*").alias("n"))


@query("""select n_name as code, coalesce(max(s_name), 'none') as name from nation left join supplier on s_nationkey = n_nationkey group by 1""")
def csv_last_key_wins(t):
    """A headed CSV with a byte-order mark in which a key comes again and again: the last row counts."""
    path = D.scratch(t.spark, "codes")
    rows = t.nation.join(t.supplier, F.col("s_nationkey") == F.col("n_nationkey"), "left").select("n_name", F.coalesce("s_name", F.lit("none")).alias("name"))
    lines = rows.select(F.lit(1).alias("o"), "name", F.concat_ws(",", "n_name", "name").alias("v")).unionByName(t.spark.createDataFrame([(0, "", "﻿code,name")], "o int, name string, v string"))
    lines.repartition(1).sortWithinPartitions("o", "name").select("v").write.text(path)
    return B.csv_dict(t.spark, path, "code").select("code", "name")


@query("""select (row_number() over (order by p_partkey))::int as rule_order, '*' as volume, p_brand as "check", p_type as found, '' as context_regex, '' as reason from part""")
def tsv_allow_list(t):
    """A TSV allow-list of several files with a header, remarks and short rows: rules in the order of files and lines."""
    path = D.scratch(t.spark, "allowed")
    rows = t.part.select("p_partkey", F.concat_ws("\t", F.lit("*"), "p_brand", "p_type").alias("v"))
    head = t.spark.createDataFrame([(-3, "volume\tcheck\tfound\tcontext_regex\treason"), (-2, "# a remark"), (-1, "")], "p_partkey long, v string")
    rows.unionByName(head).repartitionByRange(3, "p_partkey").sortWithinPartitions("p_partkey").select("v").write.text(path)
    return B.allow_list(t.spark, path).withColumn("rule_order", F.col("rule_order").cast("int"))


_RULES = [("mail", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+", "error"), ("number", "[0-9]{5,}", "warn"), ("shout", "[A-Z]{4,}", "info")]
_BY_RULE = " union all ".join(f"select {i}::int as rule_order, '{n}' as id, '{s}' as severity, len(regexp_extract_all(text, '{p}'))::bigint as n from documents" for i, (n, p, s) in enumerate(_RULES))


@query(f"with f as ({_BY_RULE}) select rule_order, id, severity, count(*) filter (n > 0)::bigint as n_docs, sum(n)::bigint as n_found from f group by 1, 2, 3")
def json_rule_findings(t):
    """Every rule of a JSON document against every text: the rules become constants of the plan, so nothing is joined."""
    path = D.scratch(t.spark, "rules")
    text = json.dumps({"rules": [{"id": i, "pattern": p, "severity": s} for i, p, s in _RULES]}, indent=1)
    t.spark.createDataFrame([(text,)], "v string").write.text(path)
    rules = D.json_rules(t.spark, path).limit(D.MAX_RULES + 1).collect()
    if len(rules) > D.MAX_RULES:
        raise ValueError(f"over {D.MAX_RULES} rules")
    counted = F.array(*(F.struct(F.lit(r["rule_order"]).alias("rule_order"), F.lit(r["id"]).alias("id"), F.lit(r["severity"]).alias("severity"), F.regexp_count("text", F.lit(r["pattern"])).cast("long").alias("n")) for r in rules))
    x = t.documents.select(F.inline(counted))
    return x.groupBy("rule_order", "id", "severity").agg(F.count_if(F.col("n") > 0).alias("n_docs"), F.sum("n").alias("n_found"))


@query("""select n_name as found, upper(r_name) as should_be from nation join region on r_regionkey = n_regionkey""")
def json_term_map(t):
    """A map of terms in a JSON document, without its remarks."""
    path = D.scratch(t.spark, "terms")
    pairs = t.nation.join(t.region, F.col("r_regionkey") == F.col("n_regionkey")).agg(F.map_from_entries(F.collect_list(F.struct("n_name", F.upper("r_name")))).alias("m"))
    pairs.select(F.map_concat("m", F.create_map(F.lit("_remark"), F.lit("none"))).alias("terms")).write.json(path)
    return D.json_terms(t.spark, path)


@query("""select r_name || '/' || lower(substr(n_name, 1, 1)) as folder, count(distinct n_name)::bigint as n_files, sum(length(n_name))::bigint as n_chars from nation join region on r_regionkey = n_regionkey group by 1""")
def globbed_files(t):
    """Text files of a tree, found by two globs that overlap, each once."""
    path = D.scratch(t.spark, "tree")
    rows = t.nation.join(t.region, F.col("r_regionkey") == F.col("n_regionkey")).select("r_name", F.lower(F.substring("n_name", 1, 1)).alias("k"), F.col("n_name").alias("name"), F.col("n_name").alias("v"))
    rows.write.partitionBy("r_name", "k", "name").option("lineSep", "\n").text(path)
    found = D.text_files(t.spark, path, ["part-*", "*.txt"])
    folder = F.concat_ws("/", F.regexp_extract("relpath", "r_name=([^/]+)/", 1), F.regexp_extract("relpath", "k=([^/]+)/", 1))
    return found.groupBy(folder.alias("folder")).agg(F.count("*").alias("n_files"), F.sum(F.length(F.rtrim(F.replace("text", F.lit("\n"), F.lit(""))))).cast("long").alias("n_chars"))


@query("select c_mktsegment, count(*)::bigint as n, round(sum(c_acctbal), 2) as total from customer group by 1")
def csv_projection(t):
    """Two of five columns of a CSV, of given types."""
    path = D.scratch(t.spark, "customers")
    t.customer.write.option("header", True).csv(path)
    x = D.csv_columns(t.spark, path, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", ["c_mktsegment", "c_acctbal"])
    return x.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))


@query("""select event_id, user_id as who_id, event_type as what_kind, json_extract_string(props, '$.k')::bigint as what_props_k from events""")
def flattened_log(t):
    """Leaves of nested JSON as columns."""
    log = t.events.select("event_id", F.concat(F.lit('{"who": {"id": '), F.col("user_id").cast("string"), F.lit('}, "what": {"kind": "'), "event_type", F.lit('", "props": '), "props", F.lit("}}")).alias("log"))
    kind = StructType([StructField("who", StructType([StructField("id", LongType())])), StructField("what", StructType([StructField("kind", StringType()), StructField("props", StructType([StructField("k", LongType())]))]))])
    return D.flattened(log, "log", kind, sep="_")


@query("select n_nationkey, n_name, r_name from nation join region on r_regionkey = n_regionkey")
def tsv_report(t):
    path = D.scratch(t.spark, "report")
    K.tsv(t.nation.join(t.region, F.col("r_regionkey") == F.col("n_regionkey")).select("n_nationkey", "n_name", "r_name"), path)
    return t.spark.read.schema("n_nationkey int, n_name string, r_name string").option("sep", "\t").option("header", True).csv(path)


@query("select o_orderstatus, count(*)::bigint as n, round(sum(o_totalprice), 2) as total from orders where o_orderstatus = 'F' group by 1")
def parquet_partitions(t):
    """Orders written by status, twice over one path; the reader prunes to one of them."""
    path = D.scratch(t.spark, "orders")
    for _ in range(2):
        t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus").write.mode("overwrite").partitionBy("o_orderstatus").parquet(path)
    x = t.spark.read.parquet(path).where("o_orderstatus = 'F'")
    return x.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""select '{"doc_id":' || doc_id || ',"lang":"' || lang || '","n_chars":' || n_chars || '}' as value from documents""")
def json_documents(t):
    path = D.scratch(t.spark, "json")
    D.json_documents(t.documents.select("doc_id", "lang", "n_chars"), path)
    return t.spark.read.text(path)


_FOUND = " union all ".join(f"select doc_id, '{c}' as \"check\", '{s}' as severity, len(regexp_extract_all(text, '{p}'))::bigint as n from documents" for c, s, p in C.RULES)


@query(f"""with f as ({_FOUND}) select "check", '{{"doc_id":' || doc_id || ',"severity":"' || severity || '","n":' || n || '}}' as line from f where n > 0""")
def findings_json(t):
    """Findings of all documents as a report: a folder a check, a line of JSON a finding."""
    found = C.findings(t.documents.select("doc_id", "text")).select("check", "doc_id", "severity", "n")
    return D.findings_report(found, D.scratch(t.spark, "findings"))


@query(r"""with r as (select n_regionkey, row_number() over (partition by n_regionkey order by n_name) as o, n_name, n_nationkey from nation)
 select n_regionkey, string_agg('| ' || replace(n_name, 'A', '\|') || ' | ' || case when o % 2 = 0 then n_nationkey::varchar else '' end || ' |' || case when o = 1 then chr(10) || '|---|---|' else '' end, chr(10) order by o) as "table" from r group by 1""")
def markdown_tables(t):
    """Ragged rows with bars as a Markdown table a region."""
    from pyspark.sql.window import Window

    r = t.nation.withColumn("o", F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_name")))
    name = F.replace("n_name", F.lit("A"), F.lit("|"))
    cells = F.when(F.col("o") % 2 == 0, F.array(name, F.col("n_nationkey").cast("string"))).otherwise(F.array(name))
    return D.markdown_table(r.withColumn("cells", cells), "n_regionkey", "o")


@query("""select case when doc_id % 7 = 0 then 'changed' when doc_id % 11 = 0 then 'new' end as kind, count(*)::bigint as n from documents where doc_id % 7 = 0 or doc_id % 11 = 0 group by 1""")
def idempotent_write(t):
    """What a second write would write: texts that differ from the first one's, and new ones."""
    old = t.documents.where("doc_id % 11 <> 0 or doc_id % 7 = 0").select("doc_id", "text")
    new = t.documents.select("doc_id", F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("."))).otherwise(F.col("text")).alias("text"))
    return K.changed(old, new).groupBy(F.when(F.col("doc_id") % 7 == 0, "changed").otherwise("new").alias("kind")).agg(F.count("*").alias("n"))


@query("""select doc_id % 3 <> 0 as accepted, count(*)::bigint as n from documents group by 1""")
def gated_write(t):
    """Changed texts against a baseline of their content: white space may change, words may not."""
    base = C.integrity(t.documents).select("doc_id", "sha256")
    new = t.documents.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit("x"))).otherwise(F.concat(F.lit("  \n"), "text")).alias("text"))
    yes, no = K.gated(new, base, T.norm_integrity)
    return yes.select(F.lit(True).alias("accepted")).unionByName(no.select(F.lit(False).alias("accepted"))).groupBy("accepted").agg(F.count("*").alias("n"))
