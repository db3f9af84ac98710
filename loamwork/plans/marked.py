"""Queries over laid-out text. The tables hold prose only, so marks are put on some lines of `documents` first, by the
line's number, in the same way in SQL."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as T
from ..operators import corpus as C
from ..operators import layout as L
from ..operators import rewrite as V
from ..operators import structure as S
from .catalogue import _LINES, query

#: What the line of a number (modulo 34) looks like: SQL that both engines read; other lines stay.
_MARKS = {
    0: "'```'", 1: "concat('x = ', substr(line, 1, 9))", 2: "'```'", 3: "concat('## ', line_no, '. ', substr(line, 1, 24))", 5: "concat('- ', substr(line, 1, 40))",
    6: "concat('> ', substr(line, 1, 30))", 7: "concat('(A) ', substr(line, 1, 30))", 8: "concat('(B) ', substr(line, 9, 30))", 9: "'Answer: B'", 10: "concat('| ', substr(line, 1, 8), ' | ', substr(line, 9, 8), ' |')",
    11: "'|---|---|'", 12: "concat('| ', substr(line, 5, 8), ' | ', substr(line, 15, 8), ' |')", 13: "''", 14: "concat(substr(line, 1, 12), ' . . . . . ', line_no)", 15: "cast(line_no as string)", 16: "'xiv'",
    17: "'::: note'", 18: "concat('<!-- page ', line_no, ' -->')", 19: "'Basics'", 20: "concat(substr(line, 1, 8), '   ', substr(line, 12, 9), '     ', substr(line, 22, 6))",
    21: "concat(substr(line, 2, 8), '   ', substr(line, 13, 9))", 22: "substr(line, 1, 14)", 23: "concat(substr(line, 3, 8), '      ', substr(line, 12, 8))", 24: "substr(line, 1, 70)", 25: "concat(substr(line, 1, 45), ',')",
    26: "concat(substr(line, 1, 90), ':')", 27: "concat('uses df.mean and fit_model() with max_depth=3 in `raw_x` of ', substr(line, 1, 20), ' and user_id')", 28: "concat('# ', substr(line, 1, 16))",
    29: "concat('Running head ', doc_id)", 30: "concat('## Appendix ', substr(line, 1, 6))", 31: "'Exercise EX-1: SIM-12 and SIM-A3'", 32: "concat('Which of ', substr(line, 1, 20), '?')", 33: "concat(line_no, '. ', substr(line, 1, 30))",
}
_CASE = "case (doc_id + line_no) % 34 " + " ".join(f"when {k} then {v}" for k, v in _MARKS.items()) + " else line end"
_BOOK = f"{_LINES}, m as (select doc_id, line_no, {_CASE.replace('as string', 'as varchar')} as line from l)"
_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def book(t):
    return C.lines(t.documents.select("doc_id", "text")).select("doc_id", "line_no", F.expr(_CASE).alias("line"))


def _sql_classes(line: str) -> str:
    s = _STRIP.format(line)
    return "case " + " ".join(f"when regexp_matches({s}, '{p}') then '{n}'" for n, p in L.classes()) + " else 'text' end"


_CLASSED = f"{_BOOK}, k as (select *, {_sql_classes('line')} as class from m)"

# --- sources and lines ----------------------------------------------------------------------------------------------


@query(f"with {_BOOK}, k as (select *, {_STRIP.format('line')} as s from m) select doc_id, count(*)::bigint as n from k where not (s = '' or regexp_matches(s, '^Running head') or regexp_matches(s, '^([ivxlc]{{1,7}}|[0-9]{{1,3}})$')) group by doc_id")
def page_furniture(t):
    return book(t).where(~L.furniture(F.col("line"), "^Running head")).groupBy("doc_id").agg(F.count("*").alias("n"))


@query(rf"with {_BOOK} select doc_id, line_no::int as line_no, line from m where regexp_matches(line, '(\s*\.\s*){{3,}}')")
def dot_leaders(t):
    return book(t).where(L.dot_leader(F.col("line")))


@query(rf"""with {_BOOK}, h as (select *, case when length(line) > 45 or regexp_matches(line, '[.,;:!?]$') then null when starts_with(line, '# ') then 'chapter' when regexp_matches(line, '^## [0-9]+\. ') then 'section' when starts_with(line, '## Appendix') then 'appendix' end as kind from m)
 select kind, count(*)::bigint as n, count(distinct doc_id)::bigint as n_docs from h where kind is not null group by 1""")
def heading_kinds(t):
    h = book(t).withColumn("kind", L.heading_kind(F.col("line"))).where("kind is not null")
    return h.groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_docs"))


@query(f"with {_CLASSED} select class, count(*)::bigint as n, sum(length(line))::bigint as n_chars from k group by 1")
def layout_classes(t):
    return book(t).groupBy(L.line_class(F.col("line")).alias("class")).agg(F.count("*").alias("n"), F.sum(F.length("line")).cast("long").alias("n_chars"))


_IN = lambda names: ", ".join(f"'{n}'" for n in names)
_JOINS = rf"""{_CLASSED}, n as (select *, lead(line) over w as nl, lead(class) over w as nc, {_STRIP.format('line')} as a, length({_STRIP.format('line')}) as width from k window w as (partition by doc_id order by line_no)),
 j as (select *, case when class in ({_IN(L.CLOSED)}) or nc is null or nc in ({_IN(L.OPENING)}) then false when regexp_matches({_STRIP.format('nl')}, '^Which of .*\?$') then true when regexp_matches(a, '[.!?]$') then false
  when regexp_matches(a, '[:;)\]]$') then width >= 80 else width >= 50 or regexp_matches(a, '[,—–-]$') end as joins from n)"""


@query(f"with {_JOINS} select doc_id, line_no::int as line_no, class, joins from j")
def merging_lines(t):
    return L.merges(book(t)).select("doc_id", "line_no", "class", "joins")


@query(rf"""with {_JOINS}, o as (select *, coalesce(lag(joins) over (partition by doc_id order by line_no), false) as cont from j), f as (select *, max(case when not cont then line_no end) over (partition by doc_id order by line_no rows unbounded preceding) as first from o),
 p as (select *, case when cont and regexp_matches(lag(line) over (partition by doc_id order by line_no), '[A-Za-z0-9]$') and regexp_matches(line, '^[A-Za-z0-9]') then ' ' || line else line end as piece from f)
 select doc_id, first::int as first, count(*)::bigint as n_lines, string_agg(piece, '' order by line_no) as text from p group by 1, 2""")
def folded_lines(t):
    return L.folded(book(t))


_BARRED = _IN([n for n, _ in L.MARKDOWN] + ["list"])


@query(rf"""with {_CLASSED}, n as (select *, lead(class) over w as nc, sum((class = 'fence')::int) over (partition by doc_id order by line_no rows unbounded preceding) % 2 as f, {_STRIP.format('line')} as a from k window w as (partition by doc_id order by line_no))
 select class as kind, count(*)::bigint as n, min(doc_id) as first_doc from n where f = 0 and class not in ({_BARRED}) and nc not in ({_BARRED}, 'choice', 'verdict') and not regexp_matches(a, '[.:?!;)\]]$') group by 1""")
def residual_kinds(t):
    return L.residuals(book(t)).groupBy("kind").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


@query(rf"""with {_CLASSED}, f as (select *, sum((class = 'fence')::int) over (partition by doc_id order by line_no rows unbounded preceding) % 2 as f from k), e as (select *, class = 'text' and f = 0 and regexp_matches(line, '[.!?]$') as e from f),
 x as (select *, lead(e) over (partition by doc_id order by line_no) as ne from e) select doc_id, line_no::int as line_no from x where e and ne""")
def guarded_breaks(t):
    return L.breaks(book(t))


_SEG = r"""s as (select doc_id, line_no, line, unnest(regexp_extract_all(line, '\S+(?: \S+)*')) as token, generate_subscripts(regexp_extract_all(line, '\S+(?: \S+)*'), 1) as i, string_split_regex(line, '\S+(?: \S+)*') as gaps, regexp_extract_all(line, '\S+(?: \S+)*') as tokens from m),
 g as (select doc_id, line_no, token, i, (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(tokens[1:i - 1], lambda x: length(x))), 0))::int as first from s where len(tokens) >= 2)"""


@query(f"with {_BOOK}, {_SEG} select doc_id, line_no::int as line_no, first, token from g")
def line_segments(t):
    x = book(t).withColumn("s", L.segments(F.col("line"))).where("size(s) >= 2")
    return x.select("doc_id", "line_no", F.inline("s"))


@query(f"with {_BOOK}, {_SEG} select doc_id, first, count(*)::bigint as votes from g group by 1, 2 having count(*) >= 2")
def offset_votes(t):
    """Starts of segments that two lines of a document or more have."""
    x = book(t).withColumn("s", L.segments(F.col("line"))).where("size(s) >= 2").select("doc_id", F.inline("s"))
    return x.groupBy("doc_id", "first").agg(F.count("*").alias("votes")).where("votes >= 2")


@query(f"""with recursive {_BOOK}, {_SEG}, v as (select doc_id, first from (select doc_id, first, count(*) as n from g group by 1, 2) where n >= 2), o as (select doc_id, list(first order by first) as a from v group by 1),
 r as (select doc_id, a, 1 as i, [a[1]] as b from o union all select doc_id, a, i + 1, case when a[i + 1] - b[-1] >= 6 then list_append(b, a[i + 1]) else b end from r where i < len(a)), bounds as (select doc_id, b from r where i = len(a))
 select doc_id, greatest(len(list_filter(b, lambda x: g.first >= x - 1)) - 1, 0)::int as col, count(*)::bigint as n from g join bounds using (doc_id) group by 1, 2""")
def segment_columns(t):
    """Segments by the column that they are in: columns are voted starts, six apart at least."""
    x = book(t).withColumn("s", L.segments(F.col("line"))).where("size(s) >= 2").select("doc_id", F.inline("s"))
    v = x.groupBy("doc_id", "first").agg(F.count("*").alias("votes")).where("votes >= 2")
    b = v.groupBy("doc_id").agg(L.column_bounds(F.sort_array(F.collect_list("first"))).alias("b"))
    return x.join(b, "doc_id").groupBy("doc_id", L.column_of(F.col("b"), F.col("first")).alias("col")).agg(F.count("*").alias("n"))


@query(rf"""with recursive {_BOOK}, c as (select doc_id, line_no, len(regexp_extract_all(line, '\S+(?: \S+)*')) as n, length(line) <= 40 as ok from m),
 r as (select doc_id, line_no, case when n >= 2 then line_no end as b, 0 as run, 0 as took from c where line_no = 1
  union all select c.doc_id, c.line_no, case when c.n >= 2 then coalesce(r.b, c.line_no) when r.b is not null and r.run < 2 and r.took < 12 and c.ok and c.n = 1 then r.b end,
   case when c.n >= 2 then 0 when r.b is not null and r.run < 2 and r.took < 12 and c.ok and c.n = 1 then r.run + 1 else 0 end, case when r.b is null then 0 when c.n >= 2 then r.took when r.run < 2 and r.took < 12 and c.ok and c.n = 1 then r.took + 1 else 0 end
  from r join c on c.doc_id = r.doc_id and c.line_no = r.line_no + 1)
 select doc_id, b::int as first, count(*)::int as n_lines, max(took)::int as n_absorbed from r where b is not null group by 1, 2""")
def layout_tables(t):
    return L.table_blocks(book(t))


@query(f"""with {_BOOK}, f as (select *, sum(starts_with(line, '```')::int) over (partition by doc_id order by line_no rows unbounded preceding) as k from m)
 select doc_id, min(line_no)::int as first, count(*)::bigint as n_lines, string_agg(line, chr(10) order by line_no) as code from f where k % 2 = 1 and not starts_with(line, '```') group by doc_id, k""")
def code_listings(t):
    return L.code_blocks(book(t))


_KIND = "case " + " ".join(f"when regexp_full_match(x, '{p}') then '{n}'" for n, p in L.CODE) + " end"


@query(rf"""with {_BOOK}, p as (select doc_id, line_no, string_split_regex(line, '{L.SPANS}') as free, regexp_extract_all(line, '{L.SPANS}') as kept from m), t as (select *, flatten(list_transform(free, lambda x: regexp_extract_all(x, '{L.TOKEN}'))) as found from p)
 select doc_id, line_no::int as line_no, array_to_string(list_transform(list_zip(list_transform(free, lambda x: regexp_replace(x, '{L.TOKEN}', '`\0`', 'g')), kept), lambda z: z[1] || coalesce(z[2], '')), '') as line, array_to_string(list_transform(found, lambda x: {_KIND} || ' ' || x), ', ') as tokens from t where len(found) > 0""")
def inline_code_tokens(t):
    """Every line that has code within its words, marked, and its tokens by kind."""
    each = F.transform("tokens", lambda k: F.concat(k["kind"], F.lit(" "), k["token"]))
    return L.inline_code(book(t)).select("doc_id", "line_no", "line", F.array_join(each, ", ").alias("tokens"))


_TERMS = [("the", "THE", None), ("ion", "-ion", "[0-9]"), ("de", "of", "des|den")]
_HITS = " union all ".join(
    f"""select doc_id, line_no, '{t}' as found, '{g}' as should_be, a as place from (select doc_id, line_no, line, (list_sum(list_transform(p[1:i], lambda x: length(x))) + (i - 1) * {len(t)})::int as a from (select doc_id, line_no, line, string_split(line, '{t}') as p, unnest(range(1, len(string_split(line, '{t}')))) as i from m))
    """ + (f"where not regexp_matches(substr(line, greatest(a - 30, 0) + 1, a - greatest(a - 30, 0) + {len(t)} + 30), '{c}')" if c else "")
    for t, g, c in _TERMS
)


@query(f"with {_BOOK}, h as ({_HITS}) select doc_id, line_no::int as line_no, found, should_be, place from h")
def guarded_terms(t):
    return L.term_hits(book(t), _TERMS)


@query(rf"""with {_BOOK}, p as (select *, max(case when starts_with(line, '<!-- page') then line_no end) over (partition by doc_id order by line_no rows unbounded preceding) as page from m)
 select doc_id, string_agg(case when starts_with(line, '#') then line || ' <!-- page ' || coalesce(page::varchar, '?') || ' -->' else line end, chr(10) order by line_no) as text from p where not regexp_matches(line, '(\s*\.\s*){{3,}}') group by doc_id""")
def anchored_skeleton(t):
    return L.skeleton(book(t), F.when(F.col("line").startswith("<!-- page"), F.col("line_no")))


@query(rf"""with {_BOOK}, x as (select *, max(case when starts_with(line, '# ') then line_no end) over (partition by doc_id order by line_no rows unbounded preceding) as chapter from m)
 select doc_id, chapter::int as chapter, count(distinct nullif(regexp_extract(line, 'SIM-([0-9A-Z]+)', 1), ''))::bigint as n_ids, sum(len(regexp_extract_all(line, 'SIM-[0-9A-Z]+')))::bigint as n_mentions, count(*) filter (regexp_matches(line, '^## [0-9]+\. '))::bigint as n_sections from x where chapter is not null group by 1, 2""")
def second_recount(t):
    """By chapter: first ids of lines, all mentions anywhere, and sections."""
    w = W.partitionBy("doc_id").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    x = book(t).withColumn("chapter", F.last(F.when(F.col("line").startswith("# "), F.col("line_no")), True).over(w)).where("chapter is not null")
    ids = F.nullif(F.regexp_extract("line", "SIM-([0-9A-Z]+)", 1), F.lit(""))
    return x.groupBy("doc_id", "chapter").agg(F.countDistinct(ids).alias("n_ids"), F.sum(F.regexp_count("line", F.lit("SIM-[0-9A-Z]+"))).cast("long").alias("n_mentions"), F.count_if(F.col("line").rlike(r"^## [0-9]+\. ")).alias("n_sections"))


@query(rf"""with {_BOOK}, n as (select *, lead(line) over (partition by doc_id order by line_no) as nl from m) select doc_id, line_no::int as line_no from n where contains(line, '|') and regexp_matches(nl, '{L.RULE}')""")
def table_headers(t):
    """Rows with a bar that a rule of a Markdown table follows."""
    x = book(t).withColumn("n", F.lead("line").over(W.partitionBy("doc_id").orderBy("line_no")))
    return x.where(F.col("line").contains("|") & F.col("n").rlike(L.RULE)).select("doc_id", "line_no")


@query(rf"""with {_BOOK}, x as (select *, regexp_matches(line, '^#') as mk from m), a as (select *, lead(line, 1) over w as l1, lead(line, 2) over w as l2, lead(line, 3) over w as l3, coalesce(lead(mk, 1) over w, true) as s1, coalesce(lead(mk, 2) over w, true) as s2, coalesce(lead(mk, 3) over w, true) as s3 from x window w as (partition by doc_id order by line_no)),
 f as (select *, length(l1) <= 60 and l1 <> '' and not regexp_matches(l1, '[,;]') as f1, length(l2) <= 60 and l2 <> '' and not regexp_matches(l2, '[,;]') as f2, length(l3) <= 60 and l3 <> '' and not regexp_matches(l3, '[,;]') as f3 from a)
 select doc_id, line_no::int as line_no, line, case when s1 then null when f1 then l1 when s2 then null when f2 then l2 when s3 then null when f3 then l3 end as title from f where mk""")
def titles_ahead(t):
    return V.title_after(book(t), F.col("line").rlike("^#"))


@query(rf"""with {_BOOK}, d as (select doc_id, line_no, case when (doc_id + line_no) % 34 in (3, 4) and line_no > 1 then '## Same' else line end as line from m), n as (select *, first_value(case when line <> '' then line end ignore nulls) over (partition by doc_id order by line_no rows between 1 following and unbounded following) as nl from d)
 select doc_id, line_no::int as line_no, line from n where not (starts_with(line, '#') and line is not distinct from nl)""")
def repeated_headings(t):
    x = book(t).withColumn("line", F.when(((F.col("doc_id") + F.col("line_no")) % 34).isin(3, 4) & (F.col("line_no") > 1), "## Same").otherwise(F.col("line")))
    return V.drop_repeated_headings(x)


@query(rf"""with {_BOOK}, x as (select *, last_value(case when starts_with(line, '# ') then substr(line, 3) end ignore nulls) over (partition by doc_id order by line_no rows unbounded preceding) as chapter, count(case when starts_with(line, '# ') then 1 end) over (partition by doc_id order by line_no rows unbounded preceding) as c from m where regexp_matches(line, '^# +.') or not starts_with(line, '# '))
 select doc_id, c::bigint as c, any_value(trim(chapter)) as chapter, count(*)::bigint as n from x where c > 0 group by 1, 2""")
def chapters_filled(t):
    x = S.headings(book(t).where("line rlike '^# +.' or not startswith(line, '# ')"))
    w = W.partitionBy("doc_id").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    x = x.withColumn("c", F.count(F.when(F.col("line").startswith("# "), 1)).over(w)).where("c > 0")
    return x.groupBy("doc_id", "c").agg(F.trim(F.max("chapter")).alias("chapter"), F.count("*").alias("n"))


# --- text functions -------------------------------------------------------------------------------------------------

_CJK = "translate(line, 'aeiot', '一二三四五')"


@query(f"with {_LINES} select doc_id, line_no::int as line_no, rtrim(replace(line, chr(9), '    ')) as t from (select doc_id, line_no, replace(line, ', ', chr(9)) || '  ' as line from l)")
def layout_normalised(t):
    x = C.lines(t.documents.select("doc_id", "text"))
    return x.select("doc_id", "line_no", T.norm_layout(F.concat(F.replace("line", F.lit(", "), F.lit("\t")), F.lit("  "))).alias("t"))


@query("select doc_id, substr(regexp_replace(text, '\\s+', ' ', 'g'), 1, 110) as t from documents")
def truncated_fields(t):
    return t.documents.select("doc_id", T.truncate(F.col("text")).alias("t"))


@query("select doc_id, case lang when 'en' then 'English' when 'de' then 'German' else lang end as label from documents")
def default_lookup(t):
    """A label by a map, and the key itself where the map has none."""
    names = F.create_map(F.lit("en"), F.lit("English"), F.lit("de"), F.lit("German"))
    return t.documents.select("doc_id", F.coalesce(F.try_element_at(names, F.col("lang")), F.col("lang")).alias("label"))


@query("select doc_id, translate(substr(text, 1, 60), 'ABCD', 'ABCD') as t, regexp_replace(regexp_replace(substr(text, 1, 40), '[^0-9A-Za-z_À-ÿ]+', '_', 'g'), '^_+|_+$', '', 'g') as slug from documents where regexp_matches(substr(text, 1, 40), '^[ -~À-ÿ\\n]*$')")
def names_normalised(t):
    """Full-width letters made ASCII again, hyphen variants as hyphens, and slugs."""
    head = F.substring("text", 1, 60)
    wide = F.translate(head, "ABCD", "ＡＢＣＤ")
    x = t.documents.where(F.substring("text", 1, 40).rlike("^[ -~À-ÿ\\n]*$"))
    return x.select("doc_id", T.full_to_half(wide).alias("t"), T.slug(F.substring("text", 1, 40)).alias("slug"))


@query(f"with {_LINES} select doc_id, line_no::int as line_no, replace(replace(line, '.', '-'), ',', '-') as t from l")
def hyphens_normalised(t):
    x = C.lines(t.documents.select("doc_id", "text"))
    return x.select("doc_id", "line_no", T.hyphens(F.replace(F.replace("line", F.lit("."), F.lit("‑")), F.lit(","), F.lit("–"))).alias("t"))


@query("""with x as (select doc_id, text, position('the' in text) as q from documents) select doc_id, substr(text, greatest(q - 30, 1), 60) as around, (length(substr(text, 1, q)) - length(replace(substr(text, 1, q), chr(10), '')) + 1)::int as line_no from x where q > 0""")
def first_context(t):
    """The surroundings of a document's first `the`, and the number of its line."""
    x = t.documents.select("doc_id", "text", F.instr("text", "the").alias("at")).where("at > 0")
    before = F.substring("text", F.lit(1), F.col("at"))
    return x.select("doc_id", T.context(F.col("text"), F.col("at")).alias("around"), (F.length(before) - F.length(F.replace(before, F.lit("\n"), F.lit(""))) + 1).alias("line_no"))


@query(f"with {_LINES}, n as (select *, lead(line) over (partition by doc_id order by line_no) as nl from l) select doc_id, line_no::int as line_no, line || case when regexp_matches(line, '[A-Za-z0-9]$') and regexp_matches(nl, '^[A-Za-z0-9]') then ' ' else '' end || nl as t from n where nl is not null")
def joined_lines(t):
    x = C.lines(t.documents.select("doc_id", "text")).withColumn("n", F.lead("line").over(W.partitionBy("doc_id").orderBy("line_no"))).where("n is not null")
    return x.select("doc_id", "line_no", T.join_lines(F.col("line"), F.col("n")).alias("t"))


@query("""with p as (select doc_id, text as a, replace(text, 'ou', 'u') as b from documents), z as (select doc_id, a, b, list_position(list_transform(list_zip(string_split(a, ''), string_split(b, '')), lambda x: x[1] is not distinct from x[2]), false) as q from p where a <> b)
 select doc_id, (q - 1)::int as place, substr(a, greatest(q - 30, 1), least(q - 1, 30) + 30) as old, substr(b, greatest(q - 30, 1), least(q - 1, 30) + 30) as new from z""")
def first_differences(t):
    """Where a text and a changed copy part (from 0), with what stands around."""
    x = t.documents.select("doc_id", F.col("text").alias("a"), F.replace("text", F.lit("ou"), F.lit("u")).alias("b")).where("a <> b")
    x = x.withColumn("place", T.first_difference(F.col("a"), F.col("b")))
    around = lambda c: F.substring(c, F.greatest(F.col("place") - 29, F.lit(1)), F.least(F.col("place"), F.lit(30)) + 30)
    return x.select("doc_id", "place", around("a").alias("old"), around("b").alias("new"))


_HAN = "一-鿿"


@query(rf"with {_LINES}, c as (select doc_id, line_no, {_CJK} as t from l) select doc_id, line_no::int as line_no, regexp_replace(regexp_replace(t, '([{_HAN}])([A-Za-z0-9])', '\1' || chr(8202) || '\2', 'g'), '([A-Za-z0-9])([{_HAN}])', '\1' || chr(8202) || '\2', 'g') as spaced from c")
def han_spacing(t):
    """A hair space between Han characters and letters, but not inside tags (there are none here)."""
    return C.lines(t.documents.select("doc_id", "text")).select("doc_id", "line_no", T.cjk_spacing(F.expr(_CJK)).alias("spaced"))


@query(rf"with {_LINES}, c as (select doc_id, line_no, regexp_replace({_CJK}, '([一二三四五])', '\1 ', 'g') as t from l) select doc_id, line_no::int as line_no, rtrim(regexp_replace(regexp_replace(regexp_replace(t, '([{_HAN}]) ([{_HAN}])', '\1\2', 'g'), '([{_HAN}]) ([{_HAN}])', '\1\2', 'g'), ' +([,.;:!?])', '\1', 'g')) as t from c")
def han_rows_tidied(t):
    """Spaces between Han characters, and before punctuation, taken out."""
    x = C.lines(t.documents.select("doc_id", "text")).select("doc_id", "line_no", F.regexp_replace(F.expr(_CJK), "([一二三四五])", "$1 ").alias("t"))
    return x.select("doc_id", "line_no", T.tidy_punctuation(T.han_together(F.col("t"))).alias("t"))


@query(r"""with h as (select doc_id, rpad(regexp_replace(substr(text, 1, 12), '[^A-Za-zÀ-ÿ0-9 ]', '.', 'g'), 12, '.') as h from documents), d as (select doc_id, '**' || substr(h, 1, 5) || '** and *' || substr(h, 7, 4) || '* with `a*b*c` <' as t from h)
 select doc_id, regexp_replace(t, '^\*\*(.*?)\*\* and \*(.*?)\* with `a\*b\*c` <$', '<strong>\1</strong> and <em>\2</em> with <code>a*b*c</code> &lt;') as html from d""")
def inline_markdown(t):
    """The beginning of every text, its signs as points and filled up with points, in Markdown that becomes HTML."""
    head = t.documents.select("doc_id", F.rpad(F.regexp_replace(F.substring("text", 1, 12), "[^A-Za-zÀ-ÿ0-9 ]", "."), 12, ".").alias("h"))
    return head.select("doc_id", T.inline_markdown(F.concat(F.lit("**"), F.substring("h", 1, 5), F.lit("** and *"), F.substring("h", 7, 4), F.lit("* with `a*b*c` <"))).alias("html"))
