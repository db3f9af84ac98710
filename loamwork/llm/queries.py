"""The operators' queries, each over its whole table, and DuckDB SQL for those that SQL can express."""

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .conversations import damage, diagnose
from .decontaminate import contaminated
from .html_extract import html_extract
from .jaccard_join import jaccard_classes
from .langid import language_id
from .lexical_search import search
from .line_dedup import line_dedup
from .mixing import mixed_counts
from .pii import pii
from .quality_classifier import resample
from .quality_rules import quality_rules
from .token_counts import token_counts
from .toxicity import toxicity


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_counts(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract(table(spark, sf_dir, "pages"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = language_id(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return out.select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "accepted")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnose(damage(table(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_mix_sources, op3_html_extract, op4_quality_classifier, op5_token_counts, op6_language_id, op7_line_dedup, op8_quality_rules, op9_jaccard_join, op10_toxicity, op11_pii, op12_lexical_search, op13_conversation_repair)}

_WORD = r"[^\x20\x09-\x0D]+"
QUALITY_SQL = rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
w as (select r, doc_id, t, regexp_extract_all(t, '{_WORD}') as ws, string_split(t, chr(10)) as ls from d),
g as (select r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as k from (select r, ws, unnest(range(1, len(ws) - 1)) as i from w)),
twice as (select r, k from g group by r, k having count(*) > 1),
places as (select distinct r, i + o as p from g join twice using (r, k), (values (0), (1), (2)) as v(o)),
rep as (select r, count(*) as n from places group by r),
m as (
  select w.r, doc_id, t, ls, len(ws) as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) as n_symbols,
    len(list_filter(ls, lambda x: regexp_matches(x, '{_WORD}'))) - len(list_distinct(list_filter(ls, lambda x: regexp_matches(x, '{_WORD}')))) as n_dup_lines,
    coalesce(rep.n, 0) as n_repeat_words
  from w left join rep using (r)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
  n_repeat_words::bigint as n_repeat_words, base_failed,
  not (base_failed or n_symbols * 10 > n_words or word_chars < 2 * n_words or word_chars > 12 * n_words or n_dup_lines * 10 > 6 * len(ls)
    or (length(t) - length(replace(t, '!', ''))) * 10 > 3 * n_words
    or length(regexp_replace(t, '[^\p{{L}}]', '', 'g')) * 2 < word_chars
    or length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) * 2 > word_chars) as kept
from b
"""
JACCARD_SQL = rf"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as ws from documents),
s as (
  select distinct doc_id, array_to_string(ws[i : i + 4], ' ') as k from (select doc_id, ws, unnest(range(1, len(ws) - 3)) as i from d where len(ws) >= 5)
  union all select doc_id, array_to_string(ws, ' ') from d where len(ws) between 1 and 4),
n as (select doc_id, count(*) as n from s group by doc_id),
o as (select a.doc_id as x, b.doc_id as y, count(*) as i from s a join s b on a.k = b.k and a.doc_id <> b.doc_id group by all),
e as (select x, y from o join n p on p.doc_id = x join n q on q.doc_id = y where 100 * i >= 75 * (p.n + q.n - i)),
reach as (select doc_id as x, doc_id as y from documents union select r.x, e.y from reach r join e on e.x = r.y)
select doc_id, coalesce(any_value(n.n), 0)::bigint as n_shingles, min(reach.y) as component_id
from d left join n using (doc_id) join reach on reach.x = d.doc_id group by doc_id
"""
#: Terms of a text, and the search that the operator's docstring states.
_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SEARCH_SQL = f"""
with d as (select row_number() over () as r, doc_id, {_TERMS} as ts from documents),
b as (select distinct item_id, unnest({_TERMS}) as t from benchmark),
s as (select count(*)::bigint as docs, sum(len(ts))::bigint as words from d where len(ts) > 0),
p as (select r, t, count(*) as tf from (select r, unnest(ts) as t from d) group by r, t),
w as (select t, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as w from p, s where t in (select t from b) group by t),
m as (select r, doc_id, 100 - 90 + ((90 * len(ts) * docs) // words) as m from d, s where len(ts) > 0),
x as (
  select item_id, r, any_value(doc_id) as doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from b join w using (t) join p using (t) join m using (r) group by item_id, r),
k as (select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank, doc_id, score from x where score > 0)
select item_id, rank::int as rank, doc_id, score from k where rank <= 10
"""
#: crc32 by its table of 256, then every state's cheapest (cost, audit, lines) of the turns behind it, from the last turn on;
#: e0 to e3 are the costs before inserts, f0 to f3 those with them.
REPAIR_SQL = r"""
with recursive crc as (select list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by n) as tab from (select unnest(range(0, 256)) as n)),
o as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
h as (
  select o.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(k, ''), lambda x: ascii(x)::bigint)), lambda c, x: xor(c >> 8, tab[xor(c, x) % 256 + 1])), 4294967295) % 20 as d
  from o, crc),
g as (
  select conv_id, turn, case when d = 4 then 'user' else role end as role,
    case when d = 1 then '' when d = 2 then translate(text, '.!?', '') else text end as text
  from (select h.*, unnest(case when d = 3 then [0, 1] else [0] end) as copy from h where d <> 0)),
n as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role || ':' || text, role) as i,
    row_number() over (partition by conv_id, role, text order by turn nulls first) as nth,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as cut from g),
f as (
  select conv_id, turn, role, text, i, left(role, 1) as c,
    case when cut = '' then 2 when nth > 1 then 3 when right(cut, 1) in ('.', '!', '?') then 0 else 1 end as fault from n),
z as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 2) as blank,
    count(*) filter (fault = 3) as duplicate, count(*) filter (fault = 1) as truncated, count(*) filter (p is not null and p || c not in ('su', 'ua', 'au')) as illegal
  from (select *, lag(c) over (partition by conv_id order by i) as p from f) group by conv_id),
dp as (
  select conv_id, n as i, {'c': 0, 'a': '', 'l': []::varchar[]} as f0, {'c': 4, 'a': 'II', 'l': ['user:', 'assistant:']} as f1,
    {'c': 2, 'a': 'I', 'l': ['assistant:']} as f2, {'c': 0, 'a': '', 'l': []::varchar[]} as f3 from z
  union all
  select conv_id, i, least(e0, {'c': e2.c + 2, 'a': 'I' || e2.a, 'l': list_prepend('user:', e2.l)}, {'c': e3.c + 4, 'a': 'II' || e3.a, 'l': list_concat(['user:', 'assistant:'], e3.l)}),
    least(e1, {'c': e2.c + 2, 'a': 'I' || e2.a, 'l': list_prepend('user:', e2.l)}, {'c': e3.c + 4, 'a': 'II' || e3.a, 'l': list_concat(['user:', 'assistant:'], e3.l)}),
    least(e2, {'c': e3.c + 2, 'a': 'I' || e3.a, 'l': list_prepend('assistant:', e3.l)}), least(e3, {'c': e2.c + 2, 'a': 'I' || e2.a, 'l': list_prepend('user:', e2.l)})
  from (
    select conv_id, i,
      case when fault > 1 then x0 when c = 's' then least(x0, {'c': f1.c + fault, 'a': 'K' || f1.a, 'l': list_prepend(y, f1.l)}, u) else least(x0, u) end as e0,
      case when fault > 1 then x1 else least(x1, u) end as e1, case when fault > 1 then x2 else least(x2, a) end as e2, case when fault > 1 then x3 else least(x3, u) end as e3
    from (
      select dp.conv_id, dp.i - 1 as i, f.c, fault, f1, role || ':' || text as y,
        {'c': f0.c + 3, 'a': 'D' || f0.a, 'l': f0.l} as x0, {'c': f1.c + 3, 'a': 'D' || f1.a, 'l': f1.l} as x1,
        {'c': f2.c + 3, 'a': 'D' || f2.a, 'l': f2.l} as x2, {'c': f3.c + 3, 'a': 'D' || f3.a, 'l': f3.l} as x3,
        case when f.c = 'u' then {'c': f2.c + fault, 'a': 'K' || f2.a, 'l': list_prepend(role || ':' || text, f2.l)} else {'c': f2.c + fault + 2, 'a': 'R' || f2.a, 'l': list_prepend('user:' || text, f2.l)} end as u,
        case when f.c = 'a' then {'c': f3.c + fault, 'a': 'K' || f3.a, 'l': list_prepend(role || ':' || text, f3.l)} else {'c': f3.c + fault + 2, 'a': 'R' || f3.a, 'l': list_prepend('assistant:' || text, f3.l)} end as a
      from dp join f on f.i = dp.i and f.conv_id is not distinct from dp.conv_id)))
select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, coalesce(f0.c, 0)::bigint as cost, coalesce(f0.a, '') as audit, sha256(coalesce(array_to_string(f0.l, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o left join z on z.conv_id is not distinct from o.conv_id left join dp on dp.conv_id is not distinct from o.conv_id and dp.i = 0
"""
ORACLES = {"op12_lexical_search": SEARCH_SQL, "op13_conversation_repair": REPAIR_SQL, "op8_quality_rules": QUALITY_SQL, "op9_jaccard_join": JACCARD_SQL}
