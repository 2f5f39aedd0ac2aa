"""Queries over the project tables, and the SQL that a second engine runs against them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import loops, parsers, quality, text as tx
from ..functions.garbage import garbage_fraction
from ..operators import agreement, corpus, layout, leaderboard as lb, pages as pg, perplexity as pp, spelling, store as st, telemetry as tl
from ..session import materialise, settled, settled_texts, spread

import pandas as pd

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_SP = tx.SPACE
_STRIP = r"\[\](){}.,;:!?\"''"
#: SQL fragments.
PAGES = "(select distinct text_id, model, doc, page, text from page_texts where text is not null)"
RESPONSES = "(select * from page_responses qualify row_number() over (partition by response_id order by ingested_at desc) = 1)"


def _trim(x: str) -> str:
    return f"regexp_replace({x}, '^[{_SP}]+|[{_SP}]+$', '', 'g')"



def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark, d, name, *columns) -> DataFrame:
    df = spark.read.parquet(f"{d}/{name}.parquet")
    return df.select(*columns) if columns else df


def page_texts(spark, d) -> DataFrame:
    """Each page's text once; re-delivered rows are settled without the texts."""
    return settled_texts(table(spark, d, "page_texts", "text_id", "model", "doc", "page", "text"), ["text_id"]).where("text is not null")


def responses(spark, d, *columns) -> DataFrame:
    """The last delivery of each response."""
    cols = [c for c in columns if c not in ("response_id", "ingested_at")]
    settle = settled_texts if "natural_text" in cols else settled
    return settle(table(spark, d, "page_responses", "response_id", "ingested_at", *cols), ["response_id"], "ingested_at").select("response_id", *cols)


# --- text metrics and leaderboards -----------------------------------------------------------------------------------

_GARBAGE = rf"""(
  list_bool_or(list_transform(range(1, length(t) - 2), lambda i: t[i] = t[i+1] and t[i] = t[i+2] and t[i] = t[i+3])) is true
  or length(regexp_replace(t, '^[{_STRIP}]+|[{_STRIP}]+$', '', 'g')) > 40
  or (regexp_matches(regexp_replace(t, '^[{_STRIP}]+|[{_STRIP}]+$', '', 'g'), '\p{{L}}') and regexp_matches(t, '[{tx.DIGIT}]'))
  or (length(regexp_replace(t, '[^\p{{L}}]', '', 'g')) > 2 and not (regexp_matches(t, '\p{{Lu}}') and not regexp_matches(t, '\p{{Ll}}')) and not regexp_matches(t, '[aeiouyAEIOUY]'))
  or len(regexp_extract_all(t, '\p{{Ll}}\p{{Lu}}')) >= 2)"""
_GARBAGE_PAGES = f"""
p as (select text_id, model, doc, page, list_filter(regexp_split_to_array(text, '[{_SP}]+'), lambda x: x <> '') as toks from {PAGES}),
u as (select text_id, unnest(toks) as t from p),
g as (select text_id, sum(case when {_GARBAGE} then 1 else 0 end)::double / count(*) as score from u group by 1),
s as (select p.model, p.doc, p.page, g.score from p join g using (text_id))"""


def _board(name: str, source: str, value: str, higher: bool | None) -> str:
    best = "max" if higher else "min"
    win = "" if higher is None else f""",
{name}_c as (select doc from {name}_d group by doc having count(distinct model) = (select count(distinct model) from {name}_d)),
{name}_w as (select model, round(avg((mean = best)::int::double), 6) as win from (select *, {best}(mean) over (partition by doc) as best from {name}_d where doc in (select doc from {name}_c)) group by model),
{name} as (select m.model, m.mean, case when (select count(*) from {name}_m) >= 2 then w.win end as win from {name}_m m left join {name}_w w using (model))"""
    return f"""{name}_d as (select model, doc, round(avg({value}), 6) as mean from {source} where {value} is not null group by 1, 2),
{name}_m as (select model, round(avg(mean), 6) as mean from {name}_d group by 1){win}"""


def garbage_pages(spark, d) -> DataFrame:
    return page_texts(spark, d).select("text_id", "model", "doc", "page", garbage_fraction(F.col("text")).alias("score")).where("score is not null")


@query(f"with {_GARBAGE_PAGES}, {_board('garbage', 's', 'score', False)} select model, mean as garbage, win as garbage_win from garbage")
def garbage_leaderboard(spark, d):
    """The flagship: garbage share of every page's text, weighted by document, with win rates."""
    return lb.metric_columns(garbage_pages(spark, d), F.col("score"), "garbage", False)


_SELECTED = f"""
r as (select response_id, model, source_path as doc, page_num as page, attempt, coalesce(is_valid, false) as v, coalesce(is_terminal, false) as t, natural_text, input_tokens, output_tokens, coalesce(is_fallback, false) as fb from {RESPONSES}),
k as (select model, doc, page, min(attempt) filter (v) as va, min(attempt) filter (t) as ta, count(*) as n_attempts from r where attempt < 8 group by all),
c as (select model, doc, page, case when va is not null and (ta is null or va < ta) then va end as attempt, not (va is not null and (ta is null or va < ta)) as is_fallback, n_attempts from k)"""


def response_attempts(spark, d, text: bool = False) -> DataFrame:
    """Evaluated attempts, one a response. Without ``text`` the texts are neither read nor shuffled."""
    r = responses(spark, d, *["natural_text"] * text, "model", "source_path", "page_num", "attempt", "is_valid", "is_terminal", "input_tokens", "output_tokens", "is_fallback", "primary_language", "is_rotation_valid", "rotation_correction", "is_table", "is_diagram")
    no = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return r.select("response_id", "model", F.col("source_path").alias("doc"), F.col("page_num").alias("page"), "attempt", no("is_valid"), no("is_terminal"), no("is_fallback"), F.col("natural_text") if text else F.lit(None).cast("string").alias("natural_text"), "input_tokens", "output_tokens",
                    "primary_language", "is_rotation_valid", "rotation_correction", "is_table", "is_diagram")


_KEYS = ["model", "doc", "page"]


def selected(spark, d, text: bool = False) -> DataFrame:
    """The chosen attempt of every page; a response that is itself a fallback keeps that mark."""
    a = response_attempts(spark, d, text)
    p = pg.selected_pages(a.drop("is_fallback"), _KEYS)
    own = a.select(*_KEYS, "attempt", F.col("is_fallback").alias("_own"))
    return p.join(own, [*_KEYS, "attempt"], "left").withColumn("is_fallback", F.col("is_fallback") | F.coalesce("_own", F.lit(False))).drop("_own")


_PAGE_ROWS = _SELECTED + """,
q as (select c.model, c.doc, c.page, c.attempt, c.is_fallback or coalesce(r.fb, false) as is_fallback, c.n_attempts, r.natural_text,
             case when c.is_fallback then 0 else coalesce(r.input_tokens, 0) end::bigint as input_tokens, case when c.is_fallback then 0 else coalesce(r.output_tokens, 0) end::bigint as output_tokens
      from c left join r on r.model = c.model and r.doc = c.doc and r.page = c.page and r.attempt = c.attempt)"""


@query(f"with {_PAGE_ROWS} select model, doc, page, attempt, is_fallback, n_attempts from q")
def attempt_selection(spark, d):
    """Which attempt each page ends with, and which pages fall back."""
    return selected(spark, d).select(*_KEYS, "attempt", "is_fallback", "n_attempts")


_REJECT = "rj as (select model, doc, count(*) as total_pages, sum(is_fallback::int) as fallback_pages, sum(is_fallback::int)::double / count(*) as rate from q group by 1, 2)"
_ONCE = {t: f"(select distinct * from {t})" for t in ("correction_rate", "garbage_fraction", "peer_agreement", "pplx")}


_BAG = f"""p as (select text_id, model, doc, page, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') as w from {PAGES}),
u as (select text_id, t, count(*) as n from (select text_id, unnest(w) as t from p) group by all)"""
_F1 = """, sh as (select x.a, x.b, sum(least(u.n, v.n)) as s from x join u on u.text_id = x.a join v on v.text_id = x.b and v.t = u.t group by all)
"""


_LAYER = f"""{_BAG}, v as (select * from u), lay as (select * from p where model = 'legacy-ocr'), tx as (select text_id, length(regexp_replace(text, '[^\\p{{L}}\\p{{N}}]', '', 'g')) as an from {PAGES}),
x as (select a.text_id as a, b.text_id as b, a.model, a.doc, a.page, len(a.w) as na, len(b.w) as nb from p a join lay b on a.doc = b.doc and a.page = b.page join tx on tx.text_id = b.text_id where a.model <> 'legacy-ocr' and tx.an >= 25){_F1},
tlp as (select model, doc, page, case when na = 0 and nb = 0 then 1.0 when na = 0 or nb = 0 then 0.0 else 2.0::double * coalesce(s, 0) / (na + nb) end::double as bow_f1 from x left join sh using (a, b))"""


def metric_tables(spark, d) -> dict[str, DataFrame]:
    t = {n: table(spark, d, n).distinct() for n in ("correction_rate", "garbage_fraction", "peer_agreement", "pplx")}
    s = selected(spark, d)
    t["reject_rate"] = s.groupBy("model", "doc").agg(F.sum(F.col("is_fallback").cast("bigint")).alias("fallback_pages"), F.count("*").alias("total_pages"))
    t["runs"] = table(spark, d, "runs").select("model")
    return t


def textlayer(spark, d, ned: bool) -> DataFrame:
    """Agreement with a text layer; one run's texts stand for it."""
    p = _pages_once(spark, d)
    layer = p.where("model = 'legacy-ocr'").select("doc", "page", F.col("text").alias("layer"))
    mine = p.where("model <> 'legacy-ocr'")
    metas = mine.select("model", "doc").distinct().withColumn("fallback_pages", F.lit(0))
    return agreement.textlayer_agreement(mine, metas, layer, ned=ned)[0]


@query(f"""with {_PAGE_ROWS.replace("r as (", "rs as (", 1).replace(" from r ", " from rs ").replace("join r on r.", "join rs r on r.")}, {_REJECT}, {_LAYER}, {_board('tf', 'tlp', 'bow_f1', True)},
{_board('cr', _ONCE['correction_rate'], 'correction_rate', False)}, {_board('ur', _ONCE['correction_rate'], 'uncorrectable_rate', None)}, {_board('gf', _ONCE['garbage_fraction'], 'score', False)},
{_board('pf', _ONCE['peer_agreement'], 'bow_f1', True)}, {_board('pn', _ONCE['peer_agreement'], 'one_minus_ned', None)}, {_board('rr', 'rj', 'rate', False)},
px as (select model, round(avg(ppl_raw), 6) as ppl_raw, round(avg(ppl_corrected), 6) as ppl_corr from {_ONCE['pplx']} group by 1),
m as (select model from runs union select model from correction_rate union select model from garbage_fraction union select model from peer_agreement union select model from rj)
select m.model, cr.mean as corr_rate, cr.win as corr_rate_win, ur_m.mean as uncorr_rate, gf.mean as garbage, gf.win as garbage_win, pf.mean as peer_f1, pf.win as peer_f1_win, pn_m.mean as peer_ned, tf.mean as tl_f1, tf.win as tl_f1_win,
 rr.mean as reject_rate, rr.win as reject_rate_win, px.ppl_raw, px.ppl_corr
from m left join cr using (model) left join ur_m using (model) left join gf using (model) left join pf using (model) left join pn_m using (model) left join tf using (model) left join rr using (model) left join px using (model)""")
def run_leaderboard(spark, d):
    """The leaderboard over the stored metrics and the words of the text layer; ``run_leaderboard_full`` has its edit distances too."""
    return lb.leaderboard(metric_tables(spark, d) | {"textlayer_agreement": textlayer(spark, d, False)}).drop("tl_ned")


@query()
def run_leaderboard_full(spark, d):
    return lb.leaderboard(metric_tables(spark, d) | {"textlayer_agreement": textlayer(spark, d, True)})


@query("select model, doc, page, score from (select distinct * from garbage_fraction) order by score desc, model, doc, page limit 10")
def top_garbage_pages(spark, d):
    return lb.top_rows(table(spark, d, "garbage_fraction").distinct(), "score", 10)


@query(f"with {_PAGE_ROWS}, {_REJECT}, {_board('rr', 'rj', 'rate', False)} select model, mean as reject_rate, win as reject_rate_win from rr")
def reject_rates(spark, d):
    return lb.metric_columns(metric_tables(spark, d)["reject_rate"], F.expr("try_divide(cast(fallback_pages as double), total_pages)"), "reject_rate", False)


# --- quality gate ------------------------------------------------------------------------------------------------------

_TOK = r"regexp_extract_all(lower(natural_text), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\x{0085}\x{00A0}\x{2028}\x{2029}\x{202F}\x{3000}]')"


_NGRAM_LOOPS = f"""with r as (select response_id, {_TOK} as w from {RESPONSES} where natural_text is not null),
a as (select response_id, len(w) as n, unnest(range(1, len(w) + 1)) as i, w from r where len(w) >= 6),
one as (select response_id, n, max(c) as top from (select response_id, n, w[i] as x, count(*) as c from a group by all) group by all),
k as (select unnest([2, 3, 4, 5]) as k),
g as (select response_id, n, k, max(c) as top from (select response_id, n, k, list_aggregate(w[i:i+k-1], 'string_agg', chr(1)) as x, count(*) as c from a, k where n >= 24 and n >= 8 * k and i <= n - k + 1 group by all) group by all)
select response_id from one where top >= 6 and top >= 0.75 * n union select response_id from g where top >= 12 and top * k >= 0.35 * n"""
_TAIL_LOOPS = f"""with r as (select response_id, {_trim('natural_text')} as t from {RESPONSES} where natural_text is not null),
x as (select response_id, t, length(t) as n, unnest([0, 8, 24, 64, 160, 400]) as tr from r where length(t) >= 100),
y as (select response_id, t, n, n - tr as e, unnest(range(1, 201)) as p from x where n - tr >= 100),
z as (select *, greatest(100, 5 * p, ceil(round(0.35 * n, 9))::bigint) as need from y)
select distinct response_id from z where need <= e and t[e] = t[e - p] and substr(t, e - need + 1, need - p) = substr(t, e - need + 1 + p, need - p)"""
_FILL = f"[{_SP}_.–—·•*=~-]"
_GATE = f"""
ngram as ({_NGRAM_LOOPS}), tail as ({_TAIL_LOOPS}),
e as (select response_id, is_valid, {_trim("coalesce(natural_text, '')")} as t from {RESPONSES}),
l as (select *, lower(t) as low, string_split(t, chr(10)) as ln, length(t) - length(replace(t, chr(65533), '')) as lost from e),
f as (select *, list_position(list_transform(ln[2:], lambda x: {_trim('x')}), '---') as fin from l),
kk as (select response_id, is_valid, case when t = '' then 'empty_output'
  when lost >= 3 or lost::double / length(t) > 0.02 then 'mojibake'
  when regexp_matches(t, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]') then 'control_characters'
  when regexp_matches(low, '\\bas an ai\\b|\\bi am unable to help\\b|\\bi can''?t help\\b|\\bi cannot help\\b|\\bi cannot provide\\b|\\bi cannot comply\\b') or (length(t) <= 600 and regexp_matches(low, '\\bi''?m sorry\\b|\\bsorry,? but\\b')) then 'refusal'
  when starts_with(t, '---') and (coalesce(fin, 0) = 0 or len(list_filter(ln[2:fin], lambda x: length(x) - length(replace(x, '[', '')) <> length(x) - length(replace(x, ']', '')) or length(x) - length(replace(x, '{{', '')) <> length(x) - length(replace(x, '}}', '')))) > 0) then 'malformed_frontmatter'
  when list_bool_or(list_transform(list_distinct(string_split(t, '')), lambda c: not regexp_matches(c, '{_FILL}') and contains(t, repeat(c, 24)))) then 'repeated_character'
  when response_id in (from ngram) then 'repeated_ngram' when response_id in (from tail) then 'repeated_tail'
  when ends_with(low, '...') or ends_with(low, '[...]') or contains(low, 'truncated') then 'truncation_indicator'
  when length(t) < 5 or length(t) > 50000 then 'length_anomaly' else 'ok' end as kind from f)"""


def gate_kinds(spark, d) -> DataFrame:
    t = responses(spark, d, "natural_text", "is_valid").select("response_id", "is_valid", tx.strip(F.coalesce("natural_text", F.lit(""))).alias("t"))
    return t.select("response_id", "is_valid", quality.verdict(F.col("t")).alias("kind"))


_RETRY = "case when kind = 'ok' then 'none' when kind = 'refusal' then 'terminal' else 'retryable' end as retry_class"


@query(f"with {_GATE} select kind, {_RETRY}, count(*) as n from kk group by 1, 2")
def quality_gate_counts(spark, d):
    """Numbers of verdicts."""
    return gate_kinds(spark, d).groupBy("kind", quality.retry_class(F.col("kind")).alias("retry_class")).agg(F.count("*").alias("n"))


@query(f"with {_GATE} select response_id, kind, {_RETRY} from kk")
def quality_gate_full(spark, d):
    """Verdict of every response by all checks."""
    return gate_kinds(spark, d).select("response_id", "kind", quality.retry_class(F.col("kind")).alias("retry_class"))


@query(f"""with {_GATE}, c as (select kind, count(*) as n from kk where not coalesce(is_valid, false) group by 1), t as (select * from c order by n desc, kind limit 3)
select kind, n from t union all select '+more', greatest((select count(*) from c) - 3, 0) where (select count(*) from c) > 3""")
def top_rejects(spark, d):
    """The commonest rejects."""
    return corpus.top_rejects(gate_kinds(spark, d).where(~F.coalesce("is_valid", F.lit(False))))


@query(_NGRAM_LOOPS)
def ngram_loops(spark, d):
    """Responses in which one phrase is repeated through a third of the text."""
    r = responses(spark, d, "natural_text").where("natural_text is not null")
    return r.where(quality._ngram_loop("natural_text")).select("response_id")


@query(_TAIL_LOOPS)
def tail_loops(spark, d):
    """Responses whose last third repeats one unit."""
    r = responses(spark, d, "natural_text").where("natural_text is not null")
    return r.where(quality._tail_loop(tx.strip(F.col("natural_text")))).select("response_id")


@query(f"""with t as (select doc_id, text, regexp_replace(text, '[{_SP}]+', ' ', 'g') as s from documents), r as (select *, string_split(reverse(s), '') as r from t)
select doc_id, case when text is not null then array_to_string(list_transform(range(1, 11), lambda n: case when n > length(s) then 0
 else 1 + coalesce(nullif(list_position(list_transform(range(1, length(s) - n + 1), lambda i: r[i] = r[i+n]), false), 0) - 1, length(s) - n) // n end), ',') end as repeats from r""")
def trailing_repeats(spark, d):
    @F.pandas_udf("array<int>")
    def repeats(t: pd.Series) -> pd.Series:
        return t.map(loops.trailing_repeats, na_action="ignore")

    return spread(table(spark, d, "documents", "doc_id", "text")).select("doc_id", F.array_join(repeats("text").cast("array<string>"), ",").alias("repeats"))


# --- documents and pages -----------------------------------------------------------------------------------------------

_CONTENT = _PAGE_ROWS + """,
o as (select *, case when natural_text is null then '' when page = max(page) over (partition by model, doc) then natural_text else natural_text || chr(10) end as c from q),
b as (select *, coalesce(sum(length(c)) over (partition by model, doc order by page rows between unbounded preceding and 1 preceding), 0) as a from o)"""


def assembled(spark, d) -> DataFrame:
    return pg.assemble(selected(spark, d, True), ["model", "doc"], "0", F.lit("2025-01-01"), max_rate=0.25)


@query(f"""with {_CONTENT} select model, doc, sha1(string_agg(c, '' order by page)) as id, length(string_agg(c, ''))::bigint as n_chars, count(*) as pages, sum(input_tokens)::bigint as input_tokens, sum(output_tokens)::bigint as output_tokens,
 sum(is_fallback::int)::bigint as fallback_pages, string_agg((a::bigint)::varchar || '-' || ((a + length(c))::bigint)::varchar || '-' || page::varchar, ' ' order by page) as spans,
 case when sum(is_fallback::int) > 0 then 'partial' else 'ok' end as outcome
from b group by model, doc having string_agg(c, '') <> '' and sum(is_fallback::int)::double / count(*) <= 0.25""")
def assemble_documents(spark, d):
    m, a = F.col("metadata"), F.col("attributes.pdf_page_numbers")
    return assembled(spark, d).select("model", "doc", "id", F.length("text").cast("bigint").alias("n_chars"), m["pdf-total-pages"].alias("pages"), m["total-input-tokens"].alias("input_tokens"), m["total-output-tokens"].alias("output_tokens"),
                                      m["total-fallback-pages"].alias("fallback_pages"), F.array_join(F.transform(a, lambda s: F.array_join(s.cast("array<string>"), "-")), " ").alias("spans"), "outcome")


@query(f"""with {_CONTENT}, g as (select model, doc from b group by 1, 2 having string_agg(c, '') <> '' and sum(is_fallback::int)::double / count(*) <= 0.25)
select model, doc, page, sha1(c) as text_sha1 from b semi join g using (model, doc) where c <> ''""")
def explode_pages(spark, d):
    """Documents cut into pages again: the slices are the pages that went in."""
    p = pg.explode_pages(assembled(spark, d), F.col("model"))
    return p.select("model", "doc", "page", F.sha1(F.encode("text", "UTF-8")).alias("text_sha1"))


@query(f"""with {_PAGE_ROWS}, x as (select model, doc, count(*) as p, sum(is_fallback::int) as f from q group by all)
select case when f::double / p > 0.25 then 'discarded' when f > 0 then 'partial' else 'ok' end as outcome, count(*) as n from x group by 1""")
def outcome_counts(spark, d):
    return pg.outcome_counts(selected(spark, d), ["model", "doc"], 0.25)


@query(f"""with {_PAGE_ROWS}, x as (select model, doc, count(*) as p, sum(is_fallback::int) as f from q group by all), e as (select distinct model, doc from page_texts),
boom as (select distinct model, doc from page_texts where length(doc) % 11 = 0)
select case when boom.doc is not null then 'crashed' when p is null then 'missing' when f::double / p > 0.25 then 'discarded' when f > 0 then 'partial' else 'ok' end as outcome, count(*) as n
from x full join e using (model, doc) left join boom using (model, doc) group by 1""")
def all_outcomes(spark, d):
    """Outcomes of documents, crashed and missing ones too; which crashed is made up."""
    e = table(spark, d, "page_texts", "model", "doc")
    return pg.outcome_counts(selected(spark, d), ["model", "doc"], 0.25, e, e.where(F.length("doc") % 11 == 0))


@query(f"""with {_PAGE_ROWS}, x as (select count(*) as p, sum(is_fallback::int) as f, sum(input_tokens) as i, sum(output_tokens) as o from q group by model, doc)
select count(*) as docs, sum(p)::bigint as pages, sum(f)::bigint as fallback_pages, sum(i)::bigint as input_tokens, sum(o)::bigint as output_tokens, sum((o > 32768)::int)::bigint as long_docs, sum(case when o > 32768 then o else 0 end)::bigint as long_tokens,
 round(sum(p)::double / count(*), 6) as pages_per_doc, round(sum(o)::double / count(*), 6) as tokens_per_doc, round(sum(o)::double / sum(p), 6) as tokens_per_page from x""")
def workspace_stats(spark, d):
    x = selected(spark, d).groupBy("model", "doc").agg(F.count("*").alias("pages"), F.sum(F.col("is_fallback").cast("bigint")).alias("fallback_pages"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"))
    return corpus.workspace_stats(x)


_COUNTERS = _PAGE_ROWS + """,
n as (select 'finished_on_attempt_' || attempt::varchar as key, count(*) as value from q where attempt is not null group by 1 union all select 'completed_pages', count(*) filter (not is_fallback) from q
 union all select 'failed_pages', count(*) filter (is_fallback) from q union all select 'server_input_tokens', coalesce(sum(input_tokens), 0) from r union all select 'server_output_tokens', coalesce(sum(output_tokens), 0) from r)"""


def counters(spark, d) -> DataFrame:
    s, a = selected(spark, d), response_attempts(spark, d)
    by = s.where("attempt is not null").groupBy(F.concat(F.lit("finished_on_attempt_"), F.col("attempt").cast("string")).alias("key")).agg(F.count("*").alias("value"))
    fb = F.col("is_fallback").cast("bigint")
    sums = s.agg(F.coalesce(F.sum(1 - fb), F.lit(0)).alias("completed_pages"), F.coalesce(F.sum(fb), F.lit(0)).alias("failed_pages"))
    tokens = a.agg(F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("server_input_tokens"), F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("server_output_tokens"))
    long = lambda t: t.unpivot([], t.columns, "key", "value")
    return by.unionByName(long(sums)).unionByName(long(tokens))


@query(f"with {_COUNTERS} select coalesce(sum(value) filter (key like 'finished_on_attempt_%' and key <> 'finished_on_attempt_0'), 0)::bigint as retries from n")
def retry_count(spark, d):
    return corpus.count_retries(counters(spark, d))


@query(f"""with {_COUNTERS}, s as (select sum(value) filter (key = 'completed_pages')::bigint as completed, sum(value) filter (key = 'failed_pages')::bigint as failed, sum(value) filter (key = 'server_input_tokens')::bigint as input_tokens,
 sum(value) filter (key = 'server_output_tokens')::bigint as output_tokens from n) select *, round(failed * 100.0::double / greatest(completed + failed, 1), 6) as failure_percent from s""")
def final_summary(spark, d):
    return corpus.final_summary(counters(spark, d))


# --- ledger and increments -----------------------------------------------------------------------------------------------

_SUMS = f"cs as (select model, doc, sha1(string_agg(page::varchar || chr(10) || text || chr(10), '' order by page, text)) as text_sha1 from {PAGES} group by 1, 2)"


def _pages_once(spark, d) -> DataFrame:
    return page_texts(spark, d).drop("text_id")


@query(f"select model, doc, sha1(string_agg(page::varchar || chr(0) || text || chr(0), '' order by page, text)) as text_sha1 from {PAGES} group by 1, 2")
def document_checksums(spark, d):
    return pg.document_checksums(_pages_once(spark, d))


@query(f"""with cs as (select model, doc, sha1(string_agg(page::varchar || chr(0) || text || chr(0), '' order by page, text)) as text_sha1 from {PAGES} group by 1, 2),
lg as (select model, doc, case when length(doc) % 3 = 1 then 'stale' else text_sha1 end as text_sha1 from cs where length(doc) % 3 < 2)
select p.model, p.doc, p.page from {PAGES} p where not exists (select 1 from lg join cs using (model, doc, text_sha1) where lg.model = p.model and lg.doc = p.doc)""")
def todo_pages(spark, d):
    """Pages still to be scored, with a ledger that has a third of the documents done, a third stale and a third not at all."""
    p = _pages_once(spark, d)
    sums = pg.document_checksums(p)
    k = F.length("doc") % 3
    ledger = sums.where(k < 2).select("model", "doc", F.lit("garbage").alias("phase"), F.when(k == 1, F.lit("stale")).otherwise(F.col("text_sha1")).alias("text_sha1"))
    return st.todo(p, sums, ledger, "garbage").select("model", "doc", "page")


@query("""with p as (select distinct model, doc, page from page_texts where text is not null), s as (select distinct model, peer, doc, page from peer_agreement)
select a.doc, a.page, a.model, b.model as peer from p a join p b on a.doc = b.doc and a.page = b.page and a.model < b.model
where not exists (select 1 from s where s.doc = a.doc and s.page = a.page and s.model = a.model and s.peer = b.model) or not exists (select 1 from s where s.doc = a.doc and s.page = a.page and s.model = b.model and s.peer = a.model)""")
def missing_pairs(spark, d):
    """Pairs of runs on a page whose agreement is not stored in both directions."""
    return st.missing_pairs(page_texts(spark, d), table(spark, d, "peer_agreement").distinct())


@query("select distinct * from peer_agreement where not (model = 'folio-vl' or peer = 'folio-vl')")
def clear_run(spark, d):
    return st.clear_run(table(spark, d, "peer_agreement").distinct(), "folio-vl")


@query("""with k as (select distinct doc from garbage_fraction where model = 'folio-vl' and page >= 2)
select distinct * from peer_agreement where not (model = 'folio-vl' or peer = 'folio-vl') or doc in (select doc from k)""")
def prune_documents(spark, d):
    keep = table(spark, d, "garbage_fraction").where("model = 'folio-vl' and page >= 2").select("doc")
    return st.prune(table(spark, d, "peer_agreement").distinct(), "folio-vl", keep)


@query("""with o as (select distinct model, doc, page, score from garbage_fraction), n as (select distinct model, doc, page, round(score / 2, 9) as score from garbage_fraction where page = 1)
select * from n union all select o.* from o anti join n using (model, doc, page)""")
def upsert_scores(spark, d):
    """New scores replace old ones of the same page."""
    o = table(spark, d, "garbage_fraction").select("model", "doc", "page", "score").distinct()
    return st.upsert(o, o.where("page = 1").withColumn("score", F.round(F.col("score") / 2, 9)), ["model", "doc", "page"])


@query("select model, input_path, case when model = 'legacy-ocr' then 'scorer-b-4b' else pplx_scorer_model end as pplx_scorer_model from runs where model <> 'new-run' union all select 'new-run', 'runs/new', null")
def register_runs(spark, d):
    """The registry after a run without scorer and another scorer for an old run."""
    runs, pplx = table(spark, d, "runs"), table(spark, d, "pplx")
    runs, pplx = st.register(runs, "new-run", "runs/new", None, pplx)
    return st.register(runs, "legacy-ocr", "imports/legacy_ocr.jsonl", "scorer-b-4b", pplx)[0]


@query("""with s as (select distinct model, doc from pplx), l as (select distinct model, doc from garbage_fraction where page > 3) select s.model, s.doc from s anti join l using (model, doc)""")
def adopted_documents(spark, d):
    """Documents with perplexities but no record, that adopt the present text."""
    sums = table(spark, d, "pplx").select("model", "doc").distinct().withColumn("text_sha1", F.sha1(F.col("doc").cast("binary")))
    ledger = table(spark, d, "garbage_fraction").where("page > 3").select("model", "doc").distinct().select("model", "doc", F.lit("pplx").alias("phase"), F.lit("x").alias("text_sha1"))
    return st.adopt(ledger, table(spark, d, "pplx"), sums, "pplx").where("text_sha1 <> 'x'").select("model", "doc")


# --- agreement -----------------------------------------------------------------------------------------------------------

@query(f"""with {_BAG}, v as (select * from u), x as (select a.text_id as a, b.text_id as b, a.model, b.model as peer, a.doc, a.page, len(a.w) as na, len(b.w) as nb from p a join p b on a.doc = b.doc and a.page = b.page and a.model < b.model){_F1},
r as (select x.*, round(case when na = 0 and nb = 0 then 1.0 when na = 0 or nb = 0 then 0.0 else 2.0::double * coalesce(s, 0) / (na + nb) end, 6)::double as bow_f1 from x left join sh using (a, b))
select model, peer, doc, page, bow_f1 from r union all select peer, model, doc, page, bow_f1 from r""")
def peer_bow_f1(spark, d):
    """Bag-of-words agreement of all pairs of runs, from the texts."""
    return agreement.peer_agreement(_pages_once(spark, d), ned=False).select("model", "peer", "doc", "page", F.round("bow_f1", 6).alias("bow_f1"))


@query()
def peer_agreement(spark, d):
    """Both agreements of all pairs of runs, on the whole texts in any script."""
    return agreement.peer_agreement(_pages_once(spark, d)).select("model", "peer", "doc", "page", F.round("bow_f1", 6).alias("bow_f1"), F.round("one_minus_ned", 6).alias("one_minus_ned"))


@query(f"with {_LAYER} select model, doc, page, round(bow_f1, 6)::double as bow_f1 from tlp")
def textlayer_bow_f1(spark, d):
    """Agreement with a text layer; one run's texts stand for it."""
    return textlayer(spark, d, False).select("model", "doc", "page", F.round("bow_f1", 6).alias("bow_f1"))


@query()
def textlayer_agreement(spark, d):
    """Both agreements with the text layer, on the whole texts."""
    return textlayer(spark, d, True).select("model", "doc", "page", F.round("bow_f1", 6).alias("bow_f1"), F.round("one_minus_ned", 6).alias("one_minus_ned"))


# --- spelling ------------------------------------------------------------------------------------------------------------

_DICT = "dw as (select lower(t) as word, count(*) as n from (select unnest(regexp_extract_all(text, '[A-Za-z]+')) as t from documents where lang = 'en' and text is not null) group by 1 having count(*) >= 20)"


def corpus_dictionary(spark, d, least: int = 20) -> DataFrame:
    t = spread(table(spark, d, "documents", "lang", "text")).where("lang = 'en' and text is not null").select(F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z]+)"), F.lit(1))).alias("word"))
    return t.groupBy(F.lower("word").alias("word")).agg(F.count("*").alias("count")).where(F.col("count") >= least)


@query(f"""with {_DICT}, k as (select text_id, model, doc, page, unnest(regexp_extract_all(text, '[A-Za-z]+')) as t from {PAGES})
select k.model, k.doc, k.page, count(*) as n_tokens, count(*) filter (dw.word is null) as n_unknown from k left join dw on dw.word = lower(k.t) group by all""")
def unknown_tokens(spark, d):
    """Alphabetic tokens of each page and how many the dictionary lacks."""
    t = spelling.page_tokens(_pages_once(spark, d), _KEYS)
    w = corpus_dictionary(spark, d).select(F.col("word").alias("_w"))
    x = t.join(w, F.lower("token") == F.col("_w"), "left")
    return x.groupBy(*_KEYS).agg(F.sum("n").alias("n_tokens"), F.coalesce(F.sum(F.when(F.col("_w").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("n_unknown"))


@query()
def correction_rates(spark, d):
    """Correction and uncorrectable rates of each page, by a dictionary of the corpus."""
    return spelling.correction_rates(_pages_once(spark, d), materialise(corpus_dictionary(spark, d), "dictionary"), _KEYS)


# --- corpus ----------------------------------------------------------------------------------------------------------------

_SPAM = ", ".join(f"'{w}'" for w in corpus.SPAM_WORDS)


@query(f"""with x as (select doc_id, text, lang, list_filter(string_split(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'), ' '), lambda t: t <> '') as w from documents)
select doc_id, case when text is null then 'unreadable' when length(text) < 200 then null when length(regexp_replace(text, '[^\\p{{L}}]', '', 'g'))::double / length(text) < 0.5 then null
 when not (lang is null or lang = 'en') then 'language' when len(w) > 0 and len(list_filter(w, lambda t: t in ({_SPAM})))::double / len(w) > 0.004 then 'spam' end as reason from x""")
def corpus_filter(spark, d):
    x = spread(table(spark, d, "documents", "doc_id", "text", "lang"))
    return x.select("doc_id", corpus.filter_reason(F.col("text"), F.col("lang")).alias("reason"))


@query("""with p as (select distinct source_path as path from page_responses where source_path is not null), g as (select path, (row_number() over (order by path) - 1) // 100 as g from p)
select sha1(string_agg(path, '' order by path)) as hash, count(*) as n from g group by g.g""")
def work_groups(spark, d):
    return corpus.work_groups(table(spark, d, "page_responses").select(F.col("source_path").alias("path")), 100).select("hash", F.size("paths").cast("bigint").alias("n"))


@query(r"""with s as (select distinct source_path as s from page_responses union select distinct '/data/packs/b' || (doc_id % 7)::varchar || '.tar.gz::in/../' || source_file from documents),
e as (select s, case when contains(s, '::') then regexp_replace(regexp_replace(regexp_replace(split_part(s, '::', 1), '^.*/', ''), '\.[^.]*$', ''), '\.tar$', '') || '/' || split_part(s, '::', 2) else s end as r from s)
select s as source, 'markdown/' || regexp_replace(array_to_string(list_filter(string_split(r, '/'), lambda x: x <> '' and x <> '..'), '/'), '\.[^./]*$', '') || '.md' as path from e""")
def markdown_paths(spark, d):
    s = table(spark, d, "page_responses").select(F.col("source_path").alias("source")).union(
        table(spark, d, "documents").select(F.concat(F.lit("/data/packs/b"), (F.col("doc_id") % 7).cast("string"), F.lit(".tar.gz::in/../"), F.col("source_file")))).distinct()
    return s.select("source", tx.markdown_path(F.col("source")).alias("path"))


_GROUPS = """p as (select distinct source_path as path from page_responses where source_path is not null), g as (select path, (row_number() over (order by path) - 1) // 100 as g from p),
w as (select sha1(string_agg(path, '' order by path)) as hash, list(path order by path) as paths from g group by g.g)"""


def _work(spark, d) -> DataFrame:
    return corpus.work_groups(table(spark, d, "page_responses").select(F.col("source_path").alias("path")), 100)


@query(f"""with {_GROUPS} select array_to_string(list_transform(list_concat([hash], paths), lambda x: case when regexp_matches(x, '[,"\\r\\n]') then '"' || replace(x, '"', '""') || '"' else x end), ',') as line from w""")
def work_index(spark, d):
    """The work index as CSV rows, written and read once before."""
    return corpus.index_lines(corpus.read_index(corpus.index_lines(_work(spark, d))))


@query(f"with {_GROUPS} select hash, len(paths)::bigint as n from w where hash >= '8'")
def remaining_work(spark, d):
    """Groups that are not done, half of them being so."""
    w = _work(spark, d)
    return corpus.shuffled(corpus.remaining_work(w, w.where("hash < '8'")), 3).select("hash", F.size("paths").cast("bigint").alias("n"))


@query("select model, regexp_replace(input_path, '[^\\p{L}\\p{N}_]+', '_', 'g') as name, rtrim(input_path, '/') || '/metrics' as url from runs")
def run_names(spark, d):
    """Names of runs that are safe for files, and the address of the metrics beside an API's."""
    return table(spark, d, "runs").select("model", tx.sanitize_name(F.col("input_path")).alias("name"), tx.metrics_url(F.concat("input_path", F.lit("/v1/"))).alias("url"))


# --- answers of models -------------------------------------------------------------------------------------------------------

_PLAIN = f"nullif({_trim('natural_text')}, '')"


@query(f"""select response_id, case when lower(primary_language) in ('null', '~', '', 'no', 'yes', 'on', 'off', 'true', 'false') then null else {_trim('primary_language')} end as primary_language, is_rotation_valid, rotation_correction, is_table, is_diagram,
 {_PLAIN} as natural_text from {RESPONSES} where is_rotation_valid is not null and is_table is not null and is_diagram is not null and rotation_correction is not null""")
def front_matter(spark, d):
    """Answers with a YAML preamble, taken apart."""
    r = responses(spark, d, "primary_language", "is_rotation_valid", "rotation_correction", "is_table", "is_diagram", "natural_text").where("is_rotation_valid is not null and is_table is not null and is_diagram is not null and rotation_correction is not null")
    flag = lambda c: F.when(F.col(c), "True").otherwise("False")
    raw = F.concat(F.lit("---\nprimary_language: "), F.coalesce("primary_language", F.lit("null")), F.lit("\nis_rotation_valid: "), flag("is_rotation_valid"), F.lit("\nrotation_correction: "), F.col("rotation_correction").cast("string"),
                   F.lit("\nis_table: "), flag("is_table"), F.lit("\nis_diagram: "), flag("is_diagram"), F.lit("\n---\n"), F.coalesce("natural_text", F.lit("")))
    return r.select("response_id", parsers.front_matter(raw).alias("p")).select("response_id", *[f"p.{c}" for c in ("primary_language", "is_rotation_valid", "rotation_correction", "is_table", "is_diagram", "natural_text")])


@query(f"select response_id, {_PLAIN} as natural_text, contains(lower(coalesce({_PLAIN}, '')), '<table') as is_table from {RESPONSES} where natural_text is not null")
def fenced_answers(spark, d):
    """Answers in a code fence and with reasoning before it, parsed to the text alone."""
    r = responses(spark, d, "natural_text").where("natural_text is not null")
    raw = F.concat(F.lit("<think>a\nb</think>```markdown\n"), F.col("natural_text"), F.lit("\n```\n"))
    return r.select("response_id", parsers.with_html_tables(raw).alias("p")).select("response_id", "p.natural_text", "p.is_table")


_TEMPERATURE = "case attempt when 0 then '0.1' when 1 then '0.1' when 2 then '0.2' when 3 then '0.3' when 4 then '0.5' when 5 then '0.8' when 6 then '0.9' else '1.0' end"


@query(f"""select response_id, '{{"model":"served","messages":[{{"role":"user","content":[{{"type":"text","text":"Read page ' || page_num || '"}},{{"type":"image_url","image_url":{{"url":"data:image/png;base64,' || to_base64(source_path::blob) || '"}}}}]}}],"max_tokens":12000,"temperature":'
 || {_TEMPERATURE} || ',"top_p":1.0}}' as request from {RESPONSES}""")
def page_requests(spark, d):
    """The request of each attempt, with the attempt's temperature; a page's name stands for its picture."""
    r = responses(spark, d, "source_path", "page_num", "attempt")
    image, prompt = F.base64(F.encode("source_path", "UTF-8")), F.concat(F.lit("Read page "), F.col("page_num").cast("string"))
    return r.select("response_id", parsers.page_request(image, prompt, pg.temperature(F.col("attempt")), "qianfan-ocr", "served").alias("request"))


@query(f"select response_id, {_trim('natural_text')} as raw_text from {RESPONSES} where natural_text is not null")
def raw_texts(spark, d):
    """What stands between the text marks of a prompt."""
    r = responses(spark, d, "natural_text").where("natural_text is not null")
    prompt = F.concat(F.lit("Below is the text.\nRAW_TEXT_START\n"), F.col("natural_text"), F.lit("\nRAW_TEXT_END"))
    return r.select("response_id", tx.raw_text_of_prompt(prompt).alias("raw_text"))


@query(f"with {_GATE} select response_id, kind, kind in ('empty_output', 'repeated_ngram', 'repeated_character', 'repeated_tail') and (response_id % 3) / 200.0 < 0.01 as is_blank from kk")
def blank_pages(spark, d):
    """Rejections that a nearly blank render explains, with a made-up share of ink."""
    return gate_kinds(spark, d).select("response_id", "kind", quality.is_blank_page(F.col("kind"), F.col("response_id") % 3 / 200.0).alias("is_blank"))


@query()
def layout_markdown(spark, d):
    """HTML answers as Markdown."""
    r = responses(spark, d, "natural_text").where(F.lower("natural_text").rlike("<(div|p|table|h[1-6])[ >]"))
    return r.select("response_id", parsers.layout_html(F.col("natural_text")).alias("p")).select("response_id", "p.natural_text", "p.is_table", "p.is_diagram")


# --- perplexity ----------------------------------------------------------------------------------------------------------------

@query("""select model, doc, page, round(case when n_tokens_raw > 0 then exp(-sum_logprob_raw / n_tokens_raw) end, 6) as ppl_raw, round(case when n_tokens_corrected > 0 then exp(-sum_logprob_corrected / n_tokens_corrected) end, 6) as ppl_corrected
from (select distinct * from pplx)""")
def page_perplexities(spark, d):
    p = table(spark, d, "pplx").distinct()
    of = lambda k: F.round(tx.perplexity(F.col(f"sum_logprob_{k}"), F.col(f"n_tokens_{k}")), 6).alias(f"ppl_{k}")
    return p.select("model", "doc", "page", of("raw"), of("corrected"))


@query(f"""with recursive p as (select model, doc, page, length(text) + 1 as n, row_number() over (partition by model, doc order by page) as i from {PAGES}),
c as (select model, doc, page, i, n as used, 0 as chunk, 0::bigint as start from p where i = 1
 union all select p.model, p.doc, p.page, p.i, case when (c.used + p.n) // 3 > 1000 then p.n else c.used + p.n end, case when (c.used + p.n) // 3 > 1000 then c.chunk + 1 else c.chunk end,
  case when (c.used + p.n) // 3 > 1000 then 0 else c.used end from c join p on p.model = c.model and p.doc = c.doc and p.i = c.i + 1)
select model, doc, page, chunk, start from c""")
def token_chunks(spark, d):
    return pp.token_chunks(_pages_once(spark, d), ["model", "doc"], 1000)


def made_up_tokens(chunks: DataFrame, length, keys: list[str]) -> DataFrame:
    """Tokens of four characters over each chunk (``length``), the first without a score, as a scorer gives them."""
    t = chunks.withColumn("n", length).where("n > 0").select(*keys, "chunk", "n", F.posexplode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(4).cast("bigint"))).alias("pos", "k"))
    return t.select(*keys, "chunk", "pos", F.when(F.col("k") > 0, F.expr("repeat('x', int(least(4, n - k)))")).alias("decoded"), F.when(F.col("k") > 0, F.lit(-0.1) * (1 + F.col("k") % 7)).alias("logprob"))


@query()
def attributed_tokens(spark, d):
    """Token scores put back to all pages, in the chunks of ``token_chunks``: a token of four characters may reach into the next page, and each
    chunk has a first token without a score."""
    keys = ["model", "doc"]
    p = _pages_once(spark, d)
    chunks = materialise(pp.token_chunks(p, keys, 1000), "chunks")
    lengths = chunks.join(p.select(*keys, "page", F.length("text").cast("bigint").alias("l")), [*keys, "page"]).groupBy(*keys, "chunk").agg((F.sum(F.col("l") + 1) - 1).alias("l"))
    return pp.attribute_tokens(made_up_tokens(lengths, F.col("l"), keys), chunks, p, keys).select(*keys, "page", "n_tokens", F.round("sum_logprob", 6).alias("sum_logprob"))


# --- telemetry --------------------------------------------------------------------------------------------------------------------

@query("select event_id, round(sum(value) over (partition by event_type order by ts range between interval 300 seconds preceding and current row), 4) as window_sum from events")
def counter_window_5min(spark, d):
    e = table(spark, d, "events", "event_id", "ts", F.col("event_type").alias("key"), "value")
    return tl.window_sums(e).select("event_id", F.round("window_sum", 4).alias("window_sum"))


@query("select event_type as key, round(sum(value), 6) as total, round(round(sum(value), 6) / 300.0::double, 6) as per_second from events group by 1")
def counter_totals(spark, d):
    return tl.totals_and_rates(table(spark, d, "events").select(F.col("event_type").alias("key"), "value"), 300.0)


@query("""with recursive e as (select event_type as server, epoch_us(ts::timestamp) / 1e6 as ts, event_id, event_id // 997 as part, abs(value) as v from events),
c as (select server, ts, sum(v) over (partition by server, part order by event_id rows unbounded preceding) as gen,
 case when event_id % 5 > 0 then (count(*) over (partition by server, part order by event_id rows unbounded preceding))::double end as prompt from e),
n as (select server, ts, max(gen) as gen, max(prompt) as prompt, row_number() over (partition by server order by ts) as i from c group by server, ts),
r as (select server, ts, i, gen, prompt, gen as last_gen, prompt as last_prompt, 1 as part from n where i = 1
 union all select n.server, n.ts, n.i, n.gen, n.prompt, case when x.fell then n.gen else coalesce(n.gen, r.last_gen) end, case when x.fell then n.prompt else coalesce(n.prompt, r.last_prompt) end, r.part + x.fell::int
 from r join n on n.server = r.server and n.i = r.i + 1, lateral (select coalesce(n.gen < r.last_gen, false) or coalesce(n.prompt < r.last_prompt, false) as fell) x),
w as (select *, min(i) over (partition by server, part order by ts range between 60 preceding and current row) as a, min(i) over (partition by server, part) as f from r),
o as (select server, ts, gen, prompt, case when a = i then greatest(f, i - 1) else a end as a, f from w)
select o.server, o.ts, case when o.ts > a.ts then round((o.gen - a.gen) / (o.ts - a.ts), 4) end as gen_tps, case when o.ts > f.ts then round((o.gen - f.gen) / (o.ts - f.ts), 4) end as gen_tps_avg,
 case when o.ts > a.ts then round((o.prompt - a.prompt) / (o.ts - a.ts), 4) end as prompt_tps, case when o.ts > f.ts then round((o.prompt - f.prompt) / (o.ts - f.ts), 4) end as prompt_tps_avg,
 null::double as kv_hit, null::double as kv_hit_avg, null::double as running, null::double as waiting, null::double as kv_usage
from o join r a on a.server = o.server and a.i = o.a join r f on f.server = o.server and f.i = o.f""")
def counter_rates_with_reset(spark, d):
    """Rates of counters that are made of the events and restart now and then."""
    e = table(spark, d, "events", F.col("event_type").alias("server"), F.col("ts").cast("timestamp").cast("double").alias("ts"), "event_id", F.abs("value").alias("v"))
    w = Window.partitionBy("server", F.floor(F.col("event_id") / 997)).orderBy("event_id")
    s = e.select("server", "ts", "event_id", F.sum("v").over(w).alias("generation_tokens"), F.when(F.col("event_id") % 5 > 0, F.count("*").over(w).cast("double")).alias("prompt_tokens"))
    r = tl.counter_rates(s.groupBy("server", "ts").agg(F.max("generation_tokens").alias("generation_tokens"), F.max("prompt_tokens").alias("prompt_tokens")))
    return r.select("server", "ts", *[F.round(c, 4).alias(c) for c in r.columns[2:]])


@query("select event_id, 'vllm:' || event_type as name, (user_id % 2)::varchar as engine, round(value, 4) as value from events")
def exposition(spark, d):
    """Metric lines written and parsed."""
    e = table(spark, d, "events", "event_id", "user_id", "event_type", "value")
    text = F.concat(F.lit("# HELP x\nbad line here\nvllm:"), F.col("event_type"), F.lit('{engine="'), (F.col("user_id") % 2).cast("string"), F.lit('",model="m"} '), F.col("value").cast("string"), F.lit("\nnan_metric NaN\n"))
    return e.select("event_id", F.explode(tl.parse_exposition(text)).alias("s")).select("event_id", "s.name", F.col("s.labels")["engine"].alias("engine"), F.round("s.value", 4).alias("value"))


@query("""select event_id, (user_id % 7 + event_id % 5)::double as running, null::double as waiting, round((0.25 + (event_id % 4) / 8.0) / 2, 6) as kv_usage, (event_id * 2)::double as generation_tokens,
 user_id::double as prompt_tokens, user_id::double as cache_queries, case when event_id % 2 = 0 then 3.0 end::double as cache_hits from events""")
def server_snapshots(spark, d):
    """Metrics of scrapes: summed over engines, usage averaged, the older name where the newer is not there."""
    e = table(spark, d, "events", "event_id", "user_id")
    line = lambda name, engine, v: F.concat(F.lit(f'{name}{{engine="{engine}"}} '), v.cast("string"), F.lit("\n"))
    id_, user = F.col("event_id"), F.col("user_id")
    text = F.concat(line("vllm:num_requests_running", 0, user % 7), line("vllm:num_requests_running", 1, id_ % 5), line("vllm:gpu_cache_usage_perc", 0, F.lit(0.25)), line("vllm:gpu_cache_usage_perc", 1, id_ % 4 / 8.0),
                    line("vllm:generation_tokens_total", 0, id_), line("vllm:generation_tokens_total", 1, id_), line("vllm:prompt_tokens_total", 0, user), F.lit("# no metric\nvllm:num_requests_waiting NaN\n"),
                    F.when(id_ % 2 == 0, line("vllm:prompt_tokens_cached_total", 0, F.lit(3))).otherwise(F.lit("")))
    names = ["running", "waiting", "kv_usage", "generation_tokens", "prompt_tokens", "cache_queries", "cache_hits"]
    return tl.snapshots(e.select("event_id", text.alias("text"))).select("event_id", *[F.round(c, 6).alias(c) for c in names])


@query("select (user_id % 8)::bigint as worker, count(*) filter (event_type = 'click') as click, count(*) filter (event_type = 'view') as view from events group by 1")
def worker_states(spark, d):
    e = table(spark, d, "events").select((F.col("user_id") % 8).alias("worker"), F.col("event_type").alias("state"))
    return tl.worker_states(e, ["click", "view"]).select("worker", "click", "view")


# --- layout -----------------------------------------------------------------------------------------------------------------------

#: Boxes of a made-up page.
PER_PAGE = 200


def _boxes(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    x, y = (F.col("p_partkey") * 37 % 900).cast("double"), (F.col("p_partkey") * 91 % 900).cast("double")
    return p.select(F.floor(F.col("p_partkey") / PER_PAGE).alias("page"), F.col("p_partkey").alias("id"), F.concat(F.lit("i"), F.col("p_partkey").cast("string")).alias("name"), x.alias("x0"), y.alias("y0"), (x + F.col("p_size")).alias("x1"), (y + F.col("p_size")).alias("y1"))


@query("""with b as (select p_partkey as id, (p_partkey * 37 % 900)::double as x0, (p_partkey * 91 % 900)::double as y0 from part)
select id, 2 * (x0 + 5) + 1 as x, 3 * (y0 + 6) + 2 as y from b""")
def placed_boxes(spark, d):
    """Corners of boxes under two affine maps, one after the other: moved by (5, 6), then scaled by 2 and 3 and moved by (1, 2)."""
    m = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    both = layout.compose(m(1, 0, 0, 1, 5, 6), m(2, 0, 0, 3, 1, 2))
    return _boxes(spark, d).select("id", layout.transform(both, F.col("x0"), F.col("y0")).alias("p")).select("id", "p.x", "p.y")


@query("""with b as (select p_partkey // 200 as page, p_partkey as id, (p_partkey * 37 % 900)::double as x0, (p_partkey * 91 % 900)::double as y0, p_size as z from part)
select l.page, l.id as a, r.id as b from b l join b r on l.page = r.page and l.id < r.id and greatest(0, greatest(l.x0, r.x0) - least(l.x0 + l.z, r.x0 + r.z)) <= 0.5 and greatest(0, greatest(l.y0, r.y0) - least(l.y0 + l.z, r.y0 + r.z)) <= 0.5""")
def overlapping_boxes(spark, d):
    return layout.overlapping(_boxes(spark, d), ["page"])


@query("""with recursive b as (select p_partkey // 200 as page, p_partkey as id, (p_partkey * 37 % 900)::double as x0, (p_partkey * 91 % 900)::double as y0, p_size::double as z from part),
e as (select l.page, l.id as a, r.id as b from b l join b r on l.page = r.page where greatest(l.x0, r.x0) - least(l.x0 + l.z, r.x0 + r.z) <= 0.5 and greatest(l.y0, r.y0) - least(l.y0 + l.z, r.y0 + r.z) <= 0.5),
r as (select page, a, b from e union select r.page, r.a, e.b from r join e on r.page = e.page and r.b = e.a),
g as (select page, b as id, min(a) as g from r group by 1, 2)
select b.page, string_agg('i' || id::varchar, '+' order by id) as name, min(x0) as x0, min(y0) as y0, max(x0 + z) as x1, max(y0 + z) as y1 from g join b using (page, id) group by b.page, g.g""")
def merged_boxes(spark, d):
    return layout.merged_boxes(_boxes(spark, d), ["page"])


@query()
def page_reports(spark, d):
    """Page reports of boxes and of the documents' texts."""
    b = _boxes(spark, d).groupBy("page").agg(F.array_sort(F.collect_list(F.struct("name", "x0", "y0", "x1", "y1"))).alias("images"))
    t = spread(table(spark, d, "documents", "doc_id", "text"))
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(x.alias("text"), F.lit(10.0).alias("x"), (i * 12).cast("double").alias("y")))
    r = t.select("doc_id", F.lit(600.0).alias("width"), F.lit(800.0).alias("height"), lines.alias("texts"), F.floor(F.col("doc_id") / 5).alias("page")).join(b, "page", "left")
    return layout.page_reports(r, 2000).select("doc_id", "report")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garbage_leaderboard(spark, sf_dir)
