"""Problem 5: repetition inside a single document.

A word counts as repeated if it lies in a passage of ``span`` or more words that began earlier in the same text. The
shares of each language and source go into a mergeable quantile sketch (KLL); its upper quantile is that group's own
threshold, and a joined filter keeps the texts above it. Texts are processed whole.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPACE
from .common import all_texts, guess_language, map_rows, materialise, read, with_group, word_languages

SPAN = 5
#: The share from which a text counts as repetitive, whatever its group's threshold.
CASE = 0.4
PUNCT = ".,;:!?…\"'“”„«»‘’()[]{}<>*_#|`~=+-–—•·/\\"


def repeated_share(words: list[str], span: int = SPAN) -> float:
    """Share of ``words`` in passages of ``span`` or more words that occurred before, overlaps included; 0 if there are none."""
    n = len(words)
    grams = list(zip(*(words[i:] for i in range(span))))
    if len(set(grams)) == len(grams):
        return 0.0
    marked, seen = bytearray(n), set()
    one = b"\x01" * span
    for i, g in enumerate(grams):
        if g in seen:
            marked[i : i + span] = one
        else:
            seen.add(g)
    return sum(marked) / n


def duplicate_share(parts: list[str]) -> float:
    """Share of characters in parts that are the same as an earlier part."""
    total = sum(map(len, parts))
    if not total:
        return 0.0
    return sum(len(p) * (k - 1) for p, k in Counter(parts).items()) / total


def normal_words(text: str) -> list[str]:
    """Words as white space splits them, lower case, without surrounding punctuation; pure punctuation is no word."""
    return [w for w in (x.strip(PUNCT) for x in text.lower().split()) if w]


def repetition_shares(texts: DataFrame, common: DataFrame, span: int = SPAN) -> DataFrame:
    """``tbl, record_id, model, lang, n_words, share, line_share, paragraph_share`` of each non-null text.

    Null texts give no row, a text without words has share 0.
    """
    known = word_languages(common)

    def start():
        def work(cols):
            out = {k: [] for k in ("tbl", "record_id", "model", "lang", "n_words", "share", "line_share", "paragraph_share")}
            for tbl, rid, model, text in zip(*cols):
                if text is None:
                    continue
                words = normal_words(text)
                lines = [x for x in map(str.strip, text.split("\n")) if x]
                paras = [x for x in map(str.strip, text.split("\n\n")) if x] if "\n\n" in text else []
                row = (tbl, rid, model or "", guess_language(words, known), len(words), repeated_share(words, span), duplicate_share(lines), duplicate_share(paras))
                for k, v in zip(out, row):
                    out[k].append(v)
            return out

        return work

    schema = "tbl string, record_id bigint, model string, lang string, n_words int, share double, line_share double, paragraph_share double"
    return map_rows(texts, schema, ["tbl", "record_id", "model", "text"], start)


def thresholds(shares: DataFrame, quantile: float = 0.9, floor: float = 0.02, cap: float | None = None) -> DataFrame:
    """Each language's and source's own threshold: an upper quantile of its shares, from sketches merged over tasks.

    ``floor`` keeps a group without repetition from naming every text; ``cap`` a group that repeats throughout from hiding its own cases.
    """
    sketch = shares.groupBy("lang", "model").agg(F.kll_sketch_agg_double("share").alias("sketch"), F.count("*").alias("n_texts"))
    q = F.greatest(F.lit(floor), F.kll_sketch_get_quantile_double("sketch", F.lit(quantile)))
    return sketch.select("lang", "model", "n_texts", (q if cap is None else F.least(F.lit(cap), q)).alias("threshold"))


def repetitive(shares: DataFrame, case: float | None = None, quantile: float = 0.9) -> DataFrame:
    """Rows that reach their group's ``threshold``.

    With ``case`` no group's threshold is above it, and ``is_case`` tells the rows that reach ``case`` too: where one share is asked for in all
    groups, the sketches can leave texts out beforehand but not decide.
    """
    own = thresholds(shares, quantile, cap=case).drop("n_texts")
    return with_group(shares, own, ["lang", "model"]).where(F.col("share") >= F.col("threshold")).withColumn("is_case", F.col("share") >= F.lit(case or 0.0))


def _shares(spark, sf_dir):
    return materialise(repetition_shares(all_texts(spark, sf_dir), read(spark, sf_dir, "common_words")), "p5-shares")


def p5_found(spark, sf_dir):
    return repetitive(_shares(spark, sf_dir), CASE).where("is_case").select("tbl", "record_id")


def p5_shares(spark, sf_dir):
    """Every text's shares beside its group's threshold, and whether the group's own threshold names it."""
    s = _shares(spark, sf_dir)
    r = lambda c: F.round(c, 6).alias(c)
    return with_group(s, thresholds(s).drop("n_texts"), ["lang", "model"]).select(
        "tbl", "record_id", "model", "lang", "n_words", r("share"), r("line_share"), r("paragraph_share"), r("threshold"), (F.col("share") >= F.col("threshold")).alias("is_repetitive"))


_SIGNS = re.sub(r"([\[\]\\^-])", r"\\\1", PUNCT).replace("'", "''")
FOUND_SQL = f"""
with t as (select 'page_responses' as tbl, response_id as record_id, natural_text as text from page_responses qualify row_number() over (partition by response_id order by ingested_at desc) = 1
  union all select 'page_texts', text_id, any_value(text) from page_texts group by text_id),
w as (select tbl, record_id, list_filter(list_transform(regexp_split_to_array(lower(text), '[{SPACE}]+'), lambda x: regexp_replace(x, '^[{_SIGNS}]+|[{_SIGNS}]+$', '', 'g')), lambda x: x <> '') as w from t where text is not null),
u as (select tbl, record_id, len(w) as n, unnest(w) as x, generate_subscripts(w, 1) as i from w where len(w) >= {SPAN}),
g as (select tbl, record_id, n, i, concat_ws(chr(1), {', '.join(f'lead(x, {k}) over o' for k in range(SPAN))}) as g from u window o as (partition by tbl, record_id order by i) qualify lead(x, {SPAN - 1}) over o is not null),
r as (select tbl, record_id, n, i, row_number() over (partition by tbl, record_id, g order by i) as k from g),
m as (select distinct tbl, record_id, n, i + d as p from r, (select unnest(range({SPAN})) as d) where k > 1)
select tbl, record_id from m group by tbl, record_id, n having count(*) >= {CASE} * n"""
