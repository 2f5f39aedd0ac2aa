"""Spell correction by symmetric deletes: a distinct-token join instead of a lookup per token."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_EDITS = 2
_TOKEN = "([A-Za-z]+)"


def osa_distance(a: str, b: str, most: int = MAX_EDITS) -> int:
    """Edits with transpositions of neighbours; ``most + 1`` for any greater distance."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, row[-1] + 1, one[j - 1] + (x != y))
            if two is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return one[-1]


@F.pandas_udf(T.IntegerType())
def _distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([osa_distance(x, y) for x, y in zip(a, b)], dtype="int32")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _deletes(word: pd.Series) -> pd.Series:
    def of(w):
        out = {w}
        edge = {w}
        for _ in range(MAX_EDITS):
            edge = {x[:i] + x[i + 1 :] for x in edge for i in range(len(x))}
            out |= edge
        return sorted(out)

    return word.map(of)


def dictionary(words: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """``word, count`` in lower case from ``word, count``; words of ``extra`` (``word``) count 1 where they are new."""
    base = words.groupBy(F.lower("word").alias("word")).agg(F.sum("count").cast("bigint").alias("count"))
    if extra is None:
        return base
    new = extra.select(F.lower("word").alias("word")).distinct().join(base, "word", "left_anti").withColumn("count", F.lit(1).cast("bigint"))
    return base.unionByName(new)


def suggestions(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """``token, word``: of each distinct token the nearest word within two edits, then the most frequent, then the first by name.

    Token and word meet on a string that both become by deleting up to two letters; the token keeps its case, so capitals cost edits.
    """
    longest = words.agg(F.coalesce(F.max(F.length("word")), F.lit(0))).first()[0]  # a longer token is no word's neighbour
    t = tokens.select("token").distinct().where(F.length("token") <= longest + MAX_EDITS).withColumn("k", F.explode(_deletes("token")))
    w = words.select("word", "count").withColumn("k", F.explode(_deletes("word")))
    pairs = t.join(w, "k").select("token", "word", "count").distinct().withColumn("d", _distance("token", "word")).where(F.col("d") <= MAX_EDITS)
    return pairs.groupBy("token").agg(F.min(F.struct("d", -F.col("count"), "word"))["word"].alias("word"))


def page_tokens(pages: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, token, n``: alphabetic tokens of each page with their number."""
    return pages.select(*keys, F.explode(F.regexp_extract_all("text", F.lit(_TOKEN), F.lit(1))).alias("token")).groupBy(*keys, "token").agg(F.count("*").alias("n"))


def correction_rates(pages: DataFrame, words: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, n_tokens, n_corrected, n_uncorrectable, correction_rate, uncorrectable_rate``; a page without alphabetic tokens gives no row."""
    t = page_tokens(pages, keys)
    known = t.join(words.select(F.col("word").alias("_w")), F.lower("token") == F.col("_w"), "left")
    unknown = known.where("_w is null").select("token").distinct()
    fixed = suggestions(unknown, words).withColumnRenamed("word", "_fix")
    x = known.join(fixed, "token", "left")
    missing = F.col("_w").isNull()
    g = x.groupBy(*keys).agg(F.sum("n").alias("n_tokens"), F.sum(F.when(missing & F.col("_fix").isNotNull(), F.col("n")).otherwise(0)).alias("n_corrected"),
                             F.sum(F.when(missing & F.col("_fix").isNull(), F.col("n")).otherwise(0)).alias("n_uncorrectable"))
    rate = lambda c: F.round(F.col(c).cast("double") / F.col("n_tokens"), 6)
    return g.withColumn("correction_rate", rate("n_corrected")).withColumn("uncorrectable_rate", rate("n_uncorrectable"))


def correct_texts(pages: DataFrame, words: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, text`` with unknown alphabetic tokens replaced by their suggestion; all else stays as it is. ``keys`` must be unique."""
    parts = pages.select(*keys, F.posexplode(F.regexp_extract_all("text", F.lit("([A-Za-z]+|[^A-Za-z]+)"), F.lit(1))).alias("i", "token"))
    alpha = F.col("token").rlike("^[A-Za-z]+$")
    known = words.select(F.col("word").alias("_w"))
    u = parts.where(alpha).select("token").distinct().join(known, F.lower("token") == F.col("_w"), "left_anti")
    x = parts.join(suggestions(u, words).withColumnRenamed("word", "_fix"), "token", "left")
    joined = x.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", F.coalesce("_fix", "token").alias("t")))), lambda s: s["t"]), "").alias("text"))
    blank = pages.where("text = ''").select(*keys, "text")
    return joined.unionByName(blank)
