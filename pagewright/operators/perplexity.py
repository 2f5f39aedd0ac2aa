"""Perplexity of pages from token log-probabilities that an injected scorer gives."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import perplexity

CHARS_PER_TOKEN, MAX_TOKENS = 3, 32_000


def token_chunks(pages: DataFrame, keys: list[str], max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``keys, page, chunk, start``: consecutive pages in chunks under a token bound, and where each page begins in its chunk.

    Greedy from the first page, so a chunk depends on the one before: one pass over a document's page lengths, which leaves the texts where they
    are. A page longer than the bound is a chunk of its own.
    """
    n = F.length("text").cast("bigint") + 1
    d = pages.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("page", n.alias("n")))).alias("_p"))
    out = d.select(*keys, F.explode(_greedy(F.transform("_p", lambda x: x["page"].cast("int")), F.transform("_p", lambda x: x["n"]), F.lit(max_tokens))).alias("o"))
    return out.select(*keys, "o.page", "o.chunk", "o.start")


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("page", T.IntegerType()), T.StructField("chunk", T.IntegerType()), T.StructField("start", T.LongType())])))
def _greedy(pages: pd.Series, lengths: pd.Series, most: pd.Series) -> pd.Series:
    def chunks(numbers, sizes, bound):
        used = chunk = 0
        for page, n in zip(numbers, sizes):
            if used and (used + n) // CHARS_PER_TOKEN > bound:
                used, chunk = 0, chunk + 1
            yield {"page": page, "chunk": chunk, "start": used}
            used += n

    return pd.Series([list(chunks(*x)) for x in zip(pages, lengths, most)])


def chunk_texts(pages: DataFrame, chunks: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, chunk, text``: the prompts, pages joined by line ends. A chunk has a bounded length, save where one page is longer."""
    at = [*keys, "chunk"]
    rows = chunks.select(*keys, "page", "chunk").join(pages.select(*keys, "page", "text"), [*keys, "page"])
    return rows.groupBy(*at).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda x: x["text"]), "\n").alias("text"))


def attribute_tokens(tokens: DataFrame, chunks: DataFrame, pages: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, page, n_tokens, sum_logprob``: each token counts for the page in which it begins.

    ``tokens``: ``keys, chunk, pos, decoded, logprob``, the first of a chunk with a null logprob and no decoded text: its length is what the others leave of
    the prompt. Offsets are running sums; a token meets its page by the last page start at or before it, on a merged order, not a range join.
    """
    at = [*keys, "chunk"]
    lengths = chunks.join(pages.select(*keys, "page", F.length("text").cast("bigint").alias("n")), [*keys, "page"])
    prompt = lengths.groupBy(*at).agg((F.sum(F.col("n") + 1) - 1).alias("prompt"))
    decoded = F.when(F.col("logprob").isNotNull(), F.length("decoded")).otherwise(0).cast("bigint")
    rest = tokens.groupBy(*at).agg(F.sum(decoded).alias("decoded_sum"))
    before = Window.partitionBy(*at).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    t = tokens.where("logprob is not null").withColumn("_d", F.length("decoded").cast("bigint")).withColumn("_b", F.coalesce(F.sum("_d").over(before), F.lit(0)))
    t = t.join(prompt, at).join(rest, at).select(*at, (F.greatest(F.col("prompt") - F.col("decoded_sum"), F.lit(0)) + F.col("_b")).alias("x"), F.lit(1).alias("kind"), F.lit(None).cast("int").alias("page"), "logprob")
    starts = chunks.select(*at, F.col("start").alias("x"), F.lit(0).alias("kind"), "page", F.lit(None).cast("double").alias("logprob"))
    merged = Window.partitionBy(*at).orderBy("x", "kind", F.col("page").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    both = t.unionByName(starts).withColumn("page", F.last("page", ignorenulls=True).over(merged))
    return both.groupBy(*keys, "page").agg(F.sum(F.col("kind").cast("bigint")).alias("n_tokens"), F.coalesce(F.sum("logprob"), F.lit(0.0)).alias("sum_logprob"))


def pick_token(candidates: Column) -> Column:
    """Of a map from token id to ``struct<logprob, decoded, rank>`` the entry of rank 0, else the first."""
    v = F.map_values(candidates)
    return F.coalesce(F.get(F.filter(v, lambda x: x["rank"] == 0), F.lit(0)), F.get(v, F.lit(0)))


def page_perplexities(raw: DataFrame, corrected: DataFrame, keys: list[str]) -> DataFrame:
    """Raw and corrected sums side by side with their perplexities. Where the corrected pass is absent (the text was not changed), the raw one
    stands for it."""
    k = [*keys, "page"]
    c = corrected.select(*k, F.col("n_tokens").alias("_n"), F.col("sum_logprob").alias("_s"))
    x = raw.join(c, k, "left").select(*k, F.col("n_tokens").cast("double").alias("n_tokens_raw"), F.col("sum_logprob").alias("sum_logprob_raw"), F.coalesce("_n", "n_tokens").cast("double").alias("n_tokens_corrected"),
                                      F.coalesce("_s", "sum_logprob").alias("sum_logprob_corrected"))
    for kind in ("raw", "corrected"):
        x = x.withColumn(f"ppl_{kind}", perplexity(F.col(f"sum_logprob_{kind}"), F.col(f"n_tokens_{kind}")))
    return x
