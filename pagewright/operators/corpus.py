"""Corpus filter, work groups, reports."""

from __future__ import annotations

import csv
import io

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import spam_share

#: Words of download spam and the share from which a text is spam; least length and least share of letters for a verdict.
SPAM_WORDS = ["download", "pdf", "epub", "mobi", "free", "ebook", "file", "save", "casino", "viagra", "cialis", "ciprofloxacin"]
SPAM_SHARE, MIN_CHARS, MIN_LETTERS = 0.004, 200, 0.5


def filter_reason(text: Column, language: Column, is_form: Column | None = None, keep=("en", None), spam: bool = True) -> Column:
    """Why a document is dropped: 'form', 'unreadable' (null text), 'language', 'spam'; null if it is kept.

    Short texts and those with few letters are kept whatever their language. An undetected language is kept if ``keep`` has None.
    """
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    n = F.length(text)
    named = [x for x in keep if x is not None]
    wanted = (F.coalesce(language.isin(*named), F.lit(False)) if named else F.lit(False)) | (language.isNull() if None in keep else F.lit(False))
    out = F.when(F.coalesce(is_form, F.lit(False)), "form") if is_form is not None else F.when(F.lit(False), "form")
    out = out.when(text.isNull(), "unreadable").when(n < MIN_CHARS, None).when(letters.cast("double") / n < MIN_LETTERS, None).when(~wanted, "language")
    return out.when(spam_share(text, SPAM_WORDS) > SPAM_SHARE, "spam") if spam else out


def work_groups(paths: DataFrame, per_group: int, indexed: DataFrame | None = None) -> DataFrame:
    """``hash, paths``: new paths in lexical order, ``per_group`` at a time; the hash is of the joined paths.

    The rank comes from range partitions and their sizes, so the order is global but no task holds all paths.
    """
    p = paths.select("path").where("path is not null").distinct()
    if indexed is not None:
        p = p.join(indexed.select(F.explode("paths").alias("path")), "path", "left_anti")
    s = p.orderBy("path").withColumn("_part", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id())
    sizes = s.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_m").alias("_first"))
    offset = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a partition
    r = s.join(F.broadcast(sizes.select("_part", "_first", offset.alias("_at"))), "_part").withColumn("g", F.floor((F.col("_at") + F.col("_m") - F.col("_first")) / per_group))
    return r.groupBy("g").agg(F.array_sort(F.collect_list("path")).alias("paths")).select(F.sha1(F.encode(F.array_join("paths", ""), "UTF-8")).alias("hash"), "paths")


def remaining_work(index: DataFrame, done: DataFrame, locks: DataFrame | None = None, seconds: float = 1800.0) -> DataFrame:
    """Groups that are neither done nor under a lock younger than ``seconds`` (``hash, age``)."""
    out = index.join(done.select("hash"), "hash", "left_anti")
    return out if locks is None else out.join(locks.where(F.col("age") <= seconds).select("hash"), "hash", "left_anti")


def extended_index(index: DataFrame, paths: DataFrame, per_group: int) -> DataFrame:
    """The work index (``hash, paths``) with groups of the paths it lacks; groups that are there stay as they are."""
    new = work_groups(paths, per_group, index)
    return index.select("hash", "paths").unionByName(new.join(index.select("hash"), "hash", "left_anti"))


def shuffled(work: DataFrame, seed: int = 0) -> DataFrame:
    """Groups in an order that looks random and is the same for a seed."""
    return work.orderBy(F.xxhash64("hash", F.lit(seed)), "hash")


def index_lines(index: DataFrame) -> DataFrame:
    """``line``: a group as a CSV row, hash first; what holds a comma, a quote or a line end is quoted."""
    quoted = lambda x: F.when(x.rlike('[,"\\r\\n]'), F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(x)
    return index.select(F.array_join(F.transform(F.concat(F.array("hash"), F.col("paths")), quoted), ",").alias("line"))


def read_index(lines: DataFrame) -> DataFrame:
    """``hash, paths`` of the rows of ``index_lines``; blank lines are left out, of equal hashes the greatest row counts."""

    @F.pandas_udf("array<string>")
    def cells(line: pd.Series) -> pd.Series:
        return line.map(lambda x: next(csv.reader(io.StringIO(x, newline=""))))

    c = lines.where(F.trim("line") != "").select(cells("line").alias("c"))
    return c.select(F.col("c")[0].alias("hash"), F.slice("c", F.lit(2), F.size("c") - 1).alias("paths")).groupBy("hash").agg(F.max("paths").alias("paths"))


def items_per_group(page_counts: DataFrame, pages_per_group: int, sample: int = 100, seed: int = 1) -> int:
    """How many inputs make a group of some pages, from the mean of up to ``sample`` readable ones; ten pages each if there are none."""
    picked = page_counts.orderBy(F.xxhash64("path", F.lit(seed))).limit(sample)
    mean = picked.agg(F.avg("pages")).first()[0] or 10
    return max(1, int(pages_per_group / mean))


def workspace_stats(docs: DataFrame, long_tokens: int = 32_768) -> DataFrame:
    """Totals and means of ``pages, fallback_pages, input_tokens, output_tokens`` over documents; one row, zeros for none."""
    c = lambda x: F.coalesce(F.col(x), F.lit(0)).cast("bigint")
    s = lambda x, a: F.coalesce(F.sum(c(x)), F.lit(0)).cast("bigint").alias(a)
    far = c("output_tokens") > long_tokens
    t = docs.agg(F.count("*").alias("docs"), s("pages", "pages"), s("fallback_pages", "fallback_pages"), s("input_tokens", "input_tokens"), s("output_tokens", "output_tokens"),
                 F.coalesce(F.sum(far.cast("bigint")), F.lit(0)).alias("long_docs"), F.coalesce(F.sum(F.when(far, c("output_tokens")).otherwise(0)), F.lit(0)).cast("bigint").alias("long_tokens"))
    over = lambda a, b: F.round(F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1)), 6)
    return t.withColumn("pages_per_doc", over("pages", "docs")).withColumn("tokens_per_doc", over("output_tokens", "docs")).withColumn("tokens_per_page", over("output_tokens", "pages"))


def count_retries(totals: DataFrame) -> DataFrame:
    """``retries`` from ``key, value`` counters: pages that finished on a later attempt than the first, or on a parallel one."""
    n = F.regexp_extract("key", r"^finished_on_attempt_(\d+)$", 1)
    late = F.coalesce(n.try_cast("int") > 0, F.lit(False)) | (F.col("key") == "finished_on_parallel_retry")
    return totals.agg(F.coalesce(F.sum(F.when(late, F.col("value")).otherwise(0)), F.lit(0)).cast("bigint").alias("retries"))


def top_rejects(kinds: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` commonest of ``kind`` with their number, and one row '+more' with the number of further kinds."""
    c = kinds.groupBy("kind").agg(F.count("*").alias("n"))
    top = c.orderBy(F.col("n").desc(), "kind").limit(k)
    more = c.agg(F.greatest(F.count("*") - k, F.lit(0)).alias("n")).where("n > 0").select(F.lit("+more").alias("kind"), "n")
    return top.unionByName(more)


def final_summary(totals: DataFrame) -> DataFrame:
    """Completed and failed pages and the failure rate in per cent, from ``key, value`` counters."""
    of = lambda k: F.coalesce(F.sum(F.when(F.col("key") == k, F.col("value"))), F.lit(0)).cast("bigint")
    t = totals.agg(of("completed_pages").alias("completed"), of("failed_pages").alias("failed"), of("server_input_tokens").alias("input_tokens"), of("server_output_tokens").alias("output_tokens"))
    return t.withColumn("failure_percent", F.round(F.col("failed") * F.lit(100.0) / F.greatest(F.col("completed") + F.col("failed"), F.lit(1)), 6))
