"""Shared helpers of the training-text operators."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import materialise, settled_texts, shared_dir, spread  # noqa: F401

LANGS = ("en", "de", "fr", "es", "pt", "pl", "ru")

#: Entries a worker-side counter or cache may hold before it is emptied.
FLUSH = 200_000


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


def all_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tbl, record_id, model, text`` of both page tables, each record once: of re-delivered ones the latest."""
    r = settled_texts(read(spark, sf_dir, "page_responses", "response_id", "model", "natural_text", "ingested_at"), ["response_id"], "ingested_at").select(F.lit("page_responses").alias("tbl"), F.col("response_id").alias("record_id"), "model", F.col("natural_text").alias("text"))
    t = settled_texts(read(spark, sf_dir, "page_texts", "text_id", "model", "text"), ["text_id"]).select(F.lit("page_texts").alias("tbl"), F.col("text_id").alias("record_id"), "model", "text")
    return r.unionByName(t)


#: Rows up to which a table of groups is broadcast; pieces into which a group's rows are cut where it has more.
SMALL, SALT = 50_000, 16


def with_group(rows: DataFrame, groups: DataFrame, keys: list[str], small: int = SMALL) -> DataFrame:
    """``rows`` with the columns of ``groups``, which has one row a key; null where there is none.

    A group may hold any share of the rows: ``groups`` is counted and broadcast if it has ``small`` rows at most, else its rows are repeated
    and a key's rows are cut into pieces.
    """
    groups = materialise(groups, "groups")
    if groups.count() <= small:
        return rows.join(F.broadcast(groups), keys, "left")
    cut = rows.withColumn("_salt", F.pmod(F.xxhash64(*[c for c, kind in rows.dtypes if not kind.startswith("map")]), F.lit(SALT)))
    many = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALT - 1).cast("bigint"))))
    return cut.join(many, [*keys, "_salt"], "left").drop("_salt")


def map_rows(df: DataFrame, schema: str, columns: list[str], start: Callable[[], Callable[[list[list]], dict[str, list]]]) -> DataFrame:
    """Arrow map: ``start()`` runs once a task and returns the function from column lists to output lists."""
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            out = work([batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns])
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in target], schema=target)

    return df.select(*columns).mapInArrow(run, schema)


def count_map(df: DataFrame, schema: str, columns: list[str], start: Callable[[], Callable[[list[list], Counter], None]]) -> DataFrame:
    """Counts made map-side. ``start()`` returns a function that adds a batch's keys (tuples) to a counter.

    The result has the key columns of ``schema`` and ``n``, summed over all rows; a counter that holds ``FLUSH`` keys is
    emitted and emptied, so a task's memory is bounded whatever the number of keys.
    """
    full = StructType.fromDDL(schema + ", n bigint")
    target = to_arrow_schema(full)

    def emit(c: Counter) -> pa.RecordBatch:
        keys = list(c)
        cols = [pa.array([k[i] for k in keys], type=f.type) for i, f in enumerate(list(target)[:-1])]
        return pa.RecordBatch.from_arrays([*cols, pa.array([c[k] for k in keys], type=pa.int64())], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, c = start(), Counter()
        for batch in batches:
            work([batch.column(batch.schema.get_field_index(x)).to_pylist() for x in columns], c)
            if len(c) > FLUSH:
                yield emit(c)
                c = Counter()
        yield emit(c)

    names = full.fieldNames()[:-1]
    return df.select(*columns).mapInArrow(run, full).groupBy(*names).agg(F.sum("n").alias("n"))


def word_languages(common: DataFrame) -> dict[str, tuple[str, ...]]:
    """The languages that have each frequent word; ``common_words`` is a fixed table of a few hundred rows."""
    out: dict[str, tuple[str, ...]] = {}
    for lang, word in sorted((r.lang, r.word.lower()) for r in common.select("lang", "word").where("lang is not null and word is not null").distinct().collect()):
        out[word] = (*out.get(word, ()), lang)
    return out


def guess_language(words: Iterable[str], known: dict[str, tuple[str, ...]]) -> str:
    """The language that has most of the frequent words among ``words``; '' if there are none. Ties go to the first code."""
    c: Counter = Counter()
    for word, n in Counter(filter(known.__contains__, words)).items():
        for lang in known[word]:
            c[lang] += n
    return max(sorted(c), key=c.__getitem__) if c else ""


def label_language(label: str | None, names: dict[str, Iterable[str]]) -> str | None:
    """The two-letter code that a spelled label names, or None."""
    s = (label or "").strip().lower().replace("_", "-")
    s = s.split("-")[0] if "-" in s else s
    return next((code for code, spelled in names.items() if s in spelled), None)
