"""Session helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``; a temporary one only where that is unset (tests)."""
    return spark.conf.get("spark.checkpoint.dir", None) or "file://" + os.path.join(tempfile.gettempdir(), "pagewright-shared")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors. It goes when the session's JVM ends."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).deleteOnExit(at)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Keys with several rows up to which the rows that count are broadcast.
REPEATED = 1_000_000


def settled(table: DataFrame, keys: list[str], order: str | None = None, small: int = REPEATED) -> DataFrame:
    """One row a key of a Parquet ``table``: the one with the greatest ``order``, of equal ones the last by place. A null key is a key.

    Which rows count is found from keys and places alone (file and number of the row), so that no wide column is shuffled. The keys that have
    several rows are counted and broadcast if there are ``small`` at most; else the rows are joined by key.
    """
    place = F.struct(F.xxhash64(F.col("_metadata.file_path")).alias("f"), F.col("_metadata.row_index").alias("i"))
    rows = table.withColumn("_place", place)
    newest = F.max(F.struct(*([F.col(order).alias("o")] if order else []), F.col("_place").alias("p"))).alias("w")
    twice = rows.groupBy(*keys).agg(F.count("*").alias("n"), newest).where("n > 1").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("w.p").alias("_wins"))
    twice = materialise(twice, "repeated")
    n = twice.count()
    if not n:
        return table
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    both = rows.join(F.broadcast(twice) if n <= small else twice, reduce(and_, same), "left")
    return both.where(F.col("_wins").isNull() | (F.col("_wins") == F.col("_place"))).select(*table.columns)


def spread(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Repartition a table of fewer files than cores before heavy text work; a table of many files stays as it is scanned. ``source`` is the table
    whose files count, where ``df`` is made of others too."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * 2) if 0 < len((source or df).inputFiles()) < cores else df


def settled_texts(table: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """``settled`` and ``spread``."""
    return spread(settled(table, keys, order), table)
