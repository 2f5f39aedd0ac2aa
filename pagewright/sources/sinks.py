"""Sinks: JSON lines by work group, Markdown files, rejected answers."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import markdown_path


def write_documents(documents: DataFrame, path: str, group: str | None = None, mode: str = "append") -> None:
    """JSON lines, gzip, in one folder a work group if ``group`` names its column. The committer makes a job's files appear at once."""
    w = documents.write.mode(mode).option("compression", "gzip")
    (w.partitionBy(group) if group else w).json(path)


def write_markdown(documents: DataFrame, workspace: str) -> int:
    """Each document's text in its Markdown file under ``workspace``; the number of files. A path without a scheme is a folder that all executors
    share; another file system is written through pyarrow. A file appears whole."""
    d = documents.select(markdown_path(F.col("metadata.Source-File")).alias("path"), "text").where("path is not null and text is not null")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(workspace if "://" in workspace else f"file://{os.path.abspath(workspace)}")
        for pdf in batches:
            for path, text in zip(pdf["path"], pdf["text"]):
                to = f"{root.rstrip('/')}/{path}"
                system.create_dir(os.path.dirname(to), recursive=True)
                with system.open_output_stream(f"{to}.part") as f:
                    f.write(text.encode())
                system.move(f"{to}.part", to)
            yield pd.DataFrame({"n": [len(pdf)]})

    return d.mapInPandas(run, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def rejects(attempts: DataFrame) -> DataFrame:
    """``doc, page, attempt, kind, len, text`` of evaluated attempts that the gate rejected (``raw`` must still be there)."""
    return attempts.where(~F.col("is_valid") & (F.col("kind") != "failed")).select("doc", "page", "attempt", "kind", F.length("raw").alias("len"), F.col("raw").alias("text"))
