"""Inputs: path expansion, tarballs, run specifications, JSON lines, dictionaries."""

from __future__ import annotations

import os
import tarfile
import warnings
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import SPACE
from ..schemas import DOCUMENT

PAPERS = (".pdf", ".png", ".jpg", ".jpeg")


def is_tarball(path: str) -> bool:
    return path.lower().endswith((".tar.gz", ".tgz"))


class Files:
    """Listing and reading through the file systems that Spark knows, by the path's scheme: local, HDFS, object stores."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path if "://" in path else f"file://{os.path.abspath(path)}")
        return p, p.getFileSystem(self.conf)

    @staticmethod
    def _name(path: str, found: str) -> str:
        """As the caller names files: without a scheme where none was given."""
        return found if "://" in path else found.removeprefix("file:")

    def find(self, pattern: str) -> list[str]:
        """Paths that a path or glob names, in order."""
        p, fs = self._at(pattern)
        return sorted(self._name(pattern, str(s.getPath())) for s in fs.globStatus(p) or [])

    def exists(self, path: str) -> bool:
        p, fs = self._at(path)
        return fs.exists(p)

    def is_file(self, path: str) -> bool:
        p, fs = self._at(path)
        return fs.exists(p) and fs.getFileStatus(p).isFile()

    def head(self, path: str, n: int) -> bytes:
        p, fs = self._at(path)
        stream = fs.open(p)
        try:
            out = [stream.read() for _ in range(n)]
        finally:
            stream.close()
        return bytes(x for x in out if x >= 0)

    def lines(self, path: str) -> list[str]:
        p, fs = self._at(path)
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
        finally:
            stream.close()


def sniff_head(head: bytes) -> str | None:
    """'pdf', 'png' or 'jpeg' by a file's first bytes."""
    return "pdf" if head[:4] == b"%PDF" else "png" if head == b"\x89PNG\r\n\x1a\n" else "jpeg" if head[:2] == b"\xff\xd8" else None


def expand_inputs(spark: SparkSession, arguments: list[str]) -> tuple[set[str], set[str]]:
    """(papers and pictures, tarballs) that arguments name: paths or globs of any file system, or ``.txt`` lists of paths, whose lines are taken as they
    are.

    A path that is not there or of another kind is an error; a paper whose first bytes are of no known kind is left out with a warning.
    """
    papers, tars, files = set(), set(), Files(spark)
    for argument in arguments:
        for path in files.find(argument) if any(c in argument for c in "*?[") else [argument]:
            low = path.lower()
            if not files.exists(path):
                raise ValueError(f"input not found: {path}")
            if is_tarball(path):
                tars.add(path)
            elif low.endswith(PAPERS):
                if sniff_head(files.head(path, 8)):
                    papers.add(path)
                else:
                    warnings.warn(f"not a PDF or picture, left out: {path}", stacklevel=2)
            elif low.endswith(".txt"):
                names = [x.strip() for x in files.lines(path) if x.strip()]
                tars |= {x for x in names if is_tarball(x)}
                papers |= {x for x in names if not is_tarball(x)}
            else:
                raise ValueError(f"unsupported kind of file: {path}")
    return papers, tars


def tarball_members(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``source, name, content``: the PDF members of tarballs, read on the executors; ``source`` is ``tar::member``.

    A task streams its tarball from the path, a member at a time, so that an archive may have any size: a local or mounted path by itself, another
    file system's through pyarrow.
    """
    listed = spark.createDataFrame([(p,) for p in sorted(paths)], "path string").repartition(max(1, len(paths)), "path")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["path"]:
                if "://" in path and not path.startswith("file://"):
                    from pyarrow import fs

                    system, inner = fs.FileSystem.from_uri(path)
                    stream = system.open_input_stream(inner, compression=None)
                else:
                    stream = open(path.removeprefix("file://"), "rb")
                with stream, tarfile.open(fileobj=stream, mode="r|gz") as tar:
                    for m in tar:
                        if m.isfile() and m.name.lower().endswith(".pdf"):
                            yield pd.DataFrame([[f"{path.removeprefix('file://')}::{m.name}", os.path.basename(m.name), tar.extractfile(m).read()]], columns=["source", "name", "content"])

    return listed.mapInPandas(run, "source string, name string, content binary")


def parse_run_specs(specs: list[str]) -> list[tuple[str, str]]:
    """``LABEL=PATH`` pairs; the label is trimmed. No sign, an empty side or a label twice is an error."""
    out: list[tuple[str, str]] = []
    for spec in specs:
        label, sign, path = spec.partition("=")
        label = label.strip()
        if not sign or not label or not path:
            raise ValueError(f"not LABEL=PATH: {spec!r}")
        if label in (x for x, _ in out):
            raise ValueError(f"label given twice: {label!r}")
        out.append((label, path))
    return out


def run_files(spark: SparkSession, path: str) -> list[str]:
    """A run's JSON lines: the file itself, a workspace's ``results``, or a folder's own, by name; on any file system."""
    files = Files(spark)
    if files.is_file(path):
        return [path]
    if not files.exists(path):
        raise FileNotFoundError(path)
    return files.find(f"{path.rstrip('/')}/results/*.jsonl") or files.find(f"{path.rstrip('/')}/*.jsonl")


def read_documents(spark: SparkSession, paths: list[str], strict: bool = True) -> DataFrame:
    """Documents of JSON lines. Strict: a malformed line is an error; else it, and a record without text or source file, is left out."""
    if not paths:
        return spark.createDataFrame([], DOCUMENT)
    if strict:
        return spark.read.schema(DOCUMENT).option("mode", "FAILFAST").json(paths)
    d = spark.read.schema(f"{DOCUMENT}, _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(paths)
    return d.where("_bad is null and text is not null and metadata.`Source-File` is not null").drop("_bad")


def load_runs(spark: SparkSession, specs: list[str]) -> DataFrame:
    """All runs' documents with ``model``; a source file twice in one run is an error when the rows are read."""
    from ..operators.pages import require_unique

    out = None
    for label, path in parse_run_specs(specs):
        d = read_documents(spark, run_files(spark, path)).withColumn("model", F.lit(label))
        out = d if out is None else out.unionByName(d)
    return require_unique(out)


def read_words(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``word``: the distinct words of text files, lower case."""
    return spark.read.text(paths).select(F.explode(F.split("value", rf"[{SPACE}]+")).alias("w")).where("w <> ''").select(F.lower("w").alias("word")).distinct()
