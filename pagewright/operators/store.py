"""The metric store: versioned Parquet tables with a completion ledger, and its updates as DataFrame operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LEDGER, METRICS, RUNS, names

PHASES = {"correction": "correction_rate", "garbage": "garbage_fraction", "peer": "peer_agreement", "textlayer": "textlayer_agreement", "reject": "reject_rate", "pplx": "pplx"}


# --- updates -------------------------------------------------------------------------------------------------------


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``new``, and those of ``old`` whose key it lacks. Of equal keys within ``new`` the greatest row counts."""
    rest = [c for c in old.columns if c not in keys]
    one = new.select(*old.columns).groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*old.columns)
    return old.join(one.select(*keys), keys, "left_anti").select(*old.columns).unionByName(one)


def replace_groups(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of each group that ``new`` has are replaced; an empty ``new`` replaces nothing."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


def replace_documents(old: DataFrame, rows: DataFrame, done: DataFrame) -> DataFrame:
    """Of the documents in ``done`` (``model, doc``) the rows are replaced; a document may end up without rows."""
    return old.join(done.select("model", "doc").distinct(), ["model", "doc"], "left_anti").select(*old.columns).unionByName(rows.select(*old.columns))


def clear_run(table: DataFrame, model: str) -> DataFrame:
    """Without a run; of pairs, without those it is either side of."""
    gone = F.col("model") == model
    if "peer" in table.columns:
        gone = gone | (F.col("peer") == model)
    return table.where(~F.coalesce(gone, F.lit(False)))


def prune(table: DataFrame, model: str, keep: DataFrame) -> DataFrame:
    """A run's documents that are not in ``keep`` (``doc``) go, as either side of a pair too; an empty ``keep`` drops them all."""
    mine = F.col("model") == model
    if "peer" in table.columns:
        mine = mine | (F.col("peer") == model)
    mine = F.coalesce(mine, F.lit(False))
    kept = table.where(mine).join(keep.select("doc").distinct(), "doc", "left_semi").select(*table.columns)
    return table.where(~mine).unionByName(kept)


def clear_peer_documents(pairs: DataFrame, touched: DataFrame) -> DataFrame:
    """Without pairs that a document of ``touched`` (``model, doc``) is either side of."""
    t = touched.select("model", "doc").distinct()
    return pairs.join(t, ["model", "doc"], "left_anti").join(t.withColumnRenamed("model", "peer"), ["peer", "doc"], "left_anti").select(*pairs.columns)


def todo(pages: DataFrame, checksums: DataFrame, ledger: DataFrame, phase: str) -> DataFrame:
    """Pages of documents whose phase is not done for the text as it is now."""
    done = ledger.where(F.col("phase") == phase).join(checksums, ["model", "doc", "text_sha1"], "left_semi").select("model", "doc").distinct()
    return pages.join(done, ["model", "doc"], "left_anti")


def adopt(ledger: DataFrame, scores: DataFrame, checksums: DataFrame, phase: str) -> DataFrame:
    """Documents with scores but no record are taken as done for their present text."""
    recorded = ledger.where(F.col("phase") == phase).select("model", "doc")
    new = scores.select("model", "doc").distinct().join(recorded, ["model", "doc"], "left_anti").join(checksums, ["model", "doc"])
    return ledger.unionByName(new.select("model", "doc", F.lit(phase).alias("phase"), "text_sha1"))


def missing_pairs(pages: DataFrame, stored: DataFrame) -> DataFrame:
    """``doc, page, model, peer`` with model < peer: pairs of runs on a page that are not stored in both directions."""
    p = pages.select("doc", "page", "model").distinct()
    pairs = p.join(p.withColumnRenamed("model", "peer"), ["doc", "page"]).where("model < peer")
    both = stored.select("doc", "page", F.least("model", "peer").alias("model"), F.greatest("model", "peer").alias("peer"), (F.col("model") < F.col("peer")).alias("d"))
    whole = both.groupBy("doc", "page", "model", "peer").agg(F.countDistinct("d").alias("n")).where("n = 2")
    return pairs.join(whole, ["doc", "page", "model", "peer"], "left_anti")


def register(runs: DataFrame, model: str, input_path: str, scorer: str | None, pplx: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(runs, perplexities) after a run is registered: another scorer drops the run's perplexities, none keeps the stored one."""
    old = runs.where(F.col("model") == model).agg(F.max("pplx_scorer_model").alias("_old"))
    row = old.select(F.lit(model).alias("model"), F.lit(input_path).alias("input_path"), F.coalesce(F.lit(scorer).cast("string"), F.col("_old")).alias("pplx_scorer_model"))
    stale = old.where(F.col("_old").isNotNull() & (F.col("_old") != F.lit(scorer))).select(F.lit(model).alias("model")) if scorer is not None else old.where("false").select(F.lit(model).alias("model"))
    return upsert(runs, row, ["model"]), pplx.join(F.broadcast(stale), "model", "left_anti")  # one row at most


def prune_runs(table: DataFrame, models: list[str], keep: DataFrame) -> DataFrame:
    """``prune`` of several runs at once; ``keep`` has ``model, doc``."""
    kept = keep.select("model", "doc").distinct()
    out = table.join(kept.withColumn("_there", F.lit(True)), ["model", "doc"], "left").where(~F.col("model").isin(models) | F.col("_there")).drop("_there")
    if "peer" in table.columns:
        other = kept.select(F.col("model").alias("peer"), "doc", F.lit(True).alias("_there"))
        out = out.join(other, ["peer", "doc"], "left").where(~F.col("peer").isin(models) | F.col("_there")).drop("_there")
    return out.select(*table.columns)


# --- tables on disk ------------------------------------------------------------------------------------------------

#: Parts that a table is cut into by its documents.
BUCKETS = 64


def bucket(doc: str = "doc") -> Column:
    return F.pmod(F.xxhash64(F.coalesce(F.col(doc), F.lit(""))), F.lit(BUCKETS)).cast("int")


class MetricStore:
    """Tables in parts by document, and numbered versions. A version is one file that names the parts in force; it is written aside and gets
    its number by a rename that fails if the number is taken. So rows and ledger change at once, a failure at any time leaves the last
    version in force, and of two writers one is told. A commit rewrites the parts it touches and no others.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.schemas = METRICS | {"runs": RUNS, "ledger": LEDGER}
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _file(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions/{name}")

    def version(self) -> int:
        """The number of the version in force; 0 for an empty store."""
        folder = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions")
        fs = folder.getFileSystem(self._conf)
        if not fs.exists(folder):
            return 0
        return max((int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit()), default=0)

    def _parts(self, version: int) -> dict[tuple[str, int], str]:
        """Where each part of each table is."""
        if not version:
            return {}
        at = self._file(f"{version:012d}")
        stream = at.getFileSystem(self._conf).open(at)
        try:
            lines = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
        finally:
            stream.close()
        return {(table, int(part)): folder for table, part, folder in (x.split("\t") for x in lines)}

    def _read(self, table: str, parts: dict[tuple[str, int], str], only: set[int] | None = None) -> DataFrame:
        at = sorted({p for (t, b), p in parts.items() if t == table and (only is None or b in only)})
        return self.spark.read.schema(self.schemas[table]).parquet(*at) if at else self.spark.createDataFrame([], self.schemas[table])

    def read(self, table: str, only: set[int] | None = None) -> DataFrame:
        """A table as it is now, or some of its parts."""
        return self._read(table, self._parts(self.version()), only)

    def _publish(self, version: int, parts: dict[tuple[str, int], str]) -> None:
        aside, target = self._file(f"{version:012d}.{uuid.uuid4().hex}"), self._file(f"{version:012d}")
        fs = aside.getFileSystem(self._conf)
        out = fs.create(aside, True)
        out.write(bytearray("".join(f"{t}\t{b}\t{at}\n" for (t, b), at in sorted(parts.items())).encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf).rename(aside, target, options)
        except Exception as e:
            fs.delete(aside, False)
            raise RuntimeError(f"version {version} of the store is taken: another writer was faster") from e

    def commit(self, changed: dict[str, set[int]] | None = None, **tables: DataFrame) -> None:
        """Writes new parts of the tables, then the version that names them. ``changed``: of a table the parts that its DataFrame stands for; of
        others all parts."""
        version = self.version()
        parts = self._parts(version)
        for name, df in tables.items():
            only = (changed or {}).get(name)
            to = f"{self.path}/{name}/{uuid.uuid4().hex}"
            rows = df.select(*names(self.schemas[name]))
            rows.withColumn("_part", bucket() if "doc" in rows.columns else F.lit(0)).repartition("_part").write.partitionBy("_part").parquet(to)
            folder = self._jvm.org.apache.hadoop.fs.Path(to)
            new = {int(f.getPath().getName().split("=")[1]) for f in folder.getFileSystem(self._conf).listStatus(folder) if "=" in f.getPath().getName()}
            parts = {(t, b): at for (t, b), at in parts.items() if t != name or only is not None and b not in only}
            parts |= {(name, b): f"{to}/_part={b}" for b in new}
        self._publish(version + 1, parts)

    def change(self, touched: set[int], update, *tables: str) -> None:
        """Replaces the touched parts of tables by what ``update`` makes of them: a function from DataFrames to DataFrames, by name."""
        if touched:
            new = update({t: self.read(t, touched) for t in tables})
            self.commit({t: touched for t in new}, **new)

    def write_phase(self, phase: str, rows: DataFrame, done: DataFrame) -> None:
        """Rows of the documents in ``done`` (``model, doc, text_sha1``) and their records in one commit."""
        if phase not in PHASES:
            raise ValueError(f"unknown phase {phase!r}")
        table = PHASES[phase]
        marks = done.select("model", "doc", F.lit(phase).alias("phase"), "text_sha1")
        self.change(touched(done), lambda old: {table: replace_documents(old[table], rows, done), "ledger": upsert(old["ledger"], marks, ["model", "doc", "phase"])}, table, "ledger")


def touched(docs: DataFrame) -> set[int]:
    """The parts that documents (``doc``) lie in: at most ``BUCKETS`` numbers."""
    return {r[0] for r in docs.select(bucket()).distinct().collect()}
