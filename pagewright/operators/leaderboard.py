"""Comparison of runs: means weighted by document, win rates over common documents, the leaderboard."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

PLACES = 6


#: Label, value, whether higher is better (None: no win rate) of a metric's columns.
Spec = tuple[str, Column, bool | None]


def document_means(metric: DataFrame, specs: list[Spec], places: int | None = PLACES) -> DataFrame:
    """``label, model, doc, mean``: means over a run's rows of a document, of all values in one aggregate. They are rounded, so that ties do not hang on
    summation order; ``places`` None leaves them exact."""
    near = lambda c: c if places is None else F.round(c, places)
    g = metric.groupBy("model", "doc").agg(*[near(F.avg(value)).alias(label) for label, value, _ in specs])
    each = F.explode(F.array(*[F.struct(F.lit(label).alias("label"), F.col(label).alias("mean")) for label, _, _ in specs])).alias("_m")
    return g.select("model", "doc", each).select("_m.label", "model", "doc", "_m.mean").where("mean is not null")


def compare(metrics: list[tuple[DataFrame, list[Spec]]], places: int | None = PLACES) -> DataFrame:
    """``model`` and ``<label>[, <label>_win]`` of each spec: means in which every document weighs the same, and the share of the documents that all runs of
    the metric have in which a run is best, all that tie included; null below two runs or without such documents.

    The means of documents are written once for all metrics: what they are made of, perhaps texts, is not gone through again for each comparison.
    """
    means = materialise(reduce(DataFrame.unionByName, [document_means(m, specs, places) for m, specs in metrics]), "document-means")
    specs = [s for _, ss in metrics for s in ss]
    near = lambda c: c if places is None else F.round(c, places)
    per = means.groupBy("label", "model").agg(near(F.avg("mean")).alias("mean"))
    runs = per.groupBy("label").agg(F.count("*").alias("runs"))  # a row a label
    docs = means.groupBy("label", "doc").agg(F.count("*").alias("n"), F.max("mean").alias("high"), F.min("mean").alias("low")).join(F.broadcast(runs), "label").where("n = runs")
    best = F.when(F.col("label").isin([label for label, _, higher in specs if higher]), F.col("high")).otherwise(F.col("low"))
    wins = means.join(docs, ["label", "doc"]).groupBy("label", "model").agg(near(F.avg((F.col("mean") == best).cast("double"))).alias("win"))
    rows = per.join(F.broadcast(runs), "label").join(wins, ["label", "model"], "left")
    of = lambda label, c: F.max(F.when(F.col("label") == label, c))
    columns = []
    for label, _, higher in specs:
        columns.append(of(label, F.col("mean")).alias(label))
        if higher is not None:
            columns.append(of(label, F.when(F.col("runs") >= 2, F.col("win"))).alias(f"{label}_win"))
    return rows.groupBy("model").agg(*columns)


def metric_columns(metric: DataFrame, value: Column, label: str, higher: bool | None, places: int | None = PLACES) -> DataFrame:
    """``compare`` of one value."""
    return compare([(metric, [(label, value, higher)])], places)


#: Label, table, value, whether higher is better (None: no win rate).
SPECS = [
    ("corr_rate", "correction_rate", "correction_rate", False), ("uncorr_rate", "correction_rate", "uncorrectable_rate", None), ("garbage", "garbage_fraction", "score", False),
    ("peer_f1", "peer_agreement", "bow_f1", True), ("peer_ned", "peer_agreement", "one_minus_ned", None),
    ("tl_f1", "textlayer_agreement", "bow_f1", True), ("tl_ned", "textlayer_agreement", "one_minus_ned", None),
    ("reject_rate", "reject_rate", "try_divide(cast(fallback_pages as double), total_pages)", False),
]


def model_universe(tables: dict[str, DataFrame]) -> DataFrame:
    """Runs that any table but perplexity names."""
    return reduce(DataFrame.unionByName, [t.select("model") for k, t in tables.items() if k != "pplx"]).where("model is not null").distinct()


def leaderboard(tables: dict[str, DataFrame], places: int | None = PLACES) -> DataFrame:
    """One row a run. Perplexities are means over pages, all other metrics over documents; absent tables give null columns."""
    out = model_universe(tables)
    there = [(tables[t], [(label, F.expr(value), higher) for label, table, value, higher in SPECS if table == t]) for t in dict.fromkeys(s[1] for s in SPECS) if t in tables]
    if there:
        out = out.join(compare(there, places), "model", "left")
    none = F.lit(None).cast("double")
    names = [c for label, _, _, higher in SPECS for c in [label, *[f"{label}_win"] * (higher is not None)]]
    out = out.select("model", *[F.col(c) if c in out.columns else none.alias(c) for c in names])
    if "pplx" in tables:
        near = lambda c: c if places is None else F.round(c, places)
        mean = lambda c: near(F.avg(F.when(~F.isnan(c), F.col(c))))
        out = out.join(tables["pplx"].groupBy("model").agg(mean("ppl_raw").alias("ppl_raw"), mean("ppl_corrected").alias("ppl_corr")), "model", "left")
    return out


def render(board: DataFrame) -> str:
    """The leaderboard as padded text: three places, ``-`` for no mean, ``n/a`` for no win rate. A row a run reaches the driver."""
    rows = board.orderBy("model").collect()
    if not rows:
        return "(no models)"
    def cell(name, v):
        if name == "model":
            return str(v)
        if name.endswith("_win"):
            return "n/a" if v is None else f"{v:.2f}"
        return "-" if v is None else f"{v:.3f}"
    table = [board.columns, *[[cell(c, r[c]) for c in board.columns] for r in rows]]
    width = [max(len(r[i]) for r in table) for i in range(len(board.columns))]
    lines = ["  ".join(x.ljust(w) for x, w in zip(r, width)) for r in table]
    return "\n".join([lines[0], "  ".join("-" * w for w in width), *lines[1:]])


def top_rows(metric: DataFrame, value: str, k: int = 10, tie: tuple[str, ...] = ("model", "doc", "page")) -> DataFrame:
    """The ``k`` rows with the greatest value, for a look at outliers."""
    return metric.orderBy(F.col(value).desc_nulls_last(), *tie).limit(k)
