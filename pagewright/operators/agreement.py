"""Agreement between runs and with a text layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.agreement import bow_f1, one_minus_ned

MIN_ALNUM = 25


def peer_agreement(pages: DataFrame, pairs: DataFrame | None = None, ned: bool = True) -> DataFrame:
    """``model, peer, doc, page, bow_f1, one_minus_ned`` in both directions; each pair of runs on a page is scored once.

    ``pairs`` (``doc, page, model, peer``, model < peer) restricts the work; without it all pairs are scored. The join is on the page, of which there
    are as many rows as runs.
    """
    a = pages.select("doc", "page", "model", F.col("text").alias("a"))
    b = pages.select("doc", "page", F.col("model").alias("peer"), F.col("text").alias("b"))
    x = a.join(b, ["doc", "page"]).where("model < peer")
    if pairs is not None:
        x = x.join(pairs.select("doc", "page", "model", "peer"), ["doc", "page", "model", "peer"], "left_semi")
    s = x.select("doc", "page", "model", "peer", bow_f1(F.col("a"), F.col("b")).alias("bow_f1"), (one_minus_ned(F.col("a"), F.col("b")) if ned else F.lit(None).cast("double")).alias("one_minus_ned"))
    both = F.explode(F.array(F.struct(F.col("model").alias("m"), F.col("peer").alias("p")), F.struct(F.col("peer").alias("m"), F.col("model").alias("p")))).alias("_d")
    return s.select(both, "doc", "page", "bow_f1", "one_minus_ned").select(F.col("_d.m").alias("model"), F.col("_d.p").alias("peer"), "doc", "page", "bow_f1", "one_minus_ned")


def layer_status(pages: DataFrame, metas: DataFrame, layer: DataFrame) -> DataFrame:
    """Pages with ``layer`` and ``status``: 'fallback' (a document with fallback pages), else 'missing' (one without any layer), 'blank'
    (under 25 letters or digits), else 'scored'. ``layer``: ``doc, page, layer[, layer_2]``, the second where the first is null."""
    first = F.coalesce("layer", "layer_2") if "layer_2" in layer.columns else F.col("layer")
    lay = layer.select("doc", "page", first.alias("layer"))
    have = lay.where("layer is not null").select("doc").distinct().withColumn("_has", F.lit(True))
    x = pages.join(metas.select("model", "doc", "fallback_pages"), ["model", "doc"], "left").join(have, "doc", "left").join(lay, ["doc", "page"], "left")
    alnum = F.length(F.regexp_replace(F.coalesce("layer", F.lit("")), r"[^\p{L}\p{N}]", ""))
    status = F.when(F.coalesce("fallback_pages", F.lit(0)) > 0, "fallback").when(F.col("_has").isNull(), "missing").when(alnum < MIN_ALNUM, "blank").otherwise("scored")
    return x.withColumn("status", status).drop("_has", "fallback_pages")


def textlayer_agreement(pages: DataFrame, metas: DataFrame, layer: DataFrame, ned: bool = True) -> tuple[DataFrame, DataFrame]:
    """(scores of pages, ``status, docs, pages``: what was skipped and why)."""
    x = layer_status(pages, metas, layer)
    s = x.where("status = 'scored'").select("model", "doc", "page", bow_f1(F.col("text"), F.col("layer")).alias("bow_f1"),
                                             (one_minus_ned(F.col("text"), F.col("layer")) if ned else F.lit(None).cast("double")).alias("one_minus_ned"))
    return s, x.groupBy("status").agg(F.countDistinct("model", "doc").alias("docs"), F.count("*").alias("pages"))
