"""The evaluation pipeline: load runs, score what is not yet scored, rank."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.garbage import garbage_fraction
from ..operators import agreement, leaderboard, pages as pg, perplexity as pp, spelling, store as st
from ..session import materialise
from ..sources.inputs import load_runs, parse_run_specs

#: Tables that follow the documents of a run; perplexities cost a model run and are kept.
FOLLOWING = ("correction_rate", "garbage_fraction", "peer_agreement", "textlayer_agreement", "reject_rate", "ledger")
DOC = ["model", "doc"]
#: Failed documents that a warning names.
NAMED = 5


def evaluate(spark: SparkSession, store: st.MetricStore, specs: list[str], words: DataFrame, layer: DataFrame | None = None, resume: bool = True,
             scorer: Callable[[DataFrame], DataFrame] | None = None, scorer_name: str | None = None, max_tokens: int = pp.MAX_TOKENS) -> DataFrame:
    """Brings the store up to date for the given runs and returns the leaderboard.

    Only documents whose text changed since their phase was done are scored again; of pairs of runs only those not stored in both directions. Documents that a
    run no longer has are forgotten, save their perplexities. A run that is resumed gives the same tables as one made afresh.

    ``scorer`` takes ``model, doc, chunk, text`` and gives ``model, doc, chunk, pos, decoded, logprob`` (as ``attribute_tokens`` has it). A document of which a
    chunk got no tokens stays unscored and is tried again next time. Another ``scorer_name`` than the stored one drops a run's perplexities.
    """
    docs = load_runs(spark, specs)
    all_pages = materialise(pg.explode_pages(docs, F.col("model")), "eval-pages")
    metas = materialise(pg.document_meta(docs, F.col("model")), "eval-metas")
    # A document without any text is complete too, with the checksum of no pages.
    sums = metas.select(*DOC).join(pg.document_checksums(all_pages), DOC, "left").withColumn("text_sha1", F.coalesce("text_sha1", F.sha1(F.lit("").cast("binary"))))
    sums = materialise(sums, "eval-sums")
    runs_given = parse_run_specs(specs)  # the runs on the command line
    models = [m for m, _ in runs_given]
    if resume:
        sides = []
        for t in FOLLOWING:
            old = store.read(t)
            for side in ("model", "peer"):
                if side in old.columns:
                    sides.append(old.where(F.col(side).isin(models)).select(F.lit(t).alias("table"), F.col(side).alias("model"), "doc"))
        gone = reduce(DataFrame.unionByName, sides).join(metas.select(*DOC), DOC, "left_anti")
        for t, found in gone.groupBy("table").agg(F.collect_set(st.bucket()).alias("parts")).collect():  # a row a table, a few numbers each
            store.change(set(found), lambda parts, t=t: {t: st.prune_runs(parts[t], models, metas)}, t)
    else:
        cleared = {t: store.read(t) for t in (*FOLLOWING, "pplx")}
        for m in models:
            cleared = {t: st.clear_run(d, m) for t, d in cleared.items()}
        store.commit(**{t: materialise(d, t) for t, d in cleared.items()})
    runs, pplx, ledger = store.read("runs"), store.read("pplx"), store.read("ledger")
    # What another scorer gave is dropped, and so is the record that it was done.
    others = [r.model for r in runs.where(F.col("model").isin(models) & (F.col("pplx_scorer_model") != F.lit(scorer_name))).select("model").collect()]
    for m, path in runs_given:
        runs, pplx = st.register(runs, m, path, scorer_name, pplx)
    more = {"pplx": materialise(pplx, "pplx"), "ledger": materialise(ledger.where(~((F.col("phase") == "pplx") & F.col("model").isin(others))), "ledger")} if others else {}
    store.commit(runs=materialise(runs, "runs"), **more)

    def due(phase):
        t = materialise(st.todo(sums, sums, store.read("ledger"), phase), f"todo-{phase}")
        return t, all_pages.join(t.select(*DOC), DOC, "left_semi")

    t, p = due("garbage")
    store.write_phase("garbage", p.select(*DOC, "page", garbage_fraction(F.col("text")).alias("score")).where("score is not null"), t)
    t, p = due("correction")
    rates = spelling.correction_rates(p, words, [*DOC, "page"])
    store.write_phase("correction", rates.select(*DOC, "page", "correction_rate", "uncorrectable_rate"), t)
    t, _ = due("peer")
    pair = ["doc", "page", "model", "peer"]

    def peers(old):
        pairs = old["peer_agreement"]
        kept = materialise(st.clear_peer_documents(pairs, t), "peer-kept")
        mine = all_pages.where(st.bucket().isin(*parts))
        half = materialise(st.missing_pairs(mine, kept), "peer-missing")
        new = agreement.peer_agreement(mine, half)
        back = half.select("doc", "page", F.col("peer").alias("model"), F.col("model").alias("peer"))
        whole = kept.join(half, pair, "left_anti").join(back, pair, "left_anti")
        marks = t.select(*DOC, F.lit("peer").alias("phase"), "text_sha1")
        return {"peer_agreement": whole.select(*pairs.columns).unionByName(new.select(*pairs.columns)), "ledger": st.upsert(old["ledger"], marks, [*DOC, "phase"])}

    # A pair may also be missing where no text changed: a run that came back.
    parts = st.touched(t.select("doc").unionByName(st.missing_pairs(all_pages, store.read("peer_agreement")).select("doc")))
    store.change(parts, peers, "peer_agreement", "ledger")
    if layer is not None:
        t, p = due("textlayer")
        scored, _ = agreement.textlayer_agreement(p, metas, layer)
        store.write_phase("textlayer", scored, t)
    if scorer is not None:
        adopted = st.adopt(store.read("ledger"), store.read("pplx"), sums, "pplx")
        store.commit(ledger=materialise(adopted, "adopted"))
        t, p = due("pplx")
        scores, failed = score_pages(p, words, scorer, max_tokens)
        failed = materialise(failed, "pplx-failed")
        n = failed.count()
        if n:
            some = ", ".join(f"{r.model}: {r.doc}" for r in failed.orderBy(*DOC).limit(NAMED).collect())
            warnings.warn(f"{n} documents got no perplexities, such as {some}", stacklevel=2)
        done = t.join(failed, DOC, "left_anti")
        store.write_phase("pplx", scores.join(failed, DOC, "left_anti"), done)
    store.commit(reject_rate=st.replace_groups(store.read("reject_rate"), metas.select(*DOC, "fallback_pages", "total_pages"), ["model"]))
    names = ("runs", "correction_rate", "garbage_fraction", "peer_agreement", "textlayer_agreement", "reject_rate")
    return leaderboard.leaderboard({t: store.read(t) for t in names} | ({"pplx": store.read("pplx")} if not store.read("pplx").isEmpty() else {}))


def score_pages(pages: DataFrame, words: DataFrame, scorer: Callable[[DataFrame], DataFrame], max_tokens: int = pp.MAX_TOKENS) -> tuple[DataFrame, DataFrame]:
    """(perplexities of each page, ``model, doc`` that failed). The texts are scored as they are and once more with their spelling corrected, where that
    changes a document."""
    fixed = spelling.correct_texts(pages, words, [*DOC, "page"])
    changed = fixed.withColumnRenamed("text", "_fixed").join(pages, [*DOC, "page"]).where("_fixed <> text").select(*DOC).distinct()
    fixed = materialise(fixed.join(changed, DOC, "left_semi"), "pplx-corrected")
    passes, failed = [], None
    for name, texts in (("raw", pages), ("corrected", fixed)):
        chunks = materialise(pp.token_chunks(texts, DOC, max_tokens), f"pplx-chunks-{name}")
        tokens = materialise(scorer(pp.chunk_texts(texts, chunks, DOC)), f"pplx-tokens-{name}")
        bad = chunks.select(*DOC, "chunk").distinct().join(tokens.select(*DOC, "chunk").distinct(), [*DOC, "chunk"], "left_anti").select(*DOC).distinct()
        failed = bad if failed is None else failed.unionByName(bad).distinct()
        passes.append(pp.attribute_tokens(tokens, chunks, texts, DOC))
    return pp.page_perplexities(*passes, DOC), failed
