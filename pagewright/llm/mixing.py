"""Problem 9: mixing sources to target weights.

Soft-membership mixing: a naive Bayes classifier, fitted to a bounded sample of labelled documents, predicts each document's distribution over
domains; a document's own source, where it has one, is evidence of nearly certain weight (``LABEL_ERROR``). Projected gradient descent on the
least squares of expected domain tokens against the targets finds a rate for each document, between 0 and the repeats its domains allow. A rate
is a function of the membership and of the residuals of earlier steps, so the steps pass over a small table of sizes and exchange one number
per domain; no rate is kept on the driver.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, materialise, read, spread
from .tokens import TOKENIZER, encoder

#: Labelled documents of each source that the classifier is fitted to.
PER_SOURCE = 200
#: Share of documents whose source is named wrongly; the most that a text may say for one domain against another, in log-odds.
LABEL_ERROR, MOST = 1e-6, 8.0
STEPS, ENOUGH = 200, 1e-7
#: How far the expected tokens of a domain may stay under the target before it is short.
SHORT = 1e-6
_WORD = re.compile(r"\w+")


class Classifier:
    """Multinomial naive Bayes on the words of the sample. A text's log-likelihoods are taken by word, so that a long text is not surer than its
    words are; a domain without documents has nothing to be recognized by."""

    def __init__(self, words: dict[str, int], weights: np.ndarray, prior: np.ndarray):
        self.words, self.weights, self.prior = words, weights, prior

    def posterior(self, text: str | None, domain: int | None) -> np.ndarray:
        """The distribution over domains of a text whose source names ``domain``, or none."""
        s = np.zeros(len(self.prior))
        ids = [i for i in map(self.words.get, _WORD.findall(text.lower())) if i is not None] if text and self.words else []
        if ids:
            s = self.weights[ids].sum(0, dtype=float) / math.sqrt(len(ids))
        known = self.prior > -1e8
        if known.any():
            s = np.maximum(s, s[known].max() - MOST) - s[known].max()
        s = s + self.prior
        if domain is not None:
            s[domain] = max(s[domain], s.max() - MOST) + math.log((1 - LABEL_ERROR) * max(1, len(s) - 1) / LABEL_ERROR)
        e = np.exp(s - s.max())
        return e / e.sum()


def fit_classifier(documents: DataFrame, domains: list[str], per_source: int = PER_SOURCE) -> Classifier:
    """From at most about ``per_source`` documents of each domain, picked by hash."""
    docs = documents.where(F.col("source").isin(*domains) & F.col("text").isNotNull())
    n = {r.source: r["count"] for r in docs.groupBy("source").count().collect()}
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    picked = F.lit(False)
    for s, k in n.items():
        picked = picked | (F.col("source") == s) & (h < min(1_000_000, int(1e6 * per_source / k) + 1))
    seen: list[Counter] = [Counter() for _ in domains]
    for r in docs.where(picked).select("source", "text").toLocalIterator():
        seen[domains.index(r.source)].update(_WORD.findall(r.text.lower()))
    words = {w: i for i, w in enumerate(sorted(set().union(*seen)))}
    counts = np.full((len(words), len(domains)), 0.1)
    for d, c in enumerate(seen):
        for w, k in c.items():
            counts[words[w], d] += k
    prior = np.array([math.log(n[d] / sum(n.values())) if n.get(d) else -1e9 for d in domains])
    return Classifier(words, np.log(counts / counts.sum(0)).astype(np.float32), prior)


def memberships(documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER) -> tuple[DataFrame, list[tuple[str, float, int]]]:
    """(``doc_id, source, n_tokens, domain, posterior``, the targets as a list).

    ``domain`` is the number of a document's source among the targets. A document of one of the targets, or without a source, has a
    ``posterior``; one of another source has none and is not mixed in. Repeated target rows count once; a source with a null share or repeats
    is no target. ``targets`` is a table of settings: its rows are few. A null text has no tokens.
    """
    rows = targets.where("source is not null and target_share is not null and max_repeats is not null").groupBy("source").agg(F.max("target_share"), F.max("max_repeats")).collect()
    want = sorted((r[0], float(r[1]), int(r[2])) for r in rows)
    domains = [w[0] for w in want]
    number = F.coalesce(*[F.when(F.col("source") == d, F.lit(i)) for i, d in enumerate(domains)], F.lit(None).cast("int")) if domains else F.lit(None).cast("int")
    shared = documents.sparkSession.sparkContext.broadcast(fit_classifier(documents, domains) if domains else None)  # bounded: words of the sample

    def start():
        enc, classify = encoder(tokenizer), shared.value

        def work(cols):
            mixed = [classify is not None and (d is not None or s is None) for s, d in zip(cols[1], cols[3])]
            return {"doc_id": cols[0], "source": cols[1], "domain": cols[3], "n_tokens": [len(enc.encode_ordinary(t)) if t else 0 for t in cols[2]],
                    "posterior": [classify.posterior(t, d).tolist() if m else None for t, d, m in zip(cols[2], cols[3], mixed)]}

        return work

    docs = documents.select("doc_id", "source", "text", number.alias("domain"))
    out = map_rows(docs, "doc_id bigint, source string, n_tokens bigint, domain int, posterior array<double>", ["doc_id", "source", "text", "domain"], start)
    return materialise(out, "p9-members"), want


def _matrix(posterior: pa.Array, k: int) -> np.ndarray:
    """Posteriors as rows of a matrix; one that is null is a row of zeros."""
    p = np.zeros((len(posterior), k))
    p[posterior.is_valid().to_numpy(zero_copy_only=False)] = posterior.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
    return p


def _rates(p: np.ndarray, steps: list[np.ndarray], most: np.ndarray) -> np.ndarray:
    """The rate of each document after the steps; one without a posterior has rate 0."""
    top = p @ most
    r = np.minimum(1.0, top)
    for g in (p @ np.array(steps).T).T if steps else ():
        r = np.clip(r - g, 0, top)
    return r


def fit_rates(members: DataFrame, want: list[tuple[str, float, int]], steps: int = STEPS) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(the residual steps, expected tokens, targets, tokens of the domain's own documents) of each domain.

    Steps are taken until the expected tokens stand still, ``steps`` at most.
    """
    most = np.array([w[2] for w in want], float)
    done: list[np.ndarray] = []

    def totals() -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        def run(batches, done=list(done)):
            got, have, own, total = np.zeros(len(most)), np.zeros(len(most)), np.zeros(len(most)), 0.0
            for batch in batches:
                n = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
                p = _matrix(batch.column(2), len(most))
                domain = batch.column(1).fill_null(-1).to_numpy(zero_copy_only=False)
                got += (n * _rates(p, done, most)) @ p
                have += n @ p
                own += np.bincount(domain[domain >= 0], n[domain >= 0], len(most))
                total += n.sum()
            yield pa.RecordBatch.from_pydict({"d": pa.array([*range(len(most)), -1], pa.int32()), "got": [*got, total], "have": [*have, 0.0], "own": [*own, 0.0]})

        rows = members.select("n_tokens", "domain", "posterior").mapInArrow(run, "d int, got double, have double, own double").groupBy("d").agg(F.sum("got").alias("got"), F.sum("have").alias("have"), F.sum("own").alias("own")).collect()
        got, have, own, total = np.zeros(len(most)), np.zeros(len(most)), np.zeros(len(most)), 0.0
        for r in rows:
            if r.d < 0:
                total = r.got
            else:
                got[r.d], have[r.d], own[r.d] = r.got, r.have, r.own
        return got, have, own, total

    got, have, own, total = totals()
    target = np.array([w[1] for w in want]) * total
    for _ in range(steps):
        step = np.where(have > 0, (got - target) / np.maximum(have, 1e-12), 0.0)
        before = got
        done.append(step)
        got, _, _, _ = totals()
        if np.abs(got - before).max(initial=0.0) <= ENOUGH * max(1.0, total):
            break
    return done, got, target, own


def mix(documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER) -> tuple[DataFrame, list[dict]]:
    """(``doc_id, source, n_tokens, rate, repeats``, one report a domain).

    ``repeats`` is the rate rounded up or down by a hash of the id, so that a source keeps its expected tokens. A domain is short if its
    rates stand at their bound and its expected tokens still fall short of the target.
    """
    members, want = memberships(documents, targets, tokenizer)
    if not want:
        return members.select("doc_id", "source", "n_tokens", F.lit(0.0).alias("rate"), F.lit(0).alias("repeats")), []
    done, got, target, own = fit_rates(members, want)
    most = np.array([w[2] for w in want], float)

    def run(batches):
        for batch in batches:
            p = _matrix(batch.column(3), len(most))
            r, domain = _rates(p, done, most), batch.column(4).fill_null(-1).to_numpy(zero_copy_only=False)
            coin = np.array([(zlib.crc32(str(i).encode()) & 0xFFFFFF) / 0x1000000 for i in batch.column(0).to_pylist()])
            times = np.where(np.abs(r - np.round(r)) < 1e-3, np.round(r), np.floor(r + coin))
            times = np.minimum(times, np.where(domain >= 0, most[domain], np.floor(p @ most + 1e-9)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(r), pa.array(times.astype(np.int32))], names=["doc_id", "source", "n_tokens", "rate", "repeats"])

    drawn = members.select("doc_id", "source", "n_tokens", "posterior", "domain").mapInArrow(run, "doc_id bigint, source string, n_tokens bigint, rate double, repeats int")
    report = [
        {"source": w[0], "target_share": w[1], "max_repeats": w[2], "expected": float(g), "target": float(t), "own": float(h), "short": bool(g < t * (1 - SHORT))}
        for w, g, t, h in zip(want, got, target, own)
    ]
    return drawn, report


def _mixed(spark, sf_dir):
    return mix(spread(read(spark, sf_dir, "documents", "doc_id", "source", "text")), read(spark, sf_dir, "mix_targets"))


def p9_found(spark, sf_dir):
    # The domains that the fit leaves short; the exact check follows: texts that look like a source's are not documents of it.
    _, report = _mixed(spark, sf_dir)
    rows = [(d["source"],) for d in report if d["short"] and d["own"] * d["max_repeats"] < d["target"]]
    return spark.createDataFrame(rows, "source string")


def p9_shares(spark, sf_dir):
    """Target and reached share of each source, in tokens of the mix that was drawn."""
    drawn, report = _mixed(spark, sf_dir)
    got = drawn.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.max("repeats").alias("most_repeats"), F.sum("n_tokens").alias("tokens_once"))
    total = F.sum("tokens").over(Window.partitionBy(F.lit(1)))
    want = spark.createDataFrame([(d["source"], d["target_share"], d["max_repeats"], d["short"]) for d in report], "source string, target_share double, max_repeats int, short boolean")
    both = want.join(got, "source", "left").fillna(0, ["tokens", "most_repeats", "tokens_once"])  # a row a source: few
    return both.withColumn("reached_share", F.round(F.try_divide(F.col("tokens").cast("double"), total.cast("double")), 6))


def p9_mix(spark, sf_dir):
    """The mix: every document that is used, with its number of repeats."""
    return _mixed(spark, sf_dir)[0].where("repeats > 0").select("doc_id", "source", "n_tokens", "repeats")
