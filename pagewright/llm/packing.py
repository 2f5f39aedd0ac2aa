"""Problem 8: filling containers of fixed capacity.

Conflict-constrained best fit: within a shard the bins are ordered by residual; a bin carries one bitmap of duplicate clusters
and one of sources (several bits for a source that the shard is full of). An item goes into the tightest bin with room that
holds no copy of it and has a free bit of its source: the search moves on to the next larger residual until one is
compatible. Items that exceed the capacity are split into full containers and a rest, which is packed like any item.

Shards are made by a hash of the id and hold a bounded number of tokens, so a source or a group of copies of any size is
spread over many tasks. Per shard at most a few bins stay part-filled.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, read, spread
from .tokens import TOKENIZER, token_counts

SHARD_TOKENS = 2_000_000


def best_fit(items: list[tuple[int, int, int]], capacity: int, slots: dict[int, int]) -> tuple[list[int], int]:
    """(bin of each item, number of bins) for items (size, source, cluster); a cluster of -1 has no copies.

    ``slots``: how many items of a source a bin may hold. The set of residuals is one integer, so the next larger residual
    is found by its lowest bit.
    """
    first, at = {}, 0
    for s, k in slots.items():
        first[s] = at
        at += k
    bit: dict[int, int] = {}
    out = [0] * len(items)
    residuals = 0
    holding: Counter = Counter()  # bins with a copy of each cluster
    filled: Counter = Counter()  # bins without a free bit of each source
    at_residual: list[list[int]] = [[] for _ in range(capacity + 1)]
    left, clusters, sources = [], [], []
    for i in sorted(range(len(items)), key=lambda i: -items[i][0]):
        size, s, c = items[i]
        own = 1 << bit.setdefault(c, len(bit)) if c >= 0 else 0
        full = ((1 << slots[s]) - 1) << first[s]
        # Where every bin holds a copy, or none has room for the source, no search is needed.
        above = 0 if holding[c] == len(left) and c >= 0 or filled[s] == len(left) else residuals >> size
        r, chosen = size, -1
        while above and chosen < 0:
            step = (above & -above).bit_length() - 1
            r += step
            for k in range(len(at_residual[r]) - 1, -1, -1):
                b = at_residual[r][k]
                if not clusters[b] & own and sources[b] & full != full:
                    chosen = b
                    at_residual[r][k] = at_residual[r][-1]
                    at_residual[r].pop()
                    if not at_residual[r]:
                        residuals &= ~(1 << r)
                    break
            above >>= step + 1
            r += 1
        if chosen < 0:
            chosen = len(left)
            left.append(capacity)
            clusters.append(0)
            sources.append(0)
        left[chosen] -= size
        clusters[chosen] |= own
        holding[c] += 1
        free = ~sources[chosen] & full
        sources[chosen] |= free & -free
        filled[s] += sources[chosen] & full == full
        at_residual[left[chosen]].append(chosen)
        residuals |= 1 << left[chosen]
        out[i] = chosen
    return out, len(left)


def pack(tokens: DataFrame, specs: DataFrame, shard_tokens: int = SHARD_TOKENS, slack: float = 8.0, least_slots: int = 2) -> DataFrame:
    """``spec_name, container, doc_id, piece, n_pieces, n_tokens``: every document with tokens in every spec's containers.

    ``slack``: a bin has room for so many times the items of a source that the source's share of the shard calls for, at least
    ``least_slots``. Documents
    without tokens and specs without a positive capacity are left out. Null ids and sources are packed like others.
    """
    rows = tokens.where("n_tokens > 0")
    total = rows.agg(F.sum("n_tokens")).first()[0] or 0
    shards = max(1, -(-total // shard_tokens))
    spec = [(r.spec_name, r.capacity_tokens) for r in specs.select("spec_name", "capacity_tokens").where("capacity_tokens > 0").distinct().collect()]
    schema = "spec_name string, container string, doc_id bigint, piece int, n_pieces int, n_tokens bigint"
    if not spec:
        return tokens.sparkSession.createDataFrame([], schema)
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("spec_name"), F.lit(int(c)).alias("capacity")) for n, c in spec])).alias("s")
    shard = F.pmod(F.xxhash64(F.lit("shard"), F.coalesce("doc_id", F.xxhash64("cluster"))), F.lit(shards)).cast("int")
    spread_rows = rows.select("doc_id", "source", "n_tokens", "cluster", shard.alias("shard"), each).select("doc_id", "source", "n_tokens", "cluster", "shard", "s.spec_name", "s.capacity")

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        name, number = key
        capacity = int(pdf["capacity"].iloc[0])
        pdf = pdf.sort_values(["doc_id", "cluster"], kind="stable")
        copies = Counter(pdf["cluster"].tolist())
        code = {s: i for i, s in enumerate(sorted({s or "" for s in pdf["source"]}))}
        items, owner = [], []
        out = defaultdict(list)

        def put(container, doc, piece, pieces, n):
            for k, v in (("spec_name", name), ("container", container), ("doc_id", doc), ("piece", piece), ("n_pieces", pieces), ("n_tokens", n)):
                out[k].append(v)

        for doc, source, n, cluster in zip(pdf["doc_id"], pdf["source"], pdf["n_tokens"].tolist(), pdf["cluster"].tolist()):
            full, rest = divmod(n, capacity)
            pieces = full + (rest > 0)
            for k in range(full):
                put(f"{number}-{doc}-{k}", doc, k, pieces, capacity)
            if rest:
                items.append((rest, code[source or ""], cluster if copies[cluster] > 1 else -1))
                owner.append((doc, full, pieces))
        if items:
            mass = sum(n for n, _, _ in items)
            of = Counter(s for _, s, _ in items)
            per_bin = capacity * len(items) / mass
            slots = {s: max(least_slots, int(slack * per_bin * k / len(items) + 0.999)) for s, k in of.items()}
            where, _ = best_fit(items, capacity, slots)
            for (doc, piece, pieces), b, (n, _, _) in zip(owner, where, items):
                put(f"{number}-{b}", doc, piece, pieces, n)
        return pd.DataFrame(out)

    return spread_rows.groupBy("spec_name", "shard").applyInPandas(run, schema)


def _packed(spark, sf_dir):
    docs = spread(read(spark, sf_dir, "documents", "doc_id", "source", "text"))
    tokens = materialise(token_counts(docs, TOKENIZER), "p8-tokens")
    return pack(tokens, read(spark, sf_dir, "pack_specs"))


def p8_found(spark, sf_dir):
    # The documents that packing had to split.
    return _packed(spark, sf_dir).where("n_pieces > 1").select("spec_name", "doc_id").distinct()


def p8_containers(spark, sf_dir):
    """Of each spec: containers, pieces, tokens, and the share of the capacity that is used."""
    p = _packed(spark, sf_dir).join(F.broadcast(read(spark, sf_dir, "pack_specs").distinct()), "spec_name")  # pack_specs: a few rows, fixed
    return p.groupBy("spec_name", "capacity_tokens").agg(
        F.countDistinct("container").alias("containers"), F.count("*").alias("pieces"), F.sum("n_tokens").alias("tokens")
    ).withColumn("used", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6))
