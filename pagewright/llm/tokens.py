"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

#: Name of a vocabulary among the installed public tokenizers, or the path of a .tiktoken file that all executors can read.
TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def encoder(tokenizer: str = TOKENIZER):
    import public_tokenizers
    import tiktoken

    path = tokenizer if os.path.sep in tokenizer else public_tokenizers.path(tokenizer)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, source, n_tokens, cluster``; ``cluster`` is alike for equal texts. A null text has no tokens and no cluster."""

    def start():
        enc = encoder(tokenizer)

        def work(cols):
            return {"doc_id": cols[0], "source": cols[1], "n_tokens": [len(enc.encode_ordinary(t)) if t else 0 for t in cols[2]], "cluster": cols[3]}

        return work

    docs = documents.select("doc_id", "source", "text", F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("cluster"))
    return map_rows(docs, "doc_id bigint, source string, n_tokens bigint, cluster bigint", ["doc_id", "source", "text", "cluster"], start)
