"""Token counts by a public byte-level tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: how this vocabulary's tokenizer splits text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, cluster, n_tokens) of every document with a doc_id; null and empty texts have 0 tokens.

    cluster is a hash of the text: copies of one text share it. Whole texts are counted, in Arrow batches, unshuffled.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = encoding(vocabulary).encode_ordinary
        for pdf in batches:
            n = [len(count(t)) if t else 0 for t in pdf.pop("text")]
            yield pdf.assign(n_tokens=n)

    rows = documents.where(F.col("doc_id").isNotNull()).select("doc_id", "source", F.xxhash64(F.trim("text")).alias("cluster"), "text")
    return rows.mapInPandas(run, "doc_id long, source string, cluster long, n_tokens long")
