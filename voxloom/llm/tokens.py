"""Token counts by a public tokenizer, shared by packing (problem 8) and mixing (problem 9)."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vocabulary file of a byte-level tokenizer as ranks; a parameter everywhere, never part of this repository.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How a byte-level tokenizer cuts text before merging: contractions, letters, digits, other marks, white space.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("public", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str, path: str = TOKENIZER) -> int:
    return len(encoder(path).encode_ordinary(text))


def with_token_counts(docs: DataFrame, text: str = "text", path: str = TOKENIZER, name: str = "n_tokens") -> DataFrame:
    """``docs`` with ``text`` replaced by its number of tokens (``name``); whole texts are encoded, null counts 0.

    The text leaves the plan here: later shuffles carry numbers only.
    """
    kept = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for pdf in batches:
            out = pdf[kept].copy()
            out[name] = [len(enc.encode_ordinary(t)) if isinstance(t, str) and t else 0 for t in pdf[text]]
            yield out

    schema = ", ".join([*(f"`{c}` {dict(docs.dtypes)[c]}" for c in kept), f"{name} bigint"])
    return docs.select(*kept, F.col(text)).mapInPandas(run, schema)
