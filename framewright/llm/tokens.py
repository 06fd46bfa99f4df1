"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rank file of the tokenizer (lines of a base64 token and its rank).
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits a text before the merges of these ranks.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def token_counter(path: str = RANKS, pattern: str = PATTERN):
    """A pandas UDF text -> number of tokens of the whole text (0 for null). ``path`` must exist on every executor."""

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for texts in batches:
            yield pd.Series([0 if t is None else len(enc.encode_ordinary(t)) for t in texts], dtype="int64")

    count.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(count, "bigint")


def source_name(c: Column) -> Column:
    """Source apart from case and blanks around it; null if empty."""
    s = F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    return F.when(s != "", s)


def sized(documents: DataFrame, path: str = RANKS) -> DataFrame:
    """``doc_id, source, text_key, n_tokens``; ``text_key`` names the exact text (null for a null text)."""
    return documents.select("doc_id", source_name(F.col("source")).alias("source"), F.md5("text").alias("text_key"), token_counter(path)(F.col("text")).alias("n_tokens"))
