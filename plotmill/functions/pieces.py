"""Tokens of a SentencePiece model, an alternative to the default regular expression (X-t1, X-t2)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _load(model: str):  # noqa: ANN202
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=model)


def piece_count(text: Column, model: str) -> Column:
    """Number of pieces of each text; 0 for null. `model` is a file that every executor can read, loaded once per batch stream."""

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = _load(model)
        for texts in batches:
            yield pd.Series([len(x) for x in own.encode([t or "" for t in texts], num_threads=1)], dtype="int64")

    return count(text)


def pieces(text: Column, model: str) -> Column:
    """The pieces of each text, word starts marked; null for null."""

    @F.pandas_udf("array<string>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = _load(model)
        for texts in batches:
            yield pd.Series([None if t is None else own.encode(t, out_type=str) for t in texts])

    return cut(text)


def join_pieces(parts: Column) -> Column:
    """The text that pieces stand for."""
    return F.regexp_replace(F.replace(F.array_join(parts, ""), F.lit("▁"), F.lit(" ")), "^ ", "")
