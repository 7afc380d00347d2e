"""Sizes in tokens of a public tokenizer whose vocabulary file is a parameter."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A vocabulary file of the `tokenizers` library; all executors must be able to read it.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Longer texts are encoded in parts cut at white space, so that no single call holds much memory.
PART = 100_000


def _parts(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PART:
        end = text.rfind(" ", at + 1, at + PART)
        end = end if end > at else at + PART
        yield text[at:end]
        at = end
    yield text[at:]


def token_count(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of each text, special-token strings counted as ordinary text; 0 for null and empty texts."""

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary)
        tokenizer.encode_special_tokens = True
        for texts in batches:
            out = []
            for start in range(0, len(texts), 256):
                chunk = [list(_parts(t)) if t else [] for t in texts.iloc[start : start + 256]]
                sizes = iter([len(e.ids) for e in tokenizer.encode_batch_fast([p for ps in chunk for p in ps], add_special_tokens=False)])
                out += [sum(next(sizes) for _ in ps) for ps in chunk]
            yield pd.Series(out, dtype="int64")

    return count(text)
