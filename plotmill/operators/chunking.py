"""Books to token-bounded chunks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotmill.constants import ABBREVIATED_TITLES
from plotmill.functions.text import let, strip, token_count
from plotmill.session import spread


def clean_bytes(text: Column) -> Column:
    """A text without byte-order mark and bytes that are no UTF-8 (nor the characters put for such)."""
    return F.regexp_replace(F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit("")), "^\ufeff", "")


def opens(line: Column) -> Column:
    """A line a paragraph may start with: a digit, a capital or an apostrophe first (Q-02)."""
    return line.rlike(r"^[\p{N}\p{Lu}']")


def closes(line: Column) -> Column:
    """A line a paragraph ends with."""
    titles = "|".join(re.escape(t) for t in ABBREVIATED_TITLES)
    return line.rlike(r"""[.?'"]\z""") & ~line.rlike(rf"({titles})\z")


def paragraphs(raw: Column) -> Column:
    """the paragraphs of a text, line wrapping undone. Empty for blank texts (Q-01), null for null ones."""
    body = F.replace(clean_bytes(raw), F.lit("’"), F.lit("'"))
    kept = F.filter(F.transform(F.split(body, "\n", -1), strip), lambda x: (x != "") & ~x.rlike(r"^\p{N}+\z"))
    start = F.struct(F.array().cast("array<string>").alias("cur"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        chapter = F.lower(x).startswith("chapter")
        grown = F.when(chapter, F.concat(s["cur"], F.array(F.lit("\n")))).when((F.size(s["cur"]) > 0) | opens(x), F.concat(s["cur"], F.array(x))).otherwise(s["cur"])
        done = ~chapter & (F.size(grown) > 0) & closes(x)
        return F.struct(
            F.when(done, F.array().cast("array<string>")).otherwise(grown).alias("cur"),
            F.when(done, F.concat(s["out"], F.array(F.array_join(grown, " ")))).otherwise(s["out"]).alias("out"),
        )

    return F.aggregate(kept, start, step, lambda s: F.when(F.size(s["cur"]) > 0, F.concat(s["out"], F.array(F.array_join(s["cur"], "\n")))).otherwise(s["out"]))


def drop_long(parts: Column, most: int) -> Column:
    """F2, excluding mode: paragraphs of at most `most` tokens."""
    return F.filter(parts, lambda p: token_count(p) <= most)


_PIECE = re.compile(r"\s?[^\W\d_]+|\s?\d|\s?[^\s\w]|\s?_|\s")


def split_long_text(text: str, most: int) -> list[str]:
    """F2, splitting mode, for one text: pieces of at most `most` tokens, cut after a full stop or else before a word that a blank precedes."""
    pieces = _PIECE.findall(text)
    out = []
    while len(pieces) > most:
        end = most
        for k in range(most, 0, -1):
            if pieces[k - 1] == "." or (k < len(pieces) and pieces[k][0].isspace()):
                end = k
                break
        out.append("".join(pieces[:end]).strip())
        pieces = pieces[end:]
    out.append("".join(pieces).strip())
    return [p for p in out if p]


def split_long(parts: Column, most: int) -> Column:
    """F2, splitting mode: paragraphs, those over `most` tokens in pieces (no token is lost, Q-03)."""

    @F.pandas_udf("array<string>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for lists in batches:
            yield pd.Series([None if ps is None else [q for p in ps for q in split_long_text(p, most)] for ps in lists])

    return cut(parts)


def pack(parts: Column, most: int) -> Column:
    """paragraphs packed greedily into chunks of fewer than `most` tokens, one token added for each line end.

    A chunk begun after an overflow counts its first paragraph without that token (Q-04).
    """
    state = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"), F.array().cast("array<int>").alias("first"))

    def step(s: Column, p: Column) -> Column:
        return let(token_count(p), lambda size: grow(s, size))

    def grow(s: Column, size: Column) -> Column:
        fits = s["sum"] + size + 1 < most
        same = fits & (s["n"] > 0)
        return F.struct(
            F.when(fits, s["sum"] + size + 1).otherwise(size).alias("sum"),
            (s["n"] + 1).alias("n"),
            F.when(same, s["first"]).otherwise(F.concat(s["first"], F.array(s["n"] + 1))).alias("first"),
        )

    def joined(firsts: Column) -> Column:
        return F.transform(firsts, lambda f, i: F.array_join(F.slice(parts, f, F.coalesce(F.get(firsts, i + 1), F.size(parts) + 1) - f), "\n"))

    return F.aggregate(parts, state, step, lambda s: joined(s["first"]))


def pack_pieces(parts: Column, model: str, most: int, exclude: bool = False) -> Column:
    """F2, F3 with the tokens of a SentencePiece model: chunks of fewer than `most` pieces, over-long paragraphs cut before a word start, or left out.

    `model` is a file that every executor can read.
    """

    @F.pandas_udf("array<string>")
    def packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from sentencepiece import SentencePieceProcessor

        own = SentencePieceProcessor(model_file=model)
        for lists in batches:
            yield pd.Series([None if ps is None else _packed_pieces(list(ps), own, most, exclude) for ps in lists])

    return packed(parts)


def _packed_pieces(parts: list[str], model, most: int, exclude: bool) -> list[str]:  # noqa: ANN001
    capped: list[tuple[str, int]] = []
    for part in parts:
        # each piece with what it stands for in the text, so that nothing of it is lost, whatever the model normalises
        ids = [(p.piece, p.surface) for p in model.encode(part, return_type="proto").pieces]
        if len(ids) > most - 1 and exclude:
            continue
        while len(ids) > most - 1:
            end = next((k for k in range(most - 1, 0, -1) if ids[k - 1][0].endswith(".") or ids[k][0].startswith("▁")), most - 1)
            capped.append(("".join(t for _, t in ids[:end]).strip(), end))
            ids = ids[end:]
        capped.append(("".join(t for _, t in ids).strip(), len(ids)))
    out: list[list[str]] = []
    total = 0
    for text, size in capped:
        if text and out and total + size + 1 < most:
            out[-1].append(text)
            total += size + 1
        elif text:
            total = size + (0 if out else 1)
            out.append([text])
    return ["\n".join(c) for c in out]


def book_chunks(books: DataFrame, key: str, raw: str, most: int, exclude: bool = False, model: str | None = None) -> DataFrame:
    """`(<key>, chunk_id, text)`, chunks numbered from 1; over-long paragraphs are cut, or left out with `exclude`. With `model` tokens are those of a SentencePiece model."""
    if model:
        held = spread(books.select(key, raw)).select(F.col(f"`{key}`"), pack_pieces(paragraphs(F.col(f"`{raw}`")), model, most, exclude).alias("chunks"))
        return held.select(key, F.posexplode("chunks").alias("i", "text")).select(key, (F.col("i") + 1).cast("bigint").alias("chunk_id"), "text")
    parts = spread(books.select(key, raw)).select(F.col(f"`{key}`"), paragraphs(F.col(f"`{raw}`")).alias("parts"))
    capped = parts.select(key, (drop_long if exclude else split_long)(F.col("parts"), most - 1).alias("parts"))
    return capped.select(key, F.posexplode(pack(F.col("parts"), most)).alias("i", "text")).select(key, (F.col("i") + 1).cast("bigint").alias("chunk_id"), "text")
