"""Cutting oversized texts at natural boundaries, with overlap (problem 3)."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 2400, 200
PARAGRAPH, SENTENCE, WORD, CHARACTER = 3, 2, 1, 0
NAMES = {PARAGRAPH: "paragraph", SENTENCE: "sentence", WORD: "word", CHARACTER: "character"}

_BREAK = re.compile(r"\s*[\r\n\u2028\u2029]\s*")
_SENTENCE = re.compile(r"(?<=[.!?…])[\"'”’»«)\]}]*(?=\s)")
_BLANK = re.compile(r"\s+")


def boundaries(text: str) -> tuple[list[int], list[int], list[int]]:
    """Cut places of `text` in order: where the unit before ends, where the unit after starts, and the strength."""
    strength: dict[int, int] = {m.start(): WORD for m in _BLANK.finditer(text)}
    after = {m.start(): m.end() for m in _BLANK.finditer(text)}
    for m in _SENTENCE.finditer(text):
        if m.end() in strength:
            strength[m.end()] = SENTENCE
    for m in _BREAK.finditer(text):
        strength[m.start()] = PARAGRAPH
        after[m.start()] = m.end()
    ends = sorted(e for e in strength if 0 < e < len(text))
    return ends, [after[e] for e in ends], [strength[e] for e in ends]


def coarsest(text: str, limit: int = LIMIT) -> int:
    """The strongest level at which every unit fits into `limit`, by a plain scan; the check of `sufficient`."""
    ends, starts, level = boundaries(text)
    for least in (PARAGRAPH, SENTENCE, WORD):
        at, fits = len(text) - len(text.lstrip()), True
        for e, s, v in zip(ends, starts, level, strict=True):
            if v >= least:
                fits &= e - at <= limit
                at = s
        if fits and len(text.rstrip()) - at <= limit:
            return least
    return CHARACTER


class RangeMaximum:
    """Sparse table: place of the greatest value in a range, the rightmost one among equals; O(1) to ask.

    Only ranges of at most `widest` values are ever asked, so a row is built for each power of two up to that and a text of
    any length needs O(n log widest).
    """

    def __init__(self, values: list[int], widest: int):
        self.values = np.array(values, np.int8)
        self.rows = [np.arange(len(values), dtype=np.int32)]
        width = 1
        while 2 * width <= min(len(values), widest):
            a, b = self.rows[-1][:-width], self.rows[-1][width:]
            self.rows.append(np.where(self.values[b] >= self.values[a], b, a))
            width *= 2

    def of(self, lo: int, hi: int) -> int:
        """Place of the maximum among values[lo:hi]; needs lo < hi."""
        k = (hi - lo).bit_length() - 1
        a, b = int(self.rows[k][lo]), int(self.rows[k][hi - (1 << k)])
        return b if self.values[b] >= self.values[a] else a


Index = tuple[list[int], list[int], list[int], RangeMaximum]


def index(text: str, limit: int = LIMIT) -> Index:
    """The `boundaries` of `text` and the range maximum over their strengths, for windows of up to `limit` characters."""
    ends, starts, level = boundaries(text)
    return ends, starts, level, RangeMaximum(level, limit + 1)


def sufficient(text: str, limit: int = LIMIT, at: Index | None = None) -> int:
    """The strongest level at which every unit fits into `limit`: the least of the maxima of windows laid end to end.

    Each window begins where the strongest cut of the one before leads, the rightmost among equals. A level that suffices has a
    cut in any window, so none of the maxima is below it; and all cuts taken are at least of the least maximum, no two of them
    more than `limit` apart.
    """
    ends, starts, level, table = at or index(text, limit)
    least, start, stop = PARAGRAPH, len(text) - len(text.lstrip()), len(text.rstrip())
    while stop - start > limit:
        lo, hi = bisect_right(ends, start), bisect_right(ends, start + limit)
        if lo >= hi:
            return CHARACTER
        pick = table.of(lo, hi)
        least, start = min(least, level[pick]), starts[pick]
    return least


def cut(text: str, limit: int = LIMIT, overlap: int = OVERLAP, at: Index | None = None) -> list[tuple[int, int, int, int]]:
    """Pieces of `text` as (start, end, strength of the cut at the end, overlap with the piece before).

    Each piece has at most `limit` characters, the pieces cover all but blanks, and each starts up to `overlap` characters
    before the end of the one before, at a word start where there is one. The cut is the strongest in the whole permissible
    window, the rightmost among equals.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and less than the limit")
    ends, starts, level, table = at or index(text, limit)
    out: list[tuple[int, int, int, int]] = []
    start, done, stop = len(text) - len(text.lstrip()), 0, len(text.rstrip())
    if start >= stop:
        return []
    while True:
        if stop - start <= limit:
            out.append((start, stop, PARAGRAPH, max(0, done - start)))
            return out
        lo, hi = bisect_right(ends, max(done, start)), bisect_right(ends, start + limit)
        if lo < hi:
            pick = table.of(lo, hi)
            end, resume, strength = ends[pick], starts[pick], level[pick]
        else:
            end, resume, strength = start + limit, start + limit, CHARACTER
        out.append((start, end, strength, max(0, done - start)))
        done = end
        if overlap == 0:
            start = resume
        else:  # step back, forward again to the next word start if there is one before the cut
            back = max(end - overlap, start + 1)
            i = bisect_left(starts, back)
            start = starts[i] if i < len(starts) and starts[i] < end else (back if strength == CHARACTER else resume)


def split_oversized(df: DataFrame, text: str = "text", key: str = "doc_id", limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Pieces of at most `limit` characters of each text.

    Returns `(<key>, piece BIGINT, n_pieces BIGINT, start BIGINT, end BIGINT, overlap BIGINT, cut STRING, boundary STRING, text STRING)`; offsets are code points,
    `cut` is the kind of boundary at the piece's end, `boundary` the coarsest kind that suffices for the whole text. Texts
    within the limit are one piece with a null `boundary` and never leave the JVM. Null texts give no row, empty and blank ones
    neither; repeated rows are cut independently. Columns of `df` other than the two named are ignored.
    """
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    short = rows.filter((F.char_length("text") <= limit) & F.col("text").rlike(r"(?U)\S")).select(
        "key", F.lit(1).cast("bigint").alias("piece"), F.lit(1).cast("bigint").alias("n_pieces"), F.lit(0).cast("bigint").alias("start"),
        F.char_length("text").cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("overlap"), F.lit("paragraph").alias("cut"), F.lit(None).cast("string").alias("boundary"), "text",
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at: list[int] = []
            cols: list[list] = [[] for _ in range(8)]
            for i, body in enumerate(batch.column(1).to_pylist()):
                known = index(body, limit)
                got, least = cut(body, limit, overlap, known), NAMES[sufficient(body, limit, known)]
                for k, (s, e, strength, over) in enumerate(got):
                    at.append(i)
                    for c, v in zip(cols, (k + 1, len(got), s, e, over, NAMES[strength], least, body[s:e]), strict=True):
                        c.append(v)
            types = [pa.int64()] * 5 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))],
                ["key", "piece", "n_pieces", "start", "end", "overlap", "cut", "boundary", "text"],
            )

    long = rows.filter(F.char_length("text") > limit).mapInArrow(
        pieces, f"key {kind}, piece bigint, n_pieces bigint, start bigint, end bigint, overlap bigint, cut string, boundary string, text string"
    )
    return short.unionByName(long).withColumnRenamed("key", key)
