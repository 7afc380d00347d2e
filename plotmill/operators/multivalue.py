"""Several values packed in one field: one row per value, position kept.

A *dialect* is the set of delimiter kinds that divide a field, together with its way of quoting (enclosing quotes with
doubled or back-slashed inner quotes, or a JSON array). Which dialect a field is written in is decided by minimum description
length. The words of all fields are counted over the whole collection, hashed into a table of fixed size (`WORD_BINS`), and give the
code length of a value: the sum of the code lengths of its words, an escape and a price a character for words never seen,
and an end mark. A dialect costs a fixed number of bits for each delimiter kind that it uses. Each field is parsed with
every dialect whose delimiters occur in it, and the cheapest parse is kept. Delimiters within parentheses, and within quotes
that by their form enclose an entry, divide under no dialect: a quoted entry holds them because they are not to divide.
"""

from __future__ import annotations

import functools
import itertools
import json
import math
import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotmill.session import spread

#: Size of the hashed word-count table that is sent to the workers (8 MB, whatever the input).
WORD_BINS = 1 << 20
ESCAPE_BITS, CHAR_BITS, END_BITS, DIALECT_BITS = 14.0, 5.0, 1.0, 3.0

# Whole fields that stand for "nothing" (lower case).
STAND_INS = ("", "n/a", "na", "none", "null", "nil", "unnamed", "unknown", "anonymous", "various", "-", "--", "—", "?", "tbd")

_DELIMITER = re.compile(
    r"""(?P<enum>(?:^|(?<=\s))\(?\d{1,3}[.)]\s+)
      |(?P<bullet>(?:^|(?<=\n))[ \t]*[•*‣◦▪–-][ \t]+|[ \t]*[•‣◦▪][ \t]*)
      |(?P<line>[\r\n]+)|(?P<tab>\t)
      |(?P<comma>[,，、])|(?P<semi>[;；])|(?P<slash>/)|(?P<pipe>\|)|(?P<dot>\s·\s)
      |(?P<amp>&|(?<=\s)\+(?=\s))|(?P<word>(?<=[\s,;/|])(?:and|und|et|y)(?=\s)|^and(?=\s))""",
    re.X | re.I,
)
_PROTECTED = re.compile(r'"(?:[^"\\]|""|\\.)*"|“[^”]*”|\([^()]*\)')
#: What may stand before an entry's opening quote and after its closing one.
_OPENS = re.compile(r"(?:^|[,;/|·&+\n\t•*‣◦▪–-]|\d[.)]|\b(?:and|und|et|y))\s*$", re.I)
_CLOSES = re.compile(r"\s*(?:$|[,;/|·&+\n\t•]|\d{1,3}[.)]\s|(?:and|und|et|y)\s)", re.I)
_STRUCTURE = re.compile(r'[,;/|·&+\n\r\t"“\[•*‣◦▪，、；]|\d[.)]|^\s*[-–]\s|\band\b|\bund\b|\bet\b|\by\b', re.I)
#: Words that hold any of these are not counted, nor are connecting words and list marks.
_UNCOUNTED = re.compile(r'[\s,;/|·&+"“”()\[\]•*‣◦▪，、；]|^(?:and|und|et|y|-|–|\d+[.)]?)$', re.I)


def _unquote(entry: str) -> str:
    entry = entry.strip()
    if len(entry) >= 2 and entry[0] == '"' and entry[-1] == '"' and _PROTECTED.fullmatch(entry):
        entry = re.sub(r'\\(["\\/])', r"\1", entry[1:-1].replace('""', '"'))
    elif len(entry) >= 2 and entry[0] == "“" and entry[-1] == "”" and "“" not in entry[1:]:
        entry = entry[1:-1]
    return entry.strip()


def _cuts(text: str) -> list[tuple[int, int, str]]:
    """Delimiters of `text` outside enclosing quotes and parentheses: start, end, kind."""
    spans = []
    at = 0
    while m := _PROTECTED.search(text, at):
        at = m.end()
        if m.group()[0] == "(" or (_OPENS.search(text, 0, m.start()) and _CLOSES.match(text, m.end())):
            spans.append(m.span())
        elif m.group()[0] != "(":
            at = m.start() + 1  # a quote that encloses no entry, as around a nickname
            nick = re.compile(r'"[^",;/|&\n\t]*"').match(text, m.start())
            if nick:
                at = nick.end()
                spans.append(nick.span())
    found = []
    k = 0
    for m in _DELIMITER.finditer(text):
        while k < len(spans) and spans[k][1] <= m.start():
            k += 1
        if k < len(spans) and spans[k][0] <= m.start() < spans[k][1]:
            continue
        found.append((m.start(), m.end(), m.lastgroup or ""))
    return found


def _pieces(text: str, cuts: list[tuple[int, int, str]], kinds: frozenset[str]) -> list[str]:
    out, at = [], 0
    for start, end, kind in cuts:
        if kind in kinds:
            out.append(text[at:start])
            at = end
    out.append(text[at:])
    return [e for e in map(_unquote, out) if e]


#: Parentheses and quotes inside a value cost nothing: they stand there under every dialect.
_MARKS = str.maketrans({"(": " ", ")": " ", '"': " ", "“": " ", "”": " "})


class Coder:
    """Code lengths of values under the counts of all words of the collection."""

    def __init__(self, bins: np.ndarray | Mapping[int, int]):
        if not isinstance(bins, np.ndarray):
            given, bins = bins, np.zeros(WORD_BINS, np.int64)
            for k, n in given.items():
                bins[k] = n
        self.bins, self.total = bins, int(bins.sum()) + 1
        self.kept: dict[str, float] = {}

    def word(self, word: str) -> float:
        bits = self.kept.get(word)
        if not word:
            return 0.0
        if bits is None:
            seen = not _UNCOUNTED.search(word)  # such words are in no count, so no other word's bin may stand for them
            n = int(self.bins[xxhash.xxh64_intdigest(word.encode(), 42) % WORD_BINS]) if seen else 0
            bits = math.log2(self.total / n) if n else ESCAPE_BITS + CHAR_BITS * len(word)
            if len(self.kept) < 200_000:
                self.kept[word] = bits
        return bits

    def value(self, value: str) -> float:
        return END_BITS + sum(map(self.word, value.translate(_MARKS).split(" ")))


def parse_field(text: str | None, coder: Coder) -> list[str]:
    """The values of one field under its cheapest dialect; [] for null, blank and stand-ins."""
    if text is None or text.strip().lower() in STAND_INS:
        return []
    if not _STRUCTURE.search(text):
        return [text.strip()]
    body = text.strip()
    if body[0] == "[" and body[-1] == "]":
        try:
            got = json.loads(body)
        except ValueError:
            got = None
        if isinstance(got, list) and all(isinstance(x, str | int | float) for x in got):
            values = [v for v in (str(x).strip() for x in got) if v]
            if DIALECT_BITS + sum(map(coder.value, values)) <= coder.value(body):
                return values
    cuts = _cuts(text)
    kinds = sorted({k for _, _, k in cuts})
    if not kinds:
        return [v] if (v := _unquote(text)) else []
    dialects = itertools.chain.from_iterable(itertools.combinations(kinds, n) for n in range(len(kinds), -1, -1))
    best, least, cost = [], math.inf, functools.cache(coder.value)
    for dialect in dialects:
        values = _pieces(text, cuts, frozenset(dialect))
        bits = DIALECT_BITS * len(dialect) + sum(map(cost, values))
        if bits < least:
            best, least = values, bits
    return best


def _fields(df: DataFrame, key: str, map_column: str, fields: list[str]) -> DataFrame:
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"`{map_column}`")[f].alias("raw")) for f in fields))
    return df.select(F.col(f"`{key}`").alias("key"), F.explode(pairs).alias("p")).select("key", "p.field", "p.raw")


def word_bins(values: DataFrame, column: str) -> np.ndarray:
    """Counts of the words of `column` over all rows, summed by hash; at most `WORD_BINS` rows reach the driver."""
    words = F.regexp_extract_all(F.col(column), F.lit(r"(?U)[^\s,;/|·&+\"“”()\[\]•*‣◦▪，、；]+"), F.lit(0))
    rows = (
        values.select(F.explode(words).alias("w"))
        .filter(~F.lower("w").isin("and", "und", "et", "y", "-", "–") & ~F.col("w").rlike(r"^\d+[.)]?$"))
        .groupBy(F.pmod(F.xxhash64("w"), F.lit(WORD_BINS)).cast("int").alias("bin"))
        .count()
        .collect()
    )
    out = np.zeros(WORD_BINS, np.int64)
    for r in rows:
        out[r["bin"]] = r["count"]
    return out


def split_packed(df: DataFrame, fields: list[str], key: str = "record_id", map_column: str = "prompt") -> DataFrame:
    """One row for each value packed in map entries `fields` of `map_column`.

    Returns `(<key>, field STRING, pos BIGINT, n_values BIGINT, item STRING)`; `pos` counts from 1, `n_values` is the number of values of
    the field. Null, empty and stand-in fields, null maps and absent keys give no row; repeated values and repeated rows each
    count; other columns of `df`, whatever their names, are not read. An empty table gives an empty result.
    """
    long = _fields(df, key, map_column, fields).filter(F.col("raw").isNotNull())
    bins = df.sparkSession.sparkContext.broadcast(word_bins(long, "raw"))
    key_type = df.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(bins.value)
        for batch in batches:
            at, pos, n, item = [], [], [], []
            for i, raw in enumerate(batch.column(2).to_pylist()):
                values = parse_field(raw, coder)
                at += [i] * len(values)
                pos += range(1, len(values) + 1)
                n += [len(values)] * len(values)
                item += values
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(pos, pa.int64()), pa.array(n, pa.int64()), pa.array(item, pa.string())],
                ["key", "field", "pos", "n_values", "item"],
            )

    out = spread(long).mapInArrow(parse, f"key {key_type}, field string, pos bigint, n_values bigint, item string")
    return out.withColumnRenamed("key", key)
