"""Visual-novel scripts to screenplay chunks (F4-F6, J-7, U2, X-s14, K2)."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotmill.constants import LOCATION_LEGEND, LOCATION_MARK, NARRATOR

_TOKEN = re.compile(r"[^\W\d_]+|\d|[^\w\s]|_")
_SPEAKER = re.compile(r'@nm t="([^"]*)"?')
_ACTION = re.compile(r"\*.*?\*")


@dataclass
class Script:
    """Elements of a screenplay and the locations and names met on the way."""

    elements: list[str] = field(default_factory=list)
    locations: dict[str, str] = field(default_factory=dict)
    names: list[str] = field(default_factory=list)


def _spoken(line: str) -> str:
    return line.replace("[r]", " ").replace("[np]", "")


def read_script(source: list[str], translations: Mapping[str, str]) -> Script:
    """the elements of a script; consecutive locations leave the last one.

    Dialogue before any speaker goes to the narrator (Q-07).
    """
    script = Script()
    places = set(translations) | set(translations.values())
    for line in map(str.strip, source):
        if line.startswith(LOCATION_MARK):
            if not line.startswith(LOCATION_LEGEND):
                shown = script.locations.setdefault(line, translations.get(line, line))
                if script.elements and script.elements[-1].strip() in places:
                    script.elements.pop()
                script.elements.append(shown + "\n")
                places |= {line, shown}
        elif m := _SPEAKER.match(line):
            script.names.append(m[1])
            script.elements.append(m[1].upper() + "\n")
        elif not line or line[0] in "@;*":
            continue
        elif line[0] == '"':
            said = _spoken(line).strip('"')
            if script.elements:
                script.elements[-1] = script.elements[-1].strip("\n") + f"\n{said}\n"
            else:
                script.elements.append(f"{NARRATOR}\n{said}\n")
        elif line[0].isalpha():
            script.elements.append(f"{NARRATOR}\n{_spoken(line)}\n")
    return script


def condense(elements: list[str]) -> list[str]:
    """narration that follows narration joined to it, once two elements exist."""
    out: list[str] = []
    for element in elements:
        if len(out) > 1 and element.startswith(NARRATOR) and out[-1].startswith(NARRATOR):
            out[-1] = out[-1].strip("\n") + " " + element.split("\n")[1] + "\n"
        else:
            out.append(element)
    return out


def chunk_script(script: Script, most: int, compat: bool = False) -> list[str]:
    """chunks of at most `most` tokens, each begun with the last location.

    An element that overflows a chunk opens the next one; with `compat` it is dropped, as is the last element of all (Q-07).
    """
    places = set(script.locations) | set(script.locations.values())
    out, body, place = [], "", ""
    elements = condense(script.elements)
    for k, element in enumerate(elements):
        if element.strip() in places:
            place = element.strip()
        elif not body and place:
            body = place + "\n"
        before, body = body, body + element
        over = len(_TOKEN.findall(body)) > most
        if compat:
            if over or k == len(elements) - 1:
                out.append(before)
                body = ""
        elif over and before and before != place + "\n":
            out.append(before)
            body = element if element.strip() in places or not place else f"{place}\n{element}"
    if not compat and body:
        out.append(body)
    return out


def screenplay_chunks(scripts: DataFrame, key: str, text: str, most: int, translations: Mapping[str, str] | None = None, compat: bool = False) -> DataFrame:
    """`(<key>, chunk_id BIGINT, is_roleplay BOOLEAN, text STRING)`, chunks numbered from 0; null and empty scripts give none."""
    known = dict(translations or {})
    rows = scripts.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).filter(F.col("text").isNotNull())
    kind = rows.schema["key"].dataType.simpleString()

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, ids, texts = [], [], []
            for i, body in enumerate(batch.column(1).to_pylist()):
                chunks = chunk_script(read_script(body.splitlines(), known), most, compat)
                at += [i] * len(chunks)
                ids += range(len(chunks))
                texts += chunks
            acted = [bool(_ACTION.search(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(ids, pa.int64()), pa.array(acted, pa.bool_()), pa.array(texts, pa.string())], ["key", "chunk_id", "is_roleplay", "text"]
            )

    return rows.mapInArrow(convert, f"key {kind}, chunk_id bigint, is_roleplay boolean, text string").withColumnRenamed("key", key)


def script_constants(scripts: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """The distinct locations and speakers of all scripts, `(location)` and `(name)`."""
    each = scripts.select(F.explode(F.split(F.col(f"`{text}`"), r"\r\n|\n|\r", -1)).alias("raw")).select(F.trim("raw").alias("line"))
    places = each.filter(F.col("line").startswith(LOCATION_MARK) & ~F.col("line").startswith(LOCATION_LEGEND)).select(F.col("line").alias("location")).distinct()
    names = each.filter(F.col("line").startswith('@nm t="')).select(F.regexp_extract("line", r'^@nm t="([^"]*)', 1).alias("name")).distinct()
    return places, names


def merged_constants(met: DataFrame, column: str, known: Mapping[str, str]) -> DataFrame:
    """`(<column>, shown)`: the known translations, and what was met beside them, shown as it is."""
    have = met.sparkSession.createDataFrame(list(known.items()), f"`{column}` string, shown string")
    return have.unionByName(met.join(F.broadcast(have.select(column)), column, "left_anti").select(column, F.col(f"`{column}`").alias("shown")))  # a translation file the driver has read
