"""Few-shot documents: parsing, editing, rendering (F8, F9, X-s9)."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from plotmill.functions.text import WS, let, lines, strip
from plotmill.operators.records import without_keys


def _entries(example: Column) -> Column:
    """The entries of one example, in order, repeated keys too."""

    def cut(rows: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(rows)), lambda i: F.element_at(rows, i).startswith(">") & F.contains(F.element_at(rows, i), F.lit(":")))
        return let(starts, lambda at: F.transform(at, lambda i, k: entry(F.array_join(F.slice(rows, i, F.coalesce(F.get(at, k + 1), F.size(rows) + 1) - i), "\n"))))

    def entry(part: Column) -> Column:
        return F.struct(
            strip(F.substring_index(F.substring(part, F.lit(2), F.length(part)), ":", 1)).alias("key"),
            F.regexp_replace(F.regexp_replace(part, r"\A>[^:]*:", ""), r"\A ", "").alias("value"),
        )

    return let(F.split(example, "\n", -1), cut)


def parse(text: Column) -> Column:
    """F8: the examples of a `>key: value` document, each a map in order of first appearance.

    A blank line ends an example; lines without a key go on with the value before; those before any key are dropped; a
    repeated key overwrites. Null for null texts, empty for texts without a key.
    """
    body = F.array_join(lines(text), "\n")
    outer = F.regexp_replace(F.regexp_replace(body, rf"\A{WS}*\n", ""), rf"\n{WS}*\z", "")
    # examples lie between blank lines; each is cut at the lines that hold a key, so that every line is copied once
    examples = F.filter(F.transform(F.split(outer, rf"\n{WS}*\n", -1), _entries), lambda es: F.size(es) > 0)

    def as_map(entries: Column) -> Column:
        keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
        return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]))

    return F.transform(examples, as_map)


def serialise(examples: Column) -> Column:
    """Examples as a `>key: value` document, a blank line between them."""
    return F.array_join(F.transform(examples, lambda m: F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(F.lit(">"), e["key"], F.lit(": "), e["value"])), "\n")), "\n\n")


def edit(text: Column, remove: list[str]) -> Column:
    """a document without some keys."""
    return serialise(F.transform(parse(text), lambda m: without_keys(m, remove)))


def render(template: str, values: dict[str, Column]) -> Column:
    """X-s9: a template filled in one pass, so that braces inside a value stay as they are; a slot without a value is an error."""
    parts: list[Column] = []
    for literal, name, _, _ in string.Formatter().parse(template):
        parts.append(F.lit(literal))
        if name is not None:
            if name not in values:
                raise KeyError(name)
            parts.append(values[name])
    return F.concat(*parts)
