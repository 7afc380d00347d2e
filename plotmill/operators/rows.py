"""Dataset rows: style text, instruction, length, dropout, token estimate (X-s1, X-s4 to X-s7, X1, X-t3, X-t4, K12)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotmill.constants import DROPPABLE_TAGS, FORMAT_TOKENS, QUOTED_FIELDS, TAG_DROP_RATE, TRAINING_FORMAT
from plotmill.functions.text import draw, draw_bits, strip, token_count
from plotmill.operators.records import only_keys, usable_context, without_nulls
from plotmill.session import spread


def straight_quotes(record: Column, keys: list[str] = QUOTED_FIELDS) -> Column:
    """X-s1: curly double quotes of some entries made straight."""
    return F.transform_values(record, lambda k, v: F.when(k.isin(keys), F.translate(v, "“”", '""')).otherwise(v))


def drop_tags(record: Column, seed: int, *key: Column, rate: float = TAG_DROP_RATE, tags: list[str] = DROPPABLE_TAGS) -> Column:
    """Each droppable tag left out with probability `rate`, the same for a record in every subset."""
    if rate == 0:
        return record
    return F.map_filter(record, lambda k, v: ~(k.isin(tags) & (draw(seed, *key, k) < rate)))


def undo_hyphens(prompt: Column) -> Column:
    """X-s4: a bulleted scene prompt as one line."""
    opening = "Write a scene where\n-"
    flat = F.replace(F.replace(F.replace(prompt, F.lit(opening), F.lit("Write a scene where: ")), F.lit("\n-"), F.lit(" ")), F.lit("  "), F.lit(" "))
    return F.when(F.contains(prompt, F.lit(opening)), flat).otherwise(prompt)


def _given(value: Column) -> Column:
    return F.coalesce(value, F.lit("")) != ""


def prose_style(record: Column) -> Column:
    """X-s5: the tags of a record as prose."""

    def tag(label: str, key: str) -> Column:
        return F.when(_given(record[key]), F.concat(F.lit(f" {label}: "), F.lower(record[key]), F.lit("."))).otherwise("")

    tags = F.replace(F.concat(tag("Tone", "tone"), tag("Writing Style", "writing style"), tag("Genre", "genre")), F.lit(".."), F.lit("."))
    written = F.when(F.lower(F.coalesce(record["humor quality"], F.lit(""))) == "high", "Humorously written ").otherwise("Written ")
    pacing = F.when(_given(record["pacing"]), F.concat(F.lit("with "), F.lower(record["pacing"]), F.lit(" pacing, "))).otherwise("")
    moments = F.when(F.lower(record["moment-to-moment detail"]) == "high", "in moment to moment detail, ").otherwise("")
    senses = F.when(_given(record["sensory detail"]), F.concat(F.lit("in "), F.lower(record["sensory detail"]), F.lit(" detail, "))).otherwise("")
    view = F.when(_given(record["point of view"]), F.concat(F.lit("from a "), record["point of view"], F.lit(" perspective."))).otherwise("")
    text = F.regexp_replace(F.concat(written, pacing, moments, senses, view), r", \z", ".")
    author = F.when(_given(record["author"]) & (record["author"] != "N/A"), F.concat(F.lit(" In the style of "), record["author"], F.lit("."))).otherwise("")
    return strip(F.concat(tags, F.lit("\n"), text, author))


def plain_style(record: Column, seed: int, *key: Column) -> Column:
    """X-s6: `key: value. ` for each tag, in an order drawn for the record."""
    entries = F.filter(F.map_entries(record), lambda e: ~e["key"].isin("context", "story", "prompt") & _given(e["value"]))
    shuffled = F.sort_array(F.transform(entries, lambda e: F.struct(draw_bits(seed, *key, e["key"]).alias("at"), e["key"].alias("k"), e["value"].alias("v"))))
    return strip(F.array_join(F.transform(shuffled, lambda e: F.concat(e["k"], F.lit(": "), F.lower(e["v"]), F.lit(". "))), ""))


def length_bucket(story: Column) -> Column:
    """X-t4: a word for the story's length in tokens."""
    n = token_count(story)
    return F.when(n < 300, "short").when(n < 500, "medium").when(n < 800, "large").when(n < 1000, "huge").otherwise("massive")


def instruction(style: Column, prompt: Column) -> Column:
    """X-s7: style and prompt."""
    return strip(F.concat(style, F.lit("\n"), prompt))


def token_estimate(*parts: Column) -> Column:
    """X-t3: tokens of the parts run together, nulls skipped, and the fixed part of the format."""
    return token_count(F.concat_ws("", *parts)) + FORMAT_TOKENS


def dataset_rows(records: DataFrame, keys: list[str], record: str = "prompt", seed: int = 42, rate: float = TAG_DROP_RATE, prose: bool = True, keep: Sequence[str] = (), droppable: Sequence[str] = DROPPABLE_TAGS) -> DataFrame:
    """J6, row part: `(<keys>, <keep>, system, context, instruction, output, length, tokens, tags)`; `tags` is what remained of the record.

    Null records and absent entries count as empty texts (Q-13). `keys` name the row and seed its draws, columns `keep` are
    handed through.
    """
    place = [F.col(f"`{k}`").cast("string") for k in keys]
    kept = drop_tags(without_nulls(straight_quotes(only_keys(F.col(f"`{record}`")))), seed, *place, rate=rate, tags=list(droppable))
    names = [*keys, *keep]
    base = spread(records.select(*dict.fromkeys([*names, record]))).select(*names, F.coalesce(kept, F.create_map().cast("map<string,string>")).alias("tags"))
    tags = F.col("tags")
    base = base.select(
        *names, "tags", (prose_style(tags) if prose else plain_style(tags, seed, *place)).alias("style"), usable_context(tags["context"]).alias("context"),
        undo_hyphens(F.coalesce(tags["prompt"], F.lit(""))).alias("ask"), F.coalesce(tags["story"], F.lit("")).alias("output"), F.coalesce(tags["system suffix"], F.lit("")).alias("system"),
    )
    return base.select(
        *names, "system", "context", instruction(F.col("style"), F.col("ask")).alias("instruction"), "output",
        F.when(F.col("style") != "", length_bucket(F.col("output"))).otherwise("").alias("length"),
        token_estimate(F.col("style"), F.col("context"), F.col("ask"), F.col("output"), F.col("system")).alias("tokens"), "tags",
    )


def render_training_text(system: Column, context: Column, ask: Column, output: Column, formats: Mapping[str, str] = TRAINING_FORMAT) -> Column:
    """The text a model is trained on, from the format that fits the parts at hand (null parts are absent)."""

    def fill(name: str) -> Column:
        values = {"system": system, "context": context, "instruction": ask, "output": output}
        parts = []
        for k, piece in enumerate(formats[name].split("%")):
            parts.append(values[piece] if k % 2 and piece in values else F.lit(piece))
        return F.concat(*parts)

    return (
        F.when(system.isNotNull() & context.isNotNull(), fill("system,context,instruction,output"))
        .when(system.isNotNull(), fill("system,instruction,output"))
        .when(context.isNotNull(), fill("context,instruction,output"))
        .otherwise(fill("instruction,output"))
    )
