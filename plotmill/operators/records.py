"""Prompt records as maps: reading, projecting, ordering, merging (S6, P1-P4, P13-P17, J-2, J-3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotmill.constants import ALLOWED_FIELDS, KEY_ORDER
from plotmill.functions.text import blank, let, strip

STRING_MAP = "map<string,string>"


def parse_record(raw: Column) -> Column:
    """The JSON object of a file as a map; null for anything else, which is then plain text (Q-24)."""
    return F.when(raw.rlike(r"^[ \t\n\r]*\{"), F.from_json(raw, STRING_MAP))


def only_keys(record: Column, keys: list[str] = ALLOWED_FIELDS) -> Column:
    """Entries whose key is listed."""
    return F.map_filter(record, lambda k, v: k.isin(keys))


def without_keys(record: Column, keys: list[str]) -> Column:
    """Entries whose key is not listed."""
    return F.map_filter(record, lambda k, v: ~k.isin(keys)) if keys else record


def rename_keys(record: Column, names: dict[str, str]) -> Column:
    """Keys renamed; where two fall together the later entry holds."""
    mapping = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    return _last_wins(F.transform(F.map_entries(record), lambda e: F.struct(F.coalesce(mapping[e["key"]], e["key"]).alias("key"), e["value"].alias("value"))))


def normalise_keys(record: Column) -> Column:
    """Keys trimmed and in lower case; where two fall together the later entry holds."""
    return _last_wins(F.transform(F.map_entries(record), lambda e: F.struct(F.lower(strip(e["key"])).alias("key"), e["value"].alias("value"))))


def _last_wins(entries: Column) -> Column:
    """A map of entries in order of first appearance, each key with its last value, whatever the session's policy on doubles."""
    def gathered(es: Column) -> Column:
        keys = F.array_distinct(F.transform(es, lambda e: e["key"]))
        return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(es, lambda e: e["key"] == k), -1)["value"]))

    return let(entries, gathered)


def ordered(record: Column, order: list[str] = KEY_ORDER) -> Column:
    """All keys of `order`, null where absent, then the others sorted (O3, U4)."""
    fixed = F.array(*map(F.lit, order))
    others = F.sort_array(F.array_except(F.map_keys(record), fixed))
    return let(F.concat(fixed, others), lambda keys: F.map_from_arrays(keys, F.transform(keys, lambda k: record[k])))


def without_nulls(record: Column) -> Column:
    """Entries with a value."""
    return F.map_filter(record, lambda k, v: v.isNotNull())


def full_text(record: Column) -> Column:
    """Context and story, or the story alone."""
    context, story = record["context"], record["story"]
    return F.when(F.coalesce(context, F.lit("")) != "", F.concat(context, F.lit("\n"), story)).otherwise(story)


def usable_context(context: Column) -> Column:
    r"""Null for blank contexts and the sentinel N\A (Q-12)."""
    return F.when(~blank(context) & (context != "N\\A"), context)


def overlay(base: Column, other: Column) -> Column:
    """Entries of `other` put over `base`; keys keep their place."""
    rest = F.map_filter(other, lambda k, v: ~F.array_contains(F.map_keys(base), k))
    kept = F.transform_values(base, lambda k, v: F.when(F.array_contains(F.map_keys(other), k), other[k]).otherwise(v))
    return F.when(other.isNull(), base).otherwise(F.map_concat(kept, rest))


def merge_records(base: DataFrame, extract: DataFrame, on: list[str], keys: list[str]) -> DataFrame:
    """J-2: records of `base` with the listed keys taken from the record of the same place in `extract`, even where null there.

    Both have the columns `on` and `prompt`. Rows of `base` without a partner are left out; `unmatched` gives them.
    """
    other = extract.select(*on, only_keys(F.col("prompt"), keys).alias("_other"))
    return base.join(other, on).select(*on, overlay(F.col("prompt"), F.col("_other")).alias("prompt"))


def unmatched(base: DataFrame, extract: DataFrame, on: list[str]) -> DataFrame:
    """J-1: rows of `base` without a partner in `extract`."""
    return base.join(extract.select(*on), on, "left_anti")


def inject(records: DataFrame, settings: DataFrame, on: str, keys: list[str]) -> DataFrame:
    """J-3, P16: the settings of a record's story written over its entries, also where empty; stories without settings stay (Q-17)."""
    values = settings.select(on, F.create_map(*(x for k in keys for x in (F.lit(k), F.col(f"`{k}`")))).alias("_set"))
    joined = records.join(values, on, "left")
    return joined.withColumn("prompt", overlay(F.col("prompt"), F.col("_set"))).drop("_set")


def parse_example(raw: Column) -> Column:
    r"""`\n\n---\n\n` between context, prompt and story, or prompt and story; no keys for four parts (Q-18); an error for one."""
    parts = F.split(raw, "\n\n---\n\n", 4)
    n = F.size(parts)
    three = F.create_map(F.lit("context"), F.get(parts, 0), F.lit("prompt"), F.get(parts, 1), F.lit("story"), F.get(parts, 2))
    two = F.create_map(F.lit("prompt"), F.get(parts, 0), F.lit("story"), F.get(parts, 1))
    return F.when(n == 3, three).when(n == 2, two).when(n > 3, F.map_filter(two, lambda k, v: F.lit(False))).when(n == 1, F.raise_error(F.lit("an example needs at least one --- line")))
