"""Tag aliases and authors by popularity (J-6, J-8, A10, A11, X-s8, X5)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotmill.constants import ALIASES
from plotmill.functions.text import draw, let, literal_map, strip


def alias(value: Column, names: Mapping[str, str]) -> Column:
    """X-s8: a tag by its canonical name; lists are mapped part by part, the first of equal parts kept (Q-11).

    A value without a comma that is no alias stays as it was, in its own case.
    """
    mapping = literal_map(dict(names))
    low = F.regexp_replace(F.lower(value), r"^\.+|\.+\z", "")
    joined = F.when(F.contains(low, F.lit(" and ")), F.replace(F.replace(low, F.lit(" and "), F.lit(", and ")), F.lit(",,"), F.lit(","))).otherwise(low)

    def listed(parts: Column) -> Column:
        tidy = F.transform(parts, lambda p, i: F.when(i == F.size(parts) - 1, F.regexp_replace(p, "^and ", "")).otherwise(p))
        return F.array_join(F.array_distinct(F.transform(tidy, lambda p: F.coalesce(mapping[p], p))), ", ")

    split = F.transform(F.split(F.replace(joined, F.lit("with a touch of "), F.lit(",")), ",", -1), strip)
    return F.when(F.coalesce(value, F.lit("")) == "", value).when(mapping[low].isNotNull(), mapping[low]).when(F.contains(low, F.lit(",")), let(split, listed)).otherwise(value)


def alias_record(record: Column, table: Mapping[str, Mapping[str, str]] = ALIASES) -> Column:
    """J-6: a record with all its aliased fields by canonical name."""

    def mapped(k: Column, v: Column) -> Column:
        out = v
        for name, names in table.items():
            out = F.when(k == name, alias(v, names)).otherwise(out)
        return out

    return F.transform_values(record, mapped)


def popularity(records: DataFrame, record: str = "prompt", key: str = "similar writers") -> DataFrame:
    """A10: `(name, n)`: how often each writer, in lower case, is named in a list."""
    each = records.select(F.explode(F.split(F.col(f"`{record}`")[key], ",", -1)).alias("w")).select(F.lower(strip(F.col("w"))).alias("name"))
    return each.filter("name <> ''").groupBy("name").agg(F.count("*").alias("n"))


def narrow_authors(records: DataFrame, popular: DataFrame, key: str, record: str = "prompt", seed: int = 42, least: int = 20) -> DataFrame:
    """J-8, X5: `(<key>, author)` for the records whose author changes: those that name none but name similar writers.

    Candidates are the similar writers of which `popular` `(name, n)` counts more than `least`. Of several one is drawn, the less
    popular the likelier (weight: the others' share of the sum); none gives `N/A`. With an empty table nothing changes (Q-21).
    `key` must be unique.
    """
    col = F.col(f"`{record}`")
    silent = records.filter((F.coalesce(col["author"], F.lit("")) == "") & (F.coalesce(col["similar writers"], F.lit("N/A")) != "N/A"))
    if popular.isEmpty():
        return records.limit(0).select(key, F.lit("").alias("author"))
    each = silent.select(key, F.posexplode(F.split(col["similar writers"], ",", -1)).alias("i", "w")).select(key, "i", strip(F.col("w")).alias("writer"))
    enough = popular.filter(F.col("n") > least).select("name", "n")
    found = each.filter("writer <> 'N/A'").join(enough, F.lower("writer") == F.col("name")).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("i", "writer", "n"))).alias("c"))
    return silent.select(key).join(found, key, "left").select(key, _drawn(F.col("c"), draw(seed, F.col(f"`{key}`").cast("string"), "author")).alias("author"))


def _drawn(names: Column, at: Column) -> Column:
    """One writer of `(i, writer, n)`, weighted by what the others count."""
    total = F.aggregate(names, F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(None).cast("string").alias("pick"))

    def step(s: Column, x: Column) -> Column:
        upto = s["sum"] + (total - x["n"])
        return F.struct(upto.alias("sum"), F.coalesce(s["pick"], F.when(at * total * (F.size(names) - 1) < upto, x["writer"])).alias("pick"))

    drawn = F.coalesce(F.aggregate(names, start, step, lambda s: s["pick"]), F.get(names, F.size(names) - 1)["writer"])
    return F.when(names.isNull(), "N/A").when(F.size(names) == 1, F.get(names, 0)["writer"]).otherwise(drawn)
