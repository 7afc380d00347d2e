"""Random names for characters (P11, F10, X4, X-s12, X-s13, A8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotmill.constants import FEMALE_NAMES, MALE_NAMES, NAME_BLACKLIST, NAME_KEYS, TITLES
from plotmill.functions.text import let, strip
from plotmill.session import spread


def parse_names(field: Column) -> Column:
    """Names of a list, without those of which a part that is not empty is in lower case; empty for null (Q-13)."""
    raw = F.coalesce(field, F.lit(""))
    kept = F.filter(F.split(raw, ",", -1), lambda n: ~F.exists(F.split(n, " ", -1), lambda p: (p != "") & (p == F.lower(p))))
    return F.when(raw == "", F.array().cast("array<string>")).otherwise(F.transform(kept, strip))


def sample(names: Sequence[str], count: Column, seed: int, role: str, *key: Column) -> Column:
    """`count` different names drawn for a record; an error if there are fewer."""
    pool = F.sort_array(F.transform(F.array(*map(F.lit, names)), lambda n: F.struct(F.md5(F.concat_ws("|", F.lit(str(seed)), *key, F.lit(role), n)).alias("at"), n.alias("name"))))
    short = F.raise_error(F.lit(f"more names asked for than the {len(names)} given"))
    none = F.array().cast("array<string>")
    return F.when(count == 0, none).when(count > len(names), short).otherwise(F.transform(F.slice(pool, 1, count), lambda s: s["name"]))


def swaps(names: Column, first: Column, last: Column) -> Column:
    """X-s13: `(name, old_first, new_first, old_last, new_last)` for each name; parts that stay are empty."""

    def one(name: Column, i: Column, firsts: Column, lasts: Column) -> Column:
        parts = F.split(name, " ", -1)
        head = F.get(parts, 0)
        title, owner, barred = head.isin(TITLES), F.endswith(head, F.lit("'s")), head.isin(NAME_BLACKLIST)
        old_first = F.when(title, "").when(owner, F.substring(head, 1, F.length(head) - 2)).when(barred, "").otherwise(head)
        old_last = F.when(~title & (owner | barred), "").when(F.size(parts) == 2, F.get(parts, 1)).otherwise("")
        return F.struct(name.alias("name"), old_first.alias("old_first"), F.get(firsts, i).alias("new_first"), old_last.alias("old_last"), F.get(lasts, i).alias("new_last"))

    return let(first, lambda fs: let(last, lambda ls: F.transform(names, lambda n, i: one(n, i, fs, ls))))


def new_name(swap: Column) -> Column:
    """A name after both of its swaps."""
    once = F.when(swap["old_first"] != "", F.replace(swap["name"], swap["old_first"], swap["new_first"])).otherwise(swap["name"])
    return F.when(swap["old_last"] != "", F.replace(once, swap["old_last"], swap["new_last"])).otherwise(once)


def replacements(swap_list: Column) -> Column:
    """`(o, n)` in the order they are carried out: each part plain, in capitals and stuttered."""

    def forms(old: Column, new: Column) -> Column:
        def stutter(x: Column) -> Column:
            return F.concat(F.substring(x, 1, 1), F.lit("-"), x)

        pairs = [(old, new), (F.upper(old), F.upper(new)), (stutter(old), stutter(new))]
        return F.when(old == "", F.array().cast("array<struct<o:string,n:string>>")).otherwise(F.array(*(F.struct(a.alias("o"), b.alias("n")) for a, b in pairs)))

    return F.flatten(F.transform(swap_list, lambda s: F.concat(forms(s["old_first"], s["new_first"]), forms(s["old_last"], s["new_last"]))))


def replace_in(record: Column, pairs: Column, keys: Sequence[str] = NAME_KEYS) -> Column:
    """Plain, chained replacement in some entries of a record (Q-14)."""
    def renamed(ps: Column) -> Column:
        return F.transform_values(record, lambda k, v: F.when(k.isin(list(keys)), F.aggregate(ps, v, lambda a, p: F.replace(a, p["o"], p["n"]))).otherwise(v))

    return F.when(F.size(pairs) <= 0, record).otherwise(let(pairs, renamed))


def randomize_names(
    df: DataFrame, keys: list[str], record: str = "prompt", seed: int = 42, male: Sequence[str] = MALE_NAMES, female: Sequence[str] = FEMALE_NAMES, name_keys: Sequence[str] = NAME_KEYS
) -> DataFrame:
    """`(<keys>, prompt, swaps)`: records with their characters renamed, and what was swapped, men first.

    Null records and absent lists name nobody and come back as they are. Draws depend on the seed and `keys` alone.
    """
    place = [F.col(f"`{k}`").cast("string") for k in keys]
    col = F.col(f"`{record}`")
    named = spread(df.select(*keys, record)).select(*keys, col.alias("prompt"), parse_names(col["male characters"]).alias("m"), parse_names(col["female characters"]).alias("f"))
    m, f = F.size("m"), F.size("f")
    drawn = named.select(
        *keys, "prompt", "m", "f",
        F.concat(sample(male, m, seed, "male first", *place), sample(female, f, seed, "female first", *place)).alias("first"),
        F.concat(sample(male, m, seed, "male last", *place), sample(female, f, seed, "female last", *place)).alias("last"),
    )
    swapped = drawn.select(*keys, "prompt", swaps(F.concat("m", "f"), F.col("first"), F.col("last")).alias("swaps"))
    return swapped.select(*keys, replace_in(F.col("prompt"), replacements(F.col("swaps")), name_keys).alias("prompt"), "swaps")


def replaced_names(renamed: DataFrame, keys: list[str]) -> DataFrame:
    """`(old_name, new_name)` of all records; the record last in the order of `keys` decides, in it the last name."""
    each = renamed.select(*keys, F.posexplode("swaps").alias("i", "s")).select(*keys, "i", F.col("s.name").alias("old_name"), new_name(F.col("s")).alias("new_name"))
    changed = each.filter(F.col("old_name") != F.col("new_name"))
    return changed.groupBy("old_name").agg(F.max_by("new_name", F.struct(*keys, "i")).alias("new_name"))
