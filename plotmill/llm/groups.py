"""Train, validation and test splits that keep connected records together (problem 7)."""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotmill.session import broadcast_if_small, cut_lineage

SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}
#: Bits of the subset-sum bitset; totals beyond it are counted in units of total / RESOLUTION records.
RESOLUTION = 1 << 22
#: Groups of one size that one task numbers, about.
PER_BIN = 100_000
MAX_ROUNDS = 60


def _folds() -> tuple[str, str]:
    """Letters of Latin blocks and the plain letter each is folded to (by canonical decomposition, and by name for stroked ones)."""
    src, dst = [], []
    for code in range(0xC0, 0x250):
        ch = chr(code).lower()
        base = unicodedata.normalize("NFD", ch)[0]
        if base == ch and unicodedata.name(ch, "").startswith("LATIN SMALL LETTER ") and " WITH " in unicodedata.name(ch):
            base = unicodedata.name(ch).split("LETTER ")[1][0].lower()
        if base != ch and base.isascii() and ch not in src:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


_FROM, _TO = _folds()


def fold(name: Column) -> Column:
    """Lower case without diacritics, composed or combining."""
    return F.regexp_replace(F.translate(F.lower(name), _FROM, _TO), r"\p{M}", "")


def _words(name: Column) -> Column:
    return F.regexp_extract_all(fold(name), F.lit(r"[\p{L}\p{N}]+(?:['’-][\p{L}\p{N}]+)*"), F.lit(0))


def named_persons(df: DataFrame, authors: DataFrame, key: str = "record_id", map_column: str = "prompt", field: str = "author") -> DataFrame:
    """`(<key>, ids ARRAY<BIGINT>)`: the persons of `authors` named in each record, by their unique surname in any case and order.

    Records that name nobody have no row. `authors` is broadcast only if it is small enough, which is counted first.
    """
    surnames = authors.filter(F.col("name").isNotNull()).select(F.element_at(_words(F.col("name")), -1).alias("w"), "author_id").filter("w is not null")
    raw = F.col(f"`{map_column}`")[field]
    held = df.filter(raw.isNotNull() & F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("key"), F.explode(F.array_distinct(_words(raw))).alias("w"))
    found = held.join(broadcast_if_small(surnames), "w").groupBy("key").agg(F.array_sort(F.collect_set("author_id")).alias("ids"))
    return found.withColumnRenamed("key", key)


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """`(node, root)`: connected components, `root` the smallest node of each. `edges` is `(a, b)`, `nodes` is `(node)`.

    Parallel hooking and shortcutting over a parent table: each round hooks the greater of two adjacent roots under the
    smaller one and then replaces every parent by its own parent, until neither changes a row.
    """
    edges = cut_lineage(edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    both = edges.selectExpr("a AS node").union(edges.selectExpr("b AS node"))
    parents = cut_lineage(nodes.select("node").union(both).distinct().withColumn("root", F.col("node")))
    for _ in range(MAX_ROUNDS):
        pa, pb = parents.selectExpr("node AS a", "root AS ra"), parents.selectExpr("node AS b", "root AS rb")
        hooks = (
            edges.join(pa, "a").join(pb, "b").filter("ra != rb")
            .select(F.greatest("ra", "rb").alias("node"), F.least("ra", "rb").alias("hook"))
            .groupBy("node").agg(F.min("hook").alias("hook"))
        )
        hooked = parents.join(hooks, "node", "left").select("node", F.least("root", F.coalesce("hook", "root")).alias("root"))
        up = hooked.selectExpr("node AS root", "root AS above")
        nxt = cut_lineage(hooked.join(up, "root").select("node", F.col("above").alias("root")))
        moved = nxt.join(parents.withColumnRenamed("root", "was"), "node").filter("root != was").limit(1).count()
        parents = nxt
        if not moved:
            return parents
    raise RuntimeError(f"components did not settle within {MAX_ROUNDS} rounds")


def closest_subset(sizes: dict[int, int], target: float, total: int) -> dict[int, int]:
    """How many components of each size to take so that the sizes add up to as near `target` as possible.

    Subset sum over size multiplicities: bit s of a bitset says that sum s can be reached; each multiplicity is taken in
    binary portions. To walk back, the bitset before each block of portions is kept and those within a block are reckoned
    again, so that for n portions about 2 sqrt(n) bitsets are held. Sums are exact up to RESOLUTION records.
    """
    unit = max(1, -(-total // RESOLUTION))
    portions = []
    for size, n in sorted(sizes.items(), reverse=True):
        k = 1
        while n:
            take = min(k, n)
            portions.append((size, take, round(size * take / unit)))
            n -= take
            k *= 2
    cap = (1 << (round(2 * target / unit) + 2)) - 1
    step = math.isqrt(len(portions)) + 1
    blocks = [portions[k : k + step] for k in range(0, len(portions), step)]
    reach, before = 1, []
    for block in blocks:
        before.append(reach)
        for _, _, weight in block:
            reach |= (reach << weight) & cap
    want = round(target / unit)
    best = next(s for d in range(want + 1) for s in (want - d, want + d) if reach >> s & 1)
    taken: dict[int, int] = {}
    for block, first in zip(reversed(blocks), reversed(before), strict=True):
        trail = [first]
        for _, _, weight in block[:-1]:
            trail.append(trail[-1] | (trail[-1] << weight) & cap)
        for (size, take, weight), held in zip(reversed(block), reversed(trail), strict=True):
            if not held >> best & 1:
                taken[size] = taken.get(size, 0) + take
                best -= weight
    return taken


def grouped_splits(
    df: DataFrame, authors: DataFrame, key: str = "record_id", map_column: str = "prompt", field: str = "author", shares: dict[str, float] | None = None
) -> DataFrame:
    """`(<key>, group_id BIGINT, split STRING)` for every record that names a person of `authors`.

    Records are connected by common persons, directly or through others; `group_id` is the smallest person of the group.
    The first of `shares` is what remains once subset sums over whole groups came as near as possible to the others; among
    groups of one size a hash of the group decides. Null maps, absent keys, values that name nobody and rows with a null key
    give no row; rows with one key are one record; an empty table gives no rows.
    """
    shares = shares or SHARES
    named = cut_lineage(named_persons(df, authors, key, map_column, field).withColumnRenamed(key, "key"))
    first = F.element_at("ids", 1)
    edges = named.filter(F.size("ids") > 1).select(first.alias("a"), F.explode(F.slice("ids", 2, F.size("ids"))).alias("b"))
    per_person = cut_lineage(named.groupBy(first.alias("node")).agg(F.count("*").alias("records")))
    roots = components(edges, per_person.select("node"))
    groups = cut_lineage(roots.join(per_person, "node", "left").groupBy("root").agg(F.coalesce(F.sum("records"), F.lit(0)).alias("records")).filter("records > 0"))
    # distinct sizes are at most the square root of twice the records, so this stays small on the driver
    sizes = {r["records"]: r["count"] for r in groups.groupBy("records").count().collect()}
    assign = _assign(groups, sizes, shares)
    of = broadcast_if_small(roots.join(assign, "root").select("node", F.col("root").alias("group_id"), "split"))
    return named.select("key", first.alias("node")).join(of, "node").select(F.col("key").alias(key), "group_id", "split")


def _assign(groups: DataFrame, sizes: dict[int, int], shares: dict[str, float]) -> DataFrame:
    total = sum(s * n for s, n in sizes.items())
    names: Sequence[str] = list(shares)
    rest = dict(sizes)
    bounds: list[tuple[str, int, int, int]] = []  # split, size, first place, last place
    used = dict.fromkeys(sizes, 0)
    for name in names[1:]:
        for size, n in closest_subset(rest, shares[name] * total, max(total, 1)).items():
            bounds.append((name, size, used[size] + 1, used[size] + n))
            used[size] += n
            rest[size] -= n
    # groups of one size are numbered by their hash, in bins of bounded size whose first numbers are sums over the bins before
    bins = -(-max(sizes.values(), default=1) // PER_BIN)
    binned = groups.withColumn("bin", F.pmod(F.xxhash64("root"), F.lit(bins)))
    upto = F.sum("n").over(Window.partitionBy("records").orderBy("bin"))
    before = binned.groupBy("records", "bin").agg(F.count("*").alias("n")).select("records", "bin", (upto - F.col("n")).alias("before"))
    place = F.col("before") + F.row_number().over(Window.partitionBy("records", "bin").orderBy(F.xxhash64("root", F.lit(1)), "root"))
    numbered = binned.join(broadcast_if_small(before), ["records", "bin"]).withColumn("place", place)
    split: Column = F.lit(names[0])
    if bounds:
        spark = groups.sparkSession
        table = spark.createDataFrame(bounds, "name string, size bigint, lo bigint, hi bigint")
        joined = numbered.join(F.broadcast(table), (F.col("records") == F.col("size")) & F.col("place").between(F.col("lo"), F.col("hi")), "left")
        return joined.select("root", F.coalesce("name", split).alias("split"))
    return numbered.select("root", split.alias("split"))
