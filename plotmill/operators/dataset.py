"""The finished dataset: token range, exact split, subsets of folders, tag metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotmill.constants import METRIC_LEAST, METRIC_SKIPPED, VALIDATION_SHARE
from plotmill.functions.text import draw_bits, strip
from plotmill.session import cut_lineage


def token_range(rows: DataFrame, least: int | None = None, most: int | None = None, column: str = "tokens") -> DataFrame:
    """P5: rows within the bounds that are given, both inclusive."""
    if least is not None:
        rows = rows.filter(F.col(column) >= least)
    return rows.filter(F.col(column) <= most) if most is not None else rows


def exact_split(rows: DataFrame, key: str, seed: int = 42, share: float = VALIDATION_SHARE) -> DataFrame:
    """`rows` with `is_validation`, true for exactly floor(share * n) of them, those with the smallest draw.

    No global sort: rows are counted by the upper 16 bits of their draw, and only the one bin the cut falls into is ranked.
    """
    drawn = rows.withColumn("_draw", draw_bits(seed, F.col(f"`{key}`").cast("string")))
    upper = F.shiftright("_draw", 16)
    bins = {r["b"]: r["count"] for r in drawn.groupBy(upper.alias("b")).count().collect()}  # at most 65,536 rows
    want, edge, before = int(share * sum(bins.values())), 1 << 16, 0
    for b in sorted(bins):
        if before + bins[b] > want:
            edge = b
            break
        before += bins[b]
    ranked = drawn.filter(upper == edge).withColumn("_rank", F.row_number().over(Window.partitionBy(F.lit(edge)).orderBy("_draw", key)))
    inside = ranked.select(*rows.columns, (F.col("_rank") <= want - before).alias("is_validation"))
    rest = drawn.filter(upper != edge).select(*rows.columns, (upper < edge).alias("is_validation"))
    return rest.unionByName(inside)


def subsets(names: list[str]) -> list[list[str]]:
    """All non-empty subsets, each new name joined to all before it: a, b, ab, c, ac, bc, abc."""
    return [[n for i, n in enumerate(names) if mask >> i & 1] for mask in range(1, 1 << len(names))]


def subset_name(subset: list[str], most: int | None = None, least: int | None = None) -> str:
    """X-s16: the name a subset's dataset is written under."""
    return "dataset_" + "_".join(subset) + (f"MAX{most}" if most is not None else "") + (f"MIN{least}" if least is not None else "")


def subset_totals(rows: DataFrame, root: str, value: str) -> DataFrame:
    """`(subset, n_rows, total)` of each subset of roots; rows are summed by root first, so the subsets join a handful of rows."""
    sums = cut_lineage(rows.groupBy(F.col(f"`{root}`").alias("root")).agg(F.count("*").alias("n"), F.sum(value).alias("v")))
    names = sorted(r["root"] for r in sums.select("root").collect() if r["root"] is not None)
    parts = rows.sparkSession.createDataFrame([("_".join(s), n) for s in subsets(names) for n in s] or [("", "")], "subset string, root string")
    return parts.join(F.broadcast(sums), "root").groupBy("subset").agg(F.sum("n").alias("n_rows"), F.sum("v").alias("total"))


def metric_values(field: Column, value: Column) -> Column:
    """A5: the values a tag counts under: divided at commas, and everywhere at `and` if any part holds it, even inside words (Q-10)."""
    body = F.regexp_replace(value, r"\.\z", "")
    view = F.array(F.when(F.contains(body, F.lit("(")), F.substring_index(body, "(", 1)).otherwise(body))
    parts = F.split(body, ",", -1)
    split = F.when(F.exists(parts, lambda p: F.contains(p, F.lit("and"))), F.flatten(F.transform(parts, lambda p: F.split(p, "and", -1)))).otherwise(parts)
    return F.transform(F.when(field == "point of view", view).otherwise(split), lambda v: F.lower(strip(v)))


def tag_metrics(rows: DataFrame, tags: str = "tags", length: str | None = "length", least: int = METRIC_LEAST) -> DataFrame:
    """`(field, value, count)` over what rows kept of their tags and over their lengths, counts above `least` only."""
    entries = F.filter(F.map_entries(F.col(f"`{tags}`")), lambda e: ~e["key"].isin(METRIC_SKIPPED) & (F.coalesce(e["value"], F.lit("")) != ""))
    if length:
        entries = F.concat(entries, F.filter(F.array(F.struct(F.lit("length").alias("key"), F.col(f"`{length}`").alias("value"))), lambda e: e["value"] != ""))
    each = rows.select(F.explode(entries).alias("e")).select(F.col("e.key").alias("field"), F.explode(metric_values(F.col("e.key"), F.col("e.value"))).alias("value"))
    return each.groupBy("field", "value").agg(F.count("*").alias("count")).filter(F.col("count") > least)
