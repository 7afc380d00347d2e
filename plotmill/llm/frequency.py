"""Frequency of every distinct term, with marks for those too rare or too common (problem 5)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotmill.session import broadcast_if_small, cut_lineage

#: Identifiers a count array covers.
RANGE = 4096
RARE_RECORDS, COMMON_SHARE = 3, 0.1


def terms(raw: Column) -> Column:
    """Terms of a packed field: divided at commas and the whole word `and`, lower case, blanks and trailing full stops tidied."""
    parts = F.split(F.lower(raw), r"(?U),|(?<![\w])and(?![\w])", -1)
    clean = F.transform(parts, lambda x: F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"(?U)\s+", " "), r"^ ", ""), r"[ .]+$", ""))
    return F.filter(clean, lambda x: x != "")


def dictionary(keys: DataFrame) -> DataFrame:
    """The distinct rows of `keys` with a dense `id` from 0: each partition numbers its rows from the sum of those before it."""
    own = F.monotonically_increasing_id()
    rows = cut_lineage(keys.distinct().withColumn("part", F.shiftright(own, 33)).withColumn("nth", own.bitwiseAND((1 << 33) - 1)))
    sizes = {r["part"]: r["count"] for r in rows.groupBy("part").count().collect()}  # one row a partition
    offsets, at = {}, 0
    for part in sorted(sizes):
        offsets[part] = at
        at += sizes[part]
    if not offsets:
        return rows.select(*keys.columns, F.lit(0).cast("bigint").alias("id"))
    table = F.create_map(*(x for p, o in offsets.items() for x in (F.lit(p).cast("bigint"), F.lit(o).cast("bigint"))))
    return rows.select(*keys.columns, (F.col("nth") + table[F.col("part")]).alias("id"))


def term_counts(df: DataFrame, fields: list[str], map_column: str = "prompt") -> DataFrame:
    """Occurrences of each term of each field and the number of records that hold it.

    Returns `(field STRING, term STRING, occurrences BIGINT, records BIGINT, field_records BIGINT, mark STRING)`; `field_records` is the number of records
    with a term in that field; `mark` is `rare` (fewer than 3 records), `common` (more than a tenth of `field_records`) or
    null. Null maps, absent keys, null and blank values count for nothing; each repeated row is a record of its own; an empty
    table gives no rows.
    """
    per_record = F.array(*(F.struct(F.lit(f).alias("field"), terms(F.col(f"`{map_column}`")[f]).alias("terms")) for f in fields))
    held = df.select(F.explode(per_record).alias("r")).select("r.field", "r.terms").filter(F.size("terms") > 0)
    each = held.select("field", "terms", F.posexplode("terms").alias("i", "term")).select(
        "field", "term", (F.array_position("terms", F.col("term")) == F.col("i") + 1).cast("bigint").alias("first"), (F.col("i") == 0).cast("bigint").alias("opens")
    )
    # a block is a partition of the input; its terms are counted before anything is shuffled
    blocks = cut_lineage(
        each.groupBy(F.spark_partition_id().alias("block"), "field", "term").agg(F.count("*").alias("occ"), F.sum("first").alias("rec"), F.sum("opens").alias("opens"))
    )
    ids = cut_lineage(dictionary(blocks.select("field", "term")))
    encoded = blocks.join(broadcast_if_small(ids), ["field", "term"]).select("id", "occ", "rec")

    def accumulate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        arrays: dict[int, np.ndarray] = {}
        for pdf in batches:
            which = pdf["id"].to_numpy() // RANGE
            for r in np.unique(which):
                part = pdf[which == r]
                block = arrays.setdefault(int(r), np.zeros((2, RANGE), np.int64))
                at = part["id"].to_numpy() % RANGE
                np.add.at(block[0], at, part["occ"].to_numpy())
                np.add.at(block[1], at, part["rec"].to_numpy())
            if len(arrays) >= 256:  # 16 MB; further arrays of the same range are summed below
                yield _rows(arrays)
                arrays = {}
        if arrays:
            yield _rows(arrays)

    def _rows(arrays: dict[int, np.ndarray]) -> pd.DataFrame:
        return pd.DataFrame({"rng": list(arrays), "occ": [a[0] for a in arrays.values()], "rec": [a[1] for a in arrays.values()]})

    def total(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = np.zeros((2, RANGE), np.int64)
        for pdf in batches:
            for occ, rec in zip(pdf["occ"], pdf["rec"], strict=True):
                whole[0] += occ
                whole[1] += rec
        at = np.flatnonzero(whole[0])
        yield pd.DataFrame({"id": at + key[0] * RANGE, "occurrences": whole[0][at], "records": whole[1][at]})

    arrays = encoded.mapInPandas(accumulate, "rng bigint, occ array<bigint>, rec array<bigint>")
    counts = arrays.groupBy("rng").applyInPandas(total, "id bigint, occurrences bigint, records bigint")
    per_field = blocks.groupBy("field").agg(F.sum("opens").alias("field_records"))
    mark = F.when(F.col("records") < RARE_RECORDS, "rare").when(F.col("records") > COMMON_SHARE * F.col("field_records"), "common")
    return (
        counts.join(ids, "id").join(F.broadcast(per_field), "field")  # per_field: a row for each of `fields`
        .select("field", "term", "occurrences", "records", "field_records", mark.alias("mark"))
    )
