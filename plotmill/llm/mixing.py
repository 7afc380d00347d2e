"""Mixing sources to target weights by balanced sampling (problem 9)."""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotmill.llm.tokens import VOCABULARY, token_count
from plotmill.session import cut_lineage, spread

#: Documents balanced together in one task; each block hands on at most two fractional probabilities.
BLOCK = 4096
_EDGE = 1e-9


def flight(pi: np.ndarray, sizes: np.ndarray, rng: random.Random) -> np.ndarray:
    """Inclusion probabilities moved to 0 or 1 while their token and document totals stay as they are; at most two stay between.

    The three units at hand span a null space of the two constraints; a step along it in either direction, as far as a
    probability reaches 0 or 1, is drawn so that each unit's expectation is kept.
    """
    out = pi.astype(float).copy()
    open_units = [k for k in range(len(out)) if _EDGE < out[k] < 1 - _EDGE]
    ones = np.array(1 / pi.clip(_EDGE))
    weight = sizes * ones
    hand: list[int] = []
    queue = iter(open_units)
    while True:
        while len(hand) < 3 and (k := next(queue, None)) is not None:
            hand.append(k)
        if len(hand) < 3:
            break
        i, j, k = hand
        a, b = (ones[i], ones[j], ones[k]), (weight[i], weight[j], weight[k])
        u = (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])
        if max(map(abs, u)) < 1e-12 * max(1.0, *map(abs, b)):  # equal sizes: any move that keeps the number
            u = (1 / a[0], -1 / a[1], 0.0)
        up = min((1 - out[m]) / x if x > 0 else out[m] / -x for m, x in zip(hand, u, strict=True) if x)
        down = min(out[m] / x if x > 0 else (1 - out[m]) / -x for m, x in zip(hand, u, strict=True) if x)
        step = up if rng.random() < down / (up + down) else -down
        for m, x in zip(hand, u, strict=True):
            out[m] = min(1.0, max(0.0, out[m] + step * x))
        hand = [m for m in hand if _EDGE < out[m] < 1 - _EDGE]
    return np.where(out >= 1 - _EDGE, 1.0, np.where(out <= _EDGE, 0.0, out))


def landing(pi: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The few probabilities left between 0 and 1 rounded to the combination that keeps the totals best."""
    left = np.flatnonzero((pi > 0) & (pi < 1))
    if not len(left):
        return pi
    tokens, count = float((pi * sizes)[left].sum()), float(pi[left].sum())
    scale = max(float(sizes.mean()), 1.0)
    best = min(itertools.product((0.0, 1.0), repeat=len(left)), key=lambda c: abs(float(np.dot(c, sizes[left])) - tokens) / scale + 0.1 * abs(sum(c) - count))
    out = pi.copy()
    out[left] = best
    return out


def source_key(source: Column) -> Column:
    """A source's name without case and outer blanks; null for blank ones."""
    key = F.regexp_replace(F.lower(source), r"(?U)^\s+|\s+$", "")
    return F.when(key != "", key)


def _balancer(last: bool, seed: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    def balance(who: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "tokens"], kind="stable", ignore_index=True)
        sizes = pdf["tokens"].to_numpy(float)
        rng = random.Random(f"{seed}|{who[0]}|{who[1]}|{len(pdf)}")  # a task that runs again draws the same
        pi = flight(pdf["pi"].to_numpy(), sizes, rng)
        return pdf.assign(pi=landing(pi, sizes) if last else pi)[["id", "key", "tokens", "whole", "first", "pi", "blocks"]]

    return balance


@dataclass
class Mixture:
    """`documents`: `(<key>, source, tokens, copies)`, each document used; `report`: a row for each target source."""

    documents: DataFrame
    report: DataFrame


def mix_sources(docs: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", vocabulary: str = VOCABULARY, seed: int = 42) -> Mixture:
    """A mixture as large as all documents with a source, in which each source of `targets` has its weight, as far as it can.

    Every document of a source is used as often as the whole part of (wanted tokens / own tokens), at most `max_repeats`
    times; the fractional part is its probability of one more copy, which the cube method balances by tokens and documents
    within the source: blocks of bounded size first, then what these leave undecided, until one block remains and lands.
    The report's columns are `source` as in `targets`, `weight`, `max_repeats`, `documents`, `tokens`, `wanted`, `capacity`, `short` (capacity below
    wanted), `mixed_tokens`, `mixed_documents` (copies), `share`. Documents with a null or blank source are left out, null texts have 0 tokens,
    repeated rows count each, null weights are 0 and null `max_repeats` 1, a source named
    several times has the largest of its values; an empty table gives a report of zeros.
    """
    sized = cut_lineage(
        docs.select(F.col(f"`{key}`").alias("id"), source_key(F.col(f"`{source}`")).alias("key"), F.col(f"`{text}`").alias("text"))
        .filter(F.col("key").isNotNull()).transform(spread).select("id", "key", token_count(F.col("text"), vocabulary).alias("tokens"))
    )
    held = cut_lineage(sized.groupBy("key").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents")))
    total = held.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).first()["t"]
    named = targets.select("source", source_key(F.col("source")).alias("key"), F.coalesce("weight", F.lit(0.0)).alias("weight"), F.coalesce("max_repeats", F.lit(1)).alias("max_repeats"))
    wanted = named.filter("key IS NOT NULL").groupBy("key").agg(F.min("source").alias("source"), F.max("weight").alias("weight"), F.max("max_repeats").alias("max_repeats"))
    plan = cut_lineage(
        wanted.join(held, "key", "left").fillna(0, ["tokens", "documents"])
        .withColumn("wanted", F.col("weight") * F.lit(float(total)))
        .withColumn("capacity", F.col("tokens") * F.col("max_repeats").cast("bigint"))
        .withColumn("short", F.col("capacity") < F.col("wanted"))
        .withColumn("rate", F.when(F.col("tokens") > 0, F.least(F.col("wanted") / F.col("tokens"), F.col("max_repeats").cast("double"))).otherwise(0.0))
        .withColumn("whole", F.floor("rate")).withColumn("part", F.col("rate") - F.col("whole"))
        .withColumn("blocks", F.ceil(F.greatest(F.col("documents"), F.lit(1)) / BLOCK))
    )
    # `targets` has a row for each source, the size of a configuration
    used = sized.join(F.broadcast(plan.select("key", "whole", "part", "blocks")), "key")
    even = used.filter("part = 0").select("id", "key", "tokens", "whole", F.lit(0.0).alias("pi"))
    state = used.filter("part > 0").select("id", "key", "tokens", "whole", F.col("part").alias("first"), F.col("part").alias("pi"), "blocks")
    largest = plan.agg(F.max("blocks")).first()[0] or 1
    schema = "id " + sized.schema["id"].dataType.simpleString() + ", key string, tokens bigint, whole bigint, first double, pi double, blocks bigint"
    decided = []
    while True:
        last = largest == 1

        placed = state.withColumn("block", F.pmod(F.xxhash64("id", "tokens", F.lit(seed)), F.col("blocks")))
        moved = cut_lineage(placed.groupBy("key", "block").applyInPandas(_balancer(last, seed), schema))
        decided.append(moved.filter("pi = 0 OR pi = 1"))
        if last:
            break
        # at most two of each block are still open
        state = moved.filter("pi > 0 AND pi < 1").withColumn("blocks", F.ceil(2 * F.col("blocks") / BLOCK))
        largest = -(-2 * largest // BLOCK)
    rows = even
    for part in decided:
        rows = rows.unionByName(part.select("id", "key", "tokens", "whole", "pi"))
    chosen = cut_lineage(rows.withColumn("copies", (F.col("whole") + F.col("pi")).cast("bigint")).filter("copies > 0").select("id", "key", "tokens", "copies"))
    reached = chosen.groupBy("key").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"), F.sum("copies").alias("mixed_documents"))
    mixed = reached.agg(F.coalesce(F.sum("mixed_tokens"), F.lit(0)).alias("m")).first()["m"]
    report = plan.join(reached, "key", "left").fillna(0, ["mixed_tokens", "mixed_documents"]).select(
        "source", "weight", "max_repeats", "documents", "tokens", "wanted", "capacity", "short", "mixed_tokens", "mixed_documents",
        (F.col("mixed_tokens") / F.lit(float(mixed or 1))).alias("share"),
    )
    names = F.broadcast(plan.select("key", "source"))
    return Mixture(chosen.join(names, "key").select(F.col("id").alias(key), "source", "tokens", "copies"), report)
