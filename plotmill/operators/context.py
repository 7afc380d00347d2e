"""Context and continuation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plotmill.constants import CONTINUATION_RATE
from plotmill.functions.text import draw, let, lines, token_count


def continues(seed: int, *key: Column, has_story: Column, rate: float = CONTINUATION_RATE) -> Column:
    """Whether a text is split into context and continuation; never if it has a story already."""
    return ~has_story & (draw(seed, *key, "continuation") < rate)


def split_context(text: Column) -> Column:
    """`(context, story)`: lines go to the story from the back while it has no more tokens than the context, else to the context from the front.

    One pass over token counts that are taken once per line.
    """
    return let(lines(text), lambda rows: let(F.transform(rows, token_count), lambda sizes: _split(rows, sizes)))


def _split(rows: Column, sizes: Column) -> Column:
    n = F.size(rows)
    start = F.struct(F.lit(0).alias("front"), F.lit(0).alias("back"), F.lit(0).alias("tf"), F.lit(0).alias("tb"))

    def step(s: Column, _: Column) -> Column:
        to_story = s["tb"] <= s["tf"]
        return F.struct(
            (s["front"] + F.when(to_story, 0).otherwise(1)).alias("front"),
            (s["back"] + F.when(to_story, 1).otherwise(0)).alias("back"),
            (s["tf"] + F.when(to_story, 0).otherwise(F.get(sizes, s["front"]))).alias("tf"),
            (s["tb"] + F.when(to_story, F.get(sizes, n - 1 - s["back"])).otherwise(0)).alias("tb"),
        )

    front = F.aggregate(rows, start, step, lambda s: s["front"])
    return let(front, lambda cut: F.struct(F.array_join(F.slice(rows, F.lit(1), cut), "\n").alias("context"), F.array_join(F.slice(rows, cut + 1, n), "\n").alias("story")))
