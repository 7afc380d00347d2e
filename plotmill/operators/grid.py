"""All combinations of template values, with trials (J-4, X-s15)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotmill.operators.fewshot import render


def template_grid(spark: SparkSession, template: str, values: dict[str, list[str]], trials: int) -> DataFrame:
    """`(<keys of values>, trial INT, prompt STRING, out_file STRING)`: each combination of values, as often as there are trials.

    The file name holds each value's first place in its list, so equal values share one. The lists come from a
    configuration file, so their product is small; it is a generator over arrays, not a join of tables.
    """
    df = spark.range(1).select(F.lit(1).alias("_one"))
    for key, options in values.items():
        df = df.withColumn(key, F.explode(F.array(*map(F.lit, options)))) if options else df.limit(0).withColumn(key, F.lit(""))
    df = df.withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(trials - 1))) if trials > 0 else F.lit(0)).drop("_one")
    if trials <= 0:
        df = df.limit(0)
    places = [F.concat(F.lit(k), (F.array_position(F.array(*map(F.lit, v)), F.col(f"`{k}`")) - 1).cast("string"), F.lit("_")) for k, v in values.items() if v]
    name = reduce(F.concat, [*places, F.lit("_trial"), F.col("trial").cast("string"), F.lit(".txt")])
    return df.withColumn("prompt", render(template, {k: F.col(f"`{k}`") for k in values})).withColumn("out_file", name)
