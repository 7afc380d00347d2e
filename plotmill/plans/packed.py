"""Problem 1 as a query over whole tables."""

from pyspark.sql import DataFrame, SparkSession

from plotmill.operators.multivalue import split_packed
from plotmill.session import table

NAME_FIELDS = ["male characters", "female characters", "similar writers"]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split_packed(table(spark, sf_dir, "prompts"), NAME_FIELDS)
    return rows.filter("n_values > 1").select("record_id", "field", "pos", "item")


QUERIES = {"p1_found": p1_found}
