"""Files as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plotmill.functions.text import draw_bits
from plotmill.operators.chunking import clean_bytes
from plotmill.operators.records import parse_record


def _name(path: Column, depth: int) -> Column:
    """The part of a path `depth` steps from its end, decoded."""
    return F.url_decode(F.replace(F.element_at(F.split(path, "/"), -1 - depth), F.lit("+"), F.lit("%2B")))


def books(spark: SparkSession, folder: str) -> DataFrame:
    """`(book, raw)`, one row for each `.txt` file directly in `folder`."""
    rows = spark.read.text(f"{folder.rstrip('/')}/*.txt", wholetext=True)
    return rows.select(F.regexp_replace(_name(F.col("_metadata.file_path"), 0), r"\.txt", "").alias("book"), clean_bytes(F.col("value")).alias("raw"))


def scripts(spark: SparkSession, folder: str) -> DataFrame:
    """S3: `(script, text)`, one row for each UTF-16 `.ks` file directly in `folder`."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.ks").load(folder)
    return rows.select(F.regexp_replace(_name(F.col("path"), 0), r"\.ks$", "").alias("script"), F.decode("content", "UTF-16").alias("text"))


def tree(spark: SparkSession, *roots: str, endings: tuple[str, ...] = (".txt", ".json")) -> DataFrame:
    """`(root, story, chunk, raw)`, the files two levels below each root."""
    parts = None
    for root in roots:
        rows = spark.read.text(f"{root.rstrip('/')}/*/*", wholetext=True)
        path = F.col("_metadata.file_path")
        one = rows.select(F.lit(root.rstrip("/").split("/")[-1]).alias("root"), _name(path, 1).alias("story"), _name(path, 0).alias("chunk"), F.col("value").alias("raw"))
        one = one.filter(F.col("chunk").rlike(rf"({'|'.join(e.replace('.', chr(92) + '.') for e in endings)})$"))
        parts = one if parts is None else parts.unionByName(one)
    if parts is None:
        raise ValueError("name at least one folder")
    return parts


def output_name(chunk: Column) -> Column:
    """X-s18: the name a chunk's output has."""
    return F.replace(chunk, F.lit(".txt"), F.lit(".json"))


def unprocessed(chunks: DataFrame, done: DataFrame) -> DataFrame:
    """S5, J-1: chunks whose output `(story, chunk)` is not among `done`."""
    return chunks.withColumn("_out", output_name(F.col("chunk"))).join(done.select("story", F.col("chunk").alias("_out")).distinct(), ["story", "_out"], "left_anti").drop("_out")


def with_record(chunks: DataFrame) -> DataFrame:
    """Chunks with the record they hold, null for plain text."""
    return chunks.withColumn("prompt", parse_record(F.col("raw")))


def new_stories(stories: DataFrame, settings: DataFrame) -> DataFrame:
    """`(story)` that have no settings yet."""
    return stories.select("story").filter("story IS NOT NULL").distinct().join(settings.select("story"), "story", "left_anti")


def shuffled(stories: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Rows in an order drawn from `key`."""
    return stories.orderBy(draw_bits(seed, F.col(f"`{key}`").cast("string")), key)
