"""Chunk files as a stream: each run takes what arrived since the last (an addition to S5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plotmill.operators.records import parse_record


def arriving_chunks(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """`(story, chunk, raw, prompt)` of files two levels below `folder` as they arrive."""
    rows = spark.readStream.schema("value string").option("wholetext", "true").option("maxFilesPerTrigger", files_per_trigger).text(f"{folder.rstrip('/')}/*/*")
    parts = F.split(F.col("_metadata.file_path"), "/")
    return rows.select(F.url_decode(F.element_at(parts, -2)).alias("story"), F.url_decode(F.element_at(parts, -1)).alias("chunk"), F.col("value").alias("raw"), parse_record(F.col("value")).alias("prompt"))


def latest_deliveries(chunks: DataFrame, arrived: str, keys: list[str], delay: str = "7 days") -> DataFrame:
    """First delivery of each key of a stream; repeated ones within `delay` are dropped, and state older than that with them."""
    return chunks.withWatermark(arrived, delay).dropDuplicatesWithinWatermark(keys)


def run_once(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write everything new as Parquet and stop."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
