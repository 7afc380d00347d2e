"""Tables as files."""

from __future__ import annotations

import json
from collections import defaultdict
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotmill.constants import KEY_ORDER


def write_chunks(chunks: DataFrame, folder: str, by: str) -> None:
    """K1, K2: chunks as JSON lines in one folder for each value of `by`."""
    chunks.write.mode("overwrite").partitionBy(by).json(folder)


def write_chunk_files(chunks: DataFrame, folder: str, by: str, roleplay: str | None = None) -> None:
    """K1, K2: each chunk as `<folder>/<by>/chunk_<chunk_id>.txt`, those with a true `roleplay` below `<folder>/roleplay`; tasks write files of their own, again after a failure.

    `folder` must be one that all executors share. For the record format that other jobs read at scale use `write_chunks`.
    """
    rows = chunks.select(F.col(f"`{by}`").alias("name"), "chunk_id", "text", (F.col(f"`{roleplay}`") if roleplay else F.lit(False)).alias("apart"))

    def write(part) -> None:  # noqa: ANN001
        for r in part:
            place = Path(folder, "roleplay") if r["apart"] else Path(folder)
            (place / r["name"]).mkdir(parents=True, exist_ok=True)
            (place / r["name"] / f"chunk_{r['chunk_id']}.txt").write_text(r["text"], "utf-8")

    rows.foreachPartition(write)


def write_records(records: DataFrame, folder: str) -> None:
    """K3: records as JSON objects, nulls kept, in one folder for each story."""
    rows = records.select("story", "chunk", F.to_json("prompt", {"ignoreNullFields": "false"}).alias("record"))
    rows.write.mode("overwrite").partitionBy("story").json(folder)


def write_extras(records: DataFrame, folder: str) -> None:
    """K3: what a record's keys outside the order hold, as JSON lines, for a look at what models add."""
    extra = F.map_filter("prompt", lambda k, v: ~k.isin(KEY_ORDER))
    records.select("story", "chunk", extra.alias("extras")).filter(F.size("extras") > 0).write.mode("overwrite").json(folder)


def write_answers(answers: DataFrame, folder: str) -> None:
    """The raw answer of each chunk, as it came."""
    answers.select("story", "chunk", "answer").write.mode("overwrite").json(folder, ignoreNullFields=False)


def write_rejects(answers: DataFrame, folder: str) -> None:
    """Junk answers and chunks without a result as JSON lines; `reason` is null where a later attempt was good."""
    answers.select("story", "chunk", "reason", "attempts", "answer", "junk").write.mode("overwrite").json(folder, ignoreNullFields=False)


def write_dataset(rows: DataFrame, folder: str, name: str) -> None:
    """K4: rows marked `is_validation` and the others as JSON lines; a null context is left out."""
    kept = ["system", "context", "instruction", "output"]
    rows.filter("NOT is_validation").select(*kept).write.mode("overwrite").json(f"{folder}/{name}")
    held = rows.filter("is_validation").select(*kept)
    if not held.isEmpty():
        held.write.mode("overwrite").json(f"{folder}/{name}_val")


def write_metrics(metrics: DataFrame, path: str) -> None:
    """K5: tag metrics as one nested JSON file; only counts above the threshold remain, so they fit the driver."""
    nested: dict[str, dict[str, int]] = defaultdict(dict)
    for r in metrics.orderBy("field", F.desc("count"), "value").toLocalIterator():
        nested[r["field"]][r["value"]] = r["count"]
    Path(path).write_text(json.dumps(nested, indent=2), "utf-8")


def write_phrases(counts: DataFrame, overall: DataFrame, folder: str) -> None:
    """K6: frequent phrases of each story and overall, the most frequent first; a story of very many is written by several tasks, in ranges."""
    order = ["story", F.desc("count"), "phrase"]
    counts.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("story").json(f"{folder}/stories")
    overall.orderBy(F.desc("count"), "phrase").write.mode("overwrite").json(f"{folder}/story_phrases")


def write_mapping(pairs: DataFrame, key: str, value: str, path: str) -> None:
    """K7, K9: a two-column table of names as one JSON object, streamed through the driver."""
    with Path(path).open("w", encoding="utf-8") as out:
        out.write("{")
        for n, r in enumerate(pairs.orderBy(key).toLocalIterator()):
            out.write((",\n  " if n else "\n  ") + json.dumps(r[key], ensure_ascii=False) + ": " + json.dumps(r[value], ensure_ascii=False))
        out.write("\n}\n")


def write_stories(stories: DataFrame, path: str) -> None:
    """K8: the stories alone, as Parquet."""
    stories.select("story").write.mode("overwrite").parquet(path)


def tested(spark: SparkSession, folder: str) -> DataFrame | None:
    """`(out_file)` of the results a folder holds; None if there are none yet."""
    try:
        return spark.read.schema("out_file string").json(folder).select("out_file").distinct()
    except AnalysisException:
        return None


def write_results(results: DataFrame, folder: str) -> None:
    """`(out_file, prompt, result)` as texts: prompt, line end, result. Files that are there already are not written again."""
    results.select("out_file", F.concat("prompt", F.lit("\n"), "result").alias("text")).write.mode("append").json(folder)
