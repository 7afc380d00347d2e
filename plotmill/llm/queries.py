"""Queries of the training-data operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotmill.llm.canonical import map_to_canonical
from plotmill.llm.frequency import term_counts
from plotmill.llm.groups import grouped_splits
from plotmill.llm.leakage import leaked_passages
from plotmill.llm.mixing import mix_sources
from plotmill.llm.oracles import ORACLES  # noqa: F401
from plotmill.llm.pairs import flag_pairs
from plotmill.llm.residue import mark_residue, without_residue
from plotmill.llm.scans import repair_scans
from plotmill.llm.splitting import split_oversized
from plotmill.session import table


def _stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "prompts").select("record_id", F.col("prompt")["story"].alias("story"))


def _pages(spark: SparkSession, sf_dir: str, rewrite: bool) -> DataFrame:
    rows = table(spark, sf_dir, "prompts").select("record_id", F.col("prompt")["story"].alias("text"), F.col("story").alias("title"), F.col("prompt")["author"].alias("author"))
    return repair_scans(rows, "record_id", "text", ["title", "author"], rewrite)


def p2_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir, True)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir, False).select("record_id", F.explode("noise").alias("noise"))


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_oversized(_stories(spark, sf_dir), "story", "record_id")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_pieces(spark, sf_dir).filter("piece = 1 AND boundary IS NOT NULL").select("record_id", "boundary")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = map_to_canonical(table(spark, sf_dir, "prompts"), table(spark, sf_dir, "tag_vocab"), ["tone", "writing style"])
    return got.select("record_id", "field", "pos", "tag_id")


def p5_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_counts(table(spark, sf_dir, "prompts"), ["genre", "tone", "writing style"])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_terms(spark, sf_dir).filter("mark IS NOT NULL").select("field", "term", "mark")


def p6_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "prompts").select("record_id", F.col("prompt")["prompt"].alias("prompt"), F.col("prompt")["story"].alias("story"))
    return flag_pairs(rows, "prompt", "story")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_defects(spark, sf_dir).filter("rank = 1").select("record_id", "defect")


def p7_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_splits(table(spark, sf_dir, "prompts"), table(spark, sf_dir, "authors"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_splits(spark, sf_dir).select("record_id", "group_id")


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_leaks(spark, sf_dir).select("doc_id", "item_id")


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets")).report


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets")).documents


def p9_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the mixture keeps the totals that inclusion probabilities ask for, up to what landing two documents may change."""
    got = mix_sources(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))
    largest = got.documents.groupBy("source").agg(F.max("tokens").alias("largest"))
    rate = F.when(F.col("tokens") > 0, F.least(F.col("wanted") / F.col("tokens"), F.col("max_repeats").cast("double"))).otherwise(0.0)
    tokens = F.abs(F.col("mixed_tokens") - rate * F.col("tokens")) <= 2 * F.coalesce("largest", F.lit(0)) + 1e-6 * F.col("tokens")
    documents = F.abs(F.col("mixed_documents") - rate * F.col("documents")) <= 2
    return got.report.join(largest, "source", "left").select("source", tokens.alias("tokens_kept"), documents.alias("documents_kept"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_shares(spark, sf_dir).filter("short").select("source")


def p10_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_residue(table(spark, sf_dir, "documents"))


def p10_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_residue(table(spark, sf_dir, "documents"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_marks(spark, sf_dir).filter("residue IS NOT NULL").select("doc_id", "residue")


QUERIES = {
    "p2_repaired": p2_repaired,
    "p2_found": p2_found,
    "p3_pieces": p3_pieces,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p5_terms": p5_terms,
    "p5_found": p5_found,
    "p6_defects": p6_defects,
    "p6_found": p6_found,
    "p7_splits": p7_splits,
    "p7_found": p7_found,
    "p8_leaks": p8_leaks,
    "p8_found": p8_found,
    "p9_shares": p9_shares,
    "p9_mixture": p9_mixture,
    "p9_kept": p9_kept,
    "p9_found": p9_found,
    "p10_marks": p10_marks,
    "p10_corpus": p10_corpus,
    "p10_found": p10_found,
}
