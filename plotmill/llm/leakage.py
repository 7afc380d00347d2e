"""Evaluation passages in a training corpus (problem 8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotmill.functions.text import let
from plotmill.session import broadcast_if_small, cut_lineage

#: Words of a passage that count as a leak, and words of a shingle.
WINDOW, SHINGLE = 12, 5


def tokens(text: Column) -> Column:
    """Runs of letters or digits, lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))


def _worded(df: DataFrame, key: str, text: str) -> DataFrame:
    """`(id, words)` of texts that are not null; not filtered by length, for which the words would be told twice."""
    return df.filter(F.col(f"`{text}`").isNotNull() & F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("id"), tokens(F.col(f"`{text}`")).alias("words"))


def _hashes(words: Column) -> Column:
    """The hash of each shingle, in order; null for fewer words (the optimiser may ask before it filters)."""
    places = F.when(F.size(words) >= SHINGLE, F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1)))
    return F.transform(places, lambda i: F.xxhash64(*(F.element_at(words, i + k) for k in range(SHINGLE))))


def _shingled(worded: DataFrame) -> DataFrame:
    """`(id, n, i, h)`: a row for each shingle with its place from 1; only the number of words goes beside it."""
    # exploded as an expression: of a column the optimiser would infer a filter that tells the words anew for each shingle
    rows = worded.withColumn("n", F.size("words")).select("id", "n", F.posexplode(_hashes(F.col("words"))).alias("i0", "h"))
    return rows.select("id", "n", (F.col("i0") + 1).alias("i"), "h")


def prefixes(items: DataFrame, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """`(item, s, h, ahead)`: the rarest shingle of each window of each item, `ahead` places after the window's start `s`; windows with a shingle that no document has are left out.

    `items` and `docs` are `(id, words)`. Rarity is counted over all documents, of which nothing but hashes is exploded.
    """
    held = cut_lineage(_shingled(items).select("id", "i", "h").distinct())
    each = docs.select(F.explode(_hashes(F.col("words"))).alias("h"))
    counts = cut_lineage(each.join(broadcast_if_small(held.select("h").distinct()), "h", "left_semi").groupBy("h").agg(F.count("*").alias("df")))
    rarity = held.join(broadcast_if_small(counts), "h", "left").select("id", "i", "h", F.coalesce("df", F.lit(0)).alias("df"))
    # windows begin at s and hold the shingles s .. s + window - SHINGLE; an item is a row of a benchmark, so its windows fit one task
    frame = Window.partitionBy("id").orderBy("i").rowsBetween(0, window - SHINGLE)
    starts = rarity.withColumn("best", F.min(F.struct("df", "i", "h")).over(frame)).withColumn("last", F.max("i").over(Window.partitionBy("id")))
    return (
        starts.filter((F.col("i") + (window - SHINGLE) <= F.col("last")) & (F.col("best.df") > 0))
        .select(F.col("id").alias("item"), F.col("i").alias("s"), F.col("best.h").alias("h"), (F.col("best.i") - F.col("i")).alias("ahead"))
    )


def leaked_passages(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """`(<doc_key>, <item_key>, runs BIGINT, longest BIGINT)`: documents that hold at least `window` consecutive words of an item.

    A set join with prefix filtering, in passes over the documents. The first counts how often each shingle of an item occurs in
    them. A window of an item is the set of its shingles, and containment needs every one, so its necessary prefix is the
    single shingle that is rarest: the second pass joins documents with these prefixes only. A match fixes where the window
    would have to lie within the document (the length and positional bounds), and the last pass fetches the words of documents with a match, each once,
    and compares the windows word by word. `longest` is the longest common run through a match. Null, empty and shorter texts
    leak nothing, rows with a null key are left out; repeated rows with one key count once; columns other than those named are
    not read.
    """
    if window < SHINGLE:
        raise ValueError("a window must hold at least one shingle")
    # texts of one key are items of their own until the end
    asked = cut_lineage(_worded(items, item_key, text).filter(F.size("words") >= window).distinct().withColumn("id", F.struct("id", F.xxhash64("words").alias("v"))))
    worded = _worded(docs, doc_key, text)
    needed = cut_lineage(prefixes(asked, worded, window))
    begin = F.col("i") - F.col("ahead")
    places = (
        _shingled(worded).join(broadcast_if_small(needed), "h")
        .filter((begin >= 1) & (begin + (window - 1) <= F.col("n")))
        .select("id", "item", "s", begin.alias("at")).distinct()
    )
    passages = asked.join(needed.select(F.col("item").alias("id"), "s").distinct(), "id").select(F.col("id").alias("item"), "s", F.slice("words", F.col("s"), window).alias("passage")).distinct()
    matches = places.join(broadcast_if_small(passages), ["item", "s"])
    # one row a document, with as many places as it may have; its words are brought once
    wanted = cut_lineage(matches.groupBy("id").agg(F.collect_list(F.struct("item", "s", "at", "passage")).alias("places")))
    held = worded.join(broadcast_if_small(wanted), "id")
    true = let(F.col("words"), lambda words: F.filter("places", lambda p: F.slice(words, p["at"], window) == p["passage"]))  # words are told once a row
    found = held.select("id", F.explode(true).alias("p")).select(F.col("id").alias("doc"), F.col("p.item.id").alias("item"), "p.at", "p.s").distinct()
    # consecutive windows on one diagonal are one run
    line = Window.partitionBy("doc", "item", F.col("at") - F.col("s")).orderBy("s")
    runs = (
        found.withColumn("run", F.col("s") - F.row_number().over(line))
        .groupBy("doc", "item", (F.col("at") - F.col("s")).alias("shift"), "run").agg((F.count("*") + (window - 1)).alias("length"))
        .groupBy("doc", "item").agg(F.count("*").alias("runs"), F.max("length").alias("longest"))
    )
    return runs.select(F.col("doc").alias(doc_key), F.col("item").alias(item_key), "runs", "longest")
