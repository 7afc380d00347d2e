"""Mapping freely typed values to the entries of a canonical list (problem 4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotmill.session import broadcast_if_small, cut_lineage

#: Least cosine, least lead over the next tag, and, for the exact check, the largest edit distance as a share of the longer spelling.
THRESHOLD, MARGIN, MAX_EDITS = 0.4, 0.03, 0.5
#: Different tags of a field that a word must accompany to be a qualifier.
QUALIFIES = 3

# Common words that qualify a value without changing what it means; others are learnt.
BEFORE, AFTER = ("slightly", "somewhat", "very", "quite", "rather", "mostly", "fairly", "a bit", "a little", "a touch of", "with a touch of"), ("undertones", "overtones")


def normalise(value: Column) -> Column:
    """Lower case, any dash a hyphen, outer punctuation gone, blanks reduced to one."""
    out = F.regexp_replace(F.lower(value), "[‐-―−_]+", "-")
    out = F.regexp_replace(out, r"(?U)[^\w\s-]+", " ")
    return F.trim(F.regexp_replace(out, r"(?U)\s+", " "))


def words(value: Column) -> Column:
    """The words of a normalised value, hyphens dividing too; those of common qualifiers are left out where others remain."""
    body = F.trim(F.regexp_replace(value, "[ -]+", " "))
    body = F.regexp_replace(body, rf"^(?:(?:{'|'.join(BEFORE)}) )+(?=.)", "")
    return F.split(F.regexp_replace(body, rf"(?<=.)(?: (?:{'|'.join(AFTER)}))+$", ""), " ")


def stripped(values: DataFrame, entries: DataFrame) -> DataFrame:
    """`(field, norm, value)`: distinct normalised values `(field, norm)`, and in `value` their words without outer qualifiers.

    A word is a qualifier of a field if it stands beside the whole spelling of an entry in values of at least `QUALIFIES`
    different tags, and no spelling begins or ends with it. Values of nothing but qualifiers stay as they are.
    """
    held = values.withColumn("w", words(F.col("norm")))
    spelled = entries.select("field", "tag_id", F.array_join(words(F.col("name")), " ").alias("name"))
    most = spelled.agg(F.coalesce(F.max(F.size(F.split("name", " "))), F.lit(0))).first()[0]
    spans = F.flatten(F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(max(most, 1)), F.size("w") - i + 1)), lambda n: F.struct(i.alias("i"), n.alias("n"), F.array_join(F.slice("w", i, n), " ").alias("name")))))
    spelled_in = held.filter(F.size("w") > 1).select("field", "w", F.explode(spans).alias("s")).select("field", "w", "s.*").join(broadcast_if_small(spelled), ["field", "name"])
    beside = spelled_in.select("field", "tag_id", F.explode(F.concat(F.slice("w", F.lit(1), F.col("i") - 1), F.slice("w", F.col("i") + F.col("n"), F.size("w")))).alias("q"))
    edges = spelled.select("field", F.explode(F.array(F.split("name", " ")[0], F.element_at(F.split("name", " "), -1))).alias("q")).distinct()
    learnt = beside.groupBy("field", "q").agg(F.count_distinct("tag_id").alias("tags")).filter(F.col("tags") >= QUALIFIES).join(broadcast_if_small(edges), ["field", "q"], "left_anti").select("field", "q", F.lit(True).alias("qualifies"))
    each = held.select("field", "norm", F.posexplode("w").alias("i", "q")).join(broadcast_if_small(cut_lineage(learnt)), ["field", "q"], "left")
    kept = F.when(F.col("qualifies").isNull(), F.col("i"))
    ends = each.groupBy("field", "norm").agg(F.min(kept).alias("lo"), F.max(kept).alias("hi"))
    inner = F.when(F.col("lo").isNull(), F.col("w")).otherwise(F.slice("w", F.col("lo") + 1, F.col("hi") - F.col("lo") + 1))
    return held.join(ends, ["field", "norm"]).select("field", "norm", F.array_join(inner, " ").alias("value"))


def squeeze(value: Column) -> Column:
    """A normalised value without blanks and hyphens."""
    return F.regexp_replace(value, r"[\s-]+", "")


def grams(value: Column) -> Column:
    """Features of a value, blanks and hyphens ignored: single letters, letter pairs, and windows of three with their letters sorted.

    Sorted windows and single letters survive letters changing places, pairs tell apart words of the same letters.
    """
    body = F.concat(F.lit("^"), squeeze(value), F.lit("$"))
    n = F.length(body)

    def at(width: int) -> Column:
        places = F.when(n >= width, F.sequence(F.lit(1), n - width + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.substring(body, i, F.lit(width)))

    one = F.transform(at(1), lambda c: F.concat(F.lit("="), c))
    three = F.transform(at(3), lambda c: F.concat(F.lit("~"), F.array_join(F.array_sort(F.split(c, "")), "")))
    return F.concat(one, at(2), three)


def split_values(raw: Column) -> Column:
    """Values of a field: divided at commas and the word `and`, trimmed; blank ones are left out."""
    parts = F.split(raw, r"(?iU)\s*,\s*(?:and(?=\s))?|\s+and(?=\s)", -1)
    return F.filter(F.transform(parts, lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")), lambda x: x != "")


def _vectors(counted: DataFrame, weights: DataFrame, totals: DataFrame, who: list[str]) -> DataFrame:
    """`(<who>, field, g, x, rest)` of gram counts `n`: weights of a vector of length 1, and the length of what remains of it from this gram on, the rarest first."""
    # a gram that no entry has weighs as much as one that a single entry has, and is rarer than all
    weight = F.when(F.col("g").startswith("="), 0.8).otherwise(1.0) * (1 + F.log(F.col("total") / F.greatest(F.col("df"), F.lit(1))))
    raw = counted.join(F.broadcast(totals), "field").join(weights, ["field", "g"], "left").withColumn("df", F.coalesce("df", F.lit(0))).withColumn("y", F.col("n") * weight)
    one = Window.partitionBy("field", *who)
    sized = raw.withColumn("x", F.col("y") / F.sqrt(F.sum(F.col("y") * F.col("y")).over(one)))
    after = one.orderBy("df", "g").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return sized.select("field", *who, "g", "x", F.sqrt(F.sum(F.col("x") * F.col("x")).over(after)).alias("rest"))


def candidates(values: DataFrame, index: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`(field, value, tag_id, name)`: all pairs whose cosine may reach the threshold, by prefix filtering over the inverted index.

    Let g be the rarest gram that both have. Everything they share lies from g on, so the cosine is at most the product of the
    lengths of what remains of both vectors from there; pairs below the threshold never meet.
    """
    reach = F.col("rest") * F.col("other") >= threshold
    probe = values.filter(F.col("rest") >= threshold)
    table = index.filter(F.col("rest") >= threshold).select("field", "g", "tag_id", "name", F.col("rest").alias("other"))
    return probe.join(broadcast_if_small(table), ["field", "g"]).filter(reach).select("field", "value", "tag_id", "name").distinct()


def match_values(values: DataFrame, entries: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The best entry of each distinct value: `(field, value, tag_id, name, score, second)`; values without any candidate are left out.

    `values` is `(field, value)` with distinct values, `entries` `(field, tag_id, name)` with a row for each spelling. The
    score is the cosine of gram counts weighted by inverse entry frequency; `second` is the best score of another tag.
    Everything of a value stays in the partition that `values` has it in.
    """
    names = entries.select("field", "tag_id", "name", F.explode(grams(F.col("name"))).alias("g")).groupBy("field", "tag_id", "name", "g").agg(F.count("*").alias("n"))
    totals = entries.groupBy("field").agg(F.count("*").alias("total"))
    weights = broadcast_if_small(cut_lineage(names.groupBy("field", "g").agg(F.count("*").alias("df"))))
    index = cut_lineage(_vectors(names, weights, totals, ["tag_id", "name"]))
    counts = values.select("field", "value", F.explode(grams(F.col("value"))).alias("g")).groupBy("field", "value", "g").agg(F.count("*").alias("n"))
    own = cut_lineage(_vectors(counts, weights, totals, ["value"]))
    pairs = candidates(own, index, threshold).join(broadcast_if_small(index.select("field", "tag_id", "name", "g", F.col("x").alias("y"))), ["field", "tag_id", "name"])
    dots = pairs.join(own.select("field", "value", "g", "x"), ["field", "value", "g"]).groupBy("field", "value", "tag_id", "name").agg(F.sum(F.col("x") * F.col("y")).alias("score"))
    best = dots.groupBy("field", "value", "tag_id").agg(F.max(F.struct("score", "name")).alias("b")).select("field", "value", "tag_id", "b.*")
    place = F.row_number().over(Window.partitionBy("field", "value").orderBy(F.desc("score"), "tag_id"))
    two = best.withColumn("place", place).filter("place <= 2")
    first = F.max(F.when(F.col("place") == 1, F.struct("tag_id", "name", "score")))
    return two.groupBy("field", "value").agg(first.alias("b"), F.coalesce(F.max(F.when(F.col("place") == 2, F.col("score"))), F.lit(0.0)).alias("second")).select("field", "value", "b.*", "second")


def map_to_canonical(
    df: DataFrame, vocab: DataFrame, fields: list[str], key: str = "record_id", map_column: str = "prompt", threshold: float = THRESHOLD, margin: float = MARGIN
) -> DataFrame:
    """Each value of `fields` that is not spelled exactly like a canonical tag, with the tag it means.

    Returns `(<key>, field STRING, pos BIGINT, value STRING, tag_id BIGINT, score DOUBLE)`; `tag_id` is 0 for values that mean no entry of `vocab`
    `(tag_id, field, tag, also_called)`. Distinct values are matched once, whatever their number of occurrences. Null maps,
    absent keys and blank values give no row; repeated rows and values count each.
    """
    tags = vocab.filter(F.col("field").isin(fields)).select("field", "tag_id", "tag")
    spellings = vocab.filter(F.col("field").isin(fields)).select("field", "tag_id", F.explode(F.concat(F.array("tag"), F.coalesce(F.split("also_called", r"\s*;\s*"), F.array().cast("array<string>")))).alias("name"))
    entries = spellings.select("field", "tag_id", normalise(F.col("name")).alias("name")).filter("name != ''").distinct()
    raw = F.array(*(F.struct(F.lit(f).alias("field"), split_values(F.col(f"`{map_column}`")[f]).alias("values")) for f in fields))
    held = df.select(F.col(f"`{key}`").alias("key"), F.explode(raw).alias("r")).select("key", "r.field", F.posexplode("r.values").alias("i", "value"))
    typed = held.join(broadcast_if_small(tags.select("field", F.col("tag").alias("value"))), ["field", "value"], "left_anti")
    distinct = cut_lineage(typed.groupBy("field", "value").agg(F.count("*").alias("n")).withColumn("norm", normalise(F.col("value"))))
    # few bytes but much work a value, so the number of partitions is set rather than left to their size
    tasks = max(2 * df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    inner = cut_lineage(stripped(distinct.filter("norm != ''").select("field", "norm").distinct(), entries))
    matched = match_values(inner.select("field", "value").repartition(tasks, "field", "value").distinct(), entries, threshold)
    # the exact check: edits as a share of the longer spelling
    a, b = squeeze(F.col("value")), squeeze(F.col("name"))
    edits = F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))
    accept = (F.col("score") >= threshold) & (F.col("score") - F.col("second") >= margin) & (edits <= MAX_EDITS)
    means = matched.select("field", "value", F.when(accept, F.col("tag_id")).otherwise(F.lit(0)).cast("bigint").alias("tag_id"), "score")
    found = inner.join(means, ["field", "value"]).select("field", "norm", "tag_id", "score")
    table = cut_lineage(distinct.join(found, ["field", "norm"], "left").select("field", "value", F.coalesce("tag_id", F.lit(0).cast("bigint")).alias("tag_id"), F.coalesce("score", F.lit(0.0)).alias("score")))
    out = typed.join(broadcast_if_small(table), ["field", "value"])
    return out.select(F.col("key").alias(key), "field", (F.col("i") + 1).cast("bigint").alias("pos"), "value", "tag_id", "score")
