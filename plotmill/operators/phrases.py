"""Over-used three-word phrases (A1-A3, J-5, P9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotmill.constants import CONTRACTIONS, PHRASE_BREAKS, PRONOUNS
from plotmill.functions.text import is_title, replace_all, strip
from plotmill.session import spread

LEAST_IN_STORY, LEAST_STORIES, LENGTH = 5, 3, 3


def skipped(word: Column) -> Column:
    """Words that disqualify a phrase."""
    return is_title(word) | word.isin(PRONOUNS)


def phrases(text: Column, length: int = LENGTH) -> Column:
    """All counted phrases of a text, repeated as often as they occur.

    The last window of each sentence is not counted, so a sentence of just `length` words has none (kept behaviour, Q-05).
    """
    curly = replace_all(text, [(c, "’" + c[1:]) for c in CONTRACTIONS])
    sentences = F.filter(F.transform(F.split(curly, PHRASE_BREAKS, -1), strip), lambda s: s != "")

    def windows(words: Column) -> Column:
        n = F.size(words)
        places = F.when(n > length, F.sequence(F.lit(1), n - length)).otherwise(F.array().cast("array<int>"))
        grams = F.transform(places, lambda i: F.slice(words, i, length))
        kept = F.filter(grams, lambda g: ~F.exists(g, skipped))
        return F.transform(kept, lambda g: F.replace(F.array_join(g, " "), F.lit("’"), F.lit("'")))

    return F.flatten(F.transform(F.transform(sentences, lambda s: F.split(s, " ", -1)), windows))


def story_phrases(df: DataFrame, story: str, text: str) -> DataFrame:
    """A1: `(story, phrase, count)`. Null texts count for nothing; exact, nothing is pruned (Q-06)."""
    each = spread(df.select(story, text)).select(F.col(f"`{story}`").alias("story"), F.explode(phrases(F.col(f"`{text}`"))).alias("phrase"))
    return each.groupBy("story", "phrase").agg(F.count("*").alias("count"))


def frequent_in_story(counts: DataFrame, least: int = LEAST_IN_STORY) -> DataFrame:
    """A3: phrases of a story that occur at least `least` times in it."""
    return counts.filter(F.col("count") >= least)


def frequent_overall(counts: DataFrame, least_in_story: int = LEAST_IN_STORY, least_stories: int = LEAST_STORIES) -> DataFrame:
    """J-5: `(phrase, count, stories)`, phrases frequent in enough stories; the count adds up all stories."""
    per = counts.groupBy("phrase").agg(F.sum("count").alias("count"), F.count_if(F.col("count") >= least_in_story).alias("stories"))
    return per.filter(F.col("stories") >= least_stories)
