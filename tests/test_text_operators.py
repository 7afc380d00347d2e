"""Phrases, chunking, context split: hand-worked examples and invariants."""

import random

import pytest
from pyspark.sql import functions as F

from plotmill.functions.text import blank, is_title, lines, strip, token_count
from plotmill.operators.chunking import book_chunks, pack, paragraphs, split_long_text
from plotmill.operators.context import split_context
from plotmill.operators.phrases import frequent_overall, phrases, story_phrases


def test_strip_knows_all_white_space(one):
    assert one(strip(F.lit("   a b \t\n　"))) == "a b"
    assert one(blank(F.lit("  "))) and one(blank(F.lit(None).cast("string")))


def test_lines(one):
    assert one(lines(F.lit("a\r\nb\rc\n"))) == ["a", "b", "c"]


@pytest.mark.parametrize("word", ["Hello", "hello", "HELLO", "It’S", "A1B", "McDonald", "1a", "x", "", "Éa", "O'Neil", "'Tis"])
def test_is_title_agrees_with_python(one, word):
    assert one(is_title(F.lit(word))) == word.istitle()


def test_phrases_leave_out_last_window_and_pronouns(one):
    assert one(phrases(F.lit("out of the way now. one two three"))) == ["out of the", "of the way"]
    assert one(phrases(F.lit("out of his way now ok"))) == []
    assert one(phrases(F.lit("the dog's old bone fell down"))) == ["the dog's old", "dog's old bone", "old bone fell"]
    assert one(phrases(F.lit(""))) == []


def test_phrases_over_stories(spark):
    text = "out of the way now. " * 5
    df = spark.createDataFrame([("a", text), ("b", text), ("c", text), ("d", "out of the way now"), ("e", None)], "story string, text string")
    counts = story_phrases(df, "story", "text")
    assert {(r["story"], r["phrase"], r["count"]) for r in counts.collect()} >= {("a", "out of the", 5), ("d", "of the way", 1)}
    assert {(r["phrase"], r["count"], r["stories"]) for r in frequent_overall(counts).collect()} == {("out of the", 16, 3), ("of the way", 16, 3)}


def _fold(raw):
    """F1 written plainly."""
    import re

    titles = "Mr. Mrs. Dr. Ms. Prof. Capt. Lt. Cmdr. Sgt. Col. Gen. Rep. Hon. Sen. Gov. Rev. Sr. Jr. Pres.".split()
    out, cur = [], []
    for line in (x.strip() for x in raw.removeprefix("﻿").replace("’", "'").split("\n")):
        if not line or re.fullmatch(r"\d+", line):
            continue
        if line.lower().startswith("chapter"):
            cur.append("\n")
            continue
        if not cur and not (line[0].isdigit() or line[0].isupper() or line[0] == "'"):
            continue
        cur.append(line)
        if line[-1] in ".?'\"" and not any(line.endswith(t) for t in titles):
            out.append(" ".join(cur))
            cur = []
    return out + (["\n".join(cur)] if cur else [])


CASES = [
    "", "﻿The first line\nand the second.\n\n12\nChapter 1\nlower start is taken now.\n", "dropped line.\nKept Mr.\nWilum went.", "“Quoted” line.\n'Tis here.\nopen tail", "A\nB\nC", "1:1 Verse\nof one.\n1:2 Two!",
]


def test_paragraphs(spark):
    rng = random.Random(1)
    parts = ["The cat", "sat.", "chapter 2", "12", "", "“Hm,”", "Dr.", "went on?", "lower", "'Tis", "End!", " padded "]
    cases = CASES + ["\n".join(rng.choices(parts, k=rng.randint(1, 15))) for _ in range(80)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, raw string")
    for r in df.select("i", "raw", paragraphs(F.col("raw")).alias("p")).collect():
        assert r["p"] == _fold(r["raw"]), r["raw"]
    assert spark.range(1).select(paragraphs(F.lit(None).cast("string")).alias("p")).first()["p"] is None


def test_chunks_rejoin_to_paragraphs_and_keep_the_bound(spark):
    rng = random.Random(2)
    raw = "\n".join("Word " * rng.randint(1, 30) + "end." for _ in range(60))
    df = spark.createDataFrame([("b", raw), ("empty", ""), ("null", None)], "book string, raw string")
    got = book_chunks(df, "book", "raw", 50, exclude=True).orderBy("chunk_id").collect()
    assert {r["book"] for r in got} == {"b"}
    assert "\n".join(r["text"] for r in got) == "\n".join(_fold(raw))
    sizes = spark.createDataFrame([(r["text"],) for r in got], "t string").select(token_count(F.col("t")).alias("n")).collect()
    assert all(r["n"] < 50 for r in sizes)


def test_pack_first_overflow_is_not_doubled(one):
    parts = F.array(F.lit("a b c d e f g h"), F.lit("a"), F.lit("b c"))
    assert one(pack(parts, 6)) == ["a b c d e f g h", "a\nb c"]


def test_split_long_text_loses_nothing():
    text = "One two three. Four five six seven eight nine. " * 20
    pieces = split_long_text(text, 20)
    assert "".join("".join(pieces).split()) == "".join(text.split())
    assert all(len(p.split()) <= 20 for p in pieces)
    assert all(p[0] != "." for p in pieces)


def test_split_context_balances(spark):
    rng = random.Random(3)
    texts = ["\n".join("w " * rng.randint(0, 9) + "x" for _ in range(rng.randint(1, 12))) for _ in range(40)]

    def plain(text):
        rows = text.split("\n")
        front, back, head, tail = 0, len(rows), [], []
        for _ in rows:
            if sum(len(x.split()) for x in tail) <= sum(len(x.split()) for x in head):
                back -= 1
                tail.insert(0, rows[back])
            else:
                head.append(rows[front])
                front += 1
        return "\n".join(head), "\n".join(tail)

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", split_context(F.col("t")).alias("s")).collect():
        assert (r["s"]["context"], r["s"]["story"]) == plain(r["t"])
