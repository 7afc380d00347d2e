"""Files in and out, settings, streams and the command line."""

import json

import pytest
from pyspark.sql import functions as F

from plotmill import sinks
from plotmill.sources import files
from plotmill.sources.settings import Settings, extend_story_settings, replacement_lists, template
from plotmill.streaming.ingest import arriving_chunks, run_once


@pytest.fixture()
def tree(tmp_path):
    for story, chunk, raw in (("a b", "1.txt", "plain"), ("a b", "2.json", '{"story": "s"}'), ("c", "1.json", "cut {"), ("c", "x.md", "no")):
        (tmp_path / "in" / story).mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / story / chunk).write_text(raw)
    return tmp_path


def test_tree_and_resume(spark, tree):
    chunks = files.tree(spark, str(tree / "in"))
    assert {(r["root"], r["story"], r["chunk"]) for r in chunks.collect()} == {("in", "a b", "1.txt"), ("in", "a b", "2.json"), ("in", "c", "1.json")}
    got = {(r["story"], r["chunk"]): r["prompt"] for r in files.with_record(chunks).collect()}
    assert got[("a b", "2.json")] == {"story": "s"} and got[("a b", "1.txt")] is None and got[("c", "1.json")] is None
    done = spark.createDataFrame([("a b", "1.json")], "story string, chunk string")
    assert {r["chunk"] for r in files.unprocessed(chunks.filter("story = 'a b'"), done).collect()} == {"2.json"}


def test_books_and_scripts(spark, tmp_path):
    (tmp_path / "one.txt").write_bytes("﻿Title".encode() + b"\xff end.")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "two.txt").write_text("no")
    (tmp_path / "s.ks").write_bytes("hé".encode("utf-16"))
    assert [(r["book"], r["raw"]) for r in files.books(spark, str(tmp_path)).collect()] == [("one", "Title end.")]
    assert [(r["script"], r["text"]) for r in files.scripts(spark, str(tmp_path)).collect()] == [("s", "hé")]


def test_settings(tmp_path):
    s = Settings({"a": {"b": 1, "c": 2}}, {"a": {"b": 5}})
    assert s.get("a.b") == 5 and s.get("a.c") == 2
    s.override_with({"a": {"c": 9}})
    assert s.get("a.b") == 1 and s.get("a.c") == 9
    s.drop_override()
    assert s.get("a.b") == 5
    with pytest.raises(KeyError, match="a.z"):
        s.get("a.z")
    (tmp_path / "t.txt").write_text("{x}")
    (tmp_path / "t.replacements.json").write_text('{"x": ["1"]}')
    assert template(tmp_path / "t.txt") == ("{x}", {}) and replacement_lists(tmp_path / "t.txt") == {"x": ["1"]}
    assert extend_story_settings(tmp_path / "i.json", ["s1"], ["genre"]) == ["s1"]
    assert extend_story_settings(tmp_path / "i.json", ["s1"], ["genre"]) == []


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("", None, "i", "o", False), ("", "c", "i2", "o2", True)], "system string, context string, instruction string, output string, is_validation boolean")
    sinks.write_dataset(rows, str(tmp_path), "dataset_x")
    lines = [json.loads(x) for p in (tmp_path / "dataset_x").glob("*.json") for x in p.read_text().splitlines()]
    assert lines == [{"system": "", "instruction": "i", "output": "o"}]
    sinks.write_metrics(spark.createDataFrame([("tone", "a", 12), ("tone", "b", 30)], "field string, value string, count bigint"), str(tmp_path / "info.json"))
    assert list(json.loads((tmp_path / "info.json").read_text())["tone"].items()) == [("b", 30), ("a", 12)]
    sinks.write_mapping(spark.createDataFrame([("x", "y"), ("é", '"')], "o string, n string"), "o", "n", str(tmp_path / "m.json"))
    assert json.loads((tmp_path / "m.json").read_text()) == {"x": "y", "é": '"'}
    sinks.write_stories(spark.createDataFrame([("s", 1)], "story string, n int"), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).columns == ["story"]


def test_stream_takes_each_file_once(spark, tree):
    args = (str(tree / "out"), str(tree / "cp"))
    run_once(arriving_chunks(spark, str(tree / "in")), *args).awaitTermination()
    first = spark.read.parquet(args[0]).count()
    (tree / "in" / "c" / "9.txt").write_text("late")
    run_once(arriving_chunks(spark, str(tree / "in")), *args).awaitTermination()
    assert (first, spark.read.parquet(args[0]).count()) == (4, 5)


def test_cli_chunks_and_finalizes(spark, tmp_path):
    from plotmill import cli

    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.txt").write_text("One line here.\nTwo lines here.\n")
    cli.main(["chunk-books", str(tmp_path / "b"), str(tmp_path / "o"), "--max-tokens", "6"], spark)
    assert spark.read.json(str(tmp_path / "o")).filter(F.col("book") == "x").count() == 2
    for root in ("r1", "r2"):
        (tmp_path / root / "s").mkdir(parents=True)
        (tmp_path / root / "s" / "1.json").write_text(json.dumps({"prompt": "p", "story": "t " * 30, "tone": "wry"}))
    cli.main(["finalize", str(tmp_path / "r1"), str(tmp_path / "r2"), "--out", str(tmp_path / "d"), "--all-combinations"], spark)
    assert {p.name for p in (tmp_path / "d").iterdir()} >= {"dataset_r1", "dataset_r2", "dataset_r1_r2", "dataset_r1_info.json"}
