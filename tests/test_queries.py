"""Each core query against its SQL on the smallest tables, and the contract of the entry module."""

import os
import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from plotmill.plans import packed, reference

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SMALL):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SMALL}/{f}'")
    return c


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return Counter(tuple(str(round(r[k], 9)) if isinstance(r[k], float) else str(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(reference.ORACLES))
def test_same_rows_as_sql(spark, con, name):
    got = reference.QUERIES[name](spark, SMALL)
    result = con.execute(reference.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(got.columns) == sorted(columns)
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted({**reference.QUERIES, **packed.QUERIES}.keys() - reference.ORACLES.keys()))
def test_queries_without_sql_run(spark, name):
    df = {**reference.QUERIES, **packed.QUERIES}[name](spark, SMALL)
    assert df.count() >= 0 and df.columns


def test_generate_prompts_is_the_whole_job(spark):
    import json

    from plotmill.session import table

    raws = {(r["story"], r["chunk"], r["raw"]) for r in table(spark, SMALL, "raw_chunks").collect()}
    rows = reference.QUERIES["generate_prompts"](spark, SMALL).collect()
    assert len(rows) == table(spark, SMALL, "raw_chunks").count() and all((r["record"] is None) == (r["reason"] is not None) for r in rows)
    made = Counter((r["story"], r["chunk"]) for r in rows)
    assert made == Counter((r["story"], r["chunk"]) for r in table(spark, SMALL, "raw_chunks").select("story", "chunk").collect())
    told = {(r["story"], r["chunk"], json.loads(r["record"])["story"]) for r in rows if r["record"]}
    old, broken = [], []
    for s, c, raw in raws:
        try:
            old += [(s, c, json.loads(raw)["story"])] if raw and raw.startswith("{") else []
        except ValueError:  # plain text
            broken.append((s, c, raw))
    assert old and all((s, c, story.strip()) in told for s, c, story in old if story)
    ends = {(s, c, story[-40:]) for s, c, story in told}
    assert all((s, c, raw.strip()[-40:]) in ends or "\n" in raw.strip()[-40:] for s, c, raw in broken)
    assert any(json.loads(r["record"])["context"] for r in rows if r["record"] and r["chunk"].endswith(".txt"))


def test_entry(spark):
    assert entry.entry(spark).columns == ["story", "phrase", "count"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_does_not_import_the_training_data_package():
    root = os.path.join(os.path.dirname(entry.__file__), "plotmill")
    for folder, _, files in os.walk(root):
        if os.path.basename(folder) != "llm":
            for f in files:
                if f.endswith(".py"):
                    with open(os.path.join(folder, f)) as source:
                        assert not re.search(r"(?m)^\s*(?:from|import)\s+plotmill\.llm", source.read()), f
