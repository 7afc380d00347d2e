import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plotmill.llm.mixing import flight, landing, mix_sources
from plotmill.llm.tokens import token_count


def test_flight_keeps_totals():
    rng = random.Random(9)
    for n in (1, 2, 3, 50, 700):
        sizes = np.array([rng.randint(1, 500) for _ in range(n)], float)
        pi = np.full(n, rng.uniform(0.05, 0.95))
        out = flight(pi, sizes, rng)
        assert ((out >= 0) & (out <= 1)).all() and ((out > 0) & (out < 1)).sum() <= 2
        assert abs((out * sizes).sum() - (pi * sizes).sum()) < 1e-4 * sizes.sum() and abs(out.sum() - pi.sum()) < 1e-4 * max(n, 1)
        assert set(np.unique(landing(out, sizes))) <= {0.0, 1.0}


def test_flight_keeps_expectations():
    sizes = np.array([1.0, 5, 9, 2, 7, 3, 3, 8])
    mean = np.mean([flight(np.full(8, 0.4), sizes, random.Random(k)) for k in range(3000)], axis=0)
    assert np.abs(mean - 0.4).max() < 0.05


def test_equal_sizes_and_zero_sizes():
    for sizes in (np.full(20, 4.0), np.zeros(20)):
        out = flight(np.full(20, 0.3), sizes, random.Random(1))
        assert ((out > 0) & (out < 1)).sum() <= 2 and abs(out.sum() - 6) < 1e-6


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(10)
    rows = [(i, "word " * rng.randint(5, 60), rng.choice(["Big", "big ", "BIG", "big", "big", "small", None, " "])) for i in range(900)]
    return spark.createDataFrame([*rows, rows[0], (None, None, "small"), (7000, "", "small")], "doc_id bigint, text string, source string")


def test_mixture(spark, docs):
    targets = spark.createDataFrame([("Big", 0.5, 2), ("small", 0.45, 2), ("none", 0.05, 9), (None, 0.1, 1)], "source string, weight double, max_repeats int")
    got = mix_sources(docs, targets)
    report = {r["source"]: r for r in got.report.collect()}
    assert set(report) == {"Big", "small", "none"}
    assert report["small"]["short"] and report["none"]["short"] and not report["Big"]["short"]
    assert report["small"]["mixed_tokens"] == report["small"]["capacity"] and report["none"]["mixed_tokens"] == 0
    assert abs(report["Big"]["mixed_tokens"] - report["Big"]["wanted"]) < 80
    assert abs(sum(r["share"] for r in report.values()) - 1) < 1e-9
    used = got.documents.collect()
    assert all(1 <= r["copies"] <= 2 for r in used)
    assert sum(r["tokens"] * r["copies"] for r in used) == sum(r["mixed_tokens"] for r in report.values())
    again = {(r["doc_id"], r["copies"]) for r in mix_sources(docs, targets).documents.collect()}
    assert again == {(r["doc_id"], r["copies"]) for r in used}
    empty = mix_sources(docs.limit(0), targets).report.collect()
    assert all(r["mixed_tokens"] == 0 and r["tokens"] == 0 for r in empty)


def test_tokens(spark):
    texts = ["one two", None, "", "<|endoftext|>", "word " * 60_000]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(token_count(F.col("t"))).collect()]
    assert got[0] == 2 and got[1] == 0 and got[2] == 0 and got[3] > 1 and 60_000 <= got[4] <= 60_010
