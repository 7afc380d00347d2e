from collections import Counter

import pytest

from pyspark.sql import functions as F

from plotmill.llm import canonical
from plotmill.llm.canonical import map_to_canonical
from plotmill.llm.frequency import RANGE, term_counts

VOCAB = [(1, "tone", "tense", "nail-biting; on edge"), (2, "tone", "melancholic", None), (3, "tone", "wry", "dry-witted"), (4, "style", "stream of consciousness", ""), (5, "tone", "light-hearted", None), (6, "tone", None, None)]


@pytest.fixture(scope="module")
def vocab(spark):
    return spark.createDataFrame(VOCAB, "tag_id bigint, field string, tag string, also_called string")


CASES = {
    "tense": None, "Tense": 1, "TENSE.": 1, "on edge": 1, "nail biting": 1, "very tense": 1, "tense-ish": 1, "tesne": 1, "with a touch of melancholic": 2, "melancolic undertones": 2, "mealncholic": 2,
    "'wry'": 3, "lighthearted": 5, "light–hearted": 5, "carbon copy": 0, "see hammer coat": 0, "box 14": 0, "stream of consciousness": 0, "?": 0,
}


def test_values(spark, vocab):
    df = spark.createDataFrame([(i, {"tone": v}) for i, v in enumerate(CASES)], "record_id bigint, prompt map<string,string>")
    got = {list(CASES)[r["record_id"]]: r["tag_id"] for r in map_to_canonical(df, vocab, ["tone"]).collect()}
    assert got == {k: v for k, v in CASES.items() if v is not None}


def test_positions_and_edges(spark, vocab):
    rows = [(1, {"tone": "tense, Wry , and rhubarb", "style": "Stream of Consciousness"}, 0), (2, None, 0), (3, {"tone": None}, 0), (4, {"tone": " , "}, 0), (1, {"tone": "tense, Wry , and rhubarb", "style": None}, 0), (5, {"tone": "x" * 5000}, 0)]
    df = spark.createDataFrame(rows, "record_id bigint, prompt map<string,string>, value int")
    got = Counter((r["record_id"], r["field"], r["pos"], r["tag_id"]) for r in map_to_canonical(df, vocab, ["tone", "style"]).collect())
    assert got == {(1, "tone", 2, 3): 2, (1, "tone", 3, 0): 2, (1, "style", 1, 4): 1, (5, "tone", 1, 0): 1}
    assert map_to_canonical(df.limit(0), vocab, ["tone"]).count() == 0
    assert {r["tag_id"] for r in map_to_canonical(df, vocab.limit(0), ["tone"]).collect()} == {0}


def test_terms_against_counting(spark):
    values = ["Wry, tense and wry.", "tense", "candid", " , ", None, "Slow  burn. , tense", "and", "band and  hand"] * 3
    values += [f"term{i}" for i in range(RANGE + 50)]
    df = spark.createDataFrame([(i, {"tone": v}, "x") for i, v in enumerate(values)] + [(0, None, "x")], "record_id bigint, prompt map<string,string>, term string").repartition(5)
    occ, rec, held = Counter(), Counter(), 0
    import re

    for v in values:
        t = [x for x in (re.sub(r"[ .]+$", "", re.sub(r"\s+", " ", p).strip()) for p in re.split(r",|\band\b", (v or "").lower())) if x]
        held += bool(t)
        occ.update(t)
        rec.update(set(t))
    got = {r["term"]: r for r in term_counts(df, ["tone", "none"]).collect()}
    assert {t: r["occurrences"] for t, r in got.items()} == occ and {t: r["records"] for t, r in got.items()} == rec
    assert all(r["field_records"] == held for r in got.values())
    assert {r["mark"] for t, r in got.items() if rec[t] < 3} == {"rare"}
    assert term_counts(df.limit(0), ["tone"]).count() == 0


def test_common(spark):
    df = spark.createDataFrame([(i, {"g": "a" if i % 2 else f"b{i % 10}"}) for i in range(40)], "record_id bigint, prompt map<string,string>")
    marks = {r["term"]: r["mark"] for r in term_counts(df, ["g"]).collect()}
    assert marks == {"a": "common", "b0": None, "b2": None, "b4": None, "b6": None, "b8": None}


def test_candidates_are_few_and_hold_every_pair_over_the_threshold(spark):
    import itertools
    import math
    import random

    rng = random.Random(6)
    parts = "mel an cho lic ten der bit sar don ic whim si cal gri tty sol emn bra zen flu ent ram blin g".split()
    names = sorted({"".join(rng.choices(parts, k=rng.randint(2, 4))) for _ in range(60)})
    typed = sorted({n[:k] + rng.choice("aeix") + n[k + 1 :] for n in names for k in (rng.randrange(len(n)),)} | {f"box {i}" for i in range(20)})
    entries = spark.createDataFrame([("f", i, n) for i, n in enumerate(names)], "field string, tag_id bigint, name string")
    values = spark.createDataFrame([("f", v) for v in typed], "field string, value string")

    def vectors(df, who):
        return {k: dict((r["g"], r["n"]) for r in rs) for k, rs in itertools.groupby(sorted(df.select(who, canonical.grams(F.col(who)).alias("gs")).select(who, F.explode("gs").alias("g")).groupBy(who, "g").agg(F.count("*").alias("n")).collect(), key=lambda r: r[who]), key=lambda r: r[who])}

    own, known = vectors(values, "value"), vectors(entries, "name")
    df = Counter(g for v in known.values() for g in v)

    def weighed(v):
        x = {g: n * (0.8 if g[0] == "=" else 1.0) * (1 + math.log(len(names) / max(df[g], 1))) for g, n in v.items()}
        size = math.sqrt(sum(y * y for y in x.values()))
        return {g: y / size for g, y in x.items()}

    own, known = {k: weighed(v) for k, v in own.items()}, {k: weighed(v) for k, v in known.items()}
    cosine = {(v, n): sum(y * known[n].get(g, 0.0) for g, y in own[v].items()) for v in own for n in known}
    counts = entries.select("field", "tag_id", "name", F.explode(canonical.grams(F.col("name"))).alias("g")).groupBy("field", "tag_id", "name", "g").agg(F.count("*").alias("n"))
    totals, weights = entries.groupBy("field").agg(F.count("*").alias("total")), counts.groupBy("field", "g").agg(F.count("*").alias("df"))
    index = canonical._vectors(counts, weights, totals, ["tag_id", "name"])
    mine = values.select("field", "value", F.explode(canonical.grams(F.col("value"))).alias("g")).groupBy("field", "value", "g").agg(F.count("*").alias("n"))
    pairs = {(r["value"], r["name"]) for r in canonical.candidates(canonical._vectors(mine, weights, totals, ["value"]), index).collect()}
    over = {p for p, c in cosine.items() if c >= canonical.THRESHOLD + 1e-9}
    assert over <= pairs and len(over) > 30 and len(pairs) < 0.2 * len(cosine)
    best = {v: max((c for (w, _), c in cosine.items() if w == v)) for v in own}
    got = {r["value"]: r["score"] for r in canonical.match_values(values, entries).collect()}
    assert all(got[v] == pytest.approx(b) for v, b in best.items() if b >= canonical.THRESHOLD + 1e-9)


def test_qualifiers_are_learnt(spark):
    vocab = spark.createDataFrame([(i, "tone", t, None) for i, t in enumerate(["tense", "solemn", "whimsical", "brazen"], 1)], "tag_id bigint, field string, tag string, also_called string")
    typed = ["zonkly tense", "zonkly solemn", "zonkly whimsical throughoutly", "tense throughoutly", "brazen throughoutly", "zonkly brazne throughoutly", "zonkly", "zonkly throughoutly"]
    df = spark.createDataFrame([(i, {"tone": v}) for i, v in enumerate(typed)], "record_id bigint, prompt map<string,string>")
    assert {typed[r["record_id"]]: r["tag_id"] for r in map_to_canonical(df, vocab, ["tone"]).collect()} == dict(zip(typed, [1, 2, 3, 1, 4, 4, 0, 0], strict=True))
