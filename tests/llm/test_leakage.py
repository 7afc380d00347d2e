import random
import re

from plotmill.llm.leakage import _shingled, _worded, leaked_passages


def _plain(docs, items, n=12):
    def words(t):
        return re.findall(r"[^\W_]+", (t or "").lower())

    out = {}
    for d, t in docs:
        w = words(t)
        for i, s in items:
            v = words(s)
            runs = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)}
            if any(tuple(w[k : k + n]) in runs for k in range(len(w) - n + 1)):
                out[(d, i)] = True
    return set(out)


def test_against_comparing_all(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(12)]  # few words, so shingles repeat a lot
    items = [(i, " ".join(rng.choices(words, k=30))) for i in range(6)] + [(6, "one two three"), (7, None)]
    docs = []
    for d in range(60):
        body = rng.choices(words, k=rng.randint(0, 40))
        if d % 3 == 0:
            src = items[d % 6][1].split()
            k, n = rng.randint(0, 18), rng.randint(10, 14)
            body[5:5] = [x.upper() + rng.choice(["", ",", " --", "."]) for x in src[k : k + n]]
        docs.append((d, " ".join(body)))
    docs += [(100, None), (101, ""), (0, docs[0][1]), (None, items[0][1])]
    a = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id bigint, text string, h string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leaked_passages(a, b).collect()}
    want = _plain([d for d in docs if d[0] is not None], items)
    assert got == want and len(want) > 5
    assert leaked_passages(a.limit(0), b).count() == 0 and leaked_passages(a, b.limit(0)).count() == 0


def test_longest_run(spark):
    text = " ".join(f"a{i}" for i in range(40))
    docs = spark.createDataFrame([(1, "x " + text + " y"), (2, " ".join(text.split()[3:18]))], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["runs"], r["longest"]) for r in leaked_passages(docs, spark.createDataFrame([(9, text)], "item_id bigint, text string")).collect()}
    assert got == {1: (1, 40), 2: (1, 15)}


def test_texts_of_one_item_key_and_one_document_key(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(20)) for x in "abc")
    items = spark.createDataFrame([(1, a), (1, b), (2, c)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "x " + b), (2, a + " " + b), (3, a[:20]), (3, c), (3, c), (4, " ".join(c.split()[:11]))], "doc_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): (r["runs"], r["longest"]) for r in leaked_passages(docs, items).collect()}
    assert got == {(1, 1): (1, 20), (2, 1): (2, 20), (3, 2): (1, 20)}


def test_over_200_000_item_shingles_and_no_words_beside_them(spark):
    rng = random.Random(3)
    items = [(i, " ".join(f"w{rng.randint(0, 40_000)}" for _ in range(110))) for i in range(2000)]
    docs = [(d, " ".join(f"w{rng.randint(0, 40_000)}" for _ in range(60)) + " " + " ".join(items[d * 7 % 2000][1].split()[30 : 30 + 10 + d % 5])) for d in range(100)]
    a, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leaked_passages(a, b).collect()}
    assert got == {(d, d * 7 % 2000) for d in range(100) if d % 5 >= 2}
    plan = _shingled(_worded(a, "doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    beside = re.findall(r"Generate posexplode\(.*\), \[([^\]]*)\], false, \[", plan)
    assert beside and not any("words" in columns for columns in beside)
