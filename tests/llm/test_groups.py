import random

import pytest

from plotmill.llm.groups import closest_subset, components, grouped_splits, named_persons


def test_closest_subset_against_trying_all():
    rng = random.Random(5)
    for _ in range(60):
        items = [rng.randint(1, 12) for _ in range(rng.randint(1, 9))]
        target = rng.uniform(0, sum(items))
        sizes = {s: items.count(s) for s in items}
        taken = closest_subset(sizes, target, sum(items))
        assert all(n <= sizes[s] for s, n in taken.items())
        sums = {0}
        for x in items:
            sums |= {s + x for s in sums}
        want = round(target)
        assert abs(sum(s * n for s, n in taken.items()) - want) == min(abs(s - want) for s in sums)


def test_components_against_union_find(spark):
    rng = random.Random(6)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(90)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7)]
    parent = {n: n for e in edges for n in e} | {999: 999}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    nodes = spark.createDataFrame([(n,) for n in parent], "node bigint")
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), nodes).collect()}
    assert got == {n: find(n) for n in parent}


AUTHORS = [(1, "Ann Øster"), (2, "Bo Müller"), (3, "Cy Stone"), (4, None), (5, "Di Park")]


@pytest.fixture(scope="module")
def authors(spark):
    return spark.createDataFrame(AUTHORS, "author_id bigint, name string")


def test_names_in_any_form(spark, authors):
    forms = {1: "ANN OSTER", 2: "Müller, Bo / Oster, A.", 3: "by Dr. C. Stone (ed.)", 4: "N/A", 5: None, 6: "", 7: "various", 8: "Parks"}
    df = spark.createDataFrame([(i, {"author": a}, "x") for i, a in forms.items()], "record_id bigint, prompt map<string,string>, w string")
    assert {r["record_id"]: r["ids"] for r in named_persons(df, authors).collect()} == {1: [1], 2: [1, 2], 3: [3]}


def test_splits(spark, authors):
    rows = [(i, {"author": "Ann Oster"}) for i in range(8)] + [(100, {"author": "A. Oster & B. Muller"}), (200, {"author": "Stone"}), (300, {"author": "D. Park"}), (400, None), (None, {"author": "Stone"})]
    df = spark.createDataFrame(rows, "record_id bigint, prompt map<string,string>")
    got = {r["record_id"]: (r["group_id"], r["split"]) for r in grouped_splits(df, authors).collect()}
    assert {k: v[0] for k, v in got.items()} == {**{i: 1 for i in range(8)}, 100: 1, 200: 3, 300: 5}
    assert len({v[1] for k, v in got.items() if v[0] == 1}) == 1
    assert sorted([got[0][1], got[200][1], got[300][1]]) == ["test", "train", "validation"] and got[0][1] == "train"
    assert grouped_splits(df.limit(0), authors).count() == 0


def test_a_group_with_most_records_and_many_of_one_size(spark):
    people = spark.range(1, 602).selectExpr("id AS author_id", "concat('X Name', id) AS name")
    rows = spark.range(1000).selectExpr("id AS record_id", "map('author', IF(id < 400, 'Name1', concat('Name', id - 398))) AS prompt")
    got = grouped_splits(rows, people).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"train": 800, "validation": 100, "test": 100}
