import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plotmill.operators.multivalue import Coder, parse_field, split_packed, word_bins

NAMES = ["Calaster", "Anselume", "Wilora", "Briume Lunthagast", "Oris", "Maran", "Elic Pell"]


@pytest.fixture(scope="module")
def coder(spark):
    plain = spark.createDataFrame([(n,) for n in NAMES * 50], "v string")
    return Coder(word_bins(plain, "v"))


@pytest.mark.parametrize(
    ("raw", "values"),
    [
        ("Calaster, Anselume", ["Calaster", "Anselume"]),
        ("Wilora and Briume Lunthagast", ["Wilora", "Briume Lunthagast"]),
        ("Oris,, Maran,", ["Oris", "Maran"]),
        ("Oris / Maran; Wilora", ["Oris", "Maran", "Wilora"]),
        ("• Oris\n• Maran", ["Oris", "Maran"]),
        ("1) Oris 2) Maran", ["Oris", "Maran"]),
        ("- Oris\n- Maran", ["Oris", "Maran"]),
        ('["Oris", "Elic \\"Bo\\" Pell"]', ["Oris", 'Elic "Bo" Pell']),
        ('"Oris, Jr."; Maran', ["Oris, Jr.", "Maran"]),
        ('"Oris and Daughters", Maran, and Wilora', ["Oris and Daughters", "Maran", "Wilora"]),
        ('"Elic ""Red"""; "Oris"', ['Elic "Red"', "Oris"]),
        ('Elic "Two Coats" Pell & Oris', ['Elic "Two Coats" Pell', "Oris"]),
        ("Oris (the younger, a pilot), Maran (twin)", ["Oris (the younger, a pilot)", "Maran (twin)"]),
        ("Oris, Oris", ["Oris", "Oris"]),
        ("O'Oris\tMaran", ["O'Oris", "Maran"]),
        ("Maran", ["Maran"]),
        ("N/A", []),
        ("", []),
        ("   ", []),
        (None, []),
    ],
)
def test_parse_field(coder, raw, values):
    assert parse_field(raw, coder) == values


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(NAMES), min_size=1, max_size=6), st.sampled_from([", ", ",", "; ", " / ", "|", "\n", "\t", " & ", " and "]))
def test_round_trip(names, mark):
    coder = Coder({})
    coder.word = lambda w: 5.0 if w in " ".join(NAMES).split() else 60.0
    assert parse_field(mark.join(names), coder) == names


def test_every_subset_of_many_kinds():
    values = ["Oris", "Maran", "AC/DC", "R&B", "P|Q", "Wilora", "Elic\tPell"]
    coder = Coder({})
    coder.word = lambda w: 5.0 if w in values else 60.0
    assert parse_field("Oris, Maran; AC/DC, R&B; P|Q, Wilora\nElic\tPell", coder) == values


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_never_fails(raw):
    assert all(v and v == v.strip() for v in parse_field(raw, Coder({})))


def test_split_packed_edges(spark):
    rows = [(1, {"a": "Oris, Maran"}, "x"), (1, {"a": "Oris, Maran"}, "x"), (2, None, "y"), (3, {"a": None}, None), (4, {}, "z"), (None, {"a": "Oris; " * 3000 + "Maran"}, "")]
    df = spark.createDataFrame(rows, "record_id bigint, prompt map<string,string>, item string")
    got = split_packed(df, ["a", "b"]).collect()
    assert sorted((r["record_id"], r["pos"], r["item"]) for r in got if r["record_id"] == 1) == [(1, 1, "Oris"), (1, 1, "Oris"), (1, 2, "Maran"), (1, 2, "Maran")]
    assert max(r["pos"] for r in got if r["record_id"] is None) == 3001
    assert {r["record_id"] for r in got} == {1, None}
    assert split_packed(df.limit(0), ["a"]).count() == 0
