import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plotmill.llm.splitting import RangeMaximum, coarsest, cut, split_oversized, sufficient


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.data())
def test_range_maximum_is_rightmost(values, data):
    lo = data.draw(st.integers(0, len(values) - 1))
    hi = data.draw(st.integers(lo + 1, len(values)))
    most = max(values[lo:hi])
    assert RangeMaximum(values, len(values)).of(lo, hi) == max(k for k in range(lo, hi) if values[k] == most)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab .\n!\"é", max_size=300), st.integers(5, 60), st.data())
def test_pieces(text, limit, data):
    overlap = data.draw(st.integers(0, limit - 1))
    pieces = cut(text, limit, overlap)
    assert bool(pieces) == bool(text.strip())
    end = 0
    for k, (s, e, _, over) in enumerate(pieces):
        assert 0 < e - s <= limit and over <= overlap
        assert not text[end:s].strip() if s > end else s >= end - overlap
        if k:
            assert e > end
        end = e
    assert not text[end:].strip()


def test_very_long_text():
    text = "word " * 1_000_000
    pieces = cut(text)
    assert pieces[-1][1] == len(text) - 1 and all(e - s <= 2400 for s, e, *_ in pieces)


def test_prefers_strong_boundaries_and_the_rightmost():
    def pieces(text, limit):
        return [text[s:e] for s, e, *_ in cut(text, limit, 0)]

    assert pieces("One two three four.\nFour five six. Seven eight nine ten.", 36) == ["One two three four.", "Four five six. Seven eight nine ten."]
    assert pieces("aaaa bbbb cccc", 9) == ["aaaa bbbb", "cccc"]
    assert pieces("x" * 25, 10) == ["x" * 10, "x" * 10, "x" * 5]


def _plain_cut(text, limit, overlap):
    """Pieces by looking at every place of every window."""
    sound = text.strip()
    first = text.index(sound) if sound else 0
    stop = first + len(sound)
    gaps = [m.span() for m in re.finditer(r"\s+", text) if 0 < m.start() < len(text)]
    strength = {a: 3 if re.search(r"[\r\n]", text[a:b]) else 2 if re.search(r"[.!?…][\"'”’»)\]]*$", text[:a]) else 1 for a, b in gaps}
    after = dict(gaps)
    out, start, done = [], first, 0
    while sound:
        if stop - start <= limit:
            return [*out, (start, stop)]
        window = [e for e in strength if max(done, start) < e <= start + limit]
        end = max(window, key=lambda e: (strength[e], e)) if window else start + limit
        out.append((start, end))
        done = end
        back = max(end - overlap, start + 1)
        near = [s for s in after.values() if back <= s < end]
        start = after.get(end, end) if not overlap else min(near) if near else after.get(end, back)
    return out


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="aab .\n!\"é", max_size=200), st.integers(5, 40), st.data())
def test_pieces_against_looking_everywhere(text, limit, data):
    overlap = data.draw(st.integers(0, limit - 1))
    assert [(s, e) for s, e, *_ in cut(text, limit, overlap)] == _plain_cut(text, limit, overlap)


def test_an_early_strong_boundary_beats_a_late_weak_one():
    text = "a" * 900 + ".\n" + "b" * 1490 + " " + "c" * 900
    assert cut(text, 2400, 0)[0][1:3] == (901, 3)


def _boundary(t, n):
    lines = re.split(r"[\r\n]+", t)
    if all(len(x) <= n for x in lines):
        return 3
    if all(len(x) <= n for line in lines for x in re.split(r"(?<=[.!?…])[\"'”’»)\]]*\s+", line)):
        return 2
    return 1 if all(len(x) <= n for x in t.split()) else 0


def test_coarsest_against_splitting():
    rng = random.Random(4)
    for _ in range(400):
        t = "".join(rng.choice(["aa", "bbbb", " ", ". ", "! ", "\n", "…\n", "cccccccccc"]) for _ in range(40)).strip()
        t = re.sub(r"[ \n]*\n[ \n]*", "\n", re.sub(" +", " ", t))
        assert coarsest(t, 20) == _boundary(t, 20), t


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="aab .\n!\"é", max_size=200), st.integers(1, 40))
def test_level_by_range_maxima_is_that_of_the_scan(text, limit):
    assert sufficient(text, limit) == coarsest(text, limit)


def test_the_table_takes_its_level_from_the_range_maxima():
    assert any("sufficient" in getattr(c, "co_names", ()) and "coarsest" not in c.co_names for c in split_oversized.__code__.co_consts)
    assert sufficient("One two.\nThree four.", 12) == 3 and sufficient("One two. Three four.", 12) == 2 and sufficient("one two three", 5) == 1 and sufficient("abcdef", 5) == 0


def test_table(spark):
    rows = [(1, "word " * 1000, "k"), (1, "word " * 1000, "k"), (2, None, ""), (3, "", None), (4, "  \n", "z"), (5, "short", "a"), (None, "y" * 50_000, "b")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, piece string")
    got = split_oversized(df).collect()
    assert {r["doc_id"] for r in got} == {1, 5, None}
    assert all(len(r["text"]) <= 2400 for r in got)
    assert {r["boundary"] for r in got if r["doc_id"] == 1} == {"word"} and {r["boundary"] for r in got if r["doc_id"] == 5} == {None}
    assert {r["boundary"] for r in got if r["doc_id"] is None} == {"character"}
    assert split_oversized(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="overlap"):
        cut("abc", 10, 10)
