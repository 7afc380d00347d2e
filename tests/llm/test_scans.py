import random

import pytest

from plotmill.llm.scans import Editor, Lexicon, apply, count_words, damage, edits_at, furniture, operations, repair_scans, restore, smudge, train, unwrap

WORDS = "the harbour was quiet and morning lantern shovel captain gardener counting house every window tired brittle between orchard letter stood beside against nobody remembered".split()


@pytest.fixture(scope="module")
def editor():
    counts = {w: 4000 for w in WORDS} | {"half-asleep": 300, "half": 2000, "asleep": 2000, "ostreskin": 3}
    return train(Lexicon(counts, sum(counts.values())))


def test_damage_is_undone_by_its_edits():
    rng = random.Random(1)
    for w in WORDS * 20:
        noisy, undo = damage(w, rng)
        assert apply(noisy, undo) == w and all(e in edits_at(noisy) for e in undo)


def test_operations():
    assert operations((2, "cl", "d")) == [(2, "replace", "cd"), (3, "delete", "l")]
    assert operations((0, "m", "rn")) == [(0, "replace", "mr"), (1, "insert", "n")]


def test_held_out_accuracy(editor):
    rng = random.Random(7)
    right = total = 0
    for w in WORDS * 10:
        noisy, undo = damage(w, rng)
        if undo and noisy not in WORDS:
            total += 1
            right += editor.repair(noisy) == w
    assert right / total > 0.9
    assert not [w for w in [*WORDS, "ostreskin", "zelume", "2nd", "14th"] if editor.repair(w)]


def test_lines_joined_and_compounds_kept(editor):
    assert editor.joins("lan", "tern", "-") and editor.joins("gar", "dener", "¬")
    assert not editor.joins("half", "asleep", "-")


PAGE = "The harbour was quiet and the gar-\n\n12    THE TIRED LANTERN\n\ndener remembered every window. The captain\n— 13 —\nstood beside the 0rchard.\n\nChapter Seven\n\nNobody remembered."


def test_restore(editor):
    got = restore(PAGE, "tired-lantern-0000001", editor)
    assert got.noise == ["header", "hyphen", "misread", "page_no"]
    assert "gardener remembered every window. The captain stood beside the orchard." in got.text
    assert "Chapter Seven" in got.text and "THE TIRED LANTERN" not in got.text and "13" not in got.text


@pytest.mark.parametrize("text", ["", " ", "\n\n\n", "x", "The captain stood.\n\n* * *\n\nNobody remembered.", "NO ENTRY\n", "room 9."])
def test_sound_texts(editor, text):
    assert restore(text, "", editor, rewrite=False).noise == []


def test_signs_and_wrapped_numbers_are_no_furniture(editor):
    text = "The captain stood in room\n320. Nobody\nremembered the window.\n\nNO ENTRY AFTER DARK\n\nThe gardener stood in room\n12.\nEvery window was quiet."
    assert furniture(text.split("\n"), "quiet-harbour", editor.lexicon) == {}


def test_unwrap_leaves_paragraph_lines():
    flat = "A long paragraph of its own that goes on and on, well past any page width, and then a little more of that, until it ends here, at last, for good.\nAnother one."
    assert unwrap(flat) == flat


def test_table(spark):
    rows = [(1, PAGE, "tired lantern"), (1, PAGE, "tired lantern"), (2, None, None), (3, "", None), (4, " ".join(WORDS * 3000), None)]
    rows += [(10 + i, " ".join(WORDS * 20) + ".", None) for i in range(5)]
    df = spark.createDataFrame(rows, "record_id bigint, body string, text string")
    got = repair_scans(df, "record_id", "body", ["text"]).collect()
    assert sorted(r["record_id"] for r in got) == [1, 1, 3, 4, 10, 11, 12, 13, 14]
    assert {tuple(r["noise"]) for r in got if r["record_id"] == 1} == {("header", "hyphen", "misread", "page_no")}
    assert all(not r["noise"] for r in got if r["record_id"] != 1)
    assert repair_scans(df.limit(0), "record_id", "body").count() == 0
    lexicon = count_words(df, "body")
    assert lexicon.counts["harbour"] > 3000 and isinstance(Editor(lexicon).repair("harbour"), type(None))


@pytest.mark.parametrize(("word", "fixed"), [("orchqrd", "orchard"), ("lantrn", "lantern"), ("captaiin", "captain"), ("gardxner", "gardener"), ("0rch4rd", "orchard"), ("rcmcmbcrcd", "remembered"), ("ostreskin", None), ("zelume", None)])
def test_errors_no_table_holds(editor, word, fixed):
    assert editor.repair(word) == fixed


def test_held_out_noise_of_another_kind(editor):
    rng = random.Random(9)
    right = wrong = total = 0
    for w in [w for w in WORDS if len(w) > 5] * 20:
        noisy, undo = smudge(w, rng)
        if undo and noisy not in WORDS:
            total += 1
            got = editor.repair(noisy)
            right += got == w
            wrong += got not in (None, w)
    print("recall", right / total, "precision", right / (right + wrong))
    assert right / total >= 0.9 and right / (right + wrong) >= 0.9


def test_any_number_of_misreadings_in_words_of_any_length():
    long = "counterrevolutionaryreconsiderations"
    counts = {w: 4000 for w in WORDS} | {long: 4000}
    own = train(Lexicon(counts, sum(counts.values())))
    assert own.repair(long.replace("o", "0").replace("e", "c")) == long
    assert own.repair("x" * 200_000) is None


def test_the_last_word_is_read_unless_it_may_be_broken_off(editor):
    assert restore("Nobody remembered the 0rchard", "", editor).text.endswith("orchard")
    assert restore("Nobody remembered the orch", "", editor).noise == []
    assert restore("Nobody remembered the lan", "", editor).noise == []


def test_running_heads_of_any_length(editor):
    head = "THE TIRED LANTERN AND EVERY WINDOW OF THE QUIET HARBOUR THAT NOBODY AT ALL REMEMBERED BEFORE THE MORNING"
    page = f"The captain stood beside the\n\n{head}\n\norchard and the gardener remembered every window.\n\nNobody remembered."
    assert restore(page, "", editor).noise == ["header"]
