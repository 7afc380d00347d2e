import random

import pytest

from plotmill.llm import residue
from plotmill.llm.residue import Localiser, Models, _codes, _grams, _slices, fit, mark_residue, without_residue


THINGS = "lantern kettle letter compass bridge violin hatch meadow barrel window quarry candle anchor ladder ribbon".split()


def _tale(rng, n=8):
    return " ".join(
        rng.choice(["The tired warden carried a {} beside the harbour.", "Nobody in the orchard remembered the {}.", '"Leave the {}," said Oryne slowly.', "Was it pride, or had the gardener hidden the {}?"]).format(rng.choice(THINGS))
        for _ in range(n)
    )


SHOTS = ">Story: The warden slept.\n>Language: English\n>Tone: wry\n>Prompt: Write a scene"


@pytest.fixture(scope="module")
def localiser():
    rng = random.Random(1)
    return Localiser(fit([*(_tale(rng) for _ in range(60)), SHOTS, SHOTS + "\n" + _tale(rng)]))


STORY = "The tired warden carried a lantern beside the harbour."


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        (STORY * 5, None),
        (None, None),
        ("", None),
        (" \n", None),
        ("Lorem ipsum dolor sit amet, consectetur adipiscing elit. Nulla minim officia.", "filler"),
        (STORY + "\nQuis nostrud ullamco laboris. Duis aute irure dolor velit esse cillum.", "filler"),
        ("Content coming soon. Content coming soon.", "filler"),
        ("404 Not Found\nThe requested page was not found on this server.", "error_page"),
        ("Home | Library | Search\nFehler 500: interner Fehler\nBitte versuchen Sie es später erneut.", "error_page"),
        (STORY + " 502 Bad Gateway. Please try again later.", "error_page"),
        ("Please enable JavaScript to continue reading.", "script_notice"),
        ("Skip to content\nThis site does not work without scripts.", "script_notice"),
        ("Dear {{name}}, " + STORY * 3, "placeholder"),
        (STORY + " [INSERT CITY] " + STORY, "placeholder"),
        (STORY + " ${hero} " + STORY, "placeholder"),
        ("TODO: describe the villain\n" + STORY * 4, "placeholder"),
        (">Story: {story}\n>Language: English", "placeholder"),
        (STORY + " On the wall someone had scratched {hinge} inside two curly brackets. " + STORY, None),
        ("[INT. HARBOUR - DAY]\nORYNE [laughs]\n" + STORY * 3, None),
        (STORY * 2 + ' "Insert your name here," said Oryne. ' + STORY, None),
        (STORY * 3 + " The sign over room 404 said the page was not found. " + STORY * 3, None),
    ],
)
def test_judge(localiser, text, kind):
    assert localiser.judge(text)[0] == kind


def test_held_out_accuracy(localiser):
    rng = random.Random(2)
    sound = [_tale(rng, rng.randint(2, 12)) for _ in range(200)]
    assert sum(localiser.judge(t)[0] is None for t in sound) == 200
    lorem = "tempor aliqua veniam nostrud commodo pariatur occaecat mollit fugiat laborum".split()
    dummy = [" ".join(rng.choices(lorem, k=rng.randint(6, 40))) + "." for _ in range(100)]
    assert sum(localiser.judge(t)[0] == "filler" for t in dummy) >= 98


# wordings that no list of the library holds
UNSEEN = {
    "filler": ["{} copy pending for the {} desk", "final {} wording will replace these lines", "qwerty qwerty uiop {} qwerty", "mock {} paragraph used while the {} is drafted", "interim wording, swap out ahead of the {} proof"],
    "error_page": ["fault {}: backend node {} returned nothing", "our {} machine hit a snag, code {}", "gateway {} refused the link to shard {}", "the {} you followed leads nowhere (code {})", "request {} aborted, node {} is offline"],
    "script_notice": ["browser scripting has been deactivated; the {} needs javascript", "kindly permit js so that the {} viewer opens", "our {} viewer runs on javascript, which you have blocked", "turn client scripting back on for the {}", "javascript seems to be off, so the {} stays hidden"],
}
THING = "ledger portal almanac atlas digest folio gazette".split()


def _unseen(rng, kind):
    def one():
        return rng.choice(UNSEEN[kind]).format(*(str(rng.randint(100, 999)) if kind == "error_page" else rng.choice(THING) for _ in range(2))).capitalize() + "."

    known = {"filler": "Lorem ipsum dolor sit amet.", "error_page": "Please try again later.", "script_notice": "Please enable JavaScript."}[kind]
    parts = [one() for _ in range(rng.randint(1, 3))] + ([known] if rng.random() < 0.5 else [])
    rng.shuffle(parts)
    return " ".join(parts)


def test_unseen_wordings_are_learnt_from_a_corpus_without_answers():
    rng = random.Random(5)
    lists = " ".join(residue.SEEDS.values())
    assert not any(part.strip() in lists for ws in UNSEEN.values() for w in ws for part in w.split("{}") if len(part.strip()) > 12)
    corpus = sorted({*(_tale(rng, rng.randint(6, 14)) for _ in range(900)), *(_unseen(rng, k) for k in UNSEEN for _ in range(25))})
    rng.shuffle(corpus)
    own = Localiser(fit(corpus))
    held = [(_unseen(rng, k), k) for k in UNSEEN for _ in range(80)] + [(_tale(rng, rng.randint(2, 14)), None) for _ in range(400)]
    got = own.judge_all([t for t, _ in held])
    flagged = sum(k is not None for k, _ in got)
    found = sum(k is not None and want is not None for (k, _), (_, want) in zip(got, held, strict=True))
    right = sum(k == want for (k, _), (_, want) in zip(got, held, strict=True) if want)
    print("precision", found / flagged, "recall", found / 240, "kind", right / 240)
    assert found / flagged >= 0.9 and found / 240 >= 0.9 and right / 240 >= 0.75


@pytest.mark.parametrize("text", ["left blank.", "a b  cd\ni", STORY.lower(), "x", "Ünïcode – “quoted” 1234 漢字 😀"])
def test_words_are_scored_across_their_blanks(localiser, text):
    lead = localiser.lead[0].astype(int)
    codes = [0] * 3 + _codes(text).tolist()
    plain = [((codes[i - 3] * residue._SIZE + codes[i - 2]) * residue._SIZE + codes[i - 1]) * residue._SIZE + codes[i] for i in range(3, len(codes))]
    assert _grams(_codes(text)).tolist() == plain
    best = run = 0
    for g in plain[1:]:
        run = max(0, run + lead[g])
        best = max(best, run)
    scored = residue._windows(localiser.lead[:1], ["", text, text * 2])
    assert scored[1, 0] == best / 8 and scored[0, 0] == 0
    assert residue._windows(localiser.lead[:1], [text])[0, 0] == best / 8


def test_a_window_spans_the_parts_a_long_text_is_scored_in(localiser, monkeypatch):
    text = STORY * 3 + " error 404: page not found. " + STORY * 3
    whole = localiser.windows([text])
    monkeypatch.setattr(residue, "SCAN", 37)
    assert (localiser.windows([text]) == whole).all()


def test_sentences_over_and_over_are_dummy_text(localiser):
    line = "The harbour kept every ribbon the gardener lost."
    assert localiser.judge(" ".join([line] * 4))[0] == "filler"
    assert localiser.judge(" ".join([line] * 900))[0] == "filler"
    assert localiser.judge(" ".join([line] * 4) + " " + STORY)[0] == "filler"
    refrain = "\n".join(f"{line}\nNobody in the orchard remembered the {t}.\nThe tired warden hid the {t} twice." for t in THINGS[:4])
    assert localiser.judge(refrain)[0] is None


def test_slots_of_any_length(localiser):
    inside = "insert " + "a long description of the house by the sea " * 3
    assert localiser.judge(f"{STORY} [{inside}] {STORY}")[0] == "placeholder"
    assert localiser.judge(STORY + " {{" + "very_long_slot_name_" * 4 + "}} " + STORY)[0] == "placeholder"


def test_models_are_small_to_send(localiser):
    models = Models(fit([STORY]))
    assert sum(n.nbytes + at.nbytes for at, n in models.counts.values()) < 1 << 20
    assert models.localiser.judge("Lorem ipsum dolor sit amet, consectetur adipiscing elit.")[0] == "filler"
    assert Localiser(fit([])).judge("Lorem ipsum dolor sit amet, consectetur adipiscing elit.")[0] == "filler"


def test_slices_keep_words_whole():
    text = " ".join(["word"] * 5000) + "x" * 9000
    assert "".join(_slices(text)) == text and all(p[0] == " " for p in list(_slices(text))[1:])


def test_a_hot_text_does_not_fill_the_sample(spark, monkeypatch):
    rng = random.Random(4)
    tales = sorted({_tale(rng, 10) for _ in range(60)})
    hashes = dict(spark.createDataFrame([(t,) for t in tales], "text string").selectExpr("text", "xxhash64(text)").collect())
    hot = min(tales, key=hashes.get)
    monkeypatch.setattr(residue, "SAMPLE", 20)
    df = spark.createDataFrame([(t,) for t in [*tales, *[hot] * 400]], "text string")
    assert residue._sample(df, "text") == sorted(tales, key=hashes.get)[:20]


def test_table(spark):
    rng = random.Random(3)
    rows = [(i, _tale(rng), 0.5) for i in range(30)] + [(30, None, 1.0), (31, "", None), (32, "Error 503: service unavailable. Please try again later.", 0.0), (32, "Error 503: service unavailable. Please try again later.", 0.0), (None, STORY * 2000, 0.1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, coverage double")
    got = mark_residue(df).collect()
    assert len(got) == len(rows) and [r["doc_id"] for r in got if r["residue"]] == [32, 32]
    kept = without_residue(df)
    assert kept.columns == df.columns and kept.count() == len(rows) - 2
    assert mark_residue(df.limit(0)).count() == 0 and without_residue(df.limit(0)).count() == 0


def test_models_are_fitted_on_all_texts_of_a_table(spark, monkeypatch):
    rng = random.Random(6)
    texts = sorted({*(_tale(rng, rng.randint(6, 14)) for _ in range(120)), *(_unseen(rng, k) for k in UNSEEN for _ in range(12)), "Dear {{name}}, " + STORY, " ".join(_tale(rng, 9) for _ in range(30))})
    rng.shuffle(texts)
    assert max(map(len, texts)) > residue.SAMPLE_LENGTH
    whole = Models(fit(texts)).counts
    monkeypatch.setattr(residue, "SAMPLE", 15)
    df = spark.createDataFrame([(t,) for t in [*texts, *texts[:40], None, "", " "]], "body string").repartition(5)
    got = residue._ship(df, "body").value.counts
    assert got.keys() == whole.keys()
    for kind, (at, n) in whole.items():
        assert got[kind][0].tolist() == at.tolist() and got[kind][1].tolist() == n.tolist()


def test_sentences_learnt_as_residue_do_not_teach_prose(spark):
    # sentences that come back in short texts beside known residue, and texts made of them alone
    rng = random.Random(7)
    notes = ["Our ledger machine hit a snag, code 512.", "Gateway refused the link to shard 77.", "Fault 310: backend node 4 returned nothing."]
    texts = [_tale(rng, 10) for _ in range(80)] + [f"404 Not Found. {a} {b} Please try again later." for a in notes for b in notes if a != b] + [f"{a} {b}" for a in notes for b in notes if a != b]
    texts = sorted(set(texts))
    want = Models(fit(texts)).counts
    got = Models(residue.fit_table(spark.createDataFrame([(t,) for t in texts], "text string"))).counts
    assert all(got[k][0].tolist() == at.tolist() and got[k][1].tolist() == n.tolist() for k, (at, n) in want.items())


def test_tallies_are_the_same_in_parts(monkeypatch):
    texts = [STORY, "x", STORY * 3, "{{name}}"]
    whole = residue._count(texts)
    monkeypatch.setattr(residue, "SCAN", 20)
    tally = residue.Tally()
    for t in texts:
        tally.add("prose", t)
    (part,) = tally.batches()
    assert (residue._dense(part.column(1).to_numpy(), part.column(2).to_numpy()) == whole).all()


def test_long_texts_not_judged_residue_tell_stories(localiser):
    text = (STORY + " ") * 3 + "The sign over room 404 said the page was not found. " + (STORY + " ") * 2 + "Nobody in the orchard remembered the kettle."
    assert localiser.windows([text])[0, 0] >= residue.WINDOW_BITS / 2 and localiser.judge(text)[0] is None
    assert list(residue._lessons(localiser, [text], 100)) == []  # teaches what it holds, nothing is set aside
    assert {use for use, _, _ in residue._lessons(localiser, [text], 1000)} == {"aside", "left", "open"}
