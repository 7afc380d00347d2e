"""Each job of the command line over a small tree of files."""

import json

import pytest

from plotmill import cli

TEXT = "Adam Stone walked out of the way now. " * 6


@pytest.fixture()
def tree(tmp_path):
    for story in ("s1", "s2", "s3"):
        (tmp_path / "in" / story).mkdir(parents=True)
        record = {"prompt": "p", "story": TEXT, "male characters": "Adam Stone", "tone": "wry", "zeta": "z"}
        (tmp_path / "in" / story / "1.json").write_text(json.dumps(record))
        (tmp_path / "in" / story / "2.txt").write_text("Plain text of a chunk.\nSecond line.")
    return tmp_path


def _json(folder):
    return [json.loads(x) for p in sorted(folder.rglob("*.json")) for x in p.read_text().splitlines()]


def test_count_phrases(spark, tree):
    cli.main(["count-phrases", str(tree / "in"), str(tree / "o")], spark)
    assert {(r["phrase"], r["count"], r["stories"]) for r in _json(tree / "o" / "story_phrases")} == {("walked out of", 18, 3), ("out of the", 18, 3), ("of the way", 18, 3)}
    assert (tree / "o" / "stories" / "story=s1").is_dir()


def test_randomize(spark, tree):
    cli.main(["randomize", str(tree / "in"), str(tree / "o")], spark)
    made = [json.loads(r["record"]) for r in _json(tree / "o")]
    assert len(made) == 3 and all("Adam" not in r["story"] and "Stone" not in r["male characters"] for r in made)
    assert list(made[0]) == ["prompt", "tone", "writing style", "pacing", "point of view", "moment-to-moment detail", "sensory detail", "male characters", "female characters", "context", "story", "zeta"]
    assert "Adam Stone" in json.loads((tree / "o_replaced_names.json").read_text())


def test_generate_and_resume(spark, tree):
    (tree / "t.txt").write_text(">Story: a\n>Prompt: b\n\n>Story: {story}\n>Context: {context}")
    (tree / "t.params.json").write_text(json.dumps({"remove_keys_from_prompt": [], "rename_keys": {"tone": "mood"}}))
    cli.main(["generate", str(tree / "in"), str(tree / "o"), "--template", str(tree / "t.txt")], spark)
    rows = _json(tree / "o")
    made = [json.loads(r["record"]) for r in rows]
    assert len(made) == 6 and all(r["prompt"] == "Write a scene" and r["mood"] == "neutral" for r in made) and {r["chunk"] for r in rows} == {"1.json", "2.json"}
    assert sum(r["zeta"] == "z" for r in made if "zeta" in r) == 3
    (tree / "done" / "s1").mkdir(parents=True)
    (tree / "done" / "s1" / "2.json").write_text("{}")
    cli.main(["generate", str(tree / "in"), str(tree / "o2"), "--template", str(tree / "t.txt"), "--done", str(tree / "done")], spark)
    assert len(_json(tree / "o2")) == 5


def _in_turn():
    class InTurn:  # within a function, so that workers need not import it
        """A junk answer first, then a usable one; never a usable one for texts with `hopeless`; a very long one for those with `endless`."""

        def __init__(self):
            self.sent = set()

        def complete(self, prompt, stop, temperature, most):
            if "endless" in prompt:
                return ">Prompt: " + "word " * 4000
            first = prompt not in self.sent
            self.sent.add(prompt)
            return ">Prompt: -" if first or "hopeless" in prompt else ">Prompt: Write"

    return InTurn


def test_generate_retries_and_keeps_rejects(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(cli.generation.BACK_ENDS, "stub", _in_turn())
    (tmp_path / "in" / "s").mkdir(parents=True)
    for name, text in (("1", "plain"), ("2", "hopeless"), ("3", "endless")):
        (tmp_path / "in" / "s" / f"{name}.txt").write_text(text)
    (tmp_path / "t.txt").write_text(">Story: {story}\n>Context: {context}")
    cli.main(["generate", str(tmp_path / "in"), str(tmp_path / "o"), "--template", str(tmp_path / "t.txt")], spark)
    assert [(r["chunk"], json.loads(r["record"])["prompt"]) for r in _json(tmp_path / "o")] == [("1.json", "Write")]
    rejects = {r["chunk"]: r for r in _json(tmp_path / "o_rejects")}
    assert [(c, r["reason"], r["attempts"], len(r["junk"])) for c, r in sorted(rejects.items())] == [("1.txt", None, 2, 1), ("2.txt", "junk", 3, 3), ("3.txt", "length", 1, 0)]


def test_generate_keeps_context_and_story_of_a_record(spark, tmp_path):
    (tmp_path / "in" / "s").mkdir(parents=True)
    (tmp_path / "in" / "s" / "1.json").write_text(json.dumps({"context": "Before.", "story": "Told.", "tone": "old"}))
    (tmp_path / "t.txt").write_text(">Story: {story}\n>Context: {context}")
    cli.main(["generate", str(tmp_path / "in"), str(tmp_path / "o"), "--template", str(tmp_path / "t.txt")], spark)
    record = json.loads(_json(tmp_path / "o")[0]["record"])
    assert (record["context"], record["story"], record["tone"]) == ("Before.", "Told.", "neutral")


def test_generate_keeps_over_long_chunks(spark, tmp_path):
    (tmp_path / "in" / "s").mkdir(parents=True)
    (tmp_path / "in" / "s" / "1.txt").write_text("short")
    (tmp_path / "in" / "s" / "2.txt").write_text("word " * 9000)
    (tmp_path / "t.txt").write_text(">Story: {story}")
    cli.main(["generate", str(tmp_path / "in"), str(tmp_path / "o"), "--template", str(tmp_path / "t.txt")], spark)
    assert [r["chunk"] for r in _json(tmp_path / "o")] == ["1.json"]
    assert [(r["chunk"], r["reason"], r["attempts"]) for r in _json(tmp_path / "o_rejects")] == [("2.txt", "window", 0)]


def test_inject_twice(spark, tree):
    args = ["inject", str(tree / "in"), str(tree / "o"), "--keys", "author", "genre", "--settings", str(tree / "settings.json")]
    with pytest.raises(SystemExit, match="fill in"):
        cli.main(args, spark)
    settings = json.loads((tree / "settings.json").read_text())
    assert set(settings) == {"s1", "s2", "s3"}
    settings["s1"]["author"] = "Ann"
    (tree / "settings.json").write_text(json.dumps(settings))
    cli.main(args, spark)
    assert sorted(json.loads(r["record"])["author"] for r in _json(tree / "o")) == ["", "", "Ann"]


def test_merge(spark, tree):
    for story in ("s1", "s2"):
        (tree / "ex" / story).mkdir(parents=True)
        (tree / "ex" / story / "1.json").write_text('{"tone": "new"}')
    args = ["merge", str(tree / "in"), str(tree / "o"), "--keys", "tone", "--extract", str(tree / "ex")]
    with pytest.raises(SystemExit, match="no partner"):
        cli.main(args, spark)
    (tree / "ex" / "s3").mkdir()
    (tree / "ex" / "s3" / "1.json").write_text('{"tone": null}')
    cli.main(args, spark)
    assert sorted(str(json.loads(r["record"])["tone"]) for r in _json(tree / "o")) == ["None", "new", "new"]


def test_examples_grid_stories_scripts(spark, tree):
    (tree / "e").mkdir()
    (tree / "e" / "x.txt").write_text("ask\n\n---\n\ntell")
    cli.main(["examples", str(tree / "e"), str(tree / "oe")], spark)
    assert json.loads(_json(tree / "oe")[0]["record"])["story"] == "tell"
    (tree / "t.txt").write_text("{a}")
    (tree / "t.replacements.json").write_text('{"a": ["1", "2"]}')
    cli.main(["test-template", str(tree / "og"), "--template", str(tree / "t.txt"), "--trials", "2"], spark)
    assert sorted(r["out_file"] for r in _json(tree / "og")) == ["a0__trial0.txt", "a0__trial1.txt", "a1__trial0.txt", "a1__trial1.txt"]
    cli.main(["stories", str(tree / "in"), str(tree / "os")], spark)
    assert spark.read.parquet(str(tree / "os")).count() == 6
    (tree / "ks").mkdir()
    (tree / "ks" / "a.ks").write_bytes(';◇◇◇：roof\n@nm t="Mia" s=1\n"Hi[np]"\n'.encode("utf-16"))
    cli.main(["chunk-scripts", str(tree / "ks"), str(tree / "ok"), "--max-tokens", "100"], spark)
    assert _json(tree / "ok")[0]["text"].endswith("MIA\nHi\n") and json.loads((tree / "ok_names.json").read_text()) == {"Mia": "Mia"}


def test_chunk_files_and_maps(spark, tree):
    (tree / "b").mkdir()
    (tree / "b" / "one.txt").write_text("The first line of all.\nThe second line.\n" + "Long " * 60 + "end.\n")
    cli.main(["chunk-books", str(tree / "b"), str(tree / "ob"), "--max-tokens", "30", "--files"], spark)
    made = [(tree / "ob" / "one" / f"chunk_{k}.txt").read_text() for k in range(1, 4)]
    assert made[0] == "The first line of all.\nThe second line." and " ".join(made).count("Long") <= 60
    (tree / "ks").mkdir()
    (tree / "ks" / "a.ks").write_bytes(';◇◇◇：roof\n@nm t="Mia" s=1\n"Hi *waves*[np]"\n'.encode("utf-16"))
    (tree / "l.json").write_text(json.dumps({";◇◇◇：roof": "ROOF", ";◇◇◇：yard": "YARD"}, ensure_ascii=False))
    (tree / "n.json").write_text('{"Ann": "ANNE"}')
    cli.main(["chunk-scripts", str(tree / "ks"), str(tree / "ok"), "--max-tokens", "100", "--files", "--locations", str(tree / "l.json"), "--names", str(tree / "n.json")], spark)
    assert (tree / "ok" / "roleplay" / "a" / "chunk_0.txt").read_text().startswith("ROOF\n")
    assert json.loads((tree / "ok_locations.json").read_text()) == {";◇◇◇：roof": "ROOF", ";◇◇◇：yard": "YARD"}
    assert json.loads((tree / "ok_names.json").read_text()) == {"Ann": "ANNE", "Mia": "Mia"}


def test_template_results_are_not_written_twice(spark, tree):
    (tree / "t.txt").write_text("{a}")
    (tree / "t.replacements.json").write_text('{"a": ["1"]}')
    args = ["test-template", str(tree / "og"), "--template", str(tree / "t.txt"), "--trials"]
    for trials in ("1", "3", "3"):
        cli.main([*args, trials], spark)
    assert sorted(r["out_file"] for r in _json(tree / "og")) == [f"a0__trial{k}.txt" for k in range(3)]


def test_finalize_takes_settings(spark, tmp_path):
    for k in range(30):
        (tmp_path / "r" / f"s{k}").mkdir(parents=True)
        record = {"prompt": "p", "story": TEXT, "tone": "wry", "pacing": "slow", "similar writers": "Ann Lee", "author": ""}
        (tmp_path / "r" / f"s{k}" / "1.json").write_text(json.dumps(record))
    (tmp_path / "d.toml").write_text("[prompt_format]\ntag_drop_rate = 1.0\ndroppable_tags = ['tone']\nvalidation_set_size = 0.2\n[hacks]\nredistribute_authors = true\nuse_prose_styles = true\n")
    (tmp_path / "u.toml").write_text("[prompt_format]\nvalidation_set_size = 0.5\n")
    args = ["finalize", str(tmp_path / "r"), "--out", str(tmp_path / "o"), "--defaults", str(tmp_path / "d.toml"), "--settings", str(tmp_path / "u.toml")]
    cli.main(args, spark)
    kept, held = _json(tmp_path / "o" / "dataset_r"), _json(tmp_path / "o" / "dataset_r_val")
    assert (len(kept), len(held)) == (15, 15)
    assert all("Tone" not in r["instruction"] and "slow pacing" in r["instruction"] for r in kept)


def test_generate_takes_settings_and_dumps(spark, tree):
    (tree / "t.txt").write_text(">Story: {story}\n>Context: {context}")
    (tree / "u.toml").write_text('[prompt_gen]\ncontinuation_likelyhood = 0\n[prompt_format]\njson_key_order = ["story", "prompt"]\n')
    cli.main(["generate", str(tree / "in"), str(tree / "o"), "--template", str(tree / "t.txt"), "--settings", str(tree / "u.toml"), "--answers", str(tree / "a"), "--extras", str(tree / "x")], spark)
    made = [json.loads(r["record"]) for r in _json(tree / "o")]
    assert len(made) == 6 and all(list(r)[:2] == ["story", "prompt"] and "context" not in r for r in made)
    assert {r["answer"] for r in _json(tree / "a")} == {">Prompt: Write a scene\n>Tone: neutral"}
    assert {(r["extras"]["zeta"]) for r in _json(tree / "x")} == {"z"}


def test_chunks_of_pieces(spark, tree):
    from sentencepiece import SentencePieceProcessor

    model = "/opt/tokenizers/piece_bpe_32k.model"
    own = SentencePieceProcessor(model_file=model)
    text = "The quiet harbour kept every lantern. " * 3 + "\n" + "It was “unforgettable”, and nobody – not one – remembered the gardener   who had left " * 12 + "at last.\n"
    (tree / "b").mkdir()
    (tree / "b" / "one.txt").write_text(text)
    cli.main(["chunk-books", str(tree / "b"), str(tree / "o"), "--max-tokens", "50", "--pieces", model], spark)
    chunks = [r["text"] for r in sorted(_json(tree / "o"), key=lambda r: r["chunk_id"])]
    assert len(chunks) > 4 and "".join("".join(chunks).split()) == "".join(text.split())
    assert all(len(own.encode(p)) <= 51 for c in chunks for p in c.split("\n"))
