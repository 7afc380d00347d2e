"""Records, rows, tags, names, few-shot documents: hand-worked examples."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plotmill.operators import dataset, fewshot, generation, names, records, rows, tags
from plotmill.operators.grid import template_grid
from plotmill.operators.screenplay import Script, chunk_script, read_script, screenplay_chunks, script_constants

M = "map<string,string>"


def record(spark, *maps):
    return spark.createDataFrame([(i, m) for i, m in enumerate(maps)], f"id bigint, prompt {M}")


def test_parse_record(one):
    assert one(records.parse_record(F.lit('{"a": "1", "b": null, "c": 2}'))) == {"a": "1", "b": None, "c": "2"}
    for raw in ("plain", '{"a": "1"', "[1]", '"x"', "", "﻿{}"):
        assert one(records.parse_record(F.lit(raw))) is None


def test_order_rename_overlay(spark):
    df = record(spark, {"zeta": "z", "story": "s", "alpha": None})
    got = df.select(F.map_entries(records.ordered(F.col("prompt"), ["prompt", "story"])).alias("p")).first()["p"]
    assert [tuple(e) for e in got] == [("prompt", None), ("story", "s"), ("alpha", None), ("zeta", "z")]
    low = record(spark, {" Tone ": "a", "tone": "b", "X": "c"}).select(records.normalise_keys(F.col("prompt")).alias("p")).first()["p"]
    assert low == {"tone": "b", "x": "c"}
    over = df.select(records.overlay(F.col("prompt"), F.create_map(F.lit("story"), F.lit(None).cast("string"), F.lit("new"), F.lit("n"))).alias("p")).first()["p"]
    assert over == {"zeta": "z", "story": None, "alpha": None, "new": "n"}


def test_merge_and_inject(spark):
    base = spark.createDataFrame([("s", "1", {"prompt": "p", "tone": "t"}), ("s", "2", {"prompt": "q"})], f"story string, chunk string, prompt {M}")
    extract = spark.createDataFrame([("s", "1", {"tone": None, "other": "o"})], f"story string, chunk string, prompt {M}")
    assert [r["prompt"] for r in records.merge_records(base, extract, ["story", "chunk"], ["tone"]).collect()] == [{"prompt": "p", "tone": None}]
    assert [r["chunk"] for r in records.unmatched(base, extract, ["story", "chunk"]).collect()] == ["2"]
    settings = spark.createDataFrame([("s", "Ann", "")], "story string, author string, genre string")
    got = records.inject(base.union(base.limit(1).withColumn("story", F.lit("none"))), settings, "story", ["author", "genre"]).collect()
    assert {("author" in r["prompt"]) for r in got if r["story"] == "s"} == {True}
    assert [r["prompt"] for r in got if r["story"] == "none"] == [{"prompt": "p", "tone": "t"}]


def test_examples(one):
    d = "\n\n---\n\n"
    assert one(records.parse_example(F.lit(f"c{d}p{d}s"))) == {"context": "c", "prompt": "p", "story": "s"}
    assert one(records.parse_example(F.lit(f"p{d}s"))) == {"prompt": "p", "story": "s"}
    assert one(records.parse_example(F.lit(f"a{d}b{d}c{d}d{d}e"))) == {}
    with pytest.raises(Exception, match="at least one"):
        one(records.parse_example(F.lit("alone")))


def test_style_and_hyphens(spark, one):
    df = record(spark, {"tone": "Wry.", "pacing": "Fast", "sensory detail": "High", "point of view": "Third Person", "author": "Ann"}, {}, {"pacing": "slow"})
    got = [r["s"] for r in df.orderBy("id").select(rows.prose_style(F.col("prompt")).alias("s")).collect()]
    assert got == ["Tone: wry.\nWritten with fast pacing, in high detail, from a Third Person perspective. In the style of Ann.", "Written", "Written with slow pacing."]
    assert one(rows.undo_hyphens(F.lit("Write a scene where\n- a\n- b"))) == "Write a scene where: a b"
    assert one(rows.undo_hyphens(F.lit("Other\n- a"))) == "Other\n- a"


def test_dataset_rows_edges(spark):
    df = record(spark, {"prompt": "do", "story": "“x”", "context": "N\\A"}, None, {"context": "  ", "story": None})
    got = {r["id"]: r for r in rows.dataset_rows(df, ["id"]).collect()}
    assert got[0]["output"] == '"x"' and got[0]["context"] is None and got[0]["instruction"] == "Written\ndo"
    assert got[1]["output"] == "" and got[2]["context"] is None and got[2]["length"] == "short"
    assert rows.dataset_rows(df.limit(0), ["id"]).count() == 0


def test_training_text(one):
    assert one(rows.render_training_text(F.lit(None).cast("string"), F.lit("c%instruction%"), F.lit("i"), F.lit("o"))).endswith("### Assistant:\nc%instruction%\n\n### User:\ni\n\n### Assistant:\no")


def test_exact_split(spark):
    df = spark.range(1000).withColumnRenamed("id", "record_id")
    for share, n in ((0.1, 100), (0.0, 0), (1.0, 1000), (0.3337, 333)):
        assert dataset.exact_split(df, "record_id", share=share).filter("is_validation").count() == n
    assert dataset.exact_split(df.limit(0), "record_id").count() == 0
    doubled = df.limit(5).union(df.limit(5))
    assert dataset.exact_split(doubled, "record_id", share=0.5).filter("is_validation").count() == 5


def test_subsets():
    assert ["".join(s) for s in dataset.subsets(list("abc"))] == ["a", "b", "ab", "c", "ac", "bc", "abc"]
    assert dataset.subset_name(["a", "b"], 9, 1) == "dataset_a_bMAX9MIN1"


def test_metric_values(one):
    def v(f, x):
        return one(dataset.metric_values(F.lit(f), F.lit(x)))

    assert v("tone", "Candid, wry.") == ["c", "id", "wry"]
    assert v("tone", "Dark, Wry") == ["dark", "wry"]
    assert v("point of view", "Third Person (Ann, Bo)") == ["third person"]


def test_alias(one):
    def a(x, f="tone"):
        return one(tags.alias(F.lit(x), tags.ALIASES[f]))

    assert a("Reflective.") == "melancholic"
    assert a("Plain Words") == "Plain Words"
    assert a("wistful, fearful and urgent") == "nostalgic, thrilling, intense"
    assert a("tense, one of tension") == "tense"
    assert a("dark, with a touch of irony") == "dark, , irony"
    assert a("") == ""


def test_narrow_authors(spark):
    df = record(spark, {"similar writers": "Ann, Bo, Cy"}, {"similar writers": "Cy"}, {"author": "Dee", "similar writers": "Ann"}, {"similar writers": "N/A"}, {"similar writers": "Ann"})
    popular = spark.createDataFrame([("ann", 90), ("bo", 30), ("cy", 5)], "name string, n bigint")
    got = {r["id"]: r["author"] for r in tags.narrow_authors(df, popular, "id").collect()}
    assert got[0] in ("Ann", "Bo") and got[1] == "N/A" and got[4] == "Ann" and set(got) == {0, 1, 4}
    assert tags.narrow_authors(df, popular.limit(0), "id").count() == 0
    many = spark.range(2000).select(F.col("id"), F.create_map(F.lit("similar writers"), F.lit("Ann,Bo")).alias("prompt"))
    share = tags.narrow_authors(many, popular, "id").filter("author = 'Bo'").count() / 2000
    assert 0.70 < share < 0.80  # weight 90 of 120


def test_names(spark, one):
    assert one(names.parse_names(F.lit("Ann Lee, the old man, Bo"))) == ["Ann Lee", "Bo"]
    assert one(names.parse_names(F.lit(None).cast("string"))) == []
    df = record(spark, {"male characters": "Adam Stone", "female characters": "Dr. Eva Moss,Ivy's Aunt", "story": "Adam said A-Adam! ADAM STONE met Moss and Ivy."})
    r = names.randomize_names(df, ["id"], male=["Ben"], female=["Cleo", "Dot"]).first()
    s = r["swaps"]
    assert [x["old_first"] for x in s] == ["Adam", "", "Ivy"] and [x["old_last"] for x in s] == ["Stone", "", ""]
    ivy = s[2]["new_first"]
    assert r["prompt"]["story"] == f"Ben said A-Ben! BEN BEN met Moss and {ivy}."
    assert {(x["old_name"], x["new_name"]) for x in names.replaced_names(names.randomize_names(df, ["id"], male=["Ben"], female=["Cleo", "Dot"]), ["id"]).collect()} == {
        ("Adam Stone", "Ben Ben"), ("Ivy's Aunt", f"{ivy}'s Aunt")
    }
    with pytest.raises(Exception, match="more names"):
        names.randomize_names(record(spark, {"male characters": "A,B,C"}), ["id"], male=["X"]).collect()
    assert names.randomize_names(record(spark, None, {}), ["id"]).filter(F.size("swaps") > 0).count() == 0


FEW = ">name: Ann\n>age: 3\n>bio: one\ntwo\n\n\n>name: Bo\nstray\n\nlost line\n>k:  two spaces\n>k: again"


def test_fewshot(one):
    got = one(fewshot.parse(F.lit(FEW)))
    assert got == [{"name": "Ann", "age": "3", "bio": "one\ntwo"}, {"name": "Bo\nstray"}, {"k": "again"}]
    assert one(fewshot.edit(F.lit(">a: 1\n>b: 2\n\n>a: 3"), ["b", "none"])) == ">a: 1\n\n>a: 3"
    assert one(fewshot.parse(F.lit("no keys here"))) == []
    assert one(fewshot.render("{a} {{x}} {b}", {"a": F.lit("{b}"), "b": F.lit("2")})) == "{b} {x} 2"
    with pytest.raises(KeyError):
        fewshot.render("{nope}", {})


def test_generation(spark, one):
    assert one(generation.clean_answer(F.lit("a\n\n b\n</s>"))) == "a\n b\n"
    assert one(generation.is_junk(F.create_map(F.lit("a"), F.lit("ok")), ["bad"])) is False
    assert one(generation.is_junk(F.create_map(F.lit("a"), F.lit("-")))) is True
    assert one(generation.is_junk(F.create_map(F.lit("a"), F.lit("a bad one")), ["bad"])) is True
    assert one(generation.is_junk(F.lit(None).cast(M))) is True
    with pytest.raises(ValueError, match="no back end"):
        generation.client("nope")
    df = spark.createDataFrame([(1, "x"), (2, None)], "id bigint, request string")
    got = {r["id"]: r for r in generation.ask(df, ["id"], "request", generation.StubClient(""), attempts=2).collect()}
    assert got[1]["answer"] is None and got[1]["attempts"] == 2 and got[1]["junk"] == ["", ""] and got[2]["attempts"] == 0


def test_answers_are_judged_in_the_loop(spark, one):
    class Client:
        """Answers in turn, for each request anew."""

        def __init__(self, replies):
            self.replies, self.sent = replies, {}

        def complete(self, prompt, stop, temperature, most):
            n = self.sent[prompt] = self.sent.get(prompt, 0) + 1
            return self.replies[min(n, len(self.replies)) - 1]

    df = spark.createDataFrame([(1, "x", {"a": "b"}), (2, "y", None)], "id bigint, request string, m map<string,string>")
    replies = ["no key", ">Tone: -", ">Tone: a fiddler", ">Tone: wry"]
    got = generation.ask(df, ["id", "m"], "request", Client(replies), attempts=4, usable=generation.judge(["fiddler"])).orderBy("id").collect()
    assert [(r["answer"], r["attempts"], r["junk"], r["m"]) for r in got] == [(">Tone: wry", 4, replies[:3], {"a": "b"}), (">Tone: wry", 4, replies[:3], None)]
    left = generation.ask(df.withColumn("fits", F.lit(True)), ["id", "fits"], "request", Client(replies), attempts=3, usable=generation.judge(["fiddler"]))
    assert [r[0] for r in left.select(generation.refusal(left, generation.first_example(F.col("answer")))).collect()] == ["junk", "junk"]
    long = spark.createDataFrame([(i, f">Tone: {'w ' * i}", 1, True) for i in (3999, 4000)], "id bigint, answer string, attempts bigint, fits boolean")
    assert [r[0] for r in long.orderBy("id").select(generation.refusal(long, generation.first_example(F.col("answer")))).collect()] == [None, "length"]
    # the judge in a worker and the column forms agree
    texts = ["", "x", ">a: ok\n\n>b: -", ">a: ok</s>", ">a: ok\n>", ">a:  b\r\nmore\r>c: d", ">a: ok\n>a: -", "lead\n> A : fine", ">a:", ">a: 1\n2", ">: ok", ">a: no\u2028w"]
    for t in texts:
        record = one(generation.first_example(F.lit(t)))
        assert generation.answer_values(t) == list((record or {}).values()), t
        assert generation.judge(["fine"])(t) is not one(generation.is_junk(generation.first_example(F.lit(t)), ["fine"])), t
    assert not generation.judge()(">Tone: -\n>tone: wry") and generation.judge(remove=["tone"])(">Tone: -\n>x: ok")


def test_requests_over_the_window_are_kept(spark):
    df = spark.createDataFrame([(1, "w " * 7592), (2, "w " * 7593), (3, None)], "id bigint, request string")
    got = generation.ask(generation.within_window(df, "request", 600), ["id", "fits"], "request", generation.StubClient())
    rows = got.select("id", "attempts", "answer", generation.refusal(got, generation.first_example(F.col("answer"))).alias("reason")).orderBy("id").collect()
    assert [(r["id"], r["attempts"], r["answer"] is None, r["reason"]) for r in rows] == [(1, 1, False, None), (2, 0, True, "window"), (3, 0, True, "unanswered")]


def test_a_record_asked_again_keeps_its_split(spark):
    kept = {"prompt": "old", "context": " before ", "story": " told\n", "zeta": "z"}
    rows = [("a", kept), ("b", {"story": "alone"}), ("c", {"context": "no story"}), ("d", {"story": None}), ("e", {}), ("f", None), ("g", None)]
    raws = {"e": "{}", "f": "one\ntwo\nthree\nfour\n"}
    df = spark.createDataFrame([("s", k, raws.get(k), m) for k, m in rows], "story string, chunk string, raw string, prompt map<string,string>")
    echo = generation.StubClient(lambda request: ">Prompt: " + request.replace("\n", "/"))

    def run(seed):
        asked = generation.ask_for_chunks(df, ["story", "chunk"], "[{context}|{story}]", echo, seed=seed)
        return {r["chunk"]: r for r in generation.chunk_records(asked).select("chunk", "prompt", "reason", "split").collect()}

    got = run(1)
    assert got["a"]["prompt"] == {"prompt": "[ before | told/]", "context": " before ", "story": "told", "zeta": "z"}
    assert got["b"]["prompt"] == {"story": "alone", "prompt": "[N/A|alone]"}
    assert [(got[k]["prompt"], got[k]["reason"]) for k in "cdg"] == [(None, "unanswered")] * 3
    seen = {}
    for seed in range(12):
        r = run(seed)
        assert not any(r[k]["split"] for k in "abcd")
        seen[r["f"]["split"]] = r["f"]["prompt"]
        if not r["e"]["split"]:
            assert r["e"]["prompt"] == {"prompt": "[N/A|{}]", "story": "{}"}
        if len(seen) == 2:
            break
    assert seen[True] == {"prompt": "[one/two|three/four]", "context": "one\ntwo", "story": "three\nfour"}
    assert seen[False] == {"prompt": "[N/A|one/two/three/four/]", "story": "one\ntwo\nthree\nfour"}


def test_grid(spark):
    got = template_grid(spark, "{a}-{b}", {"a": ["x", "y", "x"], "b": ["1"]}, 2).collect()
    assert len(got) == 6 and {r["out_file"] for r in got} == {"a0_b0__trial0.txt", "a0_b0__trial1.txt", "a1_b0__trial0.txt", "a1_b0__trial1.txt"}
    assert template_grid(spark, "{a}", {"a": []}, 1).count() == 0


SCRIPT = [
    ";◇◇◇：背景指定  ：～昼夕夜etc", ";◇◇◇：roof／day", ";◇◇◇：hall／night", "@bg x", '@nm t="Mia" s=1', '"Hello[r]there"[np]', "", "*p1|", "She left.[np]", "It rained.[np]", "Late.", '@nm t="Bo"', '"*waves*"[np]',
]


def test_screenplay(spark):
    s = read_script(SCRIPT, {";◇◇◇：hall／night": "HALL"})
    assert s.elements[0] == "HALL\n" and s.elements[1] == "MIA\nHello there\n" and s.names == ["Mia", "Bo"]
    text = "".join(chunk_script(s, 1000))
    assert "NARRATOR (V.O.)\nShe left. It rained. Late.\n" in text and text.endswith("BO\n*waves*\n")
    small = chunk_script(s, 12)
    assert len(small) > 1 and all(c.startswith("HALL\n") for c in small) and "".join(c.removeprefix("HALL\n") for c in small) == text.removeprefix("HALL\n")
    assert chunk_script(Script(), 5) == []
    assert len("".join(chunk_script(s, 12, compat=True))) < len(text)
    df = spark.createDataFrame([("a", "\n".join(SCRIPT)), ("b", None), ("c", "")], "f string, t string")
    got = screenplay_chunks(df, "f", "t", 1000).collect()
    assert [(r["f"], r["chunk_id"], r["is_roleplay"]) for r in got] == [("a", 0, True)]
    places, people = script_constants(df, "t")
    assert places.count() == 2 and {r["name"] for r in people.collect()} == {"Mia", "Bo"}


def test_clients_speak_to_a_server():
    import json
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            seen.append(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps({"choices": [{"text": "a"}], "candidates": [{"content": {"parts": [{"text": "b"}]}}]}).encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/x"
    assert generation.CompletionClient(url).complete("p", ["s"], 0.3, 50) == "a" and generation.ContentClient(url).complete("p", ["s"], 0.3, 50) == "b"
    assert seen[0]["max_tokens"] == 50 and seen[0]["truncation_length"] == 8142 and seen[1]["generationConfig"]["stopSequences"] == ["s"]
    server.shutdown()


def test_pieces(spark):
    from plotmill.functions.pieces import join_pieces, piece_count, pieces

    model = "/opt/tokenizers/piece_bpe_32k.model"
    df = spark.createDataFrame([("The quiet harbour.",), (None,), ("",)], "t string")
    got = df.select("t", piece_count(F.col("t"), model).alias("n"), pieces(F.col("t"), model).alias("p")).withColumn("back", join_pieces(F.col("p"))).collect()
    assert got[0]["n"] == len(got[0]["p"]) > 3 and got[0]["back"] == "The quiet harbour."
    assert (got[1]["n"], got[1]["p"]) == (0, None) and got[2]["n"] == 0


def test_events_of_a_stream():
    lines = [b": ping\n", b'data: {"choices": [{"text": "a"}]}\n', b"\n", b'data: {"choices":\n', b'data: [{"text": "b"}]}\n', b"\n", b"data: [DONE]\n", b"\n"]
    assert "".join(e["choices"][0]["text"] for e in generation.events(lines)) == "ab"
    assert list(generation.events([b'{"x": 1}'])) == [{"x": 1}] and list(generation.events([])) == []


def test_a_request_over_the_window_is_an_error():
    with pytest.raises(ValueError, match="longer than"):
        generation.CompletionClient(window=20).complete("word " * 30, [], 0.1, 5)
    assert generation.client("completion", "http://x", "p").preset == "p"


def _plain_examples(text):
    """The examples of a document, read line by line."""
    out, cur = [], {}
    last = None
    for line in text.replace("\r\n", "\n").replace("\r", "\n").split("\n"):
        if not line.strip():
            out += [cur] if cur else []
            cur = {}
        elif line.startswith(">") and ":" in line:
            last = line[1:].split(":", 1)[0].strip()
            value = line.split(":", 1)[1]
            cur[last] = value[1:] if value.startswith(" ") else value
        elif cur:
            cur[last] += "\n" + line
    return out + ([cur] if cur else [])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet=">a: \n\t", max_size=40), min_size=20, max_size=20))
def test_parse_against_reading_line_by_line(spark, texts):
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(fewshot.parse(F.col("t")).alias("e")).collect()
    assert [[dict(m) for m in r["e"]] for r in got] == [_plain_examples(t) for t in texts]
