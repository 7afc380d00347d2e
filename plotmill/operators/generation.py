"""Prompt metadata from an external model (L1-L6, P10, A9, A14, X-s10, X-s11). The model is a parameter; the default one is a stub."""

from __future__ import annotations

import json
import re
import urllib.request
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotmill.constants import CONTINUATION_RATE, IDEAL_TOKENS
from plotmill.functions.text import strip, token_count
from plotmill.operators import context
from plotmill.operators.fewshot import parse, render
from plotmill.operators.records import STRING_MAP, normalise_keys, overlay, rename_keys, without_keys


class Client(Protocol):
    """What answers a request."""

    def complete(self, prompt: str, stop: Sequence[str], temperature: float, most: int) -> str: ...


@dataclass
class StubClient:
    """Answers without a network: a fixed reply, or one made from the request."""

    reply: str | Callable[[str], str] = ">Prompt: Write a scene\n>Tone: neutral"

    def complete(self, prompt: str, stop: Sequence[str], temperature: float, most: int) -> str:
        return self.reply(prompt) if callable(self.reply) else self.reply


_TOKEN = re.compile(r"[^\W\d_]+|\d|[^\w\s]|_")


def events(lines: Iterable[bytes]) -> Iterator[dict]:
    """The JSON payloads of a stream of server-sent events; a plain JSON answer is one payload."""
    data: list[str] = []
    plain: list[str] = []
    for raw in [*lines, b""]:
        line = raw.decode("utf-8").rstrip("\r\n")
        if line.startswith("data:"):
            data.append(line[5:].removeprefix(" "))
        elif not line and data:
            body, data = "\n".join(data), []
            if body != "[DONE]":
                yield json.loads(body)
        elif line and not line.startswith((":", "event:", "id:", "retry:")):
            plain.append(line)
    if plain:
        yield json.loads("\n".join(plain))


@dataclass
class CompletionClient:
    """A completion server that takes a JSON request and streams `choices[0].text` as server-sent events; certificates are checked (Q-25).

    With a `preset` the server's own sampler settings hold instead of `extra`. Requests that leave no room for the answer are
    an error here; `within_window` keeps them away.
    """

    url: str = "http://127.0.0.1:5000/v1/completions"
    window: int = 8192
    preset: str | None = None
    extra: Mapping[str, object] = field(default_factory=lambda: {"min_p": 0.05, "top_p": 0.98, "repetition_penalty": 1.05, "repetition_penalty_range": 1024})

    def complete(self, prompt: str, stop: Sequence[str], temperature: float, most: int) -> str:
        if (size := len(_TOKEN.findall(prompt))) + most > self.window:
            raise ValueError(f"a prompt of {size} tokens and an answer of {most} are longer than the model's window of {self.window}")
        sampler = {"preset": self.preset} if self.preset and self.preset.lower() != "none" else self.extra
        body = {"prompt": prompt, "temperature": temperature, "max_tokens": most, "truncation_length": self.window - most, "stop": list(stop), "ban_eos_token": True, "stream": True, **sampler}
        request = urllib.request.Request(self.url, json.dumps(body).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=600) as answer:
            return "".join(event["choices"][0]["text"] for event in events(answer))


@dataclass
class ContentClient:
    """L3: a server of the `generateContent` kind, with a key; its content filters are set to let fiction pass."""

    url: str = "http://127.0.0.1:5001/v1/models/text:generateContent"
    key: str = ""
    # Filter categories of that interface.
    filters: Sequence[str] = ("HARM_CATEGORY_HARASSMENT", "HARM_CATEGORY_HATE_SPEECH", "HARM_CATEGORY_SEXUALLY_EXPLICIT", "HARM_CATEGORY_DANGEROUS_CONTENT")

    def complete(self, prompt: str, stop: Sequence[str], temperature: float, most: int) -> str:
        body = {
            "contents": [{"parts": [{"text": prompt}]}],
            "generationConfig": {"temperature": temperature, "maxOutputTokens": most, "stopSequences": list(stop)},
            "safetySettings": [{"category": c, "threshold": "BLOCK_NONE"} for c in self.filters],
        }
        request = urllib.request.Request(self.url, json.dumps(body).encode(), {"Content-Type": "application/json", "x-goog-api-key": self.key})
        with urllib.request.urlopen(request, timeout=600) as answer:
            return json.load(answer)["candidates"][0]["content"]["parts"][0]["text"]


BACK_ENDS: dict[str, Callable[[], Client]] = {"stub": StubClient, "completion": CompletionClient, "content": ContentClient}


def client(name: str, url: str | None = None, preset: str | None = None) -> Client:
    """L1: a back end by name; `url` and `preset` are for the completion server."""
    if name not in BACK_ENDS:
        raise ValueError(f"no back end {name!r}; there are {', '.join(sorted(BACK_ENDS))}")
    if name == "completion":
        return CompletionClient(**{k: v for k, v in (("url", url), ("preset", preset)) if v})
    return BACK_ENDS[name]()


def fits_window(request: Column, answer: int, window: int = 8192) -> Column:
    """L2: whether a request and its answer fit the model's window; rows that do not belong into a reject table (`within_window`)."""
    return token_count(request) + answer <= window


def within_window(requests: DataFrame, request: str, answer: int, window: int = 8192) -> DataFrame:
    """L2: all rows, with `fits`; a request that does not fit is null, so that it is not sent, and `refusal` says why."""
    sized = requests.withColumn("fits", fits_window(F.col(request), answer, window))
    return sized.withColumn(request, F.when(F.col("fits"), F.col(request)))


def clean_answer(answer: Column) -> Column:
    """X-s10, X-s11: an answer without blank lines, end mark and trailing key mark."""
    kept = F.array_join(F.filter(F.split(answer, r"\r\n|\r|\n", -1), lambda x: strip(x) != ""), "\n")
    return F.regexp_replace(F.regexp_replace(kept, r"</s>\z", ""), r"\n>\z", "")


def is_junk(record: Column, blacklist: Sequence[str] = ()) -> Column:
    """P10: an empty record, or one with a value under two characters or holding a banned text. Null counts as empty."""
    bad = F.exists(F.map_values(record), lambda v: F.coalesce(F.length(v) < 2, F.lit(True)) | _holds(v, blacklist))
    return F.coalesce((F.size(record) <= 0) | bad, F.lit(True))


def _holds(value: Column, banned: Sequence[str]) -> Column:
    out = F.lit(False)
    for b in banned:
        out = out | F.contains(value, F.lit(b))
    return out


def first_example(answer: Column) -> Column:
    """The first example of an answer with keys in lower case; null if it has no key (Q-23)."""
    return normalise_keys(F.get(parse(clean_answer(answer)), 0))


def result_tokens(record: Column) -> Column:
    """Tokens of all values."""
    return F.aggregate(F.map_values(record), F.lit(0), lambda a, v: a + token_count(v))


def acceptable(record: Column, ideal: int = IDEAL_TOKENS) -> Column:
    """A valid result of twice the ideal length or more is refused (Q-09)."""
    return F.abs(F.lit(ideal) - result_tokens(record)) < ideal


_LINE_END = re.compile(r"\r\n|\r|\n")


def answer_values(answer: str, remove: Sequence[str] = (), rename: Mapping[str, str] | None = None) -> list[str]:
    """The values of the first example of an answer, for P10 in a worker; [] if it has no key.

    Reads as `first_example`, but before keys that differ in case alone fall together: a value that another one hides counts.
    """
    kept = "\n".join(x for x in _LINE_END.split(answer) if x.strip())
    example: dict[str, str] = {}
    last = None
    for line in _LINE_END.split(re.sub(r"\n>\Z", "", re.sub(r"</s>\Z", "", kept))):
        if not line.strip():
            if example:
                break
        elif line.startswith(">") and ":" in line:
            name, value = line[1:].split(":", 1)
            last = name.strip()
            example[last] = value.removeprefix(" ")
        elif last is not None:
            example[last] += "\n" + line
    left = {k: v for k, v in example.items() if k.lower() not in remove}
    for old, new in (rename or {}).items():
        for k in [k for k in left if k.lower() == old]:
            left[new] = left.pop(k)
    return list(left.values())


def judge(blacklist: Sequence[str] = (), remove: Sequence[str] = (), rename: Mapping[str, str] | None = None) -> Callable[[str], bool]:
    """P10 for `ask`: whether an answer, without the keys `remove`, has a key, no value under two characters and no banned text."""

    def good(answer: str) -> bool:
        values = answer_values(answer, remove, rename)
        return bool(values) and all(len(v) >= 2 and not any(b in v for b in blacklist) for v in values)

    return good


def refusal(answers: DataFrame, result: Column) -> Column:
    """Why a row of `ask` that hands `fits` through has no result: `window` (L2), `unanswered` (no request), `junk` (no usable answer), `length` (A14); null if it has one."""
    return F.when(~answers["fits"], "window").when(answers["attempts"] == 0, "unanswered").when(answers["answer"].isNull(), "junk").when(~F.coalesce(acceptable(result), F.lit(False)), "length")


def ask(requests: DataFrame, keys: list[str], request: str, answerer: Client, attempts: int = 3, stop: Sequence[str] = ("\n\n",), temperature: float = 0.2, most: int = 600, usable: Callable[[str], bool] = bool) -> DataFrame:
    """`(<keys>, answer STRING, attempts BIGINT, junk ARRAY<STRING>)`: each request sent until an answer is usable (`judge`).

    One request at a time in each partition, so partitions bound the load on the server. Answers are not the same when asked
    again: write the result before it is used twice. `keys` are handed through, whatever their types; null requests are not sent.
    """
    fields = ", ".join(f"`{k}` {requests.schema[k].dataType.simpleString()}" for k in keys)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            answers, sent, junks = [], [], []
            for text in batch.column(request).to_pylist():
                junk, answer, n = [], None, 0
                while n < attempts and text is not None:
                    n += 1
                    got = answerer.complete(text, stop, temperature, most)
                    if usable(got):
                        answer = got
                        break
                    junk.append(got)
                answers.append(answer)
                sent.append(n)
                junks.append(junk)
            made = [pa.array(answers, pa.string()), pa.array(sent, pa.int64()), pa.array(junks, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), *made], [*keys, "answer", "attempts", "junk"])

    return requests.select(*dict.fromkeys([*keys, request])).mapInArrow(send, f"{fields}, answer string, attempts bigint, junk array<string>")


def ask_for_chunks(chunks: DataFrame, keys: list[str], text: str, answerer: Client, params: Mapping | None = None, seed: int = 42, attempts: int = 3, blacklist: Sequence[str] = (), rate: float = CONTINUATION_RATE) -> DataFrame:
    """X2, F7, X-s9, L2, L5: chunks `(<keys>, raw, prompt)` put into the template `text` and asked; `prompt` is the record a chunk holds, null for plain text.

    A record with the key `story` is asked again with its own story and context and is never split; plain text, and an empty
    object, may be split. A record without a story, and a null text, gives no request. Returns the columns of `ask` with those
    that `chunk_records` needs; write the result before it is used twice.
    """
    params = params or {}
    most, holds = params.get("response_length", 600), F.coalesce(F.size("prompt") > 0, F.lit(False))
    redone = holds & F.coalesce(F.map_contains_key("prompt", F.lit("story")), F.lit(False))
    known = chunks.select(*keys, "raw", F.when(holds, F.col("prompt")).otherwise(F.create_map().cast(STRING_MAP)).alias("old"), holds.alias("holds"), redone.alias("redone"))
    drawn = known.withColumn("split", context.continues(seed, F.concat_ws("/", *keys), has_story=F.col("holds"), rate=rate))
    halves = drawn.withColumn("s", F.when(F.col("split"), context.split_context(F.col("raw"))))
    before = F.when(F.col("split"), F.col("s.context")).otherwise(F.coalesce(F.when(F.col("redone"), F.col("old")["context"]), F.lit("N/A")))
    told = F.when(F.col("split"), F.col("s.story")).when(F.col("redone"), F.col("old")["story"]).when(~F.col("holds"), F.col("raw"))
    parts = halves.select(*keys, "old", "split", before.alias("before"), told.alias("told"))
    requests = within_window(parts.withColumn("request", render(text, {"story": F.col("told"), "context": F.col("before")})), "request", most)
    usable = judge(blacklist, params.get("remove_keys_from_result", []), params.get("rename_keys"))
    return ask(requests, [*keys, "old", "before", "told", "split", "fits"], "request", answerer, attempts, params.get("stopping_strings", ["\n\n"]), params.get("temperature", 0.2), most, usable)


def chunk_records(answers: DataFrame, params: Mapping | None = None) -> DataFrame:
    """Rows of `ask_for_chunks` with `prompt`, the values of the answer over the record there was, and `reason` (`refusal`).

    The story is kept as it was asked, the context too where the chunk was split; `prompt` is null for rows with a reason.
    """
    params = params or {}
    made = without_keys(first_example(F.col("answer")), params.get("remove_keys_from_result", []))
    if names := params.get("rename_keys"):
        made = rename_keys(made, names)
    story = F.create_map(F.lit("story"), strip(F.col("told")))
    own = F.when(F.col("split"), F.create_map(F.lit("context"), strip(F.col("before")), F.lit("story"), strip(F.col("told")))).otherwise(story)
    new = answers.withColumns({"made": made, "own": own}).withColumn("new", overlay(F.col("made"), F.col("own")))
    judged = new.withColumn("reason", refusal(new, F.col("new")))
    return judged.withColumn("prompt", F.when(F.col("reason").isNull(), overlay(F.col("old"), F.col("new"))))
