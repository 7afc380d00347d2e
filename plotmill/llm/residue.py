"""Template residue, dummy text and error pages in a corpus (problem 10).

Character n-gram models of dummy text, error notices, script notices, page navigation, template slots and natural prose
score every text, across words, by sums over windows of the likelihood ratio to prose. The models know only short general
lists at first; all different texts of the corpus then teach them its own wordings without any answers: they are labelled
with the models at hand, each model is fitted anew on what was labelled so, and so on for `ROUNDS` rounds. A text is excluded if residue covers all of it but a sentence. Unfilled slots and editors' reminders are marks in sound prose:
windows of the slot model find them, and their form is then checked exactly.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import cache, cached_property, reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotmill.session import spread

#: Different texts `_sample` takes at most, and the longest one taken; no query fits its models on a sample.
SAMPLE, SAMPLE_LENGTH = 4000, 5000
ROUNDS, SEED_WEIGHT = 4, 2.0
ORDER, BACKOFF = 4, 2.0
#: Bits a window must be likelier under a residue model than under prose, under the slot model, and bits a change of label costs.
WINDOW_BITS, SLOT_BITS, SWITCH_BITS = 18.0, 8.0, 9.0
#: Bits a character costs, beyond those of its letter frequency, in text of no known kind.
UNKNOWN_BITS = 0.5
#: Words of prose that a residue document may hold besides (a single sentence), and the least share of other words.
PROSE_WORDS, LEAST_COVERAGE = 30, 0.15
#: Stretches of so many characters that stand in a text so often are dummy text where hardly anything else stands.
STRETCH, REPEATS = 12, 3
#: Texts that a sentence must stand in to be learnt whole.
STOCK = 2
#: Characters labelled at a time, and scored at a time.
SLICE, SCAN = 500, 1 << 20

# General wordings the models start from.
SEEDS = {
    "filler": """
lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua.
ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat.
duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur.
excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum.
this is placeholder text. this is dummy text. sample text. your text here. insert text here. filler text. content coming soon.
this page intentionally left blank. text to come. to be written. the quick brown fox jumps over the lazy dog. test test test. testing 1 2 3. [no text] [missing]
text text text. blah blah blah. xxxx xxx xxxxx xx. asdf asdf. foo bar baz. blindtext. platzhaltertext. texte de remplissage. faux texte. texto de relleno. testo segnaposto.
""",
    "error_page": """
error 404: page not found. the requested page could not be found. the requested url was not found on this server. 400 bad request. 401 unauthorized. 403 forbidden. 404 not found. 408 request timeout. 410 gone.
429 too many requests. 500 internal server error. 502 bad gateway. 503 service unavailable. 504 gateway timeout. error code: 500. status: 404.
access denied. you do not have permission to access this page. service is temporarily unavailable. down for maintenance. please try again later. something went wrong. an unexpected error occurred. an error has occurred.
error establishing a database connection. the connection has timed out. session expired. please log in again. rate limit exceeded. request id: 00ab0c0d. if you believe this is an error, please contact the administrator.
traceback (most recent call last): keyerror: 'name'. exception in thread "main" java.lang.nullpointerexception at com.example.main(main.java:12). {"error": "not found", "code": 404} {"status": 500, "message": "internal error"} <h1>not found</h1> <title>error</title>
seite nicht gefunden. ein fehler ist aufgetreten. zugriff verweigert. bitte versuchen sie es später erneut. page introuvable. une erreur est survenue. accès refusé. veuillez réessayer plus tard.
página no encontrada. se ha producido un error. acceso denegado. inténtelo de nuevo más tarde. pagina non trovata. si è verificato un errore. accesso negato. riprova più tardi.
""",
    "script_notice": """
please enable javascript to continue. you need to enable javascript to run this app. javascript is disabled in your browser. javascript is required to view this page. this site requires javascript. please turn on javascript and reload the page.
your browser does not support javascript. this page does not work without javascript. scripts are blocked. enable scripts. allow scripts. enable cookies. activate js. enable active content. checking your browser. <noscript> this page cannot be shown because scripts are turned off. scripts must be enabled. please enable scripting and reload.
bitte aktivieren sie javascript. diese seite benötigt javascript. veuillez activer javascript. ce site nécessite javascript. active javascript para continuar. este sitio requiere javascript. attiva javascript. questo sito richiede javascript.
""",
    "navigation": """
home about contact search. log in sign up register. skip to main content. menu. next previous. back to top. table of contents. share print. archive. cookies privacy policy terms of use. home / blog / post.
""",
}
KINDS = tuple(SEEDS)
RESIDUE = KINDS[:3]

# Names of template slots, and reminders editors write.
SLOTS = (
    "name|names|first_name|last_name|full_name|nickname|character|characters|character_name|hero|heroine|villain|protagonist|antagonist|author|authors|title|subtitle|"
    "chapter|chapter_title|scene|story|plot|context|setting|season|city|town|country|place|location|date|time|year|month|day|genre|tone|style|prompt|text|body|content|"
    "summary|topic|subject|theme|language|user|username|email|company|product|age|gender|pronoun|adjective|noun|verb|item|object|animal|colou?r|number|value|placeholder|your[ _]\\w+"
)
REMINDERS = ("TODO: finish this", "FIXME: check", "TKTK", "TK", "XXX check this", "[insert name here]", "[your name]", "[name to come]", "[to be written]", "(to be added)", "(insert scene)", "Editor's note: check", "Note to self: fix this", "[describe the place]", "[add title]")
# Signs that open and close slots.
BRACKETS = (("{{", "}}"), ("{{ ", " }}"), ("{", "}"), ("[[", "]]"), ("[", "]"), ("<<", ">>"), ("<", ">"), ("<%= ", " %>"), ("{% ", " %}"), ("${", "}"), ("#{", "}"), ("%(", ")s"), ("%", "%"), ("__", "__"), ("@@", "@@"))
_SLOT = rf"(?:{SLOTS})(?:[ _-]?\d+)?"
_NAME = r"[A-Za-z_][\w .:|-]*"
# How slots and reminders look.
PLACEHOLDER = re.compile(
    rf"""\{{\{{\s*{_NAME}\}}\}}|\[\[\s*{_NAME}\]\]|<<\s*{_NAME}>>|<%[=-]?\s*{_NAME}%>|\{{%\s*{_NAME}%\}}|[$\#]\{{\s*{_NAME}\}}|%\(\s*{_NAME}\)[sdr]
      |(?i:\{{\s*{_SLOT}\s*\}}|<\s*{_SLOT}\s*>|(?<![\w%])%{_SLOT}%|(?<!\w)__{_SLOT}__(?!\w)|(?<!\w)@@{_SLOT}@@|\[\s*{_SLOT}\s*\])
      |\{{\s*[A-Z][A-Z_]{{2,}}\d*\s*\}}|(?<!\w)%[A-Z][A-Z_]{{2,}}\d*%|(?<!\w)__[A-Z][A-Z_0-9]{{2,}}__
      |\[\s*(?i:insert|enter|add|fill\ in|choose|describe)\b[^\[\]\n]*\]|\[[^\[\]\n]*\b(?i:here|goes\ here)\s*\]|\[\s*(?i:your)\s[^\[\]\n]+\]
      |\[[^\[\]\n]*\b(?i:missing|to\ come|to\ be\ (?:written|added|filled|done)|tbd|tbc|tk)\b[^\[\]\n]*\]
      |\b(?:TODO|FIXME|TKTK|HACK)\b|(?<!\w)TK(?=[\s:,.)\]])|(?<!\w)XXX+\s+\w|(?i:\bnote\ to\ (?:self|editor|author)\b\s*:)|(?i:(?:^|\n)\s*(?:editor'?s?\ note|ed\.|author'?s?\ note)\s*:)
      |\((?i:to\ be\ (?:written|added|filled\ in|continued\ by\ editor)|insert\s[^()\n]+|fill\ in\s[^()\n]+)\)""",
    re.X,
)
_WORD = re.compile(r"\S+")
_LETTERS = re.compile(r"[^\W_]")
_SENTENCES = re.compile(r"(?<=[.!?…])[\"'”’)]*\s+|\s*\n\s*")
_ENDS = re.compile(r"[.!?…][\"'”’)]*$")

#: Classes of characters: blank, letters without case and marks, digits, signs, all others.
_CLASSES = [" ", *"abcdefghijklmnopqrstuvwxyz", "0123456789", ".", "!?…¡¿", ",;", ":", "\"'“”„’‘«»", "-–—‑", "(", "[", "{", "<", ">", ")]}", "/\\|", "_", "%$#@&*+=~`^"]
_SIZE = len(_CLASSES) + 1


@cache
def _folding() -> np.ndarray:
    """The class of each code point of the basic plane; the last entry stands for all beyond."""
    known = {c: k for k, members in enumerate(_CLASSES) for c in members}
    out = np.full(1 << 16, _SIZE - 1, np.uint8)
    for code in range(0xFFFF):
        char = chr(code)
        plain = known.get(unicodedata.normalize("NFD", char.lower())[:1])
        out[code] = 0 if char.isspace() else out[code] if plain is None else plain
    return out


def _joined(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the characters of texts one after the other, runs of blanks as one, `ORDER` blanks before each and one after; the places of the first blanks, and the end."""
    points = np.frombuffer("".join(" " + t + " " for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    got = _folding()[np.minimum(points, 0xFFFF)]
    first = np.cumsum([0, *(len(t) + 2 for t in texts)])
    keep = np.ones(len(got), np.int8)
    keep[1:] = (got[1:] != 0) | (got[:-1] != 0)
    keep[first[:-1]] = ORDER
    at = np.concatenate(([0], np.cumsum(keep, dtype=np.int64)))
    return np.repeat(got, keep), at[first]


def _codes(text: str) -> np.ndarray:
    """Classes of the characters of one text, a blank before and after."""
    return _joined([text])[0][ORDER - 1 :]


def _grams(codes: np.ndarray) -> np.ndarray:
    """The number of the `ORDER` characters that end at each one; blanks stand before the first."""
    wide = np.concatenate((np.zeros(ORDER - 1, np.uint8), codes)).astype(np.int32)
    out = wide[: len(codes)]
    for k in range(1, ORDER):
        out = out * _SIZE + wide[k : k + len(codes)]
    return out


def _count(texts: Sequence[str]) -> np.ndarray:
    codes, starts = _joined(texts)
    counted = np.ones(len(codes), bool)
    counted[(starts[:-1, None] + np.arange(ORDER)).ravel()] = False
    return np.bincount(_grams(codes)[counted], minlength=_SIZE**ORDER)


def _bits(counts: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Bits of the last of each `order` characters after the others; each order backs off to the one below by a Dirichlet prior."""
    bits = np.full((1, _SIZE), 1 / _SIZE, np.float32)
    for n in range(1, order + 1):
        seen = counts.reshape(-1, _SIZE**n).sum(0).reshape(-1, _SIZE).astype(np.float32)
        bits = (seen + BACKOFF * np.tile(bits, (len(seen) // len(bits), 1))) / (seen.sum(1, keepdims=True) + BACKOFF)
    return -np.log2(bits).ravel()


def _slot_texts() -> list[str]:
    names = [s.replace("?", "").replace("[ _]\\w+", " name") for s in SLOTS.split("|")]
    return [*(a + n + b for a, b in BRACKETS for n in names), *REMINDERS]


class Localiser:
    """Likelihood ratios of each kind to prose, in eighths of a bit, for all runs of `ORDER` characters, and the labelling of texts by them."""

    names = ("prose", *KINDS, "slot", "unknown")

    def __init__(self, counts: dict[str, np.ndarray]):
        prose = _bits(counts["prose"])
        lead = [prose - _bits(counts[k]) for k in (*KINDS, "slot")]
        lead.append(prose - np.tile(_bits(counts["prose"], 1) + UNKNOWN_BITS, _SIZE ** (ORDER - 1)))
        self.lead = np.stack([np.clip(np.rint(8 * x), -127, 127).astype(np.int8) for x in lead])

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        """For each text the bits of its best window under each kind of `KINDS`, and under the slot model."""
        return _windows(self.lead[:-1], texts)

    def windows(self, texts: Sequence[str]) -> np.ndarray:
        """For each text the bits of its best window under any kind of `RESIDUE`, and under the slot model."""
        got = self.scores(texts)
        return np.stack([got[:, : len(RESIDUE)].max(1), got[:, -1]], axis=1)

    def labels(self, text: str) -> tuple[list[str], list[str]]:
        """Words of `text` and the label of each, by the cheapest path over the models."""
        words = _WORD.findall(text)
        if not words:
            return [], []
        codes = _codes(" ".join(words))
        starts = np.flatnonzero((codes[1:] != 0) & (codes[:-1] == 0)) + 1
        rows = np.add.reduceat(self.lead[:, _grams(codes)].astype(np.int32), starts, axis=1).T / 8
        n = len(self.names)
        cost, back = [0.0] * n, []
        for gain in rows.tolist():
            low = min(range(n), key=cost.__getitem__)
            step = [k if cost[k] <= cost[low] + SWITCH_BITS else low for k in range(n)]
            cost = [cost[p] + (SWITCH_BITS if p != k else 0) - (gain[k - 1] if k else 0) for k, p in enumerate(step)]
            back.append(step)
        at = min(range(n), key=cost.__getitem__)
        out = []
        for step in reversed(back):
            out.append(at)
            at = step[at]
        return words, [self.names[k] for k in reversed(out)]

    def covered(self, text: str, again: bool) -> tuple[str | None, float]:
        """The kind of residue that covers `text` but for a sentence, and its share; None and 0 for others.

        Texts are labelled slice by slice, until there is more prose than a residue document may hold, and as a whole if they
        may be a sentence over and over (`again`).
        """
        told: Counter = Counter()
        sentences = 0
        for part in [text] if again else _slices(text):
            words, labels = self.labels(part)
            if again:
                labels = _recurring(words, labels)
            told.update(label for w, label in zip(words, labels, strict=True) if _LETTERS.search(w))
            sentences += _sentences(words, labels)
            if told["prose"] + told["unknown"] > PROSE_WORDS or sentences > 1:
                return None, 0.0
        if told["slot"] and not PLACEHOLDER.search(text):
            told["filler"] += told.pop("slot")  # like a slot, but not of the form of one
        total, kinds = sum(told.values()), [k for k in RESIDUE if told[k]]
        share = 1 - (told["prose"] + told["unknown"]) / total if total else 0.0
        if not kinds or share < LEAST_COVERAGE:
            return None, 0.0
        return max(kinds, key=lambda k: told[k]), share

    def judge_all(self, texts: Sequence[str | None], scores: np.ndarray | None = None) -> list[tuple[str | None, float]]:
        """The residue of each document, if any, and the share of its words that residue and navigation cover; `scores` of the texts may be given."""
        out: list[tuple[str | None, float]] = [(None, 0.0)] * len(texts)
        filled = [k for k, t in enumerate(texts) if t and not t.isspace()]
        rows = self.scores([texts[k] for k in filled]) if scores is None else scores[filled]
        for k, best, slot in zip(filled, rows[:, : len(RESIDUE)].max(1), rows[:, -1], strict=True):
            text, again = texts[k], _recurs(texts[k])
            if best >= WINDOW_BITS or again:
                out[k] = self.covered(text, again)
            if not out[k][0] and slot >= SLOT_BITS and PLACEHOLDER.search(text):
                out[k] = ("placeholder", 0.0)
        return out

    def judge(self, text: str | None) -> tuple[str | None, float]:
        return self.judge_all([text])[0]


def _windows(lead: np.ndarray, texts: Sequence[str]) -> np.ndarray:
    """For each text the bits of its best window under each row of `lead`; texts are scored together, up to `SCAN` characters at once."""
    out = np.zeros((len(texts), len(lead)))
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= SCAN):
            size += len(texts[end])
            end += 1
        codes, starts = _joined(texts[at:end])
        grams = _grams(codes)
        for k, row in enumerate(lead):
            out[at:end, k] = _best(row, grams, starts) / 8
        at = end
    return out


def _best(lead: np.ndarray, grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The greatest sum of `lead` over a window of each text; texts lie one after the other from `starts` on, each begun with `ORDER` blanks that count for nothing."""
    out = np.zeros(len(starts) - 1)
    if len(out) == 1:  # perhaps a very long one
        run = 0
        for at in range(ORDER, len(grams), SCAN):
            sums = run + np.cumsum(lead[grams[at : at + SCAN]], dtype=np.int64)
            runs = sums - np.minimum(np.minimum.accumulate(sums), 0)
            out[0], run = max(out[0], runs.max()), int(runs[-1])
        return out
    steps = lead[grams].astype(np.int64)
    steps[(starts[:-1, None] + np.arange(ORDER)).ravel()] = -(1 << 30)  # no window reaches into the text before
    sums = np.cumsum(steps)
    return np.maximum.reduceat(sums - np.minimum.accumulate(sums), starts[:-1])


def _slices(text: str, size: int = SLICE) -> Iterator[str]:
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[at:end]
        at = end


def _stretches(codes: np.ndarray) -> np.ndarray:
    """For each character whether it lies in a run of `STRETCH` characters that occurs `REPEATS` times or more."""
    out = np.zeros(len(codes), bool)
    if len(codes) < STRETCH + REPEATS:
        return out
    n = len(codes) - STRETCH + 1
    keys = np.zeros(n, np.uint64)
    for k in range(STRETCH):
        keys = keys * np.uint64(1_000_003) + codes[k : k + n]
    _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    often = np.concatenate(([0], np.cumsum(counts[which] >= REPEATS)))
    place = np.arange(len(codes))
    return often[np.minimum(place + 1, n)] > often[np.clip(place - STRETCH + 1, 0, n)]


def _recurs(text: str) -> bool:
    """Whether one sentence stands in the text `REPEATS` times or more, beside at most one other."""
    words = text.split()
    if 3 * (len(set(words)) - PROSE_WORDS - 2) > len(words):  # too many words of which no three are the same
        return False
    times = Counter(s.lower() for s in _SENTENCES.split(text.strip()))
    most = max(times.values())
    return most >= REPEATS and times.total() - most <= 1


def _recurring(words: list[str], labels: list[str]) -> list[str]:
    """Labels with `filler` for prose in recurring stretches."""
    codes = _codes(" ".join(words))
    starts = np.flatnonzero((codes[1:] != 0) & (codes[:-1] == 0)) + 1
    again = np.minimum.reduceat(_stretches(codes) | (codes == 0), starts)
    return ["filler" if a and label in ("prose", "unknown") else label for a, label in zip(again, labels, strict=True)]


def _sentences(words: list[str], labels: list[str]) -> int:
    """Sentence ends among the words labelled prose; quotes and full stops inside one quote close a sentence together."""
    ends = 0
    for k, (w, label) in enumerate(zip(words, labels, strict=True)):
        if label == "prose" and len(w) > 1 and _ENDS.search(w):
            ends += not (k + 1 < len(words) and labels[k + 1] == "prose" and words[k + 1][0].islower())
    return ends


def _seeded(seeds: dict[str, np.ndarray], texts: Sequence[str]) -> np.ndarray:
    """Texts with a window of which most runs of `ORDER` characters stand in the list of one kind."""
    lead = np.stack([np.where(seeds[k] > 0, 8, -16).astype(np.int8) for k in (*KINDS, "slot")])
    return _windows(lead, texts).max(1) >= WINDOW_BITS


def _seed(kind: str) -> np.ndarray:
    return _count(_slot_texts()) if kind == "slot" else SEED_WEIGHT * _count(SEEDS[kind].strip().split("\n"))


def _seeds() -> dict[str, np.ndarray]:
    return {k: _seed(k) for k in (*KINDS, "slot")}


def _plain(seeds: dict[str, np.ndarray], texts: Sequence[str], least: float) -> list[str]:
    """Texts of `least` characters or more that are not much like a list."""
    return [t for t, odd in zip(texts, _seeded(seeds, texts), strict=True) if not (len(t) < least or odd)]


def _parts(text: str) -> set[str]:
    """The different sentences of a text."""
    return {s.lower() for s in _SENTENCES.split(text) if s.strip()}


def _lessons(localiser: Localiser, texts: Sequence[str], least: float) -> Iterator[tuple[str, str, str]]:
    """What each text teaches in a round: (use, kind, words).

    Texts that are neither short nor judged residue tell stories and teach prose, however much a window of them is like some
    residue: those of a rare language are, and in a large corpus their sentences come back. They give nothing here, as what
    they teach is what all texts hold less what the others do, each of which is set `aside`. `taught`: words that teach
    `kind`. `odd`: words like nothing known in residue of `kind`. `told`: a sentence of a story besides. `left`: a sentence
    of a text that is residue of `kind`, or short and perhaps so. `open`: a short text that teaches prose unless at least
    half of its sentences are learnt as residue. Texts under `least` characters are short.
    """
    scores = localiser.scores(texts)
    for text, row, (kind, _) in zip(texts, scores, localiser.judge_all(texts, scores), strict=True):
        if kind is None and len(text) >= least:
            continue
        yield "aside", "", text
        if kind == "placeholder":
            for m in PLACEHOLDER.finditer(text):
                yield "taught", "slot", m[0]
            text = PLACEHOLDER.sub(" ", text)
            for sentence in _parts(text):
                yield "told", "", sentence
            yield "taught", "prose", text
            continue
        best, likest = row[: len(RESIDUE)].max(), kind or RESIDUE[int(row[: len(RESIDUE)].argmax())]
        if kind or best >= WINDOW_BITS / 2:
            for sentence in _parts(text):
                yield "left", likest, sentence
        if kind:
            for part in _slices(text, SCAN):
                words, labels = localiser.labels(part)
                for label, run in itertools.groupby(zip(labels, words, strict=True), key=lambda x: x[0]):
                    together = " ".join(w for _, w in run)
                    yield ("odd", kind, together) if label == "unknown" else ("taught", label, together)
            continue
        words, labels = localiser.labels(text)
        if 2 * labels.count("prose") >= len(words):
            yield "open", "prose", text
        elif best >= WINDOW_BITS / 2 and _sentences(words, labels) <= 1:
            yield "taught", likest, text


def fit(texts: Sequence[str]) -> dict[str, np.ndarray]:
    """Counts of each model, learnt from `texts` without answers, starting from the general lists; `fit_table` does the same over a table.

    Prose starts as the texts that are neither unusually short nor much like a list. Each round labels the texts with the
    models of the round before. Those judged residue teach their kind what was labelled so, and what is like nothing known
    (`_shared`); short ones that are mostly like nothing known go to the kind they are likest. Sentences that come back in
    such texts, but not in prose, are learnt too (`_stock`). The others teach prose, slots cut out of them, short ones only if
    they are mostly like prose.
    """
    seeds = _seeds()
    least = float(np.median([len(t) for t in texts])) / 2 if len(texts) else 0.0
    counts = {**seeds, "prose": _count(_plain(seeds, texts, least))}
    everything, heard = _count(texts), Counter(s for t in texts for s in _parts(t))
    for _ in range(ROUNDS):
        localiser = Localiser(counts)
        taught: dict[str, list[str]] = {k: [] for k in localiser.names}
        left: dict[str, Counter] = {}
        told: set[str] = set()
        odd: dict[str, list[str]] = {k: [] for k in RESIDUE}
        undecided, aside = [], []
        for use, kind, words in _lessons(localiser, texts, least):
            if use == "aside":
                aside.append(words)
            elif use == "told":
                told.add(words)
            elif use == "left":
                left.setdefault(words, Counter())[kind] += 1
            elif use == "open":
                undecided.append(words)
            else:
                (odd if use == "odd" else taught)[kind].append(words)
        total = {k: _count(runs) for k, runs in odd.items()}
        for kind, runs in odd.items():
            for run in runs:
                taught[_shared(total, kind, run)].append(run)
        told.update((heard - Counter(s for t in aside for s in _parts(t))).keys())
        stock = _stock(left, told)
        taught["prose"] += [t for t in undecided if np.mean([s.lower() in stock for s in _SENTENCES.split(t)]) < 0.5]
        for sentence, kind in stock.items():
            taught[kind].append(sentence)
        counts = {k: _count(taught[k]) + (seeds[k] if k in seeds else everything - _count(aside)) for k in ("prose", *KINDS, "slot")}
    return counts


def _shared(counts: dict[str, np.ndarray], kind: str, run: str) -> str:
    """What a run of words like nothing known teaches: the kind of its text, or navigation if texts of other kinds hold the like (`counts` of all such runs)."""
    grams = _grams(_codes(run))
    return kind if counts[kind][grams].sum() >= 0.8 * sum(c[grams].sum() for c in counts.values()) else "navigation"


def _stock(left: dict[str, Counter], told: set[str]) -> dict[str, str]:
    """Sentences of at least `STOCK` texts that may be residue and of none that tells a story, and the kind of most of these texts; navigation if they are of several kinds."""
    out = {}
    for sentence, kinds in left.items():
        if sum(kinds.values()) >= STOCK and sentence.strip() and sentence not in told:
            kind, n = kinds.most_common(1)[0]
            out[sentence] = kind if n >= 0.8 * sum(kinds.values()) else "navigation"
    return out


def _sample(df: DataFrame, text: str) -> list[str]:
    """Texts of the smallest hashes, each once, for trying `fit` on one machine. Only hashes are shuffled and sorted."""
    body = F.col(f"`{text}`")
    usable = df.filter(F.length(body) <= SAMPLE_LENGTH).select(body.alias("text"), F.xxhash64(body).alias("h")).filter(F.trim("text") != "")
    hashes = [r["h"] for r in usable.select("h").distinct().orderBy("h").limit(SAMPLE).collect()]
    if not hashes:
        return []
    rows = usable.filter(F.col("h") <= max(hashes)).dropDuplicates(["h"]).collect()
    return [r["text"] for r in sorted(rows, key=lambda r: r["h"])]


#: Places that hold a count, in order, and the counts there.
Sparse = tuple[np.ndarray, np.ndarray]


class Models:
    """The counts of `fit`, sparse, so that they are small to send: their size is bounded by that of the tables. Tables are made once a worker."""

    def __init__(self, counts: dict[str, np.ndarray | Sparse]):
        self.counts = {k: c if isinstance(c, tuple) else _sparse(c) for k, c in counts.items()}

    @cached_property
    def full(self) -> dict[str, np.ndarray]:
        return {k: _dense(at, n) for k, (at, n) in self.counts.items()}

    @cached_property
    def localiser(self) -> Localiser:
        return Localiser({k: _dense(at, n) for k, (at, n) in self.counts.items()})


def _sparse(counts: np.ndarray) -> Sparse:
    at = np.flatnonzero(counts).astype(np.int32)
    return at, counts[at]


def _plus(a: Sparse, b: Sparse) -> Sparse:
    at = np.union1d(a[0], b[0])
    n = np.zeros(len(at), np.result_type(a[1], b[1]))
    for where, counts in (a, b):
        n[np.searchsorted(at, where)] += counts
    return at[n != 0], n[n != 0]


def _dense(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = np.zeros(_SIZE**ORDER, n.dtype)
    out[at] = n
    return out


class Tally:
    """Counts of each kind's runs of `ORDER` characters; texts wait until `SCAN` characters of a kind can be counted together."""

    schema = pa.schema([("kind", pa.string()), ("gram", pa.int32()), ("n", pa.int64())])

    def __init__(self):
        self.counts: dict[str, np.ndarray] = {}
        self.waiting: dict[str, list[str]] = {}
        self.size: Counter = Counter()

    def add(self, kind: str, text: str) -> None:
        self.waiting.setdefault(kind, []).append(text)
        self.size[kind] += len(text)
        if self.size[kind] >= SCAN:
            self._count(kind)

    def _count(self, kind: str) -> None:
        got = _count(self.waiting.pop(kind))
        self.size[kind] = 0
        if kind in self.counts:
            self.counts[kind] += got
        else:
            self.counts[kind] = got

    def batches(self) -> Iterator[pa.RecordBatch]:
        for kind in [*self.waiting]:
            self._count(kind)
        for kind, counts in self.counts.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], schema=self.schema)


_TALLY = "kind string, gram int, n bigint"


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of rows (kind, words)."""
    tally = Tally()
    for batch in batches:
        for kind, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            tally.add(kind, words)
    yield from tally.batches()


def _totals(parts: Sequence[DataFrame], kinds: Sequence[str]) -> dict[str, Sparse]:
    """Counts by kind, summed over all rows of `parts`; as many rows come to the driver as there are different runs of `ORDER` characters."""
    got = reduce(DataFrame.unionAll, parts).groupBy("kind", "gram").agg(F.sum("n").alias("n")).toArrow()
    out = {}
    for k in kinds:
        part = got.filter(pc.equal(got.column("kind"), k)).sort_by("gram")
        out[k] = (part.column("gram").to_numpy(), part.column("n").to_numpy())
    return out


def _digest(text: str) -> bytes:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _learn(texts: DataFrame, heard: DataFrame, counts: dict[str, Sparse], least: float) -> dict[str, Sparse]:
    """One round of `fit` over a table of different texts, less the lists and what texts set aside do not teach.

    Sentences meet by digests; `heard` says of those in at least `STOCK` texts in how many they are. Only what short texts
    and residue give is kept on disk meanwhile.
    """
    context = texts.sparkSession.sparkContext
    fitted = context.broadcast(Models(counts))
    fields = pa.schema([("use", pa.string()), ("kind", pa.string()), ("words", pa.string()), ("digest", pa.binary()), ("gram", pa.int32()), ("n", pa.int64())])

    def teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            rows = []
            for use, kind, words in _lessons(fitted.value.localiser, batch.column(0).to_pylist(), least):
                if use == "taught":
                    tally.add(kind, words)
                elif use == "aside":
                    tally.add(use, words)
                    rows += [{"use": use, "digest": _digest(s)} for s in _parts(words)]
                elif use == "told":
                    rows.append({"use": use, "digest": _digest(words)})
                else:
                    rows.append({"use": use, "kind": kind, "words": words, "digest": None if use == "odd" else _digest(words)})
            yield pa.RecordBatch.from_pylist(rows, schema=fields)
        for part in tally.batches():
            none = pa.nulls(part.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(["taught"] * part.num_rows, pa.string()), part.column(0), none, none.cast(pa.binary()), part.column(1), part.column(2)], schema=fields)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts = _SENTENCES.split(text)
                rows += [{"id": key, "digest": _digest(s.lower()), "sentences": len(parts)} for s in parts]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("id", pa.binary()), ("digest", pa.binary()), ("sentences", pa.int32())]))

    lessons = texts.mapInArrow(teach, "use string, kind string, words string, digest binary, gram int, n bigint").persist(StorageLevel.DISK_ONLY)
    odd, told, left, undecided, aside = (lessons.filter(F.col("use") == use) for use in ("odd", "told", "left", "open", "aside"))
    known = context.broadcast(Models(_totals([odd.select("kind", "words").mapInArrow(_tallied, _TALLY)], RESIDUE)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            for kind, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tally.add(_shared(known.value.full, kind, words), words)
        yield from tally.batches()

    again = left.groupBy("digest", "kind").agg(F.count("*").alias("n")).groupBy("digest").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("kind", "n").alias("kind")).filter(F.col("n") >= STOCK)
    elsewhere = heard.join(aside.groupBy("digest").agg(F.count("*").alias("aside")), "digest", "left").filter(F.col("texts") > F.coalesce("aside", F.lit(0)))
    stock = again.join(told.select("digest").union(elsewhere.select("digest")).distinct(), "digest", "left_anti")
    stock = stock.select("digest", F.when(F.col("most") >= 0.8 * F.col("n"), F.col("kind")).otherwise("navigation").alias("kind")).persist(StorageLevel.DISK_ONLY)
    sentences = left.select("digest", "words").join(stock, "digest").groupBy("digest").agg(F.min("kind").alias("kind"), F.min("words").alias("words"))
    parts = undecided.select("digest", "words").mapInArrow(split, "id binary, digest binary, sentences int")
    dull = parts.join(stock.select("digest"), "digest", "left_semi").groupBy("id", "sentences").agg(F.count("*").alias("n")).filter(2 * F.col("n") >= F.col("sentences")).select(F.col("id").alias("digest"))
    prose = undecided.join(dull, "digest", "left_anti")
    taught = lessons.filter("use = 'taught'").select("kind", "gram", "n")
    counted = [part.select("kind", "words").mapInArrow(f, _TALLY) for part, f in ((odd, assign), (sentences, _tallied), (prose, _tallied))]
    try:
        return _totals([taught, *counted], ("prose", *KINDS, "slot", "aside"))
    finally:
        stock.unpersist()
        lessons.unpersist()
        known.destroy()
        fitted.destroy()


def fit_table(df: DataFrame, text: str = "text") -> dict[str, Sparse]:
    """`fit` over all texts of a table, each once, whatever their number and length; nothing but counts comes to the driver."""
    body = F.col(f"`{text}`")
    texts = df.select(body.alias("text")).filter(F.trim("text") != "").distinct().persist(StorageLevel.DISK_ONLY)
    least = (texts.agg(F.percentile(F.length("text"), F.lit(0.5))).first()[0] or 0.0) / 2
    seeds = {k: _sparse(_seed(k)) for k in (*KINDS, "slot")}

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, tally = _seeds(), Tally()
        for batch in batches:
            every = batch.column(0).to_pylist()
            for t in _plain(lists, every, least):
                tally.add("prose", t)
            for t in every:
                tally.add("all", t)
        yield from tally.batches()

    def sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_digest(s) for t in batch.column(0).to_pylist() for s in _parts(t)], pa.binary())], ["digest"])

    heard = texts.mapInArrow(sentences, "digest binary").groupBy("digest").agg(F.count("*").alias("texts")).filter(F.col("texts") >= STOCK).persist(StorageLevel.DISK_ONLY)
    try:
        first = _totals([texts.mapInArrow(begin, _TALLY)], ("prose", "all"))
        everything = first.pop("all")
        counts = {**seeds, **first}
        for _ in range(ROUNDS):
            got = _learn(texts, heard, counts, least)
            at, n = got.pop("aside")
            plain = _plus(everything, (at, -n))
            counts = {k: _plus(c, seeds[k] if k in seeds else plain) for k, c in got.items()}
    finally:
        heard.unpersist()
        texts.unpersist()
    return counts


def _ship(df: DataFrame, text: str) -> Broadcast:
    return df.sparkSession.sparkContext.broadcast(Models(fit_table(df, text)))


def mark_residue(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`(<key>, residue STRING, coverage DOUBLE)` for every row: `residue` is null for sound texts, else `placeholder`, `filler`, `error_page` or `script_notice`.

    `coverage` is the share of words that residue and navigation cover in documents excluded for it, 0 for others. Null, empty
    and blank texts are sound; repeated rows are judged each; whole texts are read; other columns are ignored. The models are
    fitted on all different texts of the table; an empty table gives no rows.
    """
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    fitted = _ship(df, text)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = fitted.value.localiser.judge_all(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([k for k, _ in got], pa.string()), pa.array([c for _, c in got], pa.float64())], ["key", "residue", "coverage"])

    return spread(rows).mapInArrow(judge, f"key {kind}, residue string, coverage double").withColumnRenamed("key", key)


def without_residue(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `df` whose text holds no residue, with all their columns; one pass, no join, no key needed."""
    fitted, at = _ship(df, text), df.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sound = [k is None for k, _ in fitted.value.localiser.judge_all(batch.column(at).to_pylist())]
            yield batch.filter(pa.array(sound, pa.bool_()))

    return spread(df).mapInArrow(keep, df.schema)
