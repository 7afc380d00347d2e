"""Broken prompt and response pairs, by ordered rules (problem 6)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotmill.session import spread

# Words that as a whole response stand for nothing.
NOTHINGS = frozenset(
    "none|null|nil|nan|n a|na|tbd|tba|tbc|todo|empty|blank|missing|nothing|undefined|no story|no output|no text|no response|no answer|no content|"
    "no result|story|response|output|not available|not applicable|empty response|empty string|story missing|no data|none given|none provided".split("|")
)

# Frequent words of each language that are rare or absent in the others.
FUNCTION_WORDS = {
    "en": "the and of to was were with that had she his her from at by an it for not only or but who what this is are when than near there you your about into every he they them their been where which between behind under over after before",
    "de": "der die das und den dem des ein eine einen einem einer nicht mit von im zum zur ist war hatte sich auf aber doch denn nach bei unter hinter ohne vor dass wird wie sie ihr wo",
    "fr": "le les des du une et est dans pour pas qui sur avec sous au aux elle mais était avait ce cette puis car près derrière sans avant que où ses la un",
    "es": "el los las del una y en con por para pero que su sus al como más fue era había desde sin junto antes tras cuando donde porque luego no muy la un lo",
    "it": "il lo gli della dello delle dei degli del di e nel nella con per ma che sono era aveva poi sotto dietro senza prima dopo perché al alla uno una la un dal si",
}
_LISTS = {lang: frozenset(text.split()) for lang, text in FUNCTION_WORDS.items()}
#: "Nearly all" in another language: at least so many of its function words, and at most this share of the prompt's.
LEAST_HITS, MOST_OWN = 3, 0.2

#: Sentences of another kind than below are narrative; a refusal, of whatever length, holds at most one of under `TOLD_LENGTH` characters, or this share of its sentences and characters.
TOLD_SHARE, TOLD_LENGTH = 0.2, 120
_APOSTROPHE = str.maketrans({"’": "'", "‘": "'", "ʼ": "'", "´": "'"})

# Phrases that decline, by language.
_DECLINES = re.compile(
    r"""\b(?:
      i(?:\ must|'m\ going\ to|\ have\ to|'ll\ have\ to|\ need\ to|\ would\ rather|'d\ rather|\ will|\ am\ going\ to)?\ (?:respectfully\ |politely\ )?(?:decline|refuse|pass\ on|opt\ out)
     |i\ (?:really\ |simply\ |just\ )?(?:cannot|can't|can\ not|won't|will\ not|could\ not|couldn't|do\ not|don't)\ (?:in\ good\ conscience\ )?(?:be\ able\ to\ |feel\ able\ to\ |feel\ comfortable\ )?
       (?:help|assist|write|writing|continue|create|creating|generate|generating|produce|producing|provide|providing|comply|fulfil|fulfill|complete|do\ (?:that|this)|go\ (?:on|along)|engage|support|answer|respond|tell|describe|proceed|take\ part|offer|craft|compose|share|draft)
     |i(?:'m|\ am)\ (?:really\ |very\ |so\ |truly\ )?(?:unable|not\ able|not\ willing|not\ allowed|not\ permitted|not\ comfortable|not\ in\ a\ position|sorry|afraid|only\ an?\ (?:ai|assistant|language))
     |i\ (?:won't|will\ not|do\ not|don't|may\ not)\ (?:be\ able|feel\ able|feel\ comfortable|think\ i\ (?:can|should))
     |i\ apologi[sz]e
     |(?:it|this|that)\ (?:would|might|may)\ (?:be|not\ be)\ (?:in)?appropriate\ for\ me
     |(?:this|that)\ is\ not\ something\ i\ (?:can|could|will|am)
     |(?:that|this)(?:\ request)?\ (?:goes|is)\ (?:against|beyond|outside)\ (?:my|what\ i)
     |as\ an?\ (?:ai|artificial|language\ model|assistant|writing\ assistant)\b
     |(?:es\ tut\ mir\ leid|tut\ mir\ leid|leider\ kann\ ich|ich\ kann\ (?:das|dies|diese[nrsm]?|ihnen|dir|dabei|hier)?|ich\ darf\ nicht|ich\ muss\ (?:leider\ )?ablehnen|als\ (?:ki|sprachmodell|assistent))
     |(?:je\ suis\ désolée?|désolée?|je\ ne\ (?:peux|puis|suis)|je\ refuse|je\ dois\ (?:refuser|décliner)|en\ tant\ qu[e'])
     |(?:lo\ siento|no\ puedo|me\ disculpo|lamento|no\ me\ es\ posible|debo\ (?:rechazar|negarme)|como\ (?:modelo|asistente|una?\ ia))
     |(?:mi\ dispiace|non\ posso|spiacente|non\ sono\ in\ grado|devo\ rifiutare|in\ quanto\ (?:ia|assistente|modello)|purtroppo\ non)
    )""",
    re.X | re.I,
)
# Other sentences a refusal may hold.
_AROUND = re.compile(
    r"""^(?:\W*(?:assistant|ai|response|answer|story|output)\W+)?(?:
      sure|certainly|of\ course|here\ is|here's|okay|ok\b|thank|thanks|understood|hello|hi\b|i\ (?:appreciate|understand|hope|could|can\ (?:offer|suggest|help)|would\ be|am\ happy|'d|d\b|must\ be)|i'd|i'm\ happy
     |(?:is|would|could|may|can|do|shall|what)\b[^.]*\?|(?:please|perhaps|maybe|instead|let\ me\ know|if\ you|feel\ free|let's|try|another|a\ gentler|unfortunately|regretfully|regrettably|sorry|however)
     |gerne|natürlich|bitte|vielleicht|möchten|kann\ ich|bien\ sûr|voici|veuillez|peut-être|souhaitez|puis-je|claro|por\ supuesto|aquí|por\ favor|quizás?|tal\ vez|puedo|¿|certo|ecco|forse|vuoi|posso|per\ favore|prova
    )""",
    re.X | re.I,
)
_WORD = re.compile(r"[^\W_]+")
_ITEM = re.compile(r"\s*(?:[-*•‣◦▪]|\(?\d+[.)])(?:\s|$)")
_TERMINAL = re.compile(r"(?:[.!?…。！？؟।][\"'”’»«)\]}*_~]*|[\"”»)\]]|\*{1,3}|~|—\s*(?:end|fin|ende|fine)\W*)\s*$", re.I)
_SENTENCES = re.compile(r"(?<=[.!?…])[\"'”’»)\]]*\s+|\n+")
_ZERO_WIDTH = re.compile("[\u200b-\u200f\u2060\ufeff\u00ad]")
_SCRIPTS = (
    ("cyrillic", "Ѐ", "ԯ"), ("greek", "Ͱ", "Ͽ"), ("hebrew", "\u0590", "\u05ff"), ("arabic", "\u0600", "ۿ"), ("devanagari", "ऀ", "ॿ"),
    ("thai", "\u0e00", "\u0e7f"), ("hangul", "가", "\ud7af"), ("kana", "\u3040", "ヿ"), ("han", "一", "鿿"),
)
_FOREIGN = re.compile("[" + "".join(f"{a}-{b}" for _, a, b in _SCRIPTS) + "]")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def script(text: str) -> str:
    """The script of most letters; Latin unless most are of another."""
    found = _FOREIGN.findall(text)
    if not found or 2 * len(found) < sum(map(str.isalpha, text)):
        return "latin"
    counts = {name: sum(a <= c <= b for c in found) for name, a, b in _SCRIPTS}
    if counts["kana"]:
        return "kana"
    return max(counts, key=lambda n: counts[n])


def language(tokens: list[str]) -> str | None:
    """The language whose function words are the most frequent; None with fewer than two of them or a tie."""
    hits = sorted(((sum(w in ws for w in tokens), lang) for lang, ws in _LISTS.items()), reverse=True)
    return hits[0][1] if hits[0][0] >= 2 and hits[0][0] > hits[1][0] else None


def is_empty(story: str | None) -> bool:
    if story is None:
        return True
    if len(story) > 60:
        return not any(map(str.isalnum, story))
    tokens = words(_ZERO_WIDTH.sub("", story))
    return not tokens or " ".join(tokens) in NOTHINGS


def _sentences(text: str) -> list[tuple[str, bool]]:
    """Sentences, and whether each begins a line."""
    out, at, fresh = [], 0, True
    for m in _SENTENCES.finditer(text):
        if text[at : m.start()].strip():
            out.append((text[at : m.start()], fresh))
            fresh = False
        fresh |= "\n" in m[0]
        at = m.end()
    return [*out, (text[at:], fresh)] if text[at:].strip() else out


def is_refusal(story: str) -> bool:
    """All of it declines: sentences outside quotes refuse, are a courtesy around a refusal or items of a list after one, but for `TOLD_SHARE`."""
    text = story.translate(_APOSTROPHE)
    sentences = _sentences(text)
    declined = listed = False
    told = length = 0
    most, longest = (max(1, TOLD_SHARE * len(sentences)), max(TOLD_LENGTH, TOLD_SHARE * len(text))) if len(sentences) > 1 else (0, 0)
    for k, (s, fresh) in enumerate(sentences):
        if fresh:
            listed = declined and _ITEM.match(s) is not None
        if _DECLINES.search(s):
            declined = True
        elif not (listed or _AROUND.match(s.strip(" \t*_>-#\"'"))):
            if declined and s.rstrip(" \t*_").endswith(":") and k + 1 < len(sentences) and sentences[k + 1][1] and _ITEM.match(sentences[k + 1][0]):
                continue  # leads to a list
            told, length = told + 1, length + len(s)
            if told > most or length >= longest or any(c in s for c in '"“”'):
                return False
    body = re.sub(r"\s+", " ", _ZERO_WIDTH.sub("", story)).strip().translate(_APOSTROPHE)
    m = _DECLINES.search(body)
    return m is not None and body[:1] not in "\"“„«" and '"' not in body[: m.start()]


#: A response may add so many words, or one sentence, to the prompt before it and after it and is still an echo; so many words of a prompt of one line count as its heading.
ECHO_BEFORE, ECHO_AFTER, ECHO_HEADING = 25, 45, 8


def heading(prompt: str) -> int:
    """Words of the line that leads to a list of items."""
    first, _, rest = prompt.strip().partition("\n")
    return len(words(first)) if _ITEM.match(rest.lstrip()) and not _ITEM.match(first) else 0


def is_echo(prompt: list[str], story: list[str], raw: str, lead: int = 0) -> bool:
    """The words of the prompt in order, with or without its heading (`lead` words, or `ECHO_HEADING`), and at most one sentence besides; all of them if there are under four."""
    if len(prompt) < 4:
        return bool(prompt) and prompt == story
    most = min(max(ECHO_HEADING, lead), len(prompt) - 4)
    text = " " + " ".join(story) + " "
    if " " + " ".join(prompt[most:]) + " " not in text:
        return False
    for skip in range(most + 1):
        at = text.find(" " + " ".join(prompt[skip:]) + " ")
        if at >= 0:
            before = text[:at].count(" ")
            after = len(story) - before - (len(prompt) - skip)
            if len(story) < 0.5 * len(prompt) and skip != lead:
                return False
            return (before <= ECHO_BEFORE or _one_sentence(raw, 0, before)) and (after <= ECHO_AFTER or _one_sentence(raw, len(story) - after, len(story)))
    return False


def _one_sentence(raw: str, first: int, last: int) -> bool:
    """Whether the words `first` to `last` of a text are of one sentence."""
    low = raw.lower()
    spans = [m.span() for m in _WORD.finditer(low)]
    part = low[spans[first][0] : spans[last - 1][1]]
    return sum(bool(_WORD.search(s)) for s in _SENTENCES.split(part)) <= 1


def is_truncated(story: str) -> bool:
    body = _ZERO_WIDTH.sub("", story).rstrip() if _ZERO_WIDTH.search(story) else story.rstrip()
    if not _TERMINAL.search(body[-12:]):
        return True
    if body.count("“") > body.count("”") and body.rfind("“") > body.rfind("”"):
        return True
    if body.count("(") > body.count(")") and body.rfind("(") > body.rfind(")"):
        return True
    if body[-1] in '"“' and body[-2:-1].isspace():
        return True
    return body.count('"') % 2 == 1 and _open_quote(body)


def _open_quote(body: str) -> bool:
    """The last straight quote opens: a blank or the start before it and text after it, none closing it."""
    at = body.rfind('"')
    return at < len(body) - 1 and (at == 0 or body[at - 1] in " \n\t([—–-") and not body[at + 1].isspace()


def is_other_language(prompt: str, prompt_words: list[str], story: str, story_words: list[str]) -> bool:
    if not prompt_words:
        return False
    if (own := script(story)) != (asked := script(prompt)):
        return {own, asked} != {"han", "kana"}
    here, there = language(story_words), language(prompt_words)
    if here is None or there is None or here == there:
        return False
    foreign, own = _LISTS[here] - _LISTS[there], _LISTS[there] - _LISTS[here]
    n, m = sum(w in foreign for w in story_words), sum(w in own for w in story_words)
    return n >= LEAST_HITS and m <= MOST_OWN * (n + m)


def defects(prompt: str | None, story: str | None) -> list[str]:
    """Every defect whose rule fires, in the order of the rules."""
    if is_empty(story):
        return ["empty"]
    assert story is not None
    found, asked, told = [], words(prompt or ""), words(story)
    if is_refusal(story):
        found.append("refusal")
    if is_echo(asked, told, story, heading(prompt or "")):
        found.append("echo")
    if is_other_language(prompt or "", asked, story, told):
        found.append("language")
    if is_truncated(story):
        found.append("truncated")
    return found


def flag_pairs(df: DataFrame, prompt: str, story: str, key: str = "record_id") -> DataFrame:
    """Defects of prompt and response pairs: `(<key>, defect STRING, rank BIGINT)`, a row for each rule that fires, `rank` from 1 in rule order.

    Null, absent, blank and stand-in responses are `empty` whatever the prompt; a null prompt leaves the rules that need it
    (echo, language) silent. Repeated rows are judged each; whole texts are read; other columns are ignored.
    """
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{prompt}`").alias("prompt"), F.col(f"`{story}`").alias("story"))
    kind = rows.schema["key"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, names, ranks = [], [], []
            for i, (p, s) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                for k, name in enumerate(defects(p, s)):
                    at.append(i)
                    names.append(name)
                    ranks.append(k + 1)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(names, pa.string()), pa.array(ranks, pa.int64())], ["key", "defect", "rank"])

    return spread(rows).mapInArrow(judge, f"key {kind}, defect string, rank bigint").withColumnRenamed("key", key)
