"""Noise in text read from page images: divided words, misread characters, running headers, page numbers (problem 2).

Three parts work on each text: lines are told apart into text and page furniture by what they look like and where they stand;
words divided at line ends are joined; and a character editor, an averaged perceptron over keep, replace, delete, insert and
line-join operations, repairs misread words. The editor is trained on words of the corpus itself to which scan errors were
applied; its lexicon holds the counts of all texts. A word's repair does not depend on its place, so workers remember it.
"""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotmill.session import spread

# What a scanner reads for what is printed.
MISREADINGS = (
    ("o", "0"), ("l", "1"), ("i", "1"), ("s", "5"), ("g", "9"), ("b", "6"), ("z", "2"), ("b", "8"), ("e", "c"), ("c", "e"), ("h", "b"), ("b", "h"), ("t", "f"), ("f", "t"),
    ("i", "l"), ("l", "i"), ("n", "u"), ("u", "n"), ("d", "cl"), ("u", "ii"), ("m", "rn"), ("m", "nn"), ("w", "vv"), ("li", "h"), ("h", "li"), ("rn", "m"), ("cl", "d"), ("nn", "m"), ("n", "ri"), ("a", "o"), ("y", "v"),
    ("nn", "rm"), ("mn", "rrm"), ("d", "c1"), ("el", "d"), ("di", "ch"), ("lu", "hi"), ("in", "m"), ("ni", "m"), ("fi", "ﬁ"), ("ti", "ﬁ"), ("fl", "ﬂ"), ("ff", "ﬀ"),
)
#: Words the editor is trained on, and how often.
TRAIN_WORDS, EPOCHS = 2500, 3
#: Share of words it also meets with a letter lost, added or read as any other.
SMUDGED = 0.25
#: What an edit that is no known misreading costs at least.
LEAST_COST = -1.0
#: Level of words that are usual: those that repairs lead to, at most 160,000 whatever the corpus.
USUAL = 4
#: The lexicon holds words of at least this share of all words, so it has at most a million entries, whatever the corpus.
LEAST_SHARE = 1e-6

_WORD = re.compile(r"[^\W_]+")
_TOKEN = re.compile(r"[^\W_]+(?:-[^\W_]+)*")
_NUMERAL = re.compile(r"\d+(?:st|nd|rd|th|s)?")
_HYPHENS = "-‐‑¬\u00ad"
_LIGATURES = frozenset("ﬀﬁﬂ")
_WIDTHS = sorted({len(wrong) for _, wrong in MISREADINGS}, reverse=True)
_REPAIRS: dict[str, list[str]] = {}
for _right, _wrong in MISREADINGS:
    _REPAIRS.setdefault(_wrong, []).append(_right)


@dataclass
class Lexicon:
    """Word counts of the corpus; frequencies are relative, so that they mean the same at every size."""

    counts: dict[str, int]
    total: int

    def level(self, word: str) -> int:
        """0 for unknown words, else 1 and more, a step for each factor of four."""
        n = self.counts.get(word, 0)
        return 1 + max(0, int(math.log2(n * 1e7 / self.total) / 2)) if n else 0


def count_words(texts: DataFrame, column: str) -> Lexicon:
    """Counts over all texts of lower-case words and hyphenated compounds; partial counts are summed before they are shuffled."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(_TOKEN.findall(text.lower()))
            if len(counts) > 500_000:
                yield _counted(counts)
                counts = Counter()
        yield _counted(counts)

    def _counted(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    parts = texts.filter(F.col(column).isNotNull()).select(column).mapInArrow(tally, "word string, n bigint")
    sums = parts.groupBy("word").agg(F.sum("n").alias("n")).cache()
    total = sums.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t")).first()["t"]
    kept = {r["word"]: r["n"] for r in sums.filter(F.col("n") >= LEAST_SHARE * total).collect()}
    sums.unpersist()
    return Lexicon(kept, max(total, 1))


Edit = tuple[int, str, str]  # place, what stands there, what should
_READ = {(wrong, right) for right, wrong in MISREADINGS}


def edits_at(word: str) -> list[Edit]:
    return [(i, wrong, right) for i in range(len(word)) for n in _WIDTHS for wrong in (word[i : i + n],) for right in _REPAIRS.get(wrong, ()) if i + n <= len(word)]


def apply(word: str, edits: tuple[Edit, ...]) -> str:
    out, at = [], 0
    for i, wrong, right in edits:
        out += word[at:i], right
        at = i + len(wrong)
    return "".join([*out, word[at:]])


def operations(edit: Edit) -> list[tuple[int, str, str]]:
    """An edit as character operations: replace, and delete or insert where the lengths differ."""
    i, wrong, right = edit
    same = min(len(wrong), len(right))
    out = [(i + k, "replace", wrong[k] + right[k]) for k in range(same) if wrong[k] != right[k]]
    out += [(i + k, "delete", wrong[k]) for k in range(same, len(wrong))]
    return out + [(i + same, "insert", c) for c in right[same:]]


@dataclass
class Editor:
    """Averaged perceptron over character operations: at each place of a word keep, replace, delete or insert, scored by the operation, its neighbours and what the lexicon says of the result."""

    lexicon: Lexicon
    weights: dict[str, float] = field(default_factory=dict)
    kept: dict[str, str | None] = field(default_factory=dict)
    lifts: dict[tuple[int, int], float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.usual = {w for w in self.lexicon.counts if self.lexicon.level(w) >= USUAL and w.isalpha()}
        self.prefixes = {w[:k] for w in self.usual for k in range(len(w) + 1)}
        self.letters = sorted({c for w in self.usual for c in w})
        self.longest = max(map(len, self.lexicon.counts), default=0)
        self.top = max(map(self.lexicon.level, self.usual), default=USUAL)

    def places(self, word: str, edit: Edit) -> list[str]:
        """The features of one edit: for a known misreading its operations and their neighbours, for any other its kind and place."""
        i, wrong, right = edit
        if (wrong, right) in _READ:
            padded = "^" + word + "$"
            out = []
            for place, kind, what in operations(edit):
                name = f"{kind}:{what}"
                out += [name, f"{name}<{padded[place]}", f"{name}>{padded[min(place + 2, len(padded) - 1)]}"]
            return out
        kind = "insert" if not wrong else "replace" if right else "delete"
        where = "first" if i == 0 else "last" if i + len(wrong) >= len(word) else "inner"
        return ["other", f"other:{kind}", f"other:{where}", f"other:{kind},{where}", f"other:size{min(len(word), 9)}"]

    def whole(self, word: str, fixed: str, n: int, level: int) -> list[str]:
        """The features of a word and what it is to become, by `n` edits."""
        to = self.lexicon.level(fixed)
        digits = any(c.isdigit() for c in word), any(c.isdigit() for c in fixed)
        return [f"levels:{level},{to}", f"gain:{max(-3, min(6, to - level))}", f"known:{to > 0}", f"edits:{min(n, 4)}", f"digits:{digits}", f"size:{min(len(word), 5)},{to > 0}"]

    def features(self, word: str, edits: tuple[Edit, ...], level: int) -> list[str]:
        if not edits:
            return []
        return [f for e in edits for f in self.places(word, e)] + self.whole(word, apply(word, edits), len(edits), level)

    def score(self, features: list[str]) -> float:
        return sum(self.weights.get(f, 0.0) for f in features)

    def worth(self, word: str, edit: Edit) -> float:
        """The score of one edit; one that is no known misreading never gains, so that a search ends."""
        s = self.score(self.places(word, edit))
        return s if edit[1:] in _READ else min(s, LEAST_COST)

    def total(self, word: str, edits: tuple[Edit, ...], level: int) -> float:
        return sum(self.worth(word, e) for e in edits) + self.score(self.whole(word, apply(word, edits), len(edits), level))

    def lift(self, level: int, size: int) -> float:
        """The most that the features of whole words can add where a word of a level and size becomes a usual one."""
        if (level, size) not in self.lifts:
            w = self.weights.get
            rise = max(w(f"levels:{level},{to}", 0.0) + w(f"gain:{max(-3, min(6, to - level))}", 0.0) for to in range(USUAL, self.top + 1))
            most = [max([0.0, *(v for f, v in self.weights.items() if f.startswith(g))]) for g in ("edits:", "digits:")]
            self.lifts[level, size] = rise + w("known:True", 0.0) + w(f"size:{size},True", 0.0) + sum(most)
        return self.lifts[level, size]

    def singles(self, word: str) -> list[Edit]:
        """Edits that are no known misreadings and lead to a usual word at once."""
        out = []
        for i in range(len(word) + 1):
            head, rest, tail = word[:i], word[i:], word[i + 1 :]
            if head not in self.prefixes:
                break
            out += [(i, "", c) for c in self.letters if head + c + rest in self.usual]
            if rest:
                out += [(i, rest[0], c) for c in self.letters if c != rest[0] and (rest[0], c) not in _READ and head + c + tail in self.usual]
                if head + tail in self.usual:
                    out.append((i, rest[0], ""))
        return out

    def candidates(self, word: str, level: int) -> list[tuple[Edit, ...]]:
        """What the editor is trained against: single edits, and pairs of known misreadings."""
        places = edits_at(word)
        out: list[tuple[Edit, ...]] = [(e,) for e in places]
        if level < USUAL:
            out += [c for c in itertools.combinations(places, 2) if c[0][0] + len(c[0][1]) <= c[1][0] and apply(word, c) in self.usual]
            out += [(e,) for e in self.singles(word)]
        return out

    def search(self, word: str, level: int, known: list[Edit]) -> tuple[Edit, ...]:
        """The best scored set of edits, however many, that leads to a usual word; none if keeping the word scores at least as well.

        Words are built letter by letter along the prefixes of usual words. A branch is left only when even the best features
        of whole words could not lift it over the best result so far, so the search is exact. A word may have any number of
        known misreadings, and one other edit.
        """
        n, lift = len(word), self.lift(level, min(len(word), 5))
        ops: list[list[tuple[Edit, float]]] = [[] for _ in range(n + 1)]
        for e in known:
            ops[e[0]].append((e, self.worth(word, e)))
        rest = [0.0] * (n + 2)
        for i in range(n - 1, -1, -1):
            rest[i] = rest[i + 1] + max([0.0, *(s for _, s in ops[i])])
        free = level < USUAL
        least = level + 3 if level > 1 else 0  # a known word gives way to a far more usual one only
        costs = [[self.worth(word, (i, wrong, right)) for wrong, right in (("", "\0"), (word[i : i + 1], "\0"), (word[i : i + 1], ""))] for i in range(n + 1)] if free else []
        top: tuple[Edit, ...] = ()
        most = 0.0
        stack: list[tuple[int, str, float, tuple[Edit, ...], bool]] = [(0, "", 0.0, (), free)]
        while stack:
            i, made, got, edits, free = stack.pop()
            if got + rest[i] + lift <= most:
                continue
            if i == n and edits and made in self.usual and self.lexicon.level(made) >= least:
                total = self.total(word, edits, level)
                if total > most:
                    top, most = edits, total
            for e, s in ops[i]:
                if made + e[2] in self.prefixes:
                    stack.append((i + len(e[1]), made + e[2], got + s, (*edits, e), free))
            if free:
                for k, wrong in enumerate(("", word[i]) if i < n else ("",)):
                    j, s = i + k, costs[i][k]
                    if got + s + rest[j] + lift > most:
                        stack += [(j, made + c, got + s, (*edits, (i, wrong, c)), False) for c in self.letters if made + c in self.prefixes and c != wrong and (wrong, c) not in _READ]
                if i < n and got + (s := costs[i][2]) + rest[i + 1] + lift > most:
                    stack.append((i + 1, made, got + s, (*edits, (i, word[i], "")), False))
            if i < n and made + word[i] in self.prefixes:
                stack.append((i + 1, made + word[i], got, edits, free))
        return top

    def best(self, word: str) -> tuple[Edit, ...]:
        """The operations to carry out on a lower-case word; none if keeping it scores at least as well."""
        level = self.lexicon.level(word)
        known = edits_at(word)
        top = self.search(word, level, known)
        most = self.total(word, top, level) if top else 0.0
        # other words than usual ones are reached by the best misreading of each sign that is no letter, or by a single one
        signs = [max(es, key=lambda e: self.worth(word, e)) for _, g in itertools.groupby((e for e in known if not e[1].isalpha() or e[1] in _LIGATURES), key=lambda e: e[0]) if (es := list(g))]
        apart = tuple(b for k, b in enumerate(signs) if not k or signs[k - 1][0] + len(signs[k - 1][1]) <= b[0])
        singles = ((e,) for e in known if len(word) + len(e[2]) - len(e[1]) <= self.longest and self.lexicon.level(apply(word, (e,))))
        for c in [apart, *singles]:
            if c and (level < 2 or self.lexicon.level(apply(word, c)) >= level + 3) and (s := self.total(word, c, level)) > most:
                top, most = c, s
        return top

    def repair(self, word: str) -> str | None:
        """The repaired form of a lower-case word, or None if it stays."""
        if word in self.kept:
            return self.kept[word]
        got, at = None, word
        # the lexicon also holds frequent misreadings, so a repaired word may need another look
        # (words of two letters stay: each is a misreading of another)
        while len(at) > 1 and (len(at) > 2 or not at.isalpha()) and not _NUMERAL.fullmatch(at) and (edits := self.best(at)) and self.lexicon.level(apply(at, edits)) >= self.lexicon.level(at):
            got, before = apply(at, edits), at
            at = got
            if self.lexicon.level(at) >= USUAL or self.lexicon.level(at) == self.lexicon.level(before):
                break
        if len(self.kept) < 300_000:
            self.kept[word] = got
        return got

    def join_features(self, left: str, right: str, mark: str) -> list[str]:
        whole, parted = self.lexicon.level(left + right), self.lexicon.level(f"{left}-{right}")
        fixed = self.repair(left + right) is not None
        parts = self.lexicon.level(left) >= USUAL and self.lexicon.level(right) >= USUAL
        return ["join", f"join.whole:{whole > 0}", f"join.parted:{parted > 0}", f"join.parts:{parts}", f"join.fixed:{fixed}", f"join.soft:{mark not in '-‑'}", f"join:{whole > 0},{parted > 0},{parts}"]

    def joins(self, left: str, right: str, mark: str) -> bool:
        """Whether a line end divides one word (lower case) rather than a compound that keeps its hyphen."""
        return self.score(self.join_features(left, right, mark)) > 0


def smudge(word: str, rng: random.Random) -> tuple[str, tuple[Edit, ...]]:
    """A word with an inner letter lost, doubled up or read as any other, and the edit that undoes it."""
    i = rng.randrange(1, len(word) - 1)
    c = rng.choice(_ANY)
    kind = rng.randrange(3)
    if kind == 0:
        return word[:i] + word[i + 1 :], ((i, "", word[i]),)
    if kind == 1:
        return word[:i] + c + word[i:], ((i, c, ""),)
    return word[:i] + c + word[i + 1 :], ((i, c, word[i]),) if c != word[i] else ()


_ANY = "abcdefghijklmnopqrstuvwxyz"


def damage(word: str, rng: random.Random) -> tuple[str, tuple[Edit, ...]]:
    """A word with one or two scan errors, and the edits that undo them."""
    spots = [(i, right, wrong) for right, wrong in MISREADINGS for i in range(len(word) - len(right) + 1) if word.startswith(right, i)]
    if not spots:
        return word, ()
    chosen = sorted(rng.sample(spots, min(len(spots), 2 if rng.random() < 0.2 else 1)))
    out, at, undo = "", 0, []
    for i, right, wrong in chosen:
        if i >= at:
            out += word[at:i]
            undo.append((len(out), wrong, right))
            out += wrong
            at = i + len(right)
    return out + word[at:], tuple(undo)


def train(lexicon: Lexicon, seed: int = 42) -> Editor:
    """An editor trained on the `TRAIN_WORDS` most frequent words: misread, smudged, sound, and sound but passed off as rare."""
    rng = random.Random(seed)
    words = [w for w, _ in sorted(lexicon.counts.items(), key=lambda x: (-x[1], x[0])) if len(w) >= 2 and w.isalpha()]
    sure = [w for w in words if lexicon.level(w) >= USUAL][:TRAIN_WORDS]
    editor = Editor(lexicon)
    # a rare word one misreading away from a far more frequent one is no example of a sound word
    heard = {w for w in sure if not any(lexicon.level(apply(w, (e,))) >= lexicon.level(w) + 3 for e in edits_at(w))}
    examples: list[tuple[str, tuple[Edit, ...] | None, int]] = []
    for w in sure:
        noisy, undo = damage(w, rng)
        if undo and lexicon.level(noisy) < lexicon.level(w) - 1:
            examples.append((noisy, undo, lexicon.level(noisy)))
        if len(w) > 4 and rng.random() < SMUDGED:
            noisy, undo = smudge(w, rng)
            if undo and undo[0][1:] not in _READ and not lexicon.level(noisy):
                examples.append((noisy, undo, 0))
        if w in heard:
            examples.append((w, None, lexicon.level(w)))
            if rng.random() < 0.4:
                examples.append((w, None, rng.choice((0, 0, 1, 2))))  # as if it were rare
    sums: dict[str, float] = {}
    step = 0

    def update(names: list[str], by: float) -> None:
        for f in names:
            editor.weights[f] = editor.weights.get(f, 0.0) + by
            sums[f] = sums.get(f, 0.0) + by * step

    for _ in range(EPOCHS):
        rng.shuffle(examples)
        for word, undo, level in examples:
            step += 1
            gold = editor.features(word, undo, level) if undo else []
            aim = apply(word, undo) if undo else word
            rival, most = None, 0.0
            for c in editor.candidates(word, level):
                if apply(word, c) != aim and (s := editor.score(editor.features(word, c, level))) > (most if rival else -math.inf):
                    rival, most = c, s
            own = editor.score(gold) if undo else 0.0
            against = max(most, 0.0) if rival and undo else (most if rival else -math.inf) if not undo else 0.0
            if undo and own <= against + 1:
                update(gold, 1.0)
                if rival and most >= 0:
                    update(editor.features(word, rival, level), -1.0)
            elif not undo and rival and most >= -1:
                update(editor.features(word, rival, level), -1.0)
    compounds = [w for w in lexicon.counts if w.count("-") == 1 and lexicon.level(w) >= 1][:TRAIN_WORDS]
    cases = [(w[:k], w[k:], "-", True) for w in sure if len(w) > 4 for k in (rng.randint(2, len(w) - 2),)]
    cases += [(*w.split("-"), "-", False) for w in compounds for _ in range(max(1, len(cases) // (4 * len(compounds))))]
    cases += [(a, b, "-", False) for a, b in zip(rng.sample(sure, len(sure) // 8), rng.sample(sure, len(sure) // 8), strict=True) if a + b not in lexicon.counts]
    editor.kept.clear()
    editor.lifts.clear()
    for _ in range(EPOCHS):
        rng.shuffle(cases)
        for left, right, mark, one in cases:
            step += 1
            names = editor.join_features(left, right, mark)
            if (editor.score(names) > 0) != one:
                update(names, 1.0 if one else -1.0)
            if one and rng.random() < 0.05:
                soft = editor.join_features(left, right, "¬")
                if editor.score(soft) <= 0:
                    update(soft, 1.0)
    editor.weights = {f: w - sums[f] / (step + 1) for f, w in editor.weights.items() if abs(w - sums[f] / (step + 1)) > 1e-6}
    editor.kept.clear()
    editor.lifts.clear()
    return editor


_PAGE = re.compile(r"[\W_]*(?:p(?:age|g|p)?\.?\s*|seite\s+|página\s+|pagina\s+)?(\d{1,4}|[ivxlcdm]{1,8})[\W_]*", re.I)
_ROMAN = re.compile(r"(?i)m{0,3}(?:c[md]|d?c{0,3})(?:x[cl]|l?x{0,3})(?:i[xv]|v?i{0,3})")
_SIDE_NUMBER = re.compile(r"^(\d{1,4}|[ivxlc]{1,7})\s{2,}(.+)$|^(.+?)\s{2,}(\d{1,4}|[ivxlc]{1,7})$")
# Headings that belong to the text.
_HEADING = re.compile(r"(?:chapter|part|book|act|scene|prologue|epilogue|interlude|kapitel|teil|chapitre|partie|capítulo|parte|capitolo|the end|ende|fin|fine)\b", re.I)
_ENDED = re.compile(r"[.!?…:;][\"'”’»)\]]*$|^\W+$")
_SMALL = frozenset("a an the of and in on at to for by with from or de la le du des der die das von und et y e il".split())
#: Words before a number that make it part of the sentence.
_COUNTS = re.compile(r"\b(?:room|rooms|number|no|nr|page|pages|chapter|house|year|volume|box)\.?$", re.I)


def _title(line: str) -> str | None:
    """The words of a line that looks like a running title, spaced-out capitals closed up; None for others."""
    text = line.strip()
    if re.fullmatch(r"(?:[^\W\d_]\W? )+(?: +(?:[^\W\d_]\W? )*)*[^\W\d_]\W?", text + "") and len(re.findall(r"\b\w\b", text)) >= 4:
        text = " ".join(part.replace(" ", "") for part in re.split(r"\s{2,}", text))
    if len(text) < 3 or _HEADING.match(text) or not text[0].isalpha() or text[0] in "-*•>\"“'" or re.search(r"[,;!?…”\"]$", text):
        return None
    words = re.findall(r"[^\W\d_]+(?:['’.][^\W\d_]*)*", text)
    if not words:
        return None
    if text.isupper() or (text[-1] != "." and all(w[0].isupper() or w.lower() in _SMALL for w in words) and words[0][0].isupper()):
        return " ".join(words)
    return None


def furniture(lines: list[str], hint: str, lexicon: Lexicon) -> dict[int, set[str]]:
    """Lines that are page furniture: their numbers and `header`, `page_no` or both."""
    filled = [k for k, line in enumerate(lines) if line.strip()]
    if len(filled) < 3:
        return {}
    seen: dict[int, set[str]] = {}
    titles: dict[int, str] = {}
    for k in filled[1:-1]:
        line = lines[k].strip()
        if (m := _PAGE.fullmatch(line)) and (m[1].isdigit() or _ROMAN.fullmatch(m[1])):
            seen[k] = {"page_no"}
            continue
        m = _SIDE_NUMBER.match(line)
        if m and (title := _title(m[2] or m[3])):
            seen[k] = {"page_no", "header"}
        elif title := _title(line):
            titles[k] = title
    if not seen and not titles:
        return {}
    at = {k: n for n, k in enumerate(filled)}

    def text(n: int, step: int) -> str:
        while 0 <= n < len(filled) and (filled[n] in seen or filled[n] in titles):
            n += step
        return lines[filled[n]].strip() if 0 <= n < len(filled) else ""

    for k in [k for k, kinds in seen.items() if kinds == {"page_no"}]:
        before, after = text(at[k] - 1, -1), text(at[k] + 1, 1)
        unfinished = before and not _ENDED.search(before) and before[-1] not in _HYPHENS
        plain = re.fullmatch(r"\d{1,4}[.!?,;]?[\"”']?", lines[k].strip())
        if plain and unfinished and k - 1 in at and _COUNTS.search(before) and not after[:1].islower():
            del seen[k]  # the end of a sentence, wrapped
        elif not before or not after:
            del seen[k]
    repeated = Counter(titles.values())
    known = set(_WORD.findall(_fold(hint)))
    for k, title in titles.items():
        n = at[k]
        before, after = text(n - 1, -1), text(n + 1, 1)
        if not before or not after:
            continue
        words = _WORD.findall(_fold(title))
        beside = any(0 <= j < len(filled) and seen.get(filled[j]) == {"page_no"} for j in (n - 1, n + 1))
        inside = not _ENDED.search(before) and (after[:1].islower() or before[-1] in _HYPHENS or before[-1].isalnum())
        named = bool(known) and sum(w in known for w in words if w not in _SMALL) >= max(1, min(2, sum(w not in _SMALL for w in words)))
        person = lines[k].strip().isupper() and 2 <= len(words) <= 3 and lexicon.level(words[-1]) <= 4 and lexicon.level(words[0]) <= 7
        if beside or inside or named or repeated[title] > 1 or person:
            seen[k] = {"header"}
    return seen


def _fold(text: str) -> str:
    import unicodedata

    plain = unicodedata.normalize("NFD", text.lower().replace("ø", "o").replace("ł", "l").replace("ß", "ss").replace("æ", "ae"))
    return "".join(c for c in plain if not unicodedata.combining(c))


@dataclass
class Repair:
    """What was found in a text, and the text without it."""

    noise: list[str]
    text: str


def restore(story: str, hint: str, editor: Editor, rewrite: bool = True) -> Repair:
    """Find and, if `rewrite`, undo the scan damage of one text."""
    found: set[str] = set()
    body = story
    lines: list[str] | None = None
    removed: dict[int, set[str]] = {}
    if "\n" in story:
        lines = story.split("\n")
        removed = furniture(lines, hint, editor.lexicon)
        for kinds in removed.values():
            found |= kinds
        if removed:
            body = "\n".join(line for k, line in enumerate(lines) if k not in removed)
        if _DIVIDED.search(body):

            def close(m: re.Match) -> str:
                left, mark, right = m[1], m[2], m[3]
                if right[0].islower() and editor.joins(left.lower(), _WORD.match(right.lower())[0], mark):
                    found.add("hyphen")
                    return left + right + "\n"
                return m[0]

            body = _DIVIDED.sub(close, body)
    whole = body.rstrip()
    tokens = _TOKEN.findall(whole.lower())
    if tokens and whole[-1].isalnum() and _WORD.findall(tokens[-1])[-1] in editor.prefixes:
        tokens.pop()  # perhaps broken off
    # the parts of a known compound are sound, though they may never stand alone
    words = {w for t in set(tokens) for w in ([t] if "-" not in t else () if editor.lexicon.level(t) > 1 else _WORD.findall(t))}
    wrong = {w: fixed for w in words if (fixed := editor.repair(w))}
    if wrong:
        found.add("misread")
    if not rewrite:
        return Repair(sorted(found), story)
    if wrong:

        def mend(m: re.Match) -> str:
            fixed = wrong.get(m[0].lower())
            if not fixed:
                return m[0]
            letters = [c for c in m[0] if c.isalpha()]
            if len(letters) > 1 and all(map(str.isupper, letters)):
                return fixed.upper()
            return fixed.capitalize() if m[0][0].isupper() or (m[0][0].isdigit() and _starts_sentence(body, m.start())) else fixed

        body = _WORD.sub(mend, body)
    return Repair(sorted(found), unwrap(body, bool(removed)) if lines else body)


_DIVIDED = re.compile(r"([^\W_]+)([-‐‑¬\u00ad])[ \t]*\n(?:[ \t]*\n)*[ \t]*([^\W\d_]+\S*)[ \t]*\n?")


def _starts_sentence(text: str, at: int) -> bool:
    before = text[:at].rstrip(" \n\t\"'“‘(")
    return not before or before[-1] in ".!?…:"


def unwrap(text: str, torn: bool = False) -> str:
    """Lines of a wrapped text joined into paragraphs; texts whose lines are paragraphs stay. `torn`: furniture was removed inside paragraphs."""
    lines = [line.rstrip() for line in text.split("\n")]
    pairs = [(a, b) for a, b in itertools.pairwise(lines) if a.strip() and b.strip()]
    width = max(map(len, lines), default=0)
    full = sum(len(a) + 1 + len(b.split()[0]) >= width - 12 or not _ENDED.search(a) for a, b in pairs)
    if not pairs or width > 120 or full < 0.6 * len(pairs):
        return re.sub(r"\n{3,}", "\n\n", text) if torn else text
    out: list[str] = []
    fresh = True
    for line in lines:
        if not line.strip():
            fresh = True
            continue
        if out and ((not fresh and not _ENDED_LINE.match(line)) or (torn and fresh and line[:1].islower() and not _ENDED.search(out[-1]))):
            out[-1] += " " + line.strip()
        else:
            out.append(line.strip())
        fresh = False
    return "\n\n".join(out)


_ENDED_LINE = re.compile(r"\s*(?:[*~#_]\W*$|[-•]\s)")


def repair_scans(df: DataFrame, key: str = "record_id", text: str = "story", hints: list[str] | None = None, rewrite: bool = True) -> DataFrame:
    """`(<key>, noise ARRAY<STRING>, text STRING)` for each row whose text is not null: the kinds of damage found, sorted, and the repaired text.

    `hints` names columns in which a text's title or author may stand, for the recognition of running headers. With
    `rewrite` false the text comes back as it was. Empty texts have no damage; repeated rows are repaired each; whole texts
    are read; columns not named are ignored. An empty table gives no rows.
    """
    hint = F.concat_ws(" ", *(F.col(f"`{h}`").cast("string") for h in hints)) if hints else F.lit("")
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), hint.alias("hint")).filter(F.col("text").isNotNull())
    kind = rows.schema["key"].dataType.simpleString()
    editor = train(count_words(rows, "text"))
    shipped = rows.sparkSession.sparkContext.broadcast((editor.lexicon, editor.weights))

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, weights = shipped.value
        own = Editor(lexicon, weights)
        for batch in batches:
            got = [restore(t, h or "", own, rewrite) for t, h in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            texts = pa.array([g.text for g in got], pa.string()) if rewrite else batch.column(1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([g.noise for g in got], pa.list_(pa.string())), texts], ["key", "noise", "text"])

    return spread(rows).mapInArrow(mend, f"key {kind}, noise array<string>, text string").withColumnRenamed("key", key)
