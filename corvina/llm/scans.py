"""Repair text from scanned pages: running heads and page numbers, divided words, misread characters.

An averaged perceptron edits characters: it keeps, replaces, deletes and inserts from the letters around them, and at a line
end it joins the lines' words or leaves them, from the hyphen, the words on both sides and their being words of the corpus.
It is trained here, on the commonest words of the corpus itself, damaged by a fixed table of usual misreadings and divided at
line ends.  A word is held to be misread if the editor's best edits turn it into a word of the corpus that is far more
common than itself: a word that is not is as likely a name of its own.  Furniture is told by a score of page-position and layout features of a line.

Pages are hard-wrapped texts: two or more lines, and at least half of the characters in lines of up to `WIDEST` characters;
others have no damaged lines and stay as they are, as do null and empty texts.  Longer lines of a page are judged like the rest.

The vocabulary in memory holds the words in at least a share `COMMON` of the files, which bounds its size by the words of a
file divided by that share.  It bounds memory and decides nothing: a first pass over the pages asks for every rarer word they
need; these are counted by a join with the full table of counts and set right once each, their right forms outside the
vocabulary by another join with that table, and each file gets back the answers for its own words.
"""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvina.session import parts, staged

BEL = "\x07"
#: widest line of a page
WIDEST = 130
#: share of the files that hold a word of the vocabulary in memory
COMMON = 0.0005
#: files that hold a word that is no slip, and a word of the vocabulary, at least
LEAST_FILES = 4
#: a right word is at least so many times as common as its misreading, half a file being the error of counting
RATIO = 30
#: a shorter word with a capital within a sentence is a name
NAME = 7
#: words of the training sample, damaged copies of each, and passes
SAMPLE, COPIES, PASSES = 4000, 16, 3
#: right letters and their usual misreadings; fixed values
MISREAD = {
    "m": ["rn", "nn", "in"], "n": ["ri", "ii", "u", "m"], "l": ["1", "i", "I", "|", "!", "t"], "i": ["l", "1", "!", "j", "t"], "e": ["c", "o"], "c": ["e", "o"], "h": ["b", "li", "n"], "b": ["h", "6", "lo"], "o": ["0", "c", "e"], "s": ["5", "8"], "d": ["cl", "ol"],
    "u": ["ii", "n", "v", "li"], "w": ["vv", "w"], "a": ["o", "u", "n"], "t": ["f", "l", "1", "i"], "f": ["t", "r"], "g": ["q", "9", "y"], "q": ["g"], "r": ["n", "i", "t"], "v": ["y", "u"], "y": ["v"], "k": ["lc", "h"], "p": ["n", "o"], "z": ["2"], "x": ["s"], "S": ["5"], "B": ["8"], "O": ["0"], "I": ["l", "1"], "G": ["6"], "ß": ["B", "fs"],
    "é": ["e", "6"], "è": ["e"], "ó": ["6", "o"], "ü": ["ii", "u"], "ä": ["a"], "ö": ["o", "6"], "í": ["i"], "ñ": ["n"], "ą": ["a"], "ę": ["e"], "ł": ["l", "t"], "ś": ["s"], "ż": ["z"], "cl": ["d"], "rn": ["m"], "li": ["h"], "fi": ["ﬁ"], "fl": ["ﬂ"], "ff": ["ﬀ"], "ii": ["u", "n"], "vv": ["w"], "nn": ["m"], "ri": ["n"],
    "и": ["н", "й"], "н": ["и", "п"], "п": ["н"], "ш": ["щ"], "ь": ["ъ", "б"], "е": ["с"], "с": ["е"], "о": ["0"], "з": ["3"], "б": ["6"], "л": ["п"], "т": ["г"], "в": ["8"],
}
#: the same, from the misreading: those of two letters
_READ: dict[str, list[str]] = {}
for _right, _wrongs in MISREAD.items():
    for _wrong in _wrongs:
        if len(_wrong) > 1 or len(_right) > 1:
            _READ.setdefault(_wrong, []).append(_right)
_LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
_TOKEN = re.compile(r"\S+")
_LETTERS = re.compile(r"[^\W\d_]+")
#: letters next to no digit, as in the mark of a gene
_WORD = re.compile(r"(?<!\w)[^\W\d_]+(?!\w)")
#: marks of genes, variants, addresses and units, which mix letters with digits and signs
_CODE = re.compile(r"^(?:[A-Z]+[A-Za-z]?\d+[A-Za-z]?|[cpgmnr]\..*|rs\d+|.*@.*|.*[<>=/\\_{}$#*\[\]].*|\d.*\d|[A-Z]{1,4}\d*-\d+.*|.*\d[⁰-⁹].*|https?:.*|\d+(?:st|nd|rd|th|er|e|ª|º|-?fold|kg|mg|ml|mm|nM|kb)?)$")


#: mark-up and program text
_MARKED = re.compile(r"\[\[|\]\]|\{\{|\}\}|''|\('|'\)|</?\w|`|^\\")


def is_name(word: str, before: str) -> bool:
    """Whether a word behind `before` is taken for a name: short, with a capital, and no beginning of a sentence."""
    w = word.strip(".,;:()[]\"'“”‘’«»%?!")
    return len(w) < NAME and w.isalpha() and w[0].isupper() and w[1:].islower() and bool(before) and before[-1] not in ".!?:"


#: a sign read for a letter within a word; an address has a dot behind it
_AT = re.compile(r"(?:[^\W\d_]+[-'’])*(?:[^\W\d_]+@[^\W\d_@]*|@[^\W\d_@]+)(?:@[^\W\d_@]+)*(?:[-'’][^\W\d_]+)*")


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _LETTERS.findall(text)]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    df: Counter = Counter()
    files = 0
    for b in batches:
        for t in b["content"]:
            if t:
                files += 1
                # halves of divided words are joined, so that they are no words
                df.update(set(words_of(re.sub(r"(?<=[^\W\d_])[-‐¬\xad]\x07(?=[^\W\d_])", "", t))))
        if len(df) > 300_000:
            yield pd.DataFrame(list(df.items()), columns=["word", "n"])
            df.clear()
    yield pd.DataFrame([*df.items(), ("", files)], columns=["word", "n"])


def vocabulary(files: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """(word, n) of all words of the corpus and the number of files that hold them, '' having the number of files; the common ones."""
    counted = staged(files.select("content").mapInPandas(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "scan-words")
    n = (counted.where("word = ''").agg(F.sum("n")).collect()[0][0]) or 0
    # words of a file / COMMON rows, at most
    return counted, {r[0]: r[1] for r in counted.where((F.col("n") >= in_memory(n)) | (F.col("word") == "")).collect()}


def in_memory(files: int) -> float:
    """Files that hold a word of the vocabulary in memory, at least."""
    return max(LEAST_FILES, COMMON * files)


class CharacterEditor:
    """Averaged perceptron over the characters of a word and over line ends.

    Labels are K (keep), D (delete), R.. (replace), I.. (insert after) and, at a line end, J (join the words).
    """

    def __init__(self) -> None:
        self.weights: dict[str, dict[str, float]] = {}

    @staticmethod
    def features(w: str, i: int) -> list[str]:
        p = f"^^{w}$$"
        a, b, c, d, e = p[i : i + 5]
        return [f"0{c}", f"1{b}{c}", f"2{c}{d}", f"3{b}{c}{d}", f"4{a}{b}{c}", f"5{c}{d}{e}", f"6{a}{b}{c}{d}{e}"]

    @staticmethod
    def line_end(before: str, hyphen: str, after: str, seen: tuple[bool, bool, bool]) -> list[str]:
        """Features of a line end: its hyphen or none, the word behind it, and which of left, right and whole are words of the corpus.

        Without a hyphen, a half is a word of its own unless the whole is far more common.
        """
        return [f"j{hyphen}", "j", f"jw{hyphen}{after.lower()}", f"jw{after.lower()}", f"js{bool(hyphen)}{seen}", f"jn{hyphen}{bool(before)}"]

    def joins(self, before: str, hyphen: str, after: str, seen: tuple[bool, bool, bool]) -> bool:
        got = self.scores(self.line_end(before, hyphen, after, seen))
        return got.get("J", 0.0) > got["K"]

    def scores(self, feats: list[str]) -> dict[str, float]:
        out: dict[str, float] = defaultdict(float)
        out["K"] = 0.0
        for f in feats:
            for label, x in self.weights.get(f, {}).items():
                out[label] += x
        return out

    def train(self, pairs: list[tuple[list[list[str]], list[str]]], passes: int = PASSES, seed: int = 7) -> None:
        """pairs: the features of each place of a damaged word or of a line end, and the places' labels."""
        rng = random.Random(seed)
        w: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
        sums: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
        self.weights, step = w, 1
        for _ in range(passes):
            rng.shuffle(pairs)
            for places, labels in pairs:
                for feats, right in zip(places, labels, strict=True):
                    got = self.scores(feats)
                    best = max(got, key=lambda k: (got[k], k))
                    if best != right:
                        for f in feats:
                            w[f][right] += 1
                            sums[f][right] += step
                            w[f][best] -= 1
                            sums[f][best] -= step
                    step += 1
        self.weights = {f: {k: v - sums[f][k] / step for k, v in d.items() if v - sums[f][k] / step} for f, d in w.items()}

    def candidates(self, word: str, singles: int = 40, pairs: int = 7) -> Iterator[str]:
        """Corrected forms, best first: the greedy edit of the whole word, then the best single edits and pairs of them.

        A letter is only deleted behind one that is replaced: several letters were read for one.
        """
        edits, greedy, drops = [], [], []
        for i in range(len(word)):
            got = self.scores(self.features(word, i))
            best = max(got, key=lambda k: (got[k], k))
            greedy.append(best)
            drops.append(got.get("D"))
            edits += [(got["K"] - x, i, label) for label, x in got.items() if label not in ("K", "D")]
        if any(g != "K" for g in greedy) and not any(g == "D" and (not i or greedy[i - 1][0] not in "RD") for i, g in enumerate(greedy)):
            yield apply_edits(word, dict(enumerate(greedy)))
        edits.sort()
        top = [(i, label) for _, i, label in edits[:singles]]
        for i, label in top:
            if label[0] == "R" and i + 1 < len(word) and drops[i + 1] is not None and drops[i + 1] > 0:
                yield apply_edits(word, {i: label, i + 1: "D"})
            yield apply_edits(word, {i: label})
            if label[0] == "R" and i + 1 < len(word) and drops[i + 1] is not None and drops[i + 1] <= 0:
                yield apply_edits(word, {i: label, i + 1: "D"})
        for x in range(min(pairs, len(top))):
            for y in range(x):
                if top[x][0] != top[y][0]:
                    yield apply_edits(word, dict((top[x], top[y])))


def apply_edits(word: str, labels: dict[int, str]) -> str:
    out = []
    for i, c in enumerate(word):
        label = labels.get(i, "K")
        out.append(c if label == "K" else "" if label == "D" else label[1:] if label[0] == "R" else c + label[1:])
    return "".join(out)


def right_forms(editor: CharacterEditor, w: str) -> Iterator[str]:
    """The words that a misread word may stand for, best first."""
    for c in editor.candidates(w):
        if c != w and len(c) > 2:
            yield c
    # misreadings of several letters as several others, which need edits that hang together
    for wrong, rights in _READ.items():
        at = w.find(wrong)
        while at >= 0:
            for right in rights:
                c = w[:at] + right + w[at + len(wrong) :]
                if len(c) > 4:
                    yield c
            at = w.find(wrong, at + 1)


def least_files(n: int) -> float:
    """Files that must hold the right form of a word that `n` files hold."""
    return max(2 * LEAST_FILES, RATIO * (max(1, n) - 0.5))


def damaged(word: str, rng: random.Random) -> tuple[str, list[str]]:
    """A misread form of a word and the labels that restore it."""
    spots = [(i, k) for i in range(len(word)) for k in (2, 1) if word[i : i + k] in MISREAD and len(word[i : i + k]) == k]
    if not spots or rng.random() < 0.3:
        return word, ["K"] * len(word)
    i, k = rng.choice(spots)
    right, wrong = word[i : i + k], rng.choice(MISREAD[word[i : i + k]])
    labels = ["K"] * i
    if len(wrong) >= len(right):
        labels += [f"R{r}" for r in right] + ["D"] * (len(wrong) - len(right))
    else:
        labels += [f"R{right}"]
    labels = [lab if lab != f"R{c}" else "K" for lab, c in zip(labels, word[:i] + wrong, strict=False)] + ["K"] * (len(word) - i - k)
    return word[:i] + wrong + word[i + k :], labels


def trained_editor(vocab: dict[str, int], seed: int = 7) -> CharacterEditor:
    """The editor, trained on at most SAMPLE of the commonest words."""
    rng = random.Random(seed)
    words = sorted((w for w in vocab if len(w) > 2), key=lambda w: (-vocab[w], w))[:SAMPLE]
    editor = CharacterEditor()
    made = [damaged(w, rng) for w in words for _ in range(COPIES)]
    pairs = [([editor.features(w, i) for i in range(len(w))], labels) for w, labels in made]
    for w in words:
        hyphen = rng.choice("---‐‑¬\xad")
        if len(w) > 4:
            # a word divided at a line end; halves are seldom words themselves
            for _ in range(max(4, SAMPLE // len(words))):
                k = rng.randrange(2, len(w) - 1)
                pairs.append(([editor.line_end(w[:k], rng.choice("---‐‑¬\xad"), w[k:], (w[:k] in vocab, w[k:] in vocab, rng.random() < 0.8))], ["J"]))
                pairs.append(([editor.line_end(w, "-", rng.choice(words), (True, True, False))], ["J"]))  # a compound at its own hyphen
                # the hyphen may be lost
                pairs.append(([editor.line_end(w[:k], "", w[k:], rng.choice(((False, True, True), (True, False, True), (False, False, True))))], ["J"]))
        pairs += [([editor.line_end(w, "", rng.choice(words), (True, True, whole))], ["K"]) for whole in (False, True)]
        pairs += [([editor.line_end("", hyphen, w, seen)], ["K"]) for seen in ((False, True, False), (False, False, False), (False, True, True))]  # a dash
    # a hung hyphen before each joining word
    for word in HUNG:
        for hyphen in "-‐‑¬\xad":
            pairs += [([editor.line_end("x", hyphen, word, seen)], ["K"]) for seen in product((False, True), repeat=3) for _ in range(4)]
    editor.train(pairs)
    return editor


#: joining words after which a hung hyphen ("pre- and post-") is no division; fixed values
HUNG = "and or to und oder bis et ou y e o u i oraz lub и или".split()
_PAGE = re.compile(r"^\W*(?:p\.?|pp\.?|page|s\.?|seite|pág\.?|стр\.?|str\.?)?\s*[\dlO]{1,4}(?:\s*(?:of|/|von|de|из|z)\s*\d+)?\W*$", re.I)
_HEAD = re.compile(r"running tit|original article|review article|short report|\bvol\. ?\d|\bet al\.?$|^downloaded from|^copyright|all rights reserved|^©|\bissn \d|^doi:|^https?://\S+$|accepted manuscript|author manuscript", re.I)
_SPACED = re.compile(r"^\s*\d{1,4}\s{2,}\S|\S\s{2,}\d{1,4}\s*$")


def _likely(s: str) -> str:
    """The line with its commonest misreadings undone, for comparing with words of heads."""
    return s.replace("1", "l").replace("0", "o").replace("c", "e").replace("5", "s").replace("|", "l").replace("!", "l").lower()


_HEAD_LIKE = re.compile("|".join(_likely(x) for x in ("running tit", "original artiel", "downloaded from", "all rights res", "copyright by")) + r"|\bvol\. ?[\dlos]+$|\bet al\.?$")


def furniture(lines: list[str]) -> list[bool]:
    """Which lines are running heads, feet or page numbers."""
    lengths = sorted(len(x) for x in lines if x.strip())
    width = lengths[int(0.9 * (len(lengths) - 1))] if lengths else 0
    same = Counter(re.sub(r"\d+", "9", x.strip()) for x in lines if x.strip())
    out = []
    for i, line in enumerate(lines):
        s = line.strip()
        if not s:
            out.append(False)
            continue
        before = next((x.strip() for x in reversed(lines[:i]) if x.strip()), "")
        number = bool(_PAGE.match(s)) and bool(re.search(r"\d", s)) and not re.search(r"\d\.$|%$|[\])]\.?$", s)
        bare = re.sub(r"^\d{1,4}\s{2,}|\s{2,}\d{1,4}$", "", s)
        words = _LETTERS.findall(bare)
        score = 4.0 * number
        score += 3.0 * bool(_HEAD.search(bare) or _HEAD_LIKE.search(_likely(bare)))
        score += 2.0 * bool(_SPACED.search(line.rstrip()) and len(s) < 0.95 * max(width, 40))
        score += 2.5 * (len(words) > 1 and bare.isupper() and not bare.endswith(".") and len(bare) < 60)
        score += 1.0 * (same[re.sub(r"\d+", "9", s)] > 1 and len(s) < 0.8 * width)
        score += 0.5 * (i == 0 or i == len(lines) - 1 or not lines[i - 1].strip() or i + 1 < len(lines) and not lines[i + 1].strip())
        score += 0.5 * (bool(before) and before[-1] not in ".!?:" and not s[0].islower())
        score -= 1.5 * (len(s) > 0.9 * width and len(words) > 6)
        score -= 1.0 * s.endswith((",", ";"))
        out.append(score >= 2.5)
    return out


_DIVIDED = re.compile(r"(\S*?)([-‐‑¬\xad])\s*$")
_NEXT = re.compile(r"^\s*(\S+)")
#: halves of a word that lost its hyphen
_LAST, _FIRST = re.compile(r"(?<!\S)\W?([^\W\d_]{2,})\s*$"), re.compile(r"^\s*([^\W\d_]{2,})(?![\w@])")


def is_page(lines: list[str]) -> bool:
    """Whether the lines are those of hard-wrapped pages."""
    return len(lines) > 1 and 2 * sum(len(x) for x in lines if len(x) <= WIDEST) >= sum(map(len, lines))


class Pages:
    """Damage of hard-wrapped pages, judged with the common words, the answers for rarer ones, and an editor.

    `asked` takes the rarer words that a page needs, and whether they may be misread themselves; `told` has their counts and
    the right words of those misread.  While asking, counts are not known yet, and every branch is taken.
    """

    def __init__(self, vocab: dict[str, int], editor: CharacterEditor, asking: bool = False):
        self.vocab, self.editor, self.files, self.asking = vocab, editor, vocab.get("", 0), asking
        self.sure = max(LEAST_FILES * 4, 0.01 * self.files)
        self.known: dict[str, str | None] = {}
        self.asked: dict[str, bool] = {}
        self.told: dict[str, tuple[int, str | None]] = {}

    def ask(self, w: str, written: bool = True) -> tuple[int, str | None]:
        """What is told of a word outside the vocabulary; one that is not written so in the page needs no right word."""
        if self.asking:
            self.asked[w] = written or self.asked.get(w, False)
        return self.told.get(w, (0, None))

    def count(self, w: str, written: bool = True) -> int:
        """Number of files that hold a word."""
        n = self.vocab.get(w, 0)
        return n if n or not w else self.ask(w, written)[0]

    def right_word(self, w: str) -> str | None:
        """The word a misread word stands for, None if it is not held to be misread. `w` is lower case."""
        if w not in self.vocab:
            if len(w) < 3:
                return None
            return self.ask(w)[1]
        if w in self.known:
            return self.known[w]
        # a far more common word than one of the vocabulary is in the vocabulary
        mine = self.vocab[w]
        least = least_files(mine)
        self.known[w] = out = None if mine >= self.sure or len(w) < 3 else next((c for c in right_forms(self.editor, w) if self.vocab.get(c, 0) >= least), None)
        return out

    def misread(self, token: str) -> bool:
        """True if a written word (with its marks) has a misread character."""
        if any(c in _LIGATURES for c in token):
            return True
        if _MARKED.search(token):
            return False
        core = token.strip(".,;:()[]\"'“”‘’«»%?…·–—-‐¬\xad")
        if core[:1] in "!¡|" and core[1:2].islower():
            rest = re.split(r"[-‐/'’]", core[1:])[0].lower()
            bare, others = self.count(rest), [self.count("i" + rest), self.count("l" + rest)]
            if max(others) >= least_files(bare):
                return True
        core = core.lstrip("!¡|")
        if _AT.fullmatch(core) and (core[0] != "@" or self.count(core.replace("@", "a").lower()) >= least_files(0)):
            return True
        if not core or not any(c.isalpha() for c in core):
            return False
        if _CODE.match(core):
            return False
        for part in re.split(r"[-‐/()'’]", core):
            if len(part) < 3 or _CODE.match(part):
                continue
            low = part.lower()
            if re.fullmatch(r"[^\W\d_]+", part):
                if self.right_word(low):
                    return True
            elif sum(c.isalpha() for c in part) >= 2:
                # digits or signs within a word
                if re.search(r"[^\W\d_][\d!|][^\W\d_]|^[\d!|][a-zß-ÿ]{2,}|[a-zß-ÿ]{2,}[\d!|]$", part) and not re.search(r"[A-Z]{2,}|\d[A-Z]|\d{2}", part):
                    return True
        return False

    def judged(self, text: str) -> list[tuple[int, str]]:
        """(line number from 1, kind) of the damaged lines."""
        lines = text.split(BEL)
        if not is_page(lines):
            return []
        fixed = furniture(lines)
        found = [(i + 1, "furniture") for i, f in enumerate(fixed) if f]
        body = [i for i, f in enumerate(fixed) if not f and lines[i].strip()]
        skip_first: set[int] = set()
        last = ""
        for k, i in enumerate(body):
            line = lines[i]
            tokens = _TOKEN.findall(line)
            if not tokens:
                continue
            garbled = False
            halves = self.halves(line, lines[body[k + 1]]) if k + 1 < len(body) else None
            start = int(i in skip_first)
            inner = tokens[start:]
            if halves:
                found.append((i + 1, "break"))
                if not self.asking:
                    skip_first.add(body[k + 1])
                    inner = inner[:-1] if inner and inner[-1] == tokens[-1] else inner
                a, b, _ = halves
                whole = (a + b).lower()
                one, left, right = self.count(whole), self.count(a.lower()), self.count(b.lower())
                if whole and not (one or (left and right)):
                    right = self.right_word(whole) if whole.isalpha() else None
                    if any(c in _LIGATURES for c in a) or (not a.isalpha() and self.misread(a)):
                        garbled = True
                    elif any(c in _LIGATURES for c in b) or (b and not b.isalpha() and self.misread(b)):
                        found.append((body[k + 1] + 1, "garble"))
                    elif right:
                        if right.startswith(a.lower()):
                            found.append((body[k + 1] + 1, "garble"))
                        else:
                            garbled = True
            misread = (self.misread(t) for t, before in zip(inner, [last, *tokens][start:], strict=False) if not is_name(t, before))
            if self.asking:
                garbled = bool([*misread, self._split_word(inner)])  # every word asks; no line is judged yet
            if garbled or any(misread) or self._split_word(inner):
                found.append((i + 1, "garble"))
            last = tokens[-1]
        return sorted(set(found))

    def halves(self, line: str, following: str) -> tuple[str, str, str] | None:
        """The halves of the word that the editor joins over a line end, and the hyphen between them; None if it joins none."""
        m, nxt = _DIVIDED.search(line), _NEXT.match(following)
        if not m:
            m, nxt = _LAST.search(line), _FIRST.match(following)
            if not m or not nxt:
                return None
            a, b = m[1].lower(), nxt[1].lower()
            # beside two words of the vocabulary, one outside it is far from common
            if a + b not in self.vocab and a in self.vocab and b in self.vocab and not self.editor.joins(m[1], "", nxt[1], (True, True, True)):
                return None
            n, left, right = self.count(a + b, False), self.count(a), self.count(b)
            if n < LEAST_FILES:
                return None
            seen = (n < least_files(left), n < least_files(right), True)
            return (m[1], nxt[1], "") if self.editor.joins(m[1], "", nxt[1], seen) else None
        if not nxt or not nxt[1][0].isalnum():
            return None
        a, b = re.split(r"[^\w!|]", m[1])[-1], re.match(r"[\w!|]*", nxt[1])[0]
        # the words as they stand decide; their letters may be misread
        before, after = (m[1] if m[1][:1].isalnum() else m[1].lstrip("([\"“")), re.match(r"\w*", nxt[1])[0]
        seen = (self.count(a.lower()) > 0, self.count(b.lower()) > 0, self.count((a + b).lower()) > 0)
        return (a, b, m[2]) if self.editor.joins(before if before[:1].isalnum() else "", m[2], after, seen) else None

    def _split_word(self, tokens: list[str]) -> bool:
        """A blank inside a word: two neighbours of which one is no word, whose whole is a far more common word."""
        found = False
        for x, y in zip(tokens, tokens[1:], strict=False):
            y = y.rstrip(".,;:)%\"”")
            x = x.lstrip("(\"“")
            if x.isalpha() and y.isalpha() and not (y[0].isupper() and not x.isupper()) and len(x) + len(y) > 3:
                a, b = x.lower(), y.lower()
                # a word far more common than one of the vocabulary is in the vocabulary
                if a + b not in self.vocab and a in self.vocab and b in self.vocab:
                    continue
                n, least = self.count(a + b, False), min(self.count(a, False), self.count(b, False))
                found = found or n >= least_files(least)
                if found and not self.asking:
                    break
        return found

    def repaired(self, text: str) -> str:
        """Continuous paragraphs: furniture left out, divided words joined, misread words set right."""
        lines = text.split(BEL)
        if not is_page(lines):
            return text.replace(BEL, "\n")
        fixed = furniture(lines)
        paragraphs: list[list[str]] = [[]]
        for i, line in enumerate(lines):
            if fixed[i]:
                continue
            if not line.strip():
                if paragraphs[-1] and re.search(r"[.!?:\"”)]\s*$", paragraphs[-1][-1]):
                    paragraphs.append([])
                continue
            paragraphs[-1].append(line.strip())
        out = []
        for p in paragraphs:
            joined = ""
            for line in p:
                halves = self.halves(joined, line) if joined else None
                if halves:
                    a, b, hyphen = halves[0].lower(), halves[1].lower(), halves[2]
                    one, two = self.count(a + b), min(self.count(a), self.count(b))
                    joined = joined.rstrip()[: -len(hyphen) or None] + ("" if hyphen != "-" or one >= two else "-") + line
                else:
                    joined = f"{joined} {line}" if joined else line
            for lig, letters in _LIGATURES.items():
                joined = joined.replace(lig, letters)

            def letter(m: re.Match) -> str:
                right = m[0].replace("@", "a")
                return right if self.count(right.lower()) >= least_files(0) else m[0]

            joined = re.sub(r"[^\W\d_]*@[^\W\d_]+|[^\W\d_]+@(?!\S)", letter, joined)

            def fix(m: re.Match) -> str:
                right = self.right_word(m[0].lower())
                return m[0] if not right or is_name(m[0], joined[: m.start()].rstrip()[-1:]) else right.capitalize() if m[0][0].isupper() else right

            out.append(_WORD.sub(fix, joined))
        return "\n\n".join(x for x in out if x)


def _asked(vocab: dict[str, int], editor: CharacterEditor, repair: bool):
    """The rarer words that each page needs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pages = Pages(vocab, editor, asking=True)
        for b in batches:
            rows = []
            for i, t in zip(b["fileid"], b["content"], strict=True):
                if t:
                    pages.asked = {}
                    (pages.repaired if repair else pages.judged)(t)
                    rows.extend((i, w, written) for w, written in pages.asked.items())
            yield pd.DataFrame(rows, columns=["fileid", "word", "written"])

    return run


def _set_right(vocab: dict[str, int], editor: CharacterEditor, outside: bool):
    """Rare words with the words of the vocabulary they are misread for, and the better forms outside it if it may lack right words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for w, written, n in zip(b["word"], b["written"], b["n"], strict=True):
                least, right, forms = least_files(n), None, []
                # a word that is not written in the page comes into it by a join, if it is a word
                if len(w) > 2 and w.isalpha() and (written or n >= LEAST_FILES):
                    for c in right_forms(editor, w):
                        if vocab.get(c, 0) >= least:
                            right = c
                            break
                        if outside and c not in vocab:
                            forms.append(c)
                if n or right or forms:
                    rows.append((w, n, right, least, list(dict.fromkeys(forms))))
            yield pd.DataFrame(rows, columns=["word", "n", "right", "least", "forms"])

    return run


def _answers(pages: DataFrame, repair: bool) -> tuple[DataFrame, dict[str, int], CharacterEditor]:
    """pages with `told`, (word, n, right) of the rarer words each one needs; the vocabulary; the editor."""
    counted, vocab = vocabulary(pages)
    editor = trained_editor(vocab)
    asked = pages.where(F.instr("content", BEL) > 0).mapInPandas(_asked(vocab, editor, repair), "fileid long, word string, written boolean")
    asked = staged(asked.groupBy("fileid", "word").agg(F.max("written").alias("written")), "scan-asked")
    words = asked.groupBy("word").agg(F.max("written").alias("written")).join(counted, "word", "left").select("word", "written", F.coalesce("n", F.lit(0)).alias("n"))
    # right words outside the vocabulary, if they may be there
    common = in_memory(vocab.get("", 0))
    outside = common > least_files(0)
    told = words.repartition(parts(pages.sparkSession)).mapInPandas(_set_right(vocab, editor, outside), "word string, n long, right string, least double, forms array<string>")
    if outside:
        told = staged(told, "scan-told")
        rest = counted.where((F.col("n") >= least_files(0)) & (F.col("n") < common)).select(F.col("word").alias("form"), F.col("n").alias("files"))
        forms = told.select("word", "least", F.posexplode("forms").alias("place", "form")).join(rest, "form").where("files >= least")
        told = told.join(forms.groupBy("word").agg(F.min_by("form", "place").alias("better")), "word", "left").withColumn("right", F.coalesce("better", "right"))
    told = told.where("n > 0 or right is not null")
    # a file's own words, no more
    by_file = asked.select("fileid", "word").join(told, "word").groupBy("fileid").agg(F.collect_list(F.struct("word", "n", "right")).alias("told"))
    return pages.join(by_file, "fileid", "left"), vocab, editor


def _told(x) -> dict[str, tuple[int, str | None]]:
    return {} if x is None else {r["word"]: (r["n"], r["right"]) for r in x}


def _judge(vocab: dict[str, int], editor: CharacterEditor):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pages = Pages(vocab, editor)
        for b in batches:
            rows = []
            for i, t, told in zip(b["fileid"], b["content"], b["told"], strict=True):
                if t:
                    pages.told = _told(told)
                    rows.extend((i, n, k) for n, k in pages.judged(t))
            yield pd.DataFrame(rows, columns=["fileid", "lineno", "kind"])

    return run


def _repair(vocab: dict[str, int], editor: CharacterEditor):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pages = Pages(vocab, editor)
        for b in batches:
            out = []
            for t, told in zip(b["content"], b["told"], strict=True):
                pages.told = _told(told)
                out.append(pages.repaired(t) if t else t)
            yield pd.DataFrame({"fileid": b["fileid"], "text": out})

    return run


def _pages(files: DataFrame) -> DataFrame:
    return files.select(F.col("fileid").cast("long").alias("fileid"), F.col("content").cast("string").alias("content"))


def damaged_lines(files: DataFrame) -> DataFrame:
    """(fileid, lineno, kind) of every damaged line; repeated rows count once."""
    pages, vocab, editor = _answers(_pages(files), False)
    return pages.where(F.instr("content", BEL) > 0).mapInPandas(_judge(vocab, editor), "fileid long, lineno int, kind string").distinct()


def repaired_pages(files: DataFrame) -> DataFrame:
    """(fileid, text) of every file; null content stays null."""
    pages, vocab, editor = _answers(_pages(files), True)
    return pages.mapInPandas(_repair(vocab, editor), "fileid long, text string")
