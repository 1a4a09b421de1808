"""Find and repair passages that were decoded with a wrong character encoding.

For every pair of a true and a wrong encoding the garbled sequences are computed beforehand and matched by one multi-pattern
automaton: for UTF-8 read as a one-byte encoding the sequence of each character of a repertoire by rule (Latin, Greek and
Cyrillic letters, punctuation, symbols), for Cyrillic one-byte encodings the garbled forms of common letter triples.  A
sequence of the first kind is evidence by itself unless it is made of letters of one script only; triples need two hits and
more hits than ordinary triples.  Only matched spans are replaced, longest first, so correct text beside them stays: of a
sentence with garbled triples, the words from the first to the last that hold one, and the words next to these that read as
words of the true alphabet; never words with a Latin letter or with ordinary triples.  What was garbled twice is repaired
again until nothing changes.  The replacement character marks a passage whose original is lost; it is reported, not restored.

Null and empty texts, and texts of plain ASCII without entities, are never cases.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WRONG_FOR_UTF8 = ("cp1252", "latin-1", "cp1250", "iso8859-2", "cp1254", "cp1251", "mac-roman", "cp437", "cp850", "cp852", "koi8-r")
CYRILLIC = ("cp1251", "koi8-r", "cp866", "iso8859-5", "mac-cyrillic")
WRONG_FOR_CYRILLIC = ("cp1252", "latin-1", "cp1251", "koi8-r", "cp866", "mac-roman", "cp437")
#: code point ranges of the characters whose garbled sequences are computed
REPERTOIRE = ((0xA0, 0x17F), (0x192, 0x192), (0x218, 0x21B), (0x2C6, 0x2DD), (0x370, 0x3FF), (0x401, 0x45F), (0x490, 0x491), (0x1E80, 0x1E85), (0x2010, 0x203A), (0x2070, 0x209C), (0x20A0, 0x20BF), (0x2100, 0x2126), (0x2190, 0x2199), (0x2200, 0x2265), (0x25A0, 0x25CF), (0xFB00, 0xFB04))
#: common letter triples of Russian; fixed values
TRIPLES = "ост ого ени ние ста про ать пре при ств тел сть ова ель ном ных ани ция ест нос лен ско ере нны ент тно ило или али ния ему пол под пер рез ист ват ати диа ика дет бол леч для это что наб люд сос исс лед ова ние зам тил нед пок аза сре дни мес яца раз вит гоз ген мут аци нос рис выс оки поз дня опы при мен лек рол поб очн явл отм ече уча стн пац иен сро".split()


def _decode(data: bytes, encoding: str) -> str:
    """Like bytes.decode, but a byte without meaning stays the control character of its number."""
    out = []
    for b in data:
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


@cache
def _tables() -> tuple[object, dict[str, str]]:
    """The automaton over all garbled sequences; values are (kind, sequence, original)."""
    import ahocorasick

    table: dict[str, tuple[str, str, str]] = {}
    # the likelier encodings come first: a sequence that two of them give is read by the first
    chars = [c for low, high in REPERTOIRE for c in map(chr, range(low, high + 1)) if c.isprintable() or c in "\xa0\xad"]
    for wrong in WRONG_FOR_UTF8:
        for c in chars:
            seq = _decode(c.encode("utf-8"), wrong)
            if seq.isascii():
                continue
            # letters of one script alone may be a word: such a sequence needs company
            weak = all("Ѐ" <= x <= "џ" for x in seq) or seq[0] in "–—"
            table.setdefault(seq, ("weak" if weak else "sure", seq, c))
    for c in map(chr, range(0x80, 0xA0)):  # control characters come of what was garbled twice
        table.setdefault(_decode(c.encode("utf-8"), "latin-1"), ("sure", _decode(c.encode("utf-8"), "latin-1"), c))
    for lead in ("â€", "â‚¬", "â‰", "Ã¢", "ÃŽ", "Ãƒ", "Ã‚", "Ã…", "Ã„", "√¢", "ΓÇ", "‚Ä", "тА", "вЂ"):
        table.setdefault(lead, ("sure", lead, ""))
    for true in CYRILLIC:
        for wrong in WRONG_FOR_CYRILLIC:
            if true == wrong:
                continue
            for t in TRIPLES:
                for form in (t, t.capitalize(), t.upper()):
                    seq = _decode(form.encode(true), wrong)
                    if len(seq) == 3 and not re.search(r"[\x00-\x7f]", seq):
                        table.setdefault(seq, ("triple", seq, f"{true}>{wrong}"))
    for t in TRIPLES:
        for form in (t, t.capitalize(), t.upper()):
            if table.get(form, ("",))[0] in ("", "triple"):
                table[form] = ("plain", form, "")
    auto = ahocorasick.Automaton()
    for k, v in table.items():
        auto.add_word(k, v)
    auto.make_automaton()
    return auto, {}


_ENTITY = re.compile(r"&(?:[A-Z][A-Za-z]*(?:tilde|circ|ring|uml|grave|acute)|acirc|atilde|ETH|Ntilde|Icirc);")


_CUT = re.compile(r"[\n\x07.;!?]")


def _hits(text: str) -> tuple[list[tuple[int, int, str]], str | None, list[int], list[int]]:
    """Sure garbled spans (start, end, original); the pair of a garbled one-byte Cyrillic text, and where in its garbled
    sentences garbled and ordinary triples begin."""
    auto, _ = _tables()
    sure, weak, pairs, plain = [], [], {}, {}
    cuts = [m.start() for m in _CUT.finditer(text)]
    for end, (kind, seq, original) in auto.iter(text):
        start = end + 1 - len(seq)
        if kind == "sure":
            sure.append((start, end + 1, original))
        elif kind == "weak":
            weak.append((start, end + 1, original))
        elif kind == "triple":
            pairs.setdefault(original, {}).setdefault(bisect_left(cuts, end), []).append(start)
        else:
            plain.setdefault(bisect_left(cuts, end), []).append(start)
    ordinary = sum(map(len, plain.values()))
    spans = sure + weak if sure or len({w[:2] for w in weak}) > 3 and len(weak) > ordinary else sure
    # a sentence is garbled that holds two or more garbled triples and more of them than ordinary ones
    bad = {p: {k: x for k, x in at.items() if len(x) > 1 and len(x) > len(plain.get(k, ()))} for p, at in pairs.items()}
    pair = max(bad, key=lambda p: (sum(map(len, bad[p].values())), p), default=None)
    if not pair or not bad[pair]:
        return spans, None, [], []
    return spans, pair, [x for k in bad[pair] for x in bad[pair][k]], [x for k in bad[pair] for x in plain.get(k, ())]


_LATIN = re.compile(r"[A-Za-z]")
#: words of one letter; fixed values
_ONE = set("авикосуя")


def _read_back(text: str, pair: str, hits: list[int], ordinary: list[int]) -> str:
    """The words around the garbled triples at `hits` decoded rightly."""
    true, wrong = pair.split(">")
    cuts = [m.start() for m in _CUT.finditer(text)]
    hits, ordinary = sorted(hits), sorted(ordinary)
    within = lambda xs, a, b: bisect_left(xs, a) < bisect_left(xs, b)
    words: dict[int, list] = {}
    flagged = {bisect_left(cuts, x) for x in hits}
    for m in re.finditer(r"[^ \t\r\n\x07]+", text):
        k = bisect_left(cuts, m.start())
        if k in flagged:
            got = None
            if not m[0].isascii() and not _LATIN.search(m[0]) and (within(hits, m.start(), m.end()) or not within(ordinary, m.start(), m.end())):
                try:
                    got = m[0].encode(wrong).decode(true)
                except UnicodeError:
                    got = None
                letters = [c for c in got or "" if c.isalpha()]
                if not letters or any(not "Ѐ" <= c <= "џ" for c in letters) or len(letters) == 1 and letters[0].lower() not in _ONE:
                    got = None
            words.setdefault(k, []).append((m.start(), m.end(), got, within(hits, m.start(), m.end())))
    out, at = [], 0
    for k in sorted(words):
        ws = words[k]
        held = [i for i, w in enumerate(ws) if w[3]]
        if not held:
            continue
        a, b = held[0], held[-1]
        while a and ws[a - 1][2]:
            a -= 1
        while b + 1 < len(ws) and ws[b + 1][2]:
            b += 1
        for start, end, got, _ in ws[a : b + 1]:
            if got:
                out += [text[at:start], got]
                at = end
    return "".join([*out, text[at:]])


def is_garbled(text: str | None) -> bool:
    """True if the text has a passage that was decoded wrongly, restorable or not."""
    if not text or text.isascii() and "&" not in text:
        return False
    if "�" in text:
        return True
    if _ENTITY.search(text):
        text = html.unescape(text)
    spans, pair, _, _ = _hits(text)
    return bool(spans or pair)


def repair(text: str | None) -> str | None:
    """The text with its garbled passages restored where their original is known."""
    if not text or text.isascii() and "&" not in text:
        return text
    if _ENTITY.search(text) and (un := html.unescape(text)) and _hits(un)[0]:
        text = un
    seen = set()
    while text not in seen:
        seen.add(text)
        spans, pair, hits, ordinary = _hits(text)
        if pair and (back := _read_back(text, pair, hits, ordinary)) != text:
            text = back
            continue
        out, at = [], 0
        for a, b, c in sorted((s for s in spans if s[2]), key=lambda s: (s[0], -s[1])):
            if a >= at:
                out += [text[at:a], c]
                at = b
        text = "".join([*out, text[at:]])
    return text


def _flag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame([(f, i) for f, i, t in zip(b["field"], b["recordid"], b["text"], strict=True) if is_garbled(t)], columns=["field", "recordid"])


def _repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame([(f, i, repair(t)) for f, i, t in zip(b["field"], b["recordid"], b["text"], strict=True) if is_garbled(t)], columns=["field", "recordid", "repaired"])


def _suspects(texts: DataFrame) -> DataFrame:
    """Rows that can be cases at all, decided in the JVM: they hold a character beyond ASCII or an entity."""
    return texts.select("field", F.col("recordid").cast("long").alias("recordid"), "text").where(F.col("text").rlike(r"[^\x00-\x7f]|&[A-Za-z]+;"))


def garbled_records(texts: DataFrame) -> DataFrame:
    """(field, recordid) of the rows (field, recordid, text) with a wrongly decoded passage; repeated rows count once."""
    return _suspects(texts).mapInPandas(_flag, "field string, recordid long").distinct()


def repaired_records(texts: DataFrame) -> DataFrame:
    """(field, recordid, repaired) of the wrongly decoded rows."""
    return _suspects(texts).mapInPandas(_repair, "field string, recordid long, repaired string").distinct()
