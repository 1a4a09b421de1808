"""Sections of an article: by header lines and by the density of family names in its references."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from corvina.operators.annotators import Tagger, register_tagger

Range = tuple[int, int, str]

#: section, the share of the text in which its header may stand, and the header's words; fixed values
SECTIONS = [
    ("abstract", 0.0, 0.2, r"abstract|summary"),
    ("intro", 0.01, 0.5, r"introduction|background"),
    ("methods", 0.01, 0.9, r"materials?\s*and\s*methods|patients and methods|methods|experimental\s*procedures|experimental\s*methods"),
    ("results", 0.1, 0.95, r"results|case report|results\s*and\s*discussion|results/discussion|figures and table|figures|tables"),
    ("discussion", 0.01, 0.9, r"discussion"),
    ("conclusions", 0.1, 0.9, r"conclusion|conclusions|concluding\s*remarks"),
    ("notes", 0.8, 1.0, r"footnotes"),
    ("refs", 0.5, 1.0, r"literature\s*cited|references|bibliography|refereces|references\s*and\s*notes"),
    ("ack", 0.5, 1.0, r"acknowledgments?|acknowledgements?"),
]
#: sections that may be short and near others; fixed values
SHORT = ("abstract", "ack", "notes")
#: headers nearer than this are a table of contents; least and largest share of the text for a section; fixed values
NEAR, LEAST_SHARE, MOST_SHARE = 400, 0.003, 0.7
_HEADERS = [(name, low, high, re.compile(rf"^[*\s\d.IVX]{{0,20}}(?:{words})[\s*:]{{0,20}}$", re.I | re.M)) for name, low, high, words in SECTIONS]


def apart(marks: list[tuple[str, int]], near: int, short: tuple[str, ...] = SHORT) -> list[tuple[str, int]]:
    """Sorted (name, place) without those within `near` of the one before or behind; short sections always stay."""
    places = [p for _, p in marks]
    gaps = [b - a > near for a, b in zip(places, places[1:], strict=False)]
    return [m for m, left, right in zip(marks, [True, *gaps], [*gaps, True], strict=False) if m[0] in short or left and right]


def header_sections(text: str, near: int = NEAR, refs: bool = True) -> list[Range] | None:
    """(start, end, section) from header lines, the first being 'header'; None where the headers make no sensible sections.

    That is so with fewer than two sections, with one that begins more than twice, or with one of an unusual size.
    """
    size = len(text)
    marks = []
    for name, low, high, pattern in _HEADERS:
        if name == "refs" and not refs:
            continue
        places = [m.start() for m in pattern.finditer(text) if low * size <= m.start() <= high * size]
        marks += [(name, p) for p in (places[:1] if name == "abstract" else places)]
    starts: dict[str, list[int]] = {}
    for name, place in apart(sorted(marks, key=lambda m: m[1]), near):
        starts.setdefault(name, []).append(place)
    if len(starts) < 2 or any(len(p) > 2 for p in starts.values()):
        return None
    # sections in the order in which they first begin
    order = [("header", 0), *[(name, places[0]) for name, places in starts.items()], ("", size)]
    kept, last = [], 0
    for name, place in order:
        if place >= last:
            kept.append((name, place))
            last = place
    out = [(a, b, name) for (name, a), (_, b) in zip(kept, kept[1:], strict=False)]
    for a, b, name in out:
        if name != "header" and (b - a > int(MOST_SHARE * size) or b - a < int(LEAST_SHARE * size) and name not in SHORT):
            return None
    return out


def line_break(text: str, start: int, most: int) -> int:
    """Place of the next line break within `most` characters, or the start itself."""
    return next((i for i in range(start, min(start + most, len(text))) if text[i] in "\x07\n\r"), start)


def reference_section(text: str, names: set[str], reach: int = 250) -> tuple[int, int] | None:
    """(start, end) of the references: the longest stretch of family names not further apart than twice `reach`.

    It must begin in the second half; it is extended to the end of its last line and of two short lines behind it.
    """
    best, run = None, None
    size = len(text)
    for m in re.finditer(r"\w+", text.lower()):
        if m[0] in names:
            a, b = max(0, m.start() - reach), min(size, m.end() + reach)
            run = (run[0], b) if run and a <= run[1] else (a, b)
            if not best or run[1] - run[0] > best[1] - best[0]:
                best = run
    if not best:
        return None
    # a stretch up to the end of the text stops before its last character
    start, end = best[0] + reach, min(best[1], size - 1)
    for most in (200, 80, 80):
        end = line_break(text, end, most)
    return (start, end) if start >= size / 2 else None


def trim_range(start: int, end: int, name: str, cut_start: int, cut_end: int) -> list[Range]:
    """What is left of a range when another is cut out: none, one or two ranges."""
    if cut_start >= end or start >= cut_end:
        return [(start, end, name)]
    return [(a, b, name) for a, b in ((start, min(end, cut_start)), (max(start, cut_end), end)) if a < b]


def cut_in(sections: list[Range], start: int, end: int, name: str) -> list[Range]:
    """Sections with one more, which is cut out of the others; empty ones go."""
    left = [x for a, b, n in sections for x in trim_range(a, b, n, start, end)]
    return sorted(x for x in [*left, (start, end, name)] if x[0] < x[1])


def split_sections(text: str, kind: str = "", names: set[str] = frozenset(), least: int = 4000, least_refs: int = 500, near: int = NEAR) -> list[Range]:
    """(start, end, section) of a text; an empty one has none.  Short texts are one section, so are supplements; without headers it is 'unknown'.

    With family names the references are found by them, if that gives a section long enough, else by their header.
    """
    if not text:
        return []
    if len(text) < least:
        return [(0, len(text), "probablyAbstract")]
    if kind == "supp":
        return [(0, len(text), "supplement")]
    plain = text.replace("\x07", "\n")
    refs = reference_section(plain, names) if names else None
    if refs and refs[1] - refs[0] < least_refs:
        refs = None
    out = header_sections(plain, near, refs is None) or [(0, len(text), "unknown")]
    return cut_in(out, *refs, "refs") if refs else out


def section_tagger_for(names: set[str], name: str = "sections") -> Tagger:
    """A tagger of sections that knows some family names; they travel with the tasks, so pass a list of common ones."""
    annotate: Callable[[str], Iterator[tuple]] = lambda text: iter(split_sections(text, names=names))
    return register_tagger(Tagger(name, ["start", "end", "section"], annotate))


section_tagger = section_tagger_for(set())
