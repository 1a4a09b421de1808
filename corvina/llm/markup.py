"""Find marked-up structures in texts and turn marked-up texts into clean ones.

HTML and XML are read as the events of the standard library's streaming parser (escaped markup is unescaped first); wiki,
Markdown and LaTeX give the same kind of events from a line scanner.  An event has a syntax and a structure; marks that two
syntaxes share (`*` lists, `$` formulas, `#`) go to the syntax of the block around them.  Program text is set aside first,
so nothing in it counts as markup.

Cleaning feeds the same parser: its events give the text and the number of tags of each line.  The text-to-tag ratio of the
lines is smoothed with a Gaussian, and a threshold at the deviation of the smoothed ratio, at most `RATIO` characters a tag,
clusters lines into content and frames (menus, link bars, layout).  The text of frame lines is left out; headings, code,
formulas and table rows stay, whose marks are dense by nature.  Kept structures are rendered as plain Markdown: headings,
lists, fenced code, formulas, table rows.  Wiki, Markdown and LaTeX marks are rendered line by line.  Lines without any tag
are always content.

Null and empty texts have no structures and stay as they are.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEL = "\x07"
_HTML_KIND = {t: k for k, ts in {
    "heading": "h1 h2 h3 h4 h5 h6 title article-title subtitle", "list": "ul ol li list list-item dl dt dd def-list def-item", "code": "pre preformat",
    "formula": "math disp-formula inline-formula tex-math mml:math", "table": "table tr td th thead tbody tfoot caption table-wrap",
}.items() for t in ts.split()}
_HTML_INLINE = set("p i b u em strong a span br sup sub xref italic bold div style font sec body html head img code tt s small big center hr blockquote label fn ref ext-link script link meta section article abstract kbd del ins abbr cite q mark strike underline sc monospace graphic fig named-content styled-content underline".split())
_INSIDE = set("mi mn mo mrow msub msup msubsup mfrac mtext msqrt mover munder mtable mtr mtd mstyle mspace".split())
_WIKI_TAGS = {"ref": "inline", "nowiki": "inline", "source": "code", "syntaxhighlight": "code", "references": "inline", "gallery": "inline"}
_TAG = re.compile(r"</?([A-Za-z][A-Za-z0-9:-]*)((?:\s+[\w:-]+\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+))*)\s*/?>|<!--|<!\[CDATA\[|<!DOCTYPE", re.I)
_ENTITY = re.compile(r"&(?:#\d{2,6}|#x[0-9a-f]{2,5}|[A-Za-z]{2,8}\d?);", re.I)
_ESCAPED = re.compile(r"&(?:amp;)?lt;(?:/?[A-Za-z][\w:-]*(?:\s|/|&(?:amp;)?gt;)|!--)")

#: characters of text for a tag above which a line is content in any file
RATIO = 8.0

Event = tuple[str, str, int, int]  # syntax, structure, start, end


class _Tags(HTMLParser):
    """Streaming parser; gives (tag, start offset) of each known tag, and comments."""

    def __init__(self, text: str):
        super().__init__(convert_charrefs=False)
        self.events: list[tuple[str, int, bool]] = []
        self.starts = [0]
        for m in re.finditer("\n", text):
            self.starts.append(m.end())

    def _at(self) -> int:
        line, col = self.getpos()
        return self.starts[line - 1] + col

    def handle_starttag(self, tag, attrs):
        self.events.append((tag, self._at(), True))

    def handle_startendtag(self, tag, attrs):
        self.events.append((tag, self._at(), True))

    def handle_endtag(self, tag):
        self.events.append((tag, self._at(), False))

    def handle_comment(self, data):
        self.events.append(("!--", self._at(), True))


def _blank(m: re.Match) -> str:
    return re.sub(r"[^\n]", "\x00", m[0])


_WIKI_SURE = re.compile(r"\[\[[^\[\]\n]+\]\]|'''?[^'\n]+'''?|\{\{[^{}\n]+\}\}|^={2,6}[^=\n]+={2,6}[ \t]*$|^\{\||^\|-|^\|\}|\[https?://[^\s\]]+(?: [^\]\n]+)?\]|</?(?:ref|nowiki|source|syntaxhighlight)\b", re.M)
_MD_SURE = re.compile(r"\*\*\S(?:[^*\n]*\S)?\*\*|~~\S[^~\n]*~~|\[[^\[\]\n]+\]\([^)\s]+\)|^#{1,6} \S.*\n\s*$|^[^\n=]+\n=+[ \t]*$|^\|?(?:\s*:?-{2,}:?\s*\|)+|^```|^~~~|(?<![\w`])`[^`\n]+`(?!\w)|(?<![\w_])_[^_\n]+_(?![\w_])|\[\^\w+\]", re.M)
_TEX_SURE = re.compile(r"\\(?:begin|end)\{\w+\*?\}|\\(?:section|subsection|subsubsection|paragraph|chapter|textbf|emph|textit|textsc|cite[tp]?|ref|footnote|documentclass|usepackage|item|label|title|author|maketitle|url|underline|texttt)\b|\{\\(?:it|bf|em|sc|tt)\b|\\[%&_#]")
_HTML_SURE = re.compile(r"</?(?:p|div|span|b|i|strong|em|sec|title|list|li|ul|ol|table|t[rdh]|h[1-6]|italic|bold|xref|mml:math|pre|br|a)\b[^<>]*>", re.I)


class _Marks:
    """The sure marks of a text, for the syntax of the nearest one."""

    def __init__(self, marks: list[tuple[int, str]]):
        self.at: dict[str, list[int]] = {}
        for place, syntax in sorted(marks):
            self.at.setdefault(syntax, []).append(place)

    def nearest(self, at: int, among: tuple[str, ...]) -> str | None:
        """Syntax of the sure mark nearest to a place; of two as near the one before."""
        best = None
        for syntax in among:
            places = self.at.get(syntax, ())
            i = bisect_left(places, at)
            for p in places[max(0, i - 1) : i + 1]:
                key = (abs(p - at), p > at, syntax)
                best = min(best, key) if best else key
        return best[2] if best else None


#: a formula between dollar signs, on one line; what lies between must hold a sign of a formula
_DOLLARS = re.compile(r"(?<![\\\w$])\$(?=[^\s$])([^$\n]*)(?<=[^\s\\])\$(?![\w$])")
_SIGN = re.compile(r"[\\^_=+]")


def _dollars(text: str) -> Iterator[re.Match]:
    """Formulas between dollar signs, of any length; a sign that closes none may open the next."""
    at = 0
    while m := _DOLLARS.search(text, at):
        if _SIGN.search(m[1]):
            yield m
            at = m.end()
        else:
            at = m.end() - 1


def _without(text: str, matches: list[re.Match]) -> str:
    """The text with what was matched blanked out."""
    out, at = [], 0
    for m in matches:
        out += [text[at : m.start()], _blank(m)]
        at = m.end()
    return "".join([*out, text[at:]])


def events(text: str) -> list[Event]:
    """All structure events of a text (with newline characters), code blocks first."""
    out: list[Event] = []
    if _ESCAPED.search(text):
        text = html.unescape(text)
        if _ESCAPED.search(text):
            text = html.unescape(text)
    # program text
    def code(pattern: str, syntax: str, flags: int = re.M | re.S | re.I) -> None:
        nonlocal text
        for m in re.finditer(pattern, text, flags):
            out.append((syntax, "code", m.start(), m.end()))
        text = re.sub(pattern, _blank, text, flags=flags)

    code(r"<pre\b[^>]*>.*?</pre\s*>|<preformat\b[^>]*>.*?</preformat\s*>", "html")
    code(r"<(?:source|syntaxhighlight)\b[^>]*>.*?</(?:source|syntaxhighlight)\s*>", "wiki")
    code(r"\\begin\{(?:verbatim|lstlisting|minted|alltt)\*?\}.*?\\end\{(?:verbatim|lstlisting|minted|alltt)\*?\}", "latex")
    code(r"^[ ]{0,3}(```+|~~~+)[^\n]*\n.*?^[ ]{0,3}\1[ \t]*$", "markdown")
    # blocks of whole program lines in <code>
    for m in re.finditer(r"<code\b[^>]*>(.*?)</code\s*>", text, re.S | re.I):
        body = m[1]
        if "\n" in body or len(re.findall(r"[=(){};|]|--\w|<-", html.unescape(body))) > 1 or len(body.split()) > 3:
            out.append(("html", "code", m.start(), m.end()))
            text = text[: m.start()] + _blank(m) + text[m.end() :]
    marks = _Marks([(m.start(), s) for s, p in (("wiki", _WIKI_SURE), ("markdown", _MD_SURE), ("latex", _TEX_SURE), ("html", _HTML_SURE)) for m in p.finditer(text)])
    lines, at = [], 0
    for line in text.split("\n"):
        lines.append((at, line))
        at += len(line) + 1

    def add(syntax: str, structure: str, m: re.Match) -> None:
        out.append((syntax, structure, m.start(), m.end()))

    # tags and entities
    if "<" in text or "&" in text:
        wiki_math = {m.start() for m in re.finditer(r"<math>(?!\s*<)[^<]*</math>", text, re.I)}
        known = {m.start(): (m[1] or "!--").lower() for m in _TAG.finditer(text)}
        parser = _Tags(text)
        try:
            parser.feed(text)
            parser.close()
        except (AssertionError, ValueError):
            pass
        seen = {at for _, at, _ in parser.events}
        for place, tag in known.items():
            if place not in seen:
                parser.events.append((tag, place, True))
        closed = 0
        for tag, place, opening in sorted(parser.events, key=lambda e: e[1]):
            if place not in known or place < closed:
                continue
            base = tag.split(":")[-1] if tag.startswith("mml:") else tag
            if place in wiki_math:
                out.append(("wiki", "formula", place, place + 6))
                closed = text.find("</math>", place) + 7
                continue
            if tag in _WIKI_TAGS:
                out.append(("wiki", _WIKI_TAGS[tag], place, place + len(tag)))
                continue
            kind = _HTML_KIND.get(tag) or _HTML_KIND.get(base) or ("inline" if tag in _HTML_INLINE or tag == "!--" else "formula" if base in _INSIDE else None)
            if kind is None:
                continue
            if kind == "heading" and tag == "title" and re.search(r"<head\b", text, re.I):
                kind = "inline"
            syntax = "html"
            if tag in ("br", "!--", "code", "sub", "sup", "small", "s", "u") and "html" not in marks.at and marks.nearest(place, ("wiki", "html", "markdown", "latex")) == "wiki":
                syntax = "wiki"
            out.append((syntax, kind, place, place + len(tag) + 2))
        for m in _ENTITY.finditer(text):
            if html.unescape(m[0]) != m[0]:
                add("html", "inline", m)
    # formulas
    for m in re.finditer(r"\\begin\{(?:equation|align|gather|displaymath|eqnarray|math|multline)\*?\}.*?\\end\{\w+\*?\}|\\\[.*?\\\]|\\\([^\n]*?\\\)", text, re.S):
        add("latex", "formula", m)
    tex = re.sub(r"\\begin\{(?:equation|align|gather|displaymath|eqnarray|math|multline)\*?\}.*?\\end\{\w+\*?\}|\\\[.*?\\\]|\\\([^\n]*?\\\)|<math\b.*?</math>|<mml:math\b.*?</mml:math>|<(?:tex-math)\b.*?</tex-math>", _blank, text, flags=re.S | re.I)
    double = list(re.finditer(r"\$\$(?=\S)[^$]+\$\$", tex))
    tex = _without(tex, double)
    single = list(_dollars(tex))
    tex = _without(tex, single)
    for m in double + single:
        add(marks.nearest(m.start(), ("markdown", "latex")) or "markdown", "formula", m)
    # LaTeX
    for m in re.finditer(r"\\(?:section|subsection|subsubsection|paragraph|chapter|part)\*?\s*\{", tex):
        add("latex", "heading", m)
    for m in re.finditer(r"\\begin\{(itemize|enumerate|description)\}|\\item\b", tex):
        add("latex", "list", m)
    for m in re.finditer(r"\\begin\{(tabular|tabularx|table|longtable)\*?\}|\\hline", tex):
        add("latex", "table", m)
    for m in re.finditer(r"\\(?:textbf|textit|emph|textsc|texttt|underline|cite[tp]?|ref|footnote|documentclass|usepackage|label|url|href|title|author|maketitle|mbox|noindent)\b|\\begin\{(?:document|abstract|quote|center|figure)\}|\\[%&_#]|\{\\(?:it|bf|em|sc|tt)\b|(?<=\w)~\\(?:cite|ref)", tex):
        add("latex", "inline", m)
    plain = re.sub(r"\\begin\{tabular.*?\\end\{tabular\w*\*?\}", _blank, tex, flags=re.S)
    # wiki
    for m in re.finditer(r"^={2,6}[^=\n]+={2,6}[ \t]*$", plain, re.M):
        add("wiki", "heading", m)
    for m in re.finditer(r"^\{\|.*$|^\|\}[ \t]*$", plain, re.M):
        add("wiki", "table", m)
    rest = re.sub(r"^\{\|.*?^\|\}[ \t]*$", _blank, plain, flags=re.M | re.S)
    for m in re.finditer(r"\[\[[^\[\]\n]+\]\]|(?<!')'{2,5}(?!')[^'\n]+'{2,5}|\{\{[^{}\n]+\}\}|\[https?://[^\s\]]+(?: [^\]\n]+)?\](?!\()|^----+[ \t]*$", plain, re.M):
        add("wiki", "inline", m)
    # Markdown
    for m in re.finditer(r"^(?=[^\n=|]*\w)[^\n]*\n(?:={3,}|-{3,})[ \t]*$", rest, re.M):
        if not re.match(r"\||[-*+] ", m[0]):
            add("markdown", "heading", m)
    for m in re.finditer(r"^\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)+\|?[ \t]*$", rest, re.M):
        add("markdown", "table", m)
    for m in re.finditer(r"(?<![\w*])\*{1,3}(?=[^\s*])(?:[^*\n]*[^\s*])?\*{1,3}(?![\w*])|~~\S[^~\n]*~~|!?\[[^\[\]\n]+\]\([^)\s]+(?: \"[^\"]*\")?\)|(?<![\w`])`[^`\n]+`(?!`)|(?<![\w_\\])_{1,3}(?=[^\s_])[^_\n]*[^\s_]_{1,3}(?![\w_])|\[\^\w+\]|^> \S|(?<!\\)\\[*_`~#](?!\w)|^(?:\*\*\*|---|___)[ \t]*$|<https?://[^>\s]+>", rest, re.M):
        add("markdown", "inline", m)
    # line blocks shared by wiki and Markdown
    k = 0
    while k < len(lines):
        place, line = lines[k]
        line = rest[place : place + len(line)]
        before = lines[k - 1][1].strip() if k else ""
        m = re.match(r"(\*+|#+|[-+]|\d{1,2}[.)])(\s*)(?=\S)", line)
        if not m:
            if re.match(r"(?: {4}|\t)\S", line) and not before and "\x00" not in line:
                out.append(("markdown", "code", place, place + len(line)))
            elif re.match(r" \S", line) and "\x00" not in line and marks.nearest(place, ("wiki", "markdown", "latex", "html")) == "wiki" and re.search(r"[=(){};<>]|--\w", line):
                out.append(("wiki", "code", place, place + len(line)))
            k += 1
            continue
        mark, j = m[1][0] if not m[1][0].isdigit() else "1", k
        block = []
        while j < len(lines):
            b = rest[lines[j][0] : lines[j][0] + len(lines[j][1])]
            n = re.match(r"\s*(\*+|#+|[-+]|\d{1,2}[.)])(\s*)(?=\S)", b)
            if not n or (n[1][0] if not n[1][0].isdigit() else "1") != mark:
                break
            block.append((b, n))
            j += 1
        k = max(j, k + 1)
        first = block[0][1] if block else m
        spaced = bool(first[2])
        if mark == "1":
            numbers = [int(re.match(r"\d+", n[1])[0]) for _, n in block]
            # counted on from 1, or 1 throughout; one item alone stands behind a blank line
            if spaced and numbers[0] < 2 and (numbers == list(range(numbers[0], numbers[0] + len(numbers))) or set(numbers) == {1}) and (len(block) > 1 or numbers == [1] and not before):
                out.append(("markdown", "list", place, place + 2))
        elif mark == "#":
            if len(block) == 1 and spaced and re.match(r"#{1,6} \S", line):
                # a heading, unless wiki marks are nearest: those of a Markdown heading include itself before a blank line
                out.append(("wiki", "list", place, place + 1) if marks.nearest(place, ("wiki", "markdown")) == "wiki" else ("markdown", "heading", place, place + len(line)))
            elif len(block) > 1 or not spaced and marks.nearest(place, ("wiki", "markdown")) == "wiki":
                out.append(("wiki", "list", place, place + 1))
        elif mark == "*":
            if re.match(r"\*+\S[^*\n]*\*", line) and len(block) == 1:
                continue
            if not spaced:
                out.append(("wiki", "list", place, place + 1))
            elif len(block) > 1 or not before:
                out.append(("markdown" if not before and k < len(lines) and not lines[k][1].strip() or not before else "wiki", "list", place, place + 1))
        elif spaced and (len(block) > 1 or not before):
            out.append(("markdown", "list", place, place + 1))
    return out


def structures(text: str | None) -> list[tuple[str, str]]:
    """Distinct (syntax, structure) of a text in which BEL may stand for newline."""
    if not text:
        return []
    return sorted({(s, k) for s, k, _, _ in events(text.replace(BEL, "\n"))})


def smoothed(values: list[float], sigma: float = 1.0) -> list[float]:
    """Gaussian smoothing with a window of three deviations, renormalised at the ends."""
    reach = max(1, int(3 * sigma))
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        part = [(values[i + d], kernel[d + reach]) for d in range(-reach, reach + 1) if 0 <= i + d < len(values)]
        out.append(sum(v * k for v, k in part) / sum(k for _, k in part))
    return out


def threshold(ratios: list[float]) -> float:
    """Least smoothed ratio of a content line."""
    mean = sum(ratios) / len(ratios)
    return min((sum((x - mean) ** 2 for x in ratios) / len(ratios)) ** 0.5, RATIO)


#: tags whose lines stay whatever their ratio, tags within sentences, which count as no tag, and tags that end a line
_DENSE = set("h1 h2 h3 h4 h5 h6 title article-title pre code table tr td th caption math tex-math inline-formula disp-formula".split()) | _INSIDE
_EMPHASIS = set("i b u em strong sub sup italic bold span xref code tt s small sc monospace ref abbr cite q font".split())
_BREAKS = set("p div list ul ol table sec br tr h1 h2 h3 h4 h5 h6 title article-title".split())


class _Reader(HTMLParser):
    """Streaming parser that renders a text and counts text and tags of each line of the source."""

    def __init__(self, known: set[tuple[int, int]], lines: int):
        super().__init__(convert_charrefs=False)
        self.known = known
        self.chars, self.tags, self.dense = [0] * lines, [0] * lines, [False] * lines
        self.out: list[tuple[int, str, bool]] = []  # line of the source, text, whether it is the source's own text
        self.skip, self.cell, self.item = 0, False, 0

    def _text(self, text: str) -> None:
        line = self.getpos()[0] - 1
        for k, part in enumerate(text.split("\n")):
            n = min(line + k, len(self.chars) - 1)
            self.chars[n] += len(part.strip())
            if not self.skip:
                self.out.append((n, ("\n" if k else "") + part, True))

    def _fresh(self) -> str:
        """A newline, unless a line has just begun."""
        last = self.out[-1][1] if self.out else "\n"
        return "" if not last.rpartition("\n")[2].strip() and "\n" in last else "\n"

    def _tag(self, tag: str, opening: bool, source: str) -> None:
        line, col = self.getpos()
        if (line, col) not in self.known:
            return self._text(source)
        line -= 1
        self.tags[line] += tag not in _EMPHASIS
        tag = tag.split(":")[-1] if tag.startswith("mml:") else tag
        self.dense[line] |= tag in _DENSE
        mark = ""
        if tag in ("script", "style"):
            self.skip = max(0, self.skip + (1 if opening else -1))
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6", "title", "article-title"):
            mark = f"\n{'#' * int(tag[1]) if tag[0] == 'h' else '##'} " if opening else "\n"
        elif tag in ("li", "list-item"):
            if opening:
                mark, self.item = ("\n" if self.item == 0 else self._fresh()) + "- ", 1
        elif tag in ("td", "th"):
            mark, self.cell = (" | " if opening and self.cell else ""), True
        elif tag == "tr":
            mark, self.cell = self._fresh(), False
        elif tag in _BREAKS and (tag == "br" or not opening):
            mark = "\n"
        if tag in ("ul", "ol", "list"):
            self.item = 0
        if mark and not self.skip:
            self.out.append((line, mark, False))

    def handle_starttag(self, tag, attrs):
        self._tag(tag, True, self.get_starttag_text())

    def handle_startendtag(self, tag, attrs):
        self._tag(tag, True, self.get_starttag_text())

    def handle_endtag(self, tag):
        self._tag(tag, False, f"</{tag}>")

    def handle_data(self, data):
        self._text(data)

    def handle_entityref(self, name):
        known = html.unescape(f"&{name};")
        self._text(known if known != f"&{name};" else f"&{name}")

    def handle_charref(self, name):
        self._text(html.unescape(f"&#{name};"))

    def handle_comment(self, data):
        self.tags[self.getpos()[0] - 1] += 1

    def handle_decl(self, decl):
        self.tags[self.getpos()[0] - 1] += 1

    def handle_pi(self, data):
        self.tags[self.getpos()[0] - 1] += 1

    def unknown_decl(self, data):
        self._text(data.removeprefix("CDATA["))


def read_tags(text: str) -> str:
    """The text of HTML or XML without its tags and frame lines, structures rendered as Markdown."""
    starts = [0] + [m.end() for m in re.finditer("\n", text)]
    known = set()
    for m in _TAG.finditer(text):
        tag = (m[1] or "").lower()
        base = tag.split(":")[-1]
        if tag in _HTML_KIND or tag in _HTML_INLINE or tag in _WIKI_TAGS or base in _INSIDE or base in _HTML_KIND:
            line = bisect_right(starts, m.start()) - 1
            known.add((line + 1, m.start() - starts[line]))
    reader = _Reader(known, len(starts))
    try:
        reader.feed(text)
        reader.close()
    except (AssertionError, ValueError):
        return html.unescape(_TAG.sub("", text))
    smooth = smoothed([c / max(1, t) for c, t in zip(reader.chars, reader.tags, strict=True)])
    least = threshold(smooth)
    keep = [not t or d or s >= least for t, d, s in zip(reader.tags, reader.dense, smooth, strict=True)]
    return "".join(x if keep[line] or not own else "\n" if x.startswith("\n") else "" for line, x, own in reader.out)


def clean(text: str | None) -> str | None:
    """Clean text; headings, lists, code, formulas and tables keep a plain Markdown form."""
    if not text:
        return text
    t = text.replace(BEL, "\n").replace("\x00", "")
    if _ESCAPED.search(t):
        t = html.unescape(t)
    held: list[str] = []

    def hold(body: str) -> str:
        held.append(body)
        return f"\x00{len(held) - 1}\x00"

    fence = lambda m: "\n" + hold("```\n" + html.unescape(re.sub(r"</?code[^>]*>", "", m[1])).strip("\n") + "\n```") + "\n"
    t = re.sub(r"^[ ]{0,3}(?:```|~~~)[^\n]*\n(.*?)^[ ]{0,3}(?:```|~~~)[ \t]*$", fence, t, flags=re.S | re.M)
    t = re.sub(r"<(?:pre|preformat|source|syntaxhighlight)\b[^>]*>(.*?)</(?:pre|preformat|source|syntaxhighlight)\s*>", fence, t, flags=re.S | re.I)
    t = re.sub(r"\\begin\{(?:verbatim|lstlisting|minted)\}(.*?)\\end\{(?:verbatim|lstlisting|minted)\}", fence, t, flags=re.S)
    t = re.sub(r"<math>(?!\s*<)([^<]*)</math>|<tex-math>(.*?)</tex-math>", lambda m: hold(f"${(m[1] or m[2]).strip()}$"), t, flags=re.S)
    t = re.sub(r"\\begin\{(?:equation|align|displaymath)\*?\}(.*?)\\end\{(?:equation|align|displaymath)\*?\}|\\\[(.*?)\\\]|\$\$(.+?)\$\$", lambda m: hold(f"$${(m[1] or m[2] or m[3]).strip()}$$"), t, flags=re.S)
    out, at = [], 0
    for m in list(_dollars(t)):
        out += [t[at : m.start()], hold(m[0])]
        at = m.end()
    t = "".join([*out, t[at:]])
    t = read_tags(t)
    # wiki
    t = re.sub(r"^(={2,6})\s*([^=\n]+?)\s*={2,6}[ \t]*$", lambda m: f"{'#' * len(m[1])} {m[2]}", t, flags=re.M)
    t = re.sub(r"^\{\|.*\n|^\|-.*\n|^\|\}.*\n?", "", t, flags=re.M)
    t = re.sub(r"^[!|]\s*(.+)$", lambda m: re.sub(r"\s*(?:\|\||!!)\s*", " | ", m[1]), t, flags=re.M)
    t = re.sub(r"\[\[(?:[^\[\]|\n]*\|)?([^\[\]|\n]+)\]\]", r"\1", t)
    t = re.sub(r"\{\{(?:[^{}|\n]*\|)?([^{}|\n]+)\}\}", r"\1", t)
    t = re.sub(r"\[https?://\S+ ([^\]\n]+)\](?!\()", r"\1", t)
    t = re.sub(r"'{2,5}([^'\n]+)'{2,5}", r"\1", t)
    # LaTeX
    t = re.sub(r"\\(section|subsection|subsubsection|paragraph|chapter)\*?\{([^{}]*)\}", lambda m: f"{'#' * {'chapter': 1, 'section': 2, 'subsection': 3, 'subsubsection': 4, 'paragraph': 5}[m[1]]} {m[2]}", t)
    t = re.sub(r"\\(?:cite[tp]?|ref|label|documentclass|usepackage|footnote)(?:\[[^\]]*\])?\{[^{}]*\}", "", t)
    t = re.sub(r"\\(?:begin|end)\{[^{}]*\}(?:\{[^{}]*\})?\n?", "", t)
    t = re.sub(r"\\item\s*", "- ", t)
    t = re.sub(r"\\(?:textbf|textit|emph|textsc|texttt|underline|url)\{([^{}]*)\}", r"\1", t)
    t = re.sub(r"\{\\(?:it|bf|em|sc|tt)\s+([^{}]*)\}", r"\1", t)
    t = "\n".join(re.sub(r" *(?<!\\)& *", " | ", x.rstrip()[:-2].rstrip()) if x.rstrip().endswith("\\\\") else x for x in t.split("\n"))
    t = re.sub(r"\\([%&_#$])", r"\1", t)
    # Markdown
    t = re.sub(r"^(?=[^\n=|#]*\w)([^\n]*)\n={3,}[ \t]*$", r"# \1", t, flags=re.M)
    t = re.sub(r"^\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)+\|?[ \t]*\n?", "", t, flags=re.M)
    t = re.sub(r"!?\[([^\[\]\n]+)\]\([^)\s]+\)", r"\1", t)
    t = re.sub(r"(?<![\w*])\*{1,3}(?=[^\s*])([^*\n]*[^\s*])\*{1,3}(?![\w*])|~~(\S[^~\n]*)~~|(?<![\w`])`([^`\n]+)`(?!`)|(?<![\w_])_(?=[^\s_])([^_\n]*[^\s_])_(?![\w_])", lambda m: next(g for g in m.groups() if g is not None), t)
    # what is no emphasis by now is a list
    t = re.sub(r"^\*+(?=[^\s*])", "- ", t, flags=re.M)
    t = re.sub(r"\x00(\d+)\x00", lambda m: held[int(m[1])], t)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(x.rstrip() for x in t.split("\n"))).strip()


#: characters without which a text holds no markup; decided in the JVM
_MAY = r"[<>&\\$*_`~\[{=|#]|''|(?:^|[\x07\n])(?:[-+] | {4}|\t|\d{1,2}[.)] | \S)"


def _found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame([(i, s, k) for i, t in zip(b["fileid"], b["content"], strict=True) for s, k in structures(t)], columns=["fileid", "syntax", "structure"])


def _cleaned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"fileid": b["fileid"], "text": [clean(t) for t in b["content"]]})


def marked_structures(files: DataFrame) -> DataFrame:
    """(fileid, syntax, structure), each once a file."""
    may = files.select(F.col("fileid").cast("long").alias("fileid"), "content").where(F.col("content").rlike(_MAY))
    return may.mapInPandas(_found, "fileid long, syntax string, structure string").distinct()


def cleaned_texts(files: DataFrame) -> DataFrame:
    """(fileid, text) of every file; null content stays null."""
    return files.select(F.col("fileid").cast("long").alias("fileid"), "content").mapInPandas(_cleaned, "fileid long, text string")
