"""Text functions as native column expressions: spans, tokens, snippets, sentences, author and citation strings."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BEL = "\x07"
#: family name prefixes, tried in this order; fixed values
NAME_PREFIXES = ("van der ", "von der ", "van ", "von ", "de la ", "de ", "al-")


def with_newlines(content: Column) -> Column:
    return F.translate(content, BEL, "\n")


def bound(value: Column, use) -> Column:
    """`use(value)` with the value computed once a row, although a lambda inside may read it again and again."""
    return F.element_at(F.transform(F.array(value), use), 1)


#: spans are summed up in blocks of so many, so that no long array is copied for each span
_BLOCK = 256
_SPANS = "array<struct<start:int,end:int,hit:string>>"


def match_spans(text: Column, pattern: str) -> Column:
    """array<struct<start,end,hit>> of the non-empty matches, 0-based and half open, in code points.

    The pattern runs once and marks its matches; starts are the running lengths of what stands before.  No Python is involved.
    """
    marked = F.regexp_replace(F.translate(text, "\x01\x02", "  "), f"({pattern})", "\x01$1\x02")
    piece = lambda x: F.struct(F.substring_index(x, "\x02", 1).alias("hit"), (F.length(x) - 1).alias("n"))

    def step(acc: Column, x: Column) -> Column:
        end = acc["at"] + F.length(x["hit"])
        span = F.struct(acc["at"].alias("start"), end.alias("end"), x["hit"].alias("hit"))
        return F.struct((acc["at"] + x["n"]).alias("at"), F.when(x["hit"] == "", acc["out"]).otherwise(F.concat(acc["out"], F.array(span))).alias("out"))

    def spans(parts: Column) -> Column:
        first = F.length(F.element_at(parts, 1))
        pieces = F.transform(F.slice(parts, 2, F.size(parts)), piece)

        def block(acc: Column, i: Column) -> Column:
            got = F.aggregate(F.slice(pieces, i * _BLOCK + 1, _BLOCK), F.struct(acc["at"].alias("at"), F.array().cast(_SPANS).alias("out")), step)
            return bound(got, lambda g: F.struct(g["at"].alias("at"), F.concat(acc["blocks"], F.array(g["out"])).alias("blocks")))

        start = F.struct(first.alias("at"), F.array().cast(f"array<{_SPANS}>").alias("blocks"))
        return F.when(F.size(parts) == 1, F.array().cast(_SPANS)).otherwise(F.aggregate(F.sequence(F.lit(0), F.floor((F.size(parts) - 2) / _BLOCK).cast("int")), start, block, lambda acc: F.flatten(acc["blocks"])))

    return bound(F.split(marked, "\x01", -1), spans)


def words(text: Column) -> Column:
    """Lower-case runs of letters, digits and underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)[\w]+"), F.lit(0))


def ascii_words(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits (the same in every regular expression dialect)."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9_]+"), F.lit(0))


def bigrams(tokens: Column) -> Column:
    pairs = lambda ws: F.transform(F.sequence(F.lit(1), F.size(ws) - 1), lambda i: F.concat_ws(" ", F.element_at(ws, i), F.element_at(ws, i + 1)))
    return bound(tokens, lambda ws: F.when(F.size(ws) > 1, pairs(ws)).otherwise(F.array().cast("array<string>")))


#: end of a sentence: a stop, blanks, a capital; not after initials and usual abbreviations; fixed value
SENTENCE_END = r"(?<=[.!?])(?<!\b[A-Z]\.)(?<!\b(?:no|Fig|al|cf|vs|Dr|St|eq)\.)(?<!\b(?:e\.g|i\.e|figs|resp|approx)\.)\s+(?=[A-Z0-9(\"'])"


def sentences(text: Column) -> Column:
    return F.filter(F.split(text, SENTENCE_END), lambda s: F.trim(s) != "")


def good_word(w: Column) -> Column:
    """Longer than two letters, ASCII, not led by a digit, three distinct letters, no mark-up signs."""
    return (F.length(w) > 2) & w.rlike(r"^[\x00-\x7f]*$") & ~w.rlike("^[0-9]") & (F.size(F.array_distinct(F.split(w, ""))) > 2) & ~w.rlike("[_<>]")


def snippet_of(text: str, start: int, end: int, least: int = 0, most: int = 150) -> str:
    """The hit in <<< >>> with its context, cut at the nearest sentence ends within bounds; '' for an empty span at 0."""
    if start == end == 0:
        return ""
    lo, hi = max(0, start - most), max(0, start - least)
    dot = text.rfind(". ", lo, hi)
    left = dot + 2 if dot >= 0 else (lo if hi == start else hi)
    lo, hi = max(0, end + least), min(end + most, len(text))
    right = None
    at = text.find(". ", lo, lo + 250)
    stop = lo + 250
    window = text[lo:stop]
    for at in range(len(window)):
        if window[at] == "." and (at + 1 == len(window) or window[at + 1] == " " and window[at + 2 : at + 3].isupper()):
            right = lo + at + 1
            break
    if right is None:
        right = hi if lo == end else lo
    out = f"{text[left:start]}<<<{text[start:end]}>>>{text[end:right]}"
    return out.replace("\n", " ").replace("\t", " ")


def spans_with_snippets(df: DataFrame, spans: str, text: str, keep: list[str], least: int = 0, most: int = 150) -> DataFrame:
    """One row a span of the array column `spans`: keep, start, end, hit, snippet.

    A document comes once, with all its spans, so its text is not repeated for each of them.
    """
    schema = df.select(*keep).schema.add("start", T.IntegerType()).add("end", T.IntegerType()).add("hit", T.StringType()).add("snippet", T.StringType())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for head, t, found in zip(b[keep].itertuples(index=False), b[text], b[spans], strict=True):
                if t is not None and found is not None:
                    rows.extend((*head, x["start"], x["end"], x["hit"], snippet_of(t, x["start"], x["end"], least, most)) for x in found)
            yield pd.DataFrame(rows, columns=[f.name for f in schema])

    return df.select(*keep, text, spans).mapInPandas(run, schema)


def reference_string(journal: Column, year: Column, vol: Column, issue: Column, page: Column) -> Column:
    """journal year, Vol v, Issue i, Page p; missing parts are left out."""
    part = lambda label, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(label), c))
    return F.concat_ws(", ", F.concat_ws(" ", F.coalesce(journal, F.lit("")), F.coalesce(year, F.lit(""))), part("Vol ", vol), part("Issue ", issue), part("Page ", page))


def clean_year(year: Column) -> Column:
    """Digits of the last word; '0' if there are none."""
    digits = F.regexp_replace(F.regexp_extract(F.coalesce(year, F.lit("")), r"(\S*)\s*$", 1), "[^0-9]", "")
    return F.when(digits == "", F.lit("0")).otherwise(digits)


def first_author(authors: Column) -> Column:
    """Family name of the first author of a semicolon list."""
    return F.trim(F.substring_index(F.substring_index(F.coalesce(authors, F.lit("")), ";", 1), ",", 1))


def last_author(authors: Column) -> Column:
    return F.trim(F.substring_index(F.substring_index(F.coalesce(authors, F.lit("")), ";", -1), ",", 1))


def without_prefix(name: Column) -> Column:
    """Without the first family name prefix that it contains."""
    out = name
    for p in reversed(NAME_PREFIXES):
        out = F.when(name.contains(p), F.replace(name, F.lit(p), F.lit(""))).otherwise(out)
    return out


def url_description(url: Column) -> Column:
    """Short host (17 characters at most, without www.) and path."""
    host = F.regexp_replace(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-z]+://([^/]*)", 1), r"^www\.", "")
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-z]+://[^/]*(/[^?#]*)?", 1)
    return F.concat(F.substring(host, 1, 17), path)


def escaped(text: Column) -> Column:
    """One line of a TSV cell: newline forms become BEL, other control characters blanks."""
    t = F.regexp_replace(text, "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]", BEL)
    return F.regexp_replace(t, "[\x00-\x06\x08-\x1f\x7f]", " ")


def one_line(text: Column) -> Column:
    return F.regexp_replace(text, "[\t\n\r\x07]+", " ")


def sql_cell(text: Column, most: int = 32000) -> Column:
    """For loading: markers of hits become tags, runs of blanks one blank, at most so many characters."""
    t = F.replace(F.replace(text, F.lit("<<<"), F.lit("<B>")), F.lit(">>>"), F.lit("</B>"))
    return F.substring(F.regexp_replace(t, " +", " "), 1, most)
