"""Split fields that hold several values, choosing each field's dialect by minimum description length.

A dialect is a delimiter, with or without joining words before the last value, or a run of numbering marks; quotes are
understood in every dialect.  Every distinct field is parsed under each dialect whose mark it contains.  The length of
a parse is the sum of the code lengths of its values: a value costs ``-log2`` of a mixture of its relative frequency
among the values of the column and of a spelled-out code, which is the frequency of its shape times a uniform letter
code.  Both tables are counted over the whole column from the parses that leave least doubt (a delimiter that does not
occur inside values, or no delimiter at all).  The shortest parse wins.

Null, blank and one-value fields have defined results: null and blank fields give no value, one-value fields give one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvina.session import staged

BEL = "\x07"
_CONJ = r"(?:and|und|et|&)"
#: name, pattern, may the parse serve to count values before any choice is made
_PLAIN = [(";", ";", True), ("|", r"\|", True), ("bel", BEL, True), ("newline", r"[\r\n]+", True), ("tab", "\t", True), ("bullet", "[•]", True), ("dot", r"(?<=\s)·(?=\s)|·", True), (",", ",", False), ("/", "/", False), ("dash", r"\s[-–—]\s", False)]
DIALECTS: dict[str, tuple[re.Pattern, bool]] = {}
for _n, _p, _s in _PLAIN:
    DIALECTS[_n] = (re.compile(_p), _s)
    if _n in ";,|/":
        DIALECTS[_n + "+and"] = (re.compile(rf"\s*(?:{_p})\s*{_CONJ}\s+|{_p}|\s+{_CONJ}\s+"), False)
DIALECTS["and"] = (re.compile(rf"\s+{_CONJ}\s+"), False)
_QUOTED = re.compile(r'"(?:[^"]|"")*"')
_MARK = re.compile(r"(?:(?<=\s)|^|(?<=[;,|\x07]))(?:\[(\d{1,3})\]|\((\d{1,3})\)|(\d{1,3})[.)])\s*")
_LEAD = re.compile(r"^(?:\[(\d{1,3})\]|\((\d{1,3})\)|(\d{1,3})[.)])\s*")
_SHAPE = re.compile(r"([A-ZÀ-ÖØ-ÞĀ-Ž]{1,3}(?![^\W\d_]))|([A-ZÀ-ÖØ-ÞĀ-Ž][^\W\d_]*)|([^\W\d_]+)|(\d+)|(\s+)")
#: longest shape kept whole, in symbols; all longer ones share one code
SHAPE_SYMBOLS = 60


def shape_of(value: str) -> tuple[str, int]:
    """The value with each word replaced by its kind, and the number of symbols that a shared code leaves unsaid."""
    s = _SHAPE.sub(lambda m: "I" if m[1] else "A" if m[2] else "a" if m[3] else "9" if m[4] else " ", value)
    return (s, 0) if len(s) <= SHAPE_SYMBOLS else ("long", len(s))


def parse(text: str, dialect: str) -> list[str]:
    """The non-empty values of a field under one dialect ('' takes the field as one value)."""
    held: list[str] = []

    def hold(m: re.Match) -> str:
        before = text[: m.start()].rstrip()
        if before and before[-1] not in ';,|/\t\n•·&-])."' + BEL and not re.search(_CONJ + r"$", before):
            return m[0]
        held.append(m[0])
        return f"{len(held) - 1}"

    masked = _QUOTED.sub(hold, text) if '"' in text else text
    if dialect == "":
        parts = [masked]
    elif dialect == "numbered":
        marks, want = [], 1
        for m in _MARK.finditer(masked):
            if int(m[1] or m[2] or m[3]) == want:
                marks.append(m)
                want += 1
        if len(marks) < 2 or masked[: marks[0].start()].strip():
            return [text.strip()]
        parts = [masked[a.end() : b.start() if b else len(masked)] for a, b in zip(marks, [*marks[1:], None], strict=True)]
        parts = [p.strip().rstrip(";,|" + BEL) for p in parts]
    else:
        parts = DIALECTS[dialect][0].split(masked)
    parts = [p.strip() for p in parts]
    if held:
        parts = [re.sub("(\\d+)", lambda m: held[int(m[1])], p) for p in parts]
    parts = [p for p in parts if p]
    if len(parts) > 1 and all((m := _LEAD.match(p)) and int(m[1] or m[2] or m[3]) == k for k, p in enumerate(parts, 1)):
        parts = [p[_LEAD.match(p).end() :] for p in parts]
    out = []
    for p in parts:
        if len(p) > 1 and p[0] == '"' and p[-1] == '"' and _QUOTED.fullmatch(p):
            p = p[1:-1].replace('""', '"').strip()
        if p:
            out.append(p)
    return out


def candidates(text: str) -> list[tuple[str, bool, list[str]]]:
    """(dialect, sure, values) of every dialect that gives another parse; the surest comes first."""
    found: list[tuple[str, bool, list[str]]] = []
    seen: set[tuple[str, ...]] = set()
    quoted = text.lstrip().startswith('"')
    for d in ("numbered", *DIALECTS, ""):
        v = parse(text, d)
        if d and len(v) < 2 and not (d in DIALECTS and DIALECTS[d][1] and v and v[0] != text.strip().strip('"')):
            continue
        if tuple(v) in seen:
            continue
        seen.add(tuple(v))
        sure = d == "numbered" or (d in DIALECTS and DIALECTS[d][1]) or (quoted and d == ",")
        found.append((d, sure, v))
    sure = [x for x in found if x[1]]
    first = max(sure, key=lambda x: len(x[2])) if sure else found[-1] if len(found) == 1 else None
    return [(d, x is first, v) for x in found for d, _, v in [x]]


def _candidate_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for field, key, text in zip(b["field"], b["key"], b["value"], strict=True):
            for k, (d, sure, v) in enumerate(candidates(text)):
                for i, x in enumerate(v, 1):
                    shape, more = shape_of(x)
                    rows.append((field, key, k, d, sure, i, x, shape, len(x) + more))
        yield pd.DataFrame(rows, columns=["field", "key", "cand", "dialect", "sure", "pos", "item", "shape", "chars"])


_ROWS = "field string, key string, cand int, dialect string, sure boolean, pos int, item string, shape string, chars int"
#: bits of one letter of a value that is spelled out, and of one end of a value
LETTER_BITS, END_BITS = 4.7, 2.0


def _blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def split_packed(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct fields and their values: (field, value, dialect, items array<struct<pos,item>>).

    Each distinct non-blank (field, value) of `columns` is one row, so repeated rows cost nothing.  Extra columns of
    `df` are ignored.  An empty table gives an empty result.
    """
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])).alias("x")).select("x.*")
    fields = long.where(~_blank(F.col("value"))).distinct().withColumn("key", F.md5(F.concat_ws("\x00", "field", "value")))
    rows = staged(fields.mapInPandas(_candidate_rows, _ROWS), "packed-rows")
    sure = rows.where("sure")
    counts = sure.groupBy("field", "item").agg(F.count("*").alias("n"))
    shapes = sure.groupBy("field", "shape").agg(F.count("*").alias("shape_n"))
    totals = sure.groupBy("field").agg(F.count("*").alias("total"))
    # one row a column of the input: the size is that of `columns`
    total = F.broadcast(totals)
    own = F.col("sure").cast("int")  # a parse must not pay for its values with its own count of them
    word = F.coalesce(F.col("n") - own, F.lit(0)) / F.greatest(F.col("total"), F.lit(1))
    # a shape that was not counted is spelled out at one bit a symbol
    shape = (F.coalesce(F.col("shape_n") - own, F.lit(0)) + 0.01 * F.pow(F.lit(2.0), -F.length("shape"))) / (F.greatest(F.col("total"), F.lit(1)) + 1)
    bits = -F.log2(0.5 * word + 0.5 * shape * F.pow(F.lit(2.0), -LETTER_BITS * F.least(F.col("chars"), F.lit(150)))) + LETTER_BITS * F.greatest(F.col("chars") - 150, F.lit(0)) + END_BITS
    costed = rows.join(counts, ["field", "item"], "left").join(shapes, ["field", "shape"], "left").join(total, "field", "left")
    chosen = (
        costed.groupBy("field", "key", "cand", "dialect").agg(F.sum(bits).alias("bits"), F.sort_array(F.collect_list(F.struct("pos", "item"))).alias("items"))
        .groupBy("field", "key").agg(F.min_by(F.struct("dialect", "items"), F.struct(F.round("bits", 6), "cand")).alias("best"))
    )
    return fields.join(chosen, ["field", "key"]).select("field", "value", F.col("best.dialect").alias("dialect"), F.col("best.items").alias("items"))


def packed_values(df: DataFrame, id_col: str, columns: list[str], split: DataFrame | None = None) -> DataFrame:
    """(id, field, pos, item) of every value of every field, one-value fields included; repeated rows count once."""
    long = df.select(F.col(id_col), F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])).alias("x")).select(id_col, "x.field", "x.value").where(~_blank(F.col("value"))).distinct()
    split = split_packed(df, columns) if split is None else split
    return long.join(split, ["field", "value"]).select(id_col, "field", F.size("items").alias("n_items"), F.explode("items").alias("x")).select(id_col, "field", "x.pos", "x.item", "n_items").distinct()
