"""Ranges (start, end; half open) as column expressions: cutting, intersecting, taking their text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def intersection(start1: Column, end1: Column, start2: Column, end2: Column) -> Column:
    """Length of the intersection; negative by the gap where there is none."""
    return F.least(end1, end2) - F.greatest(start1, start2)


def cut_in(ranges: Column, start: Column, end: Column, name: Column) -> Column:
    """array<struct<start,end,name>> with one more range, which is cut out of the others; empty ones go."""
    piece = lambda a, b, n: F.struct(a.alias("start"), b.alias("end"), n.alias("name"))
    left = lambda r: F.array(piece(r["start"], F.least(r["end"], F.greatest(start, r["start"])), r["name"]), piece(F.greatest(r["start"], F.least(end, r["end"])), r["end"], r["name"]))
    rest = F.flatten(F.transform(ranges, left))
    return F.array_sort(F.filter(F.concat(rest, F.array(piece(start, end, name))), lambda r: r["start"] < r["end"]))


def without_overlaps(ranges: Column, others: Column) -> Column:
    """Those ranges that overlap none of the others."""
    return F.filter(ranges, lambda r: ~F.exists(others, lambda o: (r["start"] < o["end"]) & (o["start"] < r["end"])))


def texts(text: Column, ranges: Column) -> Column:
    return F.transform(ranges, lambda r: F.substring(text, r["start"] + 1, r["end"] - r["start"]))


def descriptions(text: Column, ranges: Column) -> Column:
    """start-end:text=id of each range, joined by bars."""
    one = lambda r: F.concat(r["start"].cast("string"), F.lit("-"), r["end"].cast("string"), F.lit(":"), F.substring(text, r["start"] + 1, r["end"] - r["start"]), F.lit("="), r["name"])
    return F.array_join(F.transform(ranges, one), "|")


def line_break(text: Column, start: Column, most: int, newline: str = "\x07") -> Column:
    """Place of the next line break from `start` on within `most` characters, or the start itself."""
    at = F.locate(newline, F.substring(text, start + 1, F.lit(most)))
    return F.when(at > 0, start + at - 1).otherwise(start)


def normalised(start: Column, end: Column) -> Column:
    """struct(start, end) of an interval that may be inverted or empty; an empty one gets one place."""
    low, high = F.least(start, end), F.greatest(start, end)
    return F.struct(low.alias("start"), F.when(low == high, high + 1).otherwise(high).alias("end"))
