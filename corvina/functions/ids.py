"""Identifiers: articles, files and annotations share one decimal key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvina.schemas import ANNOT_DIGITS, FILE_DIGITS, ID_START

_FILE, _ANNOT = 10**FILE_DIGITS, 10**ANNOT_DIGITS


def annot_article(c: Column) -> Column:
    return _div(c.cast("long"), _FILE * _ANNOT)


def split_annot_id(c: Column) -> Column:
    """(articleid, fileno, annotno) of an annotation id, by integer arithmetic."""
    c = c.cast("long")
    return F.struct(_div(c, _FILE * _ANNOT).alias("articleid"), F.pmod(_div(c, _ANNOT), F.lit(_FILE)).alias("fileno"), F.pmod(c, F.lit(_ANNOT)).alias("annotno"))


def _div(c: Column, n: int) -> Column:
    """Whole division of a non-negative long, without a detour over floating point."""
    return F.floor(c.cast("decimal(20,0)") / F.lit(n).cast("decimal(20,0)")).cast("long")


def file_id(article: Column, number: Column) -> Column:
    return article.cast("long") * _FILE + number


def annot_id(file: Column, number: Column, offset: int = 0) -> Column:
    return file.cast("long") * _ANNOT + offset + number


def dataset_of(article: Column) -> Column:
    """Name of the dataset in whose id range an article lies; null outside of all ranges."""
    starts = sorted(ID_START.items(), key=lambda kv: kv[1])
    pairs = list(zip(starts, starts[1:], strict=False))
    return reduce(lambda acc, p: acc.when((article >= p[0][1]) & (article < p[1][1]), F.lit(p[0][0])), pairs[1:], F.when((article >= pairs[0][0][1]) & (article < pairs[0][1][1]), F.lit(pairs[0][0][0])))
