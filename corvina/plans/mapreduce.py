"""User-defined map, combine and reduce over the corpus, as one lazy plan."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce as fold
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame


@dataclass
class MapReduce:
    """`map(row)` yields (key, value) of a file row; `combine(a, b)` folds values of a key; `reduce(key, value)` yields rows.

    Values are strings or numbers given as strings.  With `combine` the values are folded within each task before the
    shuffle and again after it, so a hot key travels as one value a task.  Without it, reduce gets an iterator over all
    values of the key in order; they are streamed and never held together.
    """

    map: Callable[[dict], Iterator[tuple[str, str]]]
    reduce: Callable[[str, object], Iterator[tuple]]
    schema: str
    combine: Callable[[str, str], str] | None = None


def run(files: DataFrame, job: MapReduce) -> DataFrame:
    def mapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part: dict[str, str] = {}
        for b in batches:
            rows = []
            for r in b.to_dict("records"):
                for k, v in job.map(r):
                    if job.combine is None:
                        rows.append((k, v))
                    else:
                        part[k] = job.combine(part[k], v) if k in part else v
            if len(part) > 200_000:
                rows, part = list(part.items()), {}
            yield pd.DataFrame(rows, columns=["key", "value"])
        yield pd.DataFrame(list(part.items()), columns=["key", "value"])

    pairs = files.mapInPandas(mapped, "key string, value string")
    names = [c.strip().split()[0] for c in job.schema.split(",")]

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((k, v) for b in batches for k, v in zip(b["key"], b["value"], strict=True))
        out: list[tuple] = []
        for k, group in groupby(rows, key=itemgetter(0)):
            values: object = (v for _, v in group)
            if job.combine is not None:
                values = fold(job.combine, values)
            out += [x for x in job.reduce(k, values) or [] if x is not None]
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=names)
                out = []
        yield pd.DataFrame(out, columns=names)

    return pairs.repartition("key").sortWithinPartitions("key", "value").mapInPandas(reduced, job.schema)
