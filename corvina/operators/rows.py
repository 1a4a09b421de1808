"""Row functions and outside programs over tables, and the preferences of a tagger."""

from __future__ import annotations

import subprocess
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Preferences:
    """What a tagger wants to read; main texts and only metadata exclude each other, so do PDF and XML."""

    only_main: bool = False
    only_meta: bool = False
    prefer_pdf: bool = False
    prefer_xml: bool = False

    def __post_init__(self):
        if self.only_main and self.only_meta:
            raise ValueError("only main files, or only metadata")
        if self.prefer_pdf and self.prefer_xml:
            raise ValueError("prefer PDF, or prefer XML")


def process_rows(df: DataFrame, process: Callable[[dict], dict | None], schema: str, startup: Callable[[], None] | None = None, finish: Callable[[list[dict]], list[dict]] | None = None) -> DataFrame:
    """`process(row)` of every row, None leaving it out; `finish` sees the results of each batch together."""
    names = [c.strip().split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if startup:
            startup()
        for b in batches:
            out = [x for r in b.to_dict("records") if (x := process(r)) is not None]
            out = finish(out) if finish else out
            yield pd.DataFrame([[r.get(n) for n in names] for r in out], columns=names)

    return df.mapInPandas(run, schema)


def piped(df: DataFrame, command: list[str], text: str, keep: list[str], headers: list[str], seconds: int = 600) -> DataFrame:
    """An outside tagger: it gets one line for each text of a batch and gives one line of tab-separated fields for each.

    Line breaks in texts become blanks.  A program that fails, or gives another number of lines, raises.
    """
    schema = df.select(*keep).schema
    for h in headers:
        schema = schema.add(h, "string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            lines = [" ".join((t or "").splitlines()) for t in b[text]]
            got = subprocess.run(command, input="".join(f"{x}\n" for x in lines), capture_output=True, text=True, check=True, timeout=seconds).stdout.splitlines()
            if len(got) != len(lines):
                raise ValueError(f"{command[0]} gave {len(got)} lines for {len(lines)} texts")
            rows = [(*head, *(x.split("\t") + [""] * len(headers))[: len(headers)]) for head, x in zip(b[keep].itertuples(index=False), got, strict=True)]
            yield pd.DataFrame(rows, columns=schema.names)

    return df.select(*keep, text).mapInPandas(run, schema)
