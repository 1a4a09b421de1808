"""Every core query with oracle SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from corvina.plans import registry

QUERIES, ORACLES = registry.queries(), registry.oracles()


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    if isinstance(v, list):
        return tuple(map(norm, v))
    return v if v is None or isinstance(v, (int, str, bool)) else str(v)


def bag(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr([norm(r[i]) for i in order]) for r in rows)


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    want = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert bag(map(tuple, df.collect()), df.columns) == bag(want.fetchall(), want.columns)


#: queries without SQL, and what must hold of their rows on the smallest tables
CHECKS = {
    "regex_spans": lambda r: all(x["snippet"] is not None and f"<<<{x['hit']}>>>" in x["snippet"] and x["end"] - x["start"] == len(x["hit"]) for x in r),
    "phrase_match": lambda r: all(x["start"] < x["end"] and x["id"].startswith("P") for x in r),
    "identifiers": lambda r: all(x["end"] - x["start"] == len(x["hit"]) for x in r),
    "sections": lambda r: all(x["start"] < x["end"] for x in r),
    "exact_chains": lambda r: len({(x["article"], x["chain"], x["query"]) for x in r}) == len(r),
    "sentence_split": lambda r: all(x["sentence"].strip() for x in r),
    "p5_found": lambda r: all(x["pos"] > 0 and x["item"] for x in r),
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_without_sql(spark, sf, name):
    got = QUERIES[name](spark, sf).collect()
    assert got or name in ("nucleotides", "protein_sequences"), "no rows"  # the texts hold none
    if name in CHECKS:
        assert CHECKS[name](got)


def test_llm_is_not_needed():
    import pathlib

    root = pathlib.Path(__file__).resolve().parents[1]
    for p in (root / "corvina").rglob("*.py"):
        if "llm" not in p.parts:
            assert "corvina.llm" not in p.read_text(), p
