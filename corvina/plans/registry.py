"""All queries of the core, with their oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ("corvina.operators.cases", "corvina.plans.corpus_queries", "corvina.plans.text_queries", "corvina.plans.order_queries", "corvina.plans.model_queries", "corvina.plans.value_queries", "corvina.plans.article_queries", "corvina.plans.gene_queries", "corvina.plans.source_queries", "corvina.plans.accession_queries", "corvina.plans.ingest_queries")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict = {}
    for m in MODULES:
        q = import_module(m).QUERIES
        if twice := out.keys() & q.keys():
            raise ValueError(f"registered twice: {sorted(twice)}")
        out |= q
    return out


def oracles() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in MODULES:
        out |= getattr(import_module(m), "ORACLES", {})
    return out
