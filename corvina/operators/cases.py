"""Queries of the general training-data problem (packed fields)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvina.operators.packed_fields import packed_values

PACKED = ["authors", "keywords", "authoraffiliations"]


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(articleid, field, pos, item) of every value of a field that holds two or more."""
    articles = spark.read.parquet(f"{sf_dir}/articles.parquet").select("articleid", *PACKED)
    return packed_values(articles, "articleid", PACKED).where("n_items > 1").select("articleid", "field", F.col("pos").cast("int").alias("pos"), "item")


QUERIES = {"p5_found": p5_found}
