"""Queries of the training-data problems; problem N's names begin with pN_."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvina.llm import canonical, encoding, leaks, markup, names, packing, reading_level, scans, survivors
from corvina.operators.packed_fields import packed_values

#: rank file of the tokenizer of problem 8; must be readable on every executor
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _author_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = _table(spark, sf_dir, "articles").select("articleid", "authors")
    return packed_values(articles, "articleid", ["authors"]).select(F.col("item").alias("name"))


def p1_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in articles.authors one edit apart in any order of their words: the trie join over the whole table."""
    return names.near_names(_author_names(spark, sf_dir))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of spellings of one person or group in articles.authors."""
    return names.variant_pairs(names.name_entities(_author_names(spark, sf_dir)))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged lines of scanned pages in files.content."""
    return scans.damaged_lines(_table(spark, sf_dir, "files").select("fileid", "content"))


def p2_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of files with scanned pages made into continuous paragraphs."""
    return scans.repaired_pages(_table(spark, sf_dir, "files").select("fileid", "content"))


def p3_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean texts of all files: parser events and smoothed text-to-tag ratios choose the content."""
    return markup.cleaned_texts(_table(spark, sf_dir, "files").select("fileid", "content"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of structure marked up in files.content."""
    return markup.marked_structures(_table(spark, sf_dir, "files").select("fileid", "content"))


def p4_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries meant by typed journals and publishers, accepted by cosine threshold and margin alone."""
    return canonical.map_articles(_table(spark, sf_dir, "articles"), _table(spark, sf_dir, "journals"), _table(spark, sf_dir, "publishers"), words=False)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries meant by typed journals and publishers."""
    return canonical.map_articles(_table(spark, sf_dir, "articles"), _table(spark, sf_dir, "journals"), _table(spark, sf_dir, "publishers"))


def p6_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pmid and doi of each paper with several records, from its top-ranked record that has a valid one."""
    return survivors.surviving_records(_table(spark, sf_dir, "articles"), vote=False).select("articleid", "pmid", "doi")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The right pmid and doi of each paper with several records."""
    return survivors.surviving_records(_table(spark, sf_dir, "articles")).select("articleid", "pmid", "doi")


def p6_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top-ranked record of each paper with several records."""
    return survivors.surviving_records(_table(spark, sf_dir, "articles")).select("articleid", "best", "records")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = _table(spark, sf_dir, "articles").select(F.lit("title").alias("field"), F.col("articleid").alias("recordid"), F.col("title").alias("text"))
    contents = _table(spark, sf_dir, "files").select(F.lit("content").alias("field"), F.col("fileid").alias("recordid"), F.col("content").alias("text"))
    return titles.unionByName(contents)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles and contents with a wrongly decoded passage."""
    return encoding.garbled_records(_texts(spark, sf_dir))


def p7_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those texts with what can be restored."""
    return encoding.repaired_records(_texts(spark, sf_dir))


def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's pack in each kind of container."""
    counts = packing.staged(packing.token_counts(_table(spark, sf_dir, "documents"), TOKENIZER), "pack-tokens")
    return packing.pack_documents(counts, _table(spark, sf_dir, "containers"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with leaked test items."""
    return leaks.leaked_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "testitems"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grade of every document."""
    return reading_level.reading_levels(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "levellabels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_method, p1_found, p2_found, p2_repaired, p3_method, p3_found, p4_method, p4_found, p6_method, p6_found, p6_best, p7_found, p7_repaired, p8_packed, p9_found, p10_found)
}
ORACLES: dict[str, str] = {}
