"""Records of outside formats: flat files of sequence databases, alignment reports, attribute-relation files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvina.sources.article_xml import own_text, tree


def read_flat_file(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(locus, description, organism, length, pmid, authors, title, journal): one row for each reference of each record.

    Records have two-letter line codes and end with //; references begin with RN.  A record without references has no row.
    """
    r = spark.read.text(path, lineSep="//\n").where(F.trim("value") != "")
    of = lambda c, code: F.trim(F.regexp_replace(F.array_join(F.regexp_extract_all(c, F.lit(rf"(?m)^{code}   (.*)$"), F.lit(1)), " "), '[";]+$|^"', ""))
    one: Column = F.regexp_extract("value", r"(?m)^ID   ([^;\s]+)", 1)
    head = r.select(one.alias("locus"), of(F.col("value"), "DE").alias("description"), of(F.col("value"), "OS").alias("organism"), F.regexp_extract("value", r"(?m)^SQ   Sequence (\d+) BP", 1).cast("int").alias("length"), F.explode(F.filter(F.split("value", r"(?m)^RN   "), lambda x, i: i > 0)).alias("_r"))
    return head.select("locus", "description", "organism", "length", F.regexp_extract("_r", r"(?m)^RX   PUBMED; (\d+)", 1).alias("pmid"), of(F.col("_r"), "RA").alias("authors"), of(F.col("_r"), "RT").alias("title"), of(F.col("_r"), "RL").alias("journal"))


_HIT = T.StructType([T.StructField("query", T.StringType()), T.StructField("hit", T.StringType()), T.StructField("evalue", T.DoubleType()), T.StructField("identity", T.LongType()), T.StructField("length", T.LongType())])


def alignment_hits(df: DataFrame, xml: str = "content") -> DataFrame:
    """(query, hit, evalue, identity, length) of every aligned segment of alignment reports in XML."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for x in b[xml]:
                root = tree(x)
                for it in root.iter("Iteration") if root is not None else ():
                    for hit in it.iter("Hit"):
                        for s in hit.iter("Hsp"):
                            number = lambda tag, s=s: int(own_text(s, tag) or 0)
                            rows.append((own_text(it, "Iteration_query-def"), own_text(hit, "Hit_id"), float(own_text(s, "Hsp_evalue") or "nan"), number("Hsp_identity"), number("Hsp_align-len")))
            yield pd.DataFrame(rows, columns=_HIT.names)

    return df.select(xml).mapInPandas(run, _HIT)


def attribute_header(relation: str, words: list[str], labels: list[str]) -> list[str]:
    """The header lines of an attribute-relation file of binary words."""
    return [f"@RELATION {relation}", *[f"@ATTRIBUTE {w} {{0,1}}" for w in words], f"@ATTRIBUTE class {{{','.join(labels)}}}", "@DATA"]


def attribute_lines(df: DataFrame, words: list[str], id_col: str, label: str) -> DataFrame:
    """(id, line) of the rows (id, words array, label) of an attribute-relation file."""
    bits = [F.when(F.array_contains("words", w), "1").otherwise("0") for w in words]
    return df.select(id_col, F.concat_ws(",", *bits, F.col(label)).alias("line"))
