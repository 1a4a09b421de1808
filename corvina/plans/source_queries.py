"""Queries that write tables in a format and read them again, and queries of row functions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvina.operators import rows
from corvina.plans.query import Registry, Tables
from corvina.session import shared_dir
from corvina.sources import corpus, tables, writers

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


def _folder(t: Tables, name: str) -> str:
    return f"{shared_dir(t.spark)}/corvina/{name}-{uuid.uuid4().hex}"


@query("select p_partkey, p_name, p_size from part")
def tsv_round_trip(t: Tables) -> DataFrame:
    at = _folder(t, "tsv")
    writers.write_tsv(t.part.select("p_partkey", "p_name", "p_size"), at)
    return tables.read_tsv(t.spark, at, types={"p_partkey": "long", "p_size": "int"})


@query("select p_partkey, p_name || ', \"x\"' as name from part")
def csv_round_trip(t: Tables) -> DataFrame:
    at = _folder(t, "csv")
    t.part.select(F.col("p_partkey").alias("#p partkey"), F.concat("p_name", F.lit(', "x"')).alias("name")).write.option("header", True).option("quote", '"').option("escape", '"').csv(at)
    got = corpus.read_csv(t.spark, at)
    return got.select(F.col(got.columns[0]).cast("long").alias("p_partkey"), "name")


@query("select cast(o_orderkey as varchar) as id, repeat('ACGT', cast(1 + o_orderkey % 30 as int)) as seq from orders")
def fasta_round_trip(t: Tables) -> DataFrame:
    at = _folder(t, "fasta")
    writers.write_fasta(t.orders.select(F.col("o_orderkey").alias("id"), F.repeat(F.lit("ACGT"), (1 + F.pmod("o_orderkey", F.lit(30))).cast("int")).alias("seq")), at, "id", "seq")
    return tables.read_fasta(t.spark, [f"{at}/size=short", f"{at}/size=long"]).select("id", "seq")


@query("select p_partkey as articleid, p_name as title from part where p_size > 10")
def dataset_union(t: Tables) -> DataFrame:
    """Two datasets below a base folder, read as one and cut to some updates."""
    at = _folder(t, "corpus")
    rows_ = t.part.select(F.col("p_partkey").alias("articleid"), F.col("p_name").alias("title"), F.when(F.col("p_size") > 10, 1).otherwise(2).alias("updateid"))
    rows_.where("articleid % 2 = 0").write.parquet(f"{at}/pmc/articles")
    rows_.where("articleid % 2 = 1").write.parquet(f"{at}/medline/articles")
    return corpus.Corpus(t.spark, at).read("pmc, medline", updates=[1]).select("articleid", "title")


@query("select l_orderkey, count(*) as n, min(l_linenumber) as first from lineitem group by l_orderkey")
def row_blocks(t: Tables) -> DataFrame:
    """Rows of one key as one block, in order."""
    b = corpus.blocks(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey", ["l_linenumber"])
    return b.select("l_orderkey", F.size("rows").cast("long").alias("n"), F.element_at("rows", 1)["l_linenumber"].alias("first"))


@query("select unnest([title, coalesce(isoabbrev, title)]) as phrase, cast(journalid as varchar) as id from journals")
def lexicon_lines(t: Tables) -> DataFrame:
    lines = t.journals.select(F.concat(F.col("journalid").cast("string"), F.lit("\t"), "title", F.lit("|"), F.coalesce("isoabbrev", "title")).alias("value"))
    return corpus.lexicon(lines)


@query("select upper(n_name) as name, n_nationkey * 2 as twice from nation where n_regionkey <> 0")
def processed_rows(t: Tables) -> DataFrame:
    """A function of rows that leaves some out."""
    return rows.process_rows(t.nation, lambda r: {"name": r["n_name"].upper(), "twice": r["n_nationkey"] * 2} if r["n_regionkey"] else None, "name string, twice long")


@query("select n_nationkey, n_name as said from nation")
def piped_texts(t: Tables) -> DataFrame:
    """Texts through an outside program that gives them back."""
    return rows.piped(t.nation, ["cat"], "n_name", ["n_nationkey"], ["said"])


@query("select r.articleid, a.externalid as \"externalId\", a.pmid as \"artPmid\", r.doi from refs r join (select distinct articleid, externalid, pmid, doi from articles) a using (articleid)")
def written_references(t: Tables) -> DataFrame:
    at = _folder(t, "refs")
    writers.write_references(t.refs.select("articleid", "doi"), t.articles.select("articleid", "externalid", "pmid", "doi").distinct(), at)
    return t.spark.read.parquet(at).select("articleid", "externalId", "artPmid", "doi")


@query("select f.articleid, case when a.pmid in (select pmid from refs where pmid <> '') then 'pos' else 'neg' end as label, length(f.content) as chars from files f join (select articleid, max(pmid) as pmid from articles group by articleid) a using (articleid) where coalesce(filetype, '') in ('main', '') and content is not null")
def labelled_texts(t: Tables) -> DataFrame:
    got = writers.labelled_texts(t.files, t.articles, t.refs.where("pmid <> ''").select("pmid").distinct())
    return got.select("articleid", "label", F.length("content").cast("long").alias("chars"))


@query("select s_suppkey as id, 'rs' || s_suppkey as snp, s_suppkey % 50 + 1 as place from supplier")
def protein_features(t: Tables) -> DataFrame:
    """Variants of protein entries."""
    k = F.col("s_suppkey").cast("string")
    place = (F.pmod("s_suppkey", F.lit(50)) + 1).cast("string")
    xml = F.concat(F.lit("<entry><accession>"), k, F.lit('</accession><feature type="sequence variant" description="in X; dbSNP:rs'), k, F.lit('"><original>A</original><variation>T</variation><location><position position="'), place, F.lit('"/></location></feature><feature type="chain"/></entry>'))
    got = corpus.protein_features(t.supplier.select(xml.alias("content")))
    return got.select(F.col("acc").cast("long").alias("id"), F.col("snpId").alias("snp"), F.col("begin").cast("long").alias("place"))
