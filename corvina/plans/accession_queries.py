"""Queries of accession numbers, variants, proteins, formats and identifiers of the corpus."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvina.functions import ids, sequences
from corvina.functions.text import BEL
from corvina.operators import annotators as ann
from corvina.operators import proteins, variants
from corvina.plans.query import Registry, Tables
from corvina.session import shared_dir
from corvina.sources import tables

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


@query("select p_partkey, unnest(list_transform(range(p_partkey, p_partkey + 1 + p_partkey % 20), lambda i: 'PA' || lpad(cast(i as varchar), 6, '0'))) as acc from part")
def accession_lists(t: Tables) -> DataFrame:
    """Accessions of ranges such as PA000010-PA000014."""
    end = lambda c: F.concat(F.lit("PA"), F.lpad(c.cast("string"), 6, "0"))
    d = t.part.select("p_partkey", F.concat(F.lit("see "), end(F.col("p_partkey")), F.lit("-"), end(F.col("p_partkey") + F.pmod("p_partkey", F.lit(20))), F.lit(".")).alias("content"))
    return ann.accession_lists(d, ["p_partkey"]).select("p_partkey", "acc")


@query("select p_partkey as id, 'pfam' as kind, 'PF' || lpad(cast(p_partkey as varchar), 5, '0') as ident from part where p_partkey % 2 = 0 union all select p_partkey, 'entrez', cast(1000 + p_partkey as varchar) from part union all select p_partkey, 'hgnc', 'HGNC:' || (10 + p_partkey) from part")
def more_identifiers(t: Tables) -> DataFrame:
    """Optional kinds of accession numbers; those of one kind are checked against a list."""
    text = F.concat(F.lit("Pfam PF"), F.lpad(F.col("p_partkey").cast("string"), 5, "0"), F.lit(", GeneID: "), (1000 + F.col("p_partkey")).cast("string"), F.lit(" (HGNC:"), (10 + F.col("p_partkey")).cast("string"), F.lit(")"))
    spans = ann.identifier_spans(t.part.select(F.col("p_partkey").alias("id"), text.alias("content")), ["id"], kinds=[k for k, _, _ in ann.MORE_IDENTIFIERS], cap=2**31 - 1)
    good = t.part.where("p_partkey % 2 = 0").select(F.lit("pfam").alias("kind"), F.concat(F.lit("PF"), F.lpad(F.col("p_partkey").cast("string"), 5, "0")).alias("acc"))
    return ann.accepted_identifiers(spans, good).select("id", "kind", "ident")


@query("select distinct articleid * 1000 + 7 as fileid, articleid, articleid as back from articles")
def composed_ids(t: Tables) -> DataFrame:
    """File ids made of article ids, and back from annotation ids."""
    a = t.articles.select("articleid").distinct().withColumn("fileid", ids.file_id(F.col("articleid"), F.lit(7)))
    return a.select("fileid", "articleid", ids.annot_article(ids.annot_id(F.col("fileid"), F.lit(3))).alias("back"))


@query()
def variant_mentions(t: Tables) -> DataFrame:
    """Variants in files by the table of templates, with their written forms."""
    files = t.files.where("content is not null").select("fileid", F.translate("content", BEL, "\n").alias("content"))
    got = ann.run_tagger(files, variants.variant_tagger(), ["fileid"])
    typed = got.select("annotid", "fileid", F.col("start").alias("at"), "pattern", "mut", "seqtype", F.col("place").cast("int").alias("start"), F.col("to").cast("int").alias("end"), "old", "new", F.col("offset").cast("int").alias("offset"))
    return variants.normal_form(typed)


@query()
def protein_sequences(t: Tables) -> DataFrame:
    """Protein sequences of files; the models are of sequences and of the words of titles."""
    good = proteins.Markov("sequence", ["MKTAYIAKQRQISFVKSHFSRQLEERLGLIEVQAPILSRVGDGTQDNLSGAEKAVQVKVKALPDAQFEVVHSLAKWKR"])
    titles = t.articles.where("title is not null").select(F.upper("title").alias("t")).orderBy("t").limit(500).collect()  # a bounded sample trains the background
    bad = proteins.Markov("words", ["".join(c for c in r[0] if c in proteins.LETTERS) for r in titles] or ["THE"])
    tag = proteins.protein_tagger(proteins.Classifier(0.02, [good], [bad]))
    return ann.run_tagger(t.files.where("content is not null").select("fileid", F.translate("content", BEL, "\n").alias("content")), tag, ["fileid"])


@query("select 'chr' || (o_orderkey % 22) as chrom, o_orderkey as \"start\", o_orderkey + 10 + o_orderkey % 5 + 7 as \"end\", 'q' || o_orderkey as name, case when o_orderkey % 2 = 1 then '-' else '+' end as strand from orders")
def sam_to_bed(t: Tables) -> DataFrame:
    """Alignments written as SAM and read as BED: inserted bases take no room, deleted ones do."""
    k = F.col("o_orderkey")
    at = f"{shared_dir(t.spark)}/corvina/sam-{uuid.uuid4().hex}"
    cigar = F.concat(F.lit("10M3I"), F.pmod(k, F.lit(5)).cast("string"), F.lit("D7M"))
    t.orders.select(F.concat_ws("\t", F.concat(F.lit("q"), k.cast("string")), (F.pmod(k, F.lit(2)) * 16).cast("string"), F.concat(F.lit("chr"), F.pmod(k, F.lit(22)).cast("string")), (k + 1).cast("string"), F.lit("60"), cigar, F.lit("*"), F.lit("0"), F.lit("0"), F.lit("*"), F.lit("*")).alias("value")).write.text(at)
    return tables.sam_to_bed(tables.read_format(t.spark, at, "sam")).select("chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "name", "strand")


@query("select s_suppkey as id, case when s_suppkey % 3 = 0 then 'é' || s_suppkey else 'e' || s_suppkey end as text, 1 as control from supplier")
def decoded_bytes(t: Tables) -> DataFrame:
    """Bytes as UTF-8 where they are, else as ISO-8859-1; control characters are counted."""
    k = F.col("s_suppkey").cast("string")
    data = F.when(F.pmod("s_suppkey", F.lit(6)) == 3, F.encode(F.concat(F.lit("é"), k), "ISO-8859-1")).when(F.pmod("s_suppkey", F.lit(3)) == 0, F.encode(F.concat(F.lit("é"), k), "UTF-8")).otherwise(F.encode(F.concat(F.lit("e"), k), "UTF-8"))
    return t.supplier.select(F.col("s_suppkey").alias("id"), tables.decoded(data).alias("text"), tables.control_characters(F.concat(k, F.lit("\x01\t"))).cast("long").alias("control"))


@query("select s_suppkey as id, 'T' || s_suppkey || chr(10) || 'x' as text from supplier where s_suppkey % 2 = 0")
def xml_texts(t: Tables) -> DataFrame:
    """Texts of XML documents; those without the body that is needed give none."""
    k = F.col("s_suppkey").cast("string")
    xml = F.concat(F.lit("<a><title>T"), k, F.lit("</title>"), F.when(F.pmod("s_suppkey", F.lit(2)) == 0, "<body><p>x</p></body>").otherwise("<p>x</p>"), F.lit("</a>"))
    return t.supplier.select(F.col("s_suppkey").alias("id"), F.udf(lambda x: tables.xml_text(x, True))(xml).alias("text")).where("text is not null")


@query("select cast(s_suppkey as varchar) as id, 1000 + s_suppkey as pos from supplier where 1000 + s_suppkey > 1010 and 1000 + s_suppkey <= 1030")
def vcf_region(t: Tables) -> DataFrame:
    """Variants of a region, from a file of variant calls."""
    k = F.col("s_suppkey").cast("string")
    at = f"{shared_dir(t.spark)}/corvina/vcf-{uuid.uuid4().hex}"
    t.supplier.select(F.concat_ws("\t", F.lit("1"), (1000 + F.col("s_suppkey")).cast("string"), k, F.lit("A"), F.lit("C"), F.lit("."), F.lit("."), F.lit(".")).alias("value")).write.text(at)
    return tables.vcf_region(t.spark, at, "1", 1010, 1030).select("id", "pos")


@query("select s_suppkey, unnest(list_transform(range(1, 1 + s_suppkey % 5), lambda v: 'NM_' || s_suppkey || '.' || v)) as old from supplier")
def old_versions(t: Tables) -> DataFrame:
    """Earlier versions of accessions, and the written form of a change."""
    acc = F.concat(F.lit("NM_"), F.col("s_suppkey").cast("string"), F.lit("."), (1 + F.pmod("s_suppkey", F.lit(5))).cast("string"))
    return t.supplier.select("s_suppkey", F.explode(F.udf(sequences.old_versions, "array<string>")(acc)).alias("old"))
