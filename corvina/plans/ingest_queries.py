"""Queries of conversion steps: checked metadata, lists, symbol tables, image rules, records of outside formats."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvina.functions import sequences, values
from corvina.operators import annotators as ann
from corvina.operators.ordered import row_numbers
from corvina.plans.query import Registry, Tables
from corvina.session import shared_dir
from corvina.sources import records

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


@query("select fileid, kind, n from (" + " union all ".join(f"select fileid, '{k}' as kind, len(regexp_extract_all(content, '{p}')) as n from files where " + " or ".join(f"contains(lower(content), '{w}')" for w in needs) for k, p, needs in ann.IDENTIFIERS) + ") where n > 0")
def identifier_counts(t: Tables) -> DataFrame:
    """How many accession numbers of each kind a file holds."""
    return ann.identifier_spans(t.files, ["fileid"], cap=2**31 - 1).groupBy("fileid", "kind").agg(F.count("*").alias("n"))


_CODONS = "map {" + ", ".join(f"'{c}': '{a}'" for c, a in sequences.CODONS.items()) + "}"


@query(f"with s as (select o_orderkey as id, translate(lpad(to_base(o_orderkey * 7919 + o_custkey, 4), 24, '0'), '0123', 'ACGT') as seq from orders) select id, translate(reverse(seq), 'ACGT', 'TGCA') as rc, list_aggregate(list_transform(range(0, 8), lambda i: ({_CODONS})[substr(seq, cast(3*i + 1 as int), 3)]), 'string_agg', '') as protein, regexp_replace(seq, '[aA]{{6,}}$', '') as trimmed from s")
def sequence_functions(t: Tables) -> DataFrame:
    """Reverse complements, translations and sequences without their poly-A tails."""
    seq = F.translate(F.lpad(F.conv(F.col("o_orderkey") * 7919 + F.col("o_custkey"), 10, 4), 24, "0"), "0123", "ACGT")
    d = t.orders.select(F.col("o_orderkey").alias("id"), seq.alias("seq"))
    return d.select("id", sequences.reverse_complement(F.col("seq")).alias("rc"), sequences.translated(F.col("seq")).alias("protein"), sequences.without_poly_a(F.col("seq")).alias("trimmed"))


@query("select articleid, pmid, 5000000000 + cast(pmid as bigint) as newid from (select min(articleid) as articleid, pmid from articles where regexp_matches(pmid, '^[0-9]{8}$') and pmid not in (select pmid from refs where pmid is not null) group by pmid)")
def crawler_rows(t: Tables) -> DataFrame:
    """New rows of crawled metadata: known columns only, each pmid once, none that is done; ids follow the pmid."""
    expected = {"articleid", "pmid"}
    meta = t.articles.select("articleid", "pmid")
    if set(meta.columns) != expected:
        raise ValueError(f"unexpected columns: {sorted(set(meta.columns) ^ expected)}")
    new = meta.where(F.col("pmid").rlike("^[0-9]{8}$")).join(t.refs.where("pmid is not null").select("pmid").distinct(), "pmid", "left_anti")
    return new.groupBy("pmid").agg(F.min("articleid").alias("articleid")).select("articleid", "pmid", (F.col("pmid").cast("long") + 5000000000).alias("newid"))


@query("select origfile, (row_number() over (order by origfile) - 1) // 4 as chunk from (select distinct origfile from articles where updateid % 2 = 0 and origfile <> '' and origfile not in (select origfile from articles where updateid % 2 = 1 and origfile is not null))")
def dump_chunks(t: Tables) -> DataFrame:
    """Chunks of index files that were not processed before."""
    f = t.articles.where("origfile <> ''").select("origfile", F.pmod("updateid", F.lit(2)).alias("done"))
    new = f.where("done = 0").select("origfile").distinct().join(f.where("done = 1").select("origfile").distinct(), "origfile", "left_anti")
    return row_numbers(new, [], ["origfile"]).select("origfile", F.floor((F.col("no") - 1) / 4).cast("long").alias("chunk"))


@query("select key, count(distinct v) as n from (select p_type as key, p_brand as v from part union all select p_type, p_name from part where p_size > 10) group by key")
def merged_maps(t: Tables) -> DataFrame:
    """Two tables of key and value made one of key and set."""
    small = t.part.where("p_size > 10").select(F.col("p_type").alias("key"), F.col("p_name").alias("v"))
    return t.part.select(F.col("p_type").alias("key"), F.col("p_brand").alias("v")).unionByName(small).groupBy("key").agg(F.countDistinct("v").alias("n"))


@query("select distinct lower(trim(x)) as name, coalesce(nullif(eissn, ''), nullif(printissn, '')) as gene from (select unnest([title, isoabbrev]) as x, eissn, printissn from journals where title not like 'Annals%') where x <> '' and coalesce(nullif(eissn, ''), nullif(printissn, '')) is not null")
def symbol_table(t: Tables) -> DataFrame:
    """Names with the first non-empty of two ids; withdrawn entries are left out."""
    gene = F.coalesce(F.nullif("eissn", F.lit("")), F.nullif("printissn", F.lit("")))
    j = t.journals.where(~F.col("title").startswith("Annals")).select(F.explode(F.array("title", "isoabbrev")).alias("x"), gene.alias("gene"))
    return j.where("x <> '' and gene is not null").select(F.lower(F.trim("x")).alias("name"), "gene").distinct()


@query("select pmid, string_agg(distinct cast(articleid as varchar), '|' order by cast(articleid as varchar)) as genes from refs where pmid <> '' and pubyear in ('2010', '2011', '2012') group by pmid")
def genes_of_pmids(t: Tables) -> DataFrame:
    """The list of each pmid, of chosen rows only."""
    r = t.refs.where("pmid <> ''").where(F.col("pubyear").isin("2010", "2011", "2012"))
    return r.groupBy("pmid").agg(F.array_join(F.sort_array(F.collect_set(F.col("articleid").cast("string"))), "|").alias("genes"))


@query("select x, y, x >= 100 and y >= 100 and x::double / y between 0.05 and 20 as kept from (select p_size * 7 as x, 20 + p_partkey % 300 as y from part)")
def image_rule(t: Tables) -> DataFrame:
    """Images that are worth keeping: both sides long enough, no strips."""
    return t.part.select((F.col("p_size") * 7).alias("x"), (20 + F.pmod("p_partkey", F.lit(300))).alias("y")).withColumn("kept", (F.col("x") >= 100) & (F.col("y") >= 100) & (F.col("x") / F.col("y")).between(0.05, 20))


@query("select pmid from (select pmid from refs where pmid <> '' union select pmid from articles where regexp_matches(pmid, '^[0-9]{8}$'))")
def pmid_lists(t: Tables) -> DataFrame:
    """Old and new pmids of a list, in random order, none removed."""
    new = t.articles.where(F.col("pmid").rlike("^[0-9]{8}$")).select("pmid")
    return t.refs.where("pmid <> ''").select("pmid").unionByName(new).distinct().orderBy(F.rand(7))


@query("select n_nationkey as id, [upper(substr(n_name, 1, 1)) || 'V', 'V' || upper(substr(n_name, 1, 1))] as acronyms from nation where upper(substr(n_name, 1, 1)) <> 'V' and n_name not like '% %'")
def author_acronyms(t: Tables) -> DataFrame:
    """Initials of authors in both orders."""
    n = t.nation.where("n_name not like 'V%' and n_name not like '% %'")
    return n.select(F.col("n_nationkey").alias("id"), values.author_acronyms(F.concat(F.lit("Vosek, "), F.initcap("n_name"))).alias("acronyms"))


@query("select s_suppkey as id, cast(1000 + s_suppkey as varchar) as pmid, 'Title ' || s_suppkey as title from supplier")
def flat_file_references(t: Tables) -> DataFrame:
    """References of flat-file records, one row each."""
    k = F.col("s_suppkey").cast("string")
    at = f"{shared_dir(t.spark)}/corvina/embl-{uuid.uuid4().hex}"
    text = F.concat(F.lit("ID   "), k, F.lit("; DNA\nDE   Some gene\nOS   Mus musculus\nRN   [1]\nRX   PUBMED; "), (1000 + F.col("s_suppkey")).cast("string"), F.lit('.\nRA   Vosek J.;\nRT   "Title '), k, F.lit('";\nRL   J Kidney 3:5(2001).\nSQ   Sequence 12 BP;\n     acgtacgtacgt 12\n//'))
    t.supplier.select(text.alias("value")).write.text(at)
    return records.read_flat_file(t.spark, at).select(F.col("locus").cast("long").alias("id"), "pmid", "title")


@query("select s_suppkey as id, 'h' || s_suppkey as hit, 10 + s_suppkey % 5 as length from supplier")
def alignment_hits(t: Tables) -> DataFrame:
    """Hits of alignment reports in XML."""
    k = F.col("s_suppkey").cast("string")
    xml = F.concat(F.lit("<BlastOutput><Iteration><Iteration_query-def>"), k, F.lit("</Iteration_query-def><Hit><Hit_id>h"), k, F.lit("</Hit_id><Hsp><Hsp_evalue>1e-5</Hsp_evalue><Hsp_identity>9</Hsp_identity><Hsp_align-len>"), (10 + F.pmod("s_suppkey", F.lit(5))).cast("string"), F.lit("</Hsp_align-len></Hsp></Hit></Iteration></BlastOutput>"))
    got = records.alignment_hits(t.supplier.select(xml.alias("content")))
    return got.select(F.col("query").cast("long").alias("id"), "hit", F.col("length").cast("long").alias("length"))


@query("select doc_id, (case when contains(lower(text), 'patients') then '1' else '0' end) || ',' || (case when contains(lower(text), 'mutation') then '1' else '0' end) || ',x' as line from (select doc_id, ' ' || list_aggregate(regexp_extract_all(lower(text), '[a-z]+'), 'string_agg', ' ') || ' ' as text from documents where len(regexp_extract_all(lower(text), '[a-z]+')) > 0)")
def attribute_lines(t: Tables) -> DataFrame:
    """Binary word vectors as lines of an attribute-relation file."""
    words = F.concat(F.lit(" "), F.array_join(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)), " "), F.lit(" "))
    d = t.documents.where("text is not null").select("doc_id", words.alias("words"))
    d = d.where("trim(words) <> ''").select("doc_id", F.array_compact(F.array(*[F.when(F.col("words").contains(w), F.lit(w)) for w in ("patients", "mutation")])).alias("words"), F.lit("x").alias("label"))
    return records.attribute_lines(d, ["patients", "mutation"], "doc_id", "label")
