"""Queries of genes, co-occurrence in sentences, prioritised keywords and mapped tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvina.functions import text
from corvina.operators import annotators as ann
from corvina.operators import genes, intervals, sentences
from corvina.plans.query import Registry, Tables

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles
_SYMBOL = "[A-Z]{2,4}[0-9]{1,2}"
_LEX = f"(select distinct unnest(regexp_extract_all(passage, '{_SYMBOL}')) as s from testitems)"
_WORD = "unnest(regexp_extract_all(text, '[A-Za-z0-9_]+'))"


def _symbols(t: Tables) -> DataFrame:
    """A lexicon of the symbols in the test items; short ones are doubtful, and those that differ in their number only share a gene."""
    s = t.testitems.select(F.explode(F.regexp_extract_all("passage", F.lit(_SYMBOL), F.lit(0))).alias("phrase")).distinct()
    return s.select("phrase", F.regexp_extract("phrase", "^[A-Z]+", 0).alias("id"), (F.length("phrase") < 5).alias("doubtful"))


def _names(t: Tables) -> DataFrame:
    said = [("forced expiratory volume", "FEV"), ("fasting glucose", "GLU"), ("visual acuity", "VIS"), ("serum creatinine", "CRE"), ("tumour volume", "TUM")]
    return t.spark.createDataFrame(said, "phrase string, id string")


@query(f"select doc_id, s as symbol, count(*) as n from (select doc_id, {_WORD} as w from documents) join {_LEX} on w = s group by all")
def symbol_mentions(t: Tables) -> DataFrame:
    lex = _symbols(t).select("phrase", F.col("phrase").alias("id"))
    return genes.phrase_spans(t.documents, lex, "doc_id", "text", 1, lower=False).groupBy("doc_id", F.col("phraseid").alias("symbol")).agg(F.count("*").alias("n"))


@query(f"""with w as (select doc_id, ws, generate_subscripts(ws, 1) as i, unnest(ws) as w from (select doc_id, regexp_extract_all(text, '[A-Za-z0-9_]+') as ws from documents)), h as (select doc_id, w, lower(ws[i-1]) as l1, lower(ws[i-2]) as l2, lower(ws[i+1]) as r1, lower(ws[i+2]) as r2 from w join {_LEX} on w = s),
 k as (select doc_id, regexp_extract(w, '^[A-Z]+') as marker, length(w) < 5 as doubtful, coalesce(l1 in ({', '.join(repr(x) for x in genes.LEFT_TRIGGERS)}), false) or coalesce(l2 in ({', '.join(repr(x) for x in genes.LEFT_TRIGGERS)}), false) or coalesce(r1 in ({', '.join(repr(x) for x in genes.RIGHT_TRIGGERS)}), false) or coalesce(r2 in ({', '.join(repr(x) for x in genes.RIGHT_TRIGGERS)}), false) as triggered, coalesce(l1 = 'pathway', false) or coalesce(r1 = 'pathway', false) as pathway from h)
 select doc_id, case when not doubtful or triggered then 'symbol' else 'symbolMaybe' end as kind, marker, count(*) as n from k where doubtful or not pathway group by all""")
def gene_symbols(t: Tables) -> DataFrame:
    """Sure and doubtful symbols by their trigger words."""
    none = _names(t).limit(0)
    return genes.gene_names(t.documents, none, _symbols(t)).groupBy("doc_id", "kind", "marker").agg(F.count("*").alias("n"))


def _genes(t: Tables) -> DataFrame:
    """Genes from names, symbols and the variant ids that test items give beside a symbol."""
    docs = t.documents.select("doc_id", "text")
    ids = ann.identifier_spans(docs, ["doc_id"], "text", kinds=["snp", "refseq"], cap=2**31 - 1).select("doc_id", "kind", F.col("ident").alias("marker"), "start", "end")
    table = t.testitems.select(F.explode(F.regexp_extract_all("passage", F.lit("rs[0-9]{3,10}"), F.lit(0))).alias("acc"), F.regexp_extract("passage", _SYMBOL, 0).alias("s")).where("s <> ''").select(F.lit("snp").alias("kind"), "acc", F.regexp_extract("s", "^[A-Z]+", 0).alias("gene"))
    return genes.resolved_genes(genes.gene_names(docs, _names(t), _symbols(t)).unionByName(ids), table)


@query()
def document_genes(t: Tables) -> DataFrame:
    """Genes of documents with evidence enough, by kind of marker."""
    return genes.supported_genes(_genes(t), t.documents)


@query()
def gene_ranks(t: Tables) -> DataFrame:
    return genes.ranked_genes(_genes(t))


@query(f"with p as (select distinct doc_id, regexp_extract(w, '^[A-Z]+') as g from (select doc_id, {_WORD} as w from documents) join {_LEX} on w = s), r as (select doc_id, g from p where doc_id % 3 <> 0 union select doc_id, 'NONE' from p where doc_id % 5 = 0) select (select count(*) from (select * from p intersect select * from r)) as tp, (select count(*) from (select * from p except select * from r)) as fp, (select count(*) from (select * from r except select * from p)) as fn")
def gene_benchmark(t: Tables) -> DataFrame:
    """Found pairs of document and gene against a list in which some are missing and some are more."""
    found = genes.phrase_spans(t.documents, _symbols(t).select("phrase", "id"), "doc_id", "text", 1, lower=False).select("doc_id", F.col("phraseid").alias("gene")).distinct()
    right = found.where("doc_id % 3 <> 0").unionByName(found.where("doc_id % 5 = 0").select("doc_id", F.lit("NONE").alias("gene")))
    return genes.pair_benchmark(found, right).select("tp", "fp", "fn")


@query()
def sentence_cooccurrence(t: Tables) -> DataFrame:
    """Sentences with a measure and a gene symbol."""
    measures = _names(t)
    symbols = _symbols(t).select("phrase", "id")
    return sentences.cooccurrences(t.documents, {"measure": measures, "gene": symbols}, "doc_id", "text").select("doc_id", "no", "measure", "gene")


@query()
def gene_pairs(t: Tables) -> DataFrame:
    """Sentences of 6 to 40 words with two genes, in chunks of 200 rows a source."""
    said = sentences.cooccurrences(t.documents.select("doc_id", "source", "text"), {"gene": _symbols(t).select("phrase", "id")}, "doc_id", "text")
    said = said.where((F.size("gene") >= 2) & F.size(F.split("sentence", " ")).between(6, 40))
    w = Window.partitionBy("_part").orderBy("doc_id", "no")
    return said.withColumn("_part", F.pmod("doc_id", F.lit(64))).withColumn("chunk", F.floor((F.row_number().over(w) - 1) / 200)).select("doc_id", "no", "gene", "_part", "chunk")


@query("select doc_id, x.g as \"group\", x.w as word from (select doc_id, unnest([{'g': 'danRer', 'w': case when contains(l, 'zebrafish') then 'zebrafish' when contains(l, 'danio') then 'danio' end}, {'g': 'sacCer', 'w': case when contains(l, 'yeast') then 'yeast' end}, {'g': 'mm', 'w': case when contains(l, 'mouse') then 'mouse' when contains(l, 'mice') then 'mice' end}]) as x from (select doc_id, lower(text) as l from documents)) where x.w is not null")
def species_keywords(t: Tables) -> DataFrame:
    """Genomes whose species a document names."""
    groups = {"danRer": ["zebrafish", "danio"], "sacCer": ["yeast"], "mm": ["mouse", "mice"]}
    return t.documents.select("doc_id", F.explode(sentences.first_keyword(F.col("text"), groups)).alias("x")).select("doc_id", "x.group", "x.word")


_DIS = ["carcinoma", "syndrome", "anaemia", "sclerosis", "dystrophy"]


@query("with a as (select distinct articleid, lower(keywords) as k, lower(title) as t, lower(abstract) as b from articles) select articleid, case when " + " or ".join(f"contains(k, '{d}')" for d in _DIS) + " then 'keywords' when " + " or ".join(f"contains(t, '{d}')" for d in _DIS) + " then 'title' when " + " or ".join(f"contains(b, '{d}')" for d in _DIS) + " then 'abstract' end as field from a")
def disease_fields(t: Tables) -> DataFrame:
    """The first of keywords, title and abstract that names a disease."""
    a = t.articles.select("articleid", "keywords", "title", "abstract").withColumns({c: F.lower(c) for c in ("keywords", "title", "abstract")}).distinct()
    return sentences.first_field_with(a, ["keywords", "title", "abstract"], _DIS).select("articleid", "field")


@query("select doc_id, lower(h) as hit, count(*) as n from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z]+-(?:related|onset|induced|dependent|mediated)')) as h from documents) group by all")
def dashed_words(t: Tables) -> DataFrame:
    """A word joined by a dash to one of a list."""
    hit = F.regexp_extract_all("text", F.lit("[A-Za-z]+-(?:related|onset|induced|dependent|mediated)"), F.lit(0))
    return t.documents.select("doc_id", F.explode(hit).alias("h")).groupBy("doc_id", F.lower("h").alias("hit")).agg(F.count("*").alias("n"))


@query("select f.fileid, a.pmid, a.pubyear, v as version from files f join (select articleid, max(pmid) as pmid, max(pubyear) as pubyear from articles group by articleid) a using (articleid), (select unnest(['hg18','hg19','grch37','rs1','c.1']) as v) where contains(lower(f.content), v)")
def version_keywords(t: Tables) -> DataFrame:
    """Keywords of a short list with the article's pmid and year."""
    a = t.articles.groupBy("articleid").agg(F.max("pmid").alias("pmid"), F.max("pubyear").alias("pubyear"))
    found = F.filter(F.array(*[F.lit(v) for v in ("hg18", "hg19", "grch37", "rs1", "c.1")]), lambda v: F.lower("content").contains(v))
    return t.files.select("fileid", "articleid", F.explode(found).alias("version")).join(a, "articleid").select("fileid", "pmid", "pubyear", "version")


@query("select doc_id, count(*) as n from (select doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) as w from documents where regexp_matches(lower(text), 'treatment|dose|drug')) where w in (select distinct unnest(regexp_extract_all(lower(passage), '[a-z]+(?:mab|nib|oxan|statin|azole)')) from testitems) group by doc_id having count(*) <= 150")
def drug_mentions(t: Tables) -> DataFrame:
    """Drug names in any spelling, in documents with a trigger word."""
    names = t.testitems.select(F.explode(F.regexp_extract_all(F.lower("passage"), F.lit("[a-z]+(?:mab|nib|oxan|statin|azole)"), F.lit(0))).alias("phrase")).distinct().withColumn("id", F.col("phrase"))
    return sentences.names_with_triggers(t.documents, names, "doc_id", "text", ["treatment", "dose", "drug"]).groupBy("doc_id").agg(F.count("*").alias("n"))


@query()
def modified_residues(t: Tables) -> DataFrame:
    """Sites given with serine, threonine or tyrosine in sentences on phosphorylation."""
    docs = t.documents.select("doc_id", F.concat("text", F.lit(" The phosphorylated residue was serine 12 or Thr-308.")).alias("text"))
    return sentences.modified_residues(docs, "doc_id", "text")


@query()
def gene_fusions(t: Tables) -> DataFrame:
    """Two symbols joined in sentences on fusions."""
    said = t.testitems.select(F.col("item_id").alias("doc_id"), F.concat(F.lit("A fusion of "), F.regexp_extract("passage", _SYMBOL, 0), F.lit("-XYZ77 was seen. "), "passage").alias("text"))
    lex = _symbols(t).select("phrase", "id").unionByName(t.spark.createDataFrame([("XYZ77", "XYZ")], "phrase string, id string"))
    return sentences.fusions(said, lex, "doc_id", "text")


@query("select a.articleid, count(*) as refs, max(case when j.journalid is null then 0 else 1 end) as known, coalesce(max(j.publisherid), 0) as publisher from (select distinct articleid, journal from articles) a join refs r on r.articleid = a.articleid left join journals j on j.title = a.journal group by a.articleid, a.journal")
def enriched_articles(t: Tables) -> DataFrame:
    """Articles with references, enriched by what is known of their journals; missing is 0."""
    a = t.articles.select("articleid", "journal").distinct()
    n = t.refs.groupBy("articleid").agg(F.count("*").alias("refs"))
    j = t.journals.select(F.col("title").alias("journal"), "publisherid").groupBy("journal").agg(F.max("publisherid").alias("publisherid"), F.lit(1).alias("k"))
    return a.join(n, "articleid").join(j, "journal", "left").select("articleid", "refs", F.coalesce("k", F.lit(0)).alias("known"), F.coalesce("publisherid", F.lit(0)).alias("publisher"))


@query("select f.fileid, a.pmid, coalesce(f.description, '') as description, count(r.pmid) as links from files f join (select articleid, max(pmid) as pmid from articles where pmid <> '' group by articleid) a using (articleid) left join (select distinct articleid, pmid from refs) r using (articleid) group by all")
def sequence_tables(t: Tables) -> DataFrame:
    """Files of mapped articles with their descriptions and the links of the article."""
    a = t.articles.where("pmid <> ''").groupBy("articleid").agg(F.max("pmid").alias("pmid"))
    r = t.refs.select("articleid", "pmid").distinct().groupBy("articleid").agg(F.count("pmid").alias("links"))
    return t.files.join(a, "articleid").join(r, "articleid", "left").select("fileid", "pmid", F.coalesce("description", F.lit("")).alias("description"), F.coalesce("links", F.lit(0)).alias("links"))


@query("select m as marker, count(*) as spans, count(distinct articleid) as articles from (select articleid, unnest(regexp_extract_all(content, 'rs[0-9]{3,10}')) as m from files) group by m")
def marker_counts(t: Tables) -> DataFrame:
    """Spans and distinct articles of each marker."""
    m = t.files.select("articleid", F.explode(F.regexp_extract_all("content", F.lit("rs[0-9]{3,10}"), F.lit(0))).alias("marker"))
    return m.groupBy("marker").agg(F.count("*").alias("spans"), F.countDistinct("articleid").alias("articles"))


@query("select p.p_partkey, c.n, 'part' as type from part p join (select l_partkey, count(*) as n from lineitem where l_returnflag = 'R' group by l_partkey) c on c.l_partkey = p.p_partkey")
def counted_features(t: Tables) -> DataFrame:
    """Features with a count above zero, with it and their type."""
    c = t.lineitem.where("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    return t.part.select("p_partkey").join(c, "p_partkey").select("p_partkey", "n", F.lit("part").alias("type"))


@query("select articleid, arg_min(k, p) as word from (select distinct articleid, k, instr(lower(title), k) as p from articles, (select unnest(['study','effect','patients','of','in']) as k) where instr(lower(title), k) > 0) group by articleid having count(*) > 0")
def first_title_word(t: Tables) -> DataFrame:
    """The word of a list that a title holds first; places are all different."""
    at = F.array(*[F.struct(F.instr(F.lower("title"), w).alias("at"), F.lit(w).alias("word")) for w in ("study", "effect", "patients", "of", "in")])
    a = t.articles.select("articleid", F.array_min(F.filter(at, lambda x: x["at"] > 0)).alias("x")).where("x is not null")
    return a.groupBy("articleid").agg(F.min("x").alias("x")).select("articleid", "x.word")


@query("with h as (select l_orderkey, l_suppkey, l_quantity, count(*) over (partition by l_orderkey) as n, max(l_quantity) over (partition by l_orderkey) as top from lineitem) select l_orderkey, l_suppkey, l_quantity from h where n <= 6 and l_quantity >= 0.9 * top")
def best_alignments(t: Tables) -> DataFrame:
    """Hits near the best of their query, of queries without too many."""
    w = Window.partitionBy("l_orderkey")
    h = t.lineitem.select("l_orderkey", "l_suppkey", "l_quantity", F.count("*").over(w).alias("n"), F.max("l_quantity").over(w).alias("top"))
    return h.where((F.col("n") <= 6) & (F.col("l_quantity") >= 0.9 * F.col("top"))).select("l_orderkey", "l_suppkey", "l_quantity")


@query("select articleid, string_agg(distinct db, ',' order by db) as dbs, count(*) as hits from (select articleid, unnest(string_split(source || ',' || lang, ',')) as db from articles where source <> '' and lang <> '') group by articleid")
def databases_of_articles(t: Tables) -> DataFrame:
    """Databases of each article, from packed target names."""
    d = t.articles.where("source <> '' and lang <> ''").select("articleid", F.explode(F.split(F.concat_ws(",", "source", "lang"), ",")).alias("db"))
    return d.groupBy("articleid").agg(F.array_join(F.sort_array(F.collect_set("db")), ",").alias("dbs"), F.count("*").alias("hits"))


@query("select a.o_orderkey, string_agg(distinct g, ',' order by g) as loci from (select o_orderkey, o_custkey % 100 as chrom, o_orderkey % 997 as s, o_orderkey % 997 + 5 as e from orders) a join (select p_partkey % 100 as chrom, p_partkey % 997 as s, p_partkey % 997 + 20 as e, unnest(string_split(p_name, ' ')) as g from part) b on a.chrom = b.chrom and a.s < b.e and b.s < a.e group by a.o_orderkey")
def locus_genes(t: Tables) -> DataFrame:
    """Genes of the loci that an annotation overlaps; a locus may name several."""
    a = t.orders.select("o_orderkey", F.pmod("o_custkey", F.lit(100)).cast("long").alias("chrom"), F.pmod("o_orderkey", F.lit(997)).cast("long").alias("start")).withColumn("end", F.col("start") + 5)
    b = t.part.select(F.pmod("p_partkey", F.lit(100)).cast("long").alias("chrom"), F.pmod("p_partkey", F.lit(997)).cast("long").alias("start"), "p_name").withColumn("end", F.col("start") + 20)
    hit = intervals.overlap_join(a, b, "chrom", 16).select("o_orderkey", F.explode(F.split("p_name2", " ")).alias("g"))
    return hit.groupBy("o_orderkey").agg(F.array_join(F.sort_array(F.collect_set("g")), ",").alias("loci"))


@query("select articleid, coalesce(nullif(regexp_replace(list_last(string_split(trim(coalesce(pubyear,'')), ' ')), '[^0-9]', '', 'g'), ''), '0') as year, trim(split_part(split_part(coalesce(authors,''), ';', 1), ',', 1)) as first_author from (select distinct articleid, pubyear, authors from articles where articleid in (select articleid from files))")
def mapped_articles(t: Tables) -> DataFrame:
    """Articles with files, formatted for loading."""
    a = t.articles.join(t.files.select("articleid").distinct(), "articleid", "left_semi").select("articleid", "pubyear", "authors").distinct()
    return a.select("articleid", text.clean_year(F.col("pubyear")).alias("year"), text.first_author(F.col("authors")).alias("first_author"))
