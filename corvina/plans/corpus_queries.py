"""Queries over the corpus tables: scans, filters, joins, identifiers, metadata functions, increments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvina.functions import ids, text
from corvina.operators.ordered import row_numbers
from corvina.operators import records
from corvina.plans.query import Registry, Tables

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles
_LATEST = "(select * from (select *, row_number() over (partition by articleid order by updateid desc) rn from articles) where rn=1)"


@query("select articleid, externalid, title, updateid from articles where updateid between 20 and 40")
def corpus_articles(t: Tables) -> DataFrame:
    return t.articles.where(F.col("updateid").between(20, 40)).select("articleid", "externalid", "title", "updateid")


@query("select fileid, articleid, filetype, length(content) as chars from files where updateid in (10, 11, 12, 13)")
def corpus_files(t: Tables) -> DataFrame:
    return t.files.where(F.col("updateid").isin(10, 11, 12, 13)).select("fileid", "articleid", "filetype", F.length("content").alias("chars"))


@query(f"select a.articleid, f.fileid, a.title, f.filetype, length(f.content) as chars from {_LATEST} a join files f on a.articleid = f.articleid")
def article_file_join(t: Tables) -> DataFrame:
    a = records.latest(t.articles.select("articleid", "updateid", "title"), "articleid")
    return a.join(t.files.select("articleid", "fileid", "filetype", "content"), "articleid").select("articleid", "fileid", "title", "filetype", F.length("content").alias("chars"))


@query(f"select f.fileid, a.journal from files f left join {_LATEST} a on a.articleid = f.articleid and a.source = 'pmc'")
def file_left_join(t: Tables) -> DataFrame:
    a = records.latest(t.articles.select("articleid", "updateid", "journal", "source"), "articleid").where("source = 'pmc'")
    return t.files.select("fileid", "articleid").join(a, "articleid", "left").select("fileid", "journal")


@query("select fileid, filetype from files where coalesce(filetype,'') in ('main','')")
def keep_main(t: Tables) -> DataFrame:
    return records.keep_main(t.files.select("fileid", "filetype"))


@query("""select fileid, mimetype from (select *, coalesce(filetype,'') in ('main','') as m, row_number() over (partition by articleid, coalesce(filetype,'') in ('main','')
 order by case when mimetype in ('text/xml','text/html') then 0 when mimetype='application/pdf' then 2 else 1 end, fileid) as rn from files) where not m or rn = 1""")
def keep_best_main(t: Tables) -> DataFrame:
    return records.keep_best_main(t.files.select("articleid", "fileid", "filetype", "mimetype")).select("fileid", "mimetype")


@query(f"select articleid*1000 as fileid, articleid, externalid, ' ' || coalesce(title,'') || ' ' || coalesce(abstract,'') || ' ' as content from {_LATEST}")
def pseudo_file(t: Tables) -> DataFrame:
    return records.pseudo_files(records.latest(t.articles.select("articleid", "updateid", "externalid", "title", "abstract"), "articleid"))


@query("select distinct articleid, pmid from articles where pmid in (select pmid from refs where pmid <> '') and pmid <> ''")
def filter_by_ids(t: Tables) -> DataFrame:
    return t.articles.where("pmid <> ''").select("articleid", "pmid").join(t.refs.where("pmid <> ''").select("pmid"), "pmid", "left_semi").distinct().select("articleid", "pmid")


@query("select articleid, updateid from articles where articleid in (select articleid from files where lower(content) like '%zebrafish%' or lower(content) like '%fibroblast%')")
def filter_by_keyword(t: Tables) -> DataFrame:
    return records.filter_by_keywords(t.articles.select("articleid", "updateid"), t.files.select("articleid", "content"), ["zebrafish", "fibroblast"])


@query("select articleid, printissn, eissn from articles where eissn in (select eissn from journals where publisherid < 10) or printissn in (select printissn from journals where publisherid < 10)")
def filter_by_issn(t: Tables) -> DataFrame:
    j = t.journals.where("publisherid < 10")
    a = t.articles.select("articleid", "updateid", "printissn", "eissn")
    e, p = j.select("eissn").where("eissn is not null").distinct(), j.select("printissn").where("printissn is not null").distinct()
    by_e = a.join(e, "eissn", "left_semi").select(a.columns)
    by_p = a.join(p, "printissn", "left_semi").select(a.columns)
    return by_e.union(by_p).distinct().select("articleid", "printissn", "eissn")


@query("select articleid, journal, pubyear from articles where pubyear >= '2015' and lang = 'de'")
def where_lookup(t: Tables) -> DataFrame:
    return t.articles.where("pubyear >= '2015' and lang = 'de'").select("articleid", "journal", "pubyear")


@query("select doi, max(articleid) as articleid, count(*) as n from articles where doi <> '' group by doi")
def latest_by_key(t: Tables) -> DataFrame:
    return t.articles.where("doi <> ''").groupBy("doi").agg(F.max("articleid").alias("articleid"), F.count("*").alias("n"))


@query("""select pmid, articleid, source from (select distinct pmid, articleid, source, row_number() over (partition by pmid order by
 case source when 'pmc' then 0 when 'elsevier' then 1 when 'springer' then 2 when 'medline' then 3 else 4 end, articleid, updateid) rn from articles where pmid <> '') where rn = 1""")
def lookup_by_priority(t: Tables) -> DataFrame:
    rank = F.when(F.col("source") == "pmc", 0).when(F.col("source") == "elsevier", 1).when(F.col("source") == "springer", 2).when(F.col("source") == "medline", 3).otherwise(4)
    return t.articles.where("pmid <> ''").groupBy("pmid").agg(F.min_by(F.struct("articleid", "source"), F.struct(rank, "articleid")).alias("x")).select("pmid", "x.articleid", "x.source")


@query("select r.articleid as citing, r.pmid, min(a.articleid) as cited from refs r join articles a on r.pmid = a.pmid where r.pmid <> '' group by r.articleid, r.pmid")
def bulk_lookup(t: Tables) -> DataFrame:
    target = t.articles.where("pmid <> ''").groupBy("pmid").agg(F.min("articleid").alias("cited"))
    return t.refs.where("pmid <> ''").select(F.col("articleid").alias("citing"), "pmid").distinct().join(target, "pmid").select("citing", "pmid", "cited")


@query("""select publisher, count(*) as n, sum(case when lang='en' then 1 else 0 end) as english, round(sum(case when lang='en' then 1 else 0 end)/count(*), 6) as ratio
 from articles where publisher <> '' group by publisher having count(*) >= 10 and sum(case when lang='en' then 1 else 0 end) > 0""")
def publisher_counts(t: Tables) -> DataFrame:
    english = F.sum(F.when(F.col("lang") == "en", 1).otherwise(0))
    g = t.articles.where("publisher <> ''").groupBy("publisher").agg(F.count("*").alias("n"), english.alias("english"))
    return g.where("n >= 10 and english > 0").withColumn("ratio", F.round(F.col("english") / F.col("n"), 6))


@query("select fileid*100000+7 as annotid, (fileid*100000+7)//100000000 as articleid, ((fileid*100000+7)//100000)%1000 as fileno, (fileid*100000+7)%100000 as annotno from files")
def split_annot_id(t: Tables) -> DataFrame:
    a = t.files.select(ids.annot_id(F.col("fileid"), F.lit(7)).alias("annotid"))
    return a.select("annotid", ids.split_annot_id(F.col("annotid")).alias("x")).select("annotid", "x.*")


@query("""select articleid, case when articleid>=1000000000 and articleid<2000000000 then 'pmc' when articleid>=2000000000 and articleid<2500000000 then 'elsevier' when articleid>=2500000000 and articleid<3000000000 then 'springer'
 when articleid>=3000000000 and articleid<3500000000 then 'medline' when articleid>=5000000000 and articleid<6000000000 then 'crawler' end as dataset from articles""")
def dataset_of_article(t: Tables) -> DataFrame:
    return t.articles.select("articleid", ids.dataset_of(F.col("articleid")).alias("dataset"))


@query("select articleid, fileid from files f where not exists (select 1 from refs r where r.articleid = f.articleid)")
def not_done(t: Tables) -> DataFrame:
    return t.files.select("articleid", "fileid").join(t.refs.select("articleid"), "articleid", "left_anti")


@query("select distinct updateid from articles where updateid not in (select updateid from files where updateid is not null)")
def unprocessed_updates(t: Tables) -> DataFrame:
    return t.articles.select("updateid").distinct().join(t.files.select("updateid").distinct(), "updateid", "left_anti")


@query("select updateid, max(articleid) as lastarticleid, max(convtime) as convtime, count(distinct origfile) as files, string_agg(distinct origfile, '|' order by origfile) as filelist from articles group by updateid")
def update_ledger(t: Tables) -> DataFrame:
    return t.articles.groupBy("updateid").agg(F.max("articleid").alias("lastarticleid"), F.max("convtime").alias("convtime"), F.countDistinct("origfile").alias("files"), F.array_join(F.sort_array(F.collect_set("origfile")), "|").alias("filelist"))


@query("select articleid, (row_number() over (partition by updateid order by articleid) - 1)//400 as chunk, updateid from (select distinct articleid, updateid from articles)")
def rechunk(t: Tables) -> DataFrame:
    numbered = row_numbers(t.articles.select("articleid", "updateid").distinct(), ["updateid"], ["articleid"])
    return numbered.select("articleid", F.floor((F.col("no") - 1) / 400).cast("long").alias("chunk"), "updateid")


@query("select updateid, articleid % 16 as chunk, count(*) as n from articles group by all")
def split_modulo(t: Tables) -> DataFrame:
    return t.articles.groupBy("updateid", F.pmod("articleid", F.lit(16)).alias("chunk")).agg(F.count("*").alias("n"))


@query(f"select a.articleid, coalesce(s.chars,0) + length(coalesce(a.abstract,'')) as size from {_LATEST} a left join (select articleid, sum(length(content)) chars from files group by 1) s on a.articleid = s.articleid")
def article_size(t: Tables) -> DataFrame:
    a = records.latest(t.articles.select("articleid", "updateid", "abstract"), "articleid")
    s = t.files.groupBy("articleid").agg(F.sum(F.length("content")).alias("chars"))
    return a.join(s, "articleid", "left").select("articleid", (F.coalesce("chars", F.lit(0)) + F.length(F.coalesce("abstract", F.lit("")))).alias("size"))


@query("select fileid, regexp_replace(replace(content, chr(7), chr(10)), '[\t\n\r]+', ' ', 'g') as line from files where content is not null")
def one_line_cells(t: Tables) -> DataFrame:
    return t.files.where("content is not null").select("fileid", text.one_line(F.translate("content", text.BEL, "\n")).alias("line"))


@query("select doc_id, regexp_replace(text, '\r\n|[\n\r]', chr(7), 'g') as cell from documents")
def escaped_cells(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.escaped(F.col("text")).alias("cell"))


@query("select doc_id, substr(regexp_replace(replace(replace(text,'<<<','<B>'),'>>>','</B>'),' +',' ','g'),1,500) as cell from documents")
def sql_cells(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.sql_cell(F.col("text"), 500).alias("cell"))


@query("select articleid, count(*) as n from articles group by articleid having count(*) > 1")
def duplicate_keys(t: Tables) -> DataFrame:
    return t.articles.groupBy("articleid").agg(F.count("*").alias("n")).where("n > 1")


@query("select externalid as key, arg_max(title, (updateid, articleid)) as value from articles where externalid <> '' group by externalid")
def key_value_last_wins(t: Tables) -> DataFrame:
    return t.articles.where("externalid <> ''").groupBy(F.col("externalid").alias("key")).agg(F.max_by("title", F.struct("updateid", "articleid")).alias("value"))


@query("""select distinct articleid, '>' || articleid || '|' || coalesce(nullif(pmid,''), nullif(doi,''), externalid) || ' ' || coalesce(title,'') || ' ' || coalesce(journal,'') || ' ' || coalesce(pubyear,'') as header from articles""")
def fasta_headers(t: Tables) -> DataFrame:
    ident = F.coalesce(F.nullif("pmid", F.lit("")), F.nullif("doi", F.lit("")), F.col("externalid"))
    blank = F.lit("")
    return t.articles.select("articleid", F.concat(F.lit(">"), F.col("articleid"), F.lit("|"), ident, F.lit(" "), F.coalesce("title", blank), F.lit(" "), F.coalesce("journal", blank), F.lit(" "), F.coalesce("pubyear", blank)).alias("header")).distinct()


@query("""select articleid, trim(coalesce(journal,'') || ' ' || coalesce(pubyear,'')) || case when coalesce(vol,'')<>'' then ', Vol ' || vol else '' end || case when coalesce(issue,'')<>'' then ', Issue ' || issue else '' end
 || case when coalesce(page,'')<>'' then ', Page ' || page else '' end as ref from articles""")
def reference_strings(t: Tables) -> DataFrame:
    parts = text.reference_string(F.col("journal"), F.col("pubyear"), F.col("vol"), F.col("issue"), F.col("page"))
    head = F.trim(F.concat_ws(" ", F.coalesce("journal", F.lit("")), F.coalesce("pubyear", F.lit(""))))
    return t.articles.select("articleid", F.concat(head, F.expr("''"), F.substring(parts, F.length(F.concat_ws(" ", F.coalesce("journal", F.lit("")), F.coalesce("pubyear", F.lit("")))) + 1, F.lit(10000))).alias("ref"))


@query("""select articleid, case when regexp_replace(regexp_extract(coalesce(pubyear,''),'(\\S*)\\s*$',1),'[^0-9]','','g')='' then '0' else regexp_replace(regexp_extract(coalesce(pubyear,''),'(\\S*)\\s*$',1),'[^0-9]','','g') end as year,
 trim(split_part(split_part(coalesce(authors,''),';',1),',',1)) as first, trim(split_part(split_part(coalesce(authors,''),';',-1),',',1)) as last from articles""")
def years_and_authors(t: Tables) -> DataFrame:
    return t.articles.select("articleid", text.clean_year(F.col("pubyear")).alias("year"), text.first_author(F.col("authors")).alias("first"), text.last_author(F.col("authors")).alias("last"))


@query("""select fileid, substr(regexp_replace(regexp_extract(coalesce(url,''),'^[a-z]+://([^/]*)',1),'^www\\.',''),1,17) || regexp_extract(coalesce(url,''),'^[a-z]+://[^/]*(/[^?#]*)?',1) as description from files""")
def url_descriptions(t: Tables) -> DataFrame:
    return t.files.select("fileid", text.url_description(F.col("url")).alias("description"))


@query("""with k as (select distinct articleid, lower(trim(doi)) as doi, case when coalesce(printissn,'')<>'' and trim(coalesce(vol,''))<>'' and trim(coalesce(issue,''))<>'' and trim(coalesce(page,''))<>''
 then printissn || '|' || split_part(split_part(trim(vol),' ',1),'-',1) || '|' || split_part(split_part(trim(issue),' ',1),'-',1) || '|' || split_part(split_part(trim(page),' ',1),'-',1) end as place from articles)
 select k.articleid, coalesce(d.t, p.t) as target, case when d.t is not null then 'doi' when p.t is not null then 'place' end as matched_by from k left join (select doi, max(articleid) t from k where doi <> '' group by doi) d on k.doi = d.doi
 left join (select place, max(articleid) t from k where place is not null group by place) p on k.place = p.place""")
def fingerprint_match(t: Tables) -> DataFrame:
    k = t.articles.select("articleid", F.lower(F.trim("doi")).alias("doi"), records.fingerprint_place(F.col("printissn"), F.col("vol"), F.col("issue"), F.col("page")).alias("place")).distinct()
    return records.linked_by_fingerprints(k, k, ["doi", "place"], "articleid", "articleid")


@query()
def fingerprint_cascade(t: Tables) -> DataFrame:
    c = F.col
    side = lambda df, i: df.select(i, F.lower(F.trim("doi")).alias("doi"), records.fingerprint_place(c("printissn"), c("vol"), c("issue"), c("page")).alias("place"), records.fingerprint_place(c("eissn"), c("vol"), c("issue"), c("page")).alias("eplace"), records.fingerprint_title(c("authors"), c("pubyear"), c("title")).alias("names")).distinct()
    a = side(t.articles, "articleid")
    return records.linked_by_fingerprints(a, a, ["doi", "place", "eplace", "names"], "articleid", "articleid", others=True)


@query("""select a.articleid, coalesce(m.pmid, a.pmid) as pmid from (select distinct articleid, doi, pmid from articles) a left join (select doi, max(pmid) as pmid from refs where doi <> '' and pmid <> '' group by doi) m on a.doi = m.doi""")
def pmid_update(t: Tables) -> DataFrame:
    m = t.refs.where("doi <> '' and pmid <> ''").groupBy("doi").agg(F.max("pmid").alias("newer"))
    return t.articles.select("articleid", "doi", "pmid").distinct().join(m, "doi", "left").select("articleid", F.coalesce("newer", "pmid").alias("pmid"))


@query("select f.articleid, f.n as files, r.n as refs from (select articleid, count(*) n from files group by 1) f join (select articleid, count(*) n from refs group by 1) r on f.articleid = r.articleid")
def cogrouped(t: Tables) -> DataFrame:
    f = t.files.groupBy("articleid").agg(F.count("*").alias("files"))
    return f.join(t.refs.groupBy("articleid").agg(F.count("*").alias("refs")), "articleid")


@query("select cast(articleid as varchar)[1:6] as prefix, count(*) as n, min(fileid) as first, max(fileid) as last from files group by 1")
def grouped_by_prefix(t: Tables) -> DataFrame:
    return t.files.groupBy(F.substring(F.col("articleid").cast("string"), 1, 6).alias("prefix")).agg(F.count("*").alias("n"), F.min("fileid").alias("first"), F.max("fileid").alias("last"))


@query("""select case when grouping(journal)=0 then 'journal' when grouping(source)=0 then 'source' when grouping(pubyear)=0 then 'year' else 'all' end as kind, journal, source, pubyear, count(*) as n, count(distinct articleid) as articles, count(distinct pmid) as pmids
 from articles group by grouping sets ((journal),(source),(pubyear),())""")
def corpus_stats(t: Tables) -> DataFrame:
    t.articles.createOrReplaceTempView("corvina_articles")
    return t.spark.sql("""select case when grouping(journal)=0 then 'journal' when grouping(source)=0 then 'source' when grouping(pubyear)=0 then 'year' else 'all' end as kind, journal, source, pubyear, count(*) as n,
      count(distinct articleid) as articles, count(distinct pmid) as pmids from corvina_articles group by grouping sets ((journal),(source),(pubyear),())""")


@query("select mimetype, count(*) as files, sum(length(content)) as chars, max(length(content)) as most, sum(case when coalesce(filetype,'') in ('main','') then 1 else 0 end) as mains from files group by mimetype")
def file_stats(t: Tables) -> DataFrame:
    return t.files.groupBy("mimetype").agg(F.count("*").alias("files"), F.sum(F.length("content")).alias("chars"), F.max(F.length("content")).alias("most"), F.sum(F.when(F.coalesce("filetype", F.lit("")).isin("main", ""), 1).otherwise(0)).alias("mains"))


@query("""select coalesce(nullif(printissn,''), nullif(eissn,'')) as issn, count(distinct pmid) as pmids, min(pubyear) as minyear from articles where coalesce(nullif(printissn,''), nullif(eissn,'')) is not null and pmid <> '' group by 1""")
def pmids_by_issn(t: Tables) -> DataFrame:
    issn = F.coalesce(F.nullif("printissn", F.lit("")), F.nullif("eissn", F.lit("")))
    return t.articles.where(issn.isNotNull() & (F.col("pmid") != "")).groupBy(issn.alias("issn")).agg(F.countDistinct("pmid").alias("pmids"), F.min("pubyear").alias("minyear"))


@query("""select articleid, authoryear || case when n > 1 then chr(97 + cast((rn-1)//52 as int)) || substr('abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ', 1 + cast((rn-1)%52 as int), 1) else '' end as uniqueid
 from (select articleid, authoryear, row_number() over (partition by authoryear order by articleid) rn, count(*) over (partition by authoryear) n from
 (select articleid, trim(split_part(split_part(coalesce(max(authors),''),';',1),',',1)) || coalesce(max(pubyear),'') as authoryear from articles group by articleid))""")
def author_year_ids(t: Tables) -> DataFrame:
    a = t.articles.groupBy("articleid").agg(F.max("authors").alias("authors"), F.max("pubyear").alias("pubyear")).select("articleid", F.concat(text.first_author(F.col("authors")), F.coalesce("pubyear", F.lit(""))).alias("ay"))
    w = Window.partitionBy("ay").orderBy("articleid")
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    k = F.row_number().over(w) - 1
    suffix = F.concat(F.substring(F.lit(letters), (F.floor(k / 52) + 1).cast("int"), F.lit(1)), F.substring(F.lit(letters), (F.pmod(k, F.lit(52)) + 1).cast("int"), F.lit(1)))
    return a.select("articleid", F.concat("ay", F.when(F.count("*").over(Window.partitionBy("ay")) > 1, suffix).otherwise(F.lit(""))).alias("uniqueid"))


@query("select articleid, row_number() over (partition by source order by articleid) + case source when 'pmc' then 1000000000 when 'elsevier' then 2000000000 when 'springer' then 2500000000 when 'medline' then 3000000000 else 5000000000 end as newid from (select distinct articleid, source from articles)")
def assign_ids(t: Tables) -> DataFrame:
    start = F.when(F.col("source") == "pmc", 1000000000).when(F.col("source") == "elsevier", 2000000000).when(F.col("source") == "springer", 2500000000).when(F.col("source") == "medline", 3000000000).otherwise(F.lit(5000000000))
    return row_numbers(t.articles.select("articleid", "source").distinct(), ["source"], ["articleid"]).select("articleid", (F.col("no") + start).alias("newid"))


@query("select externalid, min(articleid) as articleid from articles where pmid not in (select pmid from refs where pmid is not null) group by externalid")
def first_per_id_not_done(t: Tables) -> DataFrame:
    return t.articles.where("pmid is not null").join(t.refs.select("pmid"), "pmid", "left_anti").groupBy("externalid").agg(F.min("articleid").alias("articleid"))


@query("""select fileid, case when rn > 1 then '!' || url else url end as url from (select fileid, url, row_number() over (partition by url order by convtime desc, fileid desc) rn from files)""")
def superseded_urls(t: Tables) -> DataFrame:
    w = Window.partitionBy("url").orderBy(F.desc("convtime"), F.desc("fileid"))
    return t.files.select("fileid", "url", F.row_number().over(w).alias("rn")).select("fileid", F.when(F.col("rn") > 1, F.concat(F.lit("!"), "url")).otherwise(F.col("url")).alias("url"))


@query("select fileid, substr(content,1,100) as title, substr(content,101,900) as abstract from files where content <> ''")
def minimal_articles(t: Tables) -> DataFrame:
    return t.files.where("content <> ''").select("fileid", F.substring("content", 1, 100).alias("title"), F.substring("content", 101, 900).alias("abstract"))


@query("select distinct articleid, pmid from articles where pubyear >= '2010' and (printissn in (select printissn from journals where journalid < 60) or eissn in (select eissn from journals where journalid < 60))")
def pmids_of_issns(t: Tables) -> DataFrame:
    j = t.journals.where("journalid < 60")
    a = t.articles.where("pubyear >= '2010'").select("articleid", "pmid", "printissn", "eissn")
    return a.join(j.select("printissn").where("printissn is not null"), "printissn", "left_semi").select("articleid", "pmid").union(a.join(j.select("eissn").where("eissn is not null"), "eissn", "left_semi").select("articleid", "pmid")).distinct()


@query("select p.pubname, unnest.issn from publishers p join (select publisherid, unnest([printissn, eissn]) as issn from journals) unnest on p.publisherid = unnest.publisherid where unnest.issn is not null")
def publisher_issns(t: Tables) -> DataFrame:
    j = t.journals.select("publisherid", F.explode(F.array("printissn", "eissn")).alias("issn")).where("issn is not null")
    return t.publishers.select("publisherid", "pubname").join(j, "publisherid").select("pubname", "issn")


@query("select distinct pmid from articles where pmid <> '' intersect select distinct pmid from refs where pmid <> ''")
def in_both(t: Tables) -> DataFrame:
    return t.articles.where("pmid <> ''").select("pmid").intersect(t.refs.where("pmid <> ''").select("pmid"))


@query("""select coalesce(n.pmid, p.pmid) as pmid, case when n.pmid is not null then 'neg' else 'pos' end as label from (select distinct pmid from articles where source='pmc' and pmid<>'') p full join (select distinct pmid from articles where source='medline' and pmid<>'') n on p.pmid = n.pmid""")
def class_map(t: Tables) -> DataFrame:
    ids_of = lambda s, c: t.articles.where((F.col("source") == s) & (F.col("pmid") != "")).select("pmid").distinct().withColumn(c, F.lit(c))
    return ids_of("pmc", "pos").join(ids_of("medline", "neg"), "pmid", "full").select("pmid", F.coalesce("neg", "pos").alias("label"))


@query("""select articleid, title, pubyear from (select *, row_number() over (partition by externalid order by pubyear desc, articleid, updateid) rn from articles where journal in (select title from journals where journalid < 20)) where rn = 1""")
def newest_by_external_id(t: Tables) -> DataFrame:
    j = t.journals.where("journalid < 20").select(F.col("title").alias("journal"))
    w = Window.partitionBy("externalid").orderBy(F.desc_nulls_last("pubyear"), "articleid", "updateid")
    return t.articles.join(F.broadcast(j), "journal", "left_semi").withColumn("rn", F.row_number().over(w)).where("rn = 1").select("articleid", "title", "pubyear")
