"""Queries over texts: tokens, counts, spans, dictionaries, statistics of words, classification, sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvina.functions import sequences, text
from corvina.operators import annotators as ann
from corvina.operators import sections as sec
from corvina.plans.query import Registry, Tables

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles
_TOK = "regexp_extract_all(lower(text), '[a-z0-9_]+')"
_PLACED = f"(select doc_id, w, i, lag(w) over (partition by doc_id order by i) as l, lead(w) over (partition by doc_id order by i) as r, lead(w, 2) over (partition by doc_id order by i) as r2 from (select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as i from (select doc_id, {_TOK} as ws from documents)))"
_TOKENS = f"(select doc_id, unnest({_TOK}) as w from documents)"


def _tokens(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.explode(text.ascii_words(F.col("text"))).alias("w"))


@query(f"select doc_id, count(*) as tokens, count(distinct w) as words from {_TOKENS} group by doc_id")
def word_tokens(t: Tables) -> DataFrame:
    w = text.ascii_words(F.col("text"))
    return t.documents.select("doc_id", F.size(w).cast("long").alias("tokens"), F.size(F.array_distinct(w)).cast("long").alias("words")).where("tokens > 0").groupBy("doc_id").agg(F.sum("tokens").alias("tokens"), F.max("words").alias("words"))


@query(f"select doc_id, w, count(*) as n from {_TOKENS} group by doc_id, w")
def word_counts(t: Tables) -> DataFrame:
    return _tokens(t).groupBy("doc_id", "w").agg(F.count("*").alias("n"))


@query(f"select w, count(distinct doc_id) as docs, count(*) as n from {_TOKENS} group by w having count(distinct doc_id) >= 10")
def doc_freq(t: Tables) -> DataFrame:
    per = _tokens(t).groupBy("w", "doc_id").agg(F.count("*").alias("k"))
    return per.groupBy("w").agg(F.count("*").alias("docs"), F.sum("k").alias("n")).where("docs >= 10")


@query(f"select w || ' ' || r as bigram, count(*) as n from {_PLACED} where r is not null group by 1 having count(*) >= 20")
def bigrams(t: Tables) -> DataFrame:
    return t.documents.select(F.explode(text.bigrams(text.ascii_words(F.col("text")))).alias("bigram")).groupBy("bigram").agg(F.count("*").alias("n")).where("n >= 20")


@query(f"select w, doc_id // 100000 as block, count(*) as docs, min(doc_id) as first, max(doc_id) as last, md5(string_agg(cast(doc_id as varchar), ',' order by doc_id)) as posting from (select distinct w, doc_id from {_TOKENS}) where length(w) > 3 group by all")
def inverted_index(t: Tables) -> DataFrame:
    """Postings of each word, in blocks of document ids, so that no row grows with the corpus."""
    posting = F.md5(F.array_join(F.transform(F.sort_array(F.collect_list("doc_id")), lambda x: x.cast("string")), ","))
    words = t.documents.select("doc_id", F.explode(F.array_distinct(text.ascii_words(F.col("text")))).alias("w")).where("length(w) > 3").distinct()
    return words.groupBy("w", F.floor(F.col("doc_id") / 100000).alias("block")).agg(F.count("*").alias("docs"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), posting.alias("posting"))


@query(f"select w, count(*) as n from {_TOKENS} where length(w) > 2 and not regexp_matches(w, '^[0-9]') and len(list_distinct(string_split(w, ''))) > 2 and not regexp_matches(w, '[_<>]') group by w having count(*) > 5")
def good_words(t: Tables) -> DataFrame:
    return _tokens(t).groupBy("w").agg(F.count("*").alias("n")).where("n > 5").where(text.good_word(F.col("w")))


@query("select w, count(distinct doc_id) as docs from (select doc_id, unnest(regexp_extract_all(text, '[A-Z][A-Z0-9]{2,9}')) as w from documents) group by w having count(distinct doc_id) >= 3")
def upcase_words(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Z][A-Z0-9]{2,9}"), F.lit(0)))).alias("w")).distinct().groupBy("w").agg(F.count("*").alias("docs")).where("docs >= 3")


_KEYS = ["syndrome", "disease", "dystrophy"]
_FLANK = f"(select w as word, l, r from {_PLACED} where w in ('syndrome','disease','dystrophy'))"


def _flanks(t: Tables) -> DataFrame:
    near = lambda ws: F.filter(F.transform(ws, lambda x, i: F.struct(x.alias("word"), F.when(i > 0, F.get(ws, i - 1)).alias("l"), F.get(ws, i + 1).alias("r"))), lambda x: x["word"].isin(*_KEYS))
    return t.documents.select(F.explode(text.bound(text.ascii_words(F.col("text")), near)).alias("x")).select("x.*")


@query(f"select word, side, flank, count(*) as n from (select word, 'left' as side, l as flank from {_FLANK} union all select word, 'right', r from {_FLANK}) where flank is not null group by all")
def flank_words(t: Tables) -> DataFrame:
    return _flanks(t).select("word", F.explode(F.create_map(F.lit("left"), "l", F.lit("right"), "r")).alias("side", "flank")).where("flank is not null").groupBy("word", "side", "flank").agg(F.count("*").alias("n"))


@query(f"select word, side, string_agg(flank || '=' || n, '|' order by n desc, flank) as top from (select *, row_number() over (partition by word, side order by n desc, flank) rn from (select word, side, flank, count(*) as n from (select word, 'left' as side, l as flank from {_FLANK} union all select word, 'right', r from {_FLANK}) where flank is not null group by all)) where rn <= 30 group by word, side")
def flank_histogram(t: Tables) -> DataFrame:
    top = flank_words(t).withColumn("rn", F.row_number().over(Window.partitionBy("word", "side").orderBy(F.desc("n"), "flank"))).where("rn <= 30")
    return top.groupBy("word", "side").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rn", F.concat("flank", F.lit("="), F.col("n").cast("string")).alias("x")))), lambda x: x["x"]), "|").alias("top"))


@query(f"select word, count(*) as hits, sum(case when r in ('in','of','gene','phenotype') then 1 else 0 end) as flagged, round(sum(case when r in ('in','of','gene','phenotype') then 1 else 0 end)/count(*), 6) as ratio from {_FLANK} group by word")
def flagged_ratio(t: Tables) -> DataFrame:
    g = _flanks(t).groupBy("word").agg(F.count("*").alias("hits"), F.sum(F.when(F.col("r").isin("in", "of", "gene", "phenotype"), 1).otherwise(0)).alias("flagged"))
    return g.withColumn("ratio", F.round(F.col("flagged") / F.col("hits"), 6))


_VAR = r"[cp]\.[A-Z]?[a-z]{0,2}[0-9]+[A-Za-z>]+"


@query(f"select fileid, hit, count(*) as n from (select fileid, unnest(regexp_extract_all(content, '{_VAR}')) as hit from files) group by all")
def regex_hits(t: Tables) -> DataFrame:
    return ann.regex_spans(t.files, _VAR, ["fileid"]).groupBy("fileid", "hit").agg(F.count("*").alias("n"))


@query()
def regex_spans(t: Tables) -> DataFrame:
    """Annotation rows with ids, positions and snippets."""
    files = t.files.where("content is not null").select("fileid", "externalid", F.translate("content", text.BEL, "\n").alias("content"))
    spans = ann.with_annot_ids(ann.regex_snippets(files, _VAR, ["fileid", "externalid"], cap=1000))
    return spans.select("annotid", "externalid", "start", "end", "hit", "snippet")


@query(f"""with p as (select fileid, regexp_extract_all(content,'{_VAR}') h, regexp_split_to_array(content,'{_VAR}') g from files where regexp_matches(content,'{_VAR}'))
 select fileid, i as no, list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:i-1], lambda x: length(x))),0) as start, h[i] as hit from (select *, unnest(range(1, len(h)+1)) as i from p)""")
def span_starts(t: Tables) -> DataFrame:
    w = Window.partitionBy("fileid").orderBy("start")
    return ann.regex_spans(t.files, _VAR, ["fileid"]).select("fileid", F.row_number().over(w).cast("long").alias("no"), F.col("start").cast("long").alias("start"), "hit")


@query("select externalid, max(case when regexp_matches(lower(content), 'zebrafish|yeast') then 1 else 0 end) as found from files where content is not null group by externalid")
def regex_doc_flag(t: Tables) -> DataFrame:
    return t.files.where("content is not null").groupBy("externalid").agg(F.max(F.lower("content").rlike("zebrafish|yeast").cast("int")).alias("found"))


@query("select doc_id, k as keyword, instr(lower(text), k) - 1 as start from documents, (select unnest(['mutation','placebo','fibroblast','sensitivity','zebrafish']) as k) where instr(lower(text), k) > 0")
def keyword_hits(t: Tables) -> DataFrame:
    ks = ["mutation", "placebo", "fibroblast", "sensitivity", "zebrafish"]
    low = F.lower("text")
    d = t.documents.select("doc_id", F.explode(F.filter(F.array(*[F.struct(F.lit(k).alias("keyword"), (F.instr(low, k) - 1).cast("long").alias("start")) for k in ks]), lambda x: x["start"] >= 0)).alias("x"))
    return d.select("doc_id", "x.keyword", "x.start")


@query("select k as keyword, doc_id from (select k, doc_id, count(*) over (partition by k) as n from documents, (select unnest(['mutation','placebo','fibroblast','yeast']) as k) where instr(lower(text), k) > 0) where n < 400")
def keyword_articles(t: Tables) -> DataFrame:
    low = F.lower("text")
    hits = t.documents.select("doc_id", F.explode(F.array_compact(F.array(*[F.when(low.contains(k), F.lit(k)) for k in ("mutation", "placebo", "fibroblast", "yeast")]))).alias("keyword"))
    n = hits.groupBy("keyword").agg(F.count("*").alias("n")).where("n < 400")
    return hits.join(n, "keyword").select("keyword", "doc_id")


@query("select distinct articleid, lower(doi) as doi from articles where lower(doi) in (select lower(doi) from refs where doi <> '')")
def doi_members(t: Tables) -> DataFrame:
    return t.articles.select("articleid", F.lower("doi").alias("doi")).join(t.refs.where("doi <> ''").select(F.lower("doi").alias("doi")), "doi", "left_semi").distinct().select("articleid", "doi")


@query()
def sentence_split(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.posexplode(text.sentences(F.col("text"))).alias("no", "sentence"))


@query("select doc_id, count(*) as sentences, sum(length(s)) as chars from (select doc_id, unnest(regexp_split_to_array(text, '[.!?]\\s+')) as s from documents) where length(s) >= 30 and len(regexp_extract_all(s, '[a-z0-9_]+')) >= 5 group by doc_id")
def clean_sentences(t: Tables) -> DataFrame:
    s = t.documents.select("doc_id", F.explode(F.split("text", r"[.!?]\s+")).alias("s")).where((F.length("s") >= 30) & (F.regexp_count("s", F.lit("[a-z0-9_]+")) >= 5))
    return s.groupBy("doc_id").agg(F.count("*").alias("sentences"), F.sum(F.length("s")).alias("chars"))


_CLASSES = "(select doc_id, case when grade <= 2 then 'pos' else 'neg' end as label from (select doc_id, min(grade) as grade from levellabels group by doc_id))"


@query(f"""with c as {_CLASSES}, d as (select distinct doc_id, w from {_TOKENS}), n as (select sum(case when label='pos' then 1 else 0 end) as np, sum(case when label='neg' then 1 else 0 end) as nn from c)
 select w, a as docs, p as posdocs, q as negdocs, round(case when a=0 then 0 else power(p - greatest(floor(a*np/(np+nn)),1),2)/greatest(floor(a*np/(np+nn)),1) + power(q - greatest(floor(a*nn/(np+nn)),1),2)/greatest(floor(a*nn/(np+nn)),1) end, 6) as chisq
 from (select w, count(*) as a, sum(case when label='pos' then 1 else 0 end) as p, sum(case when label='neg' then 1 else 0 end) as q from d join c on d.doc_id=c.doc_id group by w), n""")
def chi_square_words(t: Tables) -> DataFrame:
    c = t.levellabels.groupBy("doc_id").agg(F.min("grade").alias("grade")).select("doc_id", F.when(F.col("grade") <= 2, 1).otherwise(0).alias("pos"))
    n = c.agg(F.sum("pos").alias("np"), F.sum(1 - F.col("pos")).alias("nn"))
    docs = t.documents.join(c, "doc_id").select("pos", F.explode(F.array_distinct(text.ascii_words(F.col("text")))).alias("w"))
    g = docs.groupBy("w").agg(F.count("*").alias("docs"), F.sum("pos").alias("posdocs"), F.sum(1 - F.col("pos")).alias("negdocs")).crossJoin(F.broadcast(n))  # one row
    part = lambda got, k: F.pow(F.col(got) - F.greatest(F.floor(F.col("docs") * F.col(k) / (F.col("np") + F.col("nn"))), F.lit(1)), F.lit(2)) / F.greatest(F.floor(F.col("docs") * F.col(k) / (F.col("np") + F.col("nn"))), F.lit(1))
    return g.select("w", "docs", "posdocs", "negdocs", F.round(part("posdocs", "np") + part("negdocs", "nn"), 6).alias("chisq"))


@query(f"""with c as {_CLASSES}, d as (select distinct doc_id, w from {_TOKENS})
 select w, p as posdocs, q as negdocs from (select w, sum(case when label='pos' then 1 else 0 end) as p, sum(case when label='neg' then 1 else 0 end) as q from d join c on d.doc_id=c.doc_id group by w) where p > 3 and p < 30 and q > 3 and q < 30""")
def word_range(t: Tables) -> DataFrame:
    return chi_square_words(t).where("posdocs > 3 and posdocs < 30 and negdocs > 3 and negdocs < 30").select("w", "posdocs", "negdocs")


@query("""with s as (select doc_id, grade, len(regexp_extract_all(text,'[a-z0-9_]+')) as n, length(text) as chars from levellabels join documents using (doc_id)), p as (select grade <= 2 as truth, chars < 5.6*n as guess from s)
 select sum((truth and guess)::int) as tp, sum((not truth and guess)::int) as fp, sum((truth and not guess)::int) as fn, sum((not truth and not guess)::int) as tn, round(sum((truth and guess)::int)/sum(guess::int),6) as prec, round(sum((truth and guess)::int)/sum(truth::int),6) as recall from p""")
def confusion(t: Tables) -> DataFrame:
    s = t.levellabels.join(t.documents, "doc_id").select((F.col("grade") <= 2).alias("truth"), (F.length("text") < 5.6 * F.regexp_count("text", F.lit("[a-z0-9_]+"))).alias("guess"))
    n = lambda c: F.sum(c.cast("int"))
    a, b = F.col("truth"), F.col("guess")
    return s.agg(n(a & b).alias("tp"), n(~a & b).alias("fp"), n(a & ~b).alias("fn"), n(~a & ~b).alias("tn"), F.round(n(a & b) / n(b), 6).alias("prec"), F.round(n(a & b) / n(a), 6).alias("recall"))


@query("""with p as (select distinct articleid, pmid from refs where pmid <> ''), r as (select distinct articleid, artpmid as pmid from refs where artpmid <> ''), i as (select * from p intersect select * from r)
 select (select count(*) from i) as tp, (select count(*) from p) - (select count(*) from i) as fp, (select count(*) from r) - (select count(*) from i) as fn""")
def set_benchmark(t: Tables) -> DataFrame:
    p = t.refs.where("pmid <> ''").select("articleid", "pmid").distinct().withColumn("p", F.lit(1))
    r = t.refs.where("artpmid <> ''").select("articleid", F.col("artpmid").alias("pmid")).distinct().withColumn("r", F.lit(1))
    j = p.join(r, ["articleid", "pmid"], "full")
    return j.agg(F.count(F.when(F.col("p").isNotNull() & F.col("r").isNotNull(), 1)).alias("tp"), F.count(F.when(F.col("r").isNull(), 1)).alias("fp"), F.count(F.when(F.col("p").isNull(), 1)).alias("fn"))


@query("select articleid, string_agg(class, ',' order by score desc, class) as classes, string_agg(cast(score as varchar), ',' order by score desc, class) as scores from (select articleid, journal as class, count(*) as score from refs where journal <> '' group by all) where score > 1 group by articleid")
def class_summary(t: Tables) -> DataFrame:
    s = t.refs.where("journal <> ''").groupBy("articleid", F.col("journal").alias("class")).agg(F.count("*").alias("score")).where("score > 1")
    w = Window.partitionBy("articleid").orderBy(F.desc("score"), "class")
    o = s.withColumn("rn", F.row_number().over(w)).groupBy("articleid").agg(F.sort_array(F.collect_list(F.struct("rn", "class", "score"))).alias("x"))
    return o.select("articleid", F.array_join(F.col("x.class"), ",").alias("classes"), F.array_join(F.transform("x", lambda x: x["score"].cast("string")), ",").alias("scores"))


@query("""select dimer, n, round(ln(1 + n / (sum(n) over (partition by dimer[1]))), 6) as logp from (select dimer, count(*) as n from (select unnest(list_transform(range(1, length(w)), lambda i: substr(w, i, 2))) as dimer from (select unnest(regexp_extract_all(lower(title), '[a-z]+')) as w from articles)) group by dimer)""")
def markov_dimers(t: Tables) -> DataFrame:
    w = t.articles.where("title is not null").select(F.explode(F.regexp_extract_all(F.lower("title"), F.lit("[a-z]+"), F.lit(0))).alias("w")).where("length(w) > 1")
    n = w.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substring(F.col("w"), i, F.lit(2)))).alias("dimer")).groupBy("dimer").agg(F.count("*").alias("n"))
    return n.withColumn("logp", F.round(F.log1p(F.col("n") / F.sum("n").over(Window.partitionBy(F.substring("dimer", 1, 1)))), 6))


_LEX = [("forced expiratory volume", "P1"), ("fasting glucose", "P2"), ("glucose", "P3"), ("visual acuity", "P4"), ("body mass index", "P5"), ("serum creatinine", "P6"), ("tumour volume", "P7"), ("volume", "P8")]


@query()
def phrase_match(t: Tables) -> DataFrame:
    """Longest phrases of a lexicon by a token trie."""
    tag = ann.phrase_tagger("measures", _LEX, cap=2000)
    return ann.run_tagger(t.files.where("content is not null").select("fileid", F.translate("content", text.BEL, "\n").alias("content")), tag, ["fileid"])


_LEX_SQL = ", ".join(f"('{p}', '{i}', {len(p.split())})" for p, i in _LEX)


@query(f"""with l as (select * from (values {_LEX_SQL}) as l(g, id, n)), m as (select doc_id, i - 1 as pos, n, id from {_PLACED} p join l on (n = 1 and w = g) or (n = 2 and w || ' ' || r = g) or (n = 3 and w || ' ' || r || ' ' || r2 = g)),
 b as (select doc_id, pos, max(n) as n, arg_max(id, n) as id from m group by doc_id, pos), c as (select *, max(pos + n) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding) as upto from b)
 select doc_id, pos, n, id as phraseid from c where upto is null or upto <= pos""")
def phrase_join(t: Tables) -> DataFrame:
    """All phrases of the lexicon, nested ones too: the longest at each place."""
    lex = t.spark.createDataFrame(_LEX, "phrase string, id string")
    return ann.phrase_join(t.documents, lex, "doc_id", "text", 3).select("doc_id", F.col("pos").cast("long").alias("pos"), F.col("n").cast("long").alias("n"), "phraseid")


@query()
def identifiers(t: Tables) -> DataFrame:
    """All kinds in all files; no file is dropped for the number of its spans."""
    return ann.identifier_spans(t.files, ["fileid"], cap=2**31 - 1)


@query("select doc_id, n from (select doc_id, len(regexp_extract_all(text, 'c\\.[0-9]+')) as n from documents) where n between 1 and 20")
def capped_documents(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.regexp_count("text", F.lit(r"c\.[0-9]+")).cast("long").alias("n")).where("n between 1 and 20")


@query()
def variants(t: Tables) -> DataFrame:
    return ann.run_tagger(t.files.where("content is not null").select("fileid", "content"), ann.variant_tagger, ["fileid"])


@query("select w, count(*) as n from (select unnest(regexp_extract_all(lower(text), '[a-z]+omics?')) as w from documents) group by w")
def omics_words(t: Tables) -> DataFrame:
    return t.documents.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+omics?"), F.lit(0))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))


@query()
def sections(t: Tables) -> DataFrame:
    """Sections of files by header lines, and by the family names of the citations that stand in at least ten of these."""
    names = t.refs.where("authors <> ''").select(F.lower(text.first_author(F.col("authors"))).alias("name")).where(F.length("name") > 3).groupBy("name").agg(F.count("*").alias("n")).where("n >= 10")
    # the commonest names suffice to tell dense stretches: a bounded list
    known = {r[0] for r in names.orderBy(F.desc("n"), "name").limit(20_000).collect()} | {"references", "bibliography", "literature", "refereces"}
    files = t.files.where("content is not null").select("fileid", F.translate("content", text.BEL, "\n").alias("content"))
    return ann.run_tagger(files, sec.section_tagger_for(known, "sections-names"), ["fileid"]).select("annotid", "fileid", "start", "end", "section")


@query()
def nucleotides(t: Tables) -> DataFrame:
    """Nucleotide sequences in files."""
    return ann.run_tagger(t.files.where("content is not null").select("fileid", F.translate("content", text.BEL, "\n").alias("content")), ann.dna_tagger, ["fileid"])


@query(f"""with s as (select doc_id, unnest(regexp_split_to_array(text, '[.!?]\\s+')) as s from documents), u as (select distinct doc_id, s from s where length(s) > 20), t as (select doc_id, s, unnest(list_distinct(regexp_extract_all(lower(s),'[a-z0-9_]+'))) as w from u),
 p as (select doc_id, w, count(*) * 1.0 / sum(count(*)) over (partition by doc_id) as pr from t group by doc_id, w), x as (select t.doc_id, s, avg(pr) as score from t join p on t.doc_id=p.doc_id and t.w=p.w where length(t.w) > 3 group by t.doc_id, s)
 select doc_id, s as sentence, round(score,8) as score, rn from (select *, row_number() over (partition by doc_id order by round(score,9) desc, length(s) desc, s) rn from x) where rn <= 3""")
def sum_basic(t: Tables) -> DataFrame:
    u = t.documents.select("doc_id", F.explode(F.array_distinct(F.split("text", r"[.!?]\s+"))).alias("s")).where("length(s) > 20")
    x = u.select("doc_id", "s", F.explode(F.array_distinct(text.ascii_words(F.col("s")))).alias("w"))
    p = x.groupBy("doc_id", "w").agg(F.count("*").alias("k")).withColumn("pr", F.col("k") / F.sum("k").over(Window.partitionBy("doc_id")))
    score = x.where("length(w) > 3").join(p, ["doc_id", "w"]).groupBy("doc_id", "s").agg(F.avg("pr").alias("score"))
    w = Window.partitionBy("doc_id").orderBy(F.desc(F.round("score", 9)), F.desc(F.length("s")), "s")
    return score.withColumn("rn", F.row_number().over(w)).where("rn <= 3").select("doc_id", F.col("s").alias("sentence"), F.round("score", 8).alias("score"), F.col("rn").cast("long").alias("rn"))




def _dna(t: Tables) -> DataFrame:
    """Nucleotide strings made of the digits of order keys."""
    return t.orders.select(F.col("o_orderkey").alias("id"), F.translate(F.lpad(F.conv(F.col("o_orderkey") * 7919 + F.col("o_custkey"), 10, 4), 24, "0"), "0123", "ACGT").alias("seq"))


@query()
def reverse_complements(t: Tables) -> DataFrame:
    return _dna(t).select("id", "seq", sequences.reverse_complement(F.col("seq")).alias("rc"), sequences.translated(F.col("seq")).alias("protein"), sequences.without_poly_a(F.col("seq")).alias("trimmed"))


@query("select md5(o_orderstatus || cast(floor(o_totalprice) as int)::varchar) as seq, min(o_orderkey) as id, count(*) as n from orders group by 1")
def sequence_dedupe(t: Tables) -> DataFrame:
    seq = F.md5(F.concat("o_orderstatus", F.floor("o_totalprice").cast("int").cast("string")))
    return t.orders.select("o_orderkey", seq.alias("seq")).groupBy("seq").agg(F.min("o_orderkey").alias("id"), F.count("*").alias("n"))


@query("select articleid, list_aggregate(list_sort(list_distinct(string_split(keywords, '/'))), 'string_agg', ';') as terms, len(string_split(keywords, '/')) as n from articles where keywords <> ''")
def keyword_arrays(t: Tables) -> DataFrame:
    a = F.split("keywords", "/")
    return t.articles.where("keywords <> ''").select("articleid", F.array_join(F.sort_array(F.array_distinct(a)), ";").alias("terms"), F.size(a).cast("long").alias("n"))


@query("select doc_id, md5(translate(text, 'αβγδµ', 'abgdm')) as latin from documents")
def greek_to_latin(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(F.translate("text", "αβγδµ", "abgdm")).alias("latin"))


@query("select articleid, length(title) as chars, length(title) - length(regexp_replace(title, '[^\\x00-\\x7F]', '', 'g')) as beyond, coalesce(regexp_matches(title, '^[\\x00-\\x7F]*$'), false) as ascii from articles where title is not null")
def ascii_titles(t: Tables) -> DataFrame:
    return t.articles.where("title is not null").select("articleid", F.length("title").cast("long").alias("chars"), F.regexp_count("title", F.lit(r"[^\x00-\x7F]")).cast("long").alias("beyond"), F.col("title").rlike(r"^[\x00-\x7F]*$").alias("ascii"))
