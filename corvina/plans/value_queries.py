"""Queries of small conversions, ranges, accessions and lexicon cleaning, each stated in SQL too."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvina.functions import ranges, text, values
from corvina.plans.query import Registry, Tables

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


def _thirds(t: Tables) -> DataFrame:
    n = F.length("text")
    part = lambda a, b, name: F.struct(a.cast("long").alias("start"), b.cast("long").alias("end"), F.lit(name).alias("name"))
    d = t.documents.where("text is not null").select("doc_id", "text", n.cast("long").alias("n"))
    a, b = F.floor(F.col("n") / 3), F.floor(2 * F.col("n") / 3)
    return d.withColumn("parts", F.array(part(F.lit(0), a, "header"), part(a, b, "abstract"), part(b, F.col("n"), "results")))


@query("""with d as (select doc_id, length(text) as n from documents where text is not null), p as (select doc_id, n, unnest([{'s': 0, 'e': n//3, 'm': 'header'}, {'s': n//3, 'e': 2*n//3, 'm': 'abstract'}, {'s': 2*n//3, 'e': n, 'm': 'results'}]) as r from d),
 c as (select doc_id, r.s as s, least(r.e, greatest(n//4, r.s)) as e, r.m as m from p union all select doc_id, greatest(r.s, least(r.e, n//2)), r.e, r.m from p union all select doc_id, n//4, n//2, 'refs' from d)
 select doc_id, s as "start", e as "end", m as name from c where s < e""")
def cut_sections(t: Tables) -> DataFrame:
    """Sections with the references cut into them."""
    n = F.col("n")
    cut = ranges.cut_in(F.col("parts"), F.floor(n / 4), F.floor(n / 2), F.lit("refs"))
    return _thirds(t).select("doc_id", F.explode(cut).alias("r")).select("doc_id", "r.start", "r.end", "r.name")


@query("select fileid, case when instr(substr(content, 21, 200), chr(7)) > 0 then 20 + instr(substr(content, 21, 200), chr(7)) - 1 else 20 end as place from files where content is not null")
def line_breaks(t: Tables) -> DataFrame:
    return t.files.where("content is not null").select("fileid", ranges.line_break(F.col("content"), F.lit(20), 200).cast("long").alias("place"))


@query("select l_orderkey, l_linenumber, least(l_partkey + 50, l_suppkey + 900) - greatest(l_partkey, l_suppkey) as common from lineitem")
def range_intersections(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", ranges.intersection(F.col("l_partkey"), F.col("l_partkey") + 50, F.col("l_suppkey"), F.col("l_suppkey") + 900).cast("long").alias("common"))


@query("""select doc_id, '0-' || (n//3) || ':' || md5(substr(text, 1, n//3)) || '=header' as first, md5(substr(text, n//3 + 1, 2*n//3 - n//3)) as second from (select doc_id, text, length(text) as n from documents where text is not null)""")
def range_texts(t: Tables) -> DataFrame:
    d = _thirds(t).withColumn("texts", ranges.texts(F.col("text"), F.col("parts")))
    return d.select("doc_id", F.concat(F.lit("0-"), F.floor(F.col("n") / 3).cast("string"), F.lit(":"), F.md5(F.element_at("texts", 1)), F.lit("=header")).alias("first"), F.md5(F.element_at("texts", 2)).alias("second"))


@query("""select articleid, '0-3:' || substr(title, 1, 3) || '=a|4-8:' || substr(title, 5, 4) || '=b' as description from (select distinct articleid, title from articles where length(title) > 8)""")
def span_descriptions(t: Tables) -> DataFrame:
    part = lambda a, b, n: F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(n).alias("name"))
    a = t.articles.where("length(title) > 8").select("articleid", "title").distinct()
    return a.select("articleid", ranges.descriptions(F.col("title"), F.array(part(0, 3, "a"), part(4, 8, "b"))).alias("description"))


@query("select l_orderkey, l_linenumber, least(l_partkey, l_suppkey) as \"start\", case when l_partkey = l_suppkey then l_partkey + 1 else greatest(l_partkey, l_suppkey) end as \"end\" from lineitem")
def normalised_intervals(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", ranges.normalised(F.col("l_partkey").cast("long"), F.col("l_suppkey").cast("long")).alias("r")).select("l_orderkey", "l_linenumber", "r.start", "r.end")


@query("""with w as (select doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9_]+'))) as w from documents), c as (select w from (select w, count(*) as n from w group by w) order by n desc, w limit 50)
 select doc_id, count(*) as common from w where w in (select w from c) group by doc_id""")
def common_words(t: Tables) -> DataFrame:
    """How many of the fifty commonest words a document has."""
    w = t.documents.select("doc_id", F.explode(F.array_distinct(text.ascii_words(F.col("text")))).alias("w"))
    top = w.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(50).select("w")
    return w.join(top, "w", "left_semi").groupBy("doc_id").agg(F.count("*").alias("common"))


@query("select fileid, substr(s, 1, 10) as article, substr(s, 11, 3) as file, substr(s, 14, 5) as annot from (select fileid, cast(fileid * 100000 + 7 as varchar) as s from files)")
def split_annot_id_text(t: Tables) -> DataFrame:
    s = (F.col("fileid") * 100000 + 7).cast("string")
    return t.files.select("fileid", F.substring(s, 1, 10).alias("article"), F.substring(s, 11, 3).alias("file"), F.substring(s, 14, 5).alias("annot"))


_PREFIX_SQL = "case when contains(f,'van der ') then replace(f,'van der ','') when contains(f,'von der ') then replace(f,'von der ','') when contains(f,'van ') then replace(f,'van ','') when contains(f,'von ') then replace(f,'von ','') when contains(f,'de la ') then replace(f,'de la ','') when contains(f,'de ') then replace(f,'de ','') when contains(f,'al-') then replace(f,'al-','') else f end"


@query(f"select articleid, f as family, {_PREFIX_SQL} as bare from (select distinct articleid, trim(split_part(split_part(coalesce(authors,''), ';', 1), ',', 1)) as f from articles)")
def author_families(t: Tables) -> DataFrame:
    a = t.articles.select("articleid", text.first_author(F.col("authors")).alias("family")).distinct()
    return a.select("articleid", "family", text.without_prefix(F.col("family")).alias("bare"))


@query("select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') as time from events")
def event_times(t: Tables) -> DataFrame:
    return t.events.select("event_id", values.iso_time(F.col("ts").cast("timestamp")).alias("time"))


@query("select o_orderkey, strftime(cast(o_orderdate as date), '%Y-%m-%d') as day from orders")
def record_dates(t: Tables) -> DataFrame:
    """Dates written as in sequence records, read again."""
    written = F.upper(F.date_format(F.col("o_orderdate").cast("date"), "dd-MMM-yyyy"))
    return t.orders.select("o_orderkey", values.record_date(written).alias("day"))


@query("select articleid, coalesce(cast(min(case when regexp_matches(pubyear, '^[0-9]+$') then cast(pubyear as int) end) as varchar), 'noValidYear') as year from refs group by articleid")
def least_years(t: Tables) -> DataFrame:
    return t.refs.groupBy("articleid").agg(F.collect_set("pubyear").alias("ys")).select("articleid", values.least_year(F.col("ys")).alias("year"))


@query("select n_nationkey, n_name as name, cast(n_regionkey as varchar) as region from nation")
def parameter_maps(t: Tables) -> DataFrame:
    m = values.key_values(F.concat(F.lit("name="), "n_name", F.lit(",region="), F.col("n_regionkey").cast("string")))
    return t.nation.select("n_nationkey", m["name"].alias("name"), m["region"].alias("region"))


@query("select n_nationkey, n_name as name, n_name || '|' || n_regionkey as whole from nation")
def xml_children(t: Tables) -> DataFrame:
    """Text of one child and of all children of an element."""
    x = F.concat(F.lit("<n><name>"), "n_name", F.lit("</name><r>"), F.col("n_regionkey").cast("string"), F.lit("</r></n>"))
    return t.nation.select("n_nationkey", F.xpath_string(x, F.lit("n/name")).alias("name"), F.array_join(F.xpath(x, F.lit("n/*/text()")), "|").alias("whole"))


@query("select articleid, list_aggregate(list_transform(string_split(title, ''), lambda c: case when unicode(c) > 127 then '&#' || unicode(c) || ';' else c end), 'string_agg', '') as escaped from (select distinct articleid, title from articles where title <> '')")
def character_references(t: Tables) -> DataFrame:
    return t.articles.where("title <> ''").select("articleid", "title").distinct().select("articleid", values.char_references(F.col("title")).alias("escaped"))


@query("select distinct articleid, regexp_replace(regexp_replace(title, '[0-9]', ' ', 'g'), 'z', ' ', 'g') as blanked from articles where title is not null")
def blanked_matches(t: Tables) -> DataFrame:
    """Digits and runs of z as so many blanks."""
    return t.articles.where("title is not null").select("articleid", values.blanked(F.col("title"), "[0-9]+|z+").alias("blanked")).distinct()


@query("select distinct articleid, list_filter(regexp_extract_all(keywords, '[^;/|]+|[;/|]'), lambda x: x <> '') as items from articles where keywords <> ''")
def split_with_delimiters(t: Tables) -> DataFrame:
    return t.articles.where("keywords <> ''").select("articleid", values.split_kept(F.col("keywords"), ";/|").alias("items")).distinct()


@query("select distinct w, round(list_sum(list_transform(range(2, length(w)+1), lambda i: case when w[i] <> w[i-1] then 1 else 0 end)) / length(w), 6) as rate from (select unnest(regexp_extract_all(lower(title), '[a-z]+')) as w from articles) where length(w) > 1")
def change_rates(t: Tables) -> DataFrame:
    w = t.articles.select(F.explode(F.regexp_extract_all(F.lower("title"), F.lit("[a-z]+"), F.lit(0))).alias("w")).where("length(w) > 1").distinct()
    return w.select("w", F.round(values.change_rate(F.col("w")), 6).alias("rate"))


@query("select a.journalid as a, b.journalid as b from journals a join journals b on a.journalid < b.journalid and a.publisherid = b.publisherid where a.title = b.title or (length(a.printissn) = length(b.printissn) and left(a.printissn, length(a.printissn) - 1) = left(b.printissn, length(b.printissn) - 1))")
def similar_issns(t: Tables) -> DataFrame:
    j = t.journals.select("publisherid", F.col("journalid").alias("a"), F.col("title").alias("ta"), F.col("printissn").alias("pa"))
    k = t.journals.select("publisherid", F.col("journalid").alias("b"), F.col("title").alias("tb"), F.col("printissn").alias("pb"))
    return j.join(k, "publisherid").where("a < b").where((F.col("ta") == F.col("tb")) | values.too_similar(F.col("pa"), F.col("pb"))).select("a", "b")


@query("select p_partkey, 'PA' as letters, lpad(cast(p_partkey as varchar), 6, '0') as digits, 6 as width from part")
def accession_parts(t: Tables) -> DataFrame:
    acc = F.concat(F.lit("PA"), F.lpad(F.col("p_partkey").cast("string"), 6, "0"))
    return t.part.select("p_partkey", values.split_accession(acc).alias("x")).select("p_partkey", "x.letters", "x.digits", F.col("x.width").cast("long").alias("width"))


@query("select n_nationkey, unnest(list_transform(range(1, 2 + n_nationkey % 5), lambda i: 'PITX' || i)) as symbol from nation")
def expanded_symbols(t: Tables) -> DataFrame:
    """PITX1/3 as PITX1, PITX2, PITX3."""
    typed = F.concat(F.lit("PITX1/"), (1 + F.pmod("n_nationkey", F.lit(5))).cast("string"))
    return t.nation.select("n_nationkey", F.explode(values.expanded_slash(typed)).alias("symbol"))


@query("select k, n, round(exp(lgamma(n+1) - lgamma(k+1) - lgamma(n-k+1) + k*ln(0.3) + (n-k)*ln(0.7)), 9) as binomial, round(exp(k*ln(4.0) - 4.0 - lgamma(k+1)), 9) as poisson from (select n_nationkey as k, n_nationkey + 10 as n from nation)")
def probabilities(t: Tables) -> DataFrame:
    k, n = F.col("k"), F.col("n")
    d = t.nation.select(F.col("n_nationkey").alias("k"), (F.col("n_nationkey") + 10).alias("n"))
    return d.select("k", "n", F.round(values.binomial(k, n, F.lit(0.3)), 9).alias("binomial"), F.round(values.poisson(k, F.lit(4.0)), 9).alias("poisson"))


@query("with recursive d as (select o_orderkey, o_orderkey as n, '' as s from orders union all select o_orderkey, n // 49, substr('abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ', n % 49 + 1, 1) || s from d where n > 0) select o_orderkey, case when s = '' then 'a' else s end as numeral from d where n = 0")
def base_numerals(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", values.base_n(F.col("o_orderkey")).alias("numeral"))


@query("select doc_id, regexp_extract(trim(substr(text, p - 20, 20)), '[^:,. -]*$') as l, regexp_extract(trim(substr(text, p + 9, 20)), '^[^:,. -]*') as r from (select doc_id, text, instr(text, 'treatment') as p from documents) where p > 20")
def flank_by_characters(t: Tables) -> DataFrame:
    """The words within twenty characters left and right of a keyword."""
    p = F.instr("text", "treatment")
    near = t.documents.select("doc_id", "text", p.alias("p")).where("p > 20")
    left, right = F.trim(F.substring(F.col("text"), F.col("p") - 20, F.lit(20))), F.trim(F.substring(F.col("text"), F.col("p") + 9, F.lit(20)))
    return near.select("doc_id", F.regexp_extract(left, "[^:,. -]*$", 0).alias("l"), F.regexp_extract(right, "^[^:,. -]*", 0).alias("r"))


@query("select name, row_number() over (order by cast(split_part(name, '_', 1) as int) * 10000 + cast(split_part(name, '_', 2) as int)) as place from (select distinct updateid || '_' || lpad(cast(articleid % 7 as varchar), 5, '0') as name from articles)")
def chunk_order(t: Tables) -> DataFrame:
    """Chunk names in the order of update and chunk: few names, so one sorted list."""
    names = t.articles.select(F.concat_ws("_", F.col("updateid").cast("string"), F.lpad(F.pmod("articleid", F.lit(7)).cast("string"), 5, "0")).alias("name")).distinct()
    key = F.substring_index("name", "_", 1).cast("int") * 10000 + F.substring_index("name", "_", -1).cast("int")
    return names.select("name", F.row_number().over(Window.orderBy(key)).cast("long").alias("place"))


@query("""with s as (select o_orderkey as id, 'CA' || translate(cast(cast(floor(o_totalprice * 97) as bigint) as varchar), '0123456789', 'ACDEFGHIKL') as seq from orders) select id, seq from s where regexp_matches(seq, '^CA[A-F]') and length(seq) between 8 and 25 and seq not in (select seq from s where id % 50 = 0)""")
def receptor_sequences(t: Tables) -> DataFrame:
    """Sequences with a prefix and of a length, but those of a blacklist."""
    s = t.orders.select(F.col("o_orderkey").alias("id"), F.concat(F.lit("CA"), F.translate(F.floor(F.col("o_totalprice") * 97).cast("long").cast("string"), "0123456789", "ACDEFGHIKL")).alias("seq"))
    black = s.where("id % 50 = 0").select("seq").distinct()
    return s.where(F.col("seq").rlike("^CA[A-F]") & F.length("seq").between(8, 25)).join(black, "seq", "left_anti").select("id", "seq")


@query("select doc_id, list_aggregate(list_sort(list(case when grade <= 2 then 'pos' else 'neg' end || ':' || rater)), 'string_agg', ',') as labels from levellabels group by doc_id")
def label_lists(t: Tables) -> DataFrame:
    """Labels of several lists, with their list, for each document."""
    lab = t.levellabels.select("doc_id", F.concat(F.when(F.col("grade") <= 2, "pos").otherwise("neg"), F.lit(":"), "rater").alias("x"))
    return lab.groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_list("x")), ",").alias("labels"))


@query("select distinct articleid, replace(regexp_replace(replace(title, ' ', '#TAB#') || '#N#x', '#[NRM]#', chr(10), 'g'), '#TAB#', ' ') as decoded from articles where title is not null")
def decoded_placeholders(t: Tables) -> DataFrame:
    return t.articles.where("title is not null").select("articleid", values.placeholders_decoded(F.concat(F.replace("title", F.lit(" "), F.lit("#TAB#")), F.lit("#N#x"))).alias("decoded")).distinct()


@query("select distinct articleid, coalesce(nullif(trim(pmid), ''), '0') as pmid from articles where regexp_matches(pmcid, '^PMC[0-9]+$')")
def pmc_ids(t: Tables) -> DataFrame:
    """The pmid of each PMC id, '0' where there is none; rows of another form are left out."""
    return t.articles.where(F.col("pmcid").rlike("^PMC[0-9]+$")).select("articleid", F.coalesce(F.nullif(F.trim("pmid"), F.lit("")), F.lit("0")).alias("pmid")).distinct()


@query("select distinct articleid, regexp_replace(list_last(string_split(pubyear, ' ')), '[^0-9]', '', 'g') as year from articles where pubyear is not null")
def bare_years(t: Tables) -> DataFrame:
    """Digits of the last word; nothing stays nothing."""
    return t.articles.where("pubyear is not null").select("articleid", F.regexp_replace(F.element_at(F.split("pubyear", " "), -1), "[^0-9]", "").alias("year")).distinct()


@query("select p_partkey, split_part(p_name, ' ', 1) as name, list_transform(string_split(p_name, ' '), lambda x: coalesce(map {'blue': 'B', 'red': 'R', 'green': 'G'}[x], x)) as codes from part")
def resolved_parts(t: Tables) -> DataFrame:
    """The parts of a name, each resolved by a dictionary or left as it is."""
    codes = F.create_map(*[F.lit(x) for kv in (("blue", "B"), ("red", "R"), ("green", "G")) for x in kv])
    ws = F.split("p_name", " ")
    return t.part.select("p_partkey", F.element_at(ws, 1).alias("name"), F.transform(ws, lambda x: F.coalesce(codes[x], x)).alias("codes"))


@query("""with n as (select lower(trim(s)) as name, p_partkey as id from (select p_partkey, unnest([p_type, replace(p_type, ' ', '-'), p_name, replace(p_name, ' ', '-')]) as s from part)) select name, count(distinct id) as ids, case when count(distinct id) > 1 then '?' else '' end || min(id) as gene from n where length(name) > 2 and not contains(name, 'standard') group by name""")
def lexicon_names(t: Tables) -> DataFrame:
    """Names of a lexicon with their spelling variants; one of several ids is marked as ambiguous."""
    forms = [x for c in ("p_type", "p_name") for x in (F.col(c), F.replace(c, F.lit(" "), F.lit("-")))]
    n = t.part.select(F.col("p_partkey").alias("id"), F.explode(F.array(*forms)).alias("s")).select("id", F.lower(F.trim("s")).alias("name"))
    g = n.where((F.length("name") > 2) & ~F.col("name").contains("standard")).groupBy("name").agg(F.countDistinct("id").alias("ids"), F.min("id").alias("first"))
    return g.select("name", "ids", F.concat(F.when(F.col("ids") > 1, "?").otherwise(""), F.col("first").cast("string")).alias("gene"))


@query("select p_type as key, string_agg(distinct p_brand, '|' order by p_brand) as names from part group by p_type")
def joined_lexicon(t: Tables) -> DataFrame:
    return t.part.groupBy(F.col("p_type").alias("key")).agg(F.array_join(F.sort_array(F.collect_set("p_brand")), "|").alias("names"))


@query("select split_part(band, '.', 1) as band, min(s) as \"start\", max(e) as \"end\" from (select (l_suppkey % 22) || 'q' || l_linenumber || '.' || (l_partkey % 3) as band, l_partkey as s, l_partkey + l_linenumber as e from lineitem) group by 1")
def large_bands(t: Tables) -> DataFrame:
    """Bands from their sub-bands."""
    band = F.concat(F.pmod("l_suppkey", F.lit(22)).cast("string"), F.lit("q"), F.col("l_linenumber").cast("string"))
    return t.lineitem.groupBy(band.alias("band")).agg(F.min("l_partkey").alias("start"), F.max(F.col("l_partkey") + F.col("l_linenumber")).alias("end"))


@query("select name, first from (select p_name as name, p_partkey as first, row_number() over (partition by p_name order by p_partkey) as rn from part where length(p_name) > 2 and p_name <> 'unknown') where rn = 1")
def unique_names(t: Tables) -> DataFrame:
    """Each marker name once, the first wins."""
    return t.part.where("length(p_name) > 2 and p_name <> 'unknown'").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("first"))


@query("select article, count(*) as sequences from (select cast(fileid // 1000 as varchar) as article from files) group by article")
def sequences_per_article(t: Tables) -> DataFrame:
    return t.files.groupBy(F.substring(F.col("fileid").cast("string"), 1, 10).alias("article")).agg(F.count("*").alias("sequences"))


@query("select journal, n, top || case when kinds > 3 then ' and ' || (kinds - 3) || ' others' else '' end as label from (select journal, sum(k) as n, count(*) as kinds, string_agg(case when rn <= 3 then pubyear end, ', ' order by rn) as top from (select *, row_number() over (partition by journal order by k desc, pubyear) as rn from (select journal, pubyear, count(*) as k from refs where journal <> '' and pubyear <> '' group by all)) group by journal)")
def top_three_and_others(t: Tables) -> DataFrame:
    """The three commonest years of each journal, and how many others there are."""
    k = t.refs.where("journal <> '' and pubyear <> ''").groupBy("journal", "pubyear").agg(F.count("*").alias("k"))
    r = k.withColumn("rn", F.row_number().over(Window.partitionBy("journal").orderBy(F.desc("k"), "pubyear")))
    g = r.groupBy("journal").agg(F.sum("k").alias("n"), F.count("*").alias("kinds"), F.sort_array(F.collect_list(F.when(F.col("rn") <= 3, F.struct("rn", "pubyear")))).alias("x"))
    return g.select("journal", "n", F.concat(F.array_join(F.col("x.pubyear"), ", "), F.when(F.col("kinds") > 3, F.concat(F.lit(" and "), (F.col("kinds") - 3).cast("string"), F.lit(" others"))).otherwise("")).alias("label"))


@query("select journal, sum(n) as n from (select journal, count(*) as n from refs where journal <> '' group by journal union all select journal, count(*) from articles where journal <> '' group by journal) group by journal")
def summed_counts(t: Tables) -> DataFrame:
    """Counts of several batches, added."""
    count = lambda d: d.where("journal <> ''").groupBy("journal").agg(F.count("*").alias("n"))
    return count(t.refs).unionByName(count(t.articles)).groupBy("journal").agg(F.sum("n").alias("n"))
