"""Readers of delimited tables, fixed formats, sequences, XML, HTML and plain documents."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvina.operators.ordered import row_numbers
from corvina.schemas import table_schema


def clean_names(names: list[str]) -> list[str]:
    """Column names made of letters, digits and underscores, each once."""
    out: list[str] = []
    for i, n in enumerate(names):
        n = re.sub(r"[^a-zA-Z0-9_]", "_", n.lstrip("#").strip()) or f"noName_{i}"
        n = f"n{n}" if n[0].isdigit() else n
        k, base = 2, n
        while n in out:
            n, k = f"{base}_{k}", k + 1
        out.append(n)
    return out


def read_tsv(spark: SparkSession, path: str | list[str], header: list[str] | None = None, types: dict[str, str] | None = None, comment: str | None = None, keep_line: bool = False) -> DataFrame:
    """A TSV table without quoting (.gz too); the first line names the columns unless `header` does.

    Lines of a wrong width raise when they are read.  `types` casts columns; all others are strings.
    """
    lines = spark.read.text(path)
    if comment:
        lines = lines.where(~F.col("value").startswith(comment))
    if header is None:
        first = spark.read.text(path).first()
        if first is None:
            raise ValueError("no header line")
        names = clean_names(first[0].split("\t"))
        lines = lines.where(F.col("value") != first[0])
    else:
        names = clean_names(header)
    width = len(names)
    cells = F.split("value", "\t", -1)
    checked = F.when(F.size(cells) == width, cells).otherwise(F.raise_error(F.concat(F.lit(f"expected {width} fields: "), F.col("value"))).cast("array<string>"))
    got = lines.where(F.col("value") != "").select(*(["value"] if keep_line else []), checked.alias("_c"))
    cast = lambda i, n: F.col("_c")[i].cast((types or {}).get(n, "string")).alias(n)
    return got.select(*(["value"] if keep_line else []), *[cast(i, n) for i, n in enumerate(names)])


def read_format(spark: SparkSession, path: str | list[str], kind: str) -> DataFrame:
    """A table of a fixed format (psl, bed3, bed4, bed12, blastm8, intmap, sam)."""
    schema = table_schema(kind)
    comment = "@" if kind == "sam" else "#"
    df = spark.read.csv(path, sep="\t", schema=schema, comment=comment, quote="")
    for c in ("blockSizes", "blockStarts", "qStarts", "tStarts"):
        if c in df.columns:
            df = df.withColumn(c, F.split(F.regexp_replace(c, ",$", ""), ",").cast("array<int>"))
    return df


def read_parts(spark: SparkSession, folder: str, pattern: str = "*.tab.gz", **kw) -> DataFrame:
    """All parts of a folder whose names match."""
    return read_tsv(spark, f"{folder}/{pattern}", **kw)


def first_of_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key, the first by `order`; the report of repeated keys is duplicate_report."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("x")).select(key, "x.*")


def duplicate_report(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def read_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(id, description, seq) of each record."""
    r = spark.read.text(path, lineSep=">").where(F.trim("value") != "")
    head = F.regexp_extract("value", r"^([^\n]*)", 1)
    return r.select(F.substring_index(head, " ", 1).alias("id"), head.alias("description"), F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s", "").alias("seq"))


def sam_to_bed(sam: DataFrame) -> DataFrame:
    """bed6 of the mapped alignments: the length is the sum of the M, D, N and P operations."""
    ops = F.regexp_extract_all("cigar", F.lit(r"(\d+)[MDNP]"), F.lit(1))
    size = F.aggregate(ops, F.lit(0), lambda a, x: a + x.cast("int"))
    return sam.where("pos > 0").select(F.col("rName").alias("chrom"), (F.col("pos") - 1).alias("start"), (F.col("pos") - 1 + size).alias("end"), F.col("qName").alias("name"), F.col("mapq").alias("score"), F.when(F.col("flag").bitwiseAND(16) > 0, "-").otherwise("+").alias("strand"))


def read_documents(spark: SparkSession, path: str, start: int = 4_400_000_000) -> tuple[DataFrame, DataFrame]:
    """Articles and files made of plain text files, numbered by path."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("url"), "value")
    n = row_numbers(raw.select("url").distinct(), [], ["url"])
    got = raw.join(n, "url")
    art = (F.lit(start) + F.col("no")).cast("long")
    articles = got.select(art.alias("articleId"), F.element_at(F.split("url", "/"), -1).alias("externalId"), F.lit("text").alias("source"), F.substring("value", 1, 100).alias("title"))
    files = got.select((art * 1000).alias("fileId"), art.alias("articleId"), "url", F.lit("main").alias("fileType"), F.lit("text/plain").alias("mimeType"), F.regexp_replace("value", "\r\n|\n|\r", "\x07").alias("content"))
    return articles, files


#: elements that begin a line; fixed values
_NEW_LINE = {"title", "sec", "p", "section", "caption", "label", "table"}


def xml_text(data: str | None, need_body: bool = False) -> str | None:
    """Text of an XML document, a line for each block; null if it does not parse or lacks the body that is needed."""
    if not data:
        return None
    try:
        root = ElementTree.fromstring(re.sub(r"<!DOCTYPE[^>]*>", "", data))
    except ElementTree.ParseError:
        return None
    bare = lambda tag: tag.rsplit("}", 1)[-1].lower() if isinstance(tag, str) else ""
    if need_body and not any(bare(e.tag) == "body" for e in root.iter()):
        return None
    parts: list[str] = []

    def walk(e: ElementTree.Element) -> None:
        if bare(e.tag) in _NEW_LINE:
            parts.append("\n")
        parts.append(e.text or "")
        for child in e:
            walk(child)
            parts.append(child.tail or "")

    walk(root)
    return re.sub(r"[ \t]*\n\s*", "\n", "".join(parts)).strip()


class _Html(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.meta: list[tuple[str, str]] = []
        self.title = ""
        self.skip = 0
        self.in_title = False

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "meta" and a.get("content"):
            self.meta.append(((a.get("name") or a.get("property") or a.get("http-equiv") or "").lower(), a["content"]))
        self.skip += tag in ("script", "style")
        self.in_title = tag == "title"
        if tag in ("p", "br", "div", "li", "tr", "h1", "h2", "h3", "h4", "section", "table"):
            self.parts.append("\n")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style") and self.skip > 0
        self.in_title = False

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        elif not self.skip:
            self.parts.append(data)


#: meta tags and the article fields that they give; fixed values
META_FIELDS = {
    "citation_title": "title", "dc.title": "title", "og:title": "title", "citation_journal_title": "journal", "prism.publicationname": "journal", "citation_author": "authors", "citation_authors": "authors", "dc.creator": "authors", "citation_date": "year", "citation_publication_date": "year", "dc.date": "year", "prism.publicationdate": "year",
    "citation_volume": "vol", "prism.volume": "vol", "citation_issue": "issue", "prism.number": "issue", "citation_firstpage": "page", "prism.startingpage": "page", "citation_doi": "doi", "dc.identifier": "doi", "prism.doi": "doi", "citation_pmid": "pmid", "citation_issn": "printIssn", "prism.issn": "printIssn", "prism.eissn": "eIssn", "citation_publisher": "publisher", "dc.publisher": "publisher", "citation_language": "lang", "dc.language": "lang", "citation_keywords": "keywords", "dc.subject": "keywords", "citation_abstract": "abstract", "description": "abstract", "citation_fulltext_html_url": "fulltextUrl",
}


def html_article(data: str | None) -> dict[str, str]:
    """Article fields and text of an HTML page: meta tags first, the page title if they give none."""
    if not data:
        return {}
    p = _Html()
    p.feed(data)
    out: dict[str, str] = {}
    for name, value in p.meta:
        f = META_FIELDS.get(name)
        if f == "authors" and f in out:
            out[f] += ";" + value
        elif f == "doi" and not re.search(r"10\.\d{4,}", value):
            continue
        elif f and f not in out:
            out[f] = re.search(r"\d{4}", value)[0] if f == "year" and re.search(r"\d{4}", value) else re.sub(r"^doi:\s*", "", value) if f == "doi" else value
    out.setdefault("title", p.title.strip())
    out["text"] = re.sub(r"[ \t]*\n\s*", "\n", html.unescape("".join(p.parts))).strip()
    return out


_CONVERTERS: dict[str, object] = {"text/xml": xml_text, "application/xml": xml_text, "text/html": lambda d: html_article(d).get("text"), "text/plain": lambda d: d}


def register_converter(mime: str, convert) -> None:
    """Add a converter of a document type to text; converters that need outside programs plug in here."""
    _CONVERTERS[mime] = convert


def to_text(df: DataFrame, data: str = "data", mime: str = "mimeType", name: str = "locFname", most_in: int = 50_000_000, most_out: int = 10_000_000, least_out: int = 60) -> DataFrame:
    """Adds `content`: documents as text by type, else by file extension; null beyond the size limits or without converter."""
    by_ext = {"xml": "text/xml", "nxml": "text/xml", "html": "text/html", "htm": "text/html", "txt": "text/plain", "asc": "text/plain"}
    fields = [f for f in df.schema.fields if f.name != data]
    schema = T.StructType([*fields, T.StructField("content", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for d, m, n in zip(b[data], b[mime], b[name], strict=True):
                convert = _CONVERTERS.get(m or "") or _CONVERTERS.get(by_ext.get(str(n or "").rsplit(".", 1)[-1].lower(), ""))
                text = convert(d) if convert and d is not None and len(d) <= most_in else None
                out.append(text if text is not None and least_out <= len(text) <= most_out else None)
            b = b.drop(columns=[data])
            b["content"] = out
            yield b

    return df.mapInPandas(run, schema)


def decoded(data: Column) -> Column:
    """Bytes as text: UTF-8 where valid, else ISO-8859-1."""
    return F.when(F.is_valid_utf8(data.cast("string")), F.decode(data, "UTF-8")).otherwise(F.decode(data, "ISO-8859-1"))


def control_characters(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[\x00-\x08\x0e-\x1f\x7f]"))


def read_records(spark: SparkSession, path: str, terminator: str = "//\n") -> DataFrame:
    """Flat-file records (locus, definition, organism, references, sequence length) of GenBank-like files."""
    r = spark.read.text(path, lineSep=terminator).where(F.trim("value") != "")
    x = lambda p: F.regexp_extract("value", p, 1)
    return r.select(x(r"(?m)^LOCUS\s+(\S+)").alias("locus"), x(r"(?ms)^DEFINITION\s+(.*?)^\S").alias("definition"), x(r"(?m)^\s+ORGANISM\s+(.*)$").alias("organism"), x(r"(?m)^LOCUS\s+\S+\s+(\d+)").cast("int").alias("length"), F.regexp_extract_all("value", F.lit(r"(?m)^\s+PUBMED\s+(\d+)"), F.lit(1)).alias("pmids"), F.regexp_extract_all("value", F.lit(r"(?m)^\s+TITLE\s+(.*)$"), F.lit(1)).alias("titles"))


def small_scale(records: DataFrame, reference: str, most: int = 1000, longest: int = 20_000) -> DataFrame:
    """References with few and short records."""
    return records.groupBy(reference).agg(F.count("*").alias("n"), F.max("length").alias("longest")).where((F.col("n") <= most) & (F.col("longest") <= longest))


def vcf_region(spark: SparkSession, path: str, chrom: str, start: int, end: int) -> DataFrame:
    v = spark.read.csv(path, sep="\t", comment="#", quote="").toDF("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info")
    return v.withColumn("pos", F.col("pos").cast("long")).where((F.col("chrom") == chrom) & (F.col("pos") > start) & (F.col("pos") <= end))
