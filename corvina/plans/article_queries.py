"""Queries of article XML: documents are written from the article tables and read again by the converters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvina.plans.query import Registry, Tables
from corvina.sources import article_xml as ax

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


def _x(tag: str, c: str | Column, attrs: str = "") -> Column:
    """An element with the text of a column."""
    text = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return F.concat(F.lit(f"<{tag}{attrs}>"), text, F.lit(f"</{tag}>"))


def _in(tag: str, *inner: Column, attrs: str = "") -> Column:
    return F.concat(F.lit(f"<{tag}{attrs}>"), *inner, F.lit(f"</{tag}>"))


def _articles(t: Tables) -> DataFrame:
    """Articles once, of columns that hold no control characters."""
    cols = ["vol", "issue", "page", "journal", "printissn", "eissn", "pubyear", "doi", "pmid"]
    return t.articles.select("articleid", *[F.regexp_replace(c, r"[\x00-\x1f]", " ").alias(c) for c in cols]).distinct()


def _sql(fields: dict[str, str], where: str = "true") -> str:
    cols = "vol issue page journal printissn eissn pubyear doi pmid".split()
    clean = ", ".join(f"regexp_replace({c}, '[\\x00-\\x1f]', ' ', 'g') as {c}" for c in cols)
    got = ", ".join(f"coalesce(trim({v}), '') as {k}" for k, v in fields.items())
    return f"select articleid, {got} from (select distinct articleid, {clean} from articles) where {where}"


_FIELDS = {"vol": "vol", "issue": "issue", "page": "page", "journal": "journal", "printissn": "printissn", "doi": "doi"}


def _picked(df: DataFrame) -> DataFrame:
    return df.select("articleid", "vol", "issue", "page", "journal", F.col("printIssn").alias("printissn"), "doi")


@query(_sql(_FIELDS, "trim(pmid) <> ''"))
def medline_articles(t: Tables) -> DataFrame:
    issue = _in("JournalIssue", _x("Volume", "vol"), _x("Issue", "issue"), _in("PubDate", _x("Year", "pubyear")))
    journal = _in("Journal", _x("ISSN", "printissn", ' IssnType="Print"'), issue, _x("Title", "journal"))
    article = _in("Article", journal, _x("ArticleTitle", "journal"), _x("ELocationID", "doi", ' EIdType="doi"'), _in("Pagination", _x("MedlinePgn", "page")))
    return _picked(ax.articles_from_xml(_articles(t).select("articleid", _in("MedlineCitation", _x("PMID", "pmid"), article).alias("content")), "medline", "articleid"))


@query(_sql(_FIELDS))
def pmc_articles(t: Tables) -> DataFrame:
    journal = _in("journal-meta", _x("journal-title", "journal"), _x("issn", "printissn", ' pub-type="ppub"'))
    meta = _in("article-meta", _x("article-id", "doi", ' pub-id-type="doi"'), _x("volume", "vol"), _x("issue", "issue"), _x("fpage", "page"))
    return _picked(ax.articles_from_xml(_articles(t).select("articleid", _in("article", _in("front", journal, meta), attrs=' article-type="research-article"').alias("content")), "pmc", "articleid"))


@query(_sql(_FIELDS))
def springer_articles(t: Tables) -> DataFrame:
    info = _in("JournalInfo", _x("JournalPrintISSN", "printissn"), _x("JournalTitle", "journal"))
    article = _in("Article", _in("ArticleInfo", _x("ArticleDOI", "doi"), _x("ArticleFirstPage", "page")), _in("ArticleHeader", F.lit("")))
    journal = _in("Journal", info, _in("Volume", _in("VolumeInfo", _x("VolumeIDStart", "vol")), _in("Issue", _in("IssueInfo", _x("IssueIDStart", "issue")), article)))
    return _picked(ax.articles_from_xml(_articles(t).select("articleid", _in("Publisher", journal).alias("content")), "springer", "articleid"))


@query(_sql(_FIELDS))
def elsevier_articles(t: Tables) -> DataFrame:
    desc = _in("Description", _x("doi", "doi"), _x("publicationName", "journal"), _x("issn", "printissn"), _x("startingPage", "page"), _x("number", "issue"), _x("volume", "vol"))
    return _picked(ax.articles_from_xml(_articles(t).select("articleid", _in("document", _in("RDF", desc), F.lit("<article><head/></article>")).alias("content")), "elsevier", "articleid"))


@query("select articleid, coalesce(trim(pmid), '') as pmid, coalesce(trim(doi), '') as doi, coalesce(trim(vol), '') as vol, coalesce(trim(page), '') as page, coalesce(trim(pubyear), '') as pubyear from refs")
def pmc_citations(t: Tables) -> DataFrame:
    """Citation rows of reference lists, prefixed with the article's id."""
    cite = _in("mixed-citation", _x("volume", "vol"), _x("fpage", "page"), _x("year", "pubyear"), _x("pub-id", "pmid", ' pub-id-type="pmid"'), _x("pub-id", "doi", ' pub-id-type="doi"'))
    docs = t.refs.select("articleid", _in("article", _in("back", _in("ref-list", _in("ref", cite)))).alias("content"))
    return ax.references_from_xml(docs, "articleid").select("articleid", "pmid", "doi", "vol", "page", F.col("year").alias("pubyear"))
