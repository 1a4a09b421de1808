"""Article and citation rows from the XML of publishers: MEDLINE, PMC, Elsevier, Springer.

Each format is a function from one document to a dictionary of article fields (missing ones are ''), built on a small set of
path helpers over the standard library's tree; namespaces are ignored.  `articles_from_xml` and `references_from_xml` run
them over a table of documents.  What is no XML, or no article of the format, gives no row.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corvina.schemas import ARTICLE_FIELDS

#: elements that end a line of text; fixed values
_LINES = {"title", "sec", "p", "section", "caption", "label", "table", "ce:para", "para", "simple-para", "section-title", "list-item"}


def tree(xml: str | None) -> ET.Element | None:
    """The root with tags and attributes freed of namespaces, None if the text is no XML."""
    if not xml:
        return None
    try:
        root = ET.fromstring(re.sub(r"^\s*<\?xml[^>]*\?>|<!DOCTYPE[^>\[]*(?:\[[^\]]*\])?[^>]*>", "", xml, count=2))
    except (ET.ParseError, ValueError):
        return None
    for el in root.iter():
        if isinstance(el.tag, str):
            el.tag = el.tag.rpartition("}")[2]
        el.attrib = {k.rpartition("}")[2]: v for k, v in el.attrib.items()}
    return root


def all_of(el: ET.Element | None, path: str, **attrs: str) -> list[ET.Element]:
    """Elements at a path whose attributes have the given values; '_' in a name stands for '-'."""
    if el is None:
        return []
    want = {k.replace("_", "-"): v for k, v in attrs.items()}
    return [x for x in el.findall(path) if all(x.get(k) == v for k, v in want.items())]


def own_text(el: ET.Element | None, path: str = ".", **attrs: str) -> str:
    """Text of the first such element before its children, on one line."""
    found = all_of(el, path, **attrs)
    return one_line(found[0].text) if found else ""


def one_line(s: str | None) -> str:
    return re.sub(r"[\n\t ]", " ", s or "").strip()


def whole_text(el: ET.Element | None) -> str:
    """All text of an element, with a line break behind elements of their own line."""
    if el is None:
        return ""
    parts: list[str] = []

    def walk(x: ET.Element) -> None:
        parts.append(x.text or "")
        for child in x:
            if isinstance(child.tag, str):
                walk(child)
                if child.tag in _LINES:
                    parts.append("\n")
            parts.append(child.tail or "")

    walk(el)
    return "".join(parts).strip()


def names(pairs: list[tuple[str, str]]) -> str:
    return "; ".join(f"{family}, {given}" for family, given in pairs)


def last_number(s: str) -> str:
    """Digits of the last word, '' without any."""
    return re.sub(r"\D", "", s.split(" ")[-1]) if s else ""


def likely_year(s: str) -> str:
    """The first word that is a year after 1950."""
    return next((w for w in s.split() if w.isdigit() and 1950 < int(w) < 2020), "")


# MEDLINE


#: publication types that are no research articles; fixed values
_OTHER = {"Bibliography", "Biography", "Case Reports", "Webcasts", "Dictionary", "Directory", "Editorial", "Festschrift", "Patient Education Handout", "Periodical Index", "Portraits", "Published Erratum", "Scientific Integrity Review", "Congresses"}


def _labelled(parts: list[ET.Element]) -> str:
    """Parts of a structured abstract with their labels."""
    out = []
    for p in parts:
        text, label = whole_text(p), p.get("Label", "")
        out.append(f"<b>{label}: </b> {text}" if label and label != "UNLABELLED" else text)
    return one_line("<p>".join(out) if len(out) > 1 else "".join(out))


def medline_article(cite: ET.Element) -> dict[str, str] | None:
    """Fields of a MedlineCitation."""
    article = cite.find("Article")
    pmid = own_text(cite, "PMID")
    if article is None or not pmid:
        return None
    journal = article.find("Journal")
    pmc = [x for x in (one_line(e.text) for e in all_of(cite, "OtherID", Source="NLM")) if x.startswith("PMC")]
    link = own_text(cite, "MedlineJournalInfo/ISSNLinking")
    year = own_text(journal, "JournalIssue/PubDate/Year")
    if not year:
        first = own_text(journal, "JournalIssue/PubDate/MedlineDate").split(" ")[0]
        year = first if first.isdigit() else ""
    people = [(own_text(a, "LastName") or own_text(a, "CollectiveName"), own_text(a, "ForeName") or own_text(a, "Initials")) for a in all_of(article, "AuthorList/Author")]
    kinds = {one_line(e.text) for e in all_of(article, "PublicationTypeList/PublicationType")}
    return {
        "externalId": f"PMID{pmid}", "source": "medline", "pmid": pmid, "pmcId": pmc[0].split()[0].replace("PMC", "") if pmc else "", "fulltextUrl": f"https://www.ncbi.nlm.nih.gov/pubmed/{pmid}",
        "title": _labelled(all_of(article, "ArticleTitle")), "abstract": _labelled(all_of(article, "Abstract/AbstractText")) or _labelled(all_of(cite, "OtherAbstract/AbstractText")),
        "authorAffiliations": own_text(article, "Affiliation") or own_text(article, "AuthorList/Author/AffiliationInfo/Affiliation"), "doi": own_text(article, "ELocationID", EIdType="doi"), "lang": own_text(article, "Language"),
        "journalUniqueId": own_text(cite, "MedlineJournalInfo/NlmUniqueID"), "eIssn": own_text(journal, "ISSN", IssnType="Electronic") or link, "printIssn": own_text(journal, "ISSN", IssnType="Print") or link,
        "vol": own_text(journal, "JournalIssue/Volume"), "issue": own_text(journal, "JournalIssue/Issue"), "year": year, "journal": own_text(journal, "Title"), "page": own_text(article, "Pagination/MedlinePgn"),
        "authors": names(people), "articleType": "review" if "Review" in kinds else "research-article" if "Letter" in kinds or not kinds & _OTHER else "other",
        "keywords": "/".join(one_line(e.text) for e in all_of(cite, "MeshHeadingList/MeshHeading/DescriptorName")),
    }


def medline_articles(root: ET.Element) -> Iterator[dict[str, str]]:
    """Of a set of citations, with the identifiers of the surrounding PubMed article where there is one."""
    around = {id(c): a for a in root.iter("PubmedArticle") for c in a.iter("MedlineCitation")}
    for cite in [root] if root.tag == "MedlineCitation" else list(root.iter("MedlineCitation")):
        if got := medline_article(cite):
            outer = around.get(id(cite))
            ids = lambda kind: own_text(outer, "PubmedData/ArticleIdList/ArticleId", IdType=kind)  # noqa: B023, E731
            yield got | {k: v for k, v in (("doi", ids("doi")), ("pmcId", ids("pmc").replace("PMC", ""))) if v}


# PMC


def _contributors(group: ET.Element | None) -> tuple[str, str, str]:
    """Names, e-mail addresses and affiliations; family and given names are paired as far as both go."""
    families, givens, mails, places = [], [], [], []
    for c in group if group is not None else []:
        if c.tag == "aff":
            parts = [x for x in (own_text(c, tag) for tag in ("institution", "addr-line", "country")) if x] or [one_line(whole_text(c))]
            places.append(", ".join(x for x in parts if x))
        if c.get("contrib-type") == "author" and (name := c.find("name")) is not None:
            families += [own_text(name, "surname")] if name.find("surname") is not None else []
            givens += [own_text(name, "given-names")] if name.find("given-names") is not None else []
            mails += [m for m in (own_text(c, "email"), own_text(c, "address/email")) if m]
    return names(list(zip(families, givens, strict=False))), "; ".join(mails), "; ".join(places)


def least_year(meta: ET.Element | None) -> str:
    years = [int(t) for t in (own_text(d, "year") for d in all_of(meta, "pub-date")) if t.isdigit()]
    return str(min(years)) if years else "noValidYear"


def pmc_article(root: ET.Element) -> dict[str, str] | None:
    """Fields of a PMC article; another root or an empty one is an article without content."""
    if root.tag != "article" or not len(root):
        return {"articleType": "noContent"}
    journal, meta = root.find("front/journal-meta"), root.find("front/article-meta")
    ident = lambda kind: own_text(meta, "article-id", pub_id_type=kind)
    people, mails, places = _contributors(meta.find("contrib-group") if meta is not None else None)
    abstract = meta.find("abstract") if meta is not None else None
    return {
        "externalId": f"PMC{ident('pmc')}", "source": "pmcftp", "articleType": root.get("article-type", ""), "pmcId": ident("pmc"), "pmid": ident("pmid"), "doi": ident("doi"), "fulltextUrl": f"http://www.ncbi.nlm.nih.gov/pmc/articles/PMC{ident('pmc')}",
        "journal": own_text(journal, "journal-title") or own_text(journal, "journal-title-group/journal-title"), "printIssn": own_text(journal, "issn", pub_type="ppub"), "eIssn": own_text(journal, "issn", pub_type="epub"),
        "title": one_line(whole_text(meta.find("title-group/article-title") if meta is not None else None)), "year": least_year(meta), "authors": people, "authorEmails": mails, "authorAffiliations": places,
        "vol": own_text(meta, "volume"), "issue": own_text(meta, "issue"), "page": own_text(meta, "fpage"), "abstract": one_line(whole_text(abstract)),
    }


def pmc_supplements(root: ET.Element) -> dict[str, str]:
    """File name -> description of the supplementary files: one element with many files, or one for each file."""
    found = list(root.iter("supplementary-material"))
    if len(found) == 1:
        return {m.get("href", ""): " - ".join(x for x in (f"Supp. File {k}", own_text(m, "label")) if x) for k, m in enumerate(found[0].findall("media"), 1)}
    out: dict[str, str] = {}
    for s in found:
        title = own_text(s, "caption/title")
        label = [title] * bool(title) + [f"Supp. File {len(out)}"] * (not title.startswith("Additional"))
        for m in s.findall("media"):
            out[m.get("href", "")] = " - ".join(label)
    return out


def pmc_references(root: ET.Element) -> list[dict[str, str]]:
    """One row a citation of the reference lists."""
    out = []
    for ref in (r for refs in root.iter("ref-list") for r in refs.iter("ref")):
        for cite in [*ref.findall("citation"), *ref.findall("mixed-citation"), *ref.findall("element-citation"), *ref.findall("citation-element")]:
            people = [(own_text(n, "surname"), own_text(n, "given-names")) for n in cite.iter("name") if n.find("surname") is not None and n.find("given-names") is not None]
            fields = {"journal": "source", "year": "year", "month": "month", "vol": "volume", "issue": "issue", "page": "fpage", "title": "article-title"}
            out.append({"authors": names(people), **{k: own_text(cite, tag) for k, tag in fields.items()}, **{k: own_text(cite, "pub-id", pub_id_type=k) for k in ("pmid", "doi")}})
    return out


# Elsevier


#: elements of an article's text, the first that is there counts; fixed values
_MAIN = ("converted-article", "article", "simple-article", "book-review", "exam", "book", "chapter", "simple-chapter", "examination", "fb-non-chapter")


def _main_article(root: ET.Element) -> ET.Element | None:
    return next((el for tag in _MAIN for el in root.iter(tag)), None)


def elsevier_article(root: ET.Element) -> dict[str, str] | None:
    """Fields of a document with an RDF description; without one, or without an article, it is none."""
    desc = next((d for path in ("RDF/Description", "rdf/description") if (d := root.find(path)) is not None), None)
    article = _main_article(root)
    if desc is None or article is None:
        return None
    year = own_text(root, "document-properties/year-first") or last_number(own_text(desc, "coverDisplayDate")) or last_number(likely_year(own_text(desc, "copyright")))
    if not year:
        year = next((c.get("year", "") for c in all_of(article, "item-info/copyright")), "")
    head = next((h for tag in ("head", "simple-head") if (h := article.find(tag)) is not None), article)
    people = [(own_text(a, "surname"), own_text(a, "given-name")) for a in all_of(head, "author-group/author")]
    listed = [one_line(li.text) for seq in ("seq", "Seq") for li in all_of(desc, f"creator/{seq}/li") if li.text]
    abstract = next((one_line("".join(a.itertext())) for a in head.findall("abstract") if a.get("class") != "graphical"), "")
    for word in ("Abstract", "Summary"):
        abstract = re.sub(f"^ *{word} +", "", abstract)
    got = {
        "source": "elsevier", "articleType": article.tag, "title": own_text(desc, "title"), "doi": own_text(desc, "doi"), "journal": own_text(desc, "publicationName"), "fulltextUrl": own_text(desc, "url"), "printIssn": own_text(desc, "issn"),
        "page": own_text(desc, "startingPage"), "issue": own_text(desc, "number"), "vol": own_text(desc, "volume"), "year": year, "authors": names(people) if people else "; ".join(listed), "abstract": abstract,
    }
    return got | {"externalId": got["doi"]}


def elsevier_text(root: ET.Element) -> str | None:
    """The raw text if the document has one, else the text of the article."""
    raw = next((r for r in root.iter("raw-text") if r.text), None)
    if raw is not None:
        try:
            return raw.text.encode("latin1").decode("utf8")
        except UnicodeError:
            return raw.text
    article = _main_article(root)
    return whole_text(article) if article is not None else None


# Springer


def springer_article(root: ET.Element) -> dict[str, str] | None:
    """Fields of a Springer article; without a header it is none."""
    journal = root.find("Journal")
    info = journal.find("JournalInfo") if journal is not None else None
    article = journal.find("Volume/Issue/Article") if journal is not None else None
    head = article.find("ArticleHeader") if article is not None else None
    if head is None:
        return None
    meta, issue = article.find("ArticleInfo"), journal.find("Volume/Issue/IssueInfo")
    people = [(own_text(a, "AuthorName/FamilyName"), " ".join(one_line(g.text) for g in all_of(a, "AuthorName/GivenName") if g.text)) for a in all_of(head, "AuthorGroup/Author")]
    words = [one_line(k.text).replace(";", ",") for k in [*all_of(info, "JournalSubjectGroup/JournalSubject"), *all_of(head, "KeywordGroup/Keyword")] if k.text]
    abstract, headings = [], 0
    for el in head.find("Abstract").iter() if head.find("Abstract") is not None else []:
        if el.tag == "Heading":
            headings += 1
            # the first heading is always "Abstract"
            abstract += [f"<b>{one_line(el.text)}: <b>"] if headings > 1 and el.text else []
        elif el.tag == "Para":
            abstract.append(whole_text(el))
    doi = own_text(meta, "ArticleDOI")
    return {
        "externalId": doi, "source": "springer", "publisher": "springer", "doi": doi, "fulltextUrl": f"http://link.springer.com/article/{doi}", "journal": own_text(info, "JournalTitle"), "printIssn": own_text(info, "JournalPrintISSN"), "eIssn": own_text(info, "JournalElectronicISSN"),
        "vol": own_text(journal, "Volume/VolumeInfo/VolumeIDStart"), "issue": own_text(issue, "IssueIDStart"), "year": next((y for kind in ("Online", "Print", "Cover") if (y := own_text(issue, f"IssueHistory/{kind}Date/Year"))), ""),
        "title": one_line(whole_text(next(iter(all_of(meta, "ArticleTitle")), None))), "articleType": own_text(meta, "ArticleCategory") or "unknown", "page": own_text(meta, "ArticleFirstPage"), "authors": names(people),
        "authorEmails": "; ".join(one_line(e.text) for e in all_of(head, "AuthorGroup/Author/Contact/Email") if e.text), "abstract": one_line("".join(abstract)), "keywords": "; ".join(words),
    }


FORMATS: dict[str, Callable[[ET.Element], list[dict[str, str]]]] = {
    "medline": lambda root: list(medline_articles(root)),
    **{name: (lambda root, f=f: [x] if (x := f(root)) else []) for name, f in (("pmc", pmc_article), ("elsevier", elsevier_article), ("springer", springer_article))},
}
#: fields that the converters fill
FIELDS = [f for f in ARTICLE_FIELDS if f not in ("articleId", "offset", "size")]
REF_COLUMNS = "authors title journal year month vol issue page pmid doi".split()


def _rows(df: DataFrame, id_col: str, xml: str, fields: list[str], rows: Callable[[ET.Element], list[dict[str, str]]]) -> DataFrame:
    schema = T.StructType([df.schema[id_col], *[T.StructField(f, T.StringType()) for f in fields]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, x in zip(b[id_col], b[xml], strict=True):
                root = tree(x)
                if root is not None:
                    out.extend((i, *[r.get(f, "") for f in fields]) for r in rows(root))
            yield pd.DataFrame(out, columns=[id_col, *fields])

    return df.select(id_col, xml).mapInPandas(run, schema)


def articles_from_xml(df: DataFrame, kind: str, id_col: str = "fileid", xml: str = "content") -> DataFrame:
    """Article fields of each document of a format: medline, pmc, elsevier or springer."""
    return _rows(df, id_col, xml, FIELDS, FORMATS[kind])


def references_from_xml(df: DataFrame, id_col: str = "fileid", xml: str = "content") -> DataFrame:
    """Citations of each PMC document."""
    return _rows(df, id_col, xml, REF_COLUMNS, pmc_references)
