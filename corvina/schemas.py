"""Table schemas of the corpus and the identifier layout."""

from __future__ import annotations

from pyspark.sql import types as T

#: columns of the article and file tables; fixed values
ARTICLE_FIELDS = "articleId externalId source publisher origFile journal printIssn eIssn journalUniqueId year articleType articleSection authors authorEmails authorAffiliations keywords title abstract lang vol issue page pmid pmcId doi fulltextUrl time offset size".split()
FILE_FIELDS = "fileId externalId articleId url desc fileType time mimeType locFname content".split()
REF_FIELDS = "articleId externalId artDoi artPmid authors title journal year month vol issue page pmid doi".split()
#: digits of an article, of a file in it and of an annotation in that
ARTICLE_DIGITS, FILE_DIGITS, ANNOT_DIGITS = 10, 3, 5
#: first article id of each dataset; fixed values
ID_START = {"pmc": 1000000000, "elsevier": 2000000000, "springer": 2500000000, "medline": 3000000000, "bing": 3500000000, "genbank": 4000000000, "imgt": 4300000000, "pdfDir": 4400000000, "yif": 4500000000, "crawler": 5000000000, "free": 6000000000}
#: fixed table formats; fixed values
TABLE_FORMATS = {
    "psl": "matches misMatches repMatches nCount qNumInsert qBaseInsert tNumInsert tBaseInsert strand qName qSize qStart qEnd tName tSize tStart tEnd blockCount blockSizes qStarts tStarts",
    "bed3": "chrom start end",
    "bed4": "chrom start end name",
    "bed12": "chrom start end name score strand thickStart thickEnd itemRgb blockCount blockSizes blockStarts",
    "blastm8": "qName tName identity alnLen mismatches gaps qStart qEnd tStart tEnd eVal score",
    "intmap": "key value",
    "sam": "qName flag rName pos mapq cigar rNext pNext tLen seq qual",
}
_INTS = set("matches misMatches repMatches nCount qNumInsert qBaseInsert tNumInsert tBaseInsert qSize qStart qEnd tSize tStart tEnd blockCount start end score thickStart thickEnd alnLen mismatches gaps key value flag pos mapq pNext tLen".split())


def string_schema(names: list[str], long: set[str] = frozenset()) -> T.StructType:
    return T.StructType([T.StructField(n, T.LongType() if n in long else T.StringType()) for n in names])


def table_schema(kind: str) -> T.StructType:
    names = TABLE_FORMATS[kind].split()
    return string_schema(names, {n for n in names if n in _INTS and not (kind == "blastm8" and n == "score")})


ARTICLES = string_schema(ARTICLE_FIELDS, {"articleId", "offset", "size"})
FILES = string_schema(FILE_FIELDS, {"fileId", "articleId"})
REFS = string_schema(REF_FIELDS, {"articleId"})
