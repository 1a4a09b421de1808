"""Annotators: table functions that give spans of each text, with stable ids and snippets.

A tagger is either a table of patterns (native: spans by regular expressions in the JVM) or a Python class with `headers`,
`startup` and `annotate`, run over Arrow batches.  Caps are part of a tagger's meaning: a document with more hits than the
cap gives none.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvina.functions.ids import annot_id
from corvina.functions.text import bound, match_spans, snippet_of, spans_with_snippets
from corvina.session import staged


def _with_hits(df: DataFrame, pattern: str, text: str, cap: int | None, needs: list[str] | None) -> DataFrame:
    """Rows with matches and the array of these, _hits."""
    if needs:
        low = F.lower(text)
        cond = low.contains(needs[0].lower())
        for w in needs[1:]:
            cond = cond | low.contains(w.lower())
        df = df.where(cond)
    hits = df.where(F.col(text).rlike(pattern)).withColumn("_hits", match_spans(F.col(text), pattern))
    return hits if cap is None else hits.where(F.size("_hits") <= cap)


def regex_spans(df: DataFrame, pattern: str, keep: list[str], text: str = "content", cap: int | None = None, needs: list[str] | None = None) -> DataFrame:
    """One row a match: `keep`, start, end, hit.  `needs` are words of which the text must hold one, tested first."""
    hits = _with_hits(df, pattern, text, cap, needs)
    return hits.select(*keep, F.explode("_hits").alias("_h")).select(*keep, "_h.start", "_h.end", "_h.hit")


def regex_snippets(df: DataFrame, pattern: str, keep: list[str], text: str = "content", cap: int | None = None, needs: list[str] | None = None) -> DataFrame:
    """One row a match: `keep`, start, end, hit, snippet."""
    return spans_with_snippets(_with_hits(df, pattern, text, cap, needs), "_hits", text, keep)


def with_annot_ids(spans: DataFrame, file: str = "fileid", order: tuple[str, ...] = ("start", "end"), offset: int = 0) -> DataFrame:
    """annotid = file id, five digits of running number in the file, plus the tagger's offset."""
    w = Window.partitionBy(file).orderBy(*order)
    return spans.withColumn("annotid", annot_id(F.col(file), F.row_number().over(w) - 1, offset))


@dataclass
class Tagger:
    """A table function over texts: `annotate(text)` yields tuples as long as `headers`, the first two being start and end."""

    name: str
    headers: list[str]
    annotate: Callable[[str], Iterator[tuple]]
    startup: Callable[[dict], None] | None = None
    cap: int | None = None
    params: dict = field(default_factory=dict)


_TAGGERS: dict[str, Tagger] = {}


def register_tagger(tagger: Tagger) -> Tagger:
    if tagger.headers[:2] != ["start", "end"]:
        raise ValueError("the first two headers must be start and end")
    _TAGGERS[tagger.name] = tagger
    return tagger


def tagger(name: str) -> Tagger:
    return _TAGGERS[name]


def run_tagger(files: DataFrame, which: Tagger, keep: list[str], text: str = "content", offset: int = 0) -> DataFrame:
    """annotid, `keep`, the tagger's headers and snippet.  Null texts give nothing; rows of a wrong width raise."""
    extra = which.headers[2:]
    heads = ["fileid", *[k for k in keep if k != "fileid"]]
    schema = files.select(*heads).schema.add("start", T.IntegerType()).add("end", T.IntegerType()).add("no", T.IntegerType())
    for h in extra:
        schema = schema.add(h, T.StringType())
    schema = schema.add("snippet", T.StringType())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if which.startup:
            which.startup(which.params)
        for b in batches:
            rows = []
            for r, content in zip(b[heads].itertuples(index=False), b["_text"], strict=True):
                if content is None:
                    continue
                found = list(which.annotate(content))
                if which.cap is not None and len(found) > which.cap:
                    continue
                for no, x in enumerate(found):
                    if len(x) != len(which.headers):
                        raise ValueError(f"tagger {which.name}: a row has {len(x)} fields, the headers {len(which.headers)}")
                    rows.append((*r, int(x[0]), int(x[1]), no, *[str(v) for v in x[2:]], snippet_of(content, int(x[0]), int(x[1]))))
            yield pd.DataFrame(rows, columns=[f.name for f in schema])

    out = files.select(*heads, F.col(text).alias("_text")).mapInPandas(run, schema)
    return out.withColumn("annotid", annot_id(F.col("fileid"), F.col("no"), offset)).drop("no")


def run_taggers(files: DataFrame, which: list[Tagger], keep: list[str], text: str = "content") -> dict[str, DataFrame]:
    """Several taggers over one corpus with disjoint ranges of annotation ids."""
    step = 100_000 // max(1, len(which))
    return {t.name: run_tagger(files, t, keep, text, offset=i * step) for i, t in enumerate(which)}


_WORD = re.compile(r"[\w']+")


def build_trie(lexicon: list[tuple[str, str]]) -> dict:
    """Token trie of (phrase, id); phrases with several ids get them joined by commas."""
    root: dict = {}
    for phrase, ident in lexicon:
        node = root
        for w in _WORD.findall(phrase.lower()):
            node = node.setdefault(w, {})
        if node is not root:
            node.setdefault(0, [])
            if ident not in node[0]:
                node[0].append(ident)
    return root


def match_trie(text: str, trie: dict, flank: int = 0) -> list[tuple]:
    """Longest phrase matches from left to right without overlap: (start, end, ids), with `flank` words left and right."""
    words = [(m.start(), m.end(), m[0].lower()) for m in _WORD.finditer(text)]
    out, i = [], 0
    while i < len(words):
        node, j, best = trie, i, None
        while j < len(words) and words[j][2] in node:
            node = node[words[j][2]]
            j += 1
            if 0 in node:
                best = j, ",".join(node[0])
        if best is None:
            i += 1
            continue
        j, ident = best
        hit = (words[i][0], words[j - 1][1], ident)
        if flank:
            hit += ([w for _, _, w in words[max(0, i - flank) : i]], [w for _, _, w in words[j : j + flank]])
        out.append(hit)
        i = j
    return out


def phrase_tagger(name: str, lexicon: list[tuple[str, str]], cap: int | None = None, most: int = 5_000_000) -> Tagger:
    """A dictionary tagger.  The lexicon travels with the tasks, so its size is checked; use phrase_join beyond it."""
    if sum(len(p) for p, _ in lexicon) > most:
        raise ValueError("the lexicon is too large to send to every task: use phrase_join")
    trie = build_trie(lexicon)
    return register_tagger(Tagger(name, ["start", "end", "id"], lambda text: iter(match_trie(text, trie)), cap=cap))


#: first words of a lexicon that are sent to the tasks; a larger lexicon is joined
FIRST_WORDS = 200_000


def phrase_places(docs: DataFrame, firsts: DataFrame, id_col: str, text: str, longest: int, flank: int, lower: bool, word: str) -> DataFrame:
    """(id, pos, start, first, ahead, ends, left) of the words of each text at which a phrase may begin.

    `ahead` are the words from there on, as many as the longest phrase has and `flank` more, `ends` where they end, `left` the
    words before.  The first words of a lexicon of up to FIRST_WORDS choose the places in one pass over Arrow batches; beyond
    that all places are made in the JVM, and the join that follows chooses.
    """
    known = [r[0] for r in firsts.distinct().limit(FIRST_WORDS + 1).collect()]  # no more than the bound
    fields = "pos int, start int, first string, ahead array<string>, ends array<int>, left array<string>"
    if len(known) <= FIRST_WORDS:
        begin = set(known)
        schema = T.StructType([docs.schema[id_col], *T.StructType.fromDDL(fields).fields])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            pattern = re.compile(word)
            for b in batches:
                rows = []
                for i, t in zip(b[id_col], b["_text"], strict=True):
                    if not t:
                        continue
                    found = [(m.start(), m.end(), m[0]) for m in pattern.finditer(t)]
                    words = [w.lower() for _, _, w in found] if lower else [w for _, _, w in found]
                    rows.extend((i, k, found[k][0], w, words[k : k + longest + flank], [e for _, e, _ in found[k : k + longest]], words[max(0, k - flank) : k]) for k, w in enumerate(words) if w in begin)
                yield pd.DataFrame(rows, columns=schema.names)

        return docs.select(id_col, F.col(text).alias("_text")).mapInPandas(run, schema)
    said = F.lower(text) if lower else F.col(text)

    def ahead(ws: Column) -> Column:
        near = lambda i, n: F.transform(F.slice(ws, i, n), lambda x: x["hit"])
        before = lambda i: F.when((i > 0) & F.lit(flank > 0), near(F.greatest(i - flank + 1, F.lit(1)), F.least(i, F.lit(flank)))).otherwise(F.array().cast("array<string>"))
        return F.transform(ws, lambda x, i: F.struct(i.alias("pos"), x["start"].alias("start"), x["hit"].alias("first"), near(i + 1, F.lit(longest + flank)).alias("ahead"), F.transform(F.slice(ws, i + 1, longest), lambda y: y["end"]).alias("ends"), before(i).alias("left")))

    return docs.select(id_col, F.explode(bound(match_spans(said, word), ahead)).alias("_x")).select(id_col, "_x.*")


def longest_phrases(docs: DataFrame, lexicon: DataFrame, id_col: str, text: str, longest: int, lower: bool = True, flank: int = 0, word: str = "[A-Za-z0-9_]+", joined: str = "/") -> DataFrame:
    """(id, pos, start, end, n, phraseid, left, right) of the longest phrases of a lexicon (phrase, id) of any size.

    From left to right without overlap; a phrase of several ids has them joined.  `left` and `right` are the `flank` words
    beside the match.  Null and empty texts and phrases give nothing.
    """
    key = lambda c: F.lower(c) if lower else F.col(c)
    lex = lexicon.select(F.regexp_extract_all(key("phrase"), F.lit(word), F.lit(0)).alias("_w"), F.col("id").cast("string").alias("phraseid")).where(F.size("_w").between(1, longest))
    lex = lex.groupBy(F.element_at("_w", 1).alias("first"), F.array_join("_w", " ").alias("gram"), F.size("_w").alias("n")).agg(F.array_join(F.sort_array(F.collect_set("phraseid")), joined).alias("phraseid"))
    places = phrase_places(docs, lex.select("first"), id_col, text, longest, flank, lower, word)
    hits = places.join(lex, "first").where(F.array_join(F.slice("ahead", F.lit(1), F.col("n")), " ") == F.col("gram"))
    best = hits.groupBy(id_col, "pos").agg(F.max_by(F.struct("start", "ends", "n", "phraseid", "left", "ahead"), "n").alias("x")).select(id_col, "pos", "x.*")
    covered = F.max(F.col("pos") + F.col("n")).over(Window.partitionBy(id_col).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    kept = best.withColumn("_c", covered).where(F.col("_c").isNull() | (F.col("_c") <= F.col("pos")))
    return kept.select(id_col, "pos", "start", F.element_at("ends", F.col("n")).alias("end"), "n", "phraseid", "left", F.slice("ahead", F.col("n") + 1, F.lit(flank) if flank else F.lit(0)).alias("right"))


def phrase_join(docs: DataFrame, lexicon: DataFrame, id_col: str, text: str, longest: int) -> DataFrame:
    """(id, pos, n, phraseid): places by the number of the word and lengths in words, for phrases of a lexicon of any size."""
    return longest_phrases(docs, lexicon, id_col, text, longest, joined=",").select(id_col, "pos", "n", "phraseid")


#: identifier patterns: kind, pattern, words the text must hold one of; fixed values
IDENTIFIERS = [
    ("snp", r"\brs[0-9]{3,10}\b", ["rs"]), ("omim", r"\b[0-9]{6}\b", ["omim", "mim"]), ("ec", r"\b[1-6]\.[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{1,3}\b", ["ec"]), ("genbank", r"\b[A-Z]{1,2}[0-9]{5,6}\b", ["genbank", "accession", "ncbi"]), ("refseq", r"\b[NX][MRP]_[0-9]{6,9}(?:\.[0-9]+)?\b", ["nm_", "np_", "nr_", "xm_", "xp_", "xr_"]),
    ("ensembl", r"\bENS[A-Z]{0,4}[GTPE][0-9]{11}\b", ["ens"]), ("uniprot", r"\b[OPQ][0-9][A-Z0-9]{3}[0-9]\b", ["uniprot", "swissprot", "protein"]), ("pdb", r"\b[1-9][A-Z0-9]{3}\b", ["pdb", "rcsb"]), ("geo", r"\bG(?:SE|SM|PL|DS)[0-9]{2,8}\b", ["gse", "gsm", "gpl", "gds"]), ("arrayexpress", r"\bE-[A-Z]{4}-[0-9]+\b", ["e-"]),
    ("band", r"\b(?:[1-9]|1[0-9]|2[0-2]|X|Y)[pq][0-9]{1,2}(?:\.[0-9]{1,2})?\b", ["p", "q"]), ("hgvs", r"\b[cp]\.[A-Za-z0-9_>+*-]+", ["c.", "p."]), ("interpro", r"\bIPR[0-9]{6}\b", ["ipr"]), ("go", r"\bGO:[0-9]{7}\b", ["go:"]), ("kegg", r"\bhsa[0-9]{5}\b", ["hsa"]), ("coord", r"\bchr(?:[1-9]|1[0-9]|2[0-2]|X|Y):[0-9,]+-[0-9,]+\b", ["chr"]), ("sra", r"\b[SED]R[RXPS][0-9]{6,9}\b", ["srr", "srx", "srp", "err", "drr"]),
]


#: more kinds of accession numbers: kind, pattern, words the text must hold one of; fixed values
MORE_IDENTIFIERS = [
    ("snpSs", r"\bss[0-9]{4,16}\b", ["ss"]), ("refprot", r"\b[XYNAZ]P_[0-9]{4,11}\b", ["p_"]), ("entrez", r"\b(?:Locus(?:Link|link)?|LOCUS(?:LINK)?|Entrez[ -]Gene|Entrez|GeneID|LocusID) ?(?:#|No|no|number|ID|accession)? ?:? ?[0-9]{3,8}\b", ["locus", "entrez", "geneid"]), ("sts", r"\b(?:UniSTS|UNISTS|uniSTS) ?(?:[aA]ccession(?: number)?|#|ID|[nN]o\.?|[Nn]umber)?:? ?[0-9]{3,10}\b", ["unists"]),
    ("pfam", r"\bPF[0-9]{5}\b", ["pfam"]), ("prints", r"\bPR[0-9]{5}\b", ["prints"]), ("pirsf", r"\bPIRSF[0-9]{6}\b", ["pirsf"]), ("prosite", r"\bPS[0-9]{5}\b", ["ps"]), ("smart", r"\bSM[0-9]{5}\b", ["smart"]), ("supFam", r"\bSSF[0-9]{5}\b", ["ssf"]), ("ccds", r"\bCCDS[0-9]{1,8}\b", ["ccds"]),
    ("affymetrix", r"\b[0-9]{5,8}(?:_[sa])?_at\b", ["_at"]), ("hprd", r"\b(?:HPRD|hprd)[: ](?:id [: ])?[0-9]{5,8}\b", ["hprd"]), ("pharmGkb", r"\bPA[0-9]{3,6}\b", ["pharmgkb"]), ("chembl", r"\bCHEMBL[0-9]{3,6}\b", ["chembl"]), ("hInv", r"\bHIX[0-9]{3,7}\b", ["hix"]), ("hgnc", r"\bHGNC:[0-9]{2,7}\b", ["hgnc:"]),
    ("ucsc", r"\buc[0-9]{3}[a-z]{3}\b", ["uc"]), ("uniGene", r"\bHs\.[0-9]{3,6}\b", ["hs."]), ("vega", r"\bOTTHUM[TPG][0-9]{11}\b", ["otthum"]), ("cosmic", r"\bCOSM[0-9]{6}\b", ["cosm"]), ("mgi", r"\bMGI(?: accession no\.| id| accession| acc\.)?[: ][0-9]{3,8}\b", ["mgi"]), ("flybase", r"\b(?:C[GR][0-9]{4,5}|FB(?:ab|al|ba|cl|gn|im|mc|ms|pp|rf|st|ti|tp|tr)[0-9]{7})\b", ["flybase", "drosophila"]),
    ("wormbase", r"\b(?:WBGene[0-9]{8}|WP:CE[0-9]{5})\b", ["wb", "wp:"]), ("sgd", r"\b(?:Y[A-Z]{2}[0-9]{3}[CW](?:-[AB])?|S[0-9]{9})\b", ["sgd", "yeast"]), ("zfin", r"\bZDB-GENE-[0-9]{6,8}-[0-9]{2,4}\b", ["zdb-"]), ("clinTrials", r"\bNCT[0-9]{8}\b", ["nct"]), ("merops", r"\bMER[0-9]{6}\b", ["mer"]), ("mirbase", r"\bMI(?:MAT)?[0-9]{7}\b", ["mirbase", "mirna"]),
    ("rfam", r"\bRF[0-9]{5}\b", ["rfam"]), ("tair", r"\bA[Tt][1-5MC][Gg][0-9]{5}\b", ["arabidopsis", "tair"]), ("dbGap", r"\bphs[0-9]{6}\b", ["phs"]), ("taxon", r"\btaxon(?:omy)?(?: id)?:? ?[0-9]{2,8}\b", ["taxon"]),
]
#: kinds whose number alone is the id
_NUMBERED = ("entrez", "sts", "hprd", "mgi", "taxon")


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda h: F.struct(F.lit(kind).alias("kind"), h["start"].alias("start"), h["end"].alias("end"), h["hit"].alias("hit"))


def identifier_spans(df: DataFrame, keep: list[str], text: str = "content", kinds: list[str] | None = None, cap: int = 500) -> DataFrame:
    """Spans of accession numbers of all kinds, one scan: patterns run as columns and a cap drops overfull documents.

    `kind` and the normalised `ident` (pdb in lower case, coordinates without commas) are added.
    """
    use = [(k, p, n) for k, p, n in IDENTIFIERS + MORE_IDENTIFIERS * (kinds is not None) if kinds is None or k in kinds]
    low = F.lower(text)
    parts = []
    for kind, pattern, needs in use:
        cond = low.contains(needs[0])
        for w in needs[1:]:
            cond = cond | low.contains(w)
        parts.append(F.transform(F.when(cond, match_spans(F.col(text), pattern)).otherwise(F.array().cast("array<struct<start:int,end:int,hit:string>>")), _of_kind(kind)))
    hits = df.select(*keep, F.concat(*parts).alias("_h")).where((F.size("_h") > 0) & (F.size("_h") < cap))
    out = hits.select(*keep, F.explode("_h").alias("_x")).select(*keep, "_x.*")
    ident = F.when(F.col("kind") == "pdb", F.lower("hit")).when(F.col("kind") == "coord", F.regexp_replace("hit", ",", "")).when(F.col("kind").isin(*_NUMBERED), F.regexp_extract("hit", "[0-9]+$", 0)).otherwise(F.col("hit"))
    return out.withColumn("ident", ident)


def accepted_identifiers(spans: DataFrame, accepted: DataFrame) -> DataFrame:
    """Spans of which `accepted` (kind, acc) holds the id; kinds that it has nothing of are not judged."""
    judged = accepted.select("kind").distinct().withColumn("_j", F.lit(1))
    known = accepted.select("kind", F.col("acc").alias("ident")).distinct().withColumn("_k", F.lit(1))
    return spans.join(F.broadcast(judged), "kind", "left").join(known, ["kind", "ident"], "left").where(F.col("_j").isNull() | F.col("_k").isNotNull()).drop("_j", "_k")


def accession_lists(df: DataFrame, keep: list[str], text: str = "content", most: int = 20) -> DataFrame:
    """`keep`, start, end, acc of ranges of sequence accessions `JN011487-JN011488`: one row for each accession in them.

    Both ends have the same letters and width and are not further apart than `most`.
    """
    one = "(?:[A-Z][0-9]{5}|[A-Z]{2}[0-9]{6}|[A-Z]{4}[0-9]{8,9}|[A-Z]{5}[0-9]{7})"
    hits = regex_spans(df, rf"\b{one}-{one}\b", keep, text)
    part = lambda k: F.regexp_extract("hit", "^([A-Z]+)([0-9]+)-([A-Z]+)([0-9]+)$", k)
    a, b = part(2).cast("long"), part(4).cast("long")
    same = (part(1) == part(3)) & (F.length(part(2)) == F.length(part(4))) & (a <= b) & (b - a <= most)
    return hits.where(same).select(*keep, "start", "end", part(1).alias("_l"), F.length(part(2)).alias("_w"), F.explode(F.sequence(a, b)).alias("_n")).select(*keep, "start", "end", F.concat("_l", F.lpad(F.col("_n").cast("string"), F.col("_w"), F.lit("0"))).alias("acc"))


_THREE = dict(zip("Ala Arg Asn Asp Cys Gln Glu Gly His Ile Leu Lys Met Phe Pro Ser Thr Trp Tyr Val Ter".split(), "ARNDCQEGHILKMFPSTWYV*", strict=True))
_VARIANTS = [
    ("proteinSub", re.compile(r"\bp\.\(?(?P<old>[A-Z][a-z]{2}|[A-Z])(?P<pos>\d{1,5})(?P<new>[A-Z][a-z]{2}|[A-Z*])\)?")), ("codingSub", re.compile(r"\bc\.(?P<pos>\d{1,6})(?P<old>[ACGT])>(?P<new>[ACGT])")), ("codingDel", re.compile(r"\bc\.(?P<pos>\d{1,6})(?:_(?P<to>\d{1,6}))?del(?P<old>[ACGT]*)")),
    ("codingIns", re.compile(r"\bc\.(?P<pos>\d{1,6})_(?P<to>\d{1,6})ins(?P<new>[ACGT]+)")), ("codingDup", re.compile(r"\bc\.(?P<pos>\d{1,6})(?:_(?P<to>\d{1,6}))?dup(?P<new>[ACGT]*)")), ("snp", re.compile(r"\brs(?P<pos>\d{3,10})\b")), ("bareSub", re.compile(r"(?<![\w.])(?P<old>[ARNDCQEGHILKMFPSTWYV])(?P<pos>\d{2,4})(?P<new>[ARNDCQEGHILKMFPSTWYV])(?![\w.])")),
]


def find_variants(text: str) -> Iterator[tuple]:
    """(start, end, kind, normal form) of sequence variants; wild type equal to mutant and chemical symbols are left out."""
    taken: list[tuple[int, int]] = []
    for kind, pattern in _VARIANTS:
        for m in pattern.finditer(text):
            if any(m.start() < e and s < m.end() for s, e in taken):
                continue
            g = {"to": None, "old": None, "new": None, **{k: v for k, v in m.groupdict().items() if v is not None}}
            old, new = (_THREE.get(g[x] or "", g[x] or "") for x in ("old", "new"))
            pos = int(g["pos"])
            if kind in ("proteinSub", "bareSub"):
                if old == new or (kind == "bareSub" and pos < 80 and old in "HC" and new in "ACDEH"):
                    continue
                form = f"p.{old}{pos}{new}"
            elif kind == "codingSub":
                if old == new:
                    continue
                form = f"c.{pos}{old}>{new}"
            elif kind == "snp":
                form = f"rs{pos}"
            else:
                span = f"{pos}_{g['to']}" if g["to"] else f"{pos}"
                form = f"c.{span}{kind[6:].lower()}{old or new}"
            taken.append((m.start(), m.end()))
            yield m.start(), m.end(), kind, form


variant_tagger = register_tagger(Tagger("variants", ["start", "end", "kind", "variant"], find_variants, cap=1000))

#: sites that cloning leaves at the ends of short sequences, tried in this order; fixed values
RESTRICTION_SITES = "GAATTC GATATC CTCGAG TCTAGA GCTAGC CCATGG GCGGCCGC AGATCT GGATCC AAGCTT GTCGAC CCCGGG ATCGAT TTTAAA CTGCAG".split()
_SITES = [re.compile(p) for site in RESTRICTION_SITES for p in (f"^[ACTGUactgu]{{0,2}}{site}", f"{site}[ACTGUactgu]{{0,2}}$")]
_LETTERS = re.compile("[a-zA-Z]+")
_BASES = set("ACTGUactgu")
#: shortest sequence, shortest word of one, shortest word in capitals, shortest word with other letters and its share of bases,
#: longest sequence that is freed of a site; fixed values
SEQ_LEAST, WORD_LEAST, CAPITAL_LEAST, MIXED_LEAST, MIXED_SHARE, SITE_MOST = 17, 3, 5, 19, 0.4, 30


def without_site(seq: str) -> str:
    """Without the first of the sites that stands at an end, with up to two bases beyond it."""
    for site in _SITES:
        if site.search(seq):
            return site.sub("", seq)
    return seq


def find_nucleotides(text: str) -> Iterator[tuple]:
    """(start, end, sequence, parts, tainted) of nucleotide sequences, joined over blanks, digits and line breaks.

    Two neighbouring words that are sequences themselves are not joined; the second is then given up, as in a table of
    primers.  Long words with other letters among the bases are cleaned and mark the sequence as tainted.
    """
    plain = re.sub(r"\W", " ", re.sub(r"MathType@[^ ]*", lambda m: " " * len(m[0]), text))
    words: list[re.Match] = []
    kept: list[str] = []
    tainted = False

    def ready() -> tuple | None:
        joined = "".join(kept)
        kinds = len(set(joined.lower()))
        if not (len(joined) >= SEQ_LEAST and kinds >= 3 or kinds > 1 and len(kept) == 1 and joined.isupper() and len(joined) >= CAPITAL_LEAST):
            return None
        seq = without_site(joined) if len(joined) < SITE_MOST else joined
        return words[0].start(), words[-1].end(), re.sub("[aA]{6,}$", "", seq), len(kept), tainted

    for m in _LETTERS.finditer(plain):
        w, held = m[0], sum(map(len, kept))
        bases = [c for c in w if c in _BASES]
        pure = len(bases) == len(w) and (len(w) >= WORD_LEAST or held > SEQ_LEAST) and not (held > SEQ_LEAST and len(w) > SEQ_LEAST)
        if pure or (len(w) >= MIXED_LEAST and len(bases) / len(w) >= MIXED_SHARE):
            tainted |= not pure
            words.append(m)
            kept.append("".join(bases).translate(str.maketrans("uU", "tT")))
            continue
        if kept and (got := ready()):
            yield got
        words, kept, tainted = [], [], False
    if kept and (got := ready()):
        yield got


dna_tagger = register_tagger(Tagger("dna", ["start", "end", "seq", "parts", "tainted"], find_nucleotides, cap=10_000))


def acronyms(text: str) -> dict[str, str]:
    """Acronyms defined in brackets: their letters are the initials of the words before."""
    out = {}
    for m in re.finditer(r"\(([A-Z]{2,8})\)", text):
        before = text[: m.start()].split()[-len(m[1]) :]
        if "".join(w[0] for w in before).upper() == m[1]:
            out[m[1]] = " ".join(before)
    return out


def stage_annotations(df: DataFrame, name: str) -> DataFrame:
    """Annotations written once, for several later uses."""
    return staged(df, f"annot-{name}")
