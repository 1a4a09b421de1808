"""Sequence variants: patterns from a table of templates, parsing, grounding on sequences and mapping to the genome.

Variants are rows (mut, seqtype, start, end, old, new, offset): 1-based start, half open end, mut one of sub, del, ins, dup and
splicing, seqtype protein or dna.  Grounding keeps a variant with those transcripts of the document's genes whose sequence
has the old letters at its place; positions go from protein over coding sequence and transcript to the genome by arithmetic
and a join with alignment blocks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvina.functions.sequences import single_changes
from corvina.operators.annotators import Tagger, register_tagger

#: amino acids by their names; fixed values
AMINO = dict(zip("ala arg asn asp cys gln glu gly his ile leu lys met phe pro ser thr trp tyr val ter x".split(), "ARNDCQEGHILKMFPSTWYVXX", strict=True))
AMINO |= dict(zip("alanine,arginine,asparagine,aspartate,aspartic acid,cysteine,glutamine,glutamate,glutamic acid,glycine,histidine,isoleucine,leucine,lysine,methionine,phenylalanine,proline,serine,threonine,tryptophan,tyrosine,valine,stop".split(","), "ARNDDCQEEGHILKMFPSTWYVX", strict=True))
_LONG = "|".join(sorted(map(re.escape, AMINO), key=len, reverse=True))
#: placeholders of templates; fixed values
PLACEHOLDERS = {
    "sep": r"(?:^|[:;\s\(\[\'\"/,\-])", "pos": r"(?P<pos>[1-9][0-9]*)", "fromPos": r"(?P<fromPos>[1-9][0-9]*)", "toPos": r"(?P<toPos>[1-9][0-9]*)", "offset": r"(?P<offset>[1-9][0-9]*)", "plusMinus": r"(?P<plusMinus>[+-])", "intron": r"(?P<intron>[1-9][0-9]*)",
    "origAaShort": r"(?P<origAaShort>[CISQMNPKDTFAGHLRWVEYX])", "origAasShort": r"(?P<origAasShort>[CISQMNPKDTFAGHLRWVEYX]+)", "mutAaShort": r"(?P<mutAaShort>[fCISQMNPKDTFAGHLRWVEYX*])", "mutAasShort": r"(?P<mutAasShort>[fCISQMNPKDTFAGHLRWVEYX*]+)",
    "skipAa": f"(?:{_LONG})", "origAaLong": f"(?P<origAaLong>{_LONG})", "origAasLong": f"(?P<origAasLong>(?:{_LONG})+)", "mutAaLong": f"(?P<mutAaLong>{_LONG}|fs)", "mutAasLong": f"(?P<mutAasLong>(?:{_LONG}|fs)+)",
    "dna": r"(?P<dna>[actgACTG])", "dnas": r"(?P<dnas>[actgACTG]+)", "origDna": r"(?P<origDna>[actgACTG])", "origDnas": r"(?P<origDnas>[actgACTG]+)", "mutDna": r"(?P<mutDna>[actgACTGfs])", "fs": r"(?P<fs>(?:fs\*?[0-9]*)|fs\*|fs|)?", "rightArrow": "(?:-*>|→|-?&gt;|r|R|4|ﬂ)", "sp": " | |",
}
#: templates used where no table is given
TEMPLATES = [
    ("dna", "sub", True, "c.123T>A", r"{sep}c\.{pos}{origDna}{rightArrow}{mutDna}"), ("dna", "splicing", False, "c.123+1T>A", r"{sep}c\.{pos}{plusMinus}{offset}{origDna}{rightArrow}{mutDna}"), ("dna", "del", True, "c.1_2del", r"{sep}c\.{fromPos}_{toPos}del{origDnas}?"),
    ("dna", "del", True, "c.1delA", r"{sep}c\.{pos}del{origDnas}"), ("dna", "ins", True, "c.1_2insA", r"{sep}c\.{fromPos}_{toPos}ins{dnas}"), ("dna", "dup", True, "c.1dupA", r"{sep}c\.{pos}dup{dnas}"),
    ("protein", "sub", True, "p.V600E", r"{sep}(?:p\.)?{origAaShort}{pos}{mutAaShort}(?!\w)"), ("protein", "sub", True, "p.Val600Glu", r"{sep}(?:p\.)?\(?{origAaLong}-?{pos}{mutAaLong}\)?"), ("dbSnp", "dbSnp", True, "rs123", r"{sep}rs(?P<rsId>[0-9]{{3,10}})"),
]


def variant_patterns(rows: list[tuple[str, str, bool, str, str]]) -> list[tuple[str, str, bool, str, re.Pattern]]:
    """Compiled (seqtype, mut, coding, name, pattern) of templates; those with long amino acid names ignore letter case."""
    return [(seq, mut, coding, name or template, re.compile(template.format(**PLACEHOLDERS), re.I if "Long}" in template else 0)) for seq, mut, coding, name, template in rows]


def _amino(s: str | None) -> str:
    return "" if not s else "".join(AMINO[x.lower()] for x in re.findall(_LONG, s, re.I))


def parsed_variant(mut: str, seqtype: str, coding: bool, g: dict[str, str | None]) -> tuple | None:
    """(mut, seqtype, start, end, old, new, offset) of the groups of a match; None for no change and for chemical symbols."""
    get = lambda *names: next((g[n] for n in names if g.get(n)), "") or ""
    old = (get("origAaShort", "origAasShort") or _amino(get("origAaLong", "origAasLong")) or get("origDna", "origDnas")).upper()
    new = (get("mutAaShort", "mutAasShort") or _amino(get("mutAaLong", "mutAasLong")) or get("mutDna") or (get("dna", "dnas") if mut in ("ins", "dup") else "")).upper()
    if mut == "del" and not old:
        old = get("dna", "dnas").upper()
    if mut == "dbSnp":
        return mut, seqtype, 0, 0, f"rs{get('rsId')}", "", 0
    start = int(get("fromPos", "pos") or 0)
    if not start:
        return None
    end = int(get("toPos")) + 1 if get("toPos") else start + max(1, len(old)) if mut == "del" else start + 1
    offset = 0 if coding else int(get("offset") or 0) * (-1 if get("plusMinus") == "-" else 1)
    if mut == "sub" and (old == new or seqtype == "protein" and start < 80 and (old == "H" and new in "ACDE" or old == "C" and new == "H")):
        return None
    return mut, seqtype, start, end, old, new, offset


def find_variants(text: str, patterns: list[tuple[str, str, bool, str, re.Pattern]]) -> Iterator[tuple]:
    """(start, end, pattern, mut, seqtype, place, to, old, new, offset); a place is read by the first pattern that fits."""
    taken: list[tuple[int, int]] = []
    for seqtype, mut, coding, name, pattern in patterns:
        for m in pattern.finditer(text):
            a, b = m.start() + (not m[0][0].isalnum()), m.end()
            if any(a < e and s < b for s, e in taken):
                continue
            if got := parsed_variant(mut, seqtype, coding, m.groupdict()):
                taken.append((a, b))
                yield a, b, name, *got


def variant_tagger(rows: list[tuple[str, str, bool, str, str]] = TEMPLATES, name: str = "variant-templates") -> Tagger:
    """A tagger of variants by a table of templates."""
    patterns = variant_patterns(rows)
    return register_tagger(Tagger(name, ["start", "end", "pattern", "mut", "seqtype", "place", "to", "old", "new", "offset"], lambda text: find_variants(text, patterns), cap=1000))


def normal_form(df: DataFrame) -> DataFrame:
    """`df` of variants with `variant`, its written form: all mentions of one form are one variant."""
    p = F.when(F.col("seqtype") == "protein", "p.").otherwise("c.")
    place = F.concat(F.col("start").cast("string"), F.when(F.col("offset") > 0, F.concat(F.lit("+"), F.col("offset").cast("string"))).when(F.col("offset") < 0, F.col("offset").cast("string")).otherwise(""))
    span = F.when(F.col("end") > F.col("start") + 1, F.concat(place, F.lit("_"), (F.col("end") - 1).cast("string"))).otherwise(place)
    form = F.when(F.col("mut") == "dbSnp", F.col("old")).when((F.col("mut") == "sub") & (F.col("seqtype") == "protein"), F.concat(p, "old", place, "new")).when(F.col("mut").isin("sub", "splicing"), F.concat(p, place, "old", F.lit(">"), "new"))
    return df.withColumn("variant", form.otherwise(F.concat(p, span, "mut", F.when(F.col("mut") == "del", F.col("old")).otherwise(F.col("new")))))


def grounded(variants: DataFrame, doc_genes: DataFrame, transcripts: DataFrame, id_col: str = "doc_id", insertions: bool = False) -> DataFrame:
    """Variants with each transcript (gene, protid, protein, transid, transcript, cds) of the document's genes that fits.

    `cds` is the 0-based start of the coding sequence in the transcript.  Non-coding transcripts (NR_) never fit; an insertion
    that names no old letters fits all of them if `insertions`, else none.
    """
    j = variants.join(doc_genes.select(id_col, "gene").distinct(), id_col).join(transcripts, "gene").where(~F.col("transid").startswith("NR_"))
    seq = F.when(F.col("seqtype") == "protein", F.col("protein")).otherwise(F.substring(F.col("transcript"), F.col("cds") + 1, F.length("transcript")))
    held = F.upper(F.substring(seq, F.col("start"), F.col("end") - F.col("start"))) == F.upper("old")
    fits = F.when((F.col("mut") == "ins") & (F.col("old") == ""), F.lit(insertions)).otherwise(held & (F.col("end") - 1 <= F.length(seq)))
    return j.where((F.col("mut") != "dbSnp") & fits & ((F.col("seqtype") == "protein") | (F.col("cds") >= 0)))


def coding_changes(ground: DataFrame) -> DataFrame:
    """Grounded variants with cstart, cold, cnew (1-based place in the coding sequence) and rstart, 0-based in the transcript.

    A changed amino acid gives one row for each change of one base that explains it; a deleted one, its whole codons.
    """
    keep = [c for c in ground.columns if c not in ("protein", "transcript")]
    schema = ground.select(*keep).schema.add("cstart", "long").add("cold", "string").add("cnew", "string").add("rstart", "long")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.to_dict("records"):
                head = tuple(r[c] for c in keep)
                if r["seqtype"] != "protein":
                    rows.append((*head, r["start"], r["old"], r["new"], r["cds"] + r["start"] - 1))
                    continue
                first = 3 * (r["start"] - 1)
                dna = r["transcript"][r["cds"] + first : r["cds"] + first + 3 * max(1, len(r["old"]))].upper()
                changes = [(0, dna, "")] if r["mut"] == "del" else single_changes(r["old"], r["new"], dna) if r["mut"] == "sub" and len(dna) == 3 and r["new"] in set(AMINO.values()) - {"X"} else []
                rows.extend((*head, first + at + 1, old, new, r["cds"] + first + at) for at, old, new in changes)
            yield pd.DataFrame(rows, columns=[f.name for f in schema])

    return ground.mapInPandas(run, schema)


def genome_places(changes: DataFrame, blocks: DataFrame) -> DataFrame:
    """Changes with chrom, gstart, gend through alignment blocks (transid, chrom, strand, qstart, tstart, size).

    Blocks are in transcript order; on the minus strand the genome runs down within a block.  A change over a border of blocks
    gives one row for each of them; the offset of splice variants is added.
    """
    width = F.greatest(F.length("cold"), F.lit(1))
    j = changes.join(blocks, "transid").where((F.col("rstart") < F.col("qstart") + F.col("size")) & (F.col("qstart") < F.col("rstart") + width))
    low, high = F.greatest("rstart", "qstart") - F.col("qstart"), F.least(F.col("rstart") + width, F.col("qstart") + F.col("size")) - F.col("qstart")
    plus = F.col("strand") == "+"
    start = F.when(plus, F.col("tstart") + low + F.col("offset")).otherwise(F.col("tstart") + F.col("size") - high - F.col("offset"))
    return j.withColumn("gstart", start).withColumn("gend", start + high - low).drop("qstart", "tstart", "size")


def with_snp_ids(places: DataFrame, snps: DataFrame) -> DataFrame:
    """Places with rsid from snps (chrom, gstart, gend, rsid), 'na' where none has exactly these coordinates."""
    one = snps.groupBy("chrom", "gstart", "gend").agg(F.min("rsid").alias("rsid"))
    return places.join(one, ["chrom", "gstart", "gend"], "left").withColumn("rsid", F.coalesce("rsid", F.lit("na")))


def nearest_gene(variants: DataFrame, mentions: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, variant, gene): the gene mentioned nearest to any mention of a variant, by the nearer of starts and ends.

    Places of both are swept once in order, so no pairs of mentions are made: the nearest start before or behind a start, and
    the nearest end before or behind an end.
    """
    from corvina.operators.intervals import nearest

    best = None
    for side in ("start", "end"):
        v = variants.select(F.concat_ws("\x1f", F.col(id_col).cast("string"), F.lit("")).alias("_k"), F.col(side).cast("long").alias("pos"), F.xxhash64(id_col, "variant", side).alias("_v"), id_col, "variant")
        g = mentions.select(F.concat_ws("\x1f", F.col(id_col).cast("string"), F.lit("")).alias("_k"), F.col(side).cast("long").alias("pos"), F.xxhash64("gene").alias("id"), "gene")
        names = g.select("id", "gene").distinct()
        got = nearest(v.select("_k", "pos", "_v"), g.select("_k", "pos", "id"), "_k", "_v").where("nearest is not null").join(v.select("_v", id_col, "variant").distinct(), "_v").join(names, F.col("nearest") == F.col("id")).select(id_col, "variant", "gene", "distance")
        best = got if best is None else best.unionByName(got)
    return best.groupBy(id_col, "variant").agg(F.min_by("gene", F.struct("distance", "gene")).alias("gene"))
