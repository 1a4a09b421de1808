"""Nucleotide and protein sequence functions as native column expressions."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

_BASES = "TCAG"
_AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
#: the standard genetic code, by rule: bases in the order TCAG, the last changing fastest
CODONS = dict(zip(map("".join, product(_BASES, repeat=3)), _AMINO, strict=True))


def reverse_complement(seq: Column) -> Column:
    return F.translate(F.reverse(seq), "ACGTacgt", "TGCAtgca")


def translated(dna: Column) -> Column:
    """Amino acids of whole codons; unknown codons are X, '' for less than one codon."""
    table = F.create_map(*[F.lit(x) for kv in CODONS.items() for x in kv])
    n = F.floor(F.length(dna) / 3).cast("int")
    codons = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.upper(F.substring(dna, i * 3 + 1, 3)))
    return F.when(n > 0, F.array_join(F.transform(codons, lambda c: F.coalesce(F.try_element_at(table, c), F.lit("X"))), "")).otherwise(F.lit(""))


def back_translated(amino: str) -> list[str]:
    """All codings of an amino acid string."""
    return ["".join(p) for p in product(*[[c for c, a in CODONS.items() if a == x] for x in amino])]


def single_changes(old: str, new: str, dna: str) -> list[tuple[int, str, str]]:
    """(position, old base, new base) of one-base changes of `dna`, coding `old`, that make it code `new`."""
    return sorted({(i, a, b) for c in back_translated(new) for i, (a, b) in enumerate(zip(dna, c, strict=True)) if a != b and sum(x != y for x, y in zip(dna, c, strict=True)) == 1})


def without_poly_a(seq: Column) -> Column:
    """Without a trailing run of six or more A."""
    return F.regexp_replace(seq, "[aA]{6,}$", "")


def old_versions(accession: str) -> list[str]:
    """Accessions of the earlier versions."""
    base, _, version = accession.partition(".")
    return [f"{base}.{v}" for v in range(1, int(version or 1))]


def hgvs(kind: str, seq_id: str, old: str, pos: int, new: str) -> str:
    return f"{seq_id}:{kind}.{pos}{old}>{new}" if kind in "cgr" else f"{seq_id}:{kind}.{old}{pos}{new}"


def accession_range(first: str, last: str, most: int = 20) -> list[str]:
    """Accessions from first to last of one prefix and width; only the ends if the range is not clear."""
    import re

    a, b = (re.fullmatch(r"([A-Z]+)(\d+)", x) for x in (first, last))
    if not a or not b or a[1] != b[1] or len(a[2]) != len(b[2]) or not 0 <= int(b[2]) - int(a[2]) <= most:
        return [first, last]
    return [f"{a[1]}{n:0{len(a[2])}d}" for n in range(int(a[2]), int(b[2]) + 1)]
