"""Queries that do the whole job, on tables where a cut would show."""

import hashlib

from corvina.plans import registry

QUERIES = registry.queries()


def _table(spark, tmp_path, name, rows, cols):
    spark.createDataFrame(rows, cols).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def _md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def test_greek_letters_after_the_fortieth_character(spark, tmp_path):
    d = _table(spark, tmp_path, "documents", [(1, "x" * 50 + "αβγδµ"), (2, None)], "doc_id long, text string")
    assert {r["doc_id"]: r["latin"] for r in QUERIES["greek_to_latin"](spark, d).collect()} == {1: _md5("x" * 50 + "abgdm"), 2: None}


def test_sequences_with_the_same_beginning(spark, tmp_path):
    d = _table(spark, tmp_path, "orders", [(1, "O", 123456.7), (2, "O", 123499.0), (3, "O", 123456.1)], "o_orderkey long, o_orderstatus string, o_totalprice double")
    got = {r["seq"]: (r["id"], r["n"]) for r in QUERIES["sequence_dedupe"](spark, d).collect()}
    assert got == {_md5("O123456"): (1, 2), _md5("O123499"): (2, 1)}


def test_all_kinds_of_identifiers(spark, tmp_path):
    from corvina.operators.annotators import IDENTIFIERS

    said = {"snp": "rs123456", "omim": "OMIM 123456", "ec": "EC 1.2.3.4", "genbank": "GenBank U12345", "refseq": "NM_123456.1", "ensembl": "ENSG00000123456", "uniprot": "UniProt P12345", "pdb": "PDB 1ABC", "geo": "GSE1234", "arrayexpress": "E-MTAB-12", "band": "p 17q21.3", "hgvs": "c.35delG", "interpro": "IPR001234", "go": "GO:0001234", "kegg": "hsa00010", "coord": "chr7:1,000-2,000", "sra": "SRR123456"}
    many = " ".join(f"GSE{n}" for n in range(10, 700))
    d = _table(spark, tmp_path, "files", [(i, x) for i, x in enumerate(said.values())] + [(100, many)], "fileid long, content string")
    got = QUERIES["identifiers"](spark, d).collect()
    assert [(i, k) for i, k in enumerate(said) if k not in {r["kind"] for r in got if r["fileid"] == i}] == []
    assert set(said) == {k for k, _, _ in IDENTIFIERS}
    assert sum(r["fileid"] == 100 and r["kind"] == "geo" for r in got) == 690


def test_nested_phrases_against_brute_force(spark, tmp_path):
    import random
    import re

    from corvina.plans.text_queries import _LEX

    rng = random.Random(4)
    texts = [(i, " ".join(rng.choice("forced expiratory volume fasting glucose tumour body mass index the".split()) for _ in range(60))) for i in range(40)]
    texts.append((99, "Fasting glucose, glucose; forced expiratory volume, tumour volume, volume"))
    d = _table(spark, tmp_path, "documents", texts, "doc_id long, text string")
    lex = {tuple(p.split()): k for p, k in _LEX}
    want = set()
    for i, text in texts:
        ws, at = re.findall("[a-z0-9_]+", text.lower()), 0
        while at < len(ws):
            n = len(next((p for n in (3, 2, 1) if (p := tuple(ws[at : at + n])) in lex), ()))
            if n:
                want.add((i, at, n, lex[tuple(ws[at : at + n])]))
            at += n or 1
    assert {k for *_, k in want} >= {"P1", "P2", "P3", "P7", "P8"}
    assert {tuple(r) for r in QUERIES["phrase_join"](spark, d).collect()} == want


def test_index_of_all_rows_of_all_groups(spark, tmp_path):
    d = _table(spark, tmp_path, "lineitem", [(1, 2, k) for k in (9, 5, 7, 6, 8)] + [(1, 3, 4)], "l_suppkey long, l_partkey long, l_orderkey long")
    assert {tuple(map(str, r)) for r in QUERIES["grouped_index"](spark, d).collect()} == {("1", "2", "5", "[5, 6, 7, 8, 9]"), ("1", "3", "1", "[4]")}


def test_cascade_reaches_articles_of_all_sources(spark, tmp_path):
    cols = ["doi", "printissn", "eissn", "vol", "issue", "page", "authors", "pubyear", "title"]
    place = dict(printissn="1234-5678", vol="3", issue="2", page="77")
    said = [(1, dict(doi="10.1/a")), (2, dict(doi="10.1/A ")), (3, place), (4, dict(place, doi="10.1/own")), (3000000001, dict(doi="10.1/z"))]
    d = _table(spark, tmp_path, "articles", [(i, *[x.get(c) for c in cols]) for i, x in said], "articleid long, " + ", ".join(f"{c} string" for c in cols))
    got = {r["articleid"]: (r["target"], r["matched_by"]) for r in QUERIES["fingerprint_cascade"](spark, d).collect()}
    assert got == {1: (2, "doi"), 2: (1, "doi"), 3: (4, "place"), 4: (3, "place"), 3000000001: (None, None)}
