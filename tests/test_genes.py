"""Gene finding on a small lexicon."""

from corvina.operators import annotators as ann
from corvina.operators import genes


def rows(df):
    return sorted(map(tuple, df.collect()))


def lexicon(spark):
    names = spark.createDataFrame([("thyroid hormone receptor, beta", "7068"), ("tumor protein p53", "7157")], "phrase string, id string")
    symbols = spark.createDataFrame([("FATE1", "89885", True), ("PITX2", "5308", False), ("TP53", "7157", False), ("ASM", "283120", True), ("ASM", "6609", True)], "phrase string, id string, doubtful boolean")
    accessions = spark.createDataFrame([("omim", "607608", "6609"), ("refseq", "NM_000546", "7157"), ("refseq", "NM_000325", "5308")], "kind string, acc string, gene string")
    return names, symbols, accessions


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_names_and_symbols(spark):
    names, symbols, _ = lexicon(spark)
    d = docs(spark, "thyroid hormone receptor, beta", "FATE1", "FATE1 is overexpressed", "fate1 is overexpressed", "PITX2 overexpression", "PITX2 pathway", None, "", "They call TP53 tumor protein p53.")
    got = rows(genes.gene_names(d, names, symbols))
    assert got == [(0, "geneName", "7068", 0, 30), (1, "symbolMaybe", "89885", 0, 5), (2, "symbol", "89885", 0, 5), (4, "symbol", "5308", 0, 5), (8, "geneName", "7157", 15, 32), (8, "symbol", "7157", 10, 14)]
    assert genes.gene_names(d.limit(0), names, symbols).count() == 0 and genes.gene_names(d, names.limit(0), symbols.limit(0)).count() == 0


def markers(spark, d):
    names, symbols, _ = lexicon(spark)
    ids = ann.identifier_spans(d, ["doc_id"], "text", kinds=["omim", "refseq"]).select("doc_id", "kind", ann.F.col("ident").alias("marker"), "start", "end")
    return genes.gene_names(d, names, symbols).unionByName(ids)


def test_ambiguous_symbols_are_resolved(spark):
    _, _, accessions = lexicon(spark)
    d = docs(spark, "  mutated ASM (OMIM:607608) ", " ASM ", "I don't like TP53 my dear")
    got = {tuple(r) for r in genes.resolved_genes(markers(spark, d), accessions).select("doc_id", "gene", "kind", "marker").collect()}
    assert got == {(0, "6609", "omim", "607608"), (0, "6609", "symbol", "283120/6609"), (1, "6609", "symbolMaybe", "283120/6609"), (1, "283120", "symbolMaybe", "283120/6609"), (2, "7157", "symbol", "7157")}


def test_ranks_and_support(spark):
    _, _, accessions = lexicon(spark)
    d = docs(spark, "Oh. TP53 ... They call it Tumor Protein p53 and NM_000546.2. It don't like it.", "PITX2 " + "word " * 2400)
    found = genes.resolved_genes(markers(spark, d), accessions)
    assert rows(genes.ranked_genes(found)) == [(0, "7157", 16, 1), (1, "5308", 1, 1)]
    assert {r["doc_id"] for r in genes.supported_genes(found, d).collect()} == {0}


def test_word_members(spark):
    lex = spark.createDataFrame([("unc-22", "G1"), ("UNC-22", "G1"), ("lin-4", "G2")], "word string, gene string")
    d = docs(spark, "C. elegans unc-22 and Unc-22, lin-4", "unc-22 unc-22", None)
    assert rows(genes.word_members(d, lex, "doc_id", "text", needs=["elegans", "nematode"])) == [(0, "G1", 2)]


def test_pair_benchmark(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "pmid long, gene string")
    b = spark.createDataFrame([(1, "x"), (3, "z")], "pmid long, gene string")
    assert rows(genes.pair_benchmark(a, b)) == [(1, 1, 1, 0.5, 0.5, 0.5)]
    assert rows(genes.pair_benchmark(a.limit(0), b.limit(0))) == [(0, 0, 0, 0.0, 0.0, 0.0)]


def test_large_lexicons_are_joined(spark, monkeypatch):
    monkeypatch.setattr(ann, "FIRST_WORDS", 0)
    test_names_and_symbols(spark)
    d = docs(spark, "one two three four two three")
    lex = spark.createDataFrame([("two three", "a"), ("two three", "b"), ("three four", "c"), ("", "d"), (None, "e")], "phrase string, id string")
    native = rows(ann.longest_phrases(d, lex, "doc_id", "text", 2, flank=1))
    monkeypatch.undo()
    assert native == rows(ann.longest_phrases(d, lex, "doc_id", "text", 2, flank=1)) == [(0, 1, 4, 13, 2, "a/b", ["one"], ["four"]), (0, 4, 19, 28, 2, "a/b", ["four"], [])]
