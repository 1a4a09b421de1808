"""Variants: templates, parsing, grounding and mapping on a made transcript."""

from corvina.operators import variants as va


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_templates():
    found = [x[3:] for x in va.find_variants(" c.76A>T and c.88+2T>G; c.5_7delACT, c.9dupG c.3_4insTT p.V600E Val12Glu rs12345 (H20A) p.V5V", va.variant_patterns(va.TEMPLATES))]
    assert set(found) == {("sub", "dna", 76, 77, "A", "T", 0), ("splicing", "dna", 88, 89, "T", "G", 2), ("del", "dna", 5, 8, "ACT", "", 0), ("dup", "dna", 9, 10, "", "G", 0), ("ins", "dna", 3, 5, "", "TT", 0), ("sub", "protein", 600, 601, "V", "E", 0), ("sub", "protein", 12, 13, "V", "E", 0), ("dbSnp", "dbSnp", 0, 0, "rs12345", "", 0)}
    assert list(va.find_variants("", va.variant_patterns(va.TEMPLATES))) == []


SCHEMA = "doc_id long, mut string, seqtype string, start int, end int, old string, new string, offset int"


def test_forms(spark):
    d = spark.createDataFrame([(1, "sub", "protein", 600, 601, "V", "E", 0), (1, "sub", "dna", 76, 77, "A", "T", 0), (1, "splicing", "dna", 88, 89, "T", "G", -2), (1, "del", "dna", 5, 8, "ACT", "", 0), (1, "dbSnp", "dbSnp", 0, 0, "rs5", "", 0)], SCHEMA)
    assert {r["variant"] for r in va.normal_form(d).collect()} == {"p.V600E", "c.76A>T", "c.88-2T>G", "c.5_7delACT", "rs5"}


def test_grounding(spark):
    # two bases before the coding sequence ATG GTA GGC: M V G
    trans = spark.createDataFrame([("g1", "P1", "MVG", "NM_1", "CCATGGTAGGC", 2), ("g1", "P2", "MLG", "NM_2", "ATGCTAGGC", 0), ("g1", "P3", "MVG", "NR_3", "ATGGTAGGC", 0)], "gene string, protid string, protein string, transid string, transcript string, cds int")
    v = spark.createDataFrame([(1, "sub", "protein", 2, 3, "V", "I", 0), (1, "sub", "dna", 4, 5, "G", "A", 0), (1, "sub", "protein", 3, 4, "V", "I", 0), (1, "ins", "dna", 4, 5, "", "T", 0), (2, "sub", "protein", 2, 3, "V", "I", 0), (1, "sub", "protein", 30, 31, "V", "I", 0)], SCHEMA)
    genes = spark.createDataFrame([(1, "g1"), (1, "g1"), (3, "g1")], "doc_id long, gene string")
    g = va.grounded(v, genes, trans)
    assert rows(g.select("seqtype", "start", "transid")) == [("dna", 4, "NM_1"), ("protein", 2, "NM_1")]
    assert va.grounded(v.where("mut = 'ins'"), genes, trans, insertions=True).count() == 2
    c = va.coding_changes(g)
    assert rows(c.select("seqtype", "cstart", "cold", "cnew", "rstart")) == [("dna", 4, "G", "A", 5), ("protein", 4, "G", "A", 5)]
    blocks = spark.createDataFrame([("NM_1", "chr1", "+", 0, 100, 4), ("NM_1", "chr1", "+", 4, 200, 7)], "transid string, chrom string, strand string, qstart long, tstart long, size long")
    p = va.genome_places(c, blocks)
    assert rows(p.select("chrom", "gstart", "gend")) == [("chr1", 201, 202)] * 2
    minus = spark.createDataFrame([("NM_1", "chr1", "-", 0, 200, 11)], blocks.schema)
    assert rows(va.genome_places(c, minus).select("gstart", "gend").distinct()) == [(205, 206)]
    snps = spark.createDataFrame([("chr1", 201, 202, "rs9")], "chrom string, gstart long, gend long, rsid string")
    assert {r["rsid"] for r in va.with_snp_ids(p, snps).collect()} == {"rs9"} and {r["rsid"] for r in va.with_snp_ids(p, snps.limit(0)).collect()} == {"na"}


def test_nearest_gene(spark):
    v = spark.createDataFrame([(1, "p.V2I", 100, 105), (1, "p.V2I", 500, 505), (2, "c.1A>T", 5, 9)], "doc_id long, variant string, start int, end int")
    m = spark.createDataFrame([(1, "g1", 10, 14), (1, "g2", 520, 530), (3, "g3", 1, 2)], "doc_id long, gene string, start int, end int")
    assert rows(va.nearest_gene(v, m)) == [(1, "p.V2I", "g2")]
