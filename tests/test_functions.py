from pyspark.sql import functions as F

from corvina.functions import ids, sequences, text
from corvina.operators import annotators as ann
from corvina.operators import sections as sec
from corvina.sources import tables


def one(spark, expr, **cols):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()]).select(expr.alias("x")).first()[0]


def test_split_annot_id(spark):
    r = one(spark, ids.split_annot_id(F.col("a")), a=200616640112350013)
    assert tuple(r) == (2006166401, 123, 50013)


def test_datasets(spark):
    got = spark.createDataFrame([(4300000011,), (2004499279,), (1000000000,), (4500000005,), (1,)], "a long").select(ids.dataset_of(F.col("a"))).collect()
    assert [r[0] for r in got] == ["imgt", "elsevier", "pmc", "yif", None]


def test_snippets():
    t = "cex XXX And"
    assert text.snippet_of(t, 4, 7, 5, 30) == "cex <<<XXX>>> And"
    t = "A sentence. Another sentence. XXX. And yes a sentence. Oh my. Oh my."
    x = t.find("X")
    assert text.snippet_of(t, x, x + 3, 5, 30) == "Another sentence. <<<XXX>>>. And yes a sentence."
    assert text.snippet_of(t, 0, 0) == ""


def test_spans_beyond_ascii(spark):
    r = one(spark, text.match_spans(F.col("t"), "[0-9]+"), t="ä1 😀 22 é333")
    assert [(x["start"], x["end"], x["hit"]) for x in r] == [(1, 2, "1"), (5, 7, "22"), (9, 12, "333")]
    assert one(spark, text.match_spans(F.col("t"), "[0-9]+"), t="none") == []


def test_words_and_sentences(spark):
    assert len(set(one(spark, text.words(F.col("t")), t="Red is my favorite. Blue-green are great. Red_blue not."))) == 10
    assert one(spark, text.sentences(F.col("t")), t="See Fig. 2 here. Then e.g. this. End") == ["See Fig. 2 here.", "Then e.g. this.", "End"]


def test_bigrams(spark):
    assert one(spark, text.bigrams(text.ascii_words(F.col("t"))), t="a b c") == ["a b", "b c"]
    assert one(spark, text.bigrams(text.ascii_words(F.col("t"))), t="") == []


def test_sequences(spark):
    assert one(spark, sequences.reverse_complement(F.col("s")), s="AACGt") == "aCGTT"
    assert one(spark, sequences.translated(F.col("s")), s="ATGGTATAAC") == "MV*"
    assert one(spark, sequences.without_poly_a(F.col("s")), s="CGCGAGCG" + "A" * 17) == "CGCGAGCG"
    assert one(spark, sequences.without_poly_a(F.col("s")), s="CGAAAAA") == "CGAAAAA"
    assert sequences.single_changes("V", "I", "GTA") == [(0, "G", "A")]
    assert sequences.old_versions("NM_000325.5") == ["NM_000325.1", "NM_000325.2", "NM_000325.3", "NM_000325.4"]
    assert sequences.accession_range("JN011487", "JN011488") == ["JN011487", "JN011488"]


def test_trie_matches():
    trie = ann.build_trie([("how are you", "p3"), ("how are", "p2"), ("guinea pig", "g"), ("guinea pig", "h")])
    assert ann.match_trie("how   are  you doing?", trie) == [(0, 14, "p3")]
    assert ann.match_trie("a Guinea-pig!", trie) == [(2, 12, "g,h")]
    assert ann.match_trie("so how are they", trie, flank=1) == [(3, 10, "p2", ["so"], ["they"])]


def test_variants_and_dna():
    assert [x[3] for x in ann.find_variants("p.Val600Glu, c.76A>T and rs12345; p.Val5Val")] == ["p.V600E", "c.76A>T", "rs12345"]
    assert [x[2] for x in ann.find_nucleotides("primer ACGTACGTAC GTACGTTTAG was used")] == ["ACGTACGTACGTACGTTTAG"]


def test_neighbouring_primers_and_mixed_words():
    found = lambda t: [x[:2] + (x[2], x[3], x[4]) for x in ann.find_nucleotides(t)]
    assert found("test test caccatgacacactgacacatgtgtactgtg") == [(10, 41, "caccatgacacactgacacatgtgtactgtg", 1, False)]
    assert found("test test tga tga cac atg tgt act gtg a")[0][2] == "tgatgacacatgtgtactgtga"
    assert found("bla bla actg ttt tcactybaactbacbatactbatcgactgactgactgtactcctacgatgcgtactacttacghhh")[0][2:] == ("actgttttcactaactacatactatcgactgactgactgtactcctacgatgcgtactacttacg", 3, True)
    assert found("bla bla TCTATCAATGGACAAATGGGTG TCCAGGCTCATCCATGTT bla bla") == [(8, 30, "TCTATCAATGGACAAATGGGTG", 1, False)]
    assert [ann.without_site(x) for x in ("CCCGGG", "AAAACCCGGGAAAA", "ACTACTCCCGGGC", "CGCCCGGGACTACT")] == ["", "AAAACCCGGGAAAA", "ACTACT", "ACTACT"]


def test_sections_by_headers():
    text = "some text\nIntroduction\nResults\n\nNothing\nAcknowledgements\nReferences\nRef text"
    assert sec.header_sections(text, 1) == [(0, 10, "header"), (10, 23, "intro"), (23, 40, "results"), (40, 57, "ack"), (57, 76, "refs")]
    text = "hihihi sflkjdf\n Results and Discussion\nbla bla results results results bla\nI. Methods\n123. Bibliography\n haha ahahah ahah test test\n"
    assert sec.header_sections(text, 5) == [(0, 15, "header"), (15, 75, "results"), (75, 86, "methods"), (86, 132, "refs")]
    text = "headers\nIntroduction\nResults\n***** Discussion *****\nbla bla bla bla bla blab bla bla\n"
    assert sec.header_sections(text, 1) == [(0, 8, "header"), (8, 21, "intro"), (21, 29, "results"), (29, 85, "discussion")]
    assert sec.header_sections("no header at all") is None
    assert sec.apart([("a", 1000), ("b", 2000), ("c", 2007), ("d", 2100)], 200) == [("a", 1000)]
    assert sec.apart([("a", 1), ("b", 2), ("c", 3000)], 200, ("b",)) == [("b", 2), ("c", 3000)]


def test_references_by_names():
    text = " " * 53 + "some test text\nmore test text\nreferences\nhaussler brian raney mueller a great paper\nsome more text"
    start, end = sec.reference_section(text, {"references", "haussler", "brian", "raney", "mueller"}, 5)
    assert text[start:end] == "references\nhaussler brian raney mueller a great paper"
    assert sec.reference_section("haussler " + "x " * 50, {"haussler"}, 5) is None and sec.reference_section("", {"x"}) is None
    assert sec.line_break("hi there \nis no linebreak", 3, 20) == 9 and sec.line_break("hi there \nis no linebreak", 3, 2) == 3
    got = sec.cut_in([(0, 915, "header"), (915, 10526, "abstract"), (10526, 15783, "results"), (15783, 16968, "notes")], 10000, 14000, "refs")
    assert got == [(0, 915, "header"), (915, 10000, "abstract"), (10000, 14000, "refs"), (14000, 15783, "results"), (15783, 16968, "notes")]
    assert sec.split_sections("x") == [(0, 1, "probablyAbstract")] and sec.split_sections("x" * 5000, "supp")[0][2] == "supplement" and sec.split_sections("x" * 5000)[0][2] == "unknown"


def test_ranges_and_acronyms():
    assert sec.trim_range(1, 30, "t", 5, 15) == [(1, 5, "t"), (15, 30, "t")]
    assert sec.trim_range(1, 4, "t", 5, 15) == [(1, 4, "t")]
    assert sec.trim_range(6, 9, "t", 5, 15) == []
    assert ann.acronyms("the minor allele frequency (MAF) was") == {"MAF": "minor allele frequency"}


def test_spans_of_many_matches(spark):
    import re

    from pyspark.sql import functions as F

    from corvina.functions.text import match_spans

    texts = [None, "", "none", "a1b22c333", "1" * 3, "é1é2", "x " + "12 ab " * 2000, "7"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", match_spans(F.col("t"), "[0-9]+").alias("s")).collect()
    for r in got:
        t = texts[r["i"]]
        assert (r["s"] is None) if t is None else [tuple(x) for x in r["s"]] == [(m.start(), m.end(), m[0]) for m in re.finditer("[0-9]+", t)]


def test_names_and_markup():
    assert tables.clean_names(["#a b", "", "1x", "a_b"]) == ["a_b", "noName_1", "n1x", "a_b_2"]
    assert tables.xml_text("<a><title>T</title><p>x<b>y</b></p></a>") == "T\nxy"
    assert tables.xml_text("<a>", True) is None and tables.xml_text("<a>x</a>", True) is None
    h = tables.html_article("<html><head><title>t</title><meta name='citation_doi' content='doi:10.1234/x'></head><body><p>A &amp; B</p><script>x</script></body></html>")
    assert h["doi"] == "10.1234/x" and h["title"] == "t" and h["text"] == "A & B"
