"""Protein sequences and the Markov models behind them."""

from pyspark.sql import functions as F

from corvina.operators import proteins as pr


def test_markov():
    m = pr.Markov("m", ["ACACACCCACACACACCACACTGTG"], letters="ACTG")
    assert abs(m.score("TTTTT") - 0.1632879780810205) < 1e-12 and abs(m.score("ACACAC") - 1.5307253382591655) < 1e-12
    m = pr.Markov("m", ["ABAABAABAABAABA"], 3, "AB")
    assert abs(m.score("ABA") - 0.325422400434628) < 1e-12


def test_classifier():
    fg, bg = pr.Markov("moreAC", ["ACACACCCACACACACCACACTGTG"], letters="ACTG"), pr.Markov("moreCG", ["CGCGCGCGCGCGCGCGCGCGCG"], letters="ACTG")
    c = pr.Classifier(0.9, [fg], [bg], None)
    assert [c(s) for s in ("ACTGACTGACTGACT", "CGCGCGCGGCGCC", "ACTGACTGCCGATATACTGACT")] == [("pos", "moreAC"), ("neg", "moreCG"), ("unsure", "moreAC")]
    assert pr.Classifier(0.9, [fg], [bg], 0.8)("CGCGCGCGGCGCC") == ("neg", "dna")


def always(seq):
    return "pos", "model"


def test_proteins():
    got = list(pr.find_proteins("  N A F T K A T P L S T Q V Q L S M C A D V P L V V E Y A ", always))
    assert got == [(2, 57, "NAFTKATPLSTQVQLSMCADVPLVVEYA", 28, "Y", "Y", "Y", "isPep", "model")]
    got = list(pr.find_proteins("  5 10 15 20 Ala-Val-Thr-Lys-Gly-Thrlle-Asn-Asp-Pro-Gln-Ala-Ala-Lys-Glu-Ala-Leu-Asp-Lys-Tyr. ", always))
    assert got == [(40, 91, "NDPQAAKEALDKY", 13, "Y", "Y", "Y", "isPep", "model")]
    assert list(pr.find_proteins("plain words of a text", always)) == [] and list(pr.find_proteins("", always)) == []
    assert list(pr.find_proteins("MKVLAWYRE " * 1 + "end of it. " + ("MKVLAWYRE, and then more; " * 6), always)) == []
    assert pr.letter_changes("AAAAAAAA") == 0 and abs(pr.letter_changes("ACACACACACAC") - 11 / 12) < 1e-9


def test_scores_by_joins(spark):
    m = pr.Markov("m", ["ACACACCCACACACACCACACTGTG"], letters="ACTG")
    counts = pr.run_counts(spark.createDataFrame([("ACACACCCACACACACCACACTGTG",)], "s string"), "s")
    got = {r["s"]: r["m"] for r in pr.pair_scores(spark.createDataFrame([("TTTTT",), ("ACACAC",)], "s string"), "s", {"m": counts}).collect()}
    assert all(abs(got[s] - m.score(s)) < 1e-9 for s in got)
    spans = spark.createDataFrame([(1, "A")] * 6 + [(1, "B")], "fileid int, seq string")
    assert [r["seq"] for r in pr.often_used(spans).select(F.col("seq")).collect()] == ["B"]
