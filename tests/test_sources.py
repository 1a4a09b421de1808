"""Corpus folders, lexicons, protein entries, row functions, ledgers and statements."""

import sys

import pytest

from corvina.operators import rows as ro
from corvina.sources import corpus, writers
from corvina.streaming import incremental


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_corpus_names(spark, tmp_path):
    spark.createDataFrame([(1, 0)], "articleid long, updateid int").write.parquet(f"{tmp_path}/a/articles")
    c = corpus.Corpus(spark, str(tmp_path))
    assert c.resolve(f"a,{tmp_path}/a") == [f"{tmp_path}/a"] * 2
    with pytest.raises(FileNotFoundError):
        c.resolve("missing")
    assert c.read("a,a").count() == 2 and c.read("a", updates=[5]).count() == 0 and c.chunks("a").count() == 1


def test_lexicon(spark):
    d = spark.createDataFrame([("g1\tOne|one more",), ("single",), ("",)], "value string")
    assert rows(corpus.lexicon(d, lower=True)) == [("one", "g1"), ("one more", "g1"), ("single", "single")]


def test_protein_entries(spark):
    xml = '<uniprot xmlns="http://u"><entry><accession>P1</accession><accession>P2</accession><protein><recommendedName><fullName>Alpha</fullName></recommendedName></protein><gene><name type="primary">ALP</name></gene><organism><dbReference type="NCBI Taxonomy" id="9606"/></organism><reference><citation><dbReference type="PubMed" id="77"/></citation></reference><evidence key="1"><source><dbReference type="PubMed" id="78"/></source></evidence><feature type="mutagenesis site" evidence="1" description="rs1, rs2"><location><begin position="3"/><end position="5"/></location></feature><sequence>MA\nVG</sequence></entry></uniprot>'
    d = spark.createDataFrame([(xml,), (None,), ("bad",)], "content string")
    assert rows(corpus.protein_entries(d)) == [("P1", "P1|P2", "Alpha", "ALP", "9606", "MAVG", "77")]
    assert corpus.protein_entries(d, taxa=["1"]).count() == 0
    assert rows(corpus.protein_features(d).select("acc", "begin", "end", "snpId", "pmids")) == [("P1", "3", "5", "rs2", "78")]
    assert corpus.feature_description("in ABC and XYZ; dbSNP:rs12; may be mild", {"ABC": "A disease"}) == ("ABC", "A disease", "rs12", "may be mild")


def test_rows_and_programs(spark):
    with pytest.raises(ValueError):
        ro.Preferences(only_main=True, only_meta=True)
    with pytest.raises(ValueError):
        ro.Preferences(prefer_pdf=True, prefer_xml=True)
    d = spark.createDataFrame([(1, "a\nb"), (2, None)], "i int, t string")
    assert rows(ro.piped(d, ["cat"], "t", ["i"], ["x", "y"])) == [(1, "a b", ""), (2, "", "")]
    assert rows(ro.process_rows(d, lambda r: r if r["t"] else None, "i int", finish=lambda rs: rs + rs)) == [(1,), (1,)]
    with pytest.raises(Exception, match="gave 0 lines"):
        ro.piped(d, [sys.executable, "-c", "pass"], "t", ["i"], ["x"]).collect()


def test_ledger_of_steps(spark, tmp_path):
    at = str(tmp_path / "ledger")
    for b, s in (("b1", "map"), ("b1", "load"), ("b2", "map")):
        incremental.mark_step(spark, at, b, s)
    batches = spark.createDataFrame([("b1",), ("b2",), ("b3",)], "batch string")
    assert incremental.first_incomplete(spark.read.parquet(at), batches, ["map", "load"]) == ("b2", ["load"])
    assert incremental.first_incomplete(spark.read.parquet(at), batches.where("batch = 'b1'"), ["map", "load"]) is None


def test_statements(spark):
    schema = spark.createDataFrame([], "id long, name string, score double").schema
    assert writers.create_statement("t", schema, key="id", index=["name"]) == ["CREATE TABLE t (id INTEGER, name TEXT, score REAL, PRIMARY KEY (id))", "CREATE INDEX t_name ON t (name)"]
    assert "name VARCHAR(255)" in writers.create_statement("t", schema, "mysql", index=["name"])[0]
