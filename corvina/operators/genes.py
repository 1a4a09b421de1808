"""Genes of documents from names, symbols and accession numbers, as joins of spans with lexicons of any size.

Markers are spans of a document with a kind and an id: gene names, symbols (`symbol`, or `symbolMaybe` where a doubtful one has
no trigger word beside it) and accession numbers.  Names come first, symbols that overlap them go.  Accession numbers are
resolved to genes by a table; a symbol of several genes goes to those that most other kinds of markers support; a doubtful
symbol whose gene has other support counts as sure.  Genes are kept by support and ranked by evidence.

Null texts have no markers; repeated lexicon rows count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvina.operators.annotators import longest_phrases
from corvina.operators.intervals import overlap_join

#: words beside a doubtful symbol that make it a symbol; fixed values
LEFT_TRIGGERS = "gene genes protein proteins mutated mutation mutations mutant expression express expressing expressed encoding encodes allele locus promoter transcript".split()
RIGHT_TRIGGERS = "gene genes protein proteins mutation mutations mutant mutants expression overexpression overexpressed is expressed transcript mrna allele locus promoter knockout".split()
#: evidence of a kind of marker: symbols count by their hits; fixed values
EVIDENCE = {"geneName": 5, "dnaSeq": 15, "symbolMaybe": 0}
OTHER_EVIDENCE = 10
#: a symbol needs more hits than the words of its document by this, a doubtful one more than that; fixed values
WORDS_A_HIT, DOUBTFUL_HITS = 1200, 10


def phrase_spans(docs: DataFrame, lexicon: DataFrame, id_col: str, text: str, longest: int, lower: bool = True, flank: int = 0) -> DataFrame:
    """(id, start, end, phraseid, left, right) of the longest phrases of a lexicon (phrase, id); several ids are joined by /."""
    return longest_phrases(docs, lexicon, id_col, text, longest, lower, flank).drop("pos", "n")


def gene_names(docs: DataFrame, names: DataFrame, symbols: DataFrame, id_col: str = "doc_id", text: str = "text", longest: int = 8) -> DataFrame:
    """(id, kind, marker, start, end) of gene names (phrase, id) and of symbols (phrase, id, doubtful)."""
    long = phrase_spans(docs, names, id_col, text, longest).select(id_col, F.lit("geneName").alias("kind"), F.col("phraseid").alias("marker"), "start", "end")
    marked = symbols.select("phrase", F.concat(F.when(F.col("doubtful"), "?").otherwise(""), F.col("id").cast("string")).alias("id"))
    short = phrase_spans(docs, marked, id_col, text, 2, lower=False, flank=2)
    beside = lambda c, words: F.arrays_overlap(F.transform(c, F.lower), F.array(*[F.lit(w) for w in words]))
    doubtful = F.col("phraseid").contains("?")
    trigger = beside(F.col("left"), LEFT_TRIGGERS) | beside(F.col("right"), RIGHT_TRIGGERS)
    pathway = (F.lower(F.try_element_at("left", F.lit(-1))) == "pathway") | (F.lower(F.try_element_at("right", F.lit(1))) == "pathway")
    short = short.where(doubtful | ~F.coalesce(pathway, F.lit(False)))
    short = short.select(id_col, F.when(~doubtful | F.coalesce(trigger, F.lit(False)), "symbol").otherwise("symbolMaybe").alias("kind"), F.replace("phraseid", F.lit("?"), F.lit("")).alias("marker"), "start", "end")
    return long.unionByName(overlap_join(short, long.select(id_col, "start", "end"), id_col, 64, "left_anti"))


def marker_genes(markers: DataFrame, accessions: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, kind, marker, gene, hits) of markers resolved by accessions (kind, acc, gene); names and symbols carry their genes."""
    counted = markers.groupBy(id_col, "kind", "marker").agg(F.count("*").alias("hits"))
    own = F.col("kind").isin("geneName", "symbol", "symbolMaybe", "entrez")
    carried = counted.where(own).select(id_col, "kind", "marker", F.explode(F.split("marker", "/")).alias("gene"), "hits")
    # versions and letter case of sequence records do not matter
    acc = F.when(F.col("kind").isin("refseq", "refprot", "genbank", "pdb"), F.upper(F.substring_index("marker", ".", 1))).otherwise(F.col("marker"))
    table = accessions.select("kind", "acc", F.col("gene").cast("string").alias("gene")).distinct()
    return carried.unionByName(counted.where(~own).withColumn("acc", acc).join(table, ["kind", "acc"]).select(id_col, "kind", "marker", "gene", "hits"))


def resolved_genes(markers: DataFrame, accessions: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, gene, kind, marker, hits) with symbols of several genes decided and supported doubtful symbols made sure."""
    genes = marker_genes(markers, accessions, id_col)
    symbol = F.col("kind").isin("symbol", "symbolMaybe")
    others = genes.where(~symbol)
    support = others.select(id_col, "gene", "kind").distinct().groupBy(id_col, "gene").agg(F.count("*").alias("support"))
    one = Window.partitionBy(id_col, "kind", "marker")
    of = genes.where(symbol).join(support, [id_col, "gene"], "left").withColumn("support", F.coalesce("support", F.lit(0))).withColumn("all", F.count("*").over(one)).withColumn("most", F.max("support").over(one)).where("support = most").withColumn("best", F.count("*").over(one))
    # an ambiguous symbol is sure if one gene is left, doubtful if several are; a doubtful one with other support is sure
    kind = F.when((F.col("all") > 1) & (F.col("best") > 1), "symbolMaybe").when(F.col("all") > 1, "symbol").otherwise(F.col("kind"))
    decided = of.select(id_col, "gene", kind.alias("kind"), "marker", "hits", "support")
    sure = decided.where("kind = 'symbol'").select(id_col, "gene").distinct().withColumn("said", F.lit(1))
    decided = decided.join(sure, [id_col, "gene"], "left").withColumn("kind", F.when((F.col("support") > 0) | F.col("said").isNotNull(), "symbol").otherwise(F.col("kind")))
    decided = decided.groupBy(id_col, "gene", "kind").agg(F.min("marker").alias("marker"), F.sum("hits").alias("hits"))
    return others.where("kind <> 'band'").select(id_col, "gene", "kind", "marker", "hits").unionByName(decided.select(id_col, "gene", "kind", "marker", "hits"))


def supported_genes(genes: DataFrame, docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Genes with evidence enough: other markers than symbols, or symbols that are frequent for the length of the text."""
    words = docs.select(id_col, F.floor(F.size(F.split(F.trim(text), r"\s+")) / WORDS_A_HIT).alias("least"))
    enough = ~F.col("kind").isin("symbol", "symbolMaybe") | ((F.col("kind") == "symbol") & (F.col("hits") > F.col("least"))) | ((F.col("kind") == "symbolMaybe") & (F.col("hits") > DOUBTFUL_HITS))
    return genes.join(words, id_col).where(enough).drop("least")


def ranked_genes(genes: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, gene, score, place): the sum of the evidence of a gene's kinds of markers; ties share a place."""
    score = F.when(F.col("kind") == "symbol", F.col("hits"))
    for kind, points in EVIDENCE.items():
        score = score.when(F.col("kind") == kind, F.lit(points))
    kinds = genes.groupBy(id_col, "gene", "kind").agg(F.sum("hits").alias("hits")).withColumn("score", score.otherwise(F.lit(OTHER_EVIDENCE)).cast("long"))
    total = kinds.groupBy(id_col, "gene").agg(F.sum("score").alias("score"))
    return total.withColumn("place", F.rank().over(Window.partitionBy(id_col).orderBy(F.desc("score"))).cast("long"))


def word_members(docs: DataFrame, lexicon: DataFrame, id_col: str, text: str, least: int = 2, cap: int = 150, needs: list[str] | None = None) -> DataFrame:
    """(id, gene, hits) of genes of which a document holds at least `least` words of a lexicon (word, gene).

    Only documents that hold one of `needs` are read; one with more than `cap` hits gives none.
    """
    if needs:
        docs = docs.where(F.lower(text).rlike("|".join(needs)))
    words = docs.select(id_col, F.explode(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9_.-]*[a-z0-9]"), F.lit(0))).alias("word"))
    hits = words.join(lexicon.select(F.lower("word").alias("word"), "gene").distinct(), "word").groupBy(id_col, "gene").agg(F.count("*").alias("hits"))
    return hits.withColumn("_all", F.sum("hits").over(Window.partitionBy(id_col))).where((F.col("_all") <= cap) & (F.col("hits") >= least)).drop("_all")


def pair_benchmark(found: DataFrame, right: DataFrame) -> DataFrame:
    """One row tp, fp, fn, precision, recall, f over distinct rows of both tables."""
    cols = right.columns
    j = found.select(*cols).distinct().withColumn("f", F.lit(1)).join(right.distinct().withColumn("r", F.lit(1)), cols, "full")
    n = j.agg(F.count_if(F.col("f").isNotNull() & F.col("r").isNotNull()).alias("tp"), F.count_if(F.col("r").isNull()).alias("fp"), F.count_if(F.col("f").isNull()).alias("fn"))
    share = lambda a, b: F.when(a + b == 0, 0.0).otherwise(a / (a + b))
    p, r = share(F.col("tp"), F.col("fp")), share(F.col("tp"), F.col("fn"))
    return n.select("*", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(F.when(p + r == 0, 0.0).otherwise(2 * p * r / (p + r)), 6).alias("f"))
