"""Annotations within sentences: co-occurrence of several lexicons, fusions, modified residues, prioritised keywords."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvina.functions.text import sentences
from corvina.operators.genes import phrase_spans

#: words that tell of a fusion; residues by their names and short forms; fixed values
FUSION_TRIGGERS = "fusion fused fuse chimeric chimera translocation rearrangement rearranged".split()
RESIDUES = {"ser": "S", "serine": "S", "s": "S", "thr": "T", "threonine": "T", "t": "T", "tyr": "Y", "tyrosine": "Y", "y": "Y"}


def sentence_rows(docs: DataFrame, id_col: str, text: str, most_chars: int | None = None) -> DataFrame:
    """(id, no, sentence); documents longer than `most_chars` are left out where it is given."""
    if most_chars is not None:
        docs = docs.where(F.length(text) <= most_chars)
    return docs.select(id_col, F.posexplode(sentences(F.col(text))).alias("no", "sentence"))


def cooccurrences(docs: DataFrame, lexicons: dict[str, DataFrame], id_col: str, text: str, longest: int = 4, most: int = 10, every: bool = True) -> DataFrame:
    """(id, no, sentence, one array of ids a lexicon) of sentences in which every lexicon hits, each up to `most` times.

    With every=False one lexicon suffices.  Each lexicon (phrase, id) may be of any size.
    """
    said = sentence_rows(docs, id_col, text).withColumn("_s", F.concat_ws(":", F.col(id_col).cast("string"), F.col("no").cast("string")))
    found = None
    for name, lexicon in lexicons.items():
        hits = phrase_spans(said, lexicon, "_s", "sentence", longest).select("_s", F.lit(name).alias("lexicon"), "start", "phraseid")
        found = hits if found is None else found.unionByName(hits)
    many = found.groupBy("_s", "lexicon").agg(F.count("*").alias("n"), F.sort_array(F.collect_set("phraseid")).alias("ids")).where(F.col("n") <= most)
    wide = many.groupBy("_s").agg(F.count("*").alias("kinds"), *[F.first(F.when(F.col("lexicon") == name, F.col("ids")), ignorenulls=True).alias(name) for name in lexicons])
    wide = wide.where(F.col("kinds") == len(lexicons)) if every else wide
    return said.join(wide, "_s").select(id_col, "no", "sentence", *lexicons)


def fusions(docs: DataFrame, symbols: DataFrame, id_col: str, text: str, per_sentence: int = 10, per_doc: int = 100) -> DataFrame:
    """(id, no, gene1, gene2, hit) of two symbols (phrase, id) joined by - / or : in a sentence with a trigger word.

    Symbols that are equal or differ in their last character only are no fusion; sentences and documents with too many hits
    are lists and give none.
    """
    from corvina.functions.values import too_similar

    said = sentence_rows(docs, id_col, text).where(F.lower("sentence").rlike("|".join(FUSION_TRIGGERS)))
    pair = F.regexp_extract_all("sentence", F.lit(r"\b[A-Z][A-Z0-9]+[-/:][A-Z][A-Z0-9]+\b"), F.lit(0))
    hits = said.select(id_col, "no", F.explode(pair).alias("hit")).select(id_col, "no", "hit", *[F.regexp_extract("hit", "^(.*?)[-/:](.*)$", k).alias(f"s{k}") for k in (1, 2)])
    lex = symbols.select("phrase", F.col("id").alias("gene")).distinct()
    for k in (1, 2):
        hits = hits.join(lex.select(F.col("phrase").alias(f"s{k}"), F.col("gene").alias(f"gene{k}")), f"s{k}")
    hits = hits.where((F.col("gene1") != F.col("gene2")) & ~too_similar(F.col("s1"), F.col("s2")))
    hits = hits.withColumn("_s", F.count("*").over(Window.partitionBy(id_col, "no"))).where(F.col("_s") <= per_sentence).withColumn("_d", F.count("*").over(Window.partitionBy(id_col))).where(F.col("_d") <= per_doc)
    return hits.select(id_col, "no", "gene1", "gene2", "hit")


def modified_residues(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, no, residue, position) of phosphorylation sites in sentences that tell of phosphorylation."""
    pattern = r"(?i)\b(?:ser(?:ine)?|thr(?:eonine)?|tyr(?:osine)?|[STY])[- ]?[0-9]{1,4}\b"
    said = sentence_rows(docs, id_col, text).where(F.lower("sentence").contains("phospho"))
    hits = said.select(id_col, "no", F.explode(F.regexp_extract_all("sentence", F.lit(pattern), F.lit(0))).alias("hit"))
    names = F.create_map(*[F.lit(x) for kv in RESIDUES.items() for x in kv])
    return hits.select(id_col, "no", names[F.lower(F.regexp_extract("hit", "^[A-Za-z]+", 0))].alias("residue"), F.regexp_extract("hit", "[0-9]+$", 0).cast("int").alias("position"))


def spelling_variants(name: Column) -> Column:
    """A name with blanks, with dashes and without either."""
    return F.array_distinct(F.array(name, F.replace(name, F.lit(" "), F.lit("-")), F.replace(name, F.lit("-"), F.lit(" ")), F.regexp_replace(name, "[ -]", "")))


def names_with_triggers(docs: DataFrame, names: DataFrame, id_col: str, text: str, triggers: list[str], longest: int = 3, cap: int = 150) -> DataFrame:
    """(id, start, end, phraseid) of names (phrase, id) in any spelling with blanks or dashes, in documents with a trigger word."""
    lex = names.select(F.explode(spelling_variants(F.col("phrase"))).alias("phrase"), "id")
    hits = phrase_spans(docs.where(F.lower(text).rlike("|".join(triggers))), lex, id_col, text, longest).drop("left", "right")
    return hits.withColumn("_n", F.count("*").over(Window.partitionBy(id_col))).where(F.col("_n") <= cap).drop("_n")


def first_field_with(df: DataFrame, fields: list[str], words: list[str]) -> DataFrame:
    """`df` with `field` and `word`: the first of the fields, in their order, that holds one of the words, the earliest in it."""
    best = []
    for f in fields:
        at = F.array(*[F.struct(F.locate(w, F.lower(f)).alias("at"), F.lit(f).alias("field"), F.lit(w).alias("word")) for w in words])
        best.append(F.array_min(F.filter(at, lambda x: x["at"] > 0)))
    got = F.coalesce(*best)
    return df.withColumn("_b", got).withColumn("field", F.col("_b.field")).withColumn("word", F.col("_b.word")).drop("_b")


def first_keyword(text: Column, groups: dict[str, list[str]]) -> Column:
    """Groups of which the text holds a keyword, each with its first keyword as listed: array<struct<group,word>>."""
    low = F.lower(text)
    hit = lambda words: F.coalesce(*[F.when(low.contains(w), F.lit(w)) for w in words])
    return F.filter(F.array(*[F.struct(F.lit(g).alias("group"), hit(ws).alias("word")) for g, ws in groups.items()]), lambda x: x["word"].isNotNull())
