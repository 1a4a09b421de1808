"""Grade the reading level of documents by vocabulary coverage rank and sentence complexity.

Words are counted over the whole corpus for each language (told from function words, since the lang column may be wrong) and
ranked by frequency: a word's rank is one more than the number of words that are more frequent.  A document's coverage rank is the size of the smallest frequency-ranked vocabulary that covers a fixed
share of its words, here 50, 75 and 90 %; words per sentence and letters per word are its complexity.  Each measure is made
comparable between languages by its mean and deviation over all documents of the language, and grades are calibrated in
SQL: a normal density for each grade and measure from the human labels, fitted again without the labels the first fit
contradicts (raters are sometimes off by one).

The `VOCABULARY` commonest words of each language are held in memory.  Documents of which they do not cover the largest share
give their other words to a join with the whole ranking, so the coverage rank is exact for every document and any language.
Null or empty texts have no words: they get the commonest grade.  Without any labels the result is empty.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvina.session import staged

#: words of each language whose ranks are held in memory
VOCABULARY = 20_000
SHARES = (0.5, 0.75, 0.9)
#: function words that tell languages apart; fixed values
FUNCTION_WORDS = {
    "en": "the of and to in is was with for that by were you it are from not",
    "de": "der die das und ist nicht mit von den ein eine zu auf im dem wurde sich",
    "fr": "le les et des est un une dans pour que du au qui par ont sur avec",
    "es": "el los las y es un una con por para que del se al su fue como",
}
_VOTES: dict[str, str] = {}
for _l, _ws in FUNCTION_WORDS.items():
    for _w in _ws.split():
        _VOTES[_w] = "" if _w in _VOTES else _l
_VOTES = {w: k for w, k in _VOTES.items() if k}
_WORDS = re.compile(r"[^\W\d_]+")
_ENDS = re.compile(r"[.!?]+(?=\s|$|[\"”»])|\n\n")
MEASURES = [f"cover{int(100 * s)}" for s in SHARES] + ["sentence", "letters"]


def language_of(words: list[str]) -> str:
    """The language most of whose function words the text has, '' without any."""
    votes = Counter(_VOTES[w] for w in words if w in _VOTES)
    return max(votes, key=lambda k: (votes[k], k)) if votes else ""


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, Counter] = defaultdict(Counter)

    def flush() -> pd.DataFrame:
        rows = [(k, w, n) for k, c in counts.items() for w, n in c.items()]
        counts.clear()
        return pd.DataFrame(rows, columns=["language", "word", "n"])

    for b in batches:
        for text in b["text"]:
            ws = _WORDS.findall((text or "").lower())
            counts[language_of(ws)].update(ws)
        if sum(map(len, counts.values())) > 200_000:
            yield flush()
    yield flush()


def measure(text: str | None, ranks: dict[str, dict[str, int]]) -> tuple:
    """(language, words, log coverage ranks.., words per sentence, letters per word, words beyond the ranks) of a text.

    A coverage rank that the ranks do not reach is null, and the words beyond them are given, once for each use."""
    text = text or ""
    ws = _WORDS.findall(text.lower())
    lang = language_of(ws)
    if not ws:
        return (lang, 0, *[0.0] * len(MEASURES), None)
    table = ranks.get(lang, {})
    r = sorted(table[w] for w in ws if w in table)
    places = [max(0, math.ceil(s * len(ws)) - 1) for s in SHARES]
    cover = [math.log1p(r[p]) if p < len(r) else None for p in places]
    beyond = [w for w in ws if w not in table] if None in cover else None
    return (lang, len(ws), *cover, math.log1p(len(ws) / max(1, len(_ENDS.findall(text)))), sum(map(len, ws)) / len(ws), beyond)


def _measures(ranks: dict[str, dict[str, int]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, *measure(t, ranks)) for i, t in zip(b["doc_id"], b["text"], strict=True)]
            yield pd.DataFrame(rows, columns=["doc_id", "language", "words", *MEASURES, "beyond"])

    return run


def _ranks(counted: DataFrame, lang: str) -> dict[str, int]:
    """Ranks of the VOCABULARY commonest words of a language, and of all that are as frequent as the last of them or none."""
    top = counted.where(F.col("language") == lang).orderBy(F.desc("n"), "word").limit(VOCABULARY).select("word", "n").collect()
    out: dict[str, int] = {}
    rank, before = 1, None
    for k, (w, n) in enumerate(top, 1):
        if n != before:
            rank, before = k, n
        out[w] = rank
    return out


def document_measures(documents: DataFrame) -> DataFrame:
    """(doc_id, language, words, measures) of each document."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = staged(docs.select("text").mapInPandas(_count, "language string, word string, n long").groupBy("language", "word").agg(F.sum("n").alias("n")), "level-words")
    ranks = {lang: _ranks(counted, lang) for lang in ("", *FUNCTION_WORDS)}
    schema = "doc_id long, language string, words long, " + ", ".join(f"{m} double" for m in MEASURES) + ", beyond array<string>"
    got = staged(docs.mapInPandas(_measures(ranks), schema), "level-measured")
    # ranks of all words, from the number of words of each count
    heights = counted.groupBy("language", "n").agg(F.count("*").alias("many"))
    heights = heights.withColumn("rank", 1 + F.coalesce(F.sum("many").over(Window.partitionBy("language").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rare = got.where("beyond is not null").select("doc_id", "language", "words", F.size("beyond").alias("missing"), F.explode("beyond").alias("word")).groupBy("doc_id", "language", "words", "missing", "word").agg(F.count("*").alias("times"))
    rare = rare.join(counted, ["language", "word"]).join(heights.select("language", "n", "rank"), ["language", "n"])
    # a document's own words only
    upto = rare.withColumn("upto", F.col("words") - F.col("missing") + F.sum("times").over(Window.partitionBy("doc_id", "words", "missing").orderBy("rank", "word")))
    found = upto.groupBy("doc_id").agg(*[F.min(F.when(F.col("upto") >= F.greatest(F.lit(1), F.ceil(F.lit(s) * F.col("words"))), F.log1p("rank"))).alias(f"far_{m}") for s, m in zip(SHARES, MEASURES, strict=False)])
    far = {m: F.coalesce(m, f"far_{m}").alias(m) for m in MEASURES[: len(SHARES)]}
    return got.drop("beyond").join(found, "doc_id", "left").select("doc_id", "language", "words", *[far.get(m, F.col(m)) for m in MEASURES])


def graded(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, grade, margin) by normal densities calibrated on (doc_id, grade) labels."""
    norm = measured.where("words > 0").groupBy("language").agg(*[f(m).alias(f"{m}_{k}") for m in MEASURES for k, f in (("mean", F.avg), ("dev", F.stddev_pop))])
    # five rows at most: one a language
    z = staged(measured.join(F.broadcast(norm), "language").select("doc_id", "language", "words", *[((F.col(m) - F.col(m + "_mean")) / F.greatest(F.col(m + "_dev"), F.lit(1e-6))).alias(m) for m in MEASURES]).where("words > 0"), "level-z")
    said = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("grade").cast("int").alias("grade")).where("grade is not null").join(z, "doc_id")
    said = staged(said, "level-said")

    def fit(rows: DataFrame) -> DataFrame:
        by = rows.groupBy("language", "grade").agg(F.count("*").alias("n"), *[F.avg(m).alias(f"{m}_m") for m in MEASURES], *[F.var_pop(m).alias(f"{m}_v") for m in MEASURES])
        whole = rows.groupBy("grade").agg(F.count("*").alias("all_n"), *[F.avg(m).alias(f"{m}_am") for m in MEASURES], *[F.var_pop(m).alias(f"{m}_av") for m in MEASURES])
        languages = z.select("language").distinct()
        got = whole.crossJoin(languages).join(by, ["language", "grade"], "left")  # languages x grades, twenty rows at most
        own = F.coalesce(F.col("n"), F.lit(0)) >= 12
        return got.select("language", "grade", "all_n", *[F.when(own, F.col(f"{m}_m")).otherwise(F.col(f"{m}_am")).alias(f"{m}_m") for m in MEASURES], *[F.greatest(F.when(own, F.col(f"{m}_v")).otherwise(F.col(f"{m}_av")), F.lit(0.01)).alias(f"{m}_v") for m in MEASURES])

    def score(rows: DataFrame, model: DataFrame) -> DataFrame:
        like = sum(-0.5 * F.log(f"{m}_v") - (F.col(m) - F.col(f"{m}_m")) ** 2 / (2 * F.col(f"{m}_v")) for m in MEASURES)
        return rows.select("doc_id", "language", *MEASURES).join(F.broadcast(model), "language").select("doc_id", "grade", like.alias("fit")).groupBy("doc_id").agg(F.max_by("grade", F.struct(F.round("fit", 9), "grade")).alias("grade"))

    model = staged(fit(said), "level-model")
    for _ in range(2):
        first = score(said.select("doc_id", "language", *MEASURES).dropDuplicates(["doc_id"]), model).withColumnRenamed("grade", "fitted")
        model = staged(fit(said.join(first, "doc_id").where("grade = fitted")), "level-model")
    out = score(z, model)
    common = said.groupBy("grade").agg(F.count("*").alias("n")).agg(F.max_by("grade", F.struct("n", "grade")).alias("grade"))
    empty = measured.where("words = 0").select("doc_id").crossJoin(F.broadcast(common)).where("grade is not null")  # one row
    return out.unionByName(empty).select("doc_id", F.col("grade").cast("int").alias("grade")).distinct()


def reading_levels(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of every document."""
    return graded(staged(document_measures(documents), "level-measures"), labels)
