"""Text classification: word features as sparse vectors, linear classifiers, exports."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvina.functions.text import ascii_words, good_word


def word_features(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, words): the distinct good words of each text."""
    return docs.select(id_col, F.filter(F.array_distinct(ascii_words(F.coalesce(F.col(text), F.lit("")))), good_word).alias("words"))


def train(labelled: DataFrame, features: int = 5000, min_docs: int = 3, rounds: int = 20) -> PipelineModel:
    """Linear support vector machine over binary word vectors of (words, label 0/1)."""
    return Pipeline(stages=[CountVectorizer(inputCol="words", outputCol="vector", vocabSize=features, minDF=float(min_docs), binary=True), LinearSVC(featuresCol="vector", labelCol="label", maxIter=rounds, regParam=0.01)]).fit(labelled)


def classify(model: PipelineModel, docs: DataFrame, id_col: str) -> DataFrame:
    return model.transform(docs).select(id_col, F.col("prediction").cast("int").alias("label"))


def svmlight(docs: DataFrame, best: DataFrame, id_col: str, label: str) -> DataFrame:
    """(id, line): `+1 1:1 7:1` with indices by rank of the best words (word, rank from 2); index 1 means any of them."""
    hits = docs.select(id_col, label, F.explode_outer("words").alias("word")).join(best, "word", "left").where("rank is not null")
    parts = hits.groupBy(id_col).agg(F.array_join(F.transform(F.sort_array(F.collect_set("rank")), lambda r: F.concat(r.cast("string"), F.lit(":1"))), " ").alias("x"))
    sign = F.when(F.col(label) > 0, "+1").otherwise("-1")
    return docs.join(parts, id_col, "left").select(id_col, F.when(F.col("x").isNull(), sign).otherwise(F.concat(sign, F.lit(" 1:1 "), F.col("x"))).alias("line"))


def best_words(chi: DataFrame, n: int) -> DataFrame:
    """(word, rank from 2) of the n words of greatest chi-square."""
    top = chi.orderBy(F.desc("chisq"), "w").limit(n)
    return top.select(F.col("w").alias("word"), (F.row_number().over(Window.orderBy(F.desc("chisq"), "w")) + 1).alias("rank"))
