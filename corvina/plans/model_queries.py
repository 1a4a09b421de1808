"""Queries that run user functions, classifiers and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvina.operators import classify
from corvina.plans import mapreduce
from corvina.plans.query import Registry, Tables
from corvina.session import shared_dir
from corvina.sources import tables
from corvina.streaming import incremental

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


@query("select coalesce(nullif(mimetype,''),'none') as mimetype, sum(length(content)) as chars from files where content is not null group by 1")
def map_reduce(t: Tables) -> DataFrame:
    job = mapreduce.MapReduce(lambda r: [(r["mimetype"] or "none", str(len(r["content"])))] if r["content"] is not None else [], lambda k, v: [(k, int(v))], "mimetype string, chars long", lambda a, b: str(int(a) + int(b)))
    return mapreduce.run(t.files.select("mimetype", "content"), job)


@query()
def classified(t: Tables) -> DataFrame:
    """Simple or demanding texts, by a linear classifier trained on the graded ones."""
    words = classify.word_features(t.documents, "doc_id", "text")
    labels = t.levellabels.groupBy("doc_id").agg(F.min("grade").alias("grade")).select("doc_id", (F.col("grade") > 2).cast("double").alias("label"))
    return classify.classify(classify.train(words.join(labels, "doc_id")), words, "doc_id")


@query("select event_type, count(*) as n from events group by event_type")
def stream_counts(t: Tables) -> DataFrame:
    """Counts of a file stream that has caught up, folded batch by batch."""
    at = f"{shared_dir(t.spark)}/corvina/stream-{uuid.uuid4().hex}"
    source = t.events

    def handle(batch: DataFrame, number: int) -> None:
        batch.groupBy("event_type").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{at}/out/batch={number}")

    incremental.catch_up(t.spark, f"{t.sf_dir}/events.parquet*", source.schema, f"{at}/checkpoint", handle)
    return t.spark.read.parquet(f"{at}/out").groupBy("event_type").agg(F.sum("n").alias("n"))


@query()
def html_texts(t: Tables) -> DataFrame:
    """Texts of files with HTML or XML in them; the mime type is not relied on."""
    marked = (F.col("mimetype") == "text/html") | F.col("content").rlike(r"(?i)</?(?:p|div|h[1-6]|ul|li|table|tr|td|sec|title|html|body)\b[^<>]*>")
    f = t.files.where(marked).select("fileid", F.translate("content", "\x07", "\n").alias("data"), F.lit("text/html").alias("mimeType"), F.col("locfname").alias("locFname"))
    return tables.to_text(f)


@query("select articleid, max(batch) as batch from (select articleid, updateid as batch from articles) group by articleid")
def merged_updates(t: Tables) -> DataFrame:
    rows = t.articles.select(F.col("articleid").cast("string").alias("fingerprint"), "articleid", F.col("updateid").alias("batch"))
    return incremental.merge_fingerprints(rows.where("batch < 40"), rows.where("batch >= 40")).select("articleid", "batch")
