"""Incremental processing: ledgers of updates, loads of new files only, file streams that run until they have caught up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def next_update(ledger: DataFrame, first_article: int) -> tuple[int, int]:
    """Next update id and next article id after all in the ledger (updateId, lastArticleId)."""
    r = ledger.agg(F.max("updateId"), F.max("lastArticleId")).first()
    return (0, first_article) if r is None or r[0] is None else (r[0] + 1, r[1] + 1)


def unprocessed(available: DataFrame, done: DataFrame, key: str = "updateId") -> DataFrame:
    return available.select(key).distinct().join(done.select(key), key, "left_anti")


def check_loaded(loaded: DataFrame, on_disk: DataFrame) -> DataFrame:
    """Files not yet loaded; a loaded file whose size has changed raises when the result is read.  Both: (fname, size)."""
    j = on_disk.join(loaded.withColumnRenamed("size", "_size"), "fname", "left")
    bad = F.col("_size").isNotNull() & (F.col("_size") != F.col("size"))
    checked = F.when(bad, F.raise_error(F.concat(F.lit("size changed: "), F.col("fname"))).cast("long")).otherwise(F.col("size"))
    return j.select("fname", checked.alias("size"), "_size").where(F.col("_size").isNull() & F.col("size").isNotNull()).drop("_size")


def catch_up(spark: SparkSession, source: str, schema: T.StructType, checkpoint: str, handle: Callable[[DataFrame, int], None], fmt: str = "parquet") -> None:
    """Give all files that are new since the last call to `handle(batch, batch_id)`; the checkpoint remembers them."""
    stream = spark.readStream.schema(schema).format(fmt).load(source)
    q = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def windowed_counts(events: DataFrame, time: str, keys: list[str], window: str, late: str) -> DataFrame:
    """Counts of a stream of events in time windows; rows later than the watermark are left out."""
    return events.withWatermark(time, late).groupBy(F.window(time, window), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def merge_fingerprints(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """(fingerprint, articleid, batch): the newest batch's article wins."""
    rows = new if old is None else old.unionByName(new)
    return rows.groupBy("fingerprint").agg(F.max_by("articleid", F.struct("batch", "articleid")).alias("articleid"), F.max("batch").alias("batch"))


def mark_step(spark: SparkSession, path: str, batch: str, step: str) -> None:
    """Append a finished step of a batch to its ledger."""
    spark.createDataFrame([(batch, step)], "batch string, step string").write.mode("append").parquet(path)


def first_incomplete(done: DataFrame, batches: DataFrame, steps: list[str]) -> tuple[str, list[str]] | None:
    """The least batch that lacks a step, and its missing steps in order; None when all are complete.

    One row a batch is read, of a ledger with one row a step.
    """
    has = done.groupBy("batch").agg(F.collect_set("step").alias("has"))
    r = batches.select("batch").distinct().join(has, "batch", "left").where(F.col("has").isNull() | (F.size(F.array_except(F.array(*[F.lit(s) for s in steps]), "has")) > 0)).orderBy("batch").first()
    return None if r is None else (r["batch"], [s for s in steps if s not in (r["has"] or [])])
