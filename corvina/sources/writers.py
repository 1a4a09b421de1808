"""Sinks: corpus chunks, annotation parts, sequences, KV tables, table generations."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvina.functions.text import escaped


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` with the schema's columns in order: unknown ones raise, missing ones are ''."""
    if extra := set(df.columns) - {f.name for f in schema}:
        raise ValueError(f"unknown columns: {sorted(extra)}")
    return df.select(*[(F.coalesce(F.col(f.name).cast(f.dataType), F.lit("" if isinstance(f.dataType, T.StringType) else None).cast(f.dataType)) if f.name in df.columns else F.lit("" if isinstance(f.dataType, T.StringType) else None).cast(f.dataType)).alias(f.name) for f in schema])


def write_corpus(df: DataFrame, path: str, schema: T.StructType, by: list[str], mode: str = "append") -> None:
    """Corpus rows partitioned by dataset and update; text cells are kept to one line."""
    keep = [c for c in by if c not in schema.names]
    full = T.StructType([*schema.fields, *[df.schema[c] for c in keep]])
    out = conformed(df, full)
    if "content" in out.columns:
        out = out.withColumn("content", escaped(F.col("content")))
    out.write.mode(mode).partitionBy(*by).parquet(path)


def write_tsv(df: DataFrame, path: str, mode: str = "error", rows_per_file: int = 0, one_file: bool = False) -> None:
    """Tab-separated parts with a header each; cells are made one line."""
    cells = df.select(*[F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), "[\t\r\n]+", " ").alias(c) for c in df.columns])
    w = (cells.coalesce(1) if one_file else cells).write.mode(mode).option("header", True).option("sep", "\t").option("quote", "").option("compression", "gzip").option("emptyValue", "")
    (w.option("maxRecordsPerFile", rows_per_file) if rows_per_file else w).csv(path)


def write_by_type(df: DataFrame, path: str, kind: str = "outType") -> None:
    df.write.mode("overwrite").partitionBy(kind).parquet(path)


def write_fasta(df: DataFrame, path: str, ident: str, seq: str, cut: int = 50) -> None:
    """FASTA, short and long sequences in folders of their own."""
    rows = df.select(F.concat(F.lit(">"), F.col(ident).cast("string"), F.lit("\n"), F.col(seq)).alias("value"), F.when(F.length(seq) < cut, "short").otherwise("long").alias("size"))
    rows.write.mode("overwrite").partitionBy("size").text(path)


def upsert_kv(old: DataFrame | None, new: DataFrame, key: str = "key", value: str = "value", order: str = "ord") -> DataFrame:
    """Key-value table in which the last writer wins."""
    rows = new if old is None else old.unionByName(new)
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value), F.max(order).alias(order))


def switch_over(spark: SparkSession, names: list[str]) -> None:
    """Generations of tables: production becomes backup, development becomes production."""
    for n in names:
        spark.sql(f"drop table if exists {n}_bak")
        if spark.catalog.tableExists(n):
            spark.sql(f"alter table {n} rename to {n}_bak")
        spark.sql(f"alter table {n}_dev rename to {n}")


def mark_lines(row: dict) -> str:
    """A document as `|key: value` lines, empty values left out."""
    return "\n".join(f"|{k}: {str(v).replace(chr(7), chr(10))}" for k, v in sorted(row.items()) if v not in (None, ""))


def highlighted(text: str, spans: list[tuple[int, int]], tag: str = "mark") -> str:
    """Text with tags round its spans; spans inside an earlier one are skipped."""
    out, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            out += [text[at:a], f"<{tag}>", text[a:b], f"</{tag}>"]
            at = b
    return "".join([*out, text[at:]])


def send_batches(df: DataFrame, send, size: int = 10_000) -> None:
    """Hand rows to `send(list of dicts)` in batches, partition by partition (search index, service)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = 0
        for b in batches:
            rows = b.to_dict("records")
            for i in range(0, len(rows), size):
                send(rows[i : i + size])
                n += len(rows[i : i + size])
        yield pd.DataFrame({"n": [n]})

    df.mapInPandas(run, "n long").agg(F.sum("n")).collect()


def write_references(refs: DataFrame, articles: DataFrame, path: str, mode: str = "append") -> None:
    """Citations (articleid, ...) prefixed with the external id, doi and pmid of the article they stand in."""
    a = articles.select("articleid", F.col("externalid").alias("externalId"), F.col("doi").alias("artDoi"), F.col("pmid").alias("artPmid"))
    refs.join(a, "articleid").select("articleid", "externalId", "artDoi", "artPmid", *[c for c in refs.columns if c != "articleid"]).write.mode(mode).parquet(path)


def create_statement(table: str, schema: T.StructType, kind: str = "sqlite", key: str | None = None, index: list[str] | None = None) -> list[str]:
    """SQL that makes a table of a schema, and its indexes."""
    types = {"sqlite": ("INTEGER", "REAL", "TEXT"), "mysql": ("BIGINT", "DOUBLE", "TEXT")}[kind]
    of = lambda f: types[0] if isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType)) else types[1] if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else "VARCHAR(255)" if kind == "mysql" and f.name in (key, *(index or [])) else types[2]
    cols = [f"{f.name} {of(f)}" for f in schema] + ([f"PRIMARY KEY ({key})"] if key else [])
    return [f"CREATE TABLE {table} ({', '.join(cols)})", *[f"CREATE INDEX {table}_{c} ON {table} ({c})" for c in index or []]]


def add_chunks(df: DataFrame, table: str, done: DataFrame | None = None) -> DataFrame:
    """Rows of the files that are not in `done` (chunkid), with the name of their file as chunkid, appended to a table."""
    rows = df.withColumn("chunkid", F.element_at(F.split(F.input_file_name(), "/"), -1))
    new = rows if done is None else rows.join(done.select("chunkid").distinct(), "chunkid", "left_anti")
    new.write.mode("append").saveAsTable(table)
    return new


def labelled_texts(files: DataFrame, articles: DataFrame, positive: DataFrame) -> DataFrame:
    """(articleid, label, content) of main files: 'pos' for the pmids of a list, 'neg' for the others."""
    a = articles.groupBy("articleid").agg(F.max("pmid").alias("pmid")).join(positive.select("pmid", F.lit("pos").alias("label")).distinct(), "pmid", "left")
    main = files.where((F.coalesce("filetype", F.lit("")).isin("main", "")) & F.col("content").isNotNull())
    return main.join(a, "articleid").select("articleid", F.coalesce("label", F.lit("neg")).alias("label"), "content")
