"""Datasets of a corpus by name, their chunks and unions; CSV, database tables, blocks of rows, lexicons, UniProt entries."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvina.sources.article_xml import all_of, own_text, tree
from corvina.sources.tables import clean_names


@dataclass
class Corpus:
    """Datasets in folders below a base folder, each with `articles` and `files` partitioned by update."""

    spark: SparkSession
    base: str

    def resolve(self, names: str) -> list[str]:
        """Folders of a comma list of dataset names or paths; a name below the base folder comes first, what is not there raises."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        out = []
        for name in filter(None, (n.strip() for n in names.split(","))):
            options = [f"{self.base.rstrip('/')}/{name}", name]
            found = next((o for o in options if path(o).getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path(o))), None)
            if found is None:
                raise FileNotFoundError(f"no dataset {name}: looked for {options}")
            out.append(found)
        return out

    def read(self, names: str, kind: str = "articles", updates: list[int] | None = None) -> DataFrame:
        """Rows of several datasets with `dataset`; only the given updates where there are any."""
        parts = [self.spark.read.parquet(f"{folder}/{kind}").withColumn("dataset", F.lit(folder.rstrip("/").rsplit("/", 1)[-1])) for folder in self.resolve(names)]
        if not parts:
            raise ValueError("no dataset named")
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return rows if updates is None else rows.where(F.col("updateid").isin(updates))

    def chunks(self, names: str, kind: str = "articles") -> DataFrame:
        """(dataset, file) of the files that the datasets' rows lie in."""
        return self.read(names, kind).select("dataset", F.input_file_name().alias("file")).distinct()


def read_csv(spark: SparkSession, path: str | list[str], header: list[str] | None = None) -> DataFrame:
    """A CSV table of strings with clean column names."""
    df = spark.read.option("header", header is None).option("quote", '"').option("escape", '"').csv(path)
    return df.toDF(*clean_names(header or df.columns))


def read_sql(spark: SparkSession, url: str, table: str, key: str | None = None, low: int = 0, high: int = 0, parts: int = 8, **options: str) -> DataFrame:
    """A database table; with a numeric key it is read in parts.  The driver of the database must be on the class path."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    return (r.option("partitionColumn", key).option("lowerBound", low).option("upperBound", high).option("numPartitions", parts) if key else r).load()


def blocks(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row a key with the array of its rows, in order."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*order, *[c for c in rest if c not in order]))).alias("rows"))


def lexicon(lines: DataFrame, lower: bool = False) -> DataFrame:
    """(phrase, id) of lines `id<tab>name1|name2`, or of lines that are a name and its own id."""
    cells = F.split("value", "\t")
    names = F.when(F.size(cells) > 1, F.split(cells[1], r"\|")).otherwise(F.array("value"))
    got = lines.where("value <> ''").select(F.explode(names).alias("phrase"), cells[0].alias("id")).where("phrase <> ''")
    return got.withColumn("phrase", F.lower("phrase")) if lower else got


_ENTRY = T.StructType([T.StructField(f, T.StringType()) for f in "acc allAccs name symbol taxon sequence pmids".split()])
_FEATURE = T.StructType([T.StructField(f, T.StringType()) for f in "acc type begin end original variation description snpId pmids".split()])


def _entries(b: pd.DataFrame, xml: str) -> Iterator:
    for x in b[xml]:
        root = tree(x)
        if root is not None:
            yield from [root] if root.tag == "entry" else root.iter("entry")


def protein_entries(df: DataFrame, xml: str = "content", taxa: list[str] | None = None) -> DataFrame:
    """(acc, allAccs, name, symbol, taxon, sequence, pmids) of the entries of protein XML; only of some taxa where given."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for e in _entries(b, xml):
                accs = [a.text or "" for a in e.findall("accession")]
                taxon = next((r.get("id", "") for r in all_of(e, "organism/dbReference", type="NCBI Taxonomy")), "")
                if accs and (taxa is None or taxon in taxa):
                    pmids = [r.get("id", "") for r in all_of(e, "reference/citation/dbReference", type="PubMed")]
                    rows.append((accs[0], "|".join(accs), own_text(e, "protein/recommendedName/fullName"), own_text(e, "gene/name", type="primary"), taxon, "".join(own_text(e, "sequence").split()), "|".join(dict.fromkeys(pmids))))
            yield pd.DataFrame(rows, columns=_ENTRY.names)

    return df.select(xml).mapInPandas(run, _ENTRY)


def protein_features(df: DataFrame, xml: str = "content", types: tuple[str, ...] = ("sequence variant", "mutagenesis site")) -> DataFrame:
    """(acc, type, begin, end, original, variation, description, snpId, pmids) of features; the last rs id of a description counts."""
    import re

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for e in _entries(b, xml):
                evidence = {x.get("key", ""): next((r.get("id", "") for r in all_of(x, "source/dbReference", type="PubMed")), "") for x in e.findall("evidence")}
                for f in e.findall("feature"):
                    if f.get("type") not in types:
                        continue
                    place = f.find("location")
                    one = next((p.get("position", "") for p in all_of(place, "position")), "")
                    ends = [next((p.get("position", "") for p in all_of(place, side)), one) for side in ("begin", "end")]
                    text = f.get("description", "")
                    pmids = [p for k in f.get("evidence", "").split() if (p := evidence.get(k))]
                    rows.append((own_text(e, "accession"), f.get("type"), *ends, own_text(f, "original"), own_text(f, "variation"), text, (re.findall(r"rs\d+", text) or [""])[-1], "|".join(dict.fromkeys(pmids))))
            yield pd.DataFrame(rows, columns=_FEATURE.names)

    return df.select(xml).mapInPandas(run, _FEATURE)


def feature_description(text: str, diseases: dict[str, str]) -> tuple[str, str, str, str]:
    """(disease code, name, rs id, comments) of a feature description `in CODE; rs id; other`."""
    import re

    code = name = snp = ""
    rest = []
    for part in filter(None, (p.strip().rstrip(".") for p in text.split("; "))):
        rs = re.search(r"rs\d+", part)
        said = re.match(r"in (.+)", part)
        if rs:
            snp = rs[0]
        elif said and (codes := [c for c in re.split(r", | and ", said[1]) if c in diseases]):
            code, name = ",".join(codes), ",".join(diseases[c] for c in codes)
        else:
            rest.append(part)
    return code, name, snp, "; ".join(rest)
