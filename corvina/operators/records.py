"""Record operators of the corpus: latest deliveries, preferences among files, linkage by fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str | list[str], order: str = "updateid") -> DataFrame:
    """One row a key: the one of the greatest `order`, ties by all columns; an aggregate, so a hot key is combined early."""
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order, *[c for c in rest if c != order])).alias("x")).select(*keys, "x.*")


def keep_main(files: DataFrame) -> DataFrame:
    return files.where(F.coalesce(F.col("filetype"), F.lit("")).isin("main", ""))


def keep_best_main(files: DataFrame, prefer: str = "xml") -> DataFrame:
    """Of each article's main files the first of the preferred kind, and all others that are not main."""
    kind = F.when(F.col("mimetype").isin("text/xml", "text/html"), F.lit("xml")).when(F.col("mimetype") == "application/pdf", F.lit("pdf")).otherwise(F.lit("other"))
    is_main = F.coalesce(F.col("filetype"), F.lit("")).isin("main", "")
    rank = F.when(kind == prefer, 0).when(kind == "other", 1).otherwise(2)
    w = Window.partitionBy("articleid", is_main).orderBy(rank, "fileid")
    return files.withColumn("_rn", F.row_number().over(w)).where(~is_main | (F.col("_rn") == 1)).drop("_rn")


def pseudo_files(articles: DataFrame) -> DataFrame:
    """A file of title and abstract for each article."""
    text = F.concat(F.lit(" "), F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("abstract", F.lit("")), F.lit(" "))
    return articles.select((F.col("articleid") * 1000).alias("fileid"), "articleid", "externalid", text.alias("content"))


def filter_by_keywords(articles: DataFrame, files: DataFrame, keywords: list[str]) -> DataFrame:
    """Articles any of whose files contains any keyword, whatever its case."""
    low = F.lower("content")
    hit = [low.contains(k.lower()) for k in keywords]
    any_hit = hit[0]
    for h in hit[1:]:
        any_hit = any_hit | h
    return articles.join(files.where(any_hit).select("articleid").distinct(), "articleid", "left_semi")


def _first_token(c: Column) -> Column:
    return F.substring_index(F.substring_index(F.trim(F.coalesce(c, F.lit(""))), " ", 1), "-", 1)


def fingerprint_place(issn: Column, vol: Column, issue: Column, page: Column) -> Column:
    """issn|vol|issue|first page; null unless volume, issue and page are there."""
    parts = [_first_token(x) for x in (vol, issue, page)]
    whole = F.concat_ws("|", F.coalesce(issn, F.lit("")), *parts)
    return F.when((parts[0] != "") & (parts[1] != "") & (parts[2] != "") & (F.coalesce(issn, F.lit("")) != ""), whole)


def fingerprint_title(authors: Column, year: Column, title: Column) -> Column:
    """Up to five family names joined by -, year, first and last title word; null for short names or titles."""
    names = F.transform(F.slice(F.split(F.coalesce(authors, F.lit("")), ";"), 1, 5), lambda a: F.lower(F.trim(F.substring_index(a, ",", 1))))
    joined = F.array_join(names, "-")
    words = F.split(F.lower(F.trim(F.coalesce(title, F.lit("")))), " +")
    return F.when((F.length(joined) >= 5) & (F.size(words) > 3), F.concat_ws("|", joined, F.coalesce(year, F.lit("")), F.concat(F.element_at(words, 1), F.lit("-"), F.element_at(words, -1))))


def linked_by_fingerprints(records: DataFrame, targets: DataFrame, keys: list[str], target_id: str, record_id: str, others: bool = False) -> DataFrame:
    """(record id, target id, level) by the first key of the list that both sides share; the last writer of a key wins.

    Each level is an equi-join with an index of one row a key, so no key multiplies rows.  With `others`, for targets that
    are the records themselves, no record is its own target.
    """
    out = records
    for n, k in enumerate(keys):
        held = targets.where(F.col(k).isNotNull() & (F.col(k) != ""))
        index = held.groupBy(k).agg(F.max(target_id).alias(f"_t{n}"))
        if others:
            second = held.select(k, target_id).join(index, k).where(F.col(target_id) < F.col(f"_t{n}")).groupBy(k).agg(F.max(target_id).alias(f"_s{n}"))
            index = index.join(second, k, "left")
        out = out.join(index, k, "left")
        if others:
            out = out.withColumn(f"_t{n}", F.when(F.col(f"_t{n}") != F.col(record_id), F.col(f"_t{n}")).otherwise(F.col(f"_s{n}"))).drop(f"_s{n}")
    hit = [F.col(f"_t{n}") for n in range(len(keys))]
    level = F.when(hit[0].isNotNull(), F.lit(keys[0]))
    for k, h in zip(keys[1:], hit[1:], strict=True):
        level = level.when(h.isNotNull(), F.lit(k))
    return out.select(record_id, F.coalesce(*hit).alias("target"), level.alias("matched_by"))
