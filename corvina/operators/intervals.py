"""Interval and order operators: binned overlap joins, nearest joins, chains, merging, flattening."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvina.operators.ordered import before, behind, carried, ranged


def _bins(start: Column, end: Column, width: int) -> Column:
    return F.sequence(F.floor(start / width), F.floor(F.greatest(end - 1, start) / width))


def overlap_join(a: DataFrame, b: DataFrame, key: str, width: int, how: str = "inner") -> DataFrame:
    """Rows of `a` and `b` (start, end; half open) of one key that overlap, as an equi-join on bins of `width`.

    A pair is given once: in the bin where the later of the two starts lies.  how='left_anti' gives the rows of `a` without
    overlap, 'left_semi' those with one; intervals without a start or an end overlap nothing.  Choose the width near the usual interval length; longer ones just fill more bins.
    """
    left = a.withColumn("_bin", F.explode(_bins(F.col("start"), F.col("end"), width)))
    right = b.select(F.col(key), F.col("start").alias("start2"), F.col("end").alias("end2"), *[F.col(c).alias(f"{c}2") for c in b.columns if c not in (key, "start", "end")]).withColumn("_bin", F.explode(_bins(F.col("start2"), F.col("end2"), width)))
    hit = (F.col("start") < F.col("end2")) & (F.col("start2") < F.col("end"))
    if how == "inner":
        return left.join(right, [key, "_bin"]).where(hit & (F.col("_bin") == F.floor(F.greatest("start", "start2") / width))).drop("_bin")
    semi = left.join(right, (left[key] == right[key]) & (left["_bin"] == right["_bin"]) & hit, "left_semi").drop("_bin").distinct()
    if how == "left_semi":
        return semi
    # equal in all columns, null being equal to null
    same = F.lit(True)
    mine, found = a.alias("_mine"), semi.alias("_found")
    for c in a.columns:
        same = same & F.col(f"_mine.`{c}`").eqNullSafe(F.col(f"_found.`{c}`"))
    return mine.join(found, same, "left_anti")


def nearest(a: DataFrame, b: DataFrame, key: str, a_id: str) -> DataFrame:
    """For each row of `a` (pos) the row of `b` (pos, id) of the same key nearest to it; ties go to the one before.

    One union sorted within ranges of the key: the last of `b` before and the first after are running values, and those of
    the neighbouring ranges are carried over.  So no pairs are made, and a hot key is spread over many tasks.
    """
    u = a.select(key, "pos", F.col(a_id).alias("_a"), F.lit(None).cast("long").alias("_b")).unionByName(b.select(key, "pos", F.lit(None).cast(a.schema[a_id].dataType).alias("_a"), F.col("id").cast("long").alias("_b")))
    mark = F.when(F.col("_b").isNotNull(), F.struct("pos", "_b"))
    r = carried(ranged(u, [key], ["pos"]), [key], {"_cl": (F.max(mark), F.last("_cl", True).over(before([key]))), "_cr": (F.min(mark), F.first("_cr", True).over(behind([key])))})
    w = Window.partitionBy("_part", key).orderBy("pos", F.col("_a").isNotNull(), F.col("_b"))
    last = F.coalesce(F.last(mark, True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.col("_cl"))
    first = F.coalesce(F.first(mark, True).over(w.rowsBetween(1, Window.unboundedFollowing)), F.col("_cr"))
    x = r.select(key, "pos", "_a", last.alias("l"), first.alias("r")).where("_a is not null")
    take_left = F.col("r").isNull() | (F.col("l").isNotNull() & (F.col("pos") - F.col("l.pos") <= F.col("r.pos") - F.col("pos")))
    best = F.when(take_left, F.col("l")).otherwise(F.col("r"))
    return x.select(key, F.col("_a").alias(a_id), best["_b"].alias("nearest"), F.abs(best["pos"] - F.col("pos")).alias("distance"))


def gap_sessions(df: DataFrame, key: list[str], start: str, end: str, gap: int) -> DataFrame:
    """Adds `session`, counted from 1 within the key: a new one where a row starts more than `gap` after all ends before.

    Ranges of a key are scanned apart; the furthest end and the number of sessions before each are carried over.
    """
    cols = df.columns
    r = carried(ranged(df, key, [start, end]), key, {"_reached": (F.max(end), F.max("_reached").over(before(key)))})
    w = Window.partitionBy("_part", *key).orderBy(start, end)
    reached = F.greatest(F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("_reached"))
    marked = r.withColumn("_new", F.when(reached.isNull() | (F.col(start) - reached > gap), 1).otherwise(0)).withColumn("_local", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    got = carried(marked.drop("_reached"), key, {"_off": (F.sum("_new"), F.coalesce(F.sum("_off").over(before(key)), F.lit(0)))})
    return got.select(*cols, (F.col("_local") + F.col("_off")).alias("session"))


def merged(df: DataFrame, key: list[str]) -> DataFrame:
    """Union of the intervals of each key: (key, start, end, pieces)."""
    s = gap_sessions(df, key, "start", "end", 0)
    return s.groupBy(*key, "session").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("pieces")).drop("session")


def flattened(df: DataFrame, key: str, width: int = 1024) -> DataFrame:
    """Elementary intervals of each key, each given to its shortest feature (name breaks ties).

    Steps between cuts find their features by bins of `width`, so not all features of a key meet all its steps.
    """
    cuts = df.select(key, F.explode(F.array("start", "end")).alias("start")).distinct()
    steps = cuts.withColumn("end", F.lead("start").over(Window.partitionBy(key).orderBy("start"))).where("end is not null")
    hit = overlap_join(steps, df.select(key, "start", "end", "name"), key, width).where((F.col("start2") <= F.col("start")) & (F.col("end") <= F.col("end2")))
    return hit.groupBy(key, "start", "end").agg(F.min_by("name2", F.struct(F.col("end2") - F.col("start2"), "name2")).alias("name"))


def close_neighbours_removed(df: DataFrame, key: str, pos: str, least: int) -> DataFrame:
    """Without rows whose predecessor or successor in the whole list is within `least`."""
    w = Window.partitionBy(key).orderBy(pos)
    far = lambda c: c.isNull() | (F.abs(c - F.col(pos)) > least)
    return df.withColumn("_l", F.lag(pos).over(w)).withColumn("_r", F.lead(pos).over(w)).where(far(F.col("_l")) & far(F.col("_r"))).drop("_l", "_r")


def _by_key(df: DataFrame, key: list[str], order: list[str], schema: T.StructType | str, rows: Callable[[list[tuple]], list[tuple]]) -> DataFrame:
    """`rows` of each key's tuples in order, streamed: partitions are sorted and a group ends where the key changes."""
    names = df.columns
    at = [names.index(k) for k in key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, group = None, []
        for b in batches:
            out: list[tuple] = []
            for r in b.itertuples(index=False, name=None):
                k = tuple(r[i] for i in at)
                if k != now:
                    if group:
                        out += rows(group)
                    now, group = k, []
                group.append(r)
            yield pd.DataFrame(out, columns=columns)
        yield pd.DataFrame(rows(group) if group else [], columns=columns)

    columns = [c.split()[0] for c in schema.split(", ")] if isinstance(schema, str) else schema.names
    return df.repartition(*key).sortWithinPartitions(*key, *order).mapInPandas(run, schema)


def chain_alignments(df: DataFrame, gap: int = 50_000) -> DataFrame:
    """Exact chains of alignments (article, chrom, query, tstart, tend): adds `chain`, counted from 1 for (article, chrom).

    A query sequence that is in the chain already is left out, however far away it is; any other hit opens a new chain if it
    begins more than `gap` from the end of the one taken last.  So the next gap depends on what was taken: a scan of each
    (article, chrom) in order.  Identical blocks of one query count once; alternative haplotypes are no place of their own.
    A group is one article's hits on one chromosome, which the cap on matches of an article bounds.
    """
    cols = df.columns
    q, s, e = (cols.index(c) for c in ("query", "tstart", "tend"))
    schema = T.StructType([*df.schema.fields, T.StructField("chain", T.IntegerType())])

    def rows(group: list[tuple]) -> list[tuple]:
        chain, last, inside, out = 0, None, set(), []
        for r in group:
            if chain and r[q] in inside:
                continue
            if last is None or abs(r[s] - last) > gap:
                chain, inside = chain + 1, set()
            inside.add(r[q])
            last = r[e]
            out.append((*r, chain))
        return out

    return _by_key(df.where(~F.col("chrom").cast("string").contains("_hap")), ["article", "chrom"], ["tstart", "tend", "query"], schema, rows)


def greedy_cover(chains: DataFrame) -> DataFrame:
    """Of each article's (chain, query): chains with most queries are kept, their queries leave all others, and so on."""

    def rows(group: list[tuple]) -> list[tuple]:
        sets: dict = {}
        for _, c, q in group:
            sets.setdefault(c, set()).add(q)
        kept: list[tuple] = []
        while sets and (best := max(map(len, sets.values()))):
            top = sorted(c for c, s in sets.items() if len(s) == best)
            used = set().union(*(sets[c] for c in top))
            kept += [(group[0][0], c, q) for c in top for q in sorted(sets[c])]
            sets = {c: s - used for c, s in sets.items() if c not in top}
        return kept

    fields = {f.name: f.dataType.simpleString() for f in chains.schema}
    cols = ["article", "chain", "query"]
    return _by_key(chains.select(*cols), ["article"], ["chain", "query"], ", ".join(f"{c} {fields[c]}" for c in cols), rows)
