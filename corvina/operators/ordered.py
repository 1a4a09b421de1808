"""Order-dependent columns of large groups: groups are cut into ranges, and what crosses a border is carried over.

A window over a key puts all rows of the key into one task.  Here the rows are range-partitioned by key and order first, so a
key that holds a third of all rows lies in many partitions; each computes its own part, and a small table with one row for
each key and partition carries sums, extremes or neighbours from one part to the next.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvina.session import parts, staged


def ranged(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """`df` with _part, the number of its range of (by, order); rows equal in these lie in one part.  Written once."""
    return staged(df.repartitionByRange(parts(df.sparkSession), *by, *order).withColumn("_part", F.spark_partition_id()), "ranged")


def carried(df: DataFrame, by: list[str], carry: dict[str, tuple[Column, Column]]) -> DataFrame:
    """`df` with columns carried over parts: name -> (aggregate within a part, the same over parts as a window column of `_x`).

    The window column reads the aggregate under the carry's own name, over the parts before or behind.
    """
    summary = df.groupBy(*by, "_part").agg(*[a.alias(name) for name, (a, _) in carry.items()])
    # one row for each key and part
    over = summary.select(*by, "_part", *[w.alias(name) for name, (_, w) in carry.items()])
    left, right = df.alias("_l"), over.alias("_r")
    same = reduce(lambda x, y: x & y, [F.col(f"_l.`{c}`").eqNullSafe(F.col(f"_r.`{c}`")) for c in [*by, "_part"]])
    return left.join(right, same).select("_l.*", *[F.col(f"_r.`{name}`") for name in carry])


def before(by: list[str]):
    return Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)


def behind(by: list[str]):
    return Window.partitionBy(*by).orderBy("_part").rowsBetween(1, Window.unboundedFollowing)


def row_numbers(df: DataFrame, by: list[str], order: list[str], name: str = "no") -> DataFrame:
    """`df` with the number of each row in its group, from 1; a null key is a group too."""
    cols = df.columns
    got = carried(ranged(df, by, order), by, {"_off": (F.count("*"), F.coalesce(F.sum("_off").over(before(by)), F.lit(0)))})
    return got.select(*cols, (F.row_number().over(Window.partitionBy("_part", *by).orderBy(*order)) + F.col("_off")).alias(name))


def tiles(df: DataFrame, by: list[str], order: list[str], n: int, name: str = "tile") -> DataFrame:
    """`df` with the number of one of `n` parts of near-equal size, the larger ones first, in order."""
    cols = df.columns
    numbered = row_numbers(df, by, order, "_no")
    size = df.groupBy(*by).agg(F.count("*").alias("_n"))
    left, right = numbered.alias("_l"), size.alias("_r")
    same = reduce(lambda x, y: x & y, [F.col(f"_l.`{c}`").eqNullSafe(F.col(f"_r.`{c}`")) for c in by], F.lit(True))
    r, q, more = F.col("_no") - 1, F.floor(F.col("_n") / n), F.pmod("_n", F.lit(n))
    tile = F.when(r < (q + 1) * more, F.floor(r / (q + 1))).otherwise(more + F.floor((r - (q + 1) * more) / F.greatest(q, F.lit(1)))) + 1
    return left.join(right, same).select("_l.*", "_n").select(*cols, tile.cast("long").alias(name))
