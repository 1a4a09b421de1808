"""Pack texts, measured in tokens of a public tokenizer, whole into containers of fixed capacity.

Shortest-pack-first over the histogram of lengths: lengths are placed longest first, each into the open packs with most room
left (the shortest packs), as many copies as fit; packs of the same contents are one pattern with a count, so the work
depends on the capacity and not on the number of documents.  Patterns are then joined back to the documents: the r-th
document of a length takes the r-th place of that length.  Ranks are counted in two levels, so that a length that a third
of all documents share is not sorted in one task.

A text longer than the capacity is cut into full pieces and one rest, which is packed like a document; no other text is cut.
Null and empty texts have no tokens: they are returned with pack_id null.  Repeated doc_ids count as separate documents.
"""

from __future__ import annotations

import base64
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvina.session import staged

#: the pattern that the byte-level tokenizer splits text by before its merges; fixed value
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_UNEVEN = re.compile(r" \s|\s |^ | $")
#: pieces whose token counts a worker remembers
REMEMBERED = 500_000
#: least number of parts that the pieces of one length are ranked in, and pieces of a part when all have one length
SALTS, RANKED = 64, 1_000_000


class TokenCounter:
    """Number of tokens of a text under a byte-level BPE rank file; pieces of text repeat, so their counts are kept."""

    def __init__(self, rank_file: str):
        import tiktoken

        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        # a single blank always begins a piece, so the text may be counted from blank to blank
        if _UNEVEN.search(text):
            return len(self.encoding.encode_ordinary(text))
        known, total = self.known, 0
        first, *others = text.split(" ")
        for p in [first, *[f" {x}" for x in others]]:
            n = known.get(p)
            if n is None:
                n = len(self.encoding.encode_ordinary(p))
                if len(known) >= REMEMBERED:
                    known.clear()
                known[p] = n
            total += n
        return total


def _count(rank_file: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = TokenCounter(rank_file)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "tokens": [counter(t) for t in b["text"]]})

    return run


def token_counts(documents: DataFrame, rank_file: str) -> DataFrame:
    """(doc_id, tokens); `rank_file` must be readable on every executor."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInPandas(_count(rank_file), "doc_id long, tokens long")


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Patterns (packs, {length: copies}) that hold all lengths of the histogram, none above the capacity."""
    if any(not 0 < n <= capacity for n in histogram):
        raise ValueError("lengths must lie between 1 and the capacity")
    room: dict[int, list[tuple[int, dict[int, int]]]] = defaultdict(list)  # free tokens -> patterns
    for length in sorted(histogram, reverse=True):
        left = histogram[length]

        def put(free: int, packs: int, pattern: dict[int, int], left: int, length: int = length) -> int:
            """Fill up to `packs` packs of a pattern; returns how many of the length are left."""
            copies = free // length
            full = min(packs, left // copies)
            if full:
                room[free - copies * length].append((full, {**pattern, length: copies}))
                packs, left = packs - full, left - full * copies
            if packs and left:  # the last pack takes fewer copies
                room[free - left * length].append((1, {**pattern, length: left}))
                packs, left = packs - 1, 0
            if packs and free < capacity:
                room[free].append((packs, pattern))
            return left

        for free in sorted((f for f in room if f >= length), reverse=True):
            for packs, pattern in room.pop(free):
                if left:
                    left = put(free, packs, pattern, left)
                else:
                    room[free].append((packs, pattern))
            if not left:
                break
        if left:
            put(capacity, -(-left // (capacity // length)), {}, left)
    return [p for free in sorted(room) for p in room[free]]


def _places(patterns: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, copies, first pack) of each pattern's places of a length."""
    used: dict[int, int] = defaultdict(int)
    rows, pack = [], 0
    for packs, pattern in patterns:
        for length, copies in pattern.items():
            rows.append((length, used[length], used[length] + packs * copies, copies, pack))
            used[length] += packs * copies
        pack += packs
    return rows


def pack_documents(counts: DataFrame, containers: DataFrame) -> DataFrame:
    """(container_id, pack_id, doc_id, piece, start_token, tokens) for (doc_id, tokens) and (container_id, capacity_tokens)."""
    spark = counts.sparkSession
    kinds = [(r[0], r[1]) for r in containers.select("container_id", "capacity_tokens").where("capacity_tokens > 0").distinct().orderBy("container_id").collect()]
    out = None
    # a part stays small however many documents there are; each may have few pieces or many
    salts = max(SALTS, -(-counts.count() // RANKED))
    for container, capacity in kinds:
        cut = counts.select("doc_id", "tokens", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("tokens") / capacity) - 1, F.lit(0)).cast("int"))).alias("piece"))
        pieces = cut.select("doc_id", "piece", (F.col("piece").cast("long") * capacity).alias("start_token"), F.least(F.lit(capacity).cast("long"), F.col("tokens") - F.col("piece") * capacity).alias("length"))
        pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
        sizes = staged(pieces.where("length > 0").groupBy("length", "salt").agg(F.count("*").alias("n")), "pack-sizes")
        # as many rows as the capacity has tokens, at most
        histogram = {r[0]: r[1] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
        places = _places(pack_histogram(histogram, capacity))
        before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))).select("length", "salt", F.coalesce("before", F.lit(0)).alias("before"))
        ranked = pieces.where("length > 0").withColumn("r", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")) - 1)
        ranked = ranked.join(before, ["length", "salt"]).withColumn("rank", F.col("r") + F.col("before"))
        table = spark.createDataFrame(places, "length long, first long, end long, copies long, pack long") if places else spark.createDataFrame([], "length long, first long, end long, copies long, pack long")
        at = table.select("length", "first", "end", "copies", "pack")
        # patterns times lengths: bounded by the histogram, checked here before it is broadcast
        at = F.broadcast(at) if len(places) < 1_000_000 else at
        placed = ranked.join(at, (ranked["length"] == at["length"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))).select(F.lit(container).cast("long").alias("container_id"), (F.col("pack") + F.floor((F.col("rank") - F.col("first")) / F.col("copies"))).cast("long").alias("pack_id"), "doc_id", "piece", "start_token", ranked["length"].alias("tokens"))
        none = pieces.where("length <= 0").select(F.lit(container).cast("long").alias("container_id"), F.lit(None).cast("long").alias("pack_id"), "doc_id", "piece", "start_token", F.lit(0).cast("long").alias("tokens"))
        out = placed.unionByName(none) if out is None else out.unionByName(placed).unionByName(none)
    return out if out is not None else spark.createDataFrame([], "container_id long, pack_id long, doc_id long, piece int, start_token long, tokens long")
