"""Exact join of two string tables within a bounded edit distance, by sharded tries.

Sharding: an indexed string of length n is cut into `k + 1` near-equal segments; a string within `k` edits must hold at
least one of them unchanged, at a place shifted by no more than the edits allow.  Each (length, segment number, segment)
is a shard.  Within a shard the indexed strings form a trie, and each query walks it with its Levenshtein automaton: a
state is a trie node, a place in the query and the edits left, and a branch ends as soon as no state is alive.  With
`swaps` two neighbouring letters that changed places are one edit; such a swap spoils two segments only where it lies
across their border, so the query is looked up with the letters at the borders changed over too.

Shards where all strings are equal are dropped before any Python runs.  A shard with more than `BLOCK` indexed strings, or
more than `ASKED` queries, is cut into blocks of these sizes and every pair of blocks is a task's unit, so that no task
holds an unbounded trie or walks an unbounded number of queries.

Nulls and empty strings join nothing.  Equal strings are not returned.  Repeated strings count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvina.session import parts

#: indexed strings and queries of a block
BLOCK, ASKED = 20_000, 200_000


def segments(n: int, parts: int) -> list[tuple[int, int]]:
    """(start, length) of the near-equal segments of a string of length n, the shorter ones first."""
    short, long = n // parts, n % parts
    out, at = [], 0
    for i in range(parts):
        size = short + (1 if i >= parts - long else 0)
        out.append((at, size))
        at += size
    return out


def index_keys(s: str, k: int) -> list[str]:
    """Shard keys of an indexed string."""
    return [f"{len(s)}:{i}:{s[a : a + n]}" for i, (a, n) in enumerate(segments(len(s), k + 1))]


def query_keys(s: str, k: int, swaps: bool = False) -> list[str]:
    """Shard keys under which any string within k edits of `s` can be found; swaps are allowed for k = 1 and 2."""
    out = {}
    n = len(s)
    for m in range(max(1, n - k), n + k + 1):
        delta = n - m
        cuts = segments(m, k + 1)
        looked = [(s, k)]
        if swaps:
            # a swap across a border, undone: one edit less is left
            for p in {a + d for a, _ in cuts[1:] for d in range(1 - k, k) if 0 < a + d < n}:
                looked.append((s[: p - 1] + s[p] + s[p - 1] + s[p + 1 :], k - 1))
        for t, left in looked:
            for i, (a, size) in enumerate(cuts):
                # no more than i edits lie left of segment i, no more than k - i right of it
                low = max(0, a - min(i, left), a + delta - min(k - i, left))
                high = min(n - size, a + min(i, left), a + delta + min(k - i, left))
                for p in range(low, high + 1):
                    out[f"{m}:{i}:{t[p : p + size]}"] = None
    return list(out)


class Trie:
    """A trie of strings with a search by Levenshtein automaton."""

    def __init__(self, words: list[str]):
        self.root: dict = {}
        for w in words:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w

    def within(self, word: str, k: int, swaps: bool = False) -> list[tuple[str, int]]:
        """(string, distance) of all strings within k edits."""
        found: dict[str, int] = {}
        n = len(word)
        stack = [(self.root, 0, k)]
        seen = set()
        while stack:
            node, i, left = stack.pop()
            if left and (state := (id(node), i, left)) in seen:
                continue
            elif left:
                seen.add(state)
            c = word[i] if i < n else None
            if c is None:
                if "" in node and found.get(node[""], k + 1) > k - left:
                    found[node[""]] = k - left
            elif c in node:
                stack.append((node[c], i + 1, left))
            if not left:
                continue
            if c is not None:
                stack.append((node, i + 1, left - 1))
                if swaps and i + 1 < n and word[i + 1] != c and c in node.get(word[i + 1], ()):
                    stack.append((node[word[i + 1]][c], i + 2, left - 1))
            for d, child in node.items():
                if d:
                    stack.append((child, i, left - 1))
                    if c is not None and d != c:
                        stack.append((child, i + 1, left - 1))
        return list(found.items())


def _walk(k: int, swaps: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # the indexed strings of a unit come first, then its queries one by one
        unit, words, trie = None, [], None
        for b in batches:
            rows: list = []
            for s, text, is_index, room in zip(b["shard"], b["text"], b["is_index"], b["room"], strict=True):
                if s != unit:
                    unit, words, trie = s, [], None
                if is_index:
                    words.append(text)
                elif words:
                    trie = trie or Trie(words)
                    rows.extend((text, w, d, room) for w, d in trie.within(text, k, swaps) if w != text)
            yield pd.DataFrame(rows, columns=["query", "match", "distance", "room"])

    return run


def _keys(df: DataFrame, col: str, k: int, swaps: bool, is_index: bool, room: str | None) -> DataFrame:
    @F.pandas_udf("array<string>")
    def keys(s: pd.Series) -> pd.Series:
        return s.map(lambda x: index_keys(x, k) if is_index else query_keys(x, k, swaps))

    base = df.select(F.col(col).alias("text"), (F.coalesce(F.col(room), F.lit("")) if room else F.lit("")).alias("room")).where(F.length("text") > 0).distinct().repartition(parts(df.sparkSession))
    return base.select("text", F.lit(is_index).alias("is_index"), "room", F.explode(keys("text")).alias("key")).select("text", "is_index", "room", F.concat_ws("|", "room", "key").alias("shard"))


def trie_join(queries: DataFrame, query_col: str, index: DataFrame, index_col: str, k: int, swaps: bool = False, room: str | None = None) -> DataFrame:
    """(query, match, distance, room) of all different strings within k edits; a swap of neighbours is one edit if `swaps`.

    `room` names a text column of both sides that must be equal; without it the result's room is ''.
    """
    if swaps and k > 2:
        raise ValueError("swaps need k = 1 or 2")
    rows = _keys(queries, query_col, k, swaps, False, room).unionByName(_keys(index, index_col, k, swaps, True, room))
    sizes = rows.groupBy("shard").agg(F.min("text").alias("a"), F.max("text").alias("b"), F.count_if("is_index").alias("n"), F.count_if(~F.col("is_index")).alias("m"))
    live = sizes.where((F.col("a") != F.col("b")) & (F.col("n") > 0) & (F.col("m") > 0)).select("shard", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("m") / ASKED).cast("int").alias("parts"))
    own = lambda c: F.array(F.pmod(F.xxhash64("text"), F.col(c)).cast("int"))
    every = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    spread = rows.join(live, "shard").select("text", "is_index", "room", "shard", F.when(F.col("is_index"), own("blocks")).otherwise(every("blocks")).alias("block"), F.when(F.col("is_index"), every("parts")).otherwise(own("parts")).alias("part"))
    placed = spread.select("text", "is_index", "room", "shard", F.explode("block").alias("block"), "part").select("text", "is_index", "room", "shard", "block", F.explode("part").alias("part"))
    placed = placed.select("text", "is_index", "room", F.concat_ws("#", "shard", F.col("block").cast("string"), F.col("part").cast("string")).alias("shard"))
    sorted_ = placed.repartition("shard").sortWithinPartitions("shard", F.desc("is_index"))
    return sorted_.mapInPandas(_walk(k, swaps), "query string, match string, distance int, room string").distinct()
