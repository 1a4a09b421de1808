"""Find corpus documents that hold passages or questions of held-out test items, whole or in part.

A prefix-filtered containment join.  The shingles of the items are word pairs.  First their document frequencies are
counted over the whole corpus, and each segment (passage or question) is split into its own words, with the rare pairs
they stand in, and the frame.  A window of a dozen running words is contained only if it holds own words enough, with
one rare pair of a name or two of numbers unchanged; so the rare pairs of own words are the prefix that a document must
share.  They form one multi-pattern automaton that each document passes once, and every place with such a pair is a
candidate for all segments that hold it.  The place of the pair in the segment and the length of the segment bound the
words of the document that can belong to the leak; there the own words, as they are or misspelt behind an unchanged
neighbour, are counted, and only where they can suffice is the window verified exactly: the words of the item and of the
place are aligned, and some window of at least a dozen running words must be contained with its wording and with its own
particulars (words few items share, numbers; no standard statement, which many documents hold that have not the item);
the frame of a sentence or a standard statement alone does not suffice.

The items are the stated query set.  Segments of equal words are searched once and given back to all their items.  They
are held in blocks of about `BLOCK_WORDS` words, two passes over the corpus for each block, so memory is bounded whatever
their number.  Null and empty texts hold nothing; repeated rows count once.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvina.session import staged

#: words of items in one automaton
BLOCK_WORDS = 2_000_000
#: shortest leak in running words, as a dozen may lose one
LEAST_WORDS = 11
#: own words that a leak holds, one of them a name; likeness of a word misspelt in place, at most so far behind a word that is right
OWN_HELD, LIKE, GAP = 3, 0.7, 3
#: weight of unchanged rare pairs that a leak holds
EVIDENCE = 2
#: a pair of words in more than this share of the documents, those with the item it is from left out, belongs to nobody
COMMON = 0.004
#: a document has an item if it holds such a share of a segment's pairs, or so many of its numbers and codes in pairs few segments hold
COPIED, CODES = 0.6, 3
_DROP = bytes(b if (48 <= b <= 57 or 97 <= b <= 122 or b >= 128) else 32 for b in range(256))


_BEYOND = re.compile(r"[^\x00-\x7f]")
#: letters of other scripts that look like Latin ones; fixed values
_ALIKE = dict(zip("аеорсхуіѕјԁһкмтвнАЕОРСХУІЅЈКМТВНαοενικτρ", "aeopcxyisjdhkmtbhAEOPCXYISJKMTBHaoeviktp".replace(" ", ""), strict=True))


@cache
def _plain(c: str) -> str:
    """What a character beyond ASCII is read as: a look-alike letter, its letter without accent, nothing or a blank."""
    if c in _ALIKE:
        return _ALIKE[c]
    if unicodedata.category(c) in ("Cf", "Mn"):
        return ""
    d = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
    return d if d.isalnum() else " "


def words_of(text: str) -> str:
    """Lower-case words separated and enclosed by single blanks; accents and look-alike letters are made plain."""
    if not text.isascii():
        for c in set(_BEYOND.findall(text)):
            text = text.replace(c, _plain(c))
    return f" {' '.join(text.lower().encode('utf-8', 'replace').translate(_DROP).decode('latin-1').split())} "


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & at.get(c, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


class Items:
    """The segments (passages and questions) of a block of items."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.ids = [i for i, _ in rows]
        self.words: list[list[str]] = []
        self.ends: list[list[int]] = []  # number of written words up to each word
        self.at: dict[str, list[int]] = defaultdict(list)
        for k, (_, text) in enumerate(rows):
            ws, ends = [], []
            for n, w in enumerate(text.split()):
                for p in words_of(w).split():
                    ws.append(p)
                    ends.append(n)
            self.words.append(ws)
            self.ends.append(ends)
            for a, b in zip(ws, ws[1:], strict=False):
                if not self.at[f"{a} {b}"] or self.at[f"{a} {b}"][-1] != k:
                    self.at[f"{a} {b}"].append(k)
        self.own: list[list[bool]] = []
        self.rare: list[list[int]] = []
        self.sizes_of_pairs = [len(set(zip(ws, ws[1:], strict=False))) for ws in self.words]

    def know(self, df: dict[str, int], held: dict[str, int], segments: int) -> None:
        """Mark each segment's own words: few of all segments hold them, and few documents without the item in the neighbourhood they have here."""
        few, share = max(1, segments // 100), COMMON * df.get("", 0)
        # the least number that shows a share above COMMON, by two standard deviations, whatever the number of documents
        common = (1 + (1 + share) ** 0.5) ** 2
        for ws in self.words:
            pairs = [df.get(f"{a} {b}", 0) for a, b in zip(ws, ws[1:], strict=False)]
            near = [min(pairs[max(0, x - 1) : x + 1], default=0) for x in range(len(ws))]
            own = [(held[w] <= few or w.isdigit()) and near[x] <= common for x, w in enumerate(ws)]
            self.own.append(own)
            # the weight of the rare pairs of own words, pair x being that of the words x - 1 and x: one of a name says as much as two of numbers
            name = [o and not w.isdigit() for o, w in zip(own, ws, strict=True)]
            self.rare.append([0 if not x or pairs[x - 1] > common or not (own[x - 1] or own[x]) else EVIDENCE if name[x - 1] or name[x] else 1 for x in range(len(ws))])

    def outside(self, pairs: set[str], few: int) -> set[str]:
        """Those of a document's pairs that it does not hold because it has the item they are from."""
        shared: Counter = Counter()
        codes: dict[int, set[str]] = defaultdict(set)
        for p in pairs:
            shared.update(self.at[p])
            if len(self.at[p]) <= few:
                for w in p.split():
                    if any("0" <= c <= "9" for c in w):
                        for k in self.at[p]:
                            codes[k].add(w)
        copied = {k for k, n in shared.items() if n >= COPIED * self.sizes_of_pairs[k]} | {k for k, c in codes.items() if len(c) >= CODES}
        return {p for p in pairs if copied.isdisjoint(self.at[p])} if copied else pairs

    def index(self) -> None:
        """Where the pairs of own words stand; call after `know`."""
        self.pairs_at: dict[str, list[tuple[int, int]]] = defaultdict(list)
        self.windows: dict[int, tuple] = {}
        self.alike: dict[tuple[str, str], bool] = {}
        self.places: list[dict[str, list[int]]] = []
        self.own_words = {w for ws, own in zip(self.words, self.own, strict=True) for w, o in zip(ws, own, strict=True) if o}
        for k, ws in enumerate(self.words):
            places = defaultdict(list)
            for x, w in enumerate(ws):
                if self.own[k][x]:
                    places[w].append(x)
                if self.rare[k][x]:
                    self.pairs_at[f"{ws[x - 1]} {w}"].append((k, x))
            self.places.append(dict(places))

    def like(self, w: str, y: str) -> bool:
        """Whether `y` may be a misspelling of `w`: the longest common subsequence is no shorter than matching blocks."""
        if 2 * min(len(w), len(y)) < LIKE * (len(w) + len(y)):
            return False
        got = self.alike.get((w, y))
        if got is None:
            if len(self.alike) > 300_000:
                self.alike.clear()
            got = self.alike[w, y] = w != y and 2 * _common(w, y) >= LIKE * (len(w) + len(y)) - 1e-9
        return got

    def possible(self, k: int, place: list[str]) -> bool:
        """Whether a place of a document can hold own words of a segment enough for `contained`."""
        ws, held, at = self.words[k], set(), defaultdict(list)
        for j, y in enumerate(place):
            at[y].append(j)
        for w, xs in self.places[k].items():
            if w in at:
                held.update(xs)
        n = len(place)
        for w, xs in self.places[k].items():
            if w in at or len(w) < 4:
                continue
            for x in xs:
                near = {j + o for left in ws[max(0, x - GAP) : x] for j in at.get(left, ()) for o in range(1, GAP + 1)}
                if any(j < n and self.like(w, place[j]) for j in near):
                    held.add(x)
        return self.may_hold(k, held)

    def may_hold(self, k: int, held: set[int]) -> bool:
        """Whether some window of a segment has own words enough if those at `held` are there: the bounds of `contained`."""
        if len(held) < OWN_HELD:
            return False
        if k not in self.windows:
            ws, own, ends = self.words[k], self.own[k], np.array(self.ends[k])
            a, b = np.nonzero(ends[None, :] - ends[:, None] + 1 >= LEAST_WORDS)
            m, n = (np.concatenate(([0], np.cumsum(x))) for x in (own, [o and not w.isdigit() for o, w in zip(own, ws, strict=True)]))
            self.windows[k] = (a, b + 1, np.maximum(OWN_HELD, 0.6 * (m[b + 1] - m[a])), np.maximum(1, 0.6 * (n[b + 1] - n[a])))
        a, b, least, least_names = self.windows[k]
        h, n = np.zeros(len(self.words[k]) + 1, int), np.zeros(len(self.words[k]) + 1, int)
        for x in held:
            h[x + 1] = 1
            n[x + 1] = not self.words[k][x].isdigit()
        h, n = h.cumsum(), n.cumsum()
        return bool(((h[b] - h[a] >= least) & (n[b] - n[a] >= least_names)).any())

    def automaton(self, shingles):
        import ahocorasick

        auto = ahocorasick.Automaton()
        for s in shingles:
            auto.add_word(f" {s} ", s)
        if len(auto):
            auto.make_automaton()
        return auto

    def contained(self, k: int, doc: list[str]) -> bool:
        """Exact check of one segment against the words of a place in a document."""
        ws, own, ends = self.words[k], self.own[k], self.ends[k]
        hit = [-1] * len(ws)
        blocks = SequenceMatcher(None, ws, doc, autojunk=False).get_matching_blocks()
        last = None
        for a, b, n in blocks:
            if last:
                ga, gb = a - last[0], b - last[1]
                if 0 < ga <= GAP and 0 < gb <= GAP:  # words misspelt in place
                    for x, y in zip(range(last[0], a), range(last[1], b), strict=False):
                        # another item's own word is no misspelling
                        if len(ws[x]) > 3 and (ws[x] == doc[y] or doc[y] not in self.own_words) and SequenceMatcher(None, ws[x], doc[y]).ratio() >= LIKE:
                            hit[x] = y
            for j in range(n):
                hit[a + j] = b + j
            last = (a + n, b + n)
        # rare pairs of own words that stand there unchanged
        sure = [weight if weight and hit[x] > 0 and hit[x - 1] == hit[x] - 1 and ws[x] == doc[hit[x]] and ws[x - 1] == doc[hit[x - 1]] else 0 for x, weight in enumerate(self.rare[k])]
        n = len(ws)
        pairs = np.concatenate(([0], np.cumsum(sure))).tolist() if n else [0]
        good, mine, mine_hit, named, named_hit = [0], [0], [0], [0], [0]
        for x in range(n):
            name = own[x] and not ws[x].isdigit()
            named.append(named[-1] + name)
            named_hit.append(named_hit[-1] + (name and hit[x] >= 0))
            good.append(good[-1] + (hit[x] >= 0))
            mine.append(mine[-1] + own[x])
            mine_hit.append(mine_hit[-1] + (own[x] and hit[x] >= 0))
        places = [x for x in range(n) if hit[x] >= 0]
        for i, a in enumerate(places):
            for b in reversed(places[i:]):
                if ends[b] - ends[a] + 1 < LEAST_WORDS:
                    break
                size = b - a + 1
                if hit[b] - hit[a] + 1 > 1.6 * size + 5:
                    continue
                m, h = mine[b + 1] - mine[a], mine_hit[b + 1] - mine_hit[a]
                names, names_hit = named[b + 1] - named[a], named_hit[b + 1] - named_hit[a]
                if pairs[b + 1] - pairs[a + 1] >= EVIDENCE and good[b + 1] - good[a] >= 0.6 * size and h >= OWN_HELD and h >= 0.6 * m and names_hit >= max(1, 0.6 * names):
                    return True
        return False


def _frequencies(rows: list[tuple[int, str]], segments_in_all: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = Items(rows)
        auto = items.automaton(items.at)
        df: Counter = Counter()
        for b in batches:
            df[""] += len(b)
            for text in b["text"]:
                if text and len(auto):
                    df.update(items.outside({s for _, s in auto.iter(words_of(text))}, max(1, segments_in_all // 100)))
        yield pd.DataFrame(list(df.items()), columns=["shingle", "df"])

    return run


def _search(rows: list[tuple[list[int], str]], df: dict[str, int], held: dict[str, int], segments_in_all: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = Items(rows)
        items.know(df, held, segments_in_all)
        items.index()
        auto = items.automaton(items.pairs_at)
        for b in batches:
            found = []
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                if not text or not len(auto):
                    continue
                flat = words_of(text)
                near: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
                at = word = 0
                for end, s in auto.iter(flat):
                    word += flat.count(" ", at, end)  # number of words up to this place
                    at = end
                    for k, x in items.pairs_at[s]:
                        # the second word of the pair is number `word` - 1; a leak is at most so much longer than its part of the item
                        near[k].append((word - 1 - int(1.6 * (x + 1)) - 6, word + int(1.6 * (len(items.words[k]) - x)) + 6, items.rare[k][x]))
                if not near:
                    continue
                doc = flat.split()
                for k, spans in near.items():
                    if sum(w for _, _, w in spans) < EVIDENCE:
                        continue
                    spans.sort()
                    start, end, weight = spans[0]
                    for a, z, w in [*spans[1:], (len(doc) + 1 << 40, 0, 0)]:
                        if a <= end:
                            end, weight = max(end, z), weight + w
                            continue
                        place = doc[max(0, start) : end]
                        if weight >= EVIDENCE and items.possible(k, place) and items.contained(k, place):
                            found.extend((doc_id, i) for i in items.ids[k])
                            break
                        start, end, weight = a, z, w
            yield pd.DataFrame(found, columns=["doc_id", "item_id"])

    return run


def leaked_documents(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id) of every document (doc_id, text) with a leak of an item (item_id, passage, question)."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    flat = F.pandas_udf(lambda x: x.map(words_of), "string")
    texts = items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(F.array("passage", "question")).alias("text")).where("item_id is not null and text is not null and text <> ''")
    # segments of the same words are one
    segments = staged(texts.groupBy(flat("text").alias("words")).agg(F.min("text").alias("text"), F.sort_array(F.collect_set("item_id")).alias("ids")).where("trim(words) <> ''"), "leak-segments")
    total, size = segments.agg(F.count("*"), F.coalesce(F.sum(F.size(F.split("words", " "))), F.lit(0))).first()
    # in how many segments of all blocks a word stands
    everywhere = segments.select(F.explode(F.array_distinct(F.split(F.trim("words"), " "))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    blocks = -(-size // BLOCK_WORDS)
    out = docs.sparkSession.createDataFrame([], "doc_id long, item_id long")
    for block in range(blocks):
        own = segments.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block)
        rows = [(list(r[0]), r[1]) for r in own.select("ids", "text").orderBy("words").toLocalIterator()]
        if not rows:
            continue
        # the words and the shingles of one block: about BLOCK_WORDS rows
        words = own.select(F.explode(F.split(F.trim("words"), " ")).alias("word")).distinct()
        held = {r[0]: r[1] for r in everywhere.join(words, "word").toLocalIterator()}
        counted = docs.select("text").mapInPandas(_frequencies(rows, total), "shingle string, df long").groupBy("shingle").agg(F.sum("df").alias("df"))
        df = {r[0]: r[1] for r in counted.toLocalIterator()}
        out = out.unionByName(docs.mapInPandas(_search(rows, df, held, total), "doc_id long, item_id long"))
    return out.distinct()
