"""Protein sequences in texts, told from words of a language by Markov models of letter pairs."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import product

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvina.functions.text import bound
from corvina.operators.annotators import Tagger, register_tagger

LETTERS = "ACDEFGHIKLMNPQRSTVWYBXZJUO"
_RESIDUES = set("ABCDEFGHIKLMNPQRSTVWXYZ")
_BASES = set("ACTGUN")
#: amino acids by three letters; fixed values
THREE = dict(zip("ala asx cys asp glu phe gly his ile lys leu met asn pro gln arg ser thr val trp xaa tyr glx".split(), "ABCDEFGHIKLMNPQRSTVWXYZ", strict=True))
#: shortest word, its least different letters and most lower-case ones, shortest sequence, widest gap between single letters,
#: most uses of a sequence and most sequences of a document; fixed values
WORD_LEAST, KINDS_LEAST, LOWER_MOST, SEQ_LEAST, GAP_MOST, USES_MOST, DOC_MOST = 5, 4, 3, 8, 5, 5, 300
#: verdicts: share of bases of DNA, letters for each character, letter changes for each character; fixed values
DNA_SHARE, KINDS_SHARE, LONG, CHANGES = 0.85, 0.3, 30, 0.4


class Markov:
    """Log probabilities of runs of letters: the score of a sequence is the sum over its runs."""

    def __init__(self, name: str, sequences: list[str], order: int = 2, letters: str = LETTERS):
        self.name, self.order = name, order
        counts = Counter(s[i : i + order] for s in map(str.upper, sequences) for i in range(len(s) - order + 1))
        size = sum(map(len, sequences)) - (order - 1)
        # runs that were never seen count once
        self.logs = {run: math.log1p(counts.get(run, 1) / size) for run in map("".join, product(letters, repeat=order))}

    def score(self, seq: str) -> float:
        return sum(self.logs[seq[i : i + self.order]] for i in range(len(seq) - self.order + 1))


class Classifier:
    """pos, neg or unsure by the best foreground model against the best background model; DNA and long proteins need none."""

    def __init__(self, difference: float, foreground: list[Markov], background: list[Markov], dna_share: float | None = DNA_SHARE, long: int = 40, kinds: int = 8):
        self.difference, self.foreground, self.background, self.dna_share, self.long, self.kinds = difference, foreground, background, dna_share, long, kinds

    def __call__(self, seq: str) -> tuple[str, str]:
        if self.dna_share is not None and sum(c in "ACTGU" for c in seq) / len(seq) > self.dna_share:
            return "neg", "dna"
        if len(seq) > self.long and len(set(seq)) > self.kinds:
            return "pos", "longProt"
        (f, good), (b, bad) = (max(((m.score(seq), m.name) for m in models), key=lambda x: x[0]) for models in (self.foreground, self.background))
        return ("unsure", good) if abs(f - b) < self.difference else ("pos", good) if f > b else ("neg", bad)


def letter_changes(seq: str) -> float:
    """Changes from one letter to the next, by the length."""
    return sum(a != b for a, b in zip(seq, seq[1:], strict=False)) / len(seq)


def _as_protein(word: str) -> tuple[str, bool] | None:
    """The residues a word stands for, and whether it can stand for nothing else."""
    if word.lower() in THREE:
        return THREE[word.lower()], True
    kinds = set(word)
    if len(word) >= WORD_LEAST and len(kinds) >= KINDS_LEAST and len(kinds & set("abcdefghijklmnopqrstuvwxyz")) <= LOWER_MOST and kinds <= _RESIDUES:
        return word, False
    return None


def verdict(seq: str, sure: bool, classifier: Classifier, common: set[str]) -> tuple | None:
    """(prefix, suffix, model, verdict, class) of a sequence, the first three Y or N; None where it cannot be one."""
    if len(seq) < SEQ_LEAST or letter_changes(seq) < CHANGES:
        return None
    if not sure and (sum(c in _BASES for c in seq) / len(seq) > DNA_SHARE or seq in common or not (len(set(seq)) / len(seq) > KINDS_SHARE or len(seq) > LONG)):
        return None
    kind, name = classifier(seq)
    marks = ["N" if not sure and part in common else "Y" for part in (seq[:6], seq[-6:])] + ["N" if kind == "neg" else "Y"]
    return *marks, "isPep" if "N" not in marks else "isEng", name


def find_proteins(text: str, classifier: Classifier, common: set[str] = frozenset()) -> Iterator[tuple]:
    """(start, end, seq, parts, prefix, suffix, model, verdict, class) of protein sequences.

    Words of one sequence follow each other: three-letter names, single letters close together, words of residues.  A
    sequence used too often in a text is left out, as is a text with too many of them.
    """
    parts: list[tuple[str, int, int]] = []
    found: dict[str, list[tuple]] = {}
    before, at, sure = "", 0, False

    def close(sure: bool) -> None:
        seq = "".join(p[0] for p in parts)
        if got := verdict(seq, sure, classifier, common):
            found.setdefault(seq, []).append((parts[0][1], parts[-1][2], seq, len(parts), *got))
        parts.clear()

    for m in re.finditer("[A-Za-z0-9]+", text):
        word, gap = m[0], m.start() - at
        got = _as_protein(word)
        if got is None and len(word) == 1 and word in _RESIDUES and gap < GAP_MOST and (parts or len(before) == 1 and before in _RESIDUES):
            if not parts:
                parts.append((before, at, at + 1))
            got = word, False
        before, at = word, m.start()
        if got:
            parts.append((got[0], m.start(), m.end()))
            sure = got[1]
        elif parts and m.start() - parts[-1][1] >= 3:
            close(False)
            if sum(map(len, found.values())) > DOC_MOST:
                return
    if parts:
        close(sure)
    for rows in found.values():
        if len(rows) <= USES_MOST:
            yield from rows


def protein_tagger(classifier: Classifier, common: set[str] = frozenset(), name: str = "proteins") -> Tagger:
    """A tagger of protein sequences; `common` are words in capitals that many documents hold, a bounded list."""
    return register_tagger(Tagger(name, ["start", "end", "seq", "parts", "prefix", "suffix", "model", "verdict", "class"], lambda text: find_proteins(text, classifier, common)))


def pair_scores(df: DataFrame, seq: str, models: dict[str, DataFrame], order: int = 2) -> DataFrame:
    """`df` with a score by each model (run, n) of letter runs: the same sum as joins, for models and tables of any size."""
    runs = df.select(seq).distinct().select(seq, F.explode(bound(F.col(seq), lambda s: F.transform(F.sequence(F.lit(1), F.length(s) - (order - 1)), lambda i: F.substring(s, i, F.lit(order))))).alias("run")).groupBy(seq, "run").agg(F.count("*").alias("k"))
    out = df
    for name, counts in models.items():
        size = counts.agg(F.sum("n").alias("size"))
        got = runs.join(counts, "run", "left").crossJoin(F.broadcast(size))  # one row
        out = out.join(got.groupBy(seq).agg(F.sum(F.col("k") * F.log1p(F.coalesce("n", F.lit(1)) / F.col("size"))).alias(name)), seq, "left")
    return out


def run_counts(df: DataFrame, seq: str, order: int = 2) -> DataFrame:
    """(run, n) of the letter runs of a column."""
    return df.where(F.length(seq) >= order).select(F.explode(bound(F.col(seq), lambda s: F.transform(F.sequence(F.lit(1), F.length(s) - (order - 1)), lambda i: F.substring(s, i, F.lit(order))))).alias("run")).groupBy("run").agg(F.count("*").alias("n"))


def often_used(spans: DataFrame, file: str = "fileid", most: int = USES_MOST) -> DataFrame:
    """Spans of sequences that a file does not repeat more than `most` times."""
    return spans.withColumn("_n", F.count("*").over(Window.partitionBy(file, "seq"))).where(F.col("_n") <= most).drop("_n")
