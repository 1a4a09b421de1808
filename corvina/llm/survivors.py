"""Group the records of one paper and build the surviving record of each group, field by field.

Grouping: each record gives some agreement keys, each of which is strong enough alone (an identifier with year and place or
title, or a title with year, place and an author; a pmid with a first author).  Records that share a key are of one paper; papers are the connected
components, found by spreading the least id over the keys until nothing changes.  Only minima are aggregated, so a key that
a third of all records share costs no more than its rows.

Survival: records are ranked by completeness, trust of the source, recency and id; a field's value is the valid one that most
records of the group hold, ties going to the better-ranked record; without the vote, that of the top-ranked record.  The top of
the ranking is taken as an aggregate, the same as the first row of a window in that order, so that a group of very many
copies is folded before it is shuffled and never sorted in one task.  Invalid and placeholder values never win;
a field without a valid value gives ''.  Repeated rows of an id count as its latest delivery.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvina.session import staged

#: default trust of sources, best first; others come last
TRUST = ("medline", "pmc", "elsevier", "springer", "crawler")
_MISSING = {"", "none", "null", "n/a", "na", "notspecified", "unknown", "-", "nan", "0", "?"}


def clean(s: object) -> str:
    """The value without outer blanks, or '' if it is missing or a placeholder."""
    s = "" if s is None or s != s else str(s).strip()
    return "" if s.lower() in _MISSING else s


def clean_pmid(s: object) -> str:
    """Eight digits, or ''."""
    s = re.sub(r"(?<=\d)\.0+$", "", clean(s))
    s = s.rsplit("/", 1)[-1] if "/" in s else s
    digits = re.sub(r"\D", "", s).lstrip("0")
    return digits if len(digits) == 8 and len(re.findall(r"[A-Za-z]", s)) <= 5 else ""


def clean_doi(s: object) -> str:
    """Lower case from `10.` on, without blanks and closing punctuation, or ''."""
    s = re.sub(r"\s+", "", unquote(clean(s))).lower()
    m = re.search(r"10\.\d{4,9}/\S*[^\s.;,:)\]>\"'}]", s)
    return m[0] if m and len(m[0].split("/", 1)[1]) > 1 else ""


def title_key(s: object) -> str:
    """Letters and digits of the words that are plain ASCII, which a wrong decoding leaves alone; else of all words."""
    t = unicodedata.normalize("NFC", clean(s)).lower()
    words = [re.sub(r"[^a-z0-9]", "", w) for w in t.split(" ") if w.isascii() and "&" not in w and "?" not in w and "=" not in w]
    key = "".join(words)
    if len(key) >= 8:
        return key
    t = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    return re.sub(r"[\W_]", "", t)


def author_words(s: object) -> list[str]:
    """The different words of an author field that can be names, folded, in their order."""
    from corvina.llm.names import fold

    return list(dict.fromkeys(fold(w) for w in re.findall(r"[^\W\d_]{4,}", clean(s))))


#: words of the author field that name the first author or two, which alone may stand beside a pmid
FIRST_WORDS = 3


def _keys(x: dict) -> list[str]:
    p, d, t, y, v, g = x["p"], x["d"], x["t"], x["y"], x["v"], x["g"]
    out = []
    if p:
        out += [f"1|{p}|{y}|{g}"] * bool(y and g) + [f"2|{p}|{y}|{v}"] * bool(y and v) + [f"3|{p}|{t}"] * bool(t) + [f"p|{p}|{a}" for a in x["a"][:FIRST_WORDS]]
    if d:
        out += [f"4|{d}|{y}|{v}|{g}"] * bool(g and v) + [f"5|{d}|{t}"] * bool(t) + [f"6|{d}|{g}|{a}" for a in x["a"] if g]
    if t and y:
        out += [f"7|{t}|{y}|{v}|{g}"] * bool(v and g) + [f"8|{t}|{y}|{g}|{a}" for a in x["a"] if g] + [f"9|{t}|{y}|{v}|{a}" for a in x["a"] if v]
    return out


_COLS = "articleid long, p string, d string, rank_trust int, filled int, updateid long, convtime string, keys array<string>"


def _normalise(trust: tuple[str, ...]):
    place = {s: k for k, s in enumerate(trust)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                x = {"p": clean_pmid(r.pmid), "d": clean_doi(r.doi), "t": title_key(r.title), "y": clean(r.pubyear), "v": clean(r.vol), "g": clean(r.page), "a": author_words(r.authors)}
                filled = sum(bool(x[k]) for k in "pdtyvg") + bool(x["a"]) + bool(clean(r.abstract)) + bool(clean(r.journal))
                rows.append((r.articleid, x["p"], x["d"], place.get(clean(r.source).lower(), len(place)), filled, r.updateid, clean(r.convtime), _keys(x)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _COLS.split(", ")])

    return run


def components(keys: DataFrame, id_col: str, key_col: str) -> DataFrame:
    """(id, component) of the ids that share a key with another id; the component is its least id.

    Labels only fall, and a label's label is taken too, so the rounds are about the logarithm of the longest chain."""
    shared = keys.groupBy(key_col).agg(F.min(id_col).alias("lo"), F.max(id_col).alias("hi")).where("lo <> hi").select(key_col)
    links = staged(keys.select(F.col(id_col).alias("id"), F.col(key_col).alias("key")).join(shared.withColumnRenamed(key_col, "key"), "key").distinct(), "cc-links")
    labels = staged(links.groupBy("id").agg(F.min("id").alias("label")), "cc-labels")
    while True:
        least = links.join(labels, "id").groupBy("key").agg(F.min("label").alias("least"))
        new = links.join(least, "key").groupBy("id").agg(F.min("least").alias("label"))
        # a label's own label is at least as small: this halves long chains
        jump = new.select(F.col("id").alias("label"), F.col("label").alias("next"))
        new = staged(new.join(jump, "label", "left").select("id", F.least("label", F.coalesce("next", "label")).alias("label")), "cc-labels")
        changed = new.withColumnRenamed("label", "now").join(labels, "id").where("now <> label").limit(1).count()
        labels = new
        if not changed:
            return labels.select("id", F.col("label").alias("component"))


def surviving_records(articles: DataFrame, trust: tuple[str, ...] = TRUST, vote: bool = True) -> DataFrame:
    """(articleid, pmid, doi, records, best) of each paper with two or more ids; best is the id of the top-ranked record.

    Without `vote`, values are those of the top-ranked record that has a valid one."""
    cols = ["articleid", "source", "pmid", "doi", "title", "pubyear", "vol", "page", "authors", "abstract", "journal", "convtime", "updateid"]
    text = [c for c in cols if c not in ("articleid", "updateid")]
    one = articles.select("articleid", F.col("updateid").cast("long").alias("updateid"), *[F.col(c).cast("string").alias(c) for c in text]).where("articleid is not null").groupBy("articleid").agg(F.max_by(F.struct("updateid", *text), F.struct(F.coalesce("updateid", F.lit(-1)), *text)).alias("x")).select("articleid", "x.*")
    norm = staged(one.mapInPandas(_normalise(trust), _COLS), "survivors-normal")
    group = components(norm.select("articleid", F.explode("keys").alias("key")), "articleid", "key")
    rows = norm.join(group, norm["articleid"] == group["id"]).select("component", "articleid", "p", "d", "rank_trust", "filled", "updateid", "convtime")
    # greater is better: completeness, trust, recency, and the least id
    rank = F.struct("filled", -F.col("rank_trust"), F.coalesce("updateid", F.lit(-1)), "convtime", -F.col("articleid"))
    ranked = rows.withColumn("rank", rank)

    def value(c: str) -> DataFrame:
        held = ranked.where(f"{c} <> ''").groupBy("component", c).agg(F.count("*").alias("n"), F.max(-F.col("rank_trust")).alias("trusted"), F.max("rank").alias("rank"))
        return held.groupBy("component").agg(F.max_by(c, F.struct("n", "trusted", "rank") if vote else F.col("rank")).alias("v_" + c))

    base = ranked.groupBy("component").agg(F.count("*").alias("records"), F.min("articleid").alias("first_id"), F.max_by("articleid", "rank").alias("best"))
    out = base.join(value("p"), "component", "left").join(value("d"), "component", "left").where("records > 1")
    return out.select(F.col("first_id").alias("articleid"), F.coalesce("v_p", F.lit("")).alias("pmid"), F.coalesce("v_d", F.lit("")).alias("doi"), "records", "best")
