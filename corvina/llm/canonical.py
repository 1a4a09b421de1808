"""Map freely typed values to the entries of a reference list, or report them as unmatched.

Distinct values are normalised and cut into character trigrams; a trigram inverted index over all written forms of the
entries (name, short name, code, and forms by rule: truncated words, initials, name with place) retrieves candidates, and
the cosine of trigram vectors weighted by inverse entry frequency scores them.  A value is looked up by its rarer trigrams
only: those whose remainder is too light to reach the threshold alone.  Their dot product and the weight of the remainder
bound each candidate's cosine; what cannot come within the margin of the best is dropped, and the rest is scored in full.

By the cosine alone (`map_values(..., words=False)`) the best entry is accepted above `ACCEPT` and ahead of the next by
`AHEAD`.  The cosine cannot tell a misspelt letter from a different word, so with `words` the candidates within the margin
are checked word by word: only misspelling may lie between value and form.  The one with fewest edits is taken, ties going
to the clearly higher cosine; without any the value means no entry.  When entries tie, an identifier that the record itself
gives (ISSN) may choose among the tied ones.

Null and empty values are no cases; blank values and placeholders are cases without entry.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvina.session import parts, staged

#: cosine from which, and lead over the next entry by which, the cosine alone accepts an entry
ACCEPT, AHEAD = 0.6, 0.05

_STOP = {"of", "in", "on", "for", "and", "the", "&"}
_TAIL = re.compile(r"\s*(?:\((?:print|online|publisher|electronic)\)|\[[^\]]*\]|\s:\s.*$|,?\s*\b(?:inc|ltd|gmbh|b\.?v|llc|plc|ag|s\.?a|& co|and co)\b\.?\s*$)", re.I)
_HEAD = re.compile(r"^\s*(?:©|\(c\)|published by|publisher:|journal:)\s*", re.I)


def normal(value: str) -> str:
    """Lower-case words of the value without frames such as (Print), © or Ltd."""
    s = unicodedata.normalize("NFKC", value)
    s = _HEAD.sub("", s)
    for _ in range(2):
        s = _TAIL.sub("", s)
    if " " not in s.strip() and re.search(r"[a-z][A-Z]", s):
        s = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", s)
        s = re.sub(r"(?<=[a-z]{3})(for|of|in|on)(?= [A-Z])", r" \1", s)
    s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)).lower()
    s = re.sub(r",\s*the\s*$", "", s)
    return " ".join(w for w in re.sub(r"[^\w]+", " ", s).split() if w != "the")


def grams(text: str) -> dict[str, int]:
    """Trigrams of each word between marks, with their counts; function words count as nothing."""
    out: dict[str, int] = {}
    words = text.split()
    for w in words:
        if w in _STOP and len(words) > 1:
            continue
        p = f"^{w}$"
        for i in range(len(p) - 2):
            out[p[i : i + 3]] = out.get(p[i : i + 3], 0) + 1
        first = f"^^{w[0]}"
        out[first] = out.get(first, 0) + 1
    return out


def forms(name: str, short: str | None, code: str | None, place: str | None) -> list[str]:
    """Written forms of an entry, normalised."""
    n = normal(name)
    words = [w for w in n.split() if w not in _STOP]
    out = [n]
    if short:
        out.append(normal(short))
    if code:
        out.append(normal(code))
    if place:
        out.append(f"{n} {normal(place)}")
    if len(words) > 1:
        #: the usual short forms of title words; fixed values
        usual = {"journal": "j", "international": "int", "transactions": "trans", "press": "pr", "publishers": "publ", "society": "soc", "university": "univ", "group": "gr", "frontline": "front", "european": "eur", "advances": "adv", "archives": "arch", "annals": "ann", "letters": "lett", "pacific": "pac", "review": "rev", "reports": "rep", "current": "curr", "bulletin": "bull"}
        out.append(" ".join(usual.get(w, w[:6] if len(w) > 6 else w) for w in words))
        out.append(" ".join({**usual, "group": "grp"}.get(w, w[:5]) for w in words))
        out.append("".join(w[0] for w in words))
        out.append(words[0] + " " + "".join(w[0] for w in words[1:]))
    return list(dict.fromkeys(f for f in out if f))


def edits(a: str, b: str) -> int:
    """Edit distance with transpositions of neighbours as one edit."""
    two, one = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, row[-1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        two, one = one, row
    return one[-1]


def fit(value: str, form: str) -> int | None:
    """Edits that make the value the form word by word, None if more than misspelling lies between them.

    Each word must find a word of the form within a quarter of its letters (one edit for short words); function words may
    be missing.  Failing that, the whole may differ by an eighth of its letters, which covers run-together words.
    """
    if value == form:
        return 0
    v, f = value.split(), form.split()
    total, left = 0, list(f)
    for w in v:
        # a word cut short counts as its beginning
        best = min((min(edits(w, x) if abs(len(w) - len(x)) < 4 else 99, edits(w, x[: len(w)]) if len(w) > 2 else 99), k) for k, x in enumerate([*left, ""]))
        if best[0] <= max(1, round(len(w) / 3.5)) and best[0] < len(w):
            total += best[0]
            left.pop(best[1])
        elif len(w) < 3:
            total += 1
        else:
            break
    else:
        if all(x in _STOP for x in left):
            return total
    a, b = "".join(v), "".join(f)
    if abs(len(a) - len(b)) <= max(2, len(b) // 8) and (d := edits(a, b)) <= max(1 if len(b) < 12 else 2, len(b) // 8):
        return d
    return None


def _fits(v: pd.Series, f: pd.Series) -> pd.Series:
    return pd.Series([fit(a, b) for a, b in zip(v, f, strict=True)], dtype="Int64")


def _entry_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for field, i, name, short, code, place in zip(b["field"], b["entryid"], b["name"], b["short"], b["code"], b["place"], strict=True):
            for k, f in enumerate(forms(name, short, code, place)):
                rows.extend((field, i, k, f, g, n) for g, n in grams(f).items())
        yield pd.DataFrame(rows, columns=["field", "entryid", "form", "written", "gram", "tf"])


def _value_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for field, v in zip(b["field"], b["norm"], strict=True):
            rows.extend((field, v, g, n) for g, n in grams(v).items())
        yield pd.DataFrame(rows, columns=["field", "norm", "gram", "tf"])


def _normal(v: pd.Series) -> pd.Series:
    return v.map(normal)


def near_forms(values: DataFrame, entries: DataFrame, threshold: float, margin: float) -> DataFrame:
    """(field, norm, entryid, form, written, score) of the forms with a cosine above the threshold and within the margin of the best."""
    index = staged(entries.where("name is not null").mapInPandas(_entry_grams, "field string, entryid long, form int, written string, gram string, tf int"), "canon-index")
    size = entries.groupBy("field").agg(F.countDistinct("entryid").alias("entries"))
    idf = index.groupBy("field", "gram").agg(F.countDistinct("entryid").alias("df")).join(size, "field").select("field", "gram", F.log(1 + F.col("entries") / F.col("df")).alias("idf"))
    unseen = size.select("field", F.log(1.0 + F.col("entries")).alias("rare"))
    windex = index.join(idf, ["field", "gram"]).withColumn("w", F.sqrt("tf") * F.col("idf"))
    norms = windex.groupBy("field", "entryid", "form").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("len"))
    postings = staged(windex.join(norms, ["field", "entryid", "form"]).select("field", "gram", "entryid", "form", (F.col("w") / F.col("len")).alias("ew")), "canon-postings")
    n = parts(values.sparkSession)
    distinct = values.select("field", "norm").distinct().repartition(n)
    weighed = distinct.mapInPandas(_value_grams, "field string, norm string, gram string, tf int").join(idf, ["field", "gram"], "left").join(unseen, "field").withColumn("idf", F.coalesce("idf", "rare")).withColumn("w", F.sqrt("tf") * F.col("idf"))
    # commonest trigrams first: those whose weight together stays below the threshold are the light remainder
    whole = Window.partitionBy("field", "norm")
    rising = whole.orderBy("idf", "gram").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    square = F.col("w") * F.col("w")
    vg = weighed.repartition(n, "field", "norm").withColumns({"vlen": F.sqrt(F.sum(square).over(whole)), "upto": F.sqrt(F.sum(square).over(rising))})
    vg = vg.withColumn("light", F.col("upto") < threshold * F.col("vlen") * (1 - 1e-9)).withColumn("rest", F.coalesce(F.max(F.when(F.col("light"), F.col("upto"))).over(whole), F.lit(0.0)))
    vg = staged(vg.select("field", "norm", "gram", "w", "vlen", "light", "rest"), "canon-grams")
    found = vg.where("not light").repartition(n, "field", "norm").join(postings, ["field", "gram"]).groupBy("field", "norm", "entryid", "form").agg(F.sum(F.col("w") * F.col("ew")).alias("dot"), F.first("vlen").alias("vlen"), F.first("rest").alias("rest"))
    least = F.greatest(F.max("dot").over(whole) - margin * F.col("vlen"), threshold * F.col("vlen"))
    can = staged(found.withColumn("least", least).where(F.col("dot") + F.col("rest") >= F.col("least") * (1 - 1e-9)).drop("least"), "canon-candidates")
    light = vg.where("light").select("field", "norm", "gram", "w").join(can.select("field", "norm", "entryid", "form"), ["field", "norm"]).join(postings, ["field", "gram", "entryid", "form"]).groupBy("field", "norm", "entryid", "form").agg(F.sum(F.col("w") * F.col("ew")).alias("more"))
    best = can.join(light, ["field", "norm", "entryid", "form"], "left").withColumn("score", F.round((F.col("dot") + F.coalesce("more", F.lit(0.0))) / F.col("vlen"), 6)).where(F.col("score") >= threshold)
    near = best.withColumn("top", F.max("score").over(whole)).where(F.col("score") >= F.col("top") - margin)
    return near.select("field", "norm", "entryid", "form", "score").join(index.select("field", "entryid", "form", "written").distinct(), ["field", "entryid", "form"])


def map_values(values: DataFrame, entries: DataFrame, threshold: float = 0.3, margin: float = 0.25, words: bool = True) -> DataFrame:
    """(field, value, entryid, score, tied) of distinct (field, value).

    `entries` has (field, entryid, name, short, code, place).  entryid is 0 where nothing is near enough or the best two
    entries are too close; tied then lists the entries within the margin.  Without `words` the cosine alone decides.
    """
    values = staged(values.select("field", "value").where("value is not null and value <> ''").distinct().withColumn("norm", F.pandas_udf(_normal, "string")("value")), "canon-values")
    near = near_forms(values, entries, threshold, margin)
    if words:
        near = near.repartition(parts(values.sparkSession), "field", "norm").withColumn("edits", F.pandas_udf(_fits, "int")("norm", "written")).where("edits is not null")
        ahead = 0.05
    else:
        near = near.withColumn("edits", F.lit(0)).where(F.col("score") >= ACCEPT)
        ahead = AHEAD
    checked = near.groupBy("field", "norm", "entryid").agg(F.min("edits").alias("edits"), F.max("score").alias("score"))
    least = checked.withColumn("least", F.min("edits").over(Window.partitionBy("field", "norm"))).where("edits = least")
    kept = least.groupBy("field", "norm").agg(F.max("score").alias("score"), F.max_by("entryid", "score").alias("entryid"), F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "entryid"))).alias("near"))
    out = values.join(kept, ["field", "norm"], "left")
    alone = (F.size("near") == 1) | (F.get("near", F.lit(1))["minus"] + F.col("score") > ahead)
    return out.select("field", "value", F.when(alone, F.col("entryid")).otherwise(F.lit(0)).cast("long").alias("entryid"), F.coalesce("score", F.lit(0.0)).alias("score"), F.when(~alone, F.col("near.entryid")).alias("tied"))


def map_articles(articles: DataFrame, journals: DataFrame, publishers: DataFrame, words: bool = True) -> DataFrame:
    """(articleid, field, entryid) of every journal or publisher value that is not an entry's name letter for letter."""
    entries = journals.select(F.lit("journal").alias("field"), F.col("journalid").alias("entryid"), F.col("title").alias("name"), F.col("isoabbrev").alias("short"), F.lit(None).cast("string").alias("code"), F.lit(None).cast("string").alias("place")).unionByName(
        publishers.select(F.lit("publisher").alias("field"), F.col("publisherid").alias("entryid"), F.col("pubname").alias("name"), F.lit(None).cast("string").alias("short"), "code", F.col("city").alias("place"))
    )
    long = articles.select("articleid", "printissn", "eissn", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in ("journal", "publisher")])).alias("x")).select("articleid", "printissn", "eissn", "x.*").where("value is not null and value <> ''")
    cases = long.join(entries.select("field", F.col("name").alias("value")).distinct(), ["field", "value"], "left_anti")
    mapped = staged(map_values(cases, entries, words=words), "canon-mapped")
    got = cases.join(mapped, ["field", "value"])
    # tied entries: the ISSN of the record chooses, if it is of one of them
    issn = journals.select(F.lit("journal").alias("field"), F.col("journalid").alias("by_issn"), F.explode(F.array_distinct(F.array_compact(F.array("printissn", "eissn")))).alias("issn")).where("issn <> ''")
    tied = got.where("tied is not null").select("articleid", "field", "value", "tied", F.explode(F.array_compact(F.array("printissn", "eissn"))).alias("issn")).join(issn, ["field", "issn"]).where(F.array_contains("tied", F.col("by_issn"))).groupBy("articleid", "field", "value").agg(F.min("by_issn").alias("by_issn"))
    return got.join(tied, ["articleid", "field", "value"], "left").select("articleid", "field", F.coalesce("by_issn", "entryid").alias("entryid")).distinct()
