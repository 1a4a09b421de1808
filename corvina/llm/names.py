"""Link the spellings of names of persons and groups that mean the same entity.

A name is parsed into family key, given name, initials (persons) or head word (groups); which of two words is the family
name is decided by how many different partners each word has in the whole table, so that reordered names are read right.
Misspelt given names and family names are linked to their nearest more frequent neighbour by a trie join with Levenshtein
automata.  Within a family the given names, nicknames, middle initials and bare initials are matched; a form that fits
several persons of a family (an initial shared by two of them) stays on its own rather than joining them.

Null and blank names are no entities.  Repeated names count once; their number only ranks spellings.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvina.llm.trie_join import trie_join
from corvina.session import staged

#: Common short forms of given names; fixed values.
NICKNAMES = {
    "bill": "william", "will": "william", "willy": "william", "billy": "william", "wilma": "wilhelmina", "willa": "wilhelmina", "mina": "wilhelmina", "minna": "wilhelmina", "bob": "robert", "rob": "robert", "bert": "robert", "bobby": "robert",
    "tom": "thomas", "tommy": "thomas", "tobi": "tobias", "tobe": "tobias", "toby": "tobias", "leo": "leonard", "len": "leonard", "lenny": "leonard", "beppe": "giuseppe", "peppe": "giuseppe", "pino": "giuseppe", "paco": "francisco", "pancho": "francisco", "kiko": "francisco",
    "ravi": "ravindra", "uschi": "ursula", "ulla": "ursula", "katja": "katharina", "kathi": "katharina", "katia": "katharina", "kate": "katharina", "hannes": "johannes", "hans": "johannes", "jan": "johannes", "mike": "michael", "mick": "michael", "micha": "michael", "michi": "michael",
    "alex": "alexander", "sasha": "alexander", "sascha": "alexander", "xander": "alexander", "ben": "benjamin", "benny": "benjamin", "benni": "benjamin", "chris": "christopher", "kit": "christopher", "topher": "christopher", "dani": "daniela", "ella": "gabriela", "gabi": "gabriela", "gaby": "gabriela",
    "liz": "elisabeth", "lisa": "elisabeth", "beth": "elisabeth", "betty": "elisabeth", "elsa": "elisabeth", "lisbeth": "elisabeth", "sissi": "elisabeth", "maggie": "margarethe", "gretel": "margarethe", "grete": "margarethe", "greta": "margarethe", "meg": "margarethe", "pat": "patricia", "patty": "patricia", "tricia": "patricia",
    "trish": "patricia", "rick": "richard", "dick": "richard", "rich": "richard", "ricky": "richard", "sam": "samuel", "sammy": "samuel", "sue": "susanne", "susi": "susanne", "sanne": "susanne", "susan": "susanne", "thea": "theodora", "dora": "theodora", "theo": "theodora", "nick": "nikolai", "kolya": "nikolai", "klaus": "nikolai", "niko": "nikolai",
    "vic": "viktor", "vitya": "viktor", "fred": "frederik", "fritz": "frederik", "freddy": "frederik", "rik": "frederik", "izzy": "isabel", "bella": "isabel", "isa": "isabel", "belle": "isabel", "jake": "jakob", "jack": "jakob", "jim": "james", "jimmy": "james", "toni": "antonia", "tonia": "antonia", "nia": "antonia",
    "berta": "alberta", "albie": "alberta", "conny": "konrad", "kurt": "konrad", "conrad": "konrad", "pepa": "josefina", "fina": "josefina", "josie": "josefina", "pepita": "josefina", "ossi": "oskar", "rube": "ruben", "annemie": "annemarie", "ami": "annemarie", "jl": "jeanluc", "nadja": "nadia", "inga": "ingrid", "inge": "ingrid",
    "tony": "anthony", "dave": "david", "ed": "edward", "ted": "edward", "joe": "joseph", "dan": "daniel", "danny": "daniel", "matt": "matthew", "steve": "stephen", "jenny": "jennifer", "kathy": "katherine", "sepp": "josef", "pepe": "jose", "lena": "magdalena", "nina": "antonina", "vanya": "ivan", "misha": "mikhail", "andy": "andreas",
}
_GROUP = re.compile(r"\b(?:consortium|collaborati\w*|collab|group|grp|network|netw|party|registry|committee|initiative|investigators|trials?|society|association|team|alliance|cons|coll)\b\.?", re.I)
_GENERIC = {"the", "of", "for", "and", "study", "group", "grp", "working", "party", "registry", "network", "reg", "netw", "consortium", "cons", "collaboration", "collab", "coll", "work", "pty", "stud", "trial", "on"}
_PARTICLES = {"van", "der", "den", "von", "de", "la", "dela", "vander", "vonder", "le", "al", "el", "del", "della", "di", "da", "dos", "du", "ter", "ten", "zu", "zum", "bin", "ibn", "o", "mc", "st"}
_TITLES = {"dr", "prof", "md", "phd", "msc", "bsc", "frcp", "mbbs", "jr", "sr", "mr", "mrs", "ms", "dds", "rn", "mph"}
_FOLD = str.maketrans({"ß": "ss", "ø": "o", "Ø": "o", "ł": "l", "Ł": "l", "đ": "d", "ð": "d", "þ": "th", "æ": "a", "Æ": "a", "œ": "o", "ı": "i"})


def plain(s: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", s.translate(_FOLD)) if not unicodedata.combining(c)).lower()


def fold(s: str) -> str:
    """Plain, with spelled-out umlauts and doubled letters of the same sound made one."""
    return plain(s).replace("oe", "o").replace("ue", "u").replace("ae", "a").replace("aa", "a").replace("ss", "s")


_WORD = re.compile(r"[^\W\d_]+")
_NICK = {plain(k): plain(v) for k, v in NICKNAMES.items()}


def _initials(w: str) -> bool:
    return bool(re.fullmatch(r"(?:[^\W\d_]\.?-?){1,4}", w)) and (w.isupper() and len(w.replace(".", "").replace("-", "")) <= 3 or "." in w or len(w) == 1)


def parse_name(name: str) -> tuple[str, str, str, str, str]:
    """(kind, family or head, given, initials of given, further initials), '' where there is none.

    All are folded but the given name, which is only plain: its misspellings are looked up first.
    """
    s = unicodedata.normalize("NFKC", name).strip().strip('"').strip()
    words = [fold(w) for w in _WORD.findall(s)]
    if (_GROUP.search(s) and len(words) >= 3) or (re.search(r" (?:WP|SG|RN)$", s) and len(words) > 3 and "," not in s) or ("," not in s and sum(len(w) > 3 for w in words) > 3):
        words = [w for w in words if w != "the"]
        lead = next((i for i, w in enumerate(words) if w not in _GENERIC), 0)
        words = words[lead:] + words[:lead]
        return ("g", words[0], "#", "".join(w[0] for w in words[1:]), "")
    if len(words) == 2 and "," not in s and (m := re.fullmatch(r"\S+ ([A-Z]{4,6})", s)) and not s.isupper():
        return ("a", m[1].lower(), plain(m[0].split()[0]), m[1][0].lower(), "")  # a group's head and acronym, or a given name and a family name in capitals
    words = s.replace(",", " , ").split()
    shouted = "," in words and s.isupper()
    short = lambda w: w.isupper() and len(w.strip(".")) == 2
    bare = [w for w in words if fold(w).strip(".,") not in _TITLES or (short(w) and w.strip(".").lower() not in ("md", "dr"))]
    # two capitals behind the only other word are initials, not a degree
    full = [w for w in words if fold(w) not in _PARTICLES]
    words = words if len(full) == 2 and len(words) > len(bare) and short(words[-1]) else bare
    while words and words[-1] == ",":
        words.pop()
    if not words:
        return ("p", "", "", "", "")

    def family(ws: list[str]) -> str:
        parts = [p for w in ws for p in re.split(r"[-'’]", w) if p]
        core = [fold(p) for p in parts if fold(p).strip(".") not in _PARTICLES]
        return "".join(re.sub(r"[^\w]", "", c) for c in core)

    def given(ws: list[str]) -> tuple[str, str, str]:
        full, ini, more = "", "", ""
        for w in ws:
            parts = [p for p in re.split(r"[-'’.]", w) if p]
            # a family name's particle, where the words stand in the other order
            if len(parts) > 1 and len(parts[-1]) > 2 and fold(parts[0]) in _PARTICLES:
                parts = parts[1:]
            if fold(w).strip("-.") in _PARTICLES and not w.isupper():
                continue
            if _initials(w) and not (shouted and len(w) == 3 and w.isalpha() and fold(w[1:])[0] in "aeiouy"):
                letters = "".join(fold(c) for p in parts for c in p)
                if full:
                    more += letters
                else:
                    ini += letters
            else:
                full += "".join(plain(p) for p in parts)
                ini += "".join(plain(p)[:1] for p in parts)
        return full, ini, more

    if "," in words:
        k = words.index(",")
        left, right = words[:k], [w for w in words[k + 1 :] if w != ","]
        full, ini, more = given(right)
        return ("p", family(left), full, ini, more)
    if len(words) > 1 and _initials(words[-1]) and (not _initials(words[0]) or len(words) > 2 and fold(words[0]) in _PARTICLES):
        return ("p", family(words[:-1]), "", "".join(fold(c) for c in re.sub(r"[^\w]", "", words[-1])), "")
    cut = len(words) - 1
    while cut > 1 and (fold(words[cut - 1]) in _PARTICLES and not _initials(words[cut - 1]) or words[cut - 1].upper() in ("DE", "LA", "DER", "VAN", "VON") and words[cut].isupper()):
        cut -= 1
    if cut == 1 and fold(words[0]) in _PARTICLES:  # "von Bepa Haruko", family first
        return ("p", family(words[1:]), "", "", "")
    lead = 0
    while lead < len(words) - 2 and fold(words[lead]) in _PARTICLES and not _initials(words[lead]):
        lead += 1
    if lead:
        full, ini, more = given(words[lead + 1 :])
        return ("p", family(words[lead : lead + 1]), full, ini, more)
    full, ini, more = given(words[:cut])
    return ("p", family(words[cut:]), full, ini, more)


_PARSED = "name string, n long, kind string, a string, b string, ini string, more string, swappable boolean"


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for x in batches:
        rows = []
        for name, n in zip(x["name"], x["n"], strict=True):
            kind, a, b, ini, more = parse_name(name)
            rows.append((name, n, kind, a, b, ini, more, bool(kind != "g" and a and b)))
        yield pd.DataFrame(rows, columns=["name", "n", "kind", "a", "b", "ini", "more", "swappable"])


#: a word with so many times the partners of another is a given name beside it, or the right form of it
GIVEN_RATIO = 4
#: shortest family name in which one edit is a misspelling
LEAST_FAMILY = 4


def _substituted(a: pd.Series, b: pd.Series) -> pd.Series:
    """The two letters, in order, where one letter stands for another; '' where letters were dropped, doubled or swapped."""
    out = []
    for x, y in zip(a, b, strict=True):
        differ = [i for i in range(len(x)) if x[i] != y[i]] if len(x) == len(y) else []
        out.append("".join(sorted((x[differ[0]], y[differ[0]]))) if len(differ) == 1 else "")
    return pd.Series(out, dtype="object")


def _slips(w: str) -> set[str]:
    """What a name becomes by one slip of the fingers: a letter behind the first dropped, one doubled, two swapped."""
    out = {w[:i] + w[i + 1 :] for i in range(1, len(w))} | {w[: i + 1] + w[i:] for i in range(len(w))}
    return out | {w[:i] + w[i + 1] + w[i] + w[i + 2 :] for i in range(len(w) - 1)}


def _path(x: str, y: str) -> str:
    """How two names two edits apart come of each other: 'slips' for two slips, the two letters for one slip and one letter for another, else ''."""
    for a, b in ((x, y), (y, x)):
        if any(a in _slips(m) for m in _slips(b)):
            return "slips"
    for a, b in ((x, y), (y, x)):
        for m in sorted(_slips(b)):
            if len(m) == len(a) and len(other := [(p, q) for p, q in zip(a, m, strict=True) if p != q]) == 1:
                return "".join(sorted(other[0]))
    return ""


def _paths(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_path(x, y) for x, y in zip(a, b, strict=True)], dtype="object")


def _in_order(parsed: DataFrame) -> DataFrame:
    """Names with family and given name told apart, whatever order their words were typed in.

    A word that stands with many times the partners of the other, and more often in the given name's place than in the
    family's, is the given name.  Where partners cannot tell and both orders of the two words stand in the table, they are
    one name, read in the order used more.
    """
    both = parsed.where("swappable")
    sides = both.select("n", F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("with"), F.lit(0).alias("given")), F.struct(F.col("b").alias("word"), F.col("a").alias("with"), F.lit(1).alias("given")))).alias("x")).select("n", "x.*")
    sides = sides.groupBy("word", "with").agg(F.sum(F.col("n") * F.col("given")).alias("behind"), F.sum(F.col("n") * (1 - F.col("given"))).alias("before"))
    words = staged(sides.groupBy("word").agg(F.count("*").alias("p"), (F.sum("behind") - F.sum("before")).alias("given_use")), "names-words")
    pair = [F.least("a", "b").alias("w1"), F.greatest("a", "b").alias("w2")]
    orders = both.groupBy(*pair).agg(F.sum(F.when(F.col("a") <= F.col("b"), F.col("n")).otherwise(0)).alias("up"), F.sum(F.when(F.col("a") > F.col("b"), F.col("n")).otherwise(0)).alias("down")).where("up > 0 and down > 0")
    of = lambda c: words.select(F.col("word").alias(c), F.col("p").alias("p" + c), F.col("given_use").alias("g" + c))
    got = parsed.join(of("a"), "a", "left").join(of("b"), "b", "left").withColumns({"w1": F.least("a", "b"), "w2": F.greatest("a", "b")}).join(orders, ["w1", "w2"], "left")
    first = (F.col("pa") >= GIVEN_RATIO * F.col("pb")) & (F.col("ga") > 0)
    second = (F.col("pb") >= GIVEN_RATIO * F.col("pa")) & (F.col("gb") > 0)
    rarer = F.when(F.col("a") <= F.col("b"), F.col("up") < F.col("down")).otherwise(F.col("down") <= F.col("up"))
    group = (F.col("kind") == "a") & ~F.coalesce(second, F.lit(False))
    swap = F.col("swappable") & (F.col("kind") == "p") & F.coalesce(first | (~second & rarer), F.lit(False))
    return got.select(
        "name", "n", F.when(group | (F.col("kind") == "g"), "g").otherwise("p").alias("kind"),
        F.when(swap | group, F.col("b")).otherwise(F.col("a")).alias("fam"),
        F.when(swap, F.col("a")).when(group, "#").otherwise(F.col("b")).alias("given"),
        # a single letter of the true given name is kept when the words change places
        F.when(swap, F.substring("a", 1, 1)).when(group, F.col("a")).when(F.col("kind") == "a", F.substring("b", 1, 1)).otherwise(F.col("ini")).alias("ini"), "more",
    )


def _right_given(read: DataFrame) -> DataFrame:
    """Given names spelt right and in full: the family's other spellings decide among the readings of a form.

    The readings of a form are the names one edit away with many times its partners, and the full names of these and of the
    form itself where they are short forms.  A reading that the family has in another form comes first; the others rank by
    their partners.  A form without readings stays as it is.
    """
    nick = F.create_map(*[F.lit(x) for kv in _NICK.items() for x in kv])
    forms = staged(read.where("kind = 'p' and given <> ''").select("fam", "given").distinct(), "names-forms")
    sizes = staged(forms.groupBy("given").agg(F.count("*").alias("p")), "names-givens")
    near = trie_join(sizes.where(F.length("given") > 1), "given", sizes, "given", 1, swaps=True).select(F.col("query").alias("given"), F.col("match"))
    near = near.join(sizes, "given").join(sizes.select(F.col("given").alias("match"), F.col("p").alias("pm")), "match").where(F.col("pm") >= GIVEN_RATIO * F.col("p")).select("given", F.coalesce(nick[F.col("match")], F.col("match")).alias("right"), F.col("pm").alias("weight"), F.lit(1).alias("edits"))
    full = sizes.where(nick[F.col("given")].isNotNull()).select("given", nick[F.col("given")].alias("right"), F.col("p").alias("weight"), F.lit(0).alias("edits"))
    readings = staged(near.unionByName(full).groupBy("given", "right").agg(F.max("weight").alias("weight"), F.min("edits").alias("edits")), "names-readings")
    held = forms.select("fam", F.coalesce(nick[F.col("given")], F.col("given")).alias("right"), "given").groupBy("fam", "right").agg(F.min("given").alias("f1"), F.max("given").alias("f2"))
    chosen = forms.join(readings, "given").join(held, ["fam", "right"], "left").withColumn("held", F.coalesce((F.col("f1") != F.col("given")) | (F.col("f2") != F.col("given")), F.lit(False)))
    chosen = chosen.groupBy("fam", "given").agg(F.max_by("right", F.struct("held", -F.col("edits"), "weight", "right")).alias("right"))
    read = read.join(chosen.withColumn("kind", F.lit("p")), ["kind", "fam", "given"], "left").withColumn("given", F.coalesce("right", "given")).drop("right")
    for spelt, made in (("oe", "o"), ("ue", "u"), ("ae", "a"), ("aa", "a"), ("ss", "s")):
        read = read.withColumn("given", F.replace("given", F.lit(spelt), F.lit(made)))
    return read


def _right_family(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Family names spelt right: a form goes to the best attested family one edit away that has a person who fits it.

    Letters dropped, doubled or swapped are misspellings.  One letter for another is a misspelling for those pairs of letters
    for which families that differ so have a given name in common more often than not: where they mostly have not, the pair
    tells different families apart (Larsen, Larson).  Such pairs of letters are returned too.
    """
    fams = staged(read.groupBy("kind", "fam").agg(F.count("*").alias("spellings"), F.sum("n").alias("uses")), "names-families")
    long = fams.where(F.length("fam") >= LEAST_FAMILY).select("fam").distinct()
    near = trie_join(long, "fam", long, "fam", 1, swaps=True).select(F.col("query").alias("fam"), F.col("match").alias("fam2"))
    near = staged(near.withColumn("letters", F.pandas_udf(_substituted, "string")("fam", "fam2")), "names-near")
    persons = read.where("kind = 'p' and given <> ''").select("fam", "given").distinct()
    told = near.where("letters <> '' and fam < fam2").join(persons, "fam").join(persons.select(F.col("fam").alias("fam2"), "given", F.lit(1).alias("shared")), ["fam2", "given"], "left").groupBy("fam", "fam2", "letters").agg(F.max("shared").alias("shared"))
    told = told.join(persons.select(F.col("fam").alias("fam2")).distinct(), "fam2", "left_semi")
    # at most one row for two letters of the alphabets
    apart = staged(told.groupBy("letters").agg(F.count_if(F.col("shared").isNull()).alias("differ"), F.count("shared").alias("same")).where("differ >= same").select("letters"), "names-apart")
    near = near.join(apart, "letters", "left_anti").select("fam", "fam2")
    rank = lambda s: F.struct(f"spellings{s}", f"uses{s}", F.length(f"fam{s}"), f"fam{s}")
    fams2 = fams.select("kind", *[F.col(c).alias(c + "2") for c in ("fam", "spellings", "uses")])
    up = near.join(fams, "fam").join(fams2, ["kind", "fam2"]).where(rank("") < rank("2")).select("kind", "fam", "fam2", rank("2").alias("rank"))
    form = ["fam", "given", "gi", "ini", "more"]
    one = read.select("kind", *form).distinct()
    two = one.select("kind", "gi", *[F.col(c).alias(c + "2") for c in form if c != "gi"])
    whole = lambda s: F.concat(F.when(F.col(f"given{s}") == "", F.col(f"ini{s}")).otherwise(F.col("gi")), F.col(f"more{s}"))
    full = (F.col("given") != "") & (F.col("given2") != "")
    fits = F.when(full, (F.col("given") == F.col("given2")) & ((F.col("more") == F.col("more2")) | (F.col("more") == "") | (F.col("more2") == ""))).otherwise(whole("").startswith(whole("2")) | whole("2").startswith(whole("")))
    best = up.join(one, ["kind", "fam"]).join(two, ["kind", "fam2", "gi"]).where(fits).groupBy("kind", *form).agg(F.max_by("fam2", "rank").alias("root"))
    best = staged(best, "names-roots")
    # the family found may itself be a misspelling, for this given name
    hop = best.groupBy("kind", F.col("fam").alias("root"), "given", "gi").agg(F.max("root").alias("root2"))
    best = best.join(hop, ["kind", "root", "given", "gi"], "left").select("kind", *form, F.coalesce("root2", "root").alias("root"))
    return read.join(best, ["kind", *form], "left").withColumn("fam", F.coalesce("root", "fam")).drop("root"), apart


def _right_twice(read: DataFrame, apart: DataFrame) -> DataFrame:
    """Family names two edits away: to the best attested person of the same given name whose middle initials agree.

    Two slips, or a slip and one letter for another that tells no families `apart`; then the right name has at least twice
    the spellings.
    """
    persons = staged(read.where(f"kind = 'p' and given <> '' and length(fam) >= {LEAST_FAMILY + 2}").select("fam", "given", "more").distinct().join(read.where("kind = 'p'").groupBy("fam").agg(F.count("*").alias("spellings"), F.sum("n").alias("uses")), "fam"), "names-persons")
    near = trie_join(persons, "fam", persons, "fam", 2, swaps=True, room="given").where("query < match")
    near = near.withColumn("letters", F.pandas_udf(_paths, "string")("query", "match")).where("letters <> ''").join(apart, "letters", "left_anti").select("letters", F.col("room").alias("given"), F.explode(F.array(F.struct(F.col("query").alias("fam"), F.col("match").alias("fam2")), F.struct(F.col("match").alias("fam"), F.col("query").alias("fam2")))).alias("x")).select("letters", "given", "x.*")
    two = persons.select("given", *[F.col(c).alias(c + "2") for c in ("fam", "more", "spellings", "uses")])
    rank = lambda s: F.struct(f"spellings{s}", f"uses{s}", F.length(f"fam{s}"), f"fam{s}")
    fits = near.join(persons, ["fam", "given"]).join(two, ["fam2", "given"]).where((rank("") < rank("2")) & ((F.col("letters") == "slips") | (2 * F.col("spellings") <= F.col("spellings2"))) & ((F.col("more") == F.col("more2")) | (F.col("more") == "") | (F.col("more2") == "")))
    best = staged(fits.groupBy("fam", "given", "more").agg(F.max_by("fam2", rank("2")).alias("root")), "names-twice")
    hop = best.groupBy(F.col("fam").alias("root"), "given").agg(F.max("root").alias("root2"))
    best = best.join(hop, ["root", "given"], "left").select(F.lit("p").alias("kind"), "fam", "given", "more", F.coalesce("root2", "root").alias("root"))
    return read.join(best, ["kind", "fam", "given", "more"], "left").withColumn("fam", F.coalesce("root", "fam")).drop("root")


def name_entities(names: DataFrame, name_col: str = "name") -> DataFrame:
    """(name, entity) for the distinct non-blank names of a table; other columns are ignored."""
    counted = names.select(F.col(name_col).alias("name")).where(F.length(F.trim("name")) > 0).groupBy("name").agg(F.count("*").alias("n"))
    parsed = staged(counted.mapInPandas(_parse, _PARSED).where("a <> ''"), "names-parsed")
    read = _right_given(staged(_in_order(parsed), "names-read"))
    read = read.withColumn("gi", F.when(F.col("given") == "", F.substring("ini", 1, 1)).otherwise(F.substring("given", 1, 1)))
    # a head with the first letters of a group's further words is that group, not a person with these initials
    acronyms = read.where("kind = 'g'").select("fam", "ini", F.lit(True).alias("is_group")).distinct()
    read = read.join(acronyms, ["fam", "ini"], "left").withColumn("is_group", F.coalesce(F.col("is_group") & (F.col("given") == "") & (F.length("ini") > 2), F.lit(False)))
    read = read.withColumn("kind", F.when(F.col("is_group"), "g").otherwise(F.col("kind"))).withColumn("given", F.when(F.col("is_group"), "#").otherwise(F.col("given"))).withColumn("gi", F.when(F.col("is_group"), "#").otherwise(F.col("gi"))).drop("is_group")
    read, apart = _right_family(staged(read, "names-given"))
    return _persons(staged(_right_twice(staged(read, "names-families-right"), apart), "names-twice-right"))


def _persons(read: DataFrame) -> DataFrame:
    """Entities within families, by aggregation only."""
    full = read.where("given <> ''")
    # a given name without middle initial belongs to the one that has it, if there is only one
    mids = full.where("more <> ''").groupBy("kind", "fam", "given").agg(F.min("more").alias("m1"), F.max("more").alias("m2"))
    full = full.join(mids, ["kind", "fam", "given"], "left").withColumn("mid", F.when((F.col("more") == "") & (F.col("m1") == F.col("m2")), F.col("m1")).otherwise(F.col("more")))
    full = full.withColumn("entity", F.concat_ws("|", "kind", "fam", "given", "mid"))
    # each person's possible initials: "Anne-Marie E" is AME, AE, AM or A
    persons = full.groupBy("kind", "fam", "entity", "mid").agg(F.max_by("ini", F.struct(F.length("ini"), "ini")).alias("long"), F.min("gi").alias("g"))
    keys = persons.select("kind", "fam", "entity", F.explode(F.array_distinct(F.array(F.concat("long", "mid"), F.concat("g", "mid"), F.col("long"), F.col("g"), F.concat("long", F.substring("mid", 1, 1))))).alias("key"))
    owner = keys.groupBy("kind", "fam", "key").agg(F.min("entity").alias("e1"), F.max("entity").alias("e2"))
    # exact fit of all initials first: it is not ambiguous when another person shares only the first letter
    exact = persons.select("kind", "fam", "entity", F.explode(F.array_distinct(F.array(F.concat("long", "mid"), F.concat("g", "mid")))).alias("key")).groupBy("kind", "fam", "key").agg(F.min("entity").alias("x1"), F.max("entity").alias("x2"))
    bare = persons.where("mid = ''").select("kind", "fam", "entity", F.col("g").alias("first")).groupBy("kind", "fam", "first").agg(F.min("entity").alias("b1"), F.max("entity").alias("b2"))
    short = read.where("given = ''").withColumn("key", F.concat("ini", "more")).withColumn("first", F.substring("ini", 1, 1))
    got = short.join(exact, ["kind", "fam", "key"], "left").join(owner, ["kind", "fam", "key"], "left").join(bare, ["kind", "fam", "first"], "left")
    only = lambda a, b: F.when(F.col(a) == F.col(b), F.col(a))
    linked = got.withColumn("entity", F.coalesce(only("e1", "e2"), F.when(F.length("key") > 1, only("x1", "x2")), F.when(F.col("e1").isNull() & (F.length("key") > 1), only("b1", "b2"))))
    # initials nobody's full name explains: with the longer initials of the family that begin so, if there is one such
    rest = linked.where("entity is null")
    longer = rest.where(F.length("key") > 1).groupBy("kind", "fam", "first").agg(F.min("key").alias("k1"), F.max("key").alias("k2"))
    rest = rest.drop("entity").join(longer, ["kind", "fam", "first"], "left").withColumn("entity", F.concat_ws("|", "kind", "fam", F.lit("~"), F.when((F.length("key") == 1) & F.col("e1").isNull() & (F.col("k1") == F.col("k2")), F.col("k1")).otherwise(F.col("key"))))
    cols = ["name", "entity"]
    return full.select(cols).unionByName(linked.where("entity is not null").select(cols)).unionByName(rest.select(cols))


def near_names(names: DataFrame, name_col: str = "name") -> DataFrame:
    """(name_a, name_b, distance) of names one edit apart after their words are put in one order, by the trie join alone.

    Names of the same words are a class: its least name stands for it in the pairs with other classes, and each of its other
    names is paired with that one at distance 0.  Initials, nicknames and acronyms are further than an edit away.
    """
    ordered = F.pandas_udf(lambda s: s.map(lambda x: " ".join(sorted(fold(w) for w in _WORD.findall(x)))), "string")
    distinct = names.select(F.col(name_col).alias("name")).where(F.length(F.trim("name")) > 0).distinct().withColumn("key", ordered("name")).where("key <> ''")
    classes = staged(distinct.withColumn("least", F.min("name").over(Window.partitionBy("key"))), "names-classes")
    of = classes.select("key", "least").distinct()
    near = trie_join(of, "key", of, "key", 1, swaps=True).where("query < match")
    pairs = near.join(of.select(F.col("key").alias("query"), F.col("least").alias("x")), "query").join(of.select(F.col("key").alias("match"), F.col("least").alias("y")), "match")
    same = classes.where("name <> least").select(F.col("least").alias("name_a"), F.col("name").alias("name_b"), F.lit(0).alias("distance"))
    return pairs.select(F.least("x", "y").alias("name_a"), F.greatest("x", "y").alias("name_b"), "distance").unionByName(same)


def variant_pairs(entities: DataFrame) -> DataFrame:
    """(name_a, name_b), name_a < name_b by code point, of all pairs of spellings of an entity."""
    e = staged(entities.distinct(), "names-entities")
    return e.select("entity", F.col("name").alias("name_a")).join(e.select("entity", F.col("name").alias("name_b")), "entity").where("name_a < name_b").select("name_a", "name_b").distinct()
