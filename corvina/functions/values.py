"""Small conversions of single values as column expressions: numbers, dates, codes, lists, probabilities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvina.functions.text import bound

#: numerals of `base_n`; fixed value
NUMERALS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def base_n(n: Column, base: int = 49) -> Column:
    """The number written with letters for digits, without leading ones; zero is the first letter."""
    digit = lambda k: F.substring(F.lit(NUMERALS), F.pmod(F.floor(n / F.pow(F.lit(float(base)), k)), F.lit(base)).cast("int") + 1, F.lit(1))
    size = F.floor(F.log(F.greatest(n, F.lit(1)) + 0.5) / F.log(F.lit(float(base)))).cast("int")
    return F.array_join(F.transform(F.sequence(size, F.lit(0), F.lit(-1)), digit), "")


def char_references(text: Column) -> Column:
    """Characters beyond ASCII as numeric references."""
    return F.array_join(F.transform(F.split(text, ""), lambda c: F.when(F.ascii(c) > 127, F.concat(F.lit("&#"), F.ascii(c).cast("string"), F.lit(";"))).otherwise(c)), "")


def blanked(text: Column, pattern: str) -> Column:
    """Matches replaced by as many blanks."""
    both = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
    return F.array_join(F.transform(both, lambda x: F.concat(x["gap"], F.coalesce(F.repeat(F.lit(" "), F.length(x["hit"])), F.lit("")))), "")


def split_kept(text: Column, delimiters: str) -> Column:
    """Split before and behind each delimiter character, which stays an item; empty items go."""
    return F.filter(F.split(text, f"(?=[{delimiters}])|(?<=[{delimiters}])"), lambda x: x != "")


def change_rate(word: Column) -> Column:
    """Changes from one letter to the next, by the length."""
    changes = F.aggregate(F.transform(F.sequence(F.lit(2), F.length(word)), lambda i: F.when(F.substring(word, i, F.lit(1)) != F.substring(word, i - 1, F.lit(1)), 1).otherwise(0)), F.lit(0), lambda a, b: a + b)
    return F.when(F.length(word) > 1, changes / F.length(word)).otherwise(0.0)


def too_similar(a: Column, b: Column) -> Column:
    """Equal, or equal but for the last character."""
    return (a == b) | ((F.length(a) == F.length(b)) & (F.substring(a, F.lit(1), F.length(a) - 1) == F.substring(b, F.lit(1), F.length(b) - 1)))


def split_accession(acc: Column) -> Column:
    """struct(letters, digits, width) of an accession that is letters and digits, else null."""
    letters, digits = (F.regexp_extract(acc, "^([A-Z]+)([0-9]+)$", k) for k in (1, 2))
    return F.when(letters != "", F.struct(letters.alias("letters"), digits.alias("digits"), F.length(digits).alias("width")))


def expanded_slash(symbol: Column) -> Column:
    """PITX1/3 -> PITX1, PITX2, PITX3; Hox3a/c -> Hox3a, Hox3b (a range of letters leaves out its end); others stay."""
    part = lambda p, k: F.regexp_extract(symbol, p, k)
    nums, lets = "^(.*?)([0-9]+)/([0-9]+)$", "^(.*[0-9])([a-z])/([a-z])$"
    a, b = part(nums, 2).cast("int"), part(nums, 3).cast("int")
    by_number = F.transform(F.sequence(a, b), lambda n: F.concat(part(nums, 1), n.cast("string")))
    c, d = F.ascii(part(lets, 2)), F.ascii(part(lets, 3))
    by_letter = F.transform(F.sequence(c, d - 1), lambda n: F.concat(part(lets, 1), F.char(n)))
    return F.when(symbol.rlike(nums) & (a <= b) & (b - a <= 20), by_number).when(symbol.rlike(lets) & (c < d), by_letter).otherwise(F.array(symbol))


def author_acronyms(authors: Column) -> Column:
    """Initials of each author of 'Family, Given M; …': given first and family first."""
    first = lambda ws: F.array_join(F.transform(F.filter(ws, lambda w: w != ""), lambda w: F.upper(F.substring(w, 1, 1))), "")

    def both(a: Column) -> Column:
        family, given = F.split(F.trim(F.substring_index(a, ",", 1)), "[ -]+"), F.split(F.trim(F.regexp_extract(a, ",(.*)$", 1)), "[ .-]+")
        return F.array(F.concat(first(given), first(family)), F.concat(first(family), first(given)))

    return F.array_distinct(F.flatten(F.transform(F.split(authors, ";"), both)))


def least_year(years: Column) -> Column:
    """Least of an array of years given as text; 'noValidYear' without any number."""
    return F.coalesce(F.array_min(F.transform(F.filter(years, lambda y: y.rlike("^[0-9]+$")), lambda y: y.cast("int"))).cast("string"), F.lit("noValidYear"))


def key_values(text: Column) -> Column:
    """'a=1,b=2' as a map."""
    return F.str_to_map(text, F.lit(","), F.lit("="))


def iso_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def record_date(text: Column) -> Column:
    """12-JAN-2011 as 2011-01-12."""
    return F.date_format(F.to_date(F.initcap(F.lower(text)), "dd-MMM-yyyy"), "yyyy-MM-dd")


def placeholders_decoded(text: Column) -> Column:
    """#N#, #R# and #M# are newlines, #TAB# is a blank."""
    return F.replace(F.regexp_replace(text, "#[NRM]#", "\n"), F.lit("#TAB#"), F.lit(" "))


def diff_positions(a: Column, b: Column, most: int = 1) -> Column:
    """array<struct<pos,old,new>> where two strings of one length differ; null if they differ at more places or far apart."""
    places = F.filter(F.transform(F.sequence(F.lit(1), F.length(a)), lambda i: F.struct((i - 1).alias("pos"), F.substring(a, i, F.lit(1)).alias("old"), F.substring(b, i, F.lit(1)).alias("new"))), lambda x: x["old"] != x["new"])
    near = lambda p: (F.size(p) >= 1) & (F.size(p) <= most) & (F.element_at(p, -1)["pos"] - F.element_at(p, 1)["pos"] == F.size(p) - 1)
    return bound(places, lambda p: F.when((F.length(a) == F.length(b)) & near(p), p))


def log_factorial(n: Column) -> Column:
    return F.aggregate(F.sequence(F.lit(0), n.cast("int")), F.lit(0.0), lambda acc, k: acc + F.when(k > 1, F.log(k.cast("double"))).otherwise(0.0))


def log_choose(n: Column, k: Column) -> Column:
    return log_factorial(n) - log_factorial(k) - log_factorial(n - k)


def binomial(k: Column, n: Column, p: Column) -> Column:
    """Probability of k successes in n."""
    return F.exp(log_choose(n, k) + k * F.log(p) + (n - k) * F.log(1 - p))


def poisson(k: Column, mean: Column) -> Column:
    return F.exp(k * F.log(mean) - mean - log_factorial(k))


def hypergeometric(k: Column, total: Column, marked: Column, drawn: Column) -> Column:
    """Probability of k marked ones among those drawn."""
    return F.exp(log_choose(marked, k) + log_choose(total - marked, drawn - k) - log_choose(total, drawn))
