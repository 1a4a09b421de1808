"""The training-data operators on small cases: results, nulls, empty tables, repeats, ties, clashing columns."""

import random

import pytest

from corvina.llm import canonical, encoding, leaks, markup, names, packing, queries, reading_level, scans, survivors, trie_join

BEL = "\x07"


def rows(df):
    return sorted(map(tuple, df.collect()))


# 1 names


def test_trie_join_against_brute_force(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(3, 8))) for _ in range(150)})

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i] + [min(row[j] + (x != y), row[j + 1] + 1) for j, y in enumerate(b)]
            for j in range(1, len(row)):
                row[j] = min(row[j], row[j - 1] + 1)
        return row[-1]

    def osa(a, b):
        two, one = [], list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i]
            for j, y in enumerate(b, 1):
                row.append(min(one[j] + 1, row[-1] + 1, one[j - 1] + (x != y), two[j - 2] + 1 if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y else 99))
            two, one = one, row
        return one[-1]

    d = spark.createDataFrame([(w,) for w in words] + [(None,), ("",)], "w string")
    for k, swaps, far in ((1, False, lev), (2, False, lev), (1, True, osa), (2, True, osa)):
        want = {(a, b, far(a, b), "") for a in words for b in words if a != b and far(a, b) <= k}
        got = rows(trie_join.trie_join(d, "w", d, "w", k, swaps=swaps))
        assert len(got) == len(set(got)) and set(got) == want
    assert trie_join.trie_join(d.limit(0), "w", d, "w", 2).count() == 0


def test_trie_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie_join, "BLOCK", 2)
    d = spark.createDataFrame([("abcdef",), ("abcdeg",), ("abcdeh",), ("abcdei",)], "w string")
    assert trie_join.trie_join(d, "w", d, "w", 1).count() == 12
    monkeypatch.setattr(trie_join, "ASKED", 3)
    assert trie_join.trie_join(d, "w", d, "w", 1).count() == 12


def test_trie_rooms(spark):
    d = spark.createDataFrame([("abc", "x"), ("abd", "x"), ("abe", "y"), ("abf", None)], "w string, r string")
    assert rows(trie_join.trie_join(d, "w", d, "w", 1, room="r")) == [("abc", "abd", 1, "x"), ("abd", "abc", 1, "x")]


def test_names(spark):
    given = ["William", "Jana", "Robert", "Ursula"]
    filler = [f"{f}, {g}" for g in given for f in (f"{a}{b}and" for a in ("Bo", "Ki", "Lu", "Mo", "Ze") for b in ("fop", "tuk", "wim", "rux"))]
    said = ["Vosek, William K", "Vosek, William", "VOSEK, WILLIAM K", "William K Vosek", "William K. Vosek", "Vosek WK", "Vosek, Bill", "Vosek, Wililam K", "Dr William K Vosek", "Vosek, Jana", "Vosek J", "Tamuva Kidney Study Group", "The Tamuva Kidney Study Group", "Study Group Tamuva Kidney", "Tamuva KSG"]
    d = spark.createDataFrame([(n, 1) for n in filler + said + said[:2]] + [(None, 1), (" ", 1)], "name string, entity int")
    e = {r["name"]: r["entity"] for r in names.name_entities(d).collect()}
    assert len({e[n] for n in said[:9]}) == 1
    assert e["Vosek, Jana"] == e["Vosek J"] != e["Vosek, William"]
    assert len({e[n] for n in said[11:]}) == 1
    pairs = names.variant_pairs(names.name_entities(d.where("name like '%Vosek%'"))).collect()
    assert pairs and all(r["name_a"] < r["name_b"] for r in pairs)
    assert names.name_entities(d.limit(0)).count() == 0


def _entities(spark, said):
    return {r["name"]: r["entity"] for r in names.name_entities(spark.createDataFrame([(n,) for n in said], "name string")).collect()}


FORMS = ["{}, Jana", "{} J", "Jana {}", "J. {}"]


def test_misspelt_family_in_many_forms(spark):
    # however often either is written: the forms of a misspelling are those of the name
    for times in (1, 5):
        e = _entities(spark, [f.format("Voseko") for f in FORMS] + [f.format("Vosekko") for f in [*FORMS, "{}, J", "Dr Jana {}"]] * times)
        assert e["Voseko, Jana"] == e["Vosekko, Jana"] == e["Voseko J"]


def test_letters_that_tell_families_apart(spark):
    # families that differ by e and i have other given names; the one that has the same is another family too
    said = [n for a, b in (("Larsen", "Larsin"), ("Modem", "Modim"), ("Tuleko", "Tuliko")) for n in (f"{a}, William", f"{b}, Robert")]
    said += ["Voseko, Jana", "Vosiko, Jana", "Hartuko, Ursula", "Hartufo, Ursula"]
    e = _entities(spark, said)
    assert e["Voseko, Jana"] != e["Vosiko, Jana"] and e["Hartuko, Ursula"] == e["Hartufo, Ursula"]


def test_family_two_slips_away(spark):
    e = _entities(spark, ["Lubuhawood, Ruben M", "Lubuhawood RM", "Ruben M. Lubuhawood", "Lubbuhawwood, Ruben M", "Lubbuhawwood, Jana", "Cabuhawood, Ruben M"])
    assert e["Lubuhawood, Ruben M"] == e["Lubuhawood RM"] == e["Lubbuhawwood, Ruben M"]
    assert len({e["Lubbuhawwood, Jana"], e["Cabuhawood, Ruben M"], e["Lubuhawood, Ruben M"]}) == 3


def test_family_a_slip_and_a_letter_away(spark):
    e = _entities(spark, ["Kofulaford, Ruben", "Ruben Kofulaford", "Kofulaford R", "Kofulafootd, Ruben", "Lirator, Jana", "Mirrator, Jana"])
    assert e["Kofulaford, Ruben"] == e["Kofulafootd, Ruben"] and e["Lirator, Jana"] != e["Mirrator, Jana"]


def test_given_names_are_read_by_the_family(spark):
    many = [f"F{a}{b}nd, {g}" for a in "aeiou" for b in ("bo", "ku", "li") for g in ("Jana", "Leila")]
    e = _entities(spark, [*many, "Cepegokamp, Jana V", "Cepegokamp, Jaan V", "Cepegokamp JV", "Zulo, Johannes", "Zulo, Jan", "Tepo, Jana", "Tepo, Jan"])
    assert e["Cepegokamp, Jana V"] == e["Cepegokamp, Jaan V"] == e["Cepegokamp JV"] and "jana" in e["Cepegokamp JV"]
    assert e["Zulo, Johannes"] == e["Zulo, Jan"] and e["Tepo, Jana"] == e["Tepo, Jan"]


def test_both_orders_of_two_words(spark):
    e = _entities(spark, ["Fumo, Tarvi", "Fumo, Tarvi", "Tarvi, Fumo"])
    assert e["Fumo, Tarvi"] == e["Tarvi, Fumo"]


def test_parsed_names():
    assert names.parse_name("von Retozor DR")[1:4] == ("retozor", "", "dr") and names.parse_name("Jakob Vikuba MD")[1:3] == ("vikuba", "jakob")
    assert names.parse_name("Antonia, al-Gopilax")[1:3] == ("antonia", "gopilax") and names.parse_name("Lee, Jean-Luc")[2] == "jeanluc"
    assert names.parse_name("VAN DER GABEV JA")[1:4] == ("gabev", "", "ja") and names.parse_name("de la Lonix BV")[1:4] == ("lonix", "", "bv")
    assert names.parse_name("ZADEGOD, ZO\u00c9")[2] == "zoe" and names.parse_name("MAVEK, JN")[2:4] == ("", "jn")


def test_near_names(spark):
    d = spark.createDataFrame([(n,) for n in ("Vosek, Jana", "Jana Vosek", "VOSEK JANA", "Vosek, Janna", "Vosek, Robert", None, "", "Vosek, Jana")], "name string")
    assert rows(names.near_names(d)) == [("Jana Vosek", "VOSEK JANA", 0), ("Jana Vosek", "Vosek, Jana", 0), ("Jana Vosek", "Vosek, Janna", 1)]
    assert names.near_names(d.limit(0)).count() == 0


# 2 scans


def _scan_table(spark):
    words = "the patients treated with modern medicine showed improvement during observation while controls remained unchanged after several months of careful examination by experienced clinicians"
    good = [(i, f"{words} {i}.{BEL}{words[:60]} again.") for i in range(60)]
    page = BEL.join(["ARCH KIDNEY RES   12", "patients trcated with modern medi-", "cine showed improvement, pre- and", "post- and later exam ination was", "", "– 13 –"])
    return spark.createDataFrame([*good, (100, page), (101, None), (102, ""), (103, "one line only")], "fileid long, content string")


def test_scans(spark):
    t = _scan_table(spark)
    got = {(r["lineno"], r["kind"]) for r in scans.damaged_lines(t).where("fileid = 100").collect()}
    assert {(1, "furniture"), (6, "furniture"), (2, "break"), (2, "garble"), (4, "garble")} <= got and (3, "break") not in got
    text = {r["fileid"]: r["text"] for r in scans.repaired_pages(t).collect()}
    assert "treated with modern medicine showed" in text[100] and "ARCH" not in text[100]
    assert text[101] is None and text[102] == "" and text[103] == "one line only"
    assert scans.damaged_lines(t.limit(0)).count() == 0


def test_signs_read_for_letters(spark):
    good = [(i, f"the outcome of calcium treatment was recorded{BEL}and the results were as expected {i}.") for i in range(60)]
    t = spark.createDataFrame([*good, (100, f"the outcome of c@lcium was{BEL}well known to lab7@x.example and @home.{BEL}the tre@tment, of")], "fileid long, content string")
    assert rows(scans.damaged_lines(t)) == [(100, 1, "garble"), (100, 3, "garble")]
    assert "of calcium was well known to lab7@x.example and @home. the treatment, of" in {r["fileid"]: r["text"] for r in scans.repaired_pages(t).collect()}[100]


def test_words_divided_without_hyphen(spark):
    good = [(i, f"the outcome of calcium treatment was recorded{BEL}and the results were comparable in the end {i}.") for i in range(60)]
    t = spark.createDataFrame([*good, (100, f"the outcome was com{BEL}parable in the end{BEL}and the results were recorded in the{BEL}end.")], "fileid long, content string")
    assert rows(scans.damaged_lines(t)) == [(100, 1, "break")]
    assert {r["fileid"]: r["text"] for r in scans.repaired_pages(t).collect()}[100] == "the outcome was comparable in the end and the results were recorded in the end."


def test_names_are_no_misread_words(spark):
    good = [(i, f"the outcome of calcium treatment was recorded{BEL}and the results were comparable in the end {i}.") for i in range(60)]
    t = spark.createDataFrame([*good, (100, f"the results of Resuft{BEL}Trealment were recorded{BEL}in the end. Oufcome was{BEL}recorded in Wos")], "fileid long, content string")
    assert scans.is_name("Danel", "of") and not scans.is_name("Danel", "end.") and not scans.is_name("danel", "of") and not scans.is_name("Trealment", "of") and not scans.is_name("Danel", "")
    assert (100, 1, "garble") not in rows(scans.damaged_lines(t)) and (100, 2, "garble") in rows(scans.damaged_lines(t))


def test_page_with_a_long_line(spark):
    page = BEL.join(["ARCH KIDNEY RES   12", "patients treated with modern medi-", "cine showed improvement", "during observation of the patients"] * 2)
    t = _scan_table(spark).unionByName(spark.createDataFrame([(200, page), (201, page + BEL + "controls " * 15), (202, page + BEL + "controls " * 400)], "fileid long, content string"))
    got = rows(scans.damaged_lines(t.unionByName(t)))
    by_file = {i: [x[1:] for x in got if x[0] == i] for i in (200, 201, 202)}
    assert by_file[200] and by_file[201] == by_file[200] and not by_file[202]


def test_rare_words_are_counted(spark):
    # more files than hold a word of the vocabulary: its own count still tells whether it is misread
    good = [(i, f"the outcome of treatment was recorded{BEL}and the results were as expected {i}.") for i in range(400)]
    t = spark.createDataFrame([*good, (1000, f"the oufcome of it was{BEL}well recorded.")], "fileid long, content string")
    assert rows(scans.damaged_lines(t)) == [(1000, 1, "garble")]
    # as often written so as not, it is a word
    t = spark.createDataFrame([*good, *[(1000 + i, f"the oufcome of it was{BEL}well recorded {i}.") for i in range(60)]], "fileid long, content string")
    assert rows(scans.damaged_lines(t)) == []


def test_right_words_outside_the_vocabulary(spark):
    # 20 of 60,000 files hold embolism: too few for the vocabulary in memory, far more than hold its damaged forms
    words = "the patients treated with modern medicine showed improvement during observation while controls remained unchanged after several months"
    many = spark.range(60000).selectExpr("id AS fileid", f"concat('{words} ', id) AS content")
    page = BEL.join(["the patients with cmbolism showed", "improvement after embo lism while", "controls treated with embo", "lism remained unchanged with", "CMBOLISM7 several months of observation."])
    t = many.unionByName(spark.createDataFrame([*((100000 + i, "controls with embolism") for i in range(20)), (200000, page)], "fileid long, content string"))
    assert "embolism" not in scans.vocabulary(t)[1]
    assert rows(scans.damaged_lines(t)) == [(200000, 1, "garble"), (200000, 2, "garble"), (200000, 3, "break")]
    text = scans.repaired_pages(t).where("fileid = 200000").collect()[0]["text"]
    assert text.startswith("the patients with embolism showed") and "treated with embolism remained" in text
    assert "with CMBOLISM7 several" in text
    # held by as few files, the misread form is a word
    t = t.unionByName(spark.createDataFrame([(300000 + i, "controls with cmbolism") for i in range(3)], "fileid long, content string"))
    assert rows(scans.damaged_lines(t)) == [(200000, 2, "garble"), (200000, 3, "break")]


def test_editor_learns():
    vocab = {w: 100 for w in "patients treatment medicine observation improvement clinical different community important government".split()}
    editor = scans.trained_editor(vocab)
    assert "treatment" in list(editor.candidates("trcatment"))
    no, one, two = (False, True, False), (False, False, True), (True, True, False)
    for before, after, seen, joined in (("medi", "cine", one, True), ("long", "term", two, True), ("pre", "and", no, False), ("Prä", "und", two, False), ("", "and", no, False), ("", "cine", no, False)):
        assert editor.joins(before, "-", after, seen) is joined
    assert scans.apply_edits("rnedicine", {0: "Rm", 1: "D"}) == "medicine"


# 3 markup


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("<p>a &amp; b</p><h2>T</h2><ul><li>x</li></ul>", {("html", "inline"), ("html", "heading"), ("html", "list")}),
        ("&lt;table&gt;&lt;tr&gt;&lt;td&gt;x&lt;/td&gt;&lt;/tr&gt;&lt;/table&gt;", {("html", "table")}),
        (f"== T =={BEL}*a{BEL}*b{BEL}[[x|y]] <math>\\frac{{a}}{{b}}</math>", {("wiki", "heading"), ("wiki", "list"), ("wiki", "inline"), ("wiki", "formula")}),
        (f"# T{BEL}{BEL}- a{BEL}- b{BEL}{BEL}```{BEL}x = [1]{BEL}```{BEL}{BEL}| a | b |{BEL}|---|---|{BEL}| 1 | 2 |", {("markdown", "heading"), ("markdown", "list"), ("markdown", "code"), ("markdown", "table")}),
        ("\\section{T} \\emph{x} \\[a_1\\] \\begin{itemize}\\item y\\end{itemize}", {("latex", "heading"), ("latex", "inline"), ("latex", "formula"), ("latex", "list")}),
        ("Each kit costs $40 to $60. A & B denote arms, n < 30 and p > 0.2. Values * or ** differ. The ratio {a:b}. <lab7@x.example>", set()),
        (f"x{BEL}{BEL}| Gene | N |{BEL}|---|:--|{BEL}| A | 3 |", {("markdown", "table")}),
        (f"x{BEL}{BEL}1. a{BEL}1. b{BEL}{BEL}y", {("markdown", "list")}),
        (f"in{BEL}2005. More of it (a ={BEL}1) here", set()),
        (f"== T =={BEL}# one item{BEL}and [[x]]", {("wiki", "heading"), ("wiki", "list"), ("wiki", "inline")}),
        ("", set()),
        (None, set()),
    ],
)
def test_structures(text, want):
    assert set(markup.structures(text)) == want


def test_clean(spark):
    assert markup.clean(f"<h2>T</h2><p>a <b>b</b> &amp; c</p><ul><li>x</li></ul>") == "## T\na b & c\n\n- x"
    assert markup.clean(f"== T =={BEL}'''a''' [[x|y]]") == "## T\na y"
    t = spark.createDataFrame([(1, "<p>x</p>", "s"), (2, None, "s")], "fileid long, content string, text string")
    assert rows(markup.cleaned_texts(t)) == [(1, "x"), (2, None)]
    assert markup.marked_structures(t.limit(0)).count() == 0
    assert markup.clean("***Very*** good\n**Bold** too\n\n*a\n*b") == "Very good\nBold too\n\n- a\n- b"
    assert markup.clean("<p>" + "x " * 200_000 + "</p>").startswith("x x")


def test_frames_are_left_out():
    page = ["<html><body>", '<div><a href="/">Home</a> <a href="/a">Go</a> <a href="/b">Us</a></div>', '<div><a href="/c">Login</a> <a href="/d">Map</a></div>', "<p>", "The patients were treated at home for twelve weeks.", "No <b>other</b> <i>effect</i> was <sub>ever</sub> seen in the controls.", "</p>", "<ul>", "<li>first item of the list of results</li>", "<li>second item of the list of results</li>", "</ul>", "<table><tr><td>1</td><td>2</td></tr></table>", "<pre>x = 1</pre>", "</body></html>"]
    got = markup.clean("\n".join(page))
    assert "Home" not in got and "Login" not in got
    assert "treated at home for twelve weeks" in got and "No other effect was ever seen" in got
    assert "- first item of the list of results\n- second item" in got and "1 | 2" in got and "```\nx = 1\n```" in got
    # nothing but tags that are none, and marks cut off
    assert markup.clean("n < 30 and p > 0.2 <lab7@x.example> a & b <p") == "n < 30 and p > 0.2 <lab7@x.example> a & b <p"


def test_long_formulas_and_many_lines():
    import time

    body = "x_1 + " * 500 + "x"
    assert ("latex", "formula") in markup.structures(f"\\emph{{a}} ${body}$ b") and markup.clean(f"a ${body}$ b") == f"a ${body}$ b"
    began = time.time()
    assert markup.structures("\n".join(f"* item {i} '''x'''" for i in range(8000))) and markup.clean("<li>x</li>\n" * 8000)
    assert time.time() - began < 5


# 4 canonical entries


def test_canonical(spark):
    j = spark.createDataFrame([(1, "Journal of Kidney Repair", "J Kidney Repair", "1", "2"), (2, "Annals of Kidney Repair", None, "3", None), (3, "Letters in Plant Ecology", None, "5", None)], "journalid long, title string, isoabbrev string, printissn string, eissn string")
    p = spark.createDataFrame([(7, "Wajuburg Academic Press", "wajub0", "Fenigrad")], "publisherid long, pubname string, code string, city string")
    typed = ["Journal of Kidney Repair", "the journal of kidney repair (Print)", "Anals of Kidny Repair", "Kidney Repair, Annals of", "Lett Plant Ecol", "Annals of Choral Music", "NotSpecified", None, ""]
    a = spark.createDataFrame([(i, v, "Wajuburg Acadmic Press, Inc.", "", None, 5) for i, v in enumerate(typed)] + [(1, typed[1], "wajub0", "", None, 5)], "articleid long, journal string, publisher string, printissn string, eissn string, entryid int")
    got = {(r["articleid"], r["field"]): r["entryid"] for r in canonical.map_articles(a, j, p).collect()}
    assert [got.get((i, "journal")) for i in range(9)] == [None, 1, 2, 2, 3, 0, 0, None, None]
    assert got[(0, "publisher")] == 7
    assert canonical.map_articles(a.limit(0), j, p).count() == 0


def test_near_forms_against_brute_force(spark):
    from math import log, sqrt

    rng = random.Random(4)
    words = "journal kidney repair plant ecology annals letters music choral acute review heart".split()
    names = sorted({" ".join(rng.sample(words, 3)) for _ in range(25)})
    typed = sorted({" ".join(rng.sample(words, rng.randrange(1, 4))) for _ in range(25)} | {"zzz"})
    e = spark.createDataFrame([("f", i, n, None, None, None) for i, n in enumerate(names)], "field string, entryid long, name string, short string, code string, place string")
    v = spark.createDataFrame([("f", t) for t in typed], "field string, norm string")
    got = {(r["norm"], r["entryid"], r["form"]): r["score"] for r in canonical.near_forms(v, e, 0.3, 0.25).collect()}
    written = {(i, k): canonical.grams(f) for i, n in enumerate(names) for k, f in enumerate(canonical.forms(n, None, None, None))}
    df = {}
    for g in {g for x in written.values() for g in x}:
        df[g] = len({i for (i, _), x in written.items() if g in x})
    weight = lambda x: {g: sqrt(n) * log(1 + len(names) / df.get(g, 1)) for g, n in x.items()}
    norm = lambda w: sqrt(sum(y * y for y in w.values()))
    want = {}
    for t in typed:
        a = weight(canonical.grams(t))
        scores = {k: sum(x * weight(b).get(g, 0) for g, x in a.items()) / norm(a) / norm(weight(b)) for k, b in written.items()}
        top = max(scores.values())
        want |= {(t, *k): s for k, s in scores.items() if s >= 0.3 and s >= top - 0.25}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-5 for k in got)


# 6 survivors


def test_survivors(spark):
    cols = "articleid long, source string, pmid string, doi string, title string, pubyear string, vol string, page string, authors string, abstract string, journal string, convtime string, updateid int, component int"
    base = ("A study of kidney repair in mice", "2015", "3", "77", "Vosek, Jana")
    d = [(3, "crawler", "60000021", "https://doi.example/10.1234/AB.1.", *base, None, None, "t", 3, 0), (2, "medline", "PMID: 60000012", None, *base, None, None, "t", 2, 0), (1, "pmc", "60,000,012", "10.1234/ab.1", *base, None, None, "t", 1, 0), (1, "pmc", "60,000,012", "10.1234/ab.1", *base, None, None, "t", 4, 0), (9, "pmc", None, "10.1234/ab.1", "Quite another paper on plants", "2001", "9", "1", "Other, Name", None, None, "t", 1, 0), (10, None, None, None, None, None, None, None, None, None, None, None, None, None)]
    assert rows(survivors.surviving_records(spark.createDataFrame(d, cols)).select("articleid", "pmid", "doi")) == [(1, "60000012", "10.1234/ab.1")]
    assert survivors.surviving_records(spark.createDataFrame([], cols)).count() == 0
    assert survivors.clean_pmid("60276587.0") == "60276587" and survivors.clean_pmid("n/a") == "" and survivors.clean_doi("10.") == "" and survivors.clean_doi("10.99%2Fx") == "" and survivors.clean_doi("10. 9934%2FJ1.2;") == "10.9934/j1.2"


def test_window_order_and_vote(spark):
    from corvina.llm.queries import QUERIES

    cols = "articleid long, source string, pmid string, doi string, title string, pubyear string, vol string, page string, authors string, abstract string, journal string, convtime string, updateid int"
    base = ("A study of kidney repair in mice", "2015", "3", "77", "Vosek, Jana")
    d = spark.createDataFrame([(i, "crawler", "60000012", "10.1234/wrong", *base, None, None, "t", 1) for i in (1, 2)] + [(3, "medline", "60000012", "10.1234/right", *base, "Text", "J Kidney", "t", 1)], cols)
    assert rows(survivors.surviving_records(d, vote=False).select("articleid", "pmid", "doi")) == [(1, "60000012", "10.1234/right")]
    assert rows(survivors.surviving_records(d).select("articleid", "pmid", "doi")) == [(1, "60000012", "10.1234/wrong")]
    assert [q for q in QUERIES if q.startswith("p6_")][:2] == ["p6_method", "p6_found"]


def test_components(spark):
    d = spark.createDataFrame([(i, k) for i in range(30) for k in (f"a{i}", f"a{i + 1}")] + [(100, "z")], "id long, key string")
    assert {r["component"] for r in survivors.components(d, "id", "key").collect()} == {0}


# 7 encodings


@pytest.mark.parametrize("wrong", ["cp1252", "latin-1", "cp1250", "mac-roman", "cp437"])
def test_utf8_read_wrongly(wrong):
    for text in ("Naïve médecin – señor", "10⁵ cells ± 0.4 β-subunit", "żółć und Überschuss"):
        bad = "".join(encoding._decode(c.encode(), wrong) if ord(c) > 127 else c for c in text)
        assert encoding.is_garbled(bad) and not encoding.is_garbled(text)
        assert encoding.repair(bad) == text


def test_cyrillic_and_mixed():
    text = "Поздняя диагностика у детей"
    assert not encoding.is_garbled(text) and not encoding.is_garbled(text.upper())
    for wrong in ("cp1252", "koi8-r"):
        assert encoding.repair(text.encode("cp1251").decode(wrong, "replace")) == text
    assert encoding.repair("Já está: naÃ¯ve") == "Já está: naïve"
    assert encoding.repair("DiagnÃƒÂ³stico") == "Diagnóstico"
    assert encoding.is_garbled("na�ve") and not encoding.is_garbled("SÃO, ÂGE, stœchiométrie, “ok”")
    assert not encoding.is_garbled(None) and not encoding.is_garbled("") and encoding.repair(None) is None


def test_repair_leaves_correct_text():
    right, bad = "Лечение детей с анемией проводили дома", "Поздняя диагностика у детей и пожилых"
    for true, wrong in (("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("cp1251", "cp1252"), ("cp866", "cp1251")):
        garbled = bad.encode(true).decode(wrong, "replace")
        for sep in (". ", BEL, "\n"):
            assert encoding.repair(right + sep + garbled) == right + sep + bad
            assert encoding.repair(garbled + sep + right) == bad + sep + right
    garbled = bad.encode("cp1251").decode("cp1252")
    for latin in ("Café naïve “quote” é", "Señor Müller à Škoda"):
        for sep in (". ", " ", ", "):
            assert encoding.repair(latin + sep + garbled) == latin + sep + bad
            assert encoding.repair(garbled + sep + latin) == bad + sep + latin


def test_repair_of_deep_garbling():
    text = bad = "Diagnóstico"
    for _ in range(5):
        bad = bad.encode().decode("latin-1")
    assert encoding.repair(bad) == text


def test_garbled_records(spark):
    d = spark.createDataFrame([("title", 1, "naÃ¯ve", 0), ("title", 1, "naÃ¯ve", 1), ("content", 2, "fine é", 0), ("content", 3, None, 0)], "field string, recordid long, text string, repaired int")
    assert rows(encoding.garbled_records(d)) == [("title", 1)]
    assert rows(encoding.repaired_records(d)) == [("title", 1, "naïve")]
    assert encoding.garbled_records(d.limit(0)).count() == 0


# 8 packing


def test_pack_histogram_is_exact():
    rng = random.Random(2)
    for _ in range(30):
        cap = rng.randrange(5, 60)
        hist = {n: rng.randrange(1, 30) for n in rng.sample(range(1, cap + 1), min(cap, 12))}
        packs = packing.pack_histogram(hist, cap)
        assert all(sum(n * c for n, c in p.items()) <= cap for _, p in packs)
        assert {n: sum(k * p.get(n, 0) for k, p in packs) for n in hist} == hist
    assert sum(k for k, _ in packing.pack_histogram({10: 100}, 100)) == 10
    with pytest.raises(ValueError):
        packing.pack_histogram({11: 1}, 10)


def test_pack_documents(spark):
    rng = random.Random(5)
    counts = [(i, rng.choice([3, 3, 3, 40, 7, 0, 250])) for i in range(300)]
    d, c = spark.createDataFrame(counts, "doc_id long, tokens long"), spark.createDataFrame([(1, "a", 100), (2, "b", 41)], "container_id long, label string, capacity_tokens int")
    got = packing.pack_documents(d, c).collect()
    for cid, cap in ((1, 100), (2, 41)):
        part = [r for r in got if r["container_id"] == cid]
        assert len({(r["doc_id"], r["piece"]) for r in part}) == len(part)
        assert {i: sum(r["tokens"] for r in part if r["doc_id"] == i) for i, _ in counts} == dict(counts)
        size = {}
        for r in part:
            if r["pack_id"] is not None:
                size[r["pack_id"]] = size.get(r["pack_id"], 0) + r["tokens"]
        assert max(size.values()) <= cap and sum(size.values()) / len(size) / cap > 0.9
        assert all(r["piece"] == 0 for r in part if dict(counts)[r["doc_id"]] <= cap)
        assert all((r["pack_id"] is None) == (r["tokens"] == 0) for r in part)
    assert packing.pack_documents(d.limit(0), c).count() == 0


def test_token_counts(spark):
    counter = packing.TokenCounter("/opt/tokenizers/byte_bpe_50k.tiktoken")
    for t in ("Hello big world\nnew  line \n x", " lead", "a b", "", "naïve β 10⁵"):
        assert counter(t) == len(counter.encoding.encode_ordinary(t))
    assert counter(None) == 0


# 9 leaks


def test_leaks(spark):
    passage = "Crossing HPP10-null with HEX8-c.413delG lines yielded 250 offspring, 28% of which lost histone acetylation by day 20 and showed rescue. This work was supported by the usual public funds and the funders had no role."
    frame = "Crossing ABC1-null with XYZ2-c.99A>T lines yielded 31 offspring, 77% of which lost histone acetylation by day 9 and showed rescue."
    other = "Crossing QQ7-null with RR9-c.5C>T lines yielded 12 offspring, 13% of which lost histone acetylation by day 2 and showed rescue."
    items = spark.createDataFrame([(1, passage, "Which allele of HPP10 restores growth once dose exceeds 15.8 nM for 16 days?", 0), (2, other, None, 0), (3, None, None, 0)], "item_id long, passage string, question string, doc_id int")
    fill = "Some ordinary text about other matters entirely. " * 3
    docs = [(1, fill + passage.upper().replace(",", " ;\n") + fill), (2, fill + frame + fill), (3, fill + "This work was supported by the usual public funds and the funders had no role. " + fill), (4, "the phrase HEX8-c.413delG lines yielded 250 offspring is known"), (5, fill + "HPP10-null with HEX8-c.413delG strains yielded 250 оffspring, 28% of which lost histone acetylation" + fill), (6, None), (7, "")]
    docs += [(i, "This work was supported by the usual public funds and the funders had no role.") for i in range(10, 40)]
    d = spark.createDataFrame([*docs, docs[0]], "doc_id long, text string")
    assert rows(leaks.leaked_documents(d, items)) == [(1, 1), (5, 1)]
    assert leaks.leaked_documents(d.limit(0), items).count() == 0
    assert leaks.leaked_documents(d, items.limit(0)).count() == 0


def test_leaks_of_a_passage_that_many_items_share(spark):
    passage = "Crossing HPP10-null with HEX8-c.413delG lines yielded 250 offspring, 28% of which lost histone acetylation by day 20 and showed rescue."
    other = "Crossing QQ7-null with RR9-c.5C>T lines yielded 12 offspring, 13% of which lost histone acetylation by day 2."
    for many in (1, 3, 4, 10):
        items = spark.createDataFrame([(i, passage, f"Question {i}?") for i in range(many)] + [(99, other, None)], "item_id long, passage string, question string")
        d = spark.createDataFrame([(1, "Before it. " + passage + " After it."), (2, "Nothing of the kind.")], "doc_id long, text string")
        assert rows(leaks.leaked_documents(d, items)) == [(1, i) for i in range(many)]


def test_leak_blocks(spark, monkeypatch):
    monkeypatch.setattr(leaks, "BLOCK_WORDS", 30)
    test_leaks(spark)


def test_leaks_of_a_part_with_shingles_of_many_items(spark):
    # all pairs of words but two stand in every item; the numbers are the items' own, though shared
    items = spark.createDataFrame([(i, f"Seen over 16 visits the volunteers given {w} lost 40 kg and kept acuity near 12 and reported headaches.", None) for i, w in enumerate("fipumab hozerol kudistat wanivir lecyclin".split())], "item_id long, passage string, question string")
    fill = "Some ordinary text about other matters entirely. " * 3
    docs = [f"volunteers given {w} lost 40 kg and kept acuity near 12 and" for w in ("kudistat", "placebo")]
    d = spark.createDataFrame([(i, fill + x + " " + fill) for i, x in enumerate(docs)], "doc_id long, text string")
    assert rows(leaks.leaked_documents(d, items)) == [(0, 2)]


def test_leaks_of_an_item_in_a_third_of_the_documents(spark):
    passage = "Crossing HPP10-null with HEX8-c.413delG lines yielded 250 offspring, 28% of which lost histone acetylation by day 20 and showed rescue."
    items = spark.createDataFrame([(1, passage, None), (2, "Crossing QQ7-null with RR9-c.5C>T lines yielded 12 offspring, 13% of which lost histone acetylation by day 2.", None)], "item_id long, passage string, question string")
    part = "HPP10-null with HEX8-c.413delG lines yielded 250 offspring, 28% of which lost histone acetylation"
    d = spark.createDataFrame([(i, f"Text {i} about other matters. " + (passage if i % 6 == 0 else part if i % 6 == 3 else "") + " More of it.") for i in range(300)], "doc_id long, text string")
    assert rows(leaks.leaked_documents(d, items)) == [(i, 1) for i in range(0, 300, 3)]


# 10 reading level


def test_coverage_rank_is_exact(spark, monkeypatch):
    from math import ceil, log1p

    rng = random.Random(6)
    texts = ["the of and " + " ".join(f"w{'abcdefghij'[rng.randrange(10)]}{'abcdefghij'[min(9, int(rng.expovariate(0.4)))]}" for _ in range(rng.randrange(5, 60))) for _ in range(40)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    count = {}
    for t in texts:
        for w in t.split():
            count[w] = count.get(w, 0) + 1
    rank = {w: 1 + sum(m > n for m in count.values()) for w, n in count.items()}
    for held in (20_000, 20, 1):
        monkeypatch.setattr(reading_level, "VOCABULARY", held)
        got = {r["doc_id"]: r for r in reading_level.document_measures(d).collect()}
        for i, t in enumerate(texts):
            r = sorted(rank[w] for w in t.split())
            for s in reading_level.SHARES:
                assert abs(got[i][f"cover{int(100 * s)}"] - log1p(r[max(0, ceil(s * len(r)) - 1)])) < 1e-9


def test_reading_levels(spark):
    simple = "The cat and the dog run. You can see it. It is big. "
    hard = "The stoichiometric reconstitution of heterozygous immunoprecipitates delineated constitutive haploinsufficiency, notwithstanding thermodynamic destabilisation of the interface. "
    docs = [(i, (simple if i % 2 else hard) * (3 + i % 5), "en", i) for i in range(80)] + [(100, None, "en", 0), (101, "", "en", 0)]
    d = spark.createDataFrame([*docs, docs[0]], "doc_id long, text string, lang string, grade int")
    labels = spark.createDataFrame([(i, "r", 1 if i % 2 else 4) for i in range(40)] + [(0, "s", 3), (5, "s", None)], "doc_id long, rater string, grade int")
    got = {r["doc_id"]: r["grade"] for r in reading_level.reading_levels(d, labels).collect()}
    assert len(got) == 82 and all(got[i] == (1 if i % 2 else 4) for i in range(80))
    assert reading_level.reading_levels(d, labels.limit(0)).count() == 0
    assert reading_level.reading_levels(d.limit(0), labels).count() == 0


# registered queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_queries(spark, sf, name):
    columns = {"p1_found": "name_a name_b", "p2_found": "fileid lineno kind", "p3_found": "fileid syntax structure", "p4_found": "articleid field entryid", "p6_found": "articleid pmid doi", "p7_found": "field recordid", "p9_found": "doc_id item_id", "p10_found": "doc_id grade"}
    df = queries.QUERIES[name](spark, sf)
    got = df.collect()
    assert got and (name not in columns or df.columns == columns[name].split())
    if name in columns:
        assert len(set(map(tuple, got))) == len(got)
        assert all(v is not None for r in got for v in r)
    if name == "p1_found":
        assert all(r["name_a"] < r["name_b"] for r in got)
