import random

from corvina.operators import classify, intervals, records
from corvina.operators.packed_fields import packed_values, parse, split_packed
from corvina.plans import mapreduce
from corvina.sources import tables, writers
from corvina.streaming import incremental


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_overlap_join_against_brute_force(spark):
    rng = random.Random(1)
    make = lambda n: [(i, rng.randrange(3), s := rng.randrange(200), s + rng.randrange(1, 40)) for i in range(n)]
    a, b = make(60), make(60)
    da, db = (spark.createDataFrame(x, "id long, k long, start long, end long") for x in (a, b))
    want = sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] < y[3] and y[2] < x[3])
    assert rows(intervals.overlap_join(da, db, "k", 16).select("id", "id2")) == want
    assert {r[0] for r in intervals.overlap_join(da, db, "k", 16, "left_anti").select("id").collect()} == {x[0] for x in a} - {x for x, _ in want}


def test_anti_join_with_nulls(spark):
    a = spark.createDataFrame([(1, 0, 10, None), (1, 0, 10, "x"), (1, 50, 60, None), (1, None, None, None)], "k long, start long, end long, n string")
    b = spark.createDataFrame([(1, 5, 7)], "k long, start long, end long")
    assert {(r["start"], r["n"]) for r in intervals.overlap_join(a, b, "k", 16, "left_anti").collect()} == {(50, None), (None, None)}


def test_numbers_and_sessions_of_hot_groups(spark):
    from corvina.operators import ordered

    rng = random.Random(9)
    data = [(i, rng.choice(["hot"] * 20 + ["a", "b", None]), rng.randrange(3000)) for i in range(400)]
    d = spark.createDataFrame(data, "i long, k string, s long")
    got = {r["i"]: r["no"] for r in ordered.row_numbers(d, ["k"], ["s", "i"]).collect()}
    tile = {r["i"]: r["tile"] for r in ordered.tiles(d, ["k"], ["s", "i"], 7).collect()}
    for k in ("hot", "a", "b", None):
        mine = sorted((s, i) for i, x, s in data if x == k)
        assert [got[i] for _, i in mine] == list(range(1, len(mine) + 1))
        sizes = [sum(tile[i] == n for _, i in mine) for n in range(1, 8)]
        assert sizes == [len(mine) // 7 + (n < len(mine) % 7) for n in range(7)] and [tile[i] for _, i in mine] == sorted(tile[i] for _, i in mine)
    assert {r["no"] for r in ordered.row_numbers(d, [], ["i"]).collect()} == set(range(1, 401)) and ordered.row_numbers(d.limit(0), ["k"], ["s"]).count() == 0
    e = d.selectExpr("i", "k", "s as start", "s + 5 as end")
    sess = {r["i"]: r["session"] for r in intervals.gap_sessions(e, ["k"], "start", "end", 10).collect()}
    for k in ("hot", "a", "b", None):
        n, reached = 0, None
        for s, i in sorted((s, i) for i, x, s in data if x == k):
            n += reached is None or s - reached > 10
            reached = max(reached or 0, s + 5)
            assert sess[i] == n
    left, right = d.where("i % 3 = 0").selectExpr("k", "s as pos", "i as a"), d.where("i % 3 = 1").selectExpr("k", "s as pos", "i as id")
    near = {r["a"]: r["distance"] for r in intervals.nearest(left, right, "k", "a").where("k is not null").collect()}
    for i, k, s in data:
        if i % 3 == 0 and k is not None:
            want = [abs(s - x) for j, y, x in data if j % 3 == 1 and y == k]
            assert near[i] == (min(want) if want else None)


def test_nearest_and_merge(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 50, 2), (2, 5, 3)], "k long, pos long, a long")
    b = spark.createDataFrame([(1, 8, 7), (1, 12, 8), (1, 49, 9)], "k long, pos long, id long")
    assert rows(intervals.nearest(a, b, "k", "a").select("a", "nearest", "distance").where("nearest is not null")) == [(1, 7, 2), (2, 9, 1)]
    m = spark.createDataFrame([(1, 0, 10), (1, 2, 4), (1, 9, 12), (1, 20, 21)], "k long, start long, end long")
    assert rows(intervals.merged(m, ["k"])) == [(1, 0, 12, 3), (1, 20, 21, 1)]


def test_close_neighbours(spark):
    d = spark.createDataFrame([(0, "a", 1000), (0, "b", 2000), (0, "c", 2007), (0, "d", 2100)], "k long, n string, pos long")
    assert rows(intervals.close_neighbours_removed(d, "k", "pos", 200).select("n")) == [("a",)]


def test_chains(spark):
    d = spark.createDataFrame([(1, "c", "q1", 0, 10), (1, "c", "q1", 12, 20), (1, "c", "q2", 15, 30), (1, "c", "q3", 500, 510)], "article long, chrom string, query string, tstart long, tend long")
    c = intervals.chain_alignments(d, 100)
    assert rows(c.select("query", "chain")) == [("q1", 1), ("q2", 1), ("q3", 2)]
    assert rows(intervals.greedy_cover(c).select("chain", "query")) == [(1, "q1"), (1, "q2"), (2, "q3")]


def test_chain_leaves_out_far_repeats(spark):
    d = spark.createDataFrame([(1, "c", "q1", 0, 10), (1, "c", "q2", 15, 30), (1, "c", "q1", 5000, 5010), (1, "c_hap1", "q9", 0, 9), (2, "c", "q1", 5000, 5010)], "article long, chrom string, query string, tstart long, tend long")
    assert rows(intervals.chain_alignments(d, 100).select("article", "query", "tstart", "chain")) == [(1, "q1", 0, 1), (1, "q2", 15, 1), (2, "q1", 5000, 1)]
    assert intervals.greedy_cover(intervals.chain_alignments(d.limit(0), 100)).count() == 0


def test_packed_parse():
    assert parse('"A, B", "C ""x"""', ",") == ["A, B", 'C "x"']
    assert parse("[1] A, x; [2] B", ";") == ["A, x", "B"]
    assert parse("1) A 2) B", "numbered") == ["A", "B"]
    assert parse("A; B; ", ";") == ["A", "B"]


def test_packed_fields(spark):
    fields = ["Oxygen/Mice, Mutant Lines/w", "Oxygen; w/v ratio; Rats", "Rats;Oxygen;Exome", "Oxygen|Rats|w/v ratio", "Mice, Mutant Lines|Rats", "w/v ratio", "Rats", None, "", "Mice, Mutant Lines", "Rats, Oxygen"] * 2
    d = spark.createDataFrame([(i, f, 1) for i, f in enumerate(fields)], "articleid long, keywords string, item long")
    got = {(r["articleid"], r["pos"]): r["item"] for r in packed_values(d, "articleid", ["keywords"]).where("n_items > 1").collect()}
    assert got[(1, 2)] == "w/v ratio" and got[(0, 2)] == "Mice, Mutant Lines" and got[(10, 2)] == "Oxygen"
    assert not [k for k in got if k[0] in (5, 7, 8, 9)]
    assert split_packed(d.limit(0), ["keywords"]).count() == 0


def test_records(spark):
    d = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, None)], "articleid long, updateid int, title string")
    assert rows(records.latest(d, "articleid").select("articleid", "title").where("title is not null")) == [(1, "b")]
    f = spark.createDataFrame([(1, 1000, "main", "application/pdf"), (1, 1001, "main", "text/html"), (1, 1002, "supp", "application/pdf")], "articleid long, fileid long, filetype string, mimetype string")
    assert rows(records.keep_best_main(f).select("fileid")) == [(1001,), (1002,)]
    assert rows(records.keep_best_main(f, "pdf").select("fileid")) == [(1000,), (1002,)]


def test_map_reduce(spark):
    d = spark.createDataFrame([("a b a",), (None,), ("b",)], "content string")
    job = mapreduce.MapReduce(lambda r: [(w, "1") for w in (r["content"] or "").split()], lambda k, v: [(k, int(v))], "w string, n long", lambda a, b: str(int(a) + int(b)))
    assert rows(mapreduce.run(d, job)) == [("a", 2), ("b", 2)]
    job = mapreduce.MapReduce(lambda r: [(w, "1") for w in (r["content"] or "").split()], lambda k, v: [(k, sum(1 for _ in v))], "w string, n long")
    assert rows(mapreduce.run(d, job)) == [("a", 2), ("b", 2)]


def test_tsv_round_trip(spark, tmp_path):
    d = spark.createDataFrame([("x", "1"), ("y\tz", "2")], "a string, b string")
    writers.write_tsv(d, str(tmp_path / "t"), one_file=True)
    got = tables.read_tsv(spark, str(tmp_path / "t"), types={"b": "int"})
    assert rows(got) == [("x", 1), ("y z", 2)]


def test_incremental(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(5).write.parquet(src)
    schema = spark.read.parquet(src).schema
    handle = lambda b, n: b.write.mode("append").parquet(out)
    incremental.catch_up(spark, src, schema, str(tmp_path / "cp"), handle)
    spark.range(5, 8).write.mode("append").parquet(src)
    incremental.catch_up(spark, src, schema, str(tmp_path / "cp"), handle)
    assert sorted(r[0] for r in spark.read.parquet(out).collect()) == list(range(8))


def test_svmlight(spark):
    d = spark.createDataFrame([(1, 1, ["a", "b"]), (2, 0, ["z"])], "id long, label int, words array<string>")
    best = spark.createDataFrame([("a", 2), ("b", 3)], "word string, rank int")
    assert rows(classify.svmlight(d, best, "id", "label")) == [(1, "+1 1:1 2:1 3:1"), (2, "-1")]


def test_upsert(spark):
    old = spark.createDataFrame([("k", "1", 1)], "key string, value string, ord long")
    new = spark.createDataFrame([("k", "2", 2), ("j", "0", 1)], "key string, value string, ord long")
    assert rows(writers.upsert_kv(old, new).select("key", "value")) == [("j", "0"), ("k", "2")]
    assert incremental.next_update(spark.createDataFrame([], "updateId int, lastArticleId long"), 10) == (0, 10)
