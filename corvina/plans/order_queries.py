"""Queries over ordered rows, intervals, top-k, samples and sets, on the relational tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvina.operators import intervals as iv
from corvina.operators.ordered import tiles
from corvina.plans.query import Registry, Tables

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles
_DAY = "date_diff('day', date '1970-01-01', cast({} as date))"
_LI = f"(select l_orderkey, l_linenumber, l_suppkey as chrom, {_DAY.format('l_shipdate')} as \"start\", {_DAY.format('l_shipdate')} + 1 + l_linenumber as \"end\", l_quantity from lineitem)"
_OR = f"(select o_orderkey, o_custkey % 100 as chrom, {_DAY.format('o_orderdate')} as \"start\", {_DAY.format('o_orderdate')} + 3 as \"end\" from orders)"


def _day(c: str) -> Column:
    return F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date")).cast("long")


def _items(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_suppkey").cast("long").alias("chrom"), _day("l_shipdate").alias("start"), (_day("l_shipdate") + 1 + F.col("l_linenumber")).alias("end"), "l_quantity")


def _orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.pmod("o_custkey", F.lit(100)).cast("long").alias("chrom"), _day("o_orderdate").alias("start"), (_day("o_orderdate") + 3).alias("end"))


@query(f'select a.o_orderkey, count(*) as n, min(b.l_orderkey) as first from {_OR} a join {_LI} b on a.chrom = b.chrom and a."start" < b."end" and b."start" < a."end" group by a.o_orderkey')
def interval_overlap(t: Tables) -> DataFrame:
    return iv.overlap_join(_orders(t), _items(t), "chrom", 8).groupBy("o_orderkey").agg(F.count("*").alias("n"), F.min("l_orderkey2").alias("first"))


@query(f'select a.o_orderkey, a.chrom from {_OR} a where not exists (select 1 from {_LI} b where a.chrom = b.chrom and a."start" < b."end" and b."start" < a."end")')
def interval_anti(t: Tables) -> DataFrame:
    return iv.overlap_join(_orders(t), _items(t), "chrom", 8, "left_anti").select("o_orderkey", "chrom")


@query("""with a as (select event_id, user_id % 50 as k, epoch_us(ts)//1000000 as pos from events where event_type = 'purchase'), b as (select user_id % 50 as k, epoch_us(ts)//1000000 as pos, min(event_id) as id from events where event_type = 'click' group by all)
 select a.event_id, min(abs(a.pos - b.pos)) as distance from a join b on a.k = b.k group by a.event_id""")
def nearest_event(t: Tables) -> DataFrame:
    sec = F.unix_seconds(F.col("ts").cast("timestamp"))
    e = t.events.select("event_id", "event_type", F.pmod("user_id", F.lit(50)).alias("k"), sec.alias("pos"))
    b = e.where("event_type = 'click'").groupBy("k", "pos").agg(F.min("event_id").alias("id"))
    return iv.nearest(e.where("event_type = 'purchase'"), b, "k", "event_id").where("nearest is not null").select("event_id", "distance")


@query("""select a.l_orderkey, a.l_linenumber, coalesce(min(b.o_orderkey)::varchar, 'na') as rsid from lineitem a left join orders b on a.l_suppkey = b.o_custkey % 100 and cast(a.l_shipdate as date) = cast(b.o_orderdate as date) group by all""")
def exact_coordinates(t: Tables) -> DataFrame:
    b = t.orders.groupBy(F.pmod("o_custkey", F.lit(100)).alias("l_suppkey"), F.col("o_orderdate").cast("date").alias("day")).agg(F.min("o_orderkey").alias("id"))
    a = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_shipdate").cast("date").alias("day"))
    found = a.join(b, ["l_suppkey", "day"], "left").groupBy("l_orderkey", "l_linenumber").agg(F.min("id").alias("id"))
    return found.select("l_orderkey", "l_linenumber", F.coalesce(F.col("id").cast("string"), F.lit("na")).alias("rsid"))


@query("""select user_id, count(distinct session) as chains, max(session) as last from (select *, sum(n) over (partition by user_id order by s, event_id rows unbounded preceding) as session from
 (select user_id, event_id, s, case when lag(s) over (partition by user_id order by s, event_id) is null or s - lag(s) over (partition by user_id order by s, event_id) > 86400 then 1 else 0 end n from (select *, epoch_us(ts)//1000000 as s from events))) group by user_id""")
def gap_chains(t: Tables) -> DataFrame:
    e = t.events.select("user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("e"))
    return iv.gap_sessions(e, ["user_id"], "s", "e", 86400).groupBy("user_id").agg(F.countDistinct("session").alias("chains"), F.max("session").alias("last"))


@query(f'select chrom, min("start") as "start", max("end") as "end", count(*) as pieces from (select *, sum(n) over (partition by chrom order by "start", "end", l_orderkey, l_linenumber rows unbounded preceding) as g from (select *, case when max("end") over (partition by chrom order by "start", "end", l_orderkey, l_linenumber rows between unbounded preceding and 1 preceding) >= "start" then 0 else 1 end as n from {_LI})) group by chrom, g')
def merge_intervals(t: Tables) -> DataFrame:
    return iv.merged(_items(t), ["chrom"])


@query(f'select chrom, l_orderkey, l_linenumber from {_LI} a where (select count(*) from {_LI} b where b.chrom = a.chrom) < 650')
def feature_cap(t: Tables) -> DataFrame:
    few = _items(t).groupBy("chrom").agg(F.count("*").alias("n")).where("n < 650")
    return _items(t).join(few, "chrom", "left_semi").select("chrom", "l_orderkey", "l_linenumber")


@query(f'select chrom, "start", "end", count(*) as n, string_agg(distinct cast(l_linenumber as varchar), \'\' order by cast(l_linenumber as varchar)) as types from {_LI} group by chrom, "start", "end"')
def fuse_identical(t: Tables) -> DataFrame:
    return _items(t).groupBy("chrom", "start", "end").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set(F.col("l_linenumber").cast("string"))), "").alias("types"))


@query("""select user_id, s from (select user_id, s, lag(s) over w l, lead(s) over w r from (select distinct user_id, epoch_us(ts)//1000000 as s from events) window w as (partition by user_id order by s)) where (l is null or abs(s-l) > 7200) and (r is null or abs(r-s) > 7200)""")
def close_neighbour_filter(t: Tables) -> DataFrame:
    e = t.events.select("user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("s")).distinct()
    return iv.close_neighbours_removed(e, "user_id", "s", 7200)


@query("""select user_id, max(n) as longest from (select user_id, g, count(*) n from (select user_id, hit, row_number() over (partition by user_id order by ts, event_id) - row_number() over (partition by user_id, hit order by ts, event_id) as g from (select *, value > 50 as hit from events)) where hit group by all) group by user_id""")
def longest_run(t: Tables) -> DataFrame:
    e = t.events.select("user_id", "ts", "event_id", (F.col("value") > 50).alias("hit"))
    w = lambda *k: F.row_number().over(Window.partitionBy(*k).orderBy("ts", "event_id"))
    r = e.select("user_id", "hit", (w("user_id") - w("user_id", "hit")).alias("g")).where("hit").groupBy("user_id", "g").agg(F.count("*").alias("n"))
    return r.groupBy("user_id").agg(F.max("n").alias("longest"))


_NA = "(select n_regionkey as k, n_nationkey * 3 as \"start\", n_nationkey * 3 + 4 + length(n_name) as \"end\", n_name as name from nation)"


@query(f'with f as {_NA}, c as (select distinct k, unnest(["start","end"]) as cut from f), s as (select k, cut, lead(cut) over (partition by k order by cut) as "to" from c) select s.k, s.cut as "start", s."to" as "end", arg_min(f.name, (f."end" - f."start", f.name)) as name from s join f on s.k = f.k and f."start" <= s.cut and s."to" <= f."end" group by all')
def flatten_features(t: Tables) -> DataFrame:
    n = F.col("n_nationkey").cast("long") * 3
    f = t.nation.select(F.col("n_regionkey").alias("k"), n.alias("start"), (n + 4 + F.length("n_name")).alias("end"), F.col("n_name").alias("name"))
    return iv.flattened(f, "k")


@query("""select k, name, case when l is null then mid - 100 else (l + mid) // 2 end as "start", case when r is null then mid + 100 else (mid + r) // 2 end as "end" from (select n_regionkey as k, n_name as name, n_nationkey * 10 as mid, lag(n_nationkey*10) over w l, lead(n_nationkey*10) over w r from nation window w as (partition by n_regionkey order by n_nationkey))""")
def loci_midpoints(t: Tables) -> DataFrame:
    w = Window.partitionBy("k").orderBy("mid")
    n = t.nation.select(F.col("n_regionkey").alias("k"), F.col("n_name").alias("name"), (F.col("n_nationkey").cast("long") * 10).alias("mid"))
    left, right = F.lag("mid").over(w), F.lead("mid").over(w)
    return n.select("k", "name", F.when(left.isNull(), F.col("mid") - 100).otherwise(F.floor((left + F.col("mid")) / 2)).alias("start"), F.when(right.isNull(), F.col("mid") + 100).otherwise(F.floor((F.col("mid") + right) / 2)).alias("end"))


@query("""select user_id, event_type, min(event_id) as first, count(*) as n from (select *, sum(c) over (partition by user_id order by ts, event_id rows unbounded preceding) g from (select *, case when event_type = lag(event_type) over (partition by user_id order by ts, event_id) then 0 else 1 end c from events)) group by user_id, event_type, g""")
def merge_same_name(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = t.events.select("user_id", "event_type", "ts", "event_id")
    c = F.when(F.col("event_type") == F.lag("event_type").over(w), 0).otherwise(1)
    return e.withColumn("c", c).withColumn("g", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy("user_id", "event_type", "g").agg(F.min("event_id").alias("first"), F.count("*").alias("n")).drop("g")


@query("select p_brand, arg_max(p_partkey, (p_retailprice, p_partkey)) as part, max(p_retailprice) as price from part group by p_brand")
def longest_per_group(t: Tables) -> DataFrame:
    return t.part.groupBy("p_brand").agg(F.max_by("p_partkey", F.struct("p_retailprice", "p_partkey")).alias("part"), F.max("p_retailprice").alias("price"))


@query("select * from (select *, rank() over (partition by l_suppkey order by score desc) as rk from (select l_suppkey, l_partkey, sum(case l_returnflag when 'R' then 10 when 'A' then 5 else 0 end) as score from lineitem group by l_suppkey, l_partkey)) where rk <= 3")
def rank_scores(t: Tables) -> DataFrame:
    s = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum(F.when(F.col("l_returnflag") == "R", 10).when(F.col("l_returnflag") == "A", 5).otherwise(0)).alias("score"))
    return s.withColumn("rk", F.rank().over(Window.partitionBy("l_suppkey").orderBy(F.desc("score"))).cast("long")).where("rk <= 3")


@query("select o_custkey, o_orderkey, o_totalprice from (select *, rank() over (partition by o_custkey order by o_totalprice desc) r from orders) where r = 1")
def best_per_key(t: Tables) -> DataFrame:
    best = t.orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("o_totalprice"))
    return t.orders.select("o_custkey", "o_orderkey", "o_totalprice").join(best, ["o_custkey", "o_totalprice"], "left_semi")


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 100")
def top_n(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@query("select l_suppkey, l_partkey, count(*) as n, list_sort(list(l_orderkey)) as orders from lineitem group by all")
def grouped_index(t: Tables) -> DataFrame:
    """All rows of each key."""
    return t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("l_orderkey")).alias("orders"))


@query("select ntile, count(*) as n, min(o_orderkey) as first from (select o_orderkey, ntile(7) over (partition by o_orderpriority order by o_orderkey) as ntile, o_orderpriority from orders) group by ntile")
def split_parts(t: Tables) -> DataFrame:
    return tiles(t.orders.select("o_orderkey", "o_orderpriority"), ["o_orderpriority"], ["o_orderkey"], 7, "ntile").groupBy("ntile").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"))


@query()
def train_test_split(t: Tables) -> DataFrame:
    """Four fifths by a hash of the key, the same in every run."""
    return t.orders.select("o_orderkey", F.when(F.pmod(F.xxhash64("o_orderkey", F.lit(7)), F.lit(10)) < 8, "train").otherwise("test").alias("part"))


@query("select n1, n2, count(*) as n, max(s) as most from (select least(c.c_nationkey, s.s_nationkey) as n1, greatest(c.c_nationkey, s.s_nationkey) as n2, l.l_quantity as s from lineitem l join orders o on l.l_orderkey = o.o_orderkey join customer c on o.o_custkey = c.c_custkey join supplier s on l.l_suppkey = s.s_suppkey) group by n1, n2")
def symmetric_pairs(t: Tables) -> DataFrame:
    j = t.lineitem.select("l_orderkey", "l_suppkey", "l_quantity").join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey").join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey").join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
    return j.groupBy(F.least("c_nationkey", "s_nationkey").alias("n1"), F.greatest("c_nationkey", "s_nationkey").alias("n2")).agg(F.count("*").alias("n"), F.max("l_quantity").alias("most"))


@query("select r_name, count(distinct c_custkey) as customers, count(distinct o_orderkey) as orders, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue from region join nation on r_regionkey = n_regionkey join customer on c_nationkey = n_nationkey join orders on o_custkey = c_custkey join lineitem on l_orderkey = o_orderkey group by r_name")
def two_hop_lookup(t: Tables) -> DataFrame:
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), "r_name")
    o = t.customer.select("c_custkey", "c_nationkey").join(geo, "c_nationkey").join(t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")), "c_custkey")
    j = o.join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("v")), "o_orderkey")
    return j.groupBy("r_name").agg(F.countDistinct("c_custkey").alias("customers"), F.countDistinct("o_orderkey").alias("orders"), F.round(F.sum("v"), 2).alias("revenue"))


@query("select s_nationkey, count(*) as suppliers, round(avg(s_acctbal), 4) as balance, (select count(*) from customer where c_nationkey = s_nationkey) as customers from supplier group by s_nationkey having count(*) > 1")
def nation_profile(t: Tables) -> DataFrame:
    c = t.customer.groupBy(F.col("c_nationkey").alias("s_nationkey")).agg(F.count("*").alias("customers"))
    return t.supplier.groupBy("s_nationkey").agg(F.count("*").alias("suppliers"), F.round(F.avg("s_acctbal"), 4).alias("balance")).where("suppliers > 1").join(c, "s_nationkey", "left").select("s_nationkey", "suppliers", "balance", F.coalesce("customers", F.lit(0)).alias("customers"))


@query("select event_type, date_trunc('day', ts)::date as day, count(*) as n, round(sum(value), 4) as total from events group by all")
def daily_totals(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type", F.to_date(F.col("ts").cast("timestamp")).alias("day")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query()
def exact_chains(t: Tables) -> DataFrame:
    a = t.lineitem.select(F.col("l_suppkey").alias("article"), F.concat(F.lit("chr"), F.pmod("l_partkey", F.lit(22))).alias("chrom"), F.col("l_orderkey").alias("query"), (_day("l_shipdate") * 1000).alias("tstart"), (_day("l_shipdate") * 1000 + 30).alias("tend"))
    return iv.greedy_cover(iv.chain_alignments(a, 5000).withColumn("chain", F.concat_ws(":", "chrom", "chain")))
