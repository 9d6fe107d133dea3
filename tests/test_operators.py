"""Distributed operators against Spark's single-task built-ins and naive forms."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.operators.dedup import best_per_key, keep_first, mark_duplicates, sort_key_desc_nulls_last
from marquee.operators.ordered import distributed_lag_lead, distributed_ntile
from marquee.operators.percentile import group_percentiles


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", None])   # one group holds a third
        v = rnd.choice([1.0, 2.0, 2.0, 5.5, -3.25, 1e6, 0.0, None, rnd.uniform(-50, 5e5)])
        rows.append((i, g, v))
    rows += [(5000, "single", 4.0), (5001, "pair", 1.0), (5002, "pair", 2.0)]
    return spark.createDataFrame(rows, "id long, g string, v double")


def test_group_percentiles_cont_matches_builtin(skewed):
    got = {r.g: (r.n, r.p50, r.p90) for r in
           group_percentiles(skewed, ["g"], "v", {"p50": 0.5, "p90": 0.9}).collect()}
    want = {r.g: (r.n, r.p50, r.p90) for r in skewed.where("v IS NOT NULL").groupBy("g").agg(
        F.count("*").alias("n"), F.percentile("v", 0.5).alias("p50"), F.percentile("v", 0.9).alias("p90")).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0]
        assert got[k][1] == pytest.approx(want[k][1], rel=1e-12)
        assert got[k][2] == pytest.approx(want[k][2], rel=1e-12)


def test_group_percentiles_disc_and_global(skewed):
    vals = sorted(r.v for r in skewed.where("v IS NOT NULL").collect())
    n = len(vals)
    import math
    got = group_percentiles(skewed, [], "v", {"m": 0.5}, method="disc").first()
    assert got.n == n and got.m == vals[math.ceil(0.5 * n) - 1]


def test_group_percentiles_equal_the_builtin_exactly(spark):
    # no rounding: a tertile bound that moves by one bit moves rows to another tier
    rnd = random.Random(8)
    df = spark.createDataFrame([(f"g{rnd.randint(0, 39)}", rnd.choice([rnd.uniform(-1e6, 1e6), 7.25, 0.1])) for _ in range(6000)],
                               "g string, v double")
    qs = {"p33": 0.33, "p50": 0.5, "p66": 0.66, "p90": 0.9}
    got = {r.g: tuple(r[q] for q in qs) for r in group_percentiles(df, ["g"], "v", qs).collect()}
    want = {r.g: tuple(r[q] for q in qs) for r in df.groupBy("g").agg(*[F.percentile("v", x).alias(q) for q, x in qs.items()]).collect()}
    assert got == want and len(got) == 40


def test_distributed_ntile_matches_window(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(i, float(rnd.choice([10, 20, 20, 30, 40 + i % 7]))) for i in range(1001)],
                               "movie_id long, budget double")
    got = {r.movie_id: r.q for r in distributed_ntile(df, 4, ["budget", "movie_id"], out="q", num_partitions=7).collect()}
    want = {r.movie_id: r.q for r in df.withColumn("q", F.ntile(4).over(Window.orderBy("budget", "movie_id"))).collect()}
    assert got == want


def test_distributed_lag_lead_matches_window(spark):
    rnd = random.Random(5)
    df = spark.createDataFrame([(i, rnd.choice(["t1", "t2", None]), rnd.randint(1990, 1995), float(i * 3 % 11))
                                for i in range(500)], "movie_id long, tier string, year int, revenue double")
    got = distributed_lag_lead(df, ["tier"], ["year", "movie_id"], "revenue", "p", "n", num_partitions=5)
    w = Window.partitionBy("tier").orderBy("year", "movie_id")
    want = df.select("movie_id", F.lag("revenue").over(w).alias("p"), F.lead("revenue").over(w).alias("n"))
    assert sorted(got.select("movie_id", "p", "n").collect()) == sorted(want.collect())


def test_keep_first_and_best_per_key(spark):
    df = spark.createDataFrame([("1", 3, "c"), ("1", 1, "a"), ("2", 2, "b"), (None, 5, "x"), (None, 4, "y")],
                               "id string, seq int, v string")
    got = sorted(keep_first(df, ["id"], ["seq"]).collect(), key=lambda r: (r.id is None, r.id))
    assert [(r.id, r.v) for r in got] == [("1", "a"), ("2", "b"), (None, "y")]
    ext = spark.createDataFrame([("t", None, 5.0), ("t", 10.0, 1.0), ("t", 10.0, 2.0), ("u", None, None)],
                                "k string, b double, r double")
    best = {r.k: (r.b, r.r) for r in best_per_key(ext, ["k"], sort_key_desc_nulls_last("b", "r")).collect()}
    assert best == {"t": (10.0, 2.0), "u": (None, None)}


def test_mark_duplicates(spark):
    df = spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "id string")
    got = sorted((r.id or "", r.is_duplicated) for r in mark_duplicates(df, ["id"]).collect())
    assert got == [("", False), ("1", True), ("1", True), ("2", False)]


def test_group_percentiles_clustered_hot_group(spark):
    # every value of the hot group sits inside one asinh grid cell: the
    # second-level slices must still find the exact ranks
    rows = [("hot", 1_000_000.0 + (i * 7919 % 5000) * 0.01) for i in range(5000)]
    rows += [("hot", 1_000_000.0)] * 300 + [("cold", float(i)) for i in range(11)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.p10, r.p50, r.p99) for r in
           group_percentiles(df, ["g"], "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99}).collect()}
    want = {r.g: (r.p10, r.p50, r.p99) for r in df.groupBy("g").agg(
        F.percentile("v", 0.1).alias("p10"), F.percentile("v", 0.5).alias("p50"),
        F.percentile("v", 0.99).alias("p99")).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_keep_first_with_hot_id(spark):
    # one id holds a third of the rows: partial aggregation keeps the first
    rows = [("hot" if i % 3 == 0 else f"id{i}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "id string, seq int")
    out = {r.id: r.seq for r in keep_first(df, ["id"], ["seq"]).collect()}
    assert out["hot"] == 0 and len(out) == 2001


def test_salted_join_hot_key_and_missing_matches(spark):
    from marquee.operators._joins import salted_many_to_one_join
    left = spark.createDataFrame([(i, "hot" if i % 2 else f"k{i % 7}") for i in range(200)] + [(999, None)],
                                 "id long, key string")
    right = spark.createDataFrame([("hot", 1.0), ("k0", 2.0), ("k2", None)], "rkey string, val double")
    plain = left.join(right, left.key == right.rkey, "left").select("id", "val")
    salted = salted_many_to_one_join(left, right, "key", "rkey", "id", "left", hot_threshold=10,
                                     salt_buckets=8).select("id", "val")
    assert sorted(salted.collect()) == sorted(plain.collect()) and salted.count() == 201
