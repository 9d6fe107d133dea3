import zlib

import numpy as np
from pyspark.sql import functions as F

from marquee.llm import sharding as S

from .helpers import SF, docs, edge_texts


def check(df, shards):
    rows = df.collect()
    for r in rows:
        data = (r.text or "").encode()
        assert r["size"] == len(data) + 16 and r.text_crc32 == zlib.crc32(data) and r.law == "bytes" and r.grown_shard is None
    total = sum(r["size"] for r in rows)
    most = max((r["size"] for r in rows), default=0)
    for s in range(shards):
        part = sorted((r.slot for r in rows if r.shard == s))
        assert part == list(range(len(part)))
        assert abs(sum(r["size"] for r in rows if r.shard == s) - total / shards) <= most
    return rows


def test_real_documents(spark):
    rows = check(S.histogram_shards(spark.read.parquet(f"{SF}/documents.parquet")), 40)
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_splitters_against_sorted_sums(spark):
    rng = np.random.default_rng(3)
    keys = np.concatenate([rng.integers(0, 1 << 62, 500), np.full(250, 12345), [(1 << 63) - 1, 0]])
    size = rng.integers(1, 1000, len(keys))
    df = spark.createDataFrame([(int(k), int(s)) for k, s in zip(keys, size)], "key long, size long")
    cuts = S.find_splitters(df, 7)
    order = np.argsort(keys, kind="stable")
    below = np.cumsum(size[order])
    for i, (g, n) in enumerate(zip(cuts.keys, cuts.rows_up_to), 1):
        target = -(-i * cuts.all_bytes // 7)
        first = int(np.searchsorted(below, target))  # row that reaches the target
        assert g >= keys[order][first] and not ((keys > keys[order][first]) & (keys <= g)).any()
        if g == 12345:
            tie = cuts.ties[g]
            assert (tie.rows, tie.size, tie.below_bytes) == (250, int(size[keys == g].sum()), int(size[keys < g].sum()))
            assert n == int((keys < g).sum()) + sum(tie.below_bytes + r * tie.size // tie.rows < target for r in range(250))
        else:
            assert n == int((keys <= g).sum())
    assert 1 < cuts.rounds <= 6 and list(cuts.ties) == [12345]


def test_tolerance_needs_no_more_rounds(spark):
    df = spark.range(3000).select(F.abs(F.xxhash64("id")).alias("key"), F.lit(10).cast("long").alias("size"))
    cuts = S.find_splitters(df, 4, tolerance=2000)
    assert cuts.rounds <= S.find_splitters(df, 4).rounds
    assert all(abs(n - 750 * i) <= 200 for i, n in enumerate(cuts.rows_up_to, 1))


def test_equal_rows_are_split_by_number(spark):
    """A third of the rows are equal in id and text, another group lacks an id."""
    same = [(7, "one row many times")] * 200 + [(None, "copies without an id " * 9)] * 150 + [(i, f"other {i}") for i in range(250)]
    for df in (docs(spark, same, extra=True), docs(spark, same).repartition(9)):
        rows = check(S.histogram_shards(df, 8, pieces=3), 8)
        assert len(rows) == 600 and len({(r.shard, r.slot) for r in rows}) == 600
        assert len({r.shard for r in rows if r.doc_id is None}) >= 4
    assert len(check(S.histogram_shards(docs(spark, same[:200]), 5), 5)) == 200


def test_a_round_returns_few_rows(spark, monkeypatch):
    seen = []
    real = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda df: seen.append(real(df)) or seen[-1])
    keys = spark.range(20_000).select(F.abs(F.xxhash64("id")).alias("key"), F.lit(10).cast("long").alias("size"))
    cuts = S.find_splitters(keys, 50)
    assert len(seen) == cuts.rounds + 1 and all(len(rows) <= 50 for rows in seen)


def test_edges(spark):
    rows = check(S.histogram_shards(docs(spark, [(None, None), (None, "x"), (5, "y"), (5, "y"), *enumerate(edge_texts())], extra=True), 3), 3)
    assert len(rows) == 16 and "key" in rows[0].asDict()
    assert S.histogram_shards(docs(spark, []), 4).collect() == []


def test_hot_copies_are_split(spark):
    rows = check(S.histogram_shards(docs(spark, ["the same text"] * 300 + [f"other {i}" for i in range(100)]), 5), 5)
    assert len({r.shard for r in rows if r.text == "the same text"}) >= 3
