import re

import pytest

from marquee.llm import mixing as M

from .helpers import SF, docs, edge_texts


def tokens(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def check(spark, df, target):
    rows = df.collect()
    plan, a = M.source_plan(df.withColumn("__op_tokens", M.words(M.F.col("text"))), target)
    plan = {r["__op_source"]: r for r in plan.collect()}
    got = M.mix(df, target).collect()
    for s, p in plan.items():
        own = [r for r in rows if r.source == s]
        use = [r for r in got if r.source == s]
        assert sum(tokens(r.text) for r in own) == p.source_tokens
        for e in range(p.whole):
            assert sorted(repr(r.doc_id) for r in use if r.epoch == e) == sorted(repr(r.doc_id) for r in own)
        part = [r for r in use if r.epoch == p.whole]
        assert sum(r.n_tokens for r in part) <= p.part and max((r.epoch for r in use), default=0) <= p.whole
        if p.part:  # the part is the head of its permutation: the next place would not fit
            order = sorted({(r.block_order, r.row_order) for r in part if r.n_tokens})
            every = M.mix(df, M.Target(budget=10**9, seed=target.seed)).where(M.F.col("epoch") == p.whole).where(M.F.col("source").eqNullSafe(s) if s is None else M.F.col("source") == s).collect()
            places = {}
            for r in every:
                places[(r.block_order, r.row_order)] = places.get((r.block_order, r.row_order), 0) + r.n_tokens
            places = sorted((k, v) for k, v in places.items() if v)
            if len(places) > len(order):
                assert [k for k, _ in places[: len(order)]] == order
                assert sum(v for _, v in places[: len(order) + 1]) > p.part
    return plan, a, got


def test_repetition_limit(spark):
    plan, a, got = check(spark, spark.read.parquet(f"{SF}/documents.parquet"), M.Target(repetition=1.5))
    most = max(p.budget / p.source_tokens for p in plan.values())
    assert 0 < a < 1 and 1.45 < most <= 1.51 and min(p.whole for p in plan.values()) >= 1


def test_entropy_and_budget(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    plan, a, _ = check(spark, df, M.Target(entropy=0.97, budget=20_000))
    w = [p.weight for p in plan.values()]
    assert abs(sum(w) - 1) < 1e-9 and abs(sum(p.budget for p in plan.values()) - 20_000) < len(plan)


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_TOKENS", 500)
    _, _, got = check(spark, spark.read.parquet(f"{SF}/documents.parquet"), M.Target(repetition=2.0))
    assert len({r.block for r in got}) > 3


def test_bisection():
    totals = [1000, 100, 10]
    a = M.exponent(totals, M.Target(repetition=3.0))
    assert max(M.epochs(totals, a, None)) == pytest.approx(3.0) and M.exponent(totals, M.Target(repetition=1.0)) == 1.0
    a = M.exponent(totals, M.Target(entropy=0.8))
    assert M.entropy_share(M.weights(totals, a)) == pytest.approx(0.8)
    assert M.exponent(totals, M.Target()) == 1.0 and M.exponent([0, 0], M.Target(repetition=2)) == 1.0
    assert M.exponent(totals, M.Target(entropy=0.99, repetition=2)) == M.exponent(totals, M.Target(repetition=2))


def test_edges(spark):
    df = docs(spark, [(None, None), (None, "a b"), (4, "four words of text"), (4, "four words of text"), *enumerate(edge_texts())], extra=True)
    df = df.withColumn("source", M.F.when(M.F.col("doc_id") == 4, None).when(M.F.col("doc_id") == 3, "tiny").otherwise(M.F.col("source")))
    _, _, got = check(spark, df, M.Target(repetition=2.0))
    assert {"left", "size"} <= set(got[0].asDict()) and {r.doc_id for r in got} == {r.doc_id for r in df.collect()}
    check(spark, df, M.Target(budget=50))
    assert M.mix(docs(spark, [])).collect() == []
    assert len(M.mix(docs(spark, [None, ""])).collect()) == 2
