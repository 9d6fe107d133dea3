"""Profiling operators against pandas/numpy brute force on edge rows."""

import numpy as np
import pandas as pd
import pytest

from marquee.operators import profile

IDS = ["1", "1", "2", None, None, "3", "10", "10", "10"]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, t, v) for i, t, v in zip(IDS, ["a", None, "b", "c", None, "", "x", "y", "z"],
                                         [1.0, 2.5, None, 4.0, 8.0, 16.0, 0.5, 3.0, 100.0])]
    return spark.createDataFrame(rows, "id string, title string, v double")


def test_missingness(frame):
    pdf = frame.toPandas()
    got = {r.column: (r.null_count, r.null_pct) for r in profile.missingness(frame, "m").collect()}
    for c in pdf.columns:
        n = int(pdf[c].isna().sum())
        assert got[c] == (n, round(n / len(pdf) * 100, 2))


def test_id_quality_matches_pandas(frame):
    s = pd.Series(IDS, dtype="object")
    r = profile.id_quality(frame, "id", "m").first()
    assert r.rows == len(s)
    assert r.unique_ids == s.nunique(dropna=True)
    assert r.null_ids == int(s.isna().sum())
    assert r.duplicate_rows_on_id == int(s.duplicated().sum())
    assert r.is_unique is bool(s.is_unique)
    assert r.sample_duplicate_ids == "1,10"


def test_orphan_report(spark, frame):
    parent = spark.createDataFrame([("1",), ("3",), ("4",)], "id string")
    got = {r.check: (r["count"], r.sample) for r in
           profile.orphan_report({"x": (frame.select("id"), parent)}).collect()}
    want = sorted({i for i in IDS if i is not None} - {"1", "3", "4"})
    assert got["x"] == (len(want), ",".join(want[:5]))


def test_histogram_matches_numpy(frame):
    vals = [v for v in frame.toPandas()["v"] if not pd.isna(v)]
    counts, edges = np.histogram(vals, bins=7)
    got = sorted((r.bin, r["count"], r.lower) for r in profile.histogram(frame, "v", 7).collect())
    assert got == [(i, int(c), round(float(edges[i]), 6)) for i, c in enumerate(counts)]


def test_tertile_bins_match_pandas_cut(frame):
    pdf = frame.toPandas().dropna(subset=["v"])
    p33, p66 = pdf["v"].quantile([0.33, 0.66])
    want = pd.cut(pdf["v"], bins=[0, p33, p66, np.inf], labels=["Low", "Mid", "High"]).astype(str).tolist()
    got = [r.tier for r in profile.equal_frequency_bins(frame.where("v IS NOT NULL"), "v", (0.33, 0.66),
                                                        ("Low", "Mid", "High"), "tier").orderBy("v").collect()]
    assert sorted(got) == sorted(want)


def test_top_counts_ties_by_token(spark):
    df = spark.createDataFrame([(t,) for t in ["b", "a", " a ", "c", "", None, "b"]], "t string")
    got = [(r.token, r.movie_count) for r in profile.top_counts(df.where("t IS NOT NULL"), "t", 2).collect()]
    assert got == [("a", 2), ("b", 2)]


def test_distinct_sketches_roll_up(spark):
    from marquee.operators.profile import SKETCH_BOUND, distinct_rollup, distinct_sketches
    rows = spark.range(30_000).selectExpr("id % 3 AS g", "id % 10 AS y", "id % 20000 AS v")
    fine = distinct_sketches(rows, ["g", "y"], "v")
    assert {len(r.sketch) <= 8192 for r in fine.collect()} == {True}
    true = {r[0]: r[1] for r in rows.distinct().select("g", "v").distinct().groupBy("g").count().collect()}
    got = {r.g: r.n for r in distinct_rollup(fine, ["g"], "n").collect()}
    assert set(got) == set(true) and all(abs(got[g] - true[g]) <= SKETCH_BOUND * true[g] for g in true)
    whole = distinct_rollup(fine, [], "n").first().n
    assert abs(whole - 20_000) <= SKETCH_BOUND * 20_000


def test_observed_counts_in_one_scan(spark, frame, tmp_path):
    from pyspark.sql import functions as F
    frame.unionByName(frame.limit(3)).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    flags = {("values", "large"): F.col("twice") > 6, ("values", "blank"): F.col("title") == ""}
    got_df = profile.observe(df, "id", ["id", "title", "v"], {"twice": F.col("v") * 2}, flags, "m")
    got = {(r.report, r.item): r.value for r in got_df.collect()}
    pdf = df.toPandas()
    ids = pdf["id"].astype(object).where(pdf["id"].notna(), None)
    want = {("ids", "rows"): len(pdf), ("ids", "unique_ids"): ids.nunique(dropna=True), ("ids", "null_ids"): int(ids.isna().sum()),
            ("ids", "duplicate_rows_on_id"): int(ids.duplicated().sum()), ("ids", "exact_duplicate_rows"): int(pdf.duplicated().sum()),
            ("values", "large"): int((pdf["v"] > 3).sum()), ("values", "blank"): int((pdf["title"] == "").sum()),
            **{("nulls", c): int(pdf[c].isna().sum()) for c in pdf.columns}, ("nulls", "twice"): int(pdf["v"].isna().sum())}
    assert got == want
    assert got_df._jdf.queryExecution().sparkPlan().toString().count("FileScan parquet") == 1
    none = profile.observe(df.limit(0), "id", ["id", "title", "v"], {}, {}, "m").collect()
    assert len(none) == 8 and {r.value for r in none} == {0}


def test_describe_matches_pandas(spark, frame):
    nan = spark.createDataFrame([(float("nan"),), (2.0,), (None,)], "w double")
    empty = spark.createDataFrame([(None,)], "x double")
    got = {r.column: r for r in profile.describe_many([("m", frame, ["v"]), ("n", nan, ["w"]), ("e", empty, ["x"])]).collect()}
    v = frame.toPandas()["v"].describe()
    r = got["v"]
    assert [r["count"], r.mean, r.std, r.min, r.p25, r.p50, r.p75, r.max] == [pytest.approx(x, abs=1e-6) for x in v]
    assert (got["w"]["count"], got["w"].mean, got["w"].std, got["w"].p50) == (1, 2.0, None, 2.0)
    assert "x" not in got
