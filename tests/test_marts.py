"""Mart logic on the hand-made edge rows of FIXTURES.md section 3 (C10,
C12/C13, C19, C14, C8)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marquee import config as K
from marquee.plans import dims, facts, segments


def _genre_fact(spark, rows):
    # rows: genre, tier, quartile, movie_id, revenue, profit, roi_pct, year
    return spark.createDataFrame(
        [(g, t, q, m, r, p, x, y, True, 0.0) for g, t, q, m, r, p, x, y in rows],
        "genre string, budget_tier string, budget_quartile int, movie_id long, revenue double, profit double, "
        "roi_pct double, release_year int, is_roi_eligible boolean, roi double")


def test_risk_and_predictability_boundaries(spark):
    low = K.BUDGET_TIER_LABELS[1]
    rows = [("Solo", low, 1, 1, 10.0, 1.0, 5.0, 2000)]                      # one movie: stddev NULL
    # stddev exactly 50 and success 100 %: values 0 and 100*sqrt(0.5)*... use two values 50 apart*sqrt2
    import math
    d = 50 * math.sqrt(2)
    rows += [("Edge50", low, 1, 2, 10.0, 1.0, 0.0, 2000), ("Edge50", low, 1, 3, 10.0, 1.0, d, 2001)]
    rows += [("Wide", low, 1, 4, 10.0, -1.0, 0.0, 2000), ("Wide", low, 1, 5, 10.0, 1.0, 1000.0, 2002)]
    out = {r.genre: r for r in segments.fact_genre_budget_roi(_genre_fact(spark, rows)).collect()}
    assert out["Solo"].risk_band == K.RISK_INSUFFICIENT and out["Solo"].predictability_label == \
        K.PREDICTABILITY_LOW_CONFIDENCE and out["Solo"].roi_stddev_pct is None
    assert out["Edge50"].roi_stddev_pct == 50.0 and out["Edge50"].risk_band in (K.RISK_LOW, K.RISK_MODERATE)
    assert out["Wide"].risk_band == K.RISK_HIGH and out["Wide"].success_rate_pct == 50.0
    assert out["Wide"].predictability_label == K.PREDICTABILITY_VOLATILE
    assert out["Wide"].median_roi_pct == 500.0 and out["Wide"].median_roi_rank == 1
    assert {r.genre_budget_profile_key for r in out.values()} == {
        __import__("hashlib").md5(f"{g}||{low}".encode()).hexdigest() for g in out}


def test_predictability_thresholds_inclusive(spark):
    from marquee.plans.segments import predictability, risk_band
    df = spark.createDataFrame([(50.0, 70.0), (125.0, 55.0), (125.0, 54.99), (125.01, 90.0), (None, 90.0)],
                               "sd double, s double")
    got = [(r.r, r.p) for r in df.select(risk_band(F.col("sd")).alias("r"),
                                         predictability(F.col("sd"), F.col("s")).alias("p")).collect()]
    assert got == [(K.RISK_LOW, K.PREDICTABILITY_HIGH), (K.RISK_MODERATE, K.PREDICTABILITY_MODERATE),
                   (K.RISK_MODERATE, K.PREDICTABILITY_VOLATILE), (K.RISK_HIGH, K.PREDICTABILITY_VOLATILE),
                   (K.RISK_INSUFFICIENT, K.PREDICTABILITY_LOW_CONFIDENCE)]


def test_momentum_labels_previous_present_year(spark):
    # 2000, 2001, gap, 2003 (equal median), NULL year
    rows = [("G", "t", 1, 1, 100.0, 1.0, 10.0, 2000), ("G", "t", 1, 2, 100.0, 1.0, 20.0, 2001),
            ("G", "t", 1, 3, 100.0, 1.0, 20.0, 2003), ("G", "t", 1, 4, 50.0, 1.0, 5.0, None)]
    fg = _genre_fact(spark, rows)
    out = {r.release_year: r for r in segments.fact_genre_market_momentum(fg).collect()}
    assert out[2000].momentum_label == K.MOMENTUM_INSUFFICIENT
    assert out[2001].momentum_label == K.MOMENTUM_UP and out[2001].yoy_revenue_change_pct == 0.0
    assert out[2003].momentum_label == K.MOMENTUM_STABLE and out[2003].prev_year_median_roi_pct == 20.0
    assert out[None].prev_year_median_roi_pct == 20.0       # NULL year sorts last, like the warehouse
    assert out[None].genre_year_key == __import__("hashlib").md5(b"G").hexdigest()


def test_coverage_labels(spark):
    df = spark.createDataFrame(
        [(i, "G", y, r, 10000.0, True) for i, (y, r) in enumerate(
            [(2000, 10.0), (2001, 8.0), (2001, 8.0), (2002, 1.0), (2003, 100.0), (2003, 1.0), (2003, 1.0)])],
        "movie_id long, genre string, release_year int, revenue double, budget double, "
        "is_recommendation_eligible boolean")
    out = {r.release_year: r.market_trend_label for r in segments.fact_genre_market_coverage_trends(df).collect()}
    assert out == {2000: K.COVERAGE_INSUFFICIENT, 2001: K.COVERAGE_EXPANDING, 2002: K.COVERAGE_CONTRACTING,
                   2003: K.COVERAGE_EXPANDING}


def test_dim_company_case_folding(spark):
    stg = spark.createDataFrame([(1, "Pixar"), (2, "PIXAR"), (3, " pixar "), (3, "Pixar"), (4, "")],
                                "movie_id long, company string")
    d = dims.dim_company(stg).collect()
    assert [(r.company, r.company_norm) for r in d] == [("PIXAR", "PIXAR")]   # min raw spelling
    b = dims.bridge_company(stg, dims.dim_company(stg)).collect()
    assert sorted(r.movie_id for r in b) == [1, 2, 3]


def test_dim_date_parts(spark):
    stg = spark.createDataFrame([(dt.date(2016, 4, 23), True), (dt.date(2016, 4, 25), True),
                                 (dt.date(2016, 4, 26), False), (None, True)],
                                "release_date date, is_roi_eligible boolean")
    out = {r.date_key: r for r in dims.dim_date(stg).collect()}
    assert set(out) == {20160423, 20160425}
    sat, mon = out[20160423], out[20160425]
    assert (sat.day_of_week, sat.is_weekend, mon.day_of_week, mon.is_weekend) == (6, True, 1, False)
    assert sat.month_name == "April    " and sat.quarter == 2


@pytest.mark.parametrize("pct,label", [(300.0, "Massive Hit (300%+)"), (299.99, "Strong Hit (100-300%)"),
                                       (0.0, "Profitable (0-100%)"), (-0.01, "Loss (<0%)")])
def test_profitability_tiers(spark, pct, label):
    got = spark.createDataFrame([(pct,)], "p double").select(facts.profitability_tier(F.col("p"))).first()[0]
    assert got == label


def test_budget_quartiles_edge_rows(spark):
    rows = [(i, b) for i, b in enumerate([5.0, 5.0, 5.0, 1.0, 9.0, 7.0, 7.0, 3.0, 8.0, 2.0], start=1)]
    rows += [(20, 0.0), (21, None), (22, -4.0)]           # no quartile for non-positive / missing
    df = spark.createDataFrame(rows, "movie_id long, budget double")
    out = {r.movie_id: r.budget_quartile for r in facts.budget_quartiles(df).collect()}
    sizes = [sum(1 for q in out.values() if q == k) for k in (1, 2, 3, 4)]
    assert sizes == [3, 3, 2, 2]
    assert out[20] is None and out[21] is None and out[22] is None
    # ties on budget 5.0 are ordered by movie_id: ids 1, 2, 3 sit at ranks 4-6
    assert [out[1], out[2], out[3]] == [2, 2, 2]
    few = spark.createDataFrame([(1, 10.0), (2, 20.0)], "movie_id long, budget double")
    assert sorted(r.budget_quartile for r in facts.budget_quartiles(few).collect()) == [1, 2]
