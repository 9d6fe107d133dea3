"""Tiered matching against a brute-force tier-by-tier reading; imputation
and scope flags on edge rows."""

from pyspark.sql import functions as F

from marquee.config import IMPUTE_MEDIAN_LABEL, IMPUTE_RATIO_LABEL, Scope
from marquee.operators import impute, match
from marquee.plans.clean import eligibility_flags

CAT = [  # id, title, release_date, budget, revenue
    ("1", "Alpha", "2000-01-01", "0", "500"), ("2", "Alpha", "01/01/2001", "0", "10"),
    ("3", "Alpha", "2005-06-06", "100", "50"), ("4", "Beta", None, "0", "0"),
    ("5", None, "2000-01-01", "0", "1"), ("6", "Gamma", "2010-01-01", "", "100"),
    ("7", "Delta", "2010-01-01", "5", "abc"), ("x", "Alpha", "2000-01-01", "1", "1"),
]
EXT = [  # title, release_date, budget, revenue
    ("ALPHA", "2000-03-03", "700", "9"), ("alpha!", "1999-01-01", "700", "9"), ("Alpha", "2000-01-01", "50", "1"),
    ("Beta", "1990-01-01", None, "5"), ("Beta", "1991-01-01", "0", "7"), ("Gamma", "2011-02-02", "0", None),
    (None, "2000-01-01", "1", "1"),
]


def brute_force(cat_rows, ext_rows):
    """Each tier only sees the previous tier's rejects, as in the reference."""
    def by_title(rows):
        best = {}
        for r in rows:
            k = r["title_norm"]
            key = (r["ext_budget"] is not None, r["ext_budget"] or 0, r["ext_revenue"] is not None,
                   r["ext_revenue"] or 0, r["release_year"] is not None, -(r["release_year"] or 0))
            if k is not None and (k not in best or key > best[k][0]):
                best[k] = (key, r)
        return {k: v[1] for k, v in best.items()}
    ext = by_title(ext_rows)
    out = {}
    for c in cat_rows:
        e = ext.get(c["title_norm"])
        y, ey = c["release_year"], (e or {}).get("release_year")
        tiers = [("exact", lambda: y is not None and ey is not None and y == ey),
                 ("buffer", lambda: y is not None and ey is not None and abs(y - ey) <= 1),
                 ("title_only", lambda: True)]
        tier = "unmatched"
        if e is not None and e["ext_budget"] is not None:
            tier = next(name for name, ok in tiers if ok())
        out[c["id"]] = (tier, e["ext_budget"] if tier != "unmatched" else None)
    return out


def test_one_join_equals_three_tiers(spark):
    cat = match.prepare_catalogue(spark.createDataFrame(CAT, "id string, title string, release_date string, "
                                                            "budget string, revenue string"))
    ext = match.prepare_benchmark(spark.createDataFrame(EXT, "title string, release_date string, budget string, "
                                                             "revenue string"))
    got = {r.id: (r.match_tier, r.ext_budget) for r in
           match.tiered_match(cat, match.dedup_benchmark(ext)).collect()}
    want = brute_force([r.asDict() for r in cat.collect()], [r.asDict() for r in ext.collect()])
    assert got == want
    assert got[1] == ("buffer", 700.0) and got[2] == ("title_only", 700.0) and got[4] == ("title_only", 0.0)  # budget 0 is "matched" (not NULL)
    assert "x" not in got  # non-numeric id dropped


def _fin(spark, rows):
    return spark.createDataFrame(rows, "id long, budget_reported double, revenue double, is_ext_enriched boolean")


def test_impute_ratio_and_fallbacks(spark):
    rows = [(1, None, 200.0, False), (2, 100.0, 50.0, False), (3, None, None, False), (4, 10.0, None, True)]
    fin = _fin(spark, rows)
    base = impute.imputation_baselines(fin)
    assert tuple(base.first()) == (2.0, 10.0)          # lower medians
    out = {r.id: r for r in impute.impute_budget(fin, base).collect()}
    assert out[1].budget == 400.0 and out[1].budget_imputation_method == IMPUTE_RATIO_LABEL
    assert out[3].budget is None and not out[3].is_budget_imputed   # no revenue anchor
    assert out[4].is_enriched and out[4].is_budget_reported
    one = lambda *v: spark.createDataFrame([v], "median_budget_revenue_ratio double, median_budget double")
    only_median = {r.id: r for r in impute.impute_budget(fin, one(None, 10.0)).collect()}
    assert only_median[1].budget == 10.0 and only_median[1].budget_imputation_method == IMPUTE_MEDIAN_LABEL
    nothing = {r.id: r for r in impute.impute_budget(fin, impute.imputation_baselines(fin.limit(0))).collect()}
    assert nothing[1].budget is None and nothing[1].budget_imputation_method is None


def test_scope_flags_null_safe(spark):
    df = spark.createDataFrame([(True, True, 20000.0, 2e6), (True, True, None, 2e6), (False, True, 5e4, 5e4),
                                (True, False, 5e4, None)],
                               "is_budget_reported boolean, is_revenue_reported boolean, budget double, revenue double")
    rows = eligibility_flags(df, Scope()).collect()
    assert [r.is_recommendation_eligible for r in rows] == [True, False, False, False]
    assert [r.is_market_coverage_eligible for r in rows] == [True, False, True, False]
    assert all(r.is_roi_eligible == r.is_recommendation_eligible for r in rows)


def test_salted_match_equals_plain_with_hot_title(spark):
    # one title key holds most catalogue rows; salting must not change the result
    rows = [(str(i), "Alpha" if i % 3 else "Beta", "2000-01-01", "0", "5") for i in range(300)]
    cat = match.prepare_catalogue(spark.createDataFrame(rows, "id string, title string, release_date string, "
                                                              "budget string, revenue string"))
    ext = match.dedup_benchmark(match.prepare_benchmark(spark.createDataFrame(
        EXT, "title string, release_date string, budget string, revenue string")))
    plain = match.tiered_match(cat, ext, hot_threshold=None).collect()
    salted = match.tiered_match(cat, ext, hot_threshold=10, salt_buckets=4).collect()
    assert sorted(plain) == sorted(salted) and len(salted) == 300
