"""Scope and model invariants on the smallest generated tables."""

import os

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="generated tables not present")


@pytest.fixture(scope="module")
def w(spark):
    from marquee.registry import wh
    return wh(spark, SF)


def test_recommendation_within_coverage(w):
    m = w.stg_movies
    assert m.where(F.col("is_recommendation_eligible") & ~F.col("is_market_coverage_eligible")).count() == 0
    assert m.where(F.col("is_recommendation_eligible")).count() > 0


def test_quartiles_balanced(w):
    sizes = [r["count"] for r in w.fact_movie_performance.groupBy("budget_quartile").count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1


def test_quartiles_ordered_by_budget(w):
    b = {r.budget_quartile: (r.lo, r.hi) for r in w.fact_movie_performance.groupBy("budget_quartile")
         .agg(F.min("budget").alias("lo"), F.max("budget").alias("hi")).collect()}
    assert all(b[q][1] <= b[q + 1][0] for q in (1, 2, 3))


def test_bridge_keys_in_dims(w):
    assert w.bridge_movie_genre.join(w.dim_genre, "genre_key", "left_anti").count() == 0
    assert w.bridge_movie_company.join(w.dim_company, "company_key", "left_anti").count() == 0
    assert w.bridge_movie_country.join(w.dim_country, "country_key", "left_anti").count() == 0


def test_all_quality_tests_pass(w):
    from marquee.plans.quality_suite import business_rule_suite
    failing = business_rule_suite(w.models(), w.scope).where("status <> 'pass'").collect()
    assert failing == []


def test_imputed_rows_never_recommendation_scope(w):
    m = w.stg_movies
    assert m.where(F.col("is_budget_imputed") & F.col("is_recommendation_eligible")).count() == 0
