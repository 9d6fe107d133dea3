"""Movie-grain facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.config import (BUDGET_TIER_LABELS, PROFITABILITY_LOSS, PROFITABILITY_TIERS,
                            SCOPE_LABEL_COVERAGE, SCOPE_LABEL_VERIFIED)
from marquee.functions.dates import date_key, decade
from marquee.functions.numeric import profit, rint_bigint, roi, roi_pct
from marquee.operators.ordered import distributed_ntile


def budget_tier_label(q) -> F.Column:
    expr = F.lit(None).cast("string")
    for k in sorted(BUDGET_TIER_LABELS, reverse=True):
        expr = F.when(q == k, F.lit(BUDGET_TIER_LABELS[k])).otherwise(expr)
    return expr


def profitability_tier(pct) -> F.Column:
    expr = F.lit(PROFITABILITY_LOSS)
    for bound, label in reversed(PROFITABILITY_TIERS):
        expr = F.when(pct >= bound, F.lit(label)).otherwise(expr)
    return expr


def budget_quartiles(base: DataFrame) -> DataFrame:
    """Quartile of budget among rows with a positive budget, NULL for
    the others, in one pass (union, no self re-join).  Ties are ordered by
    movie_id so the split is deterministic."""
    positive = F.col("budget").isNotNull() & (F.col("budget") > 0)
    ranked_part = base.where(positive)
    rest = base.where(~positive | F.col("budget").isNull()) \
        .withColumn("budget_quartile", F.lit(None).cast("int"))
    ranked = distributed_ntile(ranked_part, 4, ["budget", "movie_id"], out="budget_quartile")
    return ranked.unionByName(rest)


FACT_PERFORMANCE_COLUMNS = [
    "movie_id", "date_key", "budget", "budget_tier", "budget_quartile", "revenue",
    "financial_data_status", "profit", "roi", "roi_pct", "is_budget_reported",
    "is_revenue_reported", "is_roi_eligible", "avg_rating", "total_ratings", "std_dev",
]


def fact_movie_performance_wide(stg_movies: DataFrame, stg_ratings: DataFrame) -> DataFrame:
    """C7 plus the title/date attributes the marts need (avoids re-joining
    dim_movie, which is 1:1 with the fact)."""
    base = stg_movies.where(F.col("is_recommendation_eligible")).select(
        "movie_id", "title", "release_date", "budget", "revenue", "is_budget_reported",
        "is_revenue_reported", "is_roi_eligible", "is_market_coverage_eligible",
        "is_recommendation_eligible").join(stg_ratings, "movie_id", "left")
    q = budget_quartiles(base)
    return q.select(
        "movie_id", date_key("release_date").alias("date_key"), "budget",
        budget_tier_label(F.col("budget_quartile")).alias("budget_tier"),
        F.col("budget_quartile").cast("int").alias("budget_quartile"), "revenue",
        F.lit(SCOPE_LABEL_VERIFIED).alias("financial_data_status"),
        profit("revenue", "budget").alias("profit"),
        roi("revenue", "budget").alias("roi"),
        roi_pct("revenue", "budget").alias("roi_pct"),
        "is_budget_reported", "is_revenue_reported", "is_roi_eligible",
        "avg_rating", "total_ratings", "std_dev",
        # extra attributes (not part of the published fact)
        "title", "release_date", F.year("release_date").alias("release_year"),
        F.month("release_date").alias("release_month"), "last_rated",
    )


def fact_movie_performance(wide: DataFrame) -> DataFrame:
    return wide.select(*FACT_PERFORMANCE_COLUMNS)


def fact_movie_roi_analysis(wide: DataFrame) -> DataFrame:
    """Integer money (half-even rounding like the warehouse cast),
    profitability tier on the fact's roi_pct, ROI recomputed on integers.
    The wide fact has the titles, dates and ratings: no join."""
    j = wide.where(F.col("is_roi_eligible")).withColumnsRenamed(
        {"budget": "f_budget", "revenue": "f_revenue", "roi_pct": "f_roi_pct"})
    budget = rint_bigint("f_budget")
    revenue = rint_bigint("f_revenue")
    return j.select(
        "movie_id", "title", "release_date",
        F.year("release_date").alias("release_year"), F.month("release_date").alias("release_month"),
        budget.alias("budget"), "budget_tier", "budget_quartile", revenue.alias("revenue"),
        (revenue - budget).alias("profit"),
        roi_pct(revenue, budget).alias("roi_pct"),
        profitability_tier(F.col("f_roi_pct")).alias("profitability_tier"),
        "avg_rating", "total_ratings", "std_dev",
    )


def fact_movie_market_coverage(stg_movies: DataFrame, stg_ratings: DataFrame,
                               stg_extended: DataFrame) -> DataFrame:
    """Market-coverage scope with decade and extended attributes."""
    m = stg_movies.where(F.col("movie_id").isNotNull() & F.col("is_market_coverage_eligible"))
    j = m.join(stg_ratings, "movie_id", "left").join(stg_extended, "movie_id", "left")
    year = F.year("release_date")
    return j.select(
        "movie_id", "title", "release_date", year.alias("release_year"),
        F.month("release_date").alias("release_month"), decade(year).alias("release_decade"),
        "budget", "revenue", "is_budget_reported", "is_revenue_reported", "is_budget_imputed",
        "budget_imputation_method", "is_recommendation_eligible",
        F.lit(SCOPE_LABEL_COVERAGE).alias("benchmark_scope_label"),
        "avg_rating", "total_ratings", "std_dev", "last_rated",
        "genres", "production_companies", "production_countries", "spoken_languages",
    )
