"""Staging views (C29-C35): rename, null-key filters, scope recompute."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.config import Scope


def stg_movies(silver_movies: DataFrame, scope: Scope) -> DataFrame:
    """Recomputes is_roi_eligible from the flags and thresholds."""
    return silver_movies.where(F.col("id").isNotNull()).select(
        F.col("id").alias("movie_id"), "title", F.col("release_date").cast("date").alias("release_date"),
        "budget", "budget_reported", "is_budget_imputed", "budget_imputation_method", "revenue",
        "is_budget_reported", "is_revenue_reported", "is_market_coverage_eligible",
        "is_recommendation_eligible",
        (F.col("is_budget_reported") & F.col("is_revenue_reported")
         & (F.col("budget") >= scope.min_budget) & (F.col("revenue") >= scope.min_revenue))
        .alias("is_roi_eligible"),
    )


def stg_ratings(silver_ratings: DataFrame) -> DataFrame:
    """C30."""
    return silver_ratings.where(F.col("movie_id").isNotNull()).select(
        "movie_id", "avg_rating", "total_ratings", "std_dev", "last_rated")


def stg_movie_extended(silver_extended: DataFrame) -> DataFrame:
    """C31."""
    return silver_extended.where(F.col("id").isNotNull()).select(
        F.col("id").alias("movie_id"), "genres", "production_companies", "production_countries",
        "spoken_languages")


def stg_tokens(mapping: DataFrame, value: str) -> DataFrame:
    """Trimmed, non-blank tokens with an id."""
    return mapping.where(F.col("movie_id").isNotNull() & F.col(value).isNotNull()
                         & (F.trim(value) != "")).select("movie_id", F.trim(value).alias(value))


def stg_movies_roi_eligible(stg: DataFrame) -> DataFrame:
    """Investment-analysis scope only."""
    return stg.where(F.col("is_recommendation_eligible") & F.col("movie_id").isNotNull()).select(
        "movie_id", "title", "release_date", "budget", "revenue", "is_budget_reported",
        "is_revenue_reported", "is_recommendation_eligible", "is_roi_eligible")
