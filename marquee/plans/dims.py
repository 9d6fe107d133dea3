"""Dimensions and bridges.

Dimension tables hold distinct tokens (genres, countries, companies, dates):
their size is bounded by the token vocabulary, not by the fact.  Surrogate
keys over them use a global window, which is fine at that size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.config import BUDGET_TIER_DEFINITIONS, BUDGET_TIER_UNCLASSIFIED
from marquee.functions.dates import date_key, is_weekend, iso_day_of_week, month_name
from marquee.operators.multival import bridge


def dim_date(stg_movies: DataFrame, pad_month_name: bool = True) -> DataFrame:
    """C14: distinct release dates of ROI-eligible movies + calendar parts."""
    d = stg_movies.where(F.col("release_date").isNotNull() & F.col("is_roi_eligible")) \
        .select(F.col("release_date").alias("date_day")).distinct()
    return d.select(
        date_key("date_day").alias("date_key"), "date_day",
        F.year("date_day").alias("year"), F.quarter("date_day").alias("quarter"),
        F.month("date_day").alias("month"), month_name("date_day", pad_month_name).alias("month_name"),
        F.dayofmonth("date_day").alias("day"), iso_day_of_week("date_day").alias("day_of_week"),
        is_weekend("date_day").alias("is_weekend"),
    )


DIM_MOVIE_COLUMNS = [
    "movie_id", "title", "release_date", "release_year", "release_month", "budget", "budget_tier",
    "budget_quartile", "revenue", "profit", "roi", "roi_pct", "is_budget_reported",
    "is_revenue_reported", "is_roi_eligible", "avg_rating", "total_ratings", "std_dev", "last_rated",
]


def dim_movie(fact_wide: DataFrame) -> DataFrame:
    """The wide fact is 1:1 with the dimension, so it is a projection."""
    return fact_wide.select(*DIM_MOVIE_COLUMNS)


def dim_budget_tier(fact: DataFrame) -> DataFrame:
    """The (at most four) tiers present, dense key by quartile."""
    tiers = fact.where(F.col("budget_tier").isNotNull()).select("budget_tier", "budget_quartile").distinct()
    definition = F.lit(BUDGET_TIER_UNCLASSIFIED)
    for k in sorted(BUDGET_TIER_DEFINITIONS, reverse=True):
        definition = F.when(F.col("budget_quartile") == k, F.lit(BUDGET_TIER_DEFINITIONS[k])).otherwise(definition)
    return tiers.select(
        F.dense_rank().over(Window.orderBy("budget_quartile")).cast("bigint").alias("budget_tier_key"),
        "budget_tier", "budget_quartile", definition.alias("budget_tier_definition"))


def _distinct_tokens(stg: DataFrame, value: str) -> DataFrame:
    return stg.where(F.col(value).isNotNull() & (F.trim(value) != "")) \
        .select(F.trim(value).alias(value)).distinct()


def dim_dense(stg: DataFrame, value: str, key: str) -> DataFrame:
    """Distinct trimmed token + dense_rank key in token order."""
    toks = _distinct_tokens(stg, value)
    return toks.select(F.dense_rank().over(Window.orderBy(value)).cast("bigint").alias(key), value)


def dim_company(stg_companies: DataFrame) -> DataFrame:
    """One row per case-folded company, canonical = min raw spelling,
    md5 key of the folded name (A9, F20)."""
    toks = _distinct_tokens(stg_companies, "company")
    return toks.groupBy(F.upper("company").alias("company_norm")) \
        .agg(F.min("company").alias("company")) \
        .select(F.md5("company_norm").alias("company_key"), "company", "company_norm")


def bridge_genre(stg_genres: DataFrame, dim: DataFrame) -> DataFrame:
    """C20."""
    src = stg_genres.where(F.col("genre").isNotNull() & (F.trim("genre") != "")) \
        .select("movie_id", F.trim("genre").alias("genre"))
    return bridge(src, dim, "genre", ["genre_key", "genre"])


def bridge_company(stg_companies: DataFrame, dim: DataFrame) -> DataFrame:
    """Matched on the case-folded name."""
    src = stg_companies.where(F.col("company").isNotNull() & (F.trim("company") != "")) \
        .select("movie_id", F.upper(F.trim("company")).alias("company_norm"))
    return bridge(src, dim, "company_norm", ["company_key", "company", "company_norm"])


def bridge_country(stg_countries: DataFrame, dim: DataFrame) -> DataFrame:
    """C22."""
    src = stg_countries.where(F.col("country").isNotNull() & (F.trim("country") != "")) \
        .select("movie_id", F.trim("country").alias("country"))
    return bridge(src, dim, "country", ["country_key", "country"])
