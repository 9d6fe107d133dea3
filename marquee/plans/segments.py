"""Segment marts: genre x budget-tier ROI, trends, reliability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee import config as K
from marquee.functions.numeric import pct_change, round_dec
from marquee.functions.text import surrogate_key
from marquee.operators._joins import join_null_safe
from marquee.operators.percentile import group_median


# What the genre marts read of the facts; a row a genre carries no texts but the tier.
FACT_GENRE_COLUMNS = ["movie_id", "is_roi_eligible", "roi", "roi_pct", "revenue", "profit", "budget_tier", "budget_quartile", "release_year"]
COVERAGE_GENRE_COLUMNS = ["movie_id", "release_year", "budget", "revenue", "is_recommendation_eligible"]


def risk_band(stddev: Column) -> Column:
    return (F.when(stddev.isNull(), F.lit(K.RISK_INSUFFICIENT))
            .when(stddev <= K.RISK_LOW_MAX, F.lit(K.RISK_LOW))
            .when(stddev <= K.RISK_MODERATE_MAX, F.lit(K.RISK_MODERATE))
            .otherwise(F.lit(K.RISK_HIGH)))


def predictability(stddev: Column, success: Column) -> Column:
    return (F.when(stddev.isNull(), F.lit(K.PREDICTABILITY_LOW_CONFIDENCE))
            .when((stddev <= K.RISK_LOW_MAX) & (success >= K.PREDICTABILITY_HIGH_MIN_SUCCESS),
                  F.lit(K.PREDICTABILITY_HIGH))
            .when((stddev <= K.RISK_MODERATE_MAX) & (success >= K.PREDICTABILITY_MODERATE_MIN_SUCCESS),
                  F.lit(K.PREDICTABILITY_MODERATE))
            .otherwise(F.lit(K.PREDICTABILITY_VOLATILE)))


def _rank_order() -> list[Column]:
    return [F.col("__median").desc_nulls_last(), F.col("success_rate_pct").desc_nulls_last(),
            F.col("total_revenue").desc_nulls_last()]


def fact_genre_budget_roi(fact_genre: DataFrame) -> DataFrame:
    """Genre x budget tier ROI profile with volatility, predictability
    and three dense ranks (on the unrounded median).  ``fact_genre`` is the
    fact joined to its genres (J1), built once for all genre marts."""
    base = fact_genre.where(F.col("is_roi_eligible") & F.col("roi").isNotNull()
                            & (F.col("budget_tier") != K.BUDGET_TIER_UNKNOWN))
    keys = ["genre", "budget_tier", "budget_quartile"]
    agg = base.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("bigint").alias("movie_count"),
        round_dec(F.sum("revenue")).alias("total_revenue"),
        round_dec(F.sum("profit")).alias("total_profit"),
        round_dec(F.avg("roi_pct")).alias("avg_roi_pct"),
        F.stddev_samp("roi_pct").alias("__stddev"),
        F.count_if(F.col("profit") > 0).cast("bigint").alias("profitable_movies"),
        round_dec(F.try_divide(F.count_if(F.col("profit") > 0) * 100.0, F.count(F.lit(1))))
        .alias("success_rate_pct"),
        F.min("release_year").alias("first_release_year"),
        F.max("release_year").alias("last_release_year"),
    )
    med = group_median(base, keys, "roi_pct", out="__median")
    g = join_null_safe(agg, med, keys, "left")
    order = _rank_order()
    return g.select(
        surrogate_key("genre", "budget_tier").alias("genre_budget_profile_key"),
        *keys, "movie_count", "total_revenue", "total_profit", "avg_roi_pct",
        round_dec("__median").alias("median_roi_pct"),
        round_dec("__stddev").alias("roi_stddev_pct"),
        "profitable_movies", "success_rate_pct",
        risk_band(F.col("__stddev")).alias("risk_band"),
        predictability(F.col("__stddev"), F.col("success_rate_pct")).alias("predictability_label"),
        "first_release_year", "last_release_year",
        # the aggregate has one row per genre x tier: a small, global window
        F.dense_rank().over(Window.orderBy(*order)).cast("bigint").alias("median_roi_rank"),
        F.dense_rank().over(Window.partitionBy("genre").orderBy(*order)).cast("bigint")
        .alias("rank_within_genre"),
        F.dense_rank().over(Window.partitionBy("budget_tier").orderBy(*order)).cast("bigint")
        .alias("rank_within_budget_tier"),
    )


def fact_genre_budget_roi_recommendable(profile: DataFrame, min_sample: int = K.MIN_SEGMENT_SAMPLE,
                                        excluded=K.EXCLUDED_GENRES) -> DataFrame:
    """C11 (P8): enough movies and not an excluded genre."""
    return profile.where((F.col("movie_count") >= min_sample) & ~F.col("genre").isin(*excluded))


def fact_genre_market_momentum(fact_genre: DataFrame) -> DataFrame:
    """Genre x year revenue and ROI with the previous/next *present*
    year.  The label compares the rounded current median with the unrounded
    previous one, as the warehouse view does."""
    base = fact_genre.where(F.col("is_roi_eligible") & F.col("revenue").isNotNull()
                            & F.col("roi_pct").isNotNull())
    keys = ["genre", "release_year"]
    agg = base.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("bigint").alias("movie_count"),
        round_dec(F.sum("revenue")).alias("total_revenue"),
        round_dec(F.avg("roi_pct")).alias("avg_roi_pct"),
    )
    med = group_median(base, keys, "roi_pct", out="__median")
    g = join_null_safe(agg, med, keys, "left")
    w = Window.partitionBy("genre").orderBy(F.col("release_year").asc_nulls_last())
    g = g.select(
        *keys, "movie_count", "total_revenue", "avg_roi_pct",
        round_dec("__median").alias("median_roi_pct"),
        F.lag("total_revenue").over(w).alias("prev_year_revenue"),
        F.lag("__median").over(w).alias("__prev_median"),
        F.lead("__median").over(w).alias("__next_median"),
    )
    cur, prev = F.col("median_roi_pct"), F.col("__prev_median")
    label = (F.when(prev.isNull(), F.lit(K.MOMENTUM_INSUFFICIENT))
             .when(cur > prev, F.lit(K.MOMENTUM_UP))
             .when(cur < prev, F.lit(K.MOMENTUM_DOWN))
             .otherwise(F.lit(K.MOMENTUM_STABLE)))
    return g.select(
        surrogate_key("genre", "release_year").alias("genre_year_key"),
        *keys, "movie_count", "total_revenue", "avg_roi_pct", "median_roi_pct", "prev_year_revenue",
        round_dec(F.col("total_revenue") - F.col("prev_year_revenue")).alias("yoy_revenue_change"),
        pct_change("total_revenue", "prev_year_revenue").alias("yoy_revenue_change_pct"),
        round_dec(prev).alias("prev_year_median_roi_pct"),
        round_dec(cur - prev).alias("yoy_median_roi_pct_change"),
        round_dec("__next_median").alias("next_year_median_roi_pct"),
        label.alias("momentum_label"),
    )


def fact_genre_market_coverage_trends(coverage_genre: DataFrame) -> DataFrame:
    """Genre x year volume and revenue in the market-coverage scope
    (``coverage_genre`` = coverage fact joined to genres)."""
    base = coverage_genre
    keys = ["genre", "release_year"]
    agg = base.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("bigint").alias("movie_count"),
        round_dec(F.sum("revenue")).alias("total_revenue"),
        round_dec(F.avg("budget")).alias("avg_budget"),
        F.count_if(F.col("is_recommendation_eligible")).cast("bigint")
        .alias("recommendation_eligible_movie_count"),
    )
    med = group_median(base, keys, "revenue", out="__median")
    g = join_null_safe(agg, med, keys, "left")
    w = Window.partitionBy("genre").orderBy(F.col("release_year").asc_nulls_last())
    g = g.select(
        *keys, "movie_count", "total_revenue", "avg_budget",
        round_dec("__median").alias("median_revenue"), "recommendation_eligible_movie_count",
        F.lag("movie_count").over(w).alias("prev_year_movie_count"),
        F.lag("total_revenue").over(w).alias("prev_year_revenue"),
        F.lead("movie_count").over(w).alias("next_year_movie_count"),
    )
    cnt, pcnt = F.col("movie_count"), F.col("prev_year_movie_count")
    rev, prev = F.col("total_revenue"), F.col("prev_year_revenue")
    label = (F.when(pcnt.isNull(), F.lit(K.COVERAGE_INSUFFICIENT))
             .when((cnt > pcnt) & (rev >= F.coalesce(prev, rev)), F.lit(K.COVERAGE_EXPANDING))
             .when((cnt < pcnt) & (rev < F.coalesce(prev, rev)), F.lit(K.COVERAGE_CONTRACTING))
             .otherwise(F.lit(K.COVERAGE_MIXED)))
    return g.select(
        surrogate_key("genre", "release_year").alias("genre_market_coverage_year_key"),
        *keys, "movie_count", "total_revenue", "avg_budget", "median_revenue",
        "recommendation_eligible_movie_count", "prev_year_movie_count",
        (cnt - pcnt).alias("yoy_movie_count_change"),
        pct_change(cnt, pcnt).alias("yoy_movie_count_change_pct"),
        "prev_year_revenue", round_dec(rev - prev).alias("yoy_revenue_change"),
        pct_change(rev, prev).alias("yoy_revenue_change_pct"),
        "next_year_movie_count", label.alias("market_trend_label"),
    )


def catalog_reliability(stg_movies: DataFrame, by: list[str] | None = None) -> DataFrame:
    """How much of the catalogue is usable - counts and shares of the
    two scopes, overall or per ``by`` columns (one aggregation pass)."""
    by = by or []
    total = F.count(F.lit(1))
    rec = F.count_if(F.col("is_recommendation_eligible"))
    cov = F.count_if(F.col("is_market_coverage_eligible"))
    aggs = [
        total.cast("bigint").alias("movie_count"),
        rec.cast("bigint").alias("recommendation_eligible_count"),
        cov.cast("bigint").alias("market_coverage_eligible_count"),
        round_dec(F.try_divide(rec * 100.0, total)).alias("recommendation_eligible_pct"),
        round_dec(F.try_divide(cov * 100.0, total)).alias("market_coverage_eligible_pct"),
    ]
    return stg_movies.groupBy(*by).agg(*aggs) if by else stg_movies.agg(*aggs)
