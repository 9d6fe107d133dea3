"""Cleaning of the three catalogue inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.config import Scope
from marquee.functions.dates import epoch_to_timestamp, parse_mixed_date
from marquee.functions.numeric import bool_or_false, to_number, to_positive_number
from marquee.functions.text import literal_names_text, literal_or_csv_tokens, literal_values
from marquee.operators.dedup import keep_first, keep_smallest


def id_as_bigint(df: DataFrame, column: str):
    """F5 expression: integral ids pass through; text goes text -> number ->
    bigint (12.0 -> 12), unparsable -> NULL."""
    from pyspark.sql.types import IntegralType
    if isinstance(df.schema[column].dataType, IntegralType):
        return F.col(column).cast("bigint")
    return to_number(column).try_cast("bigint")


def normalize_id(df: DataFrame, column: str = "id") -> DataFrame:
    """numeric id; rows without one are dropped."""
    return df.withColumn(column, id_as_bigint(df, column)).where(F.col(column).isNotNull())


def _positive(df: DataFrame, column: str):
    """F4 + F6 expression: a double is a number unless it is NaN or infinite; its
    text need not be made and parsed."""
    if dict(df.dtypes)[column] != "double":
        return to_positive_number(column)
    return F.when((F.col(column) > 0) & (F.col(column) < float("inf")), F.col(column))


def _dedup_first(df: DataFrame, key: str = "id") -> DataFrame:
    # keep-first in ingest order when the input carries one; otherwise the
    # smallest row, so the choice is deterministic
    if "ingest_seq" in df.columns:
        return keep_first(df, [key], ["ingest_seq"]).drop("ingest_seq")
    return keep_smallest(df, [key])


def eligibility_flags(df: DataFrame, scope: Scope) -> DataFrame:
    """Market-coverage and recommendation scopes plus legacy aliases.
    NULL comparisons count as False."""
    coverage = (F.col("is_revenue_reported") & (F.col("budget") >= scope.min_budget)
                & (F.col("revenue") > 0))
    recommendation = (F.col("is_budget_reported") & F.col("is_revenue_reported")
                      & (F.col("budget") >= scope.min_budget)
                      & (F.col("revenue") >= scope.min_revenue))
    return df.withColumns({
        "is_market_coverage_eligible": bool_or_false(coverage),
        "is_recommendation_eligible": bool_or_false(recommendation),
    }).withColumns({
        "roi_eligible_imputed": F.col("is_market_coverage_eligible"),
        "roi_eligible_strict": F.col("is_recommendation_eligible"),
        "is_roi_eligible": F.col("is_recommendation_eligible"),
    })


def clean_movies(df: DataFrame, scope: Scope) -> DataFrame:
    """C4: keep-first per id -> numeric id -> mixed-format dates -> positive
    financials -> optional enrichment columns -> flags."""
    out = normalize_id(_dedup_first(df))
    if dict(out.dtypes)["release_date"] != "date":  # a date's text parses to that date
        out = out.withColumn("release_date", parse_mixed_date("release_date"))
    out = out.withColumns({"budget": _positive(out, "budget"),
                           "revenue": _positive(out, "revenue")})
    cols = set(out.columns)
    # Optional enrichment columns get stable defaults
    out = out.withColumn("budget_reported", _positive(out, "budget_reported")
                         if "budget_reported" in cols else F.col("budget"))
    out = out.withColumn("is_budget_imputed", bool_or_false("is_budget_imputed")
                         if "is_budget_imputed" in cols else F.lit(False))
    if "budget_imputation_method" not in cols:
        out = out.withColumn("budget_imputation_method", F.lit(None).cast("string"))
    out = out.withColumn("is_budget_reported", bool_or_false("is_budget_reported")
                         if "is_budget_reported" in cols else F.col("budget_reported").isNotNull())
    out = out.withColumn("is_revenue_reported", bool_or_false("is_revenue_reported")
                         if "is_revenue_reported" in cols else F.col("revenue").isNotNull())
    return eligibility_flags(out, scope)


def clean_ratings(df: DataFrame) -> DataFrame:
    """Flatten the nested summary (a missing summary gives NULLs), numeric
    movie id, epoch seconds -> timestamp (0 -> NULL)."""
    return df.select(
        id_as_bigint(df, "movie_id").alias("movie_id"),
        F.col("ratings_summary.avg_rating").cast("double").alias("avg_rating"),
        F.col("ratings_summary.total_ratings").cast("bigint").alias("total_ratings"),
        F.col("ratings_summary.std_dev").cast("double").alias("std_dev"),
        epoch_to_timestamp("last_rated").alias("last_rated"),
    )


def clean_extended(df: DataFrame, tokens: str | None = None) -> DataFrame:
    """Keep-first per id -> numeric id -> country and language list
    literals to comma-joined names (genres and companies untouched).

    ``tokens`` names a column for the countries as an array, names with commas
    whole, from the same parse."""
    out = normalize_id(_dedup_first(df)).withColumn("__countries", literal_values("production_countries"))
    countries = F.col("__countries")
    more = {tokens: literal_or_csv_tokens("production_countries", values=countries)} if tokens else {}
    return out.withColumns(more | {
        "production_countries": literal_names_text("production_countries", values=countries),
        "spoken_languages": literal_names_text("spoken_languages"),
    }).drop("__countries")
