"""The warehouse's data-quality suite: schema tests (not_null, unique,
accepted_values, relationships) and the singular business-rule tests, plus
the cleaning steps' expected-count checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import config as K
from marquee.operators.quality import (expected_count_checks, relationship_failure_counts, relationship_failures,
                                       run_rules, unique_failures)
from marquee.session import materialize

TIERS = [K.BUDGET_TIER_LABELS[k] for k in (1, 2, 3, 4)]
PROFIT_TIERS = [label for _, label in K.PROFITABILITY_TIERS] + [K.PROFITABILITY_LOSS]

# The schema tests as (model, column, test, argument).
SCHEMA_TESTS = [
    ("stg_movies", "movie_id", "not_null", None),
    ("stg_movies", "movie_id", "unique", None),
    ("stg_movies", "is_budget_reported", "not_null", None),
    ("stg_movies", "is_budget_reported", "accepted_values", [True, False]),
    ("stg_movies", "is_revenue_reported", "not_null", None),
    ("stg_movies", "is_revenue_reported", "accepted_values", [True, False]),
    ("stg_movies", "is_market_coverage_eligible", "not_null", None),
    ("stg_movies", "is_market_coverage_eligible", "accepted_values", [True, False]),
    ("stg_movies", "is_recommendation_eligible", "not_null", None),
    ("stg_movies", "is_recommendation_eligible", "accepted_values", [True, False]),
    ("stg_ratings", "movie_id", "not_null", None),
    ("stg_ratings", "movie_id", "unique", None),
    ("stg_movie_extended", "movie_id", "not_null", None),
    ("stg_movie_genres", "movie_id", "not_null", None),
    ("stg_movie_genres", "genre", "not_null", None),
    ("stg_movie_companies", "movie_id", "not_null", None),
    ("stg_movie_companies", "company", "not_null", None),
    ("stg_movie_countries", "movie_id", "not_null", None),
    ("stg_movie_countries", "country", "not_null", None),
    ("stg_movies_roi_eligible", "movie_id", "not_null", None),
    ("stg_movies_roi_eligible", "movie_id", "unique", None),
    ("stg_movies_roi_eligible", "title", "not_null", None),
    ("stg_movies_roi_eligible", "is_recommendation_eligible", "not_null", None),
    ("stg_movies_roi_eligible", "is_recommendation_eligible", "accepted_values", [True, False]),
    ("dim_date", "date_key", "not_null", None),
    ("dim_date", "date_key", "unique", None),
    ("dim_date", "date_day", "not_null", None),
    ("dim_date", "date_day", "unique", None),
    ("dim_movie", "movie_id", "not_null", None),
    ("dim_movie", "movie_id", "unique", None),
    ("dim_budget_tier", "budget_tier_key", "not_null", None),
    ("dim_budget_tier", "budget_tier_key", "unique", None),
    ("dim_budget_tier", "budget_tier", "not_null", None),
    ("dim_budget_tier", "budget_tier", "unique", None),
    ("dim_budget_tier", "budget_tier", "accepted_values", TIERS),
    ("dim_genre", "genre_key", "not_null", None),
    ("dim_genre", "genre_key", "unique", None),
    ("dim_genre", "genre", "not_null", None),
    ("dim_genre", "genre", "unique", None),
    ("dim_company", "company_key", "not_null", None),
    ("dim_company", "company_key", "unique", None),
    ("dim_company", "company", "not_null", None),
    ("dim_company", "company", "unique", None),
    ("dim_company", "company_norm", "not_null", None),
    ("dim_company", "company_norm", "unique", None),
    ("dim_country", "country_key", "not_null", None),
    ("dim_country", "country_key", "unique", None),
    ("dim_country", "country", "not_null", None),
    ("dim_country", "country", "unique", None),
    ("fact_movie_performance", "movie_id", "not_null", None),
    ("fact_movie_performance", "movie_id", "relationships", ("dim_movie", "movie_id")),
    ("fact_movie_performance", "date_key", "relationships", ("dim_date", "date_key")),
    ("fact_movie_performance", "budget_tier", "not_null", None),
    ("fact_movie_performance", "budget_tier", "accepted_values", TIERS),
    ("fact_movie_roi_analysis", "movie_id", "not_null", None),
    ("fact_movie_roi_analysis", "movie_id", "unique", None),
    ("fact_movie_roi_analysis", "movie_id", "relationships", ("dim_movie", "movie_id")),
    ("fact_movie_roi_analysis", "title", "not_null", None),
    ("fact_movie_roi_analysis", "budget_tier", "not_null", None),
    ("fact_movie_roi_analysis", "budget_tier", "accepted_values", TIERS),
    ("fact_movie_roi_analysis", "profitability_tier", "not_null", None),
    ("fact_movie_roi_analysis", "profitability_tier", "accepted_values", PROFIT_TIERS),
    ("fact_movie_market_coverage", "movie_id", "not_null", None),
    ("fact_movie_market_coverage", "movie_id", "unique", None),
    ("fact_movie_market_coverage", "title", "not_null", None),
    ("fact_movie_market_coverage", "is_recommendation_eligible", "not_null", None),
    ("fact_movie_market_coverage", "is_recommendation_eligible", "accepted_values", [True, False]),
    ("fact_genre_budget_roi", "genre_budget_profile_key", "not_null", None),
    ("fact_genre_budget_roi", "genre_budget_profile_key", "unique", None),
    ("fact_genre_budget_roi", "genre", "not_null", None),
    ("fact_genre_budget_roi", "budget_tier", "not_null", None),
    ("fact_genre_budget_roi_recommendable", "genre_budget_profile_key", "not_null", None),
    ("fact_genre_budget_roi_recommendable", "genre_budget_profile_key", "unique", None),
    ("fact_genre_budget_roi_recommendable", "genre", "not_null", None),
    ("fact_genre_budget_roi_recommendable", "budget_tier", "not_null", None),
    ("fact_genre_market_momentum", "genre_year_key", "not_null", None),
    ("fact_genre_market_momentum", "genre_year_key", "unique", None),
    ("fact_genre_market_momentum", "genre", "not_null", None),
    ("fact_genre_market_momentum", "release_year", "not_null", None),
    ("fact_genre_market_coverage_trends", "genre_market_coverage_year_key", "not_null", None),
    ("fact_genre_market_coverage_trends", "genre_market_coverage_year_key", "unique", None),
    ("fact_genre_market_coverage_trends", "genre", "not_null", None),
    ("fact_genre_market_coverage_trends", "release_year", "not_null", None),
    ("bridge_movie_genre", "movie_id", "not_null", None),
    ("bridge_movie_genre", "movie_id", "relationships", ("stg_movies", "movie_id")),
    ("bridge_movie_genre", "genre_key", "not_null", None),
    ("bridge_movie_genre", "genre_key", "relationships", ("dim_genre", "genre_key")),
    ("bridge_movie_genre", "genre", "not_null", None),
    ("bridge_movie_company", "movie_id", "not_null", None),
    ("bridge_movie_company", "movie_id", "relationships", ("stg_movies", "movie_id")),
    ("bridge_movie_company", "company_key", "not_null", None),
    ("bridge_movie_company", "company_key", "relationships", ("dim_company", "company_key")),
    ("bridge_movie_company", "company", "not_null", None),
    ("bridge_movie_country", "movie_id", "not_null", None),
    ("bridge_movie_country", "movie_id", "relationships", ("stg_movies", "movie_id")),
    ("bridge_movie_country", "country_key", "not_null", None),
    ("bridge_movie_country", "country_key", "relationships", ("dim_country", "country_key")),
    ("bridge_movie_country", "country", "not_null", None),
]


def schema_test_name(model: str, col: str, test: str) -> str:
    return f"{test}_{model}_{col}"


# Models that a join or a grouping makes; several tests read them, so the suite writes them first.
BUILT_MODELS = ["fact_movie_market_coverage", "bridge_movie_genre", "bridge_movie_company", "bridge_movie_country"]


def schema_suite(models: dict[str, DataFrame], tests=SCHEMA_TESTS, built=()) -> DataFrame:
    """Run the schema tests with few passes per model: all not_null tests of a
    model in one aggregation, accepted values as the distinct failing ones, a
    key's uniqueness as one grouping (several keys of a model stacked), and
    relationships as anti-joins - those to one parent key in one grouping.

    Of the models named in ``built`` the tested columns are written first, so
    that their tests do not make them again."""
    by_model: dict[str, list] = {}
    parents: dict[tuple[str, str], list] = {}
    for t in tests:
        by_model.setdefault(t[0], []).append(t)
        if t[2] == "relationships":
            parents.setdefault(t[3], []).append(t)
    models = dict(models)
    for model in built:
        tested = {t[1]: None for t in by_model[model]} | {col: None for name, col in parents if name == model}
        models[model] = materialize(models[model].select(*tested), "tested")
    counted = lambda wide, names: wide.unpivot([], names, "test_name", "failures")
    frames = []
    for model, ts in by_model.items():
        df = models[model]
        named = {test: [(col, schema_test_name(model, col, test), arg) for _, col, t, arg in ts if t == test]
                 for test in ("not_null", "accepted_values", "unique")}
        if filled := named["not_null"]:
            frames.append(counted(df.agg(*[F.count_if(F.col(c).isNull()).alias(n) for c, n, _ in filled]), [n for _, n, _ in filled]))
        if accepted := named["accepted_values"]:
            # only rows with a failing value survive the filter, so the
            # distinct count shuffles (usually) nothing
            bad = {n: F.col(c).isNotNull() & ~F.col(c).isin(*arg) for c, n, arg in accepted}
            values = df.where(reduce(lambda a, b: a | b, bad.values())).select(F.explode(F.array(*[
                F.when(bad[n], F.struct(F.lit(n).alias("t"), F.col(c).cast("string").alias("v"))) for c, n, _ in accepted])).alias("b"))
            frames.append(_counts_by_name(values.where(F.col("b").isNotNull()).select("b.t", "b.v").distinct(), list(bad)))
        if len(uniq := named["unique"]) == 1:
            (col, name, _), = uniq
            frames.append(counted(unique_failures(df, col).agg(F.count(F.lit(1)).alias(name)), [name]))
        elif uniq:
            stacked = df.select(F.explode(F.array(*[
                F.struct(F.lit(n).alias("t"), F.col(c).cast("string").alias("v")) for c, n, _ in uniq])).alias("s")).select("s.t", "s.v")
            dup = stacked.where(F.col("v").isNotNull()).groupBy("t", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            frames.append(_counts_by_name(dup, [n for _, n, _ in uniq]))
    for (parent, parent_col), ts in parents.items():
        children = {schema_test_name(model, col, test): (models[model], col) for model, col, test, _ in ts}
        if len(children) > 1:
            frames.append(relationship_failure_counts(children, models[parent], parent_col))
        else:
            (name, (df, col)), = children.items()
            frames.append(counted(relationship_failures(df, col, models[parent], parent_col).agg(F.count(F.lit(1)).alias(name)), [name]))
    out = reduce(lambda a, b: a.unionByName(b), frames)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def _counts_by_name(rows: DataFrame, names: list[str]) -> DataFrame:
    """(test_name, failures): the rows of each test, 0 where it has none."""
    return rows.agg(*[F.count_if(F.col("t") == n).alias(n) for n in names]).unpivot([], names, "test_name", "failures")


# The models that the business rules read; others need not be built for them.
RULE_MODELS = ["fact_genre_budget_roi_recommendable", "fact_movie_performance", "fact_movie_roi_analysis", "stg_movies_roi_eligible"]


def business_rule_suite(models: dict[str, DataFrame], scope) -> DataFrame:
    """Q13-Q17, one scan a model."""
    rec = models["fact_genre_budget_roi_recommendable"]
    perf = models["fact_movie_performance"]
    roi = models["fact_movie_roi_analysis"]
    elig = models["stg_movies_roi_eligible"]
    positive = F.col("budget").isNotNull() & (F.col("budget") > 0)
    expected_pct = F.round(((F.col("revenue") - F.col("budget")) / F.col("budget").cast("double") * 100)
                           .cast("decimal(38,10)"), 2).cast("double")
    return run_rules({
        "test_fact_genre_budget_roi_recommendable_min_sample": (rec, F.col("movie_count") < K.MIN_SEGMENT_SAMPLE),
        "test_fact_movie_performance_budget_quartile_consistency": (
            perf, (positive & F.col("budget_quartile").isNull())
            | (~F.coalesce(positive, F.lit(False)) & F.col("budget_quartile").isNotNull())),
        "test_fact_movie_roi_analysis_profit_consistency": (roi, ~F.col("profit").eqNullSafe(F.col("revenue") - F.col("budget"))),
        "test_fact_movie_roi_analysis_roi_pct_consistency": (roi, (F.col("budget") > 0) & ~F.col("roi_pct").eqNullSafe(expected_pct)),
        "test_stg_movies_roi_eligible_flag_consistency": (
            elig, ~(F.col("is_budget_reported") & F.col("is_revenue_reported") & F.col("is_roi_eligible")
                    & (F.col("budget") >= scope.min_budget) & (F.col("revenue") >= scope.min_revenue))),
    })


def cleaning_count_checks(silver_movies: DataFrame, silver_ratings: DataFrame,
                          silver_extended: DataFrame) -> DataFrame:
    """Q8: the cleaning jobs' PASS/WARN checks (all expected 0)."""
    def dup(df, col):
        return F.count(F.lit(1)) - F.count_distinct(col) - F.when(F.count_if(F.col(col).isNull()) > 0, 1).otherwise(0)
    movies = silver_movies.agg(F.count_if(F.col("id").isNull()).alias("id_nulls"),
                               dup(silver_movies, "id").alias("duplicate_ids"),
                               F.count_if(F.col("release_date").isNull()).alias("release_date_nulls"))
    ratings = silver_ratings.agg(F.count_if(F.col("movie_id").isNull()).alias("movie_id_nulls"),
                                 dup(silver_ratings, "movie_id").alias("duplicate_movie_ids"),
                                 F.count_if(F.col("avg_rating").isNull()).alias("avg_rating_nulls"),
                                 F.count_if(F.col("total_ratings").isNull()).alias("total_ratings_nulls"),
                                 F.count_if(F.col("last_rated").isNull()).alias("last_rated_nulls"))
    ext = silver_extended.agg(F.count_if(F.col("id").isNull()).alias("id_nulls"),
                              dup(silver_extended, "id").alias("duplicate_ids"))
    return expected_count_checks({"movies": movies, "ratings": ratings, "movie_extended": ext})
