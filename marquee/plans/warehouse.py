"""The layered catalogue warehouse: raw -> bronze -> silver -> staging -> gold.

Each layer is a lazily built DataFrame; building a mart builds only what it
needs.  Layers that several marts read, and the sorted inputs of exact medians
and quartiles, are written when a mart that needs them is built: building one
starts these jobs.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from marquee.config import Scope
from marquee.operators import impute, match
from marquee.operators.multival import build_mapping, build_mapping_from_literal
from marquee.plans import analyses, clean, dims, facts, segments, staging
from marquee.session import materialize
from marquee.sources.adapter import RawTables, generated_raw


def stage(df: DataFrame) -> DataFrame:
    """Materialise a reused layer once (Parquet in the session's shared
    checkpoint directory) and cut its lineage."""
    return materialize(df, "layer")


class Warehouse:
    def __init__(self, raw: RawTables, scope: Scope = Scope(), title_mode: str = "intent",
                 median_method: str = "exact",
                 country_tokens: str = "intent"):
        self.raw = raw
        self.scope = scope
        self.title_mode = title_mode
        self.median_method = median_method
        self.country_tokens = country_tokens

    @classmethod
    def from_files(cls, spark: SparkSession, movies_csv: str, extended_csv: str, ratings_json: str,
                   benchmark_csv: str, ratings_top_level_array: bool = True,
                   multiline: bool = True, **kw) -> "Warehouse":
        """Build from the landed source files (CSV, CSV, JSON, CSV).

        ``multiline``: quoted fields may hold line breaks; files split either way."""
        from marquee.sources import io
        raw = RawTables(
            movies_main=io.read_text_csv(spark, movies_csv, io.MOVIES_COLUMNS, multiline),
            movie_extended=io.read_text_csv(spark, extended_csv, io.EXTENDED_COLUMNS, multiline),
            ratings=io.read_ratings_json(spark, ratings_json, ratings_top_level_array),
            benchmark=io.read_text_csv(spark, benchmark_csv, io.BENCHMARK_COLUMNS, multiline).drop("ingest_seq"),
        )
        return cls(raw, **kw)

    @classmethod
    def from_generated(cls, spark: SparkSession, sf_dir: str, **kw) -> "Warehouse":
        kw.setdefault("scope", Scope.generated())
        return cls(generated_raw(spark, sf_dir, stage=stage), **kw)

    # ---- bronze: enrichment -------------------------------------------------
    @cached_property
    def catalogue(self) -> DataFrame:
        # the match counts its titles, then joins rows with and without one: parsed and written once
        return stage(match.prepare_catalogue(self.raw.movies_main, self.title_mode))

    @cached_property
    def benchmark_dedup(self) -> DataFrame:
        return match.dedup_benchmark(match.prepare_benchmark(self.raw.benchmark, self.title_mode))

    @cached_property
    def matched(self) -> DataFrame:
        return match.tiered_match(self.catalogue, self.benchmark_dedup)

    @cached_property
    def financials(self) -> DataFrame:
        # the match result feeds both imputation baselines and every mart:
        # materialise it once in the reliable checkpoint directory
        return stage(match.enrich_budget(self.matched))

    @cached_property
    def baselines(self) -> DataFrame:
        return impute.imputation_baselines(self.financials, self.median_method)

    @cached_property
    def imputed(self) -> DataFrame:
        return impute.impute_budget(self.financials, self.baselines)

    @cached_property
    def enriched_base(self) -> DataFrame:
        # one row per id, chosen once: movies and audit describe the same row
        return stage(clean._dedup_first(self.imputed))

    @cached_property
    def movies_enriched(self) -> DataFrame:
        return self.enriched_base.select(*impute.MOVIES_ENRICHED_COLUMNS)

    @cached_property
    def enrichment_audit(self) -> DataFrame:
        return self.enriched_base.select(*impute.AUDIT_COLUMNS)

    # ---- silver ---------------------------------------------------------------
    @cached_property
    def silver_movies(self) -> DataFrame:
        return stage(clean.clean_movies(self.movies_enriched, self.scope))

    @cached_property
    def silver_ratings(self) -> DataFrame:
        return clean.clean_ratings(self.raw.ratings)

    @cached_property
    def extended_tokens(self) -> DataFrame:
        # the country literals are parsed once, for their text and for the mapping
        return stage(clean.clean_extended(self.raw.movie_extended, "country_tokens"))

    @cached_property
    def silver_extended(self) -> DataFrame:
        return self.extended_tokens.drop("country_tokens")

    # gold_prep mapping tables, written once and read by every mart
    @cached_property
    def movie_genres(self) -> DataFrame:
        return stage(build_mapping(self.silver_extended, "genres", "genre"))

    @cached_property
    def movie_companies(self) -> DataFrame:
        return stage(build_mapping(self.silver_extended, "production_companies", "company"))

    @cached_property
    def movie_countries(self) -> DataFrame:
        # intent: explode the parsed list (names with commas stay whole);
        # as_written: split the comma-joined names again like the reference
        if self.country_tokens == "as_written":
            return stage(build_mapping(self.silver_extended, "production_countries", "country"))
        return stage(build_mapping_from_literal(self.extended_tokens, "country_tokens", "country"))

    # ---- staging --------------------------------------------------------------
    @cached_property
    def stg_movies(self) -> DataFrame:
        return staging.stg_movies(self.silver_movies, self.scope)

    @cached_property
    def stg_ratings(self) -> DataFrame:
        return staging.stg_ratings(self.silver_ratings)

    @cached_property
    def stg_movie_extended(self) -> DataFrame:
        return staging.stg_movie_extended(self.silver_extended)

    @cached_property
    def stg_movie_genres(self) -> DataFrame:
        return staging.stg_tokens(self.movie_genres, "genre")

    @cached_property
    def stg_movie_companies(self) -> DataFrame:
        return staging.stg_tokens(self.movie_companies, "company")

    @cached_property
    def stg_movie_countries(self) -> DataFrame:
        return staging.stg_tokens(self.movie_countries, "country")

    @cached_property
    def stg_movies_roi_eligible(self) -> DataFrame:
        return staging.stg_movies_roi_eligible(self.stg_movies)

    # ---- gold -----------------------------------------------------------------
    @cached_property
    def fact_wide(self) -> DataFrame:
        return stage(facts.fact_movie_performance_wide(self.stg_movies, self.stg_ratings))

    @cached_property
    def fact_movie_performance(self) -> DataFrame:
        return facts.fact_movie_performance(self.fact_wide)

    @cached_property
    def fact_movie_roi_analysis(self) -> DataFrame:
        return facts.fact_movie_roi_analysis(self.fact_wide)

    @cached_property
    def fact_movie_market_coverage(self) -> DataFrame:
        return facts.fact_movie_market_coverage(self.stg_movies, self.stg_ratings, self.stg_movie_extended)

    @cached_property
    def dim_date(self) -> DataFrame:
        return stage(dims.dim_date(self.stg_movies))

    @cached_property
    def dim_movie(self) -> DataFrame:
        return dims.dim_movie(self.fact_wide)

    @cached_property
    def dim_budget_tier(self) -> DataFrame:
        return stage(dims.dim_budget_tier(self.fact_movie_performance))

    @cached_property
    def dim_genre(self) -> DataFrame:
        return stage(dims.dim_dense(self.stg_movie_genres, "genre", "genre_key"))

    @cached_property
    def dim_country(self) -> DataFrame:
        return stage(dims.dim_dense(self.stg_movie_countries, "country", "country_key"))

    @cached_property
    def dim_company(self) -> DataFrame:
        return stage(dims.dim_company(self.stg_movie_companies))

    @cached_property
    def bridge_movie_genre(self) -> DataFrame:
        return dims.bridge_genre(self.stg_movie_genres, self.dim_genre)

    @cached_property
    def bridge_movie_company(self) -> DataFrame:
        return dims.bridge_company(self.stg_movie_companies, self.dim_company)

    @cached_property
    def bridge_movie_country(self) -> DataFrame:
        return dims.bridge_country(self.stg_movie_countries, self.dim_country)

    # fact x genre (J1), shared by all genre marts - written once
    @cached_property
    def fact_genre(self) -> DataFrame:
        return stage(self.fact_wide.select(*segments.FACT_GENRE_COLUMNS).join(self.stg_movie_genres, "movie_id"))

    @cached_property
    def coverage_genre(self) -> DataFrame:
        return stage(self.fact_movie_market_coverage.select(*segments.COVERAGE_GENRE_COLUMNS).join(self.stg_movie_genres, "movie_id"))

    @cached_property
    def fact_genre_budget_roi(self) -> DataFrame:
        return stage(segments.fact_genre_budget_roi(self.fact_genre))

    @cached_property
    def fact_genre_budget_roi_recommendable(self) -> DataFrame:
        return segments.fact_genre_budget_roi_recommendable(self.fact_genre_budget_roi)

    @cached_property
    def fact_genre_market_momentum(self) -> DataFrame:
        return stage(segments.fact_genre_market_momentum(self.fact_genre))

    @cached_property
    def fact_genre_market_coverage_trends(self) -> DataFrame:
        return stage(segments.fact_genre_market_coverage_trends(self.coverage_genre))

    # ---- analyses -------------------------------------------------------------
    def monthly_revenue_mom(self) -> DataFrame:
        return analyses.monthly_revenue_mom(self.fact_movie_performance, self.dim_date)

    def sequential_in_tier(self) -> DataFrame:
        return analyses.sequential_in_tier(self.fact_movie_performance, self.dim_date)

    def yearly_yoy(self) -> DataFrame:
        return analyses.yearly_yoy(self.fact_movie_performance, self.dim_date)

    def top10_by_genre(self) -> DataFrame:
        return analyses.top10_by_genre(self.fact_wide, self.stg_movie_genres)

    def top10_by_year(self) -> DataFrame:
        return analyses.top10_by_year(self.fact_wide, self.dim_date)

    def kpi_overview(self) -> DataFrame:
        return analyses.kpi_overview(self.fact_movie_performance)

    def kpi_by_slicer(self, by: list[str], chosen: dict[str, list[str]] | None = None) -> DataFrame:
        from marquee.plans.relations import Bridge, kpi_by_slicer
        bridges = {"genre": Bridge(self.bridge_movie_genre, "genre"), "company": Bridge(self.bridge_movie_company, "company"),
                   "country": Bridge(self.bridge_movie_country, "country")}
        return kpi_by_slicer(self.fact_movie_performance, bridges, by, chosen)

    def calendar_yoy_revenue(self) -> DataFrame:
        return analyses.calendar_yoy_revenue(self.fact_movie_performance, self.dim_date)

    def calendar_yoy_by_period(self) -> DataFrame:
        return analyses.calendar_yoy_by_period(self.fact_movie_performance, self.dim_date)

    def catalog_reliability(self, by=None) -> DataFrame:
        return segments.catalog_reliability(self.stg_movies, by)

    MODEL_NAMES = [
        "stg_movies", "stg_ratings", "stg_movie_extended", "stg_movie_genres", "stg_movie_companies",
        "stg_movie_countries", "stg_movies_roi_eligible", "fact_movie_performance",
        "fact_movie_roi_analysis", "fact_movie_market_coverage", "dim_date", "dim_movie",
        "dim_budget_tier", "dim_genre", "dim_country", "dim_company", "bridge_movie_genre",
        "bridge_movie_company", "bridge_movie_country", "fact_genre_budget_roi",
        "fact_genre_budget_roi_recommendable", "fact_genre_market_momentum",
        "fact_genre_market_coverage_trends",
    ]

    def models(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in self.MODEL_NAMES}

    LAYERS = {
        "bronze": ["movies_enriched", "enrichment_audit"],
        "silver_base": ["silver_movies", "silver_ratings", "silver_extended"],
        "gold_prep": ["movie_genres", "movie_companies", "movie_countries"],
        "silver": ["stg_movies", "stg_ratings", "stg_movie_extended", "stg_movie_genres",
                   "stg_movie_companies", "stg_movie_countries", "stg_movies_roi_eligible"],
        "gold": ["dim_date", "dim_movie", "dim_budget_tier", "dim_genre", "dim_country", "dim_company",
                 "bridge_movie_genre", "bridge_movie_company", "bridge_movie_country",
                 "fact_movie_performance", "fact_movie_roi_analysis", "fact_movie_market_coverage",
                 "fact_genre_budget_roi", "fact_genre_budget_roi_recommendable",
                 "fact_genre_market_momentum", "fact_genre_market_coverage_trends"],
    }

    def write_all(self, target_dir: str) -> dict[str, str]:
        """Write every layer's tables as Parquet under
        ``target_dir/<layer>/<table>``; returns table -> path.  Each table is
        written beside the old one and swapped in, so a failed run loses none."""
        from marquee.sources.io import replace_path
        return {n: replace_path(getattr(self, n), f"{target_dir.rstrip('/')}/{layer}/{n}")
                for layer, names in self.LAYERS.items() for n in names}

    def written(self, paths: dict[str, str]) -> dict[str, DataFrame]:
        """The tables that ``write_all`` wrote, by name."""
        return {n: self.raw.movies_main.sparkSession.read.parquet(p) for n, p in paths.items()}

    @staticmethod
    def catalog_reliability_df(df: DataFrame, by=None) -> DataFrame:
        return segments.catalog_reliability(df, by)
