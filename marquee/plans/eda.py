"""Profiling reports of the raw catalogue inputs (the EDA notebook as Spark
jobs): missingness, id quality, integrity, anomalies, patterns, ranges,
distributions, top tokens, cardinalities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import config as K
from marquee.functions.dates import epoch_to_timestamp, parse_mixed_date
from marquee.functions.numeric import clip, log10_or_null, round_dec, to_number
from marquee.functions.text import (comma_spacing, literal_names_array, literal_names_text,
                                    normalize_title, split_csv_list)
from marquee.operators import profile
from marquee.operators.dedup import mark_duplicates
from marquee.operators.multival import explode_tokens, token_cardinality
from marquee.operators.reshape import stack_labelled, unpivot_metrics
from marquee.sources.adapter import RawTables


class Eda:
    def __init__(self, raw: RawTables):
        self.raw = raw

    # ---- typed views -----------------------------------------------------------
    @property
    def movies(self) -> DataFrame:
        m = self.raw.movies_main
        return m.select(F.col("id").cast("string").alias("id"), "title", "release_date", "budget", "revenue",
                        to_number("budget").alias("budget_num"), to_number("revenue").alias("revenue_num"),
                        parse_mixed_date("release_date").alias("release_date_parsed"))

    @property
    def extended(self) -> DataFrame:
        e = self.raw.movie_extended
        return e.select(F.col("id").cast("string").alias("id"), "genres", "production_companies",
                        "production_countries", "spoken_languages",
                        split_csv_list("genres").alias("genres_list"),
                        split_csv_list("production_companies").alias("production_companies_list"),
                        literal_names_array("production_countries").alias("country_names"),
                        literal_names_array("spoken_languages").alias("language_names"))

    @property
    def ratings(self) -> DataFrame:
        r = self.raw.ratings
        return r.select(F.col("movie_id").cast("string").alias("movie_id"),
                        epoch_to_timestamp("last_rated", zero_is_null=False).alias("last_rated"),
                        F.col("ratings_summary.avg_rating").cast("double").alias("avg_rating"),
                        F.col("ratings_summary.total_ratings").cast("double").alias("total_ratings"))

    @property
    def fin_valid(self) -> DataFrame:
        """Rows with positive budget and revenue."""
        return self.movies.where((F.col("budget_num") > 0) & (F.col("revenue_num") > 0))

    # ---- every count of the three tables, one scan of each ----------------------
    def table_counts(self) -> DataFrame:
        """Q1, Q2 (counts), Q4-Q6, A22: (dataset, report, item, value)."""
        date, parsed, b, r = F.col("release_date"), F.col("release_date_parsed"), F.col("budget_num"), F.col("revenue_num")
        raw = self.raw.movies_main.select(F.col("id").cast("string").alias("id"), "title", "release_date", "budget", "revenue")
        movies = profile.observe(raw, "id", raw.columns, {
            "budget_num": to_number("budget"), "revenue_num": to_number("revenue"),
            "release_date_parsed": parse_mixed_date("release_date")}, {
            ("anomalies", "release_date_total_non_null"): date.isNotNull(),
            ("anomalies", "release_date_parse_failures"): date.isNotNull() & parsed.isNull(),
            ("anomalies", "budget_nulls"): b.isNull(), ("anomalies", "budget_zeros"): b == 0,
            ("anomalies", "budget_negatives"): b < 0, ("anomalies", "revenue_nulls"): r.isNull(),
            ("anomalies", "revenue_zeros"): r == 0, ("anomalies", "revenue_negatives"): r < 0,
            ("anomalies", "both_budget_and_revenue_zero"): (b == 0) & (r == 0),
            **{("date_patterns", name): date.rlike(p) for name, p in K.DATE_SHAPE_PATTERNS.items()}}, "movies")
        ext = self.raw.movie_extended.select(F.col("id").cast("string").alias("id"), "genres", "production_companies",
                                             "production_countries", "spoken_languages")
        spaced = {("delimiters", c): comma_spacing(c, K.COMMA_SPACING_PATTERN) for c in ("genres", "production_companies")}
        extended = profile.observe(ext, "id", ext.columns, {}, spaced, "movies_extended")
        lo, hi = K.RATING_VALID_RANGE
        a, t = F.col("avg_rating"), F.col("total_ratings")
        ratings = profile.observe(self.ratings, "movie_id", ["movie_id", "last_rated", "avg_rating", "total_ratings"], {}, {
            ("validity", "invalid_avg_rating"): ~F.coalesce(a.between(lo, hi), F.lit(False)),
            ("validity", "invalid_total_ratings"): t < 0}, "ratings")
        return movies.unionByName(extended).unionByName(ratings)

    # ---- reports ---------------------------------------------------------------
    def missingness(self) -> DataFrame:
        m = self.movies
        e = self.extended.select("id", "genres", "production_companies", "production_countries",
                                 "spoken_languages")
        return reduce(lambda a, b: a.unionByName(b), [
            profile.missingness(m, "movies"), profile.missingness(e, "movies_extended"),
            profile.missingness(self.ratings, "ratings")])

    def id_quality(self) -> DataFrame:
        return reduce(lambda a, b: a.unionByName(b), [
            profile.id_quality(self.movies, "id", "movies"),
            profile.id_quality(self.extended, "id", "movies_extended"),
            profile.id_quality(self.ratings, "movie_id", "ratings")])

    def integrity_report(self) -> DataFrame:
        main = self.movies.select("id")
        ext = self.extended.select("id")
        rat = self.ratings.select("movie_id")
        return profile.orphan_report({
            "extended_not_in_main": (ext, main),
            "ratings_not_in_main": (rat, main),
            "main_not_in_extended": (main, ext),
        })

    def anomaly_summary(self) -> DataFrame:
        m = self.movies
        raw_cols = ["id", "title", "release_date", "budget", "revenue"]
        distinct_rows = m.select(*raw_cols).distinct().agg(F.count(F.lit(1)).alias("d"))
        distinct_ids = m.groupBy("id").agg(F.lit(1).alias("x")).agg(F.count(F.lit(1)).alias("di"))
        b, r = F.col("budget_num"), F.col("revenue_num")
        c = lambda p: F.count_if(p)
        wide = m.agg(
            F.count(F.lit(1)).alias("rows"),
            c(F.col("release_date").isNotNull()).alias("release_date_total_non_null"),
            c(F.col("release_date").isNotNull() & F.col("release_date_parsed").isNull())
            .alias("release_date_parse_failures"),
            c(b.isNull()).alias("budget_nulls"), c(b == 0).alias("budget_zeros"), c(b < 0).alias("budget_negatives"),
            c(r.isNull()).alias("revenue_nulls"), c(r == 0).alias("revenue_zeros"),
            c(r < 0).alias("revenue_negatives"), c((b == 0) & (r == 0)).alias("both_budget_and_revenue_zero"),
        )
        j = profile._one_row_join(profile._one_row_join(wide, distinct_rows), distinct_ids)
        j = j.withColumns({"exact_duplicate_rows": F.col("rows") - F.col("d"),
                           "duplicate_movie_ids": F.col("rows") - F.col("di")})
        metrics = ["exact_duplicate_rows", "duplicate_movie_ids", "release_date_total_non_null",
                   "release_date_parse_failures", "budget_nulls", "budget_zeros", "budget_negatives",
                   "revenue_nulls", "revenue_zeros", "revenue_negatives", "both_budget_and_revenue_zero"]
        return unpivot_metrics(j, [], metrics, cast="bigint")

    def date_pattern_census(self) -> DataFrame:
        d = self.movies.where(F.col("release_date").isNotNull())
        wide = d.agg(*[F.count_if(F.col("release_date").rlike(p)).alias(n)
                       for n, p in K.DATE_SHAPE_PATTERNS.items()])
        return unpivot_metrics(wide, [], list(K.DATE_SHAPE_PATTERNS), "pattern", "count", "bigint")

    def ratings_validity(self) -> DataFrame:
        r = self.ratings
        lo, hi = K.RATING_VALID_RANGE
        a, t = F.col("avg_rating"), F.col("total_ratings")
        wide = r.agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(a.isNull()).alias("null_avg_rating"),
            F.count_if(t.isNull()).alias("null_total_ratings"),
            F.count_if(~F.coalesce(a.between(lo, hi), F.lit(False))).alias("invalid_avg_rating"),
            F.count_if(t < 0).alias("invalid_total_ratings"),
            F.count_if(F.col("last_rated").isNull()).alias("null_last_rated"))
        return unpivot_metrics(wide, [], wide.columns, "metric", "count", "bigint")

    def range_report(self) -> DataFrame:
        return profile.range_report(self.fin_valid, ["budget_num", "revenue_num"])

    def describe(self) -> DataFrame:
        return profile.describe_many([("movies", self.movies, ["budget_num", "revenue_num"]),
                                      ("ratings", self.ratings, ["avg_rating", "total_ratings"])])

    def budget_tertiles(self) -> DataFrame:
        binned = profile.equal_frequency_bins(self.fin_valid, "budget_num", K.TERTILE_CUTS, K.TERTILE_LABELS,
                                              "budget_tier")
        return binned.groupBy("budget_tier").agg(F.count(F.lit(1)).cast("bigint").alias("movie_count"))

    def budget_revenue_corr(self) -> DataFrame:
        return self.fin_valid.agg(F.count(F.lit(1)).cast("bigint").alias("movies"),
                                  round_dec(F.corr("budget_num", "revenue_num"), 6).alias("pearson_r"))

    def valid_financials(self) -> DataFrame:
        """Data behind the financial scatter plots."""
        f = self.fin_valid
        roi = (F.col("revenue_num") - F.col("budget_num")) / F.col("budget_num")
        return f.select("id", "budget_num", "revenue_num", roi.alias("roi"),
                        round_dec(log10_or_null("budget_num"), 9).alias("log10_budget"),
                        round_dec(log10_or_null("revenue_num"), 9).alias("log10_revenue"))

    def roi_histogram(self) -> DataFrame:
        f = self.fin_valid
        roi = (F.col("revenue_num") - F.col("budget_num")) / F.col("budget_num")
        lo, hi = K.ROI_CLIP
        return profile.histogram(f.select(clip(roi, lo, hi).alias("roi")), "roi", K.ROI_HIST_BINS)

    def rating_histogram(self) -> DataFrame:
        return profile.histogram(self.ratings, "avg_rating", K.RATING_HIST_BINS)

    def top_tokens(self, array_col: str, n: int = K.TOP_TOKENS) -> DataFrame:
        return profile.top_counts(explode_tokens(self.extended, array_col, "tok"), "tok", n)

    def top_rated(self, n: int = K.TOP_RATED) -> DataFrame:
        r = self.ratings.select(F.col("movie_id").cast("bigint").alias("movie_id"),
                                F.col("total_ratings").cast("bigint").alias("total_ratings"))
        return profile.top_n(r, [F.col("total_ratings").desc_nulls_last(), F.col("movie_id")], n)

    def low_budget_outliers(self) -> DataFrame:
        return self.fin_valid.where(F.col("budget_num") < K.LOW_BUDGET_OUTLIER) \
            .select("id", "title", "budget_num", "revenue_num")

    def multivalue_stats(self) -> DataFrame:
        return profile.array_length_stats(self.extended, {
            "genres": "genres_list", "production_companies": "production_companies_list",
            "production_countries": "country_names", "spoken_languages": "language_names"})

    def delimiter_quality(self) -> DataFrame:
        e = self.extended
        frames = []
        for field, lst in (("genres", "genres_list"), ("production_companies", "production_companies_list")):
            frames.append(e.agg(F.lit(field).alias("field"),
                                F.max(comma_spacing(field, K.COMMA_SPACING_PATTERN)).alias("contains_comma_space_pattern"),
                                F.max(F.size(lst)).cast("int").alias("max_items"),
                                round_dec(F.avg(F.size(lst)), 6).alias("mean_items")))
        return reduce(lambda a, b: a.unionByName(b), frames)

    def genre_count_distribution(self) -> DataFrame:
        return self.extended.groupBy(F.size("genres_list").cast("int").alias("items")) \
            .agg(F.count(F.lit(1)).cast("bigint").alias("movie_count"))

    def dimension_cardinality(self) -> DataFrame:
        return token_cardinality(self.extended, {"dim_genre": "genres_list", "dim_company": "production_companies_list",
                                                 "dim_country": "country_names"})

    def parse_release_dates(self) -> DataFrame:
        return self.movies.select("id", "release_date", "release_date_parsed")

    def normalize_titles(self) -> DataFrame:
        return self.raw.movies_main.select(
            F.col("id").cast("string").alias("id"), "title",
            normalize_title("title", "intent").alias("title_norm"),
            normalize_title("title", "as_written").alias("title_norm_as_written"))

    def parse_country_literals(self) -> DataFrame:
        e = self.raw.movie_extended
        return e.select(F.col("id").cast("string").alias("id"), "production_countries",
                        literal_names_text("production_countries").alias("country_names_text"),
                        F.size(literal_names_array("production_countries")).cast("int").alias("country_count"))

    def duplicate_flags(self) -> DataFrame:
        return mark_duplicates(self.movies.select("id", "title"), ["id"])

    def schema_summary(self) -> DataFrame:
        """Q18: side-by-side column types of the three inputs ('-' if absent),
        and in how many of their rows the column has a value."""
        def counted(name: str, df: DataFrame) -> DataFrame:
            row = df.agg(*[F.count(f"`{c}`").alias(c) for c in df.columns])  # one pass
            items = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.col(f"`{c}`").alias("n")) for c, t in df.dtypes])
            return row.select(F.inline(items)).withColumn("dataset", F.lit(name))

        frames = {"movies": self.movies, "movies_extended": self.extended, "ratings": self.ratings}
        long = reduce(lambda a, b: a.unionByName(b), [counted(n, df) for n, df in frames.items()])
        dtype = {n: F.coalesce(F.max(F.when(F.col("dataset") == n, F.col("dtype"))), F.lit("-")).alias(n) for n in frames}
        return long.groupBy("column").agg(*dtype.values(), F.sum("n").alias("rows_with_value"))

    def dataset_sizes(self) -> DataFrame:
        """Rows and columns of each landed input."""
        frames = {"movies": self.raw.movies_main.drop("ingest_seq"),
                  "movies_extended": self.raw.movie_extended.drop("ingest_seq"),
                  "ratings": self.raw.ratings}
        return reduce(lambda a, b: a.unionByName(b), [
            df.agg(F.count(F.lit(1)).cast("bigint").alias("rows")).select(
                F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).alias("columns"))
            for name, df in frames.items()])

    def valid_financials_summary(self) -> DataFrame:
        """Count and medians of budget, revenue and ROI over the rows with
        positive budget and revenue (exact, size-checked medians)."""
        from marquee.operators.percentile import group_percentiles
        f = self.fin_valid.select("budget_num", "revenue_num",
                                  ((F.col("revenue_num") - F.col("budget_num")) / F.col("budget_num")).alias("roi"))
        stacked = f.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("measure"), F.col(c).alias("value")) for c in ("budget_num", "revenue_num", "roi")
        ])).alias("s")).select("s.measure", "s.value")
        med = group_percentiles(stacked, ["measure"], "value", {"median": 0.5})
        return med.select("measure", F.col("n").cast("bigint").alias("movies"),
                          round_dec("median", 6).alias("median"))

    def date_parse_failures(self) -> DataFrame:
        """Raw release dates present but not parsable by any format."""
        return self.movies.where(F.col("release_date").isNotNull() & F.col("release_date_parsed").isNull()) \
            .select("id", "release_date")

    def stacked_numeric_profile(self) -> DataFrame:
        """Per-dataset reports stacked with a dataset label."""
        return stack_labelled({
            "movies": self.fin_valid.agg(F.count(F.lit(1)).cast("bigint").alias("rows")),
            "ratings": self.ratings.agg(F.count(F.lit(1)).cast("bigint").alias("rows")),
        })
