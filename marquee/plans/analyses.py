"""Ad-hoc analyses and BI measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.config import TOP_N_RANKING
from marquee.functions.dates import month_start
from marquee.functions.numeric import pct_change, round_dec
from marquee.operators.ordered import distributed_lag_lead
from marquee.operators.percentile import group_median


def _dated(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    # Fact -> date on date_key; NULL dates drop out of the inner join.
    # dim_date holds distinct dates (bounded by the calendar), AQE broadcasts it.
    return fact.join(dim_date, "date_key")


def monthly_revenue_mom(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue per month and month-over-month change (W7).  The monthly
    series is small (one row per month), so a global window is fine."""
    m = _dated(fact.where(F.col("revenue").isNotNull()), dim_date) \
        .groupBy(month_start("date_day").alias("month_start")) \
        .agg(round_dec(F.sum("revenue")).alias("monthly_revenue"))
    w = Window.orderBy("month_start")
    prev = F.lag("monthly_revenue").over(w)
    return m.select("month_start", "monthly_revenue", prev.alias("prev_month_revenue"),
                    round_dec(F.col("monthly_revenue") - prev).alias("month_over_month_change"),
                    pct_change(F.col("monthly_revenue"), prev).alias("month_over_month_pct"))


def sequential_in_tier(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """C24 (W8): previous/next movie revenue within the budget tier ordered by
    year, movie_id.  Four tiers would make four giant window tasks, so the
    neighbours come from range partitions and their boundary rows."""
    d = _dated(fact.where(F.col("revenue").isNotNull()), dim_date) \
        .select("movie_id", F.col("year").alias("release_year"), "budget_tier", "revenue")
    out = distributed_lag_lead(d, ["budget_tier"], ["release_year", "movie_id"], "revenue",
                               "prev_movie_revenue_in_tier", "next_movie_revenue_in_tier")
    return out.select("movie_id", "release_year", "budget_tier", "revenue",
                      "prev_movie_revenue_in_tier", "next_movie_revenue_in_tier")


def yearly_yoy(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue and average ROI per year with the previous year's."""
    y = _dated(fact.where(F.col("revenue").isNotNull()), dim_date) \
        .groupBy(F.col("year").alias("release_year")) \
        .agg(round_dec(F.sum("revenue")).alias("yearly_revenue"),
             round_dec(F.avg("roi"), 6).alias("avg_roi"))
    w = Window.orderBy("release_year")
    prev_rev, prev_roi = F.lag("yearly_revenue").over(w), F.lag("avg_roi").over(w)
    return y.select("release_year", "yearly_revenue", prev_rev.alias("prev_year_revenue"),
                    round_dec(F.col("yearly_revenue") - prev_rev).alias("yoy_revenue_change"),
                    "avg_roi", prev_roi.alias("prev_year_avg_roi"),
                    round_dec(F.col("avg_roi") - prev_roi, 6).alias("yoy_avg_roi_change"))


def top_n_per_group(df: DataFrame, group: str, n: int, rank_col: str) -> DataFrame:
    """Top-n by revenue (NULLs last, movie_id tiebreak) per group.
    ``row_number <= n`` lets Catalyst insert a partial WindowGroupLimit before
    the shuffle, so a hot group is cut to n rows per map partition."""
    w = Window.partitionBy(group).orderBy(F.col("revenue").desc_nulls_last(), F.col("movie_id"))
    return df.withColumn(rank_col, F.row_number().over(w).cast("bigint")).where(F.col(rank_col) <= n)


def top10_by_genre(fact_wide: DataFrame, stg_genres: DataFrame, n: int = TOP_N_RANKING) -> DataFrame:
    """The wide fact carries the title, so only the genres are joined."""
    base = fact_wide.where(F.col("revenue").isNotNull()).select("movie_id", "title", "revenue", "profit") \
        .join(stg_genres, "movie_id")
    return top_n_per_group(base, "genre", n, "revenue_rank_in_genre") \
        .select("genre", "movie_id", "title", "revenue", "profit", "revenue_rank_in_genre")


def top10_by_year(fact_wide: DataFrame, dim_date: DataFrame, n: int = TOP_N_RANKING) -> DataFrame:
    """C27."""
    base = _dated(fact_wide.where(F.col("revenue").isNotNull()).drop("release_year"), dim_date) \
        .select(F.col("year").alias("release_year"), "movie_id", "title", "revenue", "profit")
    return top_n_per_group(base, "release_year", n, "revenue_rank_in_year") \
        .select("release_year", "movie_id", "title", "revenue", "profit", "revenue_rank_in_year")


def kpi_overview(fact: DataFrame) -> DataFrame:
    """KPI card measures over the fact.  Distinct movie counts come
    from one groupBy(movie_id) (partial aggregation) instead of two
    count-distinct aggregates, which Spark would evaluate by expanding every
    row once per distinct expression."""
    k = fact.agg(
        round_dec(F.sum("revenue")).alias("total_revenue"),
        round_dec(F.sum("budget")).alias("total_budget"),
        round_dec(F.sum("profit")).alias("total_profit"),
        round_dec(F.avg("roi_pct")).alias("average_roi_pct"),
    )
    movies = fact.where(F.col("movie_id").isNotNull()).groupBy("movie_id") \
        .agg(F.max(F.coalesce(F.col("is_roi_eligible"), F.lit(False)).cast("int")).alias("eligible")) \
        .agg(F.count(F.lit(1)).cast("bigint").alias("total_movies"),
             F.coalesce(F.sum("eligible"), F.lit(0)).cast("bigint").alias("recommendation_movies"))
    med = group_median(fact, [], "roi_pct", out="median_roi_pct")
    # all three sides are one-row aggregates
    one = lambda df: F.broadcast(df.withColumn("__k", F.lit(0)))
    out = k.withColumn("__k", F.lit(0)).join(one(movies), "__k").join(one(med), "__k", "left").drop("__k")
    return out.select("total_movies", "total_revenue", "total_budget", "total_profit", "average_roi_pct",
                      "recommendation_movies", round_dec("median_roi_pct").alias("median_roi_pct"))


def _year_on_year(sums: DataFrame, keys: list[str], period: str, a_year_on) -> DataFrame:
    """Each period's total_revenue beside that of a year earlier.

    Every period that has revenue, and every one a year after such a one, has
    its row: a blank period still shows what the year before had.  As in the BI
    measure a blank counts as 0 in the difference, and the ratio falls back to 0
    without a base.  One shuffle: each sum is sent to its own and the next period."""
    own = sums.select(*keys, F.col(period), F.col("total_revenue"), F.lit(None).cast("double").alias("prev"))
    later = sums.where("total_revenue IS NOT NULL").select(*keys, a_year_on.alias(period), F.lit(None).cast("double").alias("total_revenue"), F.col("total_revenue").alias("prev"))
    both = own.unionByName(later).groupBy(*keys, period).agg(F.max("total_revenue").alias("total_revenue"), F.max("prev").alias("prev_calendar_year_revenue"))
    zero = F.lit(0.0)
    change = F.when(F.col("total_revenue").isNull() & F.col("prev_calendar_year_revenue").isNull(), F.lit(None)) \
        .otherwise(round_dec(F.coalesce("total_revenue", zero) - F.coalesce("prev_calendar_year_revenue", zero)))
    ratio = round_dec(F.try_divide(change, F.col("prev_calendar_year_revenue")), 6)
    return both.select(*keys, period, "total_revenue", "prev_calendar_year_revenue", change.alias("yoy_revenue_change"),
                       F.coalesce(ratio, zero).alias("yoy_revenue_change_ratio"))


def calendar_yoy_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue per calendar year against the same measure one calendar year earlier."""
    y = _dated(fact, dim_date).groupBy("year").agg(round_dec(F.sum("revenue")).alias("total_revenue"))
    return _year_on_year(y, [], "year", (F.col("year") + 1).cast(y.schema["year"].dataType))


def calendar_yoy_by_period(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """W9 in a quarter and a month context."""
    day = F.col("date_day")
    periods = F.array(*[F.struct(F.lit(g).alias("grain"), F.to_date(F.date_trunc(g, day)).alias("period_start")) for g in ("quarter", "month")])
    sums = _dated(fact, dim_date).select("revenue", F.inline(periods)).groupBy("grain", "period_start") \
        .agg(round_dec(F.sum("revenue")).alias("total_revenue"))
    return _year_on_year(sums, ["grain"], "period_start", F.add_months("period_start", 12))
