"""Budget imputation with lineage.

The two baselines are a one-row frame that is joined in, so the imputation
stays one lazy plan: no value passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.config import APPROX_ACCURACY, IMPUTE_MEDIAN_LABEL, IMPUTE_RATIO_LABEL
from marquee.operators.percentile import group_percentiles

# The published columns of the two enrichment tables.
MOVIES_ENRICHED_COLUMNS = [
    "id", "title", "release_date", "budget", "budget_reported", "revenue", "is_budget_reported",
    "is_budget_imputed", "budget_imputation_method", "is_revenue_reported", "is_roi_eligible",
]
AUDIT_COLUMNS = [
    "id", "used_ext_budget", "used_ext_revenue", "is_budget_imputed", "budget_imputation_method",
    "is_ext_enriched", "is_enriched",
]

BASELINES = {"median_budget_revenue_ratio": "ratio", "median_budget": "budget"}


def baseline_measures(financials: DataFrame) -> DataFrame:
    """(measure, v): the values whose medians are the baselines."""
    reported = F.when(F.col("budget_reported") > 0, F.col("budget_reported"))
    earned = F.when(F.col("revenue") > 0, F.col("revenue"))
    measures = F.array(F.struct(F.lit("ratio").alias("measure"), (reported / earned).alias("v")),
                       F.struct(F.lit("budget").alias("measure"), reported.cast("double").alias("v")))
    return financials.select(F.inline(measures)).where(F.col("v").isNotNull())


def imputation_baselines(financials: DataFrame, method: str = "exact",
                         accuracy: int = APPROX_ACCURACY) -> DataFrame:
    """One row: the median budget/revenue ratio over rows with both figures and
    the median reported budget (NULL where no row qualifies).

    ``exact`` is the lower median (the element the approximate percentile
    converges to); ``approx`` is percentile_approx."""
    long = baseline_measures(financials)
    if method == "exact":
        medians = group_percentiles(long, ["measure"], "v", {"m": 0.5}, method="disc")
    elif method == "approx":
        medians = long.groupBy("measure").agg(F.percentile_approx("v", 0.5, accuracy).alias("m"))
    else:
        raise ValueError(method)
    return medians.agg(*[F.max(F.when(F.col("measure") == k, F.col("m"))).alias(name) for name, k in BASELINES.items()])


def baseline_rank_errors(financials: DataFrame, accuracy: int = APPROX_ACCURACY) -> DataFrame:
    """(measure, rows, within): whether the approximate median's rank is within
    rows / ``accuracy`` of the middle, the bound that percentile_approx states."""
    long = baseline_measures(financials)
    guess = long.groupBy("measure").agg(F.percentile_approx("v", 0.5, accuracy).alias("m"))
    ranks = long.join(F.broadcast(guess), "measure").groupBy("measure").agg(  # two rows
        F.count("*").alias("rows"), F.count_if(F.col("v") < F.col("m")).alias("below"), F.count_if(F.col("v") <= F.col("m")).alias("upto"))
    slack = F.col("rows") / accuracy + 1
    within = (F.col("below") <= F.col("rows") / 2 + slack) & (F.col("upto") >= F.col("rows") / 2 - slack)
    return ranks.select("measure", "rows", within.alias("within"))


def impute_budget(financials: DataFrame, baselines: DataFrame) -> DataFrame:
    """A row with revenue but no budget gets one from the first usable
    baseline (revenue x ratio, then the median budget) and the baseline's
    label.  Rows that report a budget, or no revenue, are left alone."""
    offers = F.array(*[
        F.struct(F.lit(label).alias("method"), amount.alias("amount"))
        for label, amount in (
            (IMPUTE_RATIO_LABEL, F.col("revenue") * F.when(F.col("median_budget_revenue_ratio") > 0, F.col("median_budget_revenue_ratio"))),
            (IMPUTE_MEDIAN_LABEL, F.when(F.col("median_budget") > 0, F.col("median_budget"))),
        )])
    usable = F.try_element_at(F.filter(offers, lambda o: o["amount"].isNotNull()), F.lit(1))
    gap = F.col("budget_reported").isNull() & (F.col("revenue") > 0)
    # the baselines are one row by construction: a broadcast of fixed size
    rows = financials.crossJoin(F.broadcast(baselines)).withColumn("__fill", F.when(gap, usable))
    filled, reported, earned = (F.col(c).isNotNull() for c in ("__fill", "budget_reported", "revenue"))
    return rows.select(
        *financials.columns,
        F.coalesce("budget_reported", "__fill.amount").alias("budget"),
        filled.alias("is_budget_imputed"), F.col("__fill.method").alias("budget_imputation_method"),
        reported.alias("is_budget_reported"), earned.alias("is_revenue_reported"),
        (reported & earned).alias("is_roi_eligible"),
        (F.col("is_ext_enriched") | filled).alias("is_enriched"))


def enrichment_metrics(base: DataFrame) -> DataFrame:
    """Run metrics of an enrichment as one row, from the table with one
    row per id that the audit is taken from."""
    no_budget = ~F.col("is_budget_reported")
    counted = {
        "enriched_rows": F.col("is_enriched"),
        "budget_reported_rows": F.col("is_budget_reported"),
        "revenue_reported_rows": F.col("is_revenue_reported"),
        "budget_imputed_rows": F.col("is_budget_imputed"),
        "missing_budget_with_revenue_rows": no_budget & (F.col("revenue") > 0),
        "missing_budget_and_revenue_rows": no_budget & ~F.col("is_revenue_reported"),
    }
    totals = base.agg(F.count("*").alias("total_rows"), *[F.count_if(p).alias(n) for n, p in counted.items()])
    share = F.try_divide(F.col("enriched_rows") * 100.0, F.col("total_rows")).cast("decimal(38,10)")
    return totals.withColumn("enriched_pct", F.coalesce(F.round(share, 2).cast("double"), F.lit(0.0)))


def imputation_method_mix(base: DataFrame) -> DataFrame:
    """Rows per imputation method, NULL reported as 'none'."""
    return base.groupBy(F.coalesce(F.col("budget_imputation_method"), F.lit("none")).alias("method")) \
        .agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
