"""Reshaping: pivot with fixed values, unpivot, labelled stacking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_fixed(df: DataFrame, keys: list[str], pivot_col: str, values: list[str], measure: str) -> DataFrame:
    """One column per listed value (explicit values -> no extra job to
    discover them); cells hold the measure of the single matching row."""
    return df.groupBy(*keys).pivot(pivot_col, values).agg(F.first(measure))


def unpivot_metrics(df: DataFrame, ids: list[str], metrics: list[str], name: str = "metric",
                    value: str = "value", cast: str = "double") -> DataFrame:
    """Wide one-row metric reports -> (metric, value) rows."""
    return df.select(*ids, *[F.col(m).cast(cast).alias(m) for m in metrics]) \
        .unpivot(ids, metrics, name, value)


def stack_labelled(frames: dict[str, DataFrame], label: str = "dataset") -> DataFrame:
    """Union of per-dataset reports with a label column (by name)."""
    labelled = [df.withColumn(label, F.lit(k)) for k, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)
