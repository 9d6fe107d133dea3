"""Rule-based data-quality checks.

Every check is a DataFrame of failing rows; a suite runs many checks and
reports one row per test with its failure count, all as Spark jobs (no
collect of data rows)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null_failures(df: DataFrame, col: str) -> DataFrame:
    """Q9: rows where the column is NULL."""
    return df.where(F.col(col).isNull())


def unique_failures(df: DataFrame, col: str) -> DataFrame:
    """Q10: values occurring more than once (NULLs ignored); partial
    aggregation keeps a hot value to one row per map partition."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def accepted_values_failures(df: DataFrame, col: str, values: list) -> DataFrame:
    """Q11: non-NULL values outside the accepted set."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(*values)).select(col).distinct()


def relationship_failures(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Non-NULL child keys missing in the parent (anti-join)."""
    keys = parent.select(F.col(parent_col).alias(col)).distinct()
    return child.where(F.col(col).isNotNull()).select(col).join(keys, col, "left_anti")


def relationship_failure_counts(children: dict[str, tuple[DataFrame, str]], parent: DataFrame, parent_col: str) -> DataFrame:
    """Q12/J11 for several children of one parent key: (test_name, failures),
    the rows of each child whose non-NULL key the parent lacks.

    Children and parent are grouped by key together, counted on the map side
    first: one narrow shuffle and no sort, and a hot key is one row a task."""
    names = list(children)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    slots = [*[f"c{k}" for k in range(len(names))], "parent"]
    sides = [(df, col) for df, col in children.values()] + [(parent, parent_col)]
    rows = reduce(lambda a, b: a.unionByName(b), [
        df.where(F.col(col).isNotNull()).select(F.col(col).alias("key"), *[(one if k == j else none).alias(s) for j, s in enumerate(slots)])
        for k, (df, col) in enumerate(sides)])
    keys = rows.groupBy("key").agg(*[F.sum(s).alias(s) for s in slots]).where(F.col("parent") == 0)
    wide = keys.agg(*[F.coalesce(F.sum(s), none).alias(n) for s, n in zip(slots, names)])
    return wide.unpivot([], names, "test_name", "failures")


def predicate_failures(df: DataFrame, failing: Column) -> DataFrame:
    """Q13-Q17: rows violating a business rule (zero rows = pass)."""
    return df.where(failing)


@dataclass
class Check:
    name: str
    failures: DataFrame


def run_suite(checks: list[Check]) -> DataFrame:
    """One row per test: test_name, failures, status ('pass'/'fail')."""
    counts = [c.failures.agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
              .select(F.lit(c.name).alias("test_name"), "failures") for c in checks]
    out = reduce(lambda a, b: a.unionByName(b), counts)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def run_rules(rules: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Q13-Q17: rows for which a rule's failing predicate holds, all rules of
    one model in one aggregation: test_name, failures, status ('pass'/'fail')."""
    models: list[tuple[DataFrame, dict[str, Column]]] = []
    for name, (df, failing) in rules.items():
        own = next((r for d, r in models if d is df), None)
        if own is None:
            own = {}
            models.append((df, own))
        own[name] = failing
    frames = [df.agg(*[F.count_if(failing).alias(name) for name, failing in own.items()])
              .unpivot([], list(own), "test_name", "failures") for df, own in models]
    out = reduce(lambda a, b: a.unionByName(b), frames).withColumn("failures", F.col("failures").cast("bigint"))
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def expected_count_checks(metrics: dict[str, DataFrame], expected: int = 0) -> DataFrame:
    """Q8: metric frames (one row, one bigint column per metric) ->
    (dataset, metric, observed, expected, status PASS/WARN)."""
    frames = []
    for dataset, df in metrics.items():
        cols = df.columns
        frames.append(df.select(*[F.col(c).cast("bigint") for c in cols])
                      .unpivot([], cols, "metric", "observed")
                      .withColumn("dataset", F.lit(dataset)))
    out = reduce(lambda a, b: a.unionByName(b), frames)
    return out.select("dataset", "metric", "observed", F.lit(expected).cast("bigint").alias("expected"),
                      F.when(F.col("observed") == expected, "PASS").otherwise("WARN").alias("status"))


def count_check_totals(checks: DataFrame) -> DataFrame:
    """Q8: how many of each dataset's count checks pass and warn."""
    return checks.groupBy("dataset").agg(F.count_if(F.col("status") == "PASS").alias("passed"), F.count_if(F.col("status") == "WARN").alias("warned"))
