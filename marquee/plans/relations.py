"""Filters that cross many-to-many bridges, and measures under them.

A slicer on a dimension keeps the facts whose movie has a chosen member: a
semi-join with the bridge, so a movie with several chosen members still
counts once.  Measures by members take each movie once a group."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.numeric import round_dec
from marquee.operators._joins import join_null_safe
from marquee.operators.percentile import group_percentiles
from marquee.session import materialize


@dataclass(frozen=True)
class Bridge:
    """(movie_id, ``member``) rows of a dimension."""

    rows: DataFrame
    member: str

    def movies(self, chosen: list[str] | None = None) -> DataFrame:
        """(movie_id, member), of the chosen members or all."""
        rows = self.rows if chosen is None else self.rows.where(F.col(self.member).isin(chosen))
        return rows.select("movie_id", self.member)


def sliced(fact: DataFrame, bridges: Mapping[str, Bridge], chosen: Mapping[str, list[str]]) -> DataFrame:
    """The facts that pass every slicer; an empty choice keeps none."""
    for name, members in chosen.items():
        fact = fact.join(bridges[name].movies(members).select("movie_id"), "movie_id", "left_semi")
    return fact


def kpi_by_slicer(fact: DataFrame, bridges: Mapping[str, Bridge], by: list[str], chosen: Mapping[str, list[str]] | None = None) -> DataFrame:
    """A18's measures for every combination of the members of ``by``, with
    totals: a null member stands for all, and a movie counts once in each row.

    ``chosen`` slices the facts first and, for dimensions of ``by``, the members
    that have rows.  Facts are one row a movie."""
    chosen = chosen or {}
    fact = sliced(fact, bridges, chosen)
    names = [bridges[x].member for x in by]
    # one row a movie with its members of each dimension: bounded by the vocabularies
    movies = fact.where(F.col("movie_id").isNotNull()).select("movie_id", "revenue", "budget", "profit", "roi_pct", "is_roi_eligible")
    for k, x in enumerate(by):
        own = bridges[x].movies(chosen.get(x)).where(F.col("movie_id").isNotNull()).repartition("movie_id")
        # collect_set leaves out a null member, which the total stands for already
        movies = movies.join(own.groupBy("movie_id").agg(F.collect_set(names[k]).alias(f"__m{k}")), "movie_id")
    # written: the measures and the medians read it
    rows = materialize(movies, "sliced")
    # each movie once in each total: a total is one more member
    for k, n in enumerate(names):
        rows = rows.withColumn(n, F.explode(F.concat(F.array(F.lit(None).cast("string")), f"__m{k}"))).drop(f"__m{k}")
    out = rows.groupBy(*names).agg(
        F.count("movie_id").alias("total_movies"),
        *[round_dec(F.sum(c)).alias(f"total_{c}") for c in ("revenue", "budget", "profit")],
        round_dec(F.avg("roi_pct")).alias("average_roi_pct"),
        F.count(F.when(F.col("is_roi_eligible"), 1)).alias("recommendation_movies"))
    median = group_percentiles(rows, names, "roi_pct", {"median_roi_pct": 0.5}).select(*names, "median_roi_pct")
    out = join_null_safe(out, median, names, "left")
    return out.withColumn("median_roi_pct", round_dec("median_roi_pct"))
