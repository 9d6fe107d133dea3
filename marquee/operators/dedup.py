"""Duplicate handling.

Deduplication is expressed as an aggregation (``min_by``/``max_by`` over a
packed row) rather than a window, so partial aggregation collapses a hot key
on the map side: an id repeated a billion times never reaches one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators._joins import join_null_safe


def _packed(df: DataFrame) -> Column:
    return F.struct(*[F.col(c) for c in df.columns])


def keep_first(df: DataFrame, keys: list[str], order_by: list[str | Column]) -> DataFrame:
    """A10: one row per key - the first by ``order_by`` (e.g. an ingest
    sequence) - with all columns.  Deterministic given a total order.

    With a single unique sequence column: a fixed-width hash aggregation of
    min(seq) per key (partial aggregation collapses a hot key), then a
    semi-join back on (key, seq) - a unique pair, so a hot key spreads over
    reducers by its sequence values.  Otherwise ``min_by`` over the packed
    row."""
    if len(order_by) == 1 and isinstance(order_by[0], str):
        seq = order_by[0]
        firsts = df.groupBy(*keys).agg(F.min(seq).alias(seq))
        return join_null_safe(df, firsts, list(keys) + [seq], "left_semi")
    key = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_by])
    return df.groupBy(*keys).agg(F.min_by(_packed(df), key).alias("__row")).select("__row.*")


def keep_smallest(df: DataFrame, keys: list[str]) -> DataFrame:
    """A10 without a sequence: the smallest row per key, by its columns in turn.
    The row is its own order, so the aggregation carries one copy of it."""
    return df.groupBy(*keys).agg(F.min(_packed(df)).alias("__row")).select("__row.*")


def sort_key_desc_nulls_last(*cols: str) -> list[Column]:
    """Components of a max-key meaning ``c1 desc nulls last, c2 desc ...``."""
    out: list[Column] = []
    for c in cols:
        out += [F.col(c).isNotNull(), F.col(c)]
    return out


def sort_key_asc_nulls_last(*cols: str) -> list[Column]:
    """Components of a max-key meaning ``c asc nulls last`` (numeric cols)."""
    out: list[Column] = []
    for c in cols:
        out += [F.col(c).isNotNull(), -F.col(c)]
    return out


def best_per_key(df: DataFrame, keys: list[str], max_key: list[Column]) -> DataFrame:
    """Keep the row with the greatest ``max_key`` per key (row_number = 1
    written as a partial-aggregating ``max_by``)."""
    key = F.struct(*max_key)
    return df.groupBy(*keys).agg(F.max_by(_packed(df), key).alias("__row")).select("__row.*")


def mark_duplicates(df: DataFrame, keys: list[str], flag: str = "is_duplicated") -> DataFrame:
    """W10 ``duplicated(keep=False)``: flag every member of a duplicate group;
    missing keys equal each other.  Count per key, then join back (AQE splits a
    skewed key in the join)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return join_null_safe(df, counts, keys).withColumn(flag, F.col("__n") > 1).drop("__n")
