"""Join helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from marquee.session import materialize


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (group keys may be NULL).
    The right side's key columns are dropped from the output."""
    if not keys:
        raise ValueError("join_null_safe needs at least one key")
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__rk_{k}")
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__rk_{k}"]) for k in keys])
    out = left.join(renamed, cond, how)
    return out.drop(*[f"__rk_{k}" for k in keys])


def salted_many_to_one_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                            spread_col: str, how: str = "left", hot_threshold: int = 1_000_000,
                            salt_buckets: int = 32) -> DataFrame:
    """Join ``left`` to ``right`` (unique on ``right_key``) when a few keys of
    ``left`` may be hot.

    Keys with more than ``hot_threshold`` rows on the left are found by one
    partial aggregation; there are at most rows/threshold of them, so that
    set is broadcast with a proven bound.  Hot left rows get a salt from the
    hash of ``spread_col``; the matching right rows (one per hot key) are
    replicated once per salt.  Other keys join with salt 0 as usual, so no
    reducer receives more than about ``hot_threshold`` rows of one key."""
    from pyspark.sql import functions as F

    # both sides read it: written once, so the left side is counted once
    hot = materialize(left.where(F.col(left_key).isNotNull()).groupBy(left_key)
           .agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_threshold)
           .select(F.col(left_key).alias("__hot_key"), F.lit(True).alias("__is_hot")), "hot-keys")
    lh = left.join(F.broadcast(hot), left[left_key] == F.col("__hot_key"), "left").drop("__hot_key")
    lh = lh.withColumn("__salt", F.when(F.col("__is_hot"), F.pmod(F.xxhash64(spread_col), F.lit(salt_buckets)))
                       .otherwise(F.lit(0)).cast("int")).drop("__is_hot")
    rh = right.join(F.broadcast(hot), right[right_key] == F.col("__hot_key"), "left").drop("__hot_key")
    rh = rh.withColumn("__salt", F.explode(F.when(F.col("__is_hot"), F.sequence(F.lit(0), F.lit(salt_buckets - 1)))
                                           .otherwise(F.array(F.lit(0))))).drop("__is_hot") \
        .withColumnRenamed("__salt", "__rsalt")
    cond = (lh[left_key] == rh[right_key]) & (lh["__salt"] == rh["__rsalt"])
    return lh.join(rh, cond, how).drop("__salt", "__rsalt")
