"""Shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from marquee import session
from marquee.session import app_scratch_dir

__all__ = ["app_scratch_dir", "materialize", "shuffle_partitions", "small_batches", "table"]

BATCH_BYTES = 4 << 20  # of an Arrow batch to Python
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside sends rows to Python in batches of about BATCH_BYTES (one
    longer row is a batch of its own).  By Spark's own limits, 10,000 rows or
    64 MB, each task holds such a batch several times: in the executor's memory
    outside the heap, in the worker, and as what the worker makes of it."""
    before = spark.conf.get(BATCH_LIMIT)
    spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(BATCH_LIMIT, before)


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """``session.materialize`` with small batches."""
    with small_batches(df.sparkSession):
        return session.materialize(df, label)
