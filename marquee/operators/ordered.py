"""Order-dependent operators at fact grain (W3, W8, global row numbers).

A window with no PARTITION BY - or one partitioned by a handful of values
such as four budget tiers - runs in a single task.  Here a global order is
computed the distributed way, at every size:

1. ``repartitionByRange`` on the full sort key (ties split by the
   tiebreak columns), ``sortWithinPartitions``;
2. tag rows with ``spark_partition_id`` and ``monotonically_increasing_id``
   and write them once to the session's shared checkpoint directory, so the
   ids are fixed even if executors are lost and later stages re-run (the
   range bounds are sampled once per job and the sort key is a total order,
   so a retried write task reproduces its partition exactly);
3. per-partition counts (one row per partition) -> prefix offsets,
   broadcast back (size bounded by the partition count);
4. global rank = offset + position inside the partition.

NTILE follows from the rank.  LAG/LEAD run inside the range partitions; only
each partition's first and last row look into a table of boundary rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import materialize


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def range_sorted(df: DataFrame, order_by: list, label: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """``df`` written in global order, with ``__pid`` (partition) and ``__mid``
    (consecutive within a partition, increasing over all)."""
    parts = num_partitions or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    oc = _cols(order_by)
    return materialize(
        df.repartitionByRange(parts, *oc)
        .sortWithinPartitions(*oc)
        .withColumn("__pid", F.spark_partition_id())
        .withColumn("__mid", F.monotonically_increasing_id()), label)


def with_global_rank(df: DataFrame, order_by: list, rank_col: str = "global_rank",
                     num_partitions: int | None = None, total_col: str | None = None) -> DataFrame:
    """Add a 1-based dense row number over a total order ``order_by``.

    ``order_by`` must be a total order (append a unique id as tiebreak)."""
    staged = range_sorted(df, order_by, "rank", num_partitions)
    counts = staged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__pn"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "__pid",
        F.coalesce(F.sum("__pn").over(before), F.lit(0)).alias("__off"),
        F.sum("__pn").over(Window.partitionBy(F.lit(1))).alias("__total"),
    )
    # offsets has one row per partition: a proven, config-bounded size
    out = staged.join(F.broadcast(offsets), "__pid")
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("bigint"), 33)
    out = out.withColumn(rank_col, F.col("__off") + local + 1)
    if total_col:
        out = out.withColumnRenamed("__total", total_col)
    return out.drop("__pid", "__mid", "__off", "__total")


def ntile_from_rank(rank: Column, total: Column, buckets: int) -> Column:
    """NTILE(k) of a 1-based row number g among n rows: the first n % k tiles
    get one extra row."""
    q = F.floor(total / buckets)
    r = total % buckets
    big = r * (q + 1)
    return F.when(rank <= big, F.ceil(rank / (q + 1))).otherwise(
        r + F.ceil((rank - big) / q)).cast("int")


def distributed_ntile(df: DataFrame, buckets: int, order_by: list, out: str = "ntile",
                      num_partitions: int | None = None) -> DataFrame:
    """NTILE over the whole DataFrame from a global rank."""
    ranked = with_global_rank(df, order_by, "__g", num_partitions, total_col="__n")
    return ranked.withColumn(out, ntile_from_rank(F.col("__g"), F.col("__n"), buckets)) \
        .drop("__g", "__n")


def distributed_lag_lead(df: DataFrame, partition_by: list[str], order_by: list,
                         value: str, lag_col: str | None, lead_col: str | None,
                         num_partitions: int | None = None) -> DataFrame:
    """Previous / next row's ``value`` within ``partition_by`` in the
    order ``order_by`` (must be a total order).

    Rows are range-sorted by (partition, order); a neighbour is the row before
    or after in the same range partition, or the nearest boundary row of
    another one (two rows for each partition, broadcast)."""
    staged = range_sorted(df, list(partition_by) + list(order_by), "rank", num_partitions)
    row = F.struct(*[F.col(p).alias(f"p{i}") for i, p in enumerate(partition_by)], F.col(value).alias("v"))
    ends = staged.select("__pid", "__mid", row.alias("__row")).groupBy("__pid").agg(
        F.min_by("__row", "__mid").alias("__head"), F.max_by("__row", "__mid").alias("__tail"))
    across = Window.orderBy("__pid")  # one row for each range partition
    ends = ends.select("__pid", F.lag("__tail").over(across).alias("__before"), F.lead("__head").over(across).alias("__after"))
    inside = Window.partitionBy("__pid").orderBy("__mid")
    out = staged.withColumn("__row", row).withColumns({"__prev": F.lag("__row").over(inside), "__next": F.lead("__row").over(inside)})
    out = out.join(F.broadcast(ends), "__pid")
    for name, near, edge in ((lag_col, "__prev", "__before"), (lead_col, "__next", "__after")):
        if name:
            other = F.coalesce(near, edge)
            same = reduce(lambda a, b: a & b, [other[f"p{i}"].eqNullSafe(F.col(p)) for i, p in enumerate(partition_by)], other.isNotNull())
            out = out.withColumn(name, F.when(same, other["v"]))
    return out.drop("__pid", "__mid", "__row", "__prev", "__next", "__before", "__after")
