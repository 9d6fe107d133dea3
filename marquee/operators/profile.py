"""Dataset profiling (Q1-Q7, A15-A21, O3-O6).  One aggregation pass per
report wherever possible; exact quantiles come from the distributed
percentile operator; nothing is collected to the driver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.numeric import round_dec
from marquee.operators.percentile import group_percentiles


def missingness(df: DataFrame, dataset: str) -> DataFrame:
    """Q1: per column null_count and null_pct (2 dp) with a dataset label."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot(["__rows"], cols, "column", "null_count")
    return long.select(F.lit(dataset).alias("dataset"), "column",
                       F.col("null_count").cast("bigint").alias("null_count"),
                       round_dec(F.try_divide(F.col("null_count") * 100.0, F.col("__rows"))).alias("null_pct"))


def id_quality(df: DataFrame, id_col: str, dataset: str, sample: int = 5) -> DataFrame:
    """Q2: rows, unique ids, null ids, rows repeating an earlier id (NULL
    equals NULL), uniqueness flag and up to ``sample`` duplicated ids."""
    per_id = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    summary = per_id.agg(
        F.sum("n").cast("bigint").alias("rows"),
        F.count_if(F.col(id_col).isNotNull()).cast("bigint").alias("unique_ids"),
        F.coalesce(F.sum(F.when(F.col(id_col).isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("null_ids"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows_on_id"),
    )
    dups = per_id.where((F.col("n") > 1) & F.col(id_col).isNotNull()) \
        .select(F.col(id_col).cast("string").alias("v")).orderBy("v").limit(sample) \
        .agg(F.coalesce(F.array_join(F.array_sort(F.collect_list("v")), ","), F.lit("")).alias("sample_duplicate_ids"))
    out = _one_row_join(summary, dups)
    return out.select(F.lit(dataset).alias("dataset"), F.lit(id_col).alias("id_col"), "rows", "unique_ids",
                      "null_ids", "duplicate_rows_on_id",
                      (F.col("duplicate_rows_on_id") == 0).alias("is_unique"), "sample_duplicate_ids")


def _one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Attach a one-row aggregate ``b`` to every row of ``a``; ``b`` is
    broadcast (its size bound is one row), so no constant-key shuffle."""
    return a.withColumn("__k", F.lit(1)).join(F.broadcast(b.withColumn("__k", F.lit(1))), "__k").drop("__k")


def orphan_report(pairs: dict[str, tuple[DataFrame, DataFrame]], sample: int = 5) -> DataFrame:
    """For each named (child ids, parent ids) pair - count of
    distinct child ids missing in the parent and the first ``sample`` of them
    in text order.  Ids are compared as text, as the EDA does."""
    frames = []
    for name, (child, parent) in pairs.items():
        c = child.select(F.col(child.columns[0]).cast("string").alias("v")).where("v IS NOT NULL").distinct()
        p = parent.select(F.col(parent.columns[0]).cast("string").alias("v")).distinct()
        orphans = c.join(p, "v", "left_anti")
        cnt = orphans.agg(F.count(F.lit(1)).cast("bigint").alias("count"))
        smp = orphans.orderBy("v").limit(sample).agg(
            F.coalesce(F.array_join(F.array_sort(F.collect_list("v")), ","), F.lit("")).alias("sample"))
        frames.append(_one_row_join(cnt, smp).select(F.lit(name).alias("check"), "count", "sample"))
    return reduce(lambda a, b: a.unionByName(b), frames)


def describe(df: DataFrame, dataset: str, cols: list[str]) -> DataFrame:
    """A15 for one dataset (see ``describe_many``)."""
    return describe_many([(dataset, df, cols)])


def describe_many(specs: list[tuple[str, DataFrame, list[str]]]) -> DataFrame:
    """Count, mean, std, min, 25/50/75 % (linear) and max per numeric
    column of several datasets: the moments from one aggregate a table, the
    quantiles from one sort of the counted (dataset, column, value) triples."""
    stacks, rows = [], []
    keys = ["dataset", "column"]
    for dataset, df, cols in specs:
        num = df.select(*[F.nullif(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in cols])
        # the moments need no row for each value: one aggregate a table
        rows.append(num.agg(*[F.struct(
            F.count(c).cast("bigint").alias("count"), round_dec(F.avg(c), 6).alias("mean"),
            round_dec(F.stddev_samp(c), 6).alias("std"), F.min(c).alias("min"), F.max(c).alias("max")).alias(c)
            for c in cols]).select(F.inline(F.array(*[
                F.struct(F.lit(dataset).alias("dataset"), F.lit(c).alias("column"), F.col(c).alias("m")) for c in cols])))
            .select(*keys, "m.*"))
        stacks.append(num.select(F.explode(F.array(*[
            F.struct(F.lit(dataset).alias("dataset"), F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols
        ])).alias("s")).select("s.dataset", "s.column", "s.value"))
    stacked = reduce(lambda a, b: a.unionByName(b), stacks)
    q = group_percentiles(stacked, keys, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}).drop("n")
    moments = reduce(lambda a, b: a.unionByName(b), rows).where(F.col("count") > 0)
    # one row for each described column: as many as the call names
    return moments.join(F.broadcast(q), keys, "left").select(
        *keys, "count", "mean", "std", "min",
        round_dec("p25", 6).alias("p25"), round_dec("p50", 6).alias("p50"), round_dec("p75", 6).alias("p75"), "max")


def observe(df: DataFrame, id_col: str, row: list[str], derived: dict[str, Column], flags: dict[tuple[str, str], Column],
            dataset: str) -> DataFrame:
    """Every count of a table in one scan: (dataset, report, item, value).

    ``row`` are the stored columns, ``derived`` columns that follow from them;
    ``flags`` names the conditions to count, by report and item, over both.
    Added to these: the nulls of each column (report ``nulls``), and the report
    ``ids``: rows, unique_ids, null_ids, duplicate_rows_on_id (NULL equals NULL)
    and exact_duplicate_rows.

    Equal rows are counted on the map side, so ``derived`` and ``flags`` are
    evaluated once for each distinct row; distinct rows then meet by id, in
    partial sums, so a hot id is no hot task.  An empty table counts 0."""
    n = F.col("__n")
    per_row = df.groupBy(*row).agg(F.count(F.lit(1)).alias("__n")).withColumns(derived) if derived else \
        df.groupBy(*row).agg(F.count(F.lit(1)).alias("__n"))
    every = {("nulls", c): F.col(f"`{c}`").isNull() for c in [*row, *derived]} | flags
    hits = {f"__f{k}": F.sum(F.when(cond, n).otherwise(0)) for k, cond in enumerate(every.values())}
    per_id = per_row.groupBy(F.col(id_col).alias("__id")).agg(
        F.sum("__n").alias("__rows"), F.sum(n - 1).alias("__again"), *[v.alias(k) for k, v in hits.items()])
    ids = {
        "rows": F.sum("__rows"), "unique_ids": F.count("__id"), "null_ids": F.sum(F.when(F.col("__id").isNull(), F.col("__rows"))),
        "duplicate_rows_on_id": F.sum(F.col("__rows") - 1), "exact_duplicate_rows": F.sum("__again"),
    }
    wide = per_id.agg(*[v.alias(f"__i{k}") for k, v in enumerate(ids.values())], *[F.sum(k).alias(k) for k in hits])
    items = [*((("ids", name), f"__i{k}") for k, name in enumerate(ids)), *zip(every, hits, strict=True)]
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(dataset).alias("dataset"), F.lit(report).alias("report"), F.lit(item).alias("item"),
                 F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("value")) for (report, item), c in items])))


def range_report(df: DataFrame, cols: list[str]) -> DataFrame:
    """Q7: min, p50, p90, max per field (linear quantiles)."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("value")) for c in cols
    ])).alias("s")).select("s.field", "s.value").where(F.col("value").isNotNull())
    mm = stacked.groupBy("field").agg(F.min("value").alias("min"), F.max("value").alias("max"))
    q = group_percentiles(stacked, ["field"], "value", {"p50": 0.5, "p90": 0.9}).drop("n")
    return mm.join(q, "field").select("field", "min", round_dec("p50", 6).alias("p50"),
                                      round_dec("p90", 6).alias("p90"), "max")


def equal_frequency_bins(df: DataFrame, value: str, cuts: tuple[float, ...], labels: tuple[str, ...],
                         out: str = "bin") -> DataFrame:
    """Right-closed bins [0, q1], (q1, q2], ..., (qk, inf) at the
    linear quantiles ``cuts``; adds the label column."""
    qs = {f"q{i}": c for i, c in enumerate(cuts)}
    bounds = group_percentiles(df, [], value, qs).drop("n")
    j = _one_row_join(df, bounds)
    expr = F.lit(labels[-1])
    for i in reversed(range(len(cuts))):
        expr = F.when(F.col(value) <= F.col(f"q{i}"), F.lit(labels[i])).otherwise(expr)
    return j.withColumn(out, F.when(F.col(value) > 0, expr)).drop(*qs.keys())


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Fixed-width bins between min and max (last bin closed), as the
    plotting library draws them: bin, lower, upper, count.  Every bin is
    there, with count 0 if it is empty; no valid value gives no bins."""
    valid = df.select(F.col(value).cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    mm = valid.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).where(F.col("lo").isNotNull())
    span = F.col("hi") - F.col("lo")
    at = F.when(span > 0, F.least(F.floor((F.col("x") - F.col("lo")) / span * bins), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    filled = _one_row_join(valid, mm).groupBy(at.alias("__bin")).agg(F.count(F.lit(1)).cast("bigint").alias("__n"))
    every = mm.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = span / bins
    return every.join(filled, every["bin"] == filled["__bin"], "left").select(
        "bin", round_dec(F.col("lo") + F.col("bin") * width, 6).alias("lower"),
        round_dec(F.col("lo") + (F.col("bin") + 1) * width, 6).alias("upper"),
        F.coalesce("__n", F.lit(0).cast("bigint")).alias("count"))


def top_counts(df: DataFrame, token: str, n: int) -> DataFrame:
    """Most frequent non-blank trimmed tokens (ties by token)."""
    t = df.select(F.trim(F.col(token).cast("string")).alias("token")).where(F.col("token") != "")
    return t.groupBy("token").agg(F.count(F.lit(1)).cast("bigint").alias("movie_count")) \
        .orderBy(F.col("movie_count").desc(), F.col("token")).limit(n)


def array_length_stats(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Mean and max items per row for each array column, one pass."""
    aggs = []
    for label, col in fields.items():
        aggs += [F.avg(F.size(col)).alias(f"{label}__avg"), F.max(F.size(col)).alias(f"{label}__max")]
    wide = df.agg(*aggs)
    rows = [wide.select(F.lit(label).alias("field"), round_dec(f"{label}__avg", 6).alias("avg_items_per_movie"),
                        F.col(f"{label}__max").cast("int").alias("max_items_per_movie")) for label in fields]
    return reduce(lambda a, b: a.unionByName(b), rows)


def top_n(df: DataFrame, order_cols: list, n: int) -> DataFrame:
    """Distributed top-k (TakeOrderedAndProject)."""
    return df.orderBy(*order_cols).limit(n)


LG_K = 12  # registers of a distinct sketch: 2**12, about 4 KB
#: Three standard errors of such a sketch's estimate.
SKETCH_BOUND = 3 * 1.04 / 2 ** (LG_K / 2)


def distinct_sketches(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A14 (approximate): ``keys`` and a mergeable sketch of the distinct ``value``s.

    A sketch has a fixed size whatever it counts, so map-side partial ones
    merge and a hot group moves a few KB a task."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(value), F.lit(LG_K)).alias("sketch"))


def distinct_rollup(sketches: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Estimated distinct values for coarser ``keys``, from the sketches alone:
    no second scan.  Within SKETCH_BOUND of the true count, relatively, in all but
    about three groups of a thousand."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out))
