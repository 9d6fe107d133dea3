"""Exact per-group percentiles without gathering a group into one task.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer; a group holding a third of all rows would have to fit in
one task.  Here one scan counts each group's rows by a coarse step of their
value (64 steps an octave), which tells the step in which each wanted rank
lies.  A second scan keeps only the rows of these steps, counts them per (group,
value) and range-sorts the counts across the cluster, so even a step that holds
all values is no single task.  Each partition's sums give the offsets, and only
the wanted ranks are read back.

``cont`` interpolates between neighbours with Spark's own formula, so results
equal ``F.percentile`` / ``F.median`` bit for bit; ``disc`` returns the element
at rank ceil(q*n) (``percentile_disc``, and what ``percentile_approx``
converges to).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.operators._joins import join_null_safe
from marquee.operators.ordered import range_sorted
from marquee.session import materialize


STEPS = 64  # in an octave
FAR = 70_000  # more than the steps between 1 and the smallest double


def value_step(v: Column) -> Column:
    """A whole number that never falls as the double ``v`` rises."""
    # the logarithm of an infinite value is cut at a step above that of the largest double
    size = F.floor(F.least(F.log2(F.abs(v)) * STEPS, F.lit(1030.0 * STEPS))) + FAR
    return F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0)).cast("int")


def group_percentiles(df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float],
                      method: str = "cont") -> DataFrame:
    """Return ``keys`` + ``n`` + one column per entry of ``quantiles``.

    Groups whose values are all NULL/NaN are absent; with ``keys=[]`` the
    result is one global row (none for an empty input).  Two jobs run over
    ``df``, which should be a cheap scan; the result itself is lazy."""
    if method not in ("cont", "disc"):
        raise ValueError(method)
    gkeys = list(keys) if keys else ["__g"]
    v = F.col(value).cast("double")
    base = df.select(*([F.col(k) for k in keys] if keys else [F.lit(0).alias("__g")]),
                     v.alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    base = base.withColumn("__b", value_step(F.col("__v")))
    # groups x steps they touch: few, and counted on the map side
    steps = base.groupBy(*gkeys, "__b").agg(F.count(F.lit(1)).alias("__c"))
    wg = Window.partitionBy(*gkeys)
    before = F.coalesce(F.sum("__c").over(wg.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    steps = steps.withColumns({"__before": before, "n": F.sum("__c").over(wg)})
    n = F.col("n")
    wanted = []
    for name, q in quantiles.items():
        if method == "cont":
            pos = (n - 1) * F.lit(float(q))
            wanted += [(name, "lo", F.floor(pos)), (name, "hi", F.ceil(pos))]
        else:
            wanted.append((name, "lo", F.greatest(F.ceil(n * F.lit(float(q))) - 1, F.lit(0))))
    ranks = F.array(*[F.struct(F.lit(f"__{nm}_{side}").alias("slot"), r.cast("bigint").alias("rank")) for nm, side, r in wanted])
    targets = steps.select(*gkeys, "__b", "n", "__before", "__c", F.explode(ranks).alias("__t"))
    targets = targets.where((F.col("__t.rank") >= F.col("__before")) & (F.col("__t.rank") < F.col("__before") + F.col("__c")))
    # written, so its size is known and the rows meet it where they are
    targets = materialize(targets.select(*gkeys, "__b", "n", F.col("__t.slot").alias("__slot"), (F.col("__t.rank") - F.col("__before")).alias("__at")), "pct-targets")
    skeys = [*gkeys, "__b"]
    near = join_null_safe(base, targets.select(*skeys), skeys, "left_semi")
    counted = near.groupBy(*skeys, "__v").agg(F.count(F.lit(1)).alias("__k"))
    staged = range_sorted(counted, [*skeys, "__v"], "pct")
    # steps x partitions they touch
    runs = staged.groupBy(*skeys, "__pid").agg(F.sum("__k").alias("__c"))
    before = F.coalesce(F.sum("__c").over(Window.partitionBy(*skeys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wanted_runs = join_null_safe(runs.withColumn("__before", before), targets, skeys).where((F.col("__at") >= F.col("__before")) & (F.col("__at") < F.col("__before") + F.col("__c")))
    wanted_runs = wanted_runs.select(*skeys, "__pid", "n", "__slot", (F.col("__at") - F.col("__before")).alias("__at"))
    upto = F.sum("__k").over(Window.partitionBy(*skeys, "__pid").orderBy("__mid").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    picked = join_null_safe(staged.withColumn("__upto", upto), wanted_runs, [*skeys, "__pid"])
    picked = picked.where((F.col("__at") < F.col("__upto")) & (F.col("__at") >= F.col("__upto") - F.col("__k")))
    out = picked.groupBy(*gkeys).agg(F.first("n").alias("n"), *[
        F.max(F.when(F.col("__slot") == f"__{nm}_{side}", F.col("__v"))).alias(f"__{nm}_{side}") for nm, side, _ in wanted])
    for name, q in quantiles.items():
        lo = F.col(f"__{name}_lo")
        if method == "cont":
            hi, pos = F.col(f"__{name}_hi"), (n - 1) * F.lit(float(q))
            mixed = (F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi
            out = out.withColumn(name, F.when((F.floor(pos) == F.ceil(pos)) | (lo == hi), lo).otherwise(mixed))
        else:
            out = out.withColumn(name, lo)
    out = out.drop(*[f"__{nm}_{side}" for nm, side, _ in wanted])
    return out.drop("__g") if not keys else out


def group_median(df: DataFrame, keys: list[str], value: str, out: str = "median", method: str = "cont") -> DataFrame:
    """A5: exact median per group (interpolated for ``cont``)."""
    return group_percentiles(df, keys, value, {out: 0.5}, method=method).drop("n")
