"""Operator 6: temperature mixing of sources, realised as block permutations.

A source with T tokens gets weight T**a / sum T**a.  The exponent a is the one
at which the mixture meets a target entropy or a limit on repetition, found by
bisection.  Each weight becomes a budget of tokens: whole epochs over the
source, then part of one.  In an epoch the source's blocks are permuted, and
the rows within each block; the part takes the first rows of its permutation
that fit the budget.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK_TOKENS = 1_000_000
MOST_SOURCES = 1_000_000  # totals that reach the driver; more raise an error


@dataclass(frozen=True)
class Target:
    """What the exponent must meet, and the budget of tokens in all.

    ``entropy`` is a share of the largest possible one (all sources equal).
    ``repetition`` is the most epochs of any source.  If both are given, both
    hold where possible.  ``budget`` None: as many tokens as give every source
    at least one epoch."""

    entropy: float | None = None
    repetition: float | None = None
    budget: int | None = None
    seed: int = 17


def words(text: Column) -> Column:
    """Tokens of a text: its runs of non-space characters (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def weights(totals: list[int], a: float) -> list[float]:
    big = max(totals)
    raw = [(t / big) ** a if t else 0.0 for t in totals]
    return [x / sum(raw) for x in raw]


def epochs(totals: list[int], a: float, budget: int | None) -> list[float]:
    """How often each source is read at exponent ``a``."""
    if budget is None:
        big = max(totals)
        return [(big / t) ** (1 - a) if t else 0.0 for t in totals]
    return [w * budget / t if t else 0.0 for w, t in zip(weights(totals, a), totals, strict=True)]


def entropy_share(w: list[float]) -> float:
    n = sum(x > 0 for x in w)
    return 1.0 if n < 2 else -sum(x * math.log(x) for x in w if x > 0) / math.log(n)


#: Columns that ``mix`` adds.
ADDED = ["n_tokens", "epoch", "block", "block_order", "row_order"]


def bisect(fits: Callable[[float], bool], rising: bool, rounds: int = 60) -> float:
    """The a in [0, 1] where ``fits`` changes: the least one that fits if it holds
    for large a (``rising``), else the largest; 1 or 0 if it never holds."""
    lo, hi = 0.0, 1.0
    if fits(lo if rising else hi):
        return lo if rising else hi
    for _ in range(rounds):
        mid = (lo + hi) / 2
        if fits(mid) == rising:
            hi = mid
        else:
            lo = mid
    return hi if rising else lo


def exponent(totals: list[int], target: Target) -> float:
    """Flatter mixtures have more entropy and repeat small sources more often."""
    if not any(totals):
        return 1.0
    a = 1.0
    if target.entropy is not None:
        a = bisect(lambda x: entropy_share(weights(totals, x)) >= target.entropy, rising=False)
    if target.repetition is not None:
        least = bisect(lambda x: max(epochs(totals, x, target.budget)) <= target.repetition, rising=True)
        a = least if target.entropy is None else max(a, least)
    return a


def source_plan(rows: DataFrame, target: Target) -> tuple[DataFrame, float]:
    """(source, tokens, weight, budget, whole, part, blocks) and the exponent."""
    spark = rows.sparkSession
    got = rows.groupBy("source").agg(F.sum("__op_tokens").alias("t")).limit(MOST_SOURCES + 1).collect()
    if len(got) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    got = sorted(got, key=lambda r: (r.source is not None, r.source))
    totals = [int(r.t) for r in got]
    a = exponent(totals, target)
    plan = []
    for r, t, w, e in zip(got, totals, weights(totals, a) if any(totals) else [0.0] * len(totals), epochs(totals, a, target.budget) if any(totals) else [1.0] * len(totals), strict=True):
        budget = int(math.floor(t * e + 0.5)) if t else 0
        whole, part = divmod(budget, t) if t else (1, 0)  # a source without tokens costs nothing: one epoch
        plan.append((r.source, t, w, budget, whole, part, max(1, -(-t // BLOCK_TOKENS))))
    return spark.createDataFrame(plan, "__op_source string, source_tokens long, weight double, budget long, whole long, part long, blocks long"), a


def mix(docs: DataFrame, target: Target = Target(repetition=2.0), tokens: Column | None = None) -> DataFrame:
    """``docs``, a row for each time that a document is used, with n_tokens,
    epoch, block, block_order and row_order added.

    Sorted by source, epoch, block_order and row_order the rows of an epoch are
    a permutation of the source's blocks and of the rows within each.  A source
    never gets more tokens than its budget, nor less by as much as the next
    document of its permutation has.

    Null sources are one source.  Null or empty texts have no tokens; they come
    with every epoch and cost nothing.  Equal rows share their place and are
    used together or not at all.  A null doc_id is placed by its text.  Empty
    table: no rows.  Columns named like an added one are replaced.

    Only (source, order, tokens) moves; whole rows are never shuffled, however
    large a source is: a source's cut in its last epoch is one row."""
    kept = docs.drop(*[c for c in docs.columns if c.lower() in ADDED])
    rows = kept.withColumn("__op_tokens", words(F.col("text")) if tokens is None else tokens)
    plan, _ = source_plan(rows, target)
    plan = F.broadcast(plan.select("__op_source", *[F.col(c).alias(f"__op_{c}") for c in ("whole", "part", "blocks")]))  # at most MOST_SOURCES short rows, counted above
    seed = F.lit(target.seed)
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("__op_source")))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(seed, "doc_id", "text"), F.col("__op_blocks")))

    def ordered(df: DataFrame) -> DataFrame:
        return df.withColumns({"block_order": F.xxhash64(seed, "epoch", "source", "block"), "row_order": F.xxhash64(seed, "epoch", "doc_id", "text")})

    whole = ordered(rows.where("__op_whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__op_whole") - 1))))
    part = ordered(rows.where("__op_part > 0").withColumn("epoch", F.col("__op_whole")))
    # the cut of each source's partial epoch, from narrow rows
    narrow = part.select("__op_source", F.col("__op_part").alias("part"), "block_order", "row_order", "__op_tokens")
    sums = narrow.groupBy("__op_source", "part", "block_order").agg(F.sum("__op_tokens").alias("t"))
    by_block = Window.partitionBy("__op_source").orderBy("block_order")
    sums = sums.withColumn("upto", F.sum("t").over(by_block)).withColumn("room", F.col("part") - (F.col("upto") - F.col("t")))
    last = sums.where("room >= 0 AND upto > part").select(F.col("__op_source").alias("__op_s"), F.col("block_order").alias("__op_b"), "room")  # one block a source
    inside = narrow.join(F.broadcast(last), F.col("__op_source").eqNullSafe(F.col("__op_s")) & (F.col("block_order") == F.col("__op_b")))
    by_row = Window.partitionBy("__op_source").orderBy("row_order").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("upto", F.sum("__op_tokens").over(by_row)).where("upto <= room")
    cut = inside.groupBy("__op_source").agg(F.max("row_order").alias("__op_cut_row")).withColumnRenamed("__op_source", "__op_cs")
    cut = last.join(cut, F.col("__op_s").eqNullSafe(F.col("__op_cs")), "left").select("__op_s", "__op_b", "__op_cut_row")
    part = part.join(F.broadcast(cut), F.col("__op_source").eqNullSafe(F.col("__op_s")), "left")
    part = part.where("__op_b IS NULL OR block_order < __op_b OR (block_order = __op_b AND row_order <= __op_cut_row) OR __op_tokens = 0")
    names = [c for c in kept.columns] + ["__op_tokens", "epoch", "block", "block_order", "row_order"]
    return whole.select(*names).unionByName(part.select(*names)).withColumnRenamed("__op_tokens", "n_tokens")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "source", "n_tokens", "epoch", "block", "block_order", "row_order")
