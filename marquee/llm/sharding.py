"""Operator 8: shards of near equal bytes by histogram sort.

Every row has a 63-bit key from its text and id, so equal texts lie side by
side and a large group of copies can still be split.  The splitters are found
by counting: each round counts the exact bytes and rows in sub-intervals of
the intervals that still hold a wanted splitter, and narrows these down until
the bytes on both sides are within the tolerance of their target.  Then each
row's shard and slot are known from the counts, and the rows move once.

Rows that share a key with more bytes than fit beside a splitter are numbered,
partition by partition, and cut by their number.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .util import materialize, shuffle_partitions

KEY_BITS = 63
ROUND_BITS = 11  # each round splits an interval into 2**11


def size_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 16."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def shard_key(doc_id: Column, text: Column) -> Column:
    """32 bits of the text, then 31 of the id: copies are neighbours, but not ties."""
    low = F.xxhash64(doc_id, text).bitwiseAND(F.lit((1 << 31) - 1))
    return F.shiftleft(text_crc32(text).cast("long"), 31).bitwiseOR(low)


@dataclass
class Interval:
    """Keys from ``lo`` (2**bits of them) with the bytes and rows below and in it."""

    lo: int
    bits: int
    below_bytes: int
    below_rows: int
    size: int
    rows: int


@dataclass
class Tie:
    """A key that one or more splitters cut: its rows are dealt by number."""

    below_bytes: int
    size: int
    rows: int


@dataclass
class Splitters:
    """Of ``n`` ranges: the last key of each but the last, the rows up to it,
    the keys that are cut, the rounds taken and the bytes of all rows."""

    n: int
    keys: list[int]
    rows_up_to: list[int]
    ties: dict[int, Tie]
    rounds: int
    all_bytes: int


def small_table(spark: SparkSession, schema: str, rows: list[list[int]]) -> DataFrame:
    """A few rows of the driver's as a table."""
    names = [c.split()[0] for c in schema.split(", ")]
    text = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    return spark.range(1, numPartitions=1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schema.replace(' long', ':bigint')}>>")))


def targets_upto(x: Column, n: int, total: int) -> Column:
    """How many of the targets ceil(i * total / n) are at most ``x`` bytes."""
    product = x.cast("decimal(25,0)") * F.lit(n).cast("decimal(10,0)")
    return F.call_function("div", product, F.lit(total).cast("decimal(25,0)"))


def find_splitters(keys: DataFrame, n: int, tolerance: int = 0) -> Splitters:
    """Splitters of ``n`` near equal ranges of ``keys`` (key and size).

    Splitter i is the last key of range i: up to it lie at least i/n of all
    bytes, less without its own row, or no more than ``tolerance`` bytes from
    that.  The counts of a round stay in Spark; the driver holds at most n - 1
    intervals, and a round returns the n - 1 bins at most that hold a target."""
    spark = keys.sparkSession
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("s"), F.count("*").alias("n")).first()
    all_bytes, all_rows = int(total.s), int(total.n)
    targets = [(i * all_bytes + n - 1) // n for i in range(1, n)]
    at = [Interval(0, KEY_BITS, 0, 0, all_bytes, all_rows) for _ in targets]
    rounds = 0
    while True:
        open_ = {(x.lo, x.bits): x for x in at if x.bits > 0 and x.rows > 1 and x.size > tolerance}
        if not open_:
            break
        rounds += 1
        bits = max(b for _, b in open_)  # all open intervals are equally wide
        step = max(0, bits - ROUND_BITS)
        if bits == KEY_BITS:  # one interval, of all keys
            part = keys.withColumns({c: F.lit(0).cast("long") for c in ("interval", "below_bytes", "below_rows")})
        else:
            intervals = small_table(spark, "interval long, below_bytes long, below_rows long", [[x.lo >> bits, x.below_bytes, x.below_rows] for x in open_.values()])
            part = keys.withColumn("interval", F.shiftright("key", bits)).join(F.broadcast(intervals), "interval")
        bins = part.groupBy("interval", "below_bytes", "below_rows", F.shiftright("key", step).alias("bin")).agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
        smaller = Window.partitionBy("interval").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # 2**ROUND_BITS bins at most
        bins = bins.withColumns({"before": F.col("below_bytes") + F.coalesce(F.sum("size").over(smaller), F.lit(0)), "rows_before": F.col("below_rows") + F.coalesce(F.sum("rows").over(smaller), F.lit(0))})
        crossed = bins.where(targets_upto(F.col("before"), n, all_bytes) < targets_upto(F.col("before") + F.col("size"), n, all_bytes)).select("interval", "bin", "before", "rows_before", "size", "rows").collect()
        found = sorted(crossed, key=lambda r: r.bin)
        ends = [r.before + r["size"] for r in found]
        for i, x in enumerate(at):
            if (x.lo, x.bits) in open_:
                r = found[bisect_left(ends, targets[i])]
                at[i] = Interval(r.bin << step, step, r.before, r.rows_before, int(r["size"]), int(r.rows))
    last, rows_up_to, ties = [], [], {}
    for i, x in enumerate(at):
        last.append(x.lo + (1 << x.bits) - 1)
        if x.bits == 0 and x.rows > 1 and x.size > tolerance:
            ties[x.lo] = Tie(x.below_bytes, x.size, x.rows)
            rows_up_to.append(x.below_rows - (x.below_bytes - targets[i]) * x.rows // x.size)  # rows that begin before the target, rounded up
        else:
            rows_up_to.append(x.below_rows + x.rows)  # the crossing interval goes to the left range
    return Splitters(n, last, rows_up_to, ties, rounds, all_bytes)


def number_ties(rows: DataFrame, cuts: Splitters) -> DataFrame:
    """The rows of the cut keys with their range, ``__op_piece``.

    They are written once with the place they had, so that a retry numbers them
    alike, then counted by key and partition; the numbers follow from the counts."""
    spark = rows.sparkSession
    ties = small_table(spark, "__op_key long, __op_below long, __op_bytes long, __op_rows long", [[k, t.below_bytes, t.size, t.rows] for k, t in cuts.ties.items()])
    placed = materialize(rows.join(F.broadcast(ties), "__op_key").withColumn("__op_at", F.monotonically_increasing_id()), "shard-ties")
    placed = placed.withColumn("__op_part", F.shiftright("__op_at", 33))
    counts = placed.groupBy("__op_key", "__op_part").agg(F.count("*").alias("__op_n"))
    earlier = Window.partitionBy("__op_key").orderBy("__op_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    counts = counts.select("__op_key", "__op_part", F.coalesce(F.sum("__op_n").over(earlier), F.lit(0)).alias("__op_first"))
    within = F.row_number().over(Window.partitionBy("__op_key", "__op_part").orderBy("__op_at")) - 1
    numbered = placed.withColumn("__op_row", within).join(counts, ["__op_key", "__op_part"]).withColumn("__op_row", F.col("__op_row") + F.col("__op_first"))
    begin = F.expr("__op_below + cast(cast(__op_row as decimal(19,0)) * cast(__op_bytes as decimal(19,0)) div __op_rows as long)")
    piece = targets_upto(begin, cuts.n, cuts.all_bytes).cast("int")
    return numbered.withColumn("__op_piece", piece).drop("__op_below", "__op_bytes", "__op_rows", "__op_at", "__op_part", "__op_first", "__op_row")


def range_of(key: Column, splitters: list[int]) -> Column:
    """How many splitters are below ``key``, by halving."""
    def pick(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key <= F.lit(splitters[mid]), pick(lo, mid)).otherwise(pick(mid + 1, hi))

    return pick(0, len(splitters))


def histogram_shards(docs: DataFrame, shards: int = 40, tolerance: int = 0, pieces: int | None = None) -> DataFrame:
    """``docs`` with size, text_crc32, law, shard, slot and grown_shard added.

    Law ``bytes``: each shard has total / ``shards`` bytes within one document
    (and ``tolerance``).  Slots number a shard's rows from 0 in key order.
    Each shard is dealt to several tasks (``pieces`` ranges, by default enough
    for the session's shuffle partitions), so none sorts a whole shard.

    Null doc_id or text: keyed and sized like any row (size 16); very long
    texts are rows like others.  Equal rows (same id and text) share a key and
    are neighbours; where a shard ends among them they are cut by number, and
    which of them lies where is open, as they are equal.  Empty table: no rows.
    Other columns stay, but for those named like an added one, which are replaced."""
    spark = docs.sparkSession
    added = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    keyed = docs.withColumns({"size": size_bytes(F.col("text")), "text_crc32": text_crc32(F.col("text")), "__op_key": shard_key(F.col("doc_id"), F.col("text"))})
    keys = materialize(keyed.select(F.col("__op_key").alias("key"), "size"), "shard-keys")
    n = shards * max(1, pieces if pieces else -(-shuffle_partitions(spark) // shards))
    cuts = find_splitters(keys, n, tolerance)
    starts = [0, *cuts.rows_up_to]
    per = n // shards
    dealt = keyed.withColumn("__op_piece", range_of(F.col("__op_key"), cuts.keys))
    if cuts.ties:
        tied = F.col("__op_key").isin(list(cuts.ties))
        dealt = dealt.where(~tied).unionByName(number_ties(keyed.where(tied), cuts).select(*dealt.columns))
    # rows of a shard before each of its pieces, known from the counts
    offset = F.element_at(F.array(*[F.lit(starts[p] - starts[p - p % per]).cast("long") for p in range(n)]), F.col("__op_piece") + 1)
    w = Window.partitionBy("__op_piece").orderBy("__op_key", "doc_id")
    return (dealt.withColumn("slot", (F.row_number().over(w) - 1).cast("long") + offset)
            .withColumn("shard", F.floor(F.col("__op_piece") / per).cast("int"))
            .withColumn("law", F.lit("bytes"))
            .withColumn("grown_shard", F.lit(None).cast("int"))
            .drop("__op_piece", "__op_key"))
