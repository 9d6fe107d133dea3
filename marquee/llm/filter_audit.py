"""Operator 13: how filters interact, by contractions of contingency tensors.

Every document is reduced to one bit a filter (does it fail?).  For each part
of the corpus the counts of the 32 combinations, reshaped to 2x2x2x2x2, tell
all there is to know about any order of the filters: a step's figures are
contractions in which each axis is selected by pass, fail or all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import materialize, table

FILTERS = "ABCDE"
AXES = len(FILTERS)
CELLS = 1 << AXES
#: What an axis keeps of (passing, failing) documents, in the order of the constants below.
SELECT = np.array([[1, 0], [0, 1], [1, 1]], dtype=np.int64)
PASS, FAIL, ALL = range(3)
PARTS_AT_ONCE = 32  # parts in one contraction: 32 x 600 rows of results
FIGURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
AUDIT_SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{x} long" for x in FIGURES)
AUDIT_ARROW = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *[(x, pa.int64()) for x in FIGURES]])


@dataclass(frozen=True)
class Rules:
    """Thresholds of the text filters A to D; E has none."""

    least_words: int = 200
    distinct_percent: int = 50
    capital_percent: int = 2
    signs: str = "[#$%&*|]"


def text_failures(text: Column, rules: Rules) -> dict[str, Column]:
    """Filter letter -> does ``text`` (not null) fail it, for filters A to D."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": n < rules.least_words,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < rules.distinct_percent * n.cast("long"),
        "C": 100 * capitals.cast("long") > rules.capital_percent * F.length(text).cast("long"),
        "D": text.rlike(rules.signs),
    }


def judged(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(doc_id, part, text_sha, fails, n): rows of ``docs`` counted by id, part
    and text; bit k of ``fails`` is set if the text fails filter k (A to D).

    Equal rows meet in partial sums; one pass over the texts, which do not move."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    bits = sum((F.when(f, F.lit(1 << FILTERS.index(x))).otherwise(F.lit(0)) for x, f in text_failures(F.col("text"), rules).items()), F.lit(0))
    rows = rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("text_sha"), bits.alias("fails"))
    return rows.groupBy("doc_id", "text_sha", "part", "fails").agg(F.count("*").alias("n"))


def with_copies(rows: DataFrame) -> DataFrame:
    """``rows`` of ``judged`` with bit E set where a smaller doc_id has the same text.

    The smallest id of a text is joined back on (text, id), so a text with any
    number of copies meets one row only."""
    first = rows.groupBy("text_sha").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    out = rows.join(first, ["text_sha", "doc_id"], "left")
    later = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return out.select("doc_id", "part", "n", F.when(later, F.col("fails") + F.lit(1 << FILTERS.index("E"))).otherwise(F.col("fails")).alias("fails"))


def cell_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, n, good, toxic): documents of each combination, and those labelled."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("q"), (F.col("toxic") == 1).alias("t"))
    marks = marks.where("doc_id IS NOT NULL AND (q OR t)").groupBy("doc_id").agg(F.max("q").alias("q"), F.max("t").alias("t"))
    few = rows.groupBy("doc_id", "part", "fails").agg(F.sum("n").alias("n"))  # a repeated id: 32 rows a part at most
    found = few.join(marks, "doc_id", "left")
    counted = [F.sum(F.when(F.col(c), F.col("n")).otherwise(F.lit(0))).alias(name) for c, name in (("q", "good"), ("t", "toxic"))]
    return found.groupBy("part", "fails").agg(F.sum("n").alias("n"), *counted)


def contract(cells: np.ndarray) -> np.ndarray:
    """All selections of (parts, 2, 2, 2, 2, 2) counts: (parts, 3, 3, 3, 3, 3),
    indexed by PASS, FAIL or ALL along each axis."""
    return np.einsum("pabcde,va,wb,xc,yd,ze->pvwxyz", cells, *[SELECT] * AXES, optimize=True)


def _selections() -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The orders, and for each order and step the place in the contracted
    tensor of the documents kept, removed, and of all that fail the step's filter."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    kept, removed, failing = (np.full((len(orders), AXES, AXES), ALL) for _ in range(3))
    for o, order in enumerate(orders):
        for s, letter in enumerate(order):
            before = [FILTERS.index(x) for x in order[:s]]
            axis = FILTERS.index(letter)
            kept[o, s, [*before, axis]] = PASS
            removed[o, s, before] = PASS
            removed[o, s, axis] = failing[o, s, axis] = FAIL
    return orders, kept, removed, failing


def audit_parts(cells: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> tuple[list[str], dict[str, np.ndarray]]:
    """Orders, and figures of shape (parts, orders, steps), from counts of shape (parts, CELLS).

    Cell numbers have filter A in bit 0, so the axes are reversed once."""
    def tensor(x: np.ndarray) -> np.ndarray:
        return contract(x.reshape(-1, *[2] * AXES).transpose(0, *range(AXES, 0, -1)))

    orders, kept, removed, failing = _selections()
    every, good_, toxic_ = tensor(cells), tensor(good), tensor(toxic)

    def pick(t: np.ndarray, where: np.ndarray) -> np.ndarray:
        return t[(slice(None), *np.moveaxis(where, -1, 0))]

    only = np.where(failing == FAIL, FAIL, PASS)
    out = {"kept": pick(every, kept), "removed": pick(every, removed)}
    out["redundant"] = pick(every, failing) - out["removed"]
    out["unique_fails"] = pick(every, only)
    out["good_lost"], out["toxic_lost"] = pick(good_, removed), pick(toxic_, removed)
    letter = np.argmax(failing == FAIL, axis=-1)  # the step's filter
    total = np.stack([(out["removed"] * (letter == k)).sum(axis=(1, 2)) for k in range(AXES)], axis=1)
    out["shapley"] = total[:, letter]
    return orders, out


def _audit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, PARTS_AT_ONCE):
            part = b.slice(i, PARTS_AT_ONCE)
            counts = np.zeros((3, part.num_rows, CELLS), dtype=np.int64)
            for p, cells in enumerate(part.column(1).to_pylist()):
                for c in cells:
                    counts[:, p, c["fails"]] = c["n"], c["good"], c["toxic"]
            orders, figures = audit_parts(*counts)
            shape = figures["kept"].shape
            per = shape[1] * shape[2]
            names = part.column(0).take(pa.array(np.repeat(np.arange(shape[0]), per)))
            order = pa.array(np.tile(np.repeat(np.array(orders, dtype=object), AXES), shape[0]), pa.string())
            step = pa.array(np.tile(np.arange(1, AXES + 1, dtype=np.int32), shape[0] * shape[1]))
            yield pa.RecordBatch.from_arrays([names, order, step, *[pa.array(figures[x].ravel(), pa.int64()) for x in FIGURES]], schema=AUDIT_ARROW)


def audit(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """A row for each part (value of source), order of the five filters and step:
    kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Null text: empty.  Null source: part ``''``, with those whose source is
    empty.  Null doc_id: a document without labels that is no one's copy and
    whose text makes no copy.  Repeated rows count each; equal ids with equal
    text are no copies of each other.  Repeated labels: 1 if any row says 1;
    labels of ids that no document has count nowhere.  Very long texts: split
    in one row's task.  Empty table: no parts, so no rows.  Extra columns are
    not read.

    Texts are read once, and only ids, hashes and bits move; every part's
    counts are 32 at most, made by partial sums, so a hot part, text or id
    gathers nowhere."""
    rows = materialize(judged(docs, rules), "audit-rows")
    cells = cell_counts(with_copies(rows), labels)
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells"))
    return parts.mapInArrow(_audit_rows, AUDIT_SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), table(spark, sf_dir, "labels"))
