"""Files whose records span lines, read in splits.

Spark's text source deals a file's lines to many tasks, but a task cannot
know whether its first line lies inside a quoted field or a nested value.
That depends only on sums over the lines before it: of lines with an odd
number of quotes (CSV), or of opened less closed brackets (JSON).  So

1. one scan sums the measure by split, and the sums of all earlier splits of
   the file give the state in which each split begins (one row a split),
2. each split cuts its own lines into records, in order,
3. only the records that a split's end cuts, two fragments a split at most,
   move and are joined.

Fields are parsed by Spark's own ``from_csv`` and ``from_json``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.session import materialize

WHOLE, HEAD, TAIL = range(3)  # a record; the end of an earlier split's; the start of one
CUT_SCHEMA = "file string, start long, seq long, kind int, text string"
CUT_ARROW = pa.schema([("file", pa.string()), ("start", pa.int64()), ("seq", pa.int64()), ("kind", pa.int32()), ("text", pa.string())])
BATCH = 4096  # records in one Arrow batch

#: (text, lines) of a split in order, its state at the start, is it the file's first -> (seq, kind, text)
Cutter = Callable[[Iterator[str], int, bool], Iterator[tuple[int, int, str]]]


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, row, line): the lines of all files, by file split.

    Lines end with a line feed only, so a carriage return stays inside fields."""
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row")]
    return spark.read.option("lineSep", "\n").text(path).select(*place, F.col("value").alias("line"))


def split_states(lines: DataFrame, measure: Column, ends_at: Callable[[Column], Column], problem: str) -> DataFrame:
    """(file, start, before): the sum of ``measure`` over all earlier splits of the file.

    One row a split, which is all that moves.  A file whose whole sum does not
    satisfy ``ends_at`` is an error."""
    sums = materialize(lines.groupBy("file", "start").agg(F.sum(measure).alias("own")), "split-sums")
    bad = sums.groupBy("file").agg(F.sum("own").alias("total")).where(~ends_at(F.col("total"))).select("file").limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0].file}: {problem}")
    w = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("file", "start", F.coalesce(F.sum("own").over(w), F.lit(0)).cast("long").alias("before"))


def cut_records(lines: DataFrame, states: DataFrame, cutter: Cutter) -> DataFrame:
    """(place, text) of all records; ``place`` orders them as in their files."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (file, start), state, texts in _by_split(batches):
            for seq, kind, text in cutter(texts, state, start == 0):
                out.append((file, start, seq, kind, text))
                if len(out) == BATCH:
                    yield _batch(out)
                    out = []
        yield _batch(out)

    # the join may stay on the scan's side or shuffle by split: either way a split's lines are together, then sorted
    known = lines.join(states, ["file", "start"]).sortWithinPartitions("file", "start", "row")
    cut = known.select("file", "start", "before", "line").mapInArrow(rows, CUT_SCHEMA)
    place = F.struct("file", "start", "seq").alias("place")
    whole = cut.where(F.col("kind") == WHOLE).select(place, "text")
    parts = cut.where(F.col("kind") != WHOLE)
    w = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = parts.withColumn("record", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(w))
    pieces = F.array_sort(F.collect_list(F.struct("start", "kind", "text")))
    joined = numbered.groupBy("file", "record").agg(F.min(F.struct("file", "start", "seq")).alias("place"), F.array_join(F.transform(pieces, lambda p: p["text"]), "\n").alias("text"))
    return whole.unionByName(joined.select("place", "text")).where(F.col("text").rlike(r"\S"))


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], int, Iterator[str]]]:
    """The lines of one split after another; a task holds one batch of them."""
    rows = ((f, s, n, t) for b in batches for f, s, n, t in zip(*(c.to_pylist() for c in b.columns), strict=True))
    held = next(rows, None)
    while held is not None:
        file, start, state, _ = held

        def mine() -> Iterator[str]:
            nonlocal held
            while held is not None and held[0] == file and held[1] == start:
                yield held[3]
                held = next(rows, None)

        texts = mine()
        yield (file, start), state, texts
        for _ in texts:  # what the cutter left
            pass


def _batch(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*out, strict=True)) if out else [[]] * len(CUT_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, CUT_ARROW, strict=True)], schema=CUT_ARROW)


# ---- CSV --------------------------------------------------------------------

def _cut_csv(texts: Iterator[str], odd_before: int, first: bool) -> Iterator[tuple[int, int, str]]:
    """Records of a split: a line with an odd number of quotes opens or closes one."""
    held: list[str] | None = [] if odd_before % 2 else None
    kind, seq, since = HEAD, 0, 0
    for seq, text in enumerate(texts):
        odd = text.count('"') % 2
        if held is None:
            if odd:
                held, kind, since = [text], TAIL, seq
            else:
                yield seq, WHOLE, text
            continue
        held.append(text)
        if odd:
            yield since, HEAD if kind == HEAD else WHOLE, "\n".join(held)
            held = None
    if held is not None:
        yield since, kind, "\n".join(held)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(place, text) of the records of CSV files, which may hold line breaks in quotes.

    Fields with quotes must be quoted themselves (quotes doubled), as every CSV
    writer does; a file that ends inside quotes is an error.  Blank lines
    between records are no records."""
    lines = lines_of(spark, path)
    odd = F.length(F.regexp_replace("line", '[^"]+', "")) % 2
    states = split_states(lines, odd, lambda total: total % 2 == 0, "the file ends inside a quoted field")
    cut = cut_records(lines, states, _cut_csv)
    return cut.withColumn("text", F.regexp_replace("text", r"\r$", ""))


def read_csv_records(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Header CSV read as text, in splits, with line breaks in quoted fields.

    The first line is the header.  ``columns`` are picked by its names in any case; missing ones are NULL
    and others are ignored.  ``ingest_seq`` orders rows by file and place."""
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    names = [c for c in spark.read.options(header=True, quote='"', escape='"').csv(path).columns]
    if not names:  # files without any line
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns) + ", ingest_seq struct<file:string,start:bigint,seq:bigint>")
    schema = ", ".join(f"c{k} string" for k in range(len(names)))
    records = csv_records(spark, path).where("NOT (place.start = 0 AND place.seq = 0)")  # each file's header
    rows = records.select("place", F.from_csv("text", schema, options).alias("r"))
    at = {n.lower(): k for k, n in reversed(list(enumerate(names)))}
    picked = [F.col(f"r.c{at[c.lower()]}").alias(c) if c.lower() in at else F.lit(None).cast("string").alias(c) for c in columns]
    return rows.select(*picked, F.col("place").alias("ingest_seq"))


# ---- JSON -------------------------------------------------------------------

_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{},]')


def _cut_json(texts: Iterator[str], depth: int, first: bool) -> Iterator[tuple[int, int, str]]:
    """Elements of a top-level array: cut at commas at depth 1 and at its two brackets."""
    held: list[str] = []
    since, seq, begun = 0, 0, first  # ``begun``: the held text starts inside this split
    for seq, text in enumerate(texts):
        at = 0
        for m in _TOKEN.finditer(text):
            c = m.group()
            if c in "[{":
                depth += 1
                if depth == 1:  # the array begins
                    held, at, begun, since = [], m.end(), True, seq
            elif c in "]}" or c == "," and depth == 1:
                depth -= c != ","
                if c == "," or depth == 0:
                    yield since, WHOLE if begun else HEAD, "\n".join([*held, text[at: m.start()]])
                    held, at, begun, since = [], m.end(), True, seq
        held.append(text[at:])
    yield since, TAIL if begun else HEAD, "\n".join(held)


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """(place, text) of the elements of files that hold one JSON array each.

    JSON strings have no line breaks, so only the depth passes from line to
    line.  A file on a single line is one line for Spark, and thus one task; an
    array that is not closed is an error."""
    lines = lines_of(spark, path)
    bare = F.regexp_replace(F.regexp_replace("line", r"\\.", ""), '"[^"]*"', "")
    change = F.length(F.regexp_replace(bare, r"[^\[{]+", "")) - F.length(F.regexp_replace(bare, r"[^\]}]+", ""))
    states = split_states(lines, change, lambda total: total == 0, "the JSON array is not closed")
    return cut_records(lines, states, _cut_json)


def read_json_array(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """S3: the elements of top-level JSON arrays, in splits, parsed by ``schema``."""
    return json_elements(spark, path).select(F.from_json("text", schema).alias("r")).select("r.*")
