"""Operator 10: benchmark decontamination over a positional inverted index.

The training texts are stored as an index table split by documents into
segments: for each segment and token the positions of the token, and one
directory row with the segment's documents.  A query phrase intersects its
terms' position lists, shifted by the term's offset, from the rarest term on.
With ``slop`` 0 that gives exact phrases, else proximity matches.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import kernels as K
from .util import app_scratch_dir, small_batches

WINDOW = 13
SEGMENT_WORDS = 1 << 19  # words in one segment, about 3 MB of text (one longer text is a segment)
ROW_GROUP = 8 << 20  # bytes that the index writer holds
CHUNK_BYTES = 1 << 19  # of text whose words are hashed at once; the scratch arrays take over 30 times as much
BLOCK_WORDS = 200_000  # benchmark words that are searched in one pass
INDEX_SCHEMA = "segment long, token long, n int, first int, width int, gaps binary, doc_ids array<long>, starts array<int>, n_words array<int>, text_hashes array<long>"
MATCH_SCHEMA = "segment long, ordinal int, doc_id long, item_id string, first_word int, n_words int"
MATCH_ARROW = pa.schema([("segment", pa.int64()), ("ordinal", pa.int32()), ("doc_id", pa.int64()), ("item_id", pa.string()), ("first_word", pa.int32()), ("n_words", pa.int32())])


COLUMNS = [x.split()[0] for x in INDEX_SCHEMA.split(", ")]


def _posting_batches(segment: int, tok: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of all tokens: first position, then gaps in 2 or 4 bytes each.

    Positions are 32-bit; an empty place ends each text, so no phrase crosses it."""
    order = np.argsort(tok, kind="stable").astype(np.int32)
    tok = tok[order]
    pos = np.repeat(np.arange(len(counts), dtype=np.int32), counts)[order]
    pos += order
    del order
    head = np.flatnonzero(np.r_[True, tok[1:] != tok[:-1]])
    count = np.diff(np.r_[head, len(tok)])
    token, first = tok[head].view(np.int64), pos[head]
    del tok
    gap = np.zeros(len(pos), dtype=np.uint32)
    gap[1:] = pos[1:] - pos[:-1]  # wraps at list heads, which are cleared
    del pos
    gap[head] = 0
    wide = np.maximum.reduceat(gap, head) > 0xFFFF
    for width, kind, pick in ((2, np.uint16, ~wide), (4, np.uint32, wide)):
        if not pick.any():
            continue
        n = count[pick]
        data = gap[np.repeat(pick, count)].astype(kind)
        off = np.zeros(len(n) + 1, dtype=np.int32)
        np.cumsum(n * width, out=off[1:])
        m = len(n)
        gaps = pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer(off), pa.py_buffer(data)])
        none, none32 = pa.nulls(m, pa.list_(pa.int64())), pa.nulls(m, pa.list_(pa.int32()))
        cols = [pa.array(np.full(m, segment)), pa.array(token[pick]), pa.array(n.astype(np.int32)), pa.array(first[pick]),
                pa.array(np.full(m, width, dtype=np.int32)), gaps, none, none32, none32, none]
        yield pa.RecordBatch.from_arrays(cols, names=COLUMNS)


def _segment_batches(segment: int, ids: list, hashes: list, words: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    starts = np.zeros(len(counts), dtype=np.int64)
    np.cumsum(counts[:-1] + 1, out=starts[1:])
    tok = np.concatenate(words) if words else np.zeros(0, dtype=np.uint64)
    words.clear()
    if len(tok):
        yield from _posting_batches(segment, tok, counts)
    one = [pa.array([segment]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()),
           pa.array([ids], pa.list_(pa.int64())), pa.array([starts.astype(np.int32)], pa.list_(pa.int32())), pa.array([counts.astype(np.int32)], pa.list_(pa.int32())), pa.array([hashes], pa.list_(pa.int64()))]
    yield pa.RecordBatch.from_arrays(one, names=COLUMNS)


def hash_words(texts: pa.Array, table: np.ndarray, values: np.ndarray, powers: K.Powers) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, word hashes, words of each text) for chunks of texts."""
    data, off = K.utf8_column(texts)
    for i, j in K.chunks(off, CHUNK_BYTES):
        part, o = data[off[i]: off[j]], off[i: j + 1] - off[i]
        s, e, first = K.word_bounds(part, o, table)
        yield i, j, K.span_hashes(part, s, e, values, powers), np.diff(first)


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, values, powers = K.letter_digit_words(), K.byte_values(), K.Powers()
    part = TaskContext.get().partitionId() << 24
    seq, ids, hashes, words, counts, size = 0, [], [], [], [], 0
    for b in batches:
        doc_ids, text_hashes = b.column(0).to_pylist(), b.column(2).to_pylist()
        for i, j, h, n in hash_words(b.column(1), table, values, powers):
            ids += doc_ids[i:j]
            hashes += text_hashes[i:j]
            words.append(h)
            counts.append(n)
            size += len(h)
            if size >= SEGMENT_WORDS:
                yield from _segment_batches(part + seq, ids, hashes, words, np.concatenate(counts))
                seq, ids, hashes, words, counts, size = seq + 1, [], [], [], [], 0
    if ids:
        yield from _segment_batches(part + seq, ids, hashes, words, np.concatenate(counts))


def build_index(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the index of ``docs`` (doc_id, text) to ``path`` and return it.

    No shuffle: each task writes segments of its own documents."""
    spark = docs.sparkSession
    path = path or f"{app_scratch_dir(spark)}/token-index-{uuid.uuid4().hex[:12]}"
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash")).mapInArrow(_index_rows, INDEX_SCHEMA)
    with small_batches(spark):
        rows.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(INDEX_SCHEMA).parquet(path)


@dataclass
class Phrases:
    """A block of query phrases: distinct token sequences and their items."""

    windows: dict[tuple[int, ...], set[str]] = field(default_factory=dict)
    words: int = 0

    def add(self, item: str, tokens: np.ndarray, window: int) -> None:
        t = tuple(int(x) for x in tokens)
        for i in range(max(1, len(t) - window + 1)):
            self.windows.setdefault(t[i: i + window], set()).add(item)
        self.words += len(t)

    def tokens(self) -> set[int]:
        return {x for w in self.windows for x in w}

    def by_rarest(self) -> dict[int, list[tuple[tuple[int, ...], set[str]]]]:
        """The windows under the term that the fewest of them have."""
        held: dict[int, int] = {}
        for w in self.windows:
            for x in set(w):
                held[x] = held.get(x, 0) + 1
        out: dict[int, list] = {}
        for w, items in self.windows.items():
            out.setdefault(min(w, key=lambda x: (held[x], x)), []).append((w, items))
        return out


def phrase_blocks(items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[Phrases]:
    """The items' windows in blocks of bounded size; the driver holds one."""
    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, values, powers = K.letter_digit_words(), K.byte_values(), K.Powers()
        for b in batches:
            for i, j, h, n in hash_words(b.column(1), table, values, powers):
                off = np.r_[0, np.cumsum(n)].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(off), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), lists], names=["item_id", "tokens"])

    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), F.col("text").cast("string").alias("text"))
    block = Phrases()
    for r in rows.mapInArrow(tokens, "item_id string, tokens array<long>").toLocalIterator():
        if r.tokens:
            block.add(r.item_id, np.array(r.tokens, dtype=np.int64), window)
            if block.words >= block_words:
                yield block
                block = Phrases()
    if block.words:
        yield block


def _near(lists: list[np.ndarray], offs: list[int], slop: int, starts: np.ndarray) -> np.ndarray:
    """Places s such that term k occurs within ``slop`` of s + k, all in one text."""
    order = sorted(range(len(lists)), key=lambda k: len(lists[k]))
    owner = lists[order[0]]
    at = owner - offs[order[0]]
    if slop:
        owner = np.tile(owner, 2 * slop + 1)
        at = np.concatenate([at + d for d in range(-slop, slop + 1)])
    first = starts[np.searchsorted(starts, owner, side="right") - 1]
    last = np.r_[starts, np.iinfo(np.int64).max][np.searchsorted(starts, owner, side="right")]
    for k in order[1:]:
        other, want = lists[k], at + offs[k]
        i = np.searchsorted(other, np.maximum(want - slop, first))
        found = other[np.minimum(i, len(other) - 1)]
        ok = (i < len(other)) & (found <= want + slop) & (found < last)
        at, first, last = at[ok], first[ok], last[ok]
        if not len(at):
            break
    if slop:  # the place itself may lie outside the text
        at = np.maximum(at, first)
    return np.unique(at)


def _search_segment(rows: pa.Table, windows: dict[int, list[tuple[tuple[int, ...], set[str]]]], slop: int) -> pa.Table:
    where = rows.filter(pc.is_null(rows["token"])).slice(0, 1)
    segment, ids = where["segment"][0].as_py(), where["doc_ids"][0].as_py()
    starts = np.array(where["starts"][0].as_py(), dtype=np.int64)
    ends = starts + np.array(where["n_words"][0].as_py(), dtype=np.int64)
    terms = rows.filter(pc.is_valid(rows["token"])).select(["token", "first", "width", "gaps"]).to_pydict()
    lists: dict[int, np.ndarray] = {}
    for token, first, width, gaps in zip(*terms.values(), strict=True):
        lists[token] = np.cumsum(np.frombuffer(gaps, dtype=np.uint16 if width == 2 else np.uint32), dtype=np.int64) + first
    found: dict[str, list[tuple[np.ndarray, int]]] = {}
    for w, items in (x for t in lists if t in windows for x in windows[t]):
        if all(t in lists for t in w) and len(at := _near([lists[t] for t in w], list(range(len(w))), slop, starts)):
            for item in items:
                found.setdefault(item, []).append((at, len(w)))
    out = []
    for item, hits in found.items():
        s = np.concatenate([a for a, _ in hits])
        e = np.concatenate([a + n for a, n in hits])
        e = np.minimum(e, ends[np.searchsorted(starts, s, side="right") - 1])  # a proximity match may end outside
        order = np.argsort(s, kind="stable")
        s, e = s[order], np.maximum.accumulate(e[order])
        head = np.flatnonzero(np.r_[True, s[1:] >= e[:-1]])
        lo, hi = s[head], e[np.r_[head[1:] - 1, len(e) - 1]]
        doc = np.searchsorted(starts, lo, side="right") - 1
        out += [{"segment": segment, "ordinal": int(d), "doc_id": ids[d], "item_id": item, "first_word": int(a - starts[d]), "n_words": int(b - a)} for d, a, b in zip(doc, lo, hi, strict=True)]
    return pa.Table.from_pylist(out, schema=MATCH_ARROW)


def _searcher(sent, slop: int):
    return lambda rows: _search_segment(rows, sent.value, slop)


def search(index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Maximal runs of words of each document that windows of an item cover.

    A window is ``window`` consecutive words of the item (all, if it has
    fewer).  Only the positions of the block's terms are read and moved."""
    spark = index.sparkSession
    out = None
    for block in phrase_blocks(items, window, block_words):
        sent = spark.sparkContext.broadcast(block.by_rarest())  # at most block_words of them
        terms = spark.createDataFrame([(t,) for t in block.tokens()], "token long")
        rows = index.join(F.broadcast(terms), "token", "left_semi").unionByName(index.where("token IS NULL"))
        rows = rows.select("segment", "token", "first", "width", "gaps", "doc_ids", "starts", "n_words")
        part = rows.groupBy("segment").applyInArrow(_searcher(sent, slop), MATCH_SCHEMA)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], MATCH_SCHEMA) if out is None else out


def directory(index: DataFrame) -> DataFrame:
    """(segment, ordinal, doc_id, text_hash, n_words): one row for each indexed document."""
    rows = index.where("token IS NULL").select("segment", F.posexplode(F.arrays_zip("doc_ids", "text_hashes", "n_words")).alias("ordinal", "d"))
    return rows.select("segment", "ordinal", F.col("d.doc_ids").alias("doc_id"), F.col("d.text_hashes").alias("text_hash"), F.col("d.n_words").cast("long").alias("n_words"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: int = 20, block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row for each document: n_words, n_hit (words inside an occurrence of
    any window), items and n_items, items_sha256, contaminated (n_hit > 0 and
    ``share`` * n_hit >= n_words) and text_hash, the text's xxhash64.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  Null
    or empty text: no words, not contaminated.  Null doc_id: kept.  Repeated
    documents: a row each.  Items without words match nothing; equal item_ids
    count once, a null one as ``null``.  Empty tables give no rows, or no hits.
    Extra columns are not read."""
    index = build_index(docs)
    matches = search(index, items, window, 0, block_words)
    # words covered by the union of the runs of all items, run by run
    w = Window.partitionBy("segment", "ordinal").orderBy("first_word", "n_words", "item_id").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("first_word") + F.col("n_words")
    fresh = F.greatest(F.lit(0), end - F.greatest(F.col("first_word"), F.coalesce(F.max(end).over(w), F.lit(0))))
    hits = (matches.withColumn("fresh", fresh).groupBy("segment", "ordinal")
            .agg(F.sum("fresh").cast("long").alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("items")))
    out = directory(index).join(hits, ["segment", "ordinal"], "left")
    items_ = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0).cast("long"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_).cast("long").alias("n_items"), F.sha2(F.array_join(items_, ",").cast("binary"), 256).alias("items_sha256"),
                      ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"), items_.alias("items"), "text_hash")


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents.  Edges: as in ``contamination``;
    all columns stay as they are, null and empty texts stay.

    Each row goes or stays by its own text: clean rows stay, whatever rows
    share their doc_id or lack one too."""
    bad = contamination(docs, items).where("contaminated").select(F.col("doc_id").alias("__op_bad"), F.col("text_hash").alias("__op_hash")).distinct()
    same_text = F.xxhash64(F.col("text").cast("string")) == F.col("__op_hash")
    return docs.join(bad, F.col("doc_id").cast("long").eqNullSafe(F.col("__op_bad")) & same_text, "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, items).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
