"""Operator 3: document fingerprints by content-defined chunking.

A gear hash over the last 16 bytes decides where chunks may end, with a
harder mask below the normal chunk size and an easier one above it.  Since
the boundaries depend on nearby bytes only, an edit changes the chunks around
it and no others.  A fingerprint is the set of chunk digests with their
lengths; containment is the share of a text's bytes in chunks that the other
text has too.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .util import shuffle_partitions

#: Bytes in a chunk: least (the hash window at least), normal, most.
LEAST, NORMAL, MOST = 16, 32, 128
#: Bits of the hash that must be 0 at a boundary, below and above NORMAL.
HARD_BITS, EASY_BITS = 6, 4
LEAST_KEY = -(1 << 63)

_rng = np.random.default_rng(977)
GEAR = _rng.integers(0, 1 << 16, 256, dtype=np.uint16)
VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[data[i - j]] << j over j < 16, by doubling the window."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):
        nxt = h.copy()
        nxt[step:] += h[:-step] << np.uint16(step)
        h = nxt
    return h


def _cuts(places: list[int], hard: list[bool], start: int, end: int) -> list[int]:
    out, s = [], start
    for p, strong in zip(places, hard):
        d = p - s
        if d < LEAST:
            continue
        while d > MOST:
            s += MOST
            out.append(s)
            d -= MOST
        if d >= LEAST and (strong or d >= NORMAL):
            s = p
            out.append(s)
    while end - s > MOST:
        s += MOST
        out.append(s)
    if s < end:
        out.append(end)
    return out


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """Ends of the chunks of each text (offsets are relative to ``data``)."""
    if not len(data):
        return [[] for _ in range(len(offsets) - 1)]
    h = gear_hashes(data)
    place = np.flatnonzero((h >> np.uint16(16 - EASY_BITS)) == 0)
    hard = ((h[place] >> np.uint16(16 - HARD_BITS)) == 0).tolist()
    at = np.searchsorted(place, offsets).tolist()
    place = (place + 1).tolist()  # a chunk ends after its boundary byte
    return [_cuts(place[at[d]: at[d + 1]], hard[at[d]: at[d + 1]], int(offsets[d]), int(offsets[d + 1])) for d in range(len(offsets) - 1)]


def chunk_sets(texts: pa.Array, powers: K.Powers) -> list[np.ndarray]:
    """For each text its sorted distinct chunks: digest << 16 | length."""
    data, off = K.utf8_column(texts)
    out: list[np.ndarray] = []
    for i, j in K.chunks(off):
        part, o = data[off[i]: off[j]], off[i: j + 1] - off[i]
        ends = chunk_ends(part, o)
        count = np.array([len(x) for x in ends], dtype=np.int64)
        end = np.array([x for e in ends for x in e], dtype=np.int64)
        first = np.r_[0, np.cumsum(count)]
        start = np.empty_like(end)
        if len(end):
            start[1:] = end[:-1]
            filled = count > 0
            start[first[:-1][filled]] = o[:-1][filled]
        digest = (K.span_hashes(part, start, end, VALUES, powers) >> np.uint64(32)) << np.uint64(16) | (end - start).astype(np.uint64)
        out += [np.unique(digest[first[d]: first[d + 1]]) for d in range(j - i)]
    return out


def encode(chunks: np.ndarray) -> str:
    """Six bytes for a chunk (digest, length) in base64; empty for no chunk."""
    if not len(chunks):
        return ""
    return base64.b64encode(chunks.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), dtype=np.uint8).reshape(-1, 6)
    return np.concatenate([np.zeros((len(raw), 2), dtype=np.uint8), raw], axis=1).view(">u8").ravel().astype(np.uint64)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of ``a``'s chunk bytes in chunks of ``b``; two empty sets: 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = a[b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a]
    length = np.uint64(0xFFFF)
    return float((both & length).sum()) / float((a & length).sum())


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a fingerprint column: no shuffle.

    Null or empty texts have the empty fingerprint; equal texts equal ones.  A
    column named fingerprint is replaced."""
    kept = docs.drop("fingerprint")
    at = kept.columns.index(text)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = K.Powers()
        for b in batches:
            prints = [encode(x) for x in chunk_sets(b.column(at).cast(pa.string()), powers)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(prints, pa.string())], names=[*b.schema.names, "fingerprint"])

    return kept.mapInArrow(rows, kept.withColumn("fingerprint", F.lit("")).schema)


def _bucket(key, splitters: list[int]):
    """How many splitters are at most ``key``: a binary search over an array."""
    n = len(splitters)
    if not n:
        return F.lit(0)
    bits = n.bit_length()
    arr = "array(" + ",".join(f"{x}L" for x in splitters) + ")"
    return F.expr(f"aggregate(array({','.join(str(1 << k) for k in reversed(range(bits)))}), 0, (a, k) -> if(a + k <= {n} AND try_element_at({arr}, a + k) <= {key}, a + k, a))")


def in_order(docs: DataFrame, pieces: int | None = None) -> DataFrame:
    """(bucket, ahead, doc_id, text) in ascending doc_id, dealt to ranges of ids.

    Each range ends with a copy of the first document of the next one (marked
    ``ahead``; the last range gets the very first), so every document finds its
    successor in its own task and all texts move once.  Nulls come first,
    repeated ids are ordered by text.  The driver holds one id for each range."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(LEAST_KEY)))
    pieces = pieces or shuffle_partitions(spark)
    cuts = rows.select("doc_id").approxQuantile("doc_id", [i / pieces for i in range(1, pieces)], 0.2 / pieces) if pieces > 1 else []
    splitters = sorted({int(x) for x in cuts})
    rows = rows.withColumn("own", _bucket("key", splitters).cast("int"))
    first = sorted((r.k, r.own) for r in rows.groupBy("own").agg(F.min("key").alias("k")).collect())
    before = {k: first[i - 1][1] for i, (k, _) in enumerate(first)}
    if not first:
        before = {0: 0}
    prev = spark.createDataFrame([(k, b) for k, b in before.items()], "first_key long, prev int")
    # a few long ids: one for each range
    rows = rows.join(F.broadcast(prev), rows.key == prev.first_key, "left")
    here, ahead = F.struct(F.col("own").alias("bucket"), F.lit(False).alias("ahead")), F.struct(F.col("prev").alias("bucket"), F.lit(True).alias("ahead"))
    rows = rows.withColumn("to", F.explode(F.when(F.col("prev").isNull(), F.array(here)).otherwise(F.array(here, ahead))))
    rows = rows.select("to.bucket", "to.ahead", "key", "doc_id", "text")
    return rows.repartition(pieces, "bucket").sortWithinPartitions("bucket", "ahead", "key", "text").select("bucket", "ahead", "doc_id", "text")


COMPARED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = K.Powers()
    held: tuple | None = None  # (bucket, doc_id, text, chunks) that waits for its successor
    for b in batches:
        _, off = K.utf8_column(b.column(3))
        for i, j in K.chunks(off, 2 * K.CHUNK_BYTES):
            part = b.slice(i, j - i)
            texts = part.column(3).to_pylist()
            rows = list(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), texts, chunk_sets(part.column(3), powers), strict=True))
            pairs = []
            for bucket, ahead, doc_id, text, chunks in rows:
                if held and held[0] == bucket:
                    pairs.append((held, text, chunks))
                held = None if ahead else (bucket, doc_id, text, chunks)
            out = []
            edited = []
            for (_, _, text, _), nxt, _ in pairs:
                cut = len(text) // 4
                edited.append(text[: len(text) - cut] + nxt[:cut])
            for ((_, doc_id, text, own), _, follow), new, chunks in zip(pairs, edited, chunk_sets(pa.array(edited, pa.string()), powers), strict=True):
                out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), encode(own), encode(chunks), containment(own, chunks), containment(own, follow)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            cols = list(zip(*out, strict=True)) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in COMPARED.split(", ")])


def compare_with_next(docs: DataFrame, pieces: int | None = None) -> DataFrame:
    """Each document's fingerprint, that of its edited text (the last quarter of
    its code points replaced by as many first ones of the next document), and
    the containment of its fingerprint in that one and in the next document's.

    Null texts count as empty ones; an empty text is contained in an empty text
    only.  A null doc_id comes first; repeated ids follow each other in order of
    their texts.  A single document is its own successor.  Empty table: no rows.
    Extra columns are not read."""
    return in_order(docs, pieces).mapInArrow(_compare, COMPARED)
