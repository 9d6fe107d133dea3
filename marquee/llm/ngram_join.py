"""Operator 4: exact n-gram Jaccard join by multiple-global-order filtering.

A pair whose sets have a Jaccard similarity of at least t shares at least l
tokens in prefixes of n - ceil(t n) + l tokens of both sets under *every*
global order of tokens.  Here l is an eighth of the smaller set.  The join

1. counts tokens in a sketch of fixed size, so that all orders put frequent
   tokens last (any order is right; this one keeps posting lists short),
2. keeps one text for each distinct word sequence,
3. deals the prefix tokens of the first order to tasks, drops those that a
   single text has, and texts with too few of the others,
4. puts texts that share most of these tokens into blocks of bounded size and
   lists the pairs of blocks that share a token,
5. in each pair of blocks keeps the pairs of texts that share a prefix token
   under each of the other orders too, verifies them on their whole sets and
   returns a spanning forest of the links,
6. joins the links to components.

No step lists all pairs of a group; a hot token's postings are salted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import kernels as K
from .util import materialize, shuffle_partitions

SKETCH_BITS = 22  # counters of the token sketch: 2**22, whatever the input
FREQUENT = 64  # hits of a counter from which its tokens count as frequent
ORDERS = 3
EXTRA = 8  # a prefix has size / EXTRA tokens more than one shared token would need
SALT_FROM = 12  # tokens of a higher class (over 2**12 hits) are dealt to several tasks
CHUNK_BYTES = 1 << 19  # of text that is shingled at once; the scratch arrays take over 30 times as much
BLOCK_TOKENS = 1_000_000  # set elements in a block of texts, at most about (8 MB)


@dataclass(frozen=True)
class Likeness:
    """Words in a shingle, and the least similarity in hundredths."""

    n: int = 4
    percent: int = 85

    def prefix(self, size: int) -> int:
        return size - (self.percent * size + 99) // 100 + max(1, size // EXTRA)

    def shared_at_least(self, size: str) -> str:
        """SQL: tokens of its prefix that a set shares with a linked one, which may be smaller."""
        return f"greatest(1, ({self.percent} * {size} + 99) DIV 100 DIV {EXTRA})"


def _shingle_sets(texts: pa.Array, n: int, table: np.ndarray, values: np.ndarray, powers: K.Powers) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(text number, sorted distinct shingle hashes, word hashes)."""
    mult = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93)]
    data, off = K.utf8_column(texts)
    for i, j in K.chunks(off, CHUNK_BYTES):
        part, o = data[off[i]: off[j]], off[i: j + 1] - off[i]
        s, e, first = K.word_bounds(part, o, table)
        h = K.span_hashes(part, s, e, values, powers)
        with np.errstate(over="ignore"):
            m = max(0, len(h) - n + 1)
            g = np.zeros(m, dtype=np.uint64)
            for k in range(n):
                g = K.mix64(g * mult[0] + h[k: k + m] * mult[1 + k % 3] + np.uint64(k))
        for d in range(j - i):
            a, b = int(first[d]), int(first[d + 1])
            w = h[a:b]
            if b - a >= n:
                yield i + d, np.unique(g[a: b - n + 1]), w
            elif b > a:
                with np.errstate(over="ignore"):
                    short = np.uint64(b - a)
                    for x in w:
                        short = K.mix64(np.array([short * mult[0] + x], dtype=np.uint64))[0]
                yield i + d, np.array([short], dtype=np.uint64), w
            else:
                yield i + d, w, w


def _digest(words: np.ndarray, seed: int) -> int:
    """64 bits of a word sequence."""
    with np.errstate(over="ignore"):
        at = np.arange(1, len(words) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
        x = K.mix64(words ^ K.mix64(at)).sum(dtype=np.uint64) + np.uint64(len(words))
        return int(K.mix64(np.array([x]))[0].astype(np.int64))


def _ranks(tokens: np.ndarray, order: int, classes: np.ndarray) -> np.ndarray:
    """Token numbers by global order ``order``: frequency class, then its own hash."""
    with np.errstate(over="ignore"):
        h = K.mix64(tokens ^ K.mix64(np.array([order + 1], dtype=np.uint64))[0])
    c = classes[(tokens & np.uint64(len(classes) - 1)).astype(np.int64)]
    return np.lexsort((h, c)) if c.any() else np.argsort(h)


def _base_rows(like: Likeness, seed: int):
    """For each row its text's digests and set size; then the task's frequent sketch counters."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, values, powers = K.space_words(), K.byte_values(), K.Powers()
        size = 1 << SKETCH_BITS
        sketch, seen = np.zeros(size, dtype=np.int32), 0
        for b in batches:
            n, d1, d2 = [], [], []
            for _, tokens, words in _shingle_sets(b.column(1), like.n, table, values, powers):
                n.append(len(tokens))
                d1.append(_digest(words, seed) if len(words) else None)
                d2.append(_digest(words, ~seed & 0xFFFFFFFF) if len(words) else None)
                _count(sketch, tokens)
                seen += len(tokens)
            m = len(b)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())],
                                             names=["doc_id", "text_hash", "n", "key", "key2", "bucket", "hits"])
        often = np.flatnonzero(sketch >= 4 + 2 * seen // size)  # of one task; others cannot add up to much
        none = pa.nulls(len(often), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, none, pa.array(often), pa.array(sketch[often].astype(np.int64))], names=["doc_id", "text_hash", "n", "key", "key2", "bucket", "hits"])

    return rows


def _count(sketch: np.ndarray, tokens: np.ndarray) -> None:
    # tokens are distinct, but their buckets may not be
    bucket, hits = np.unique((tokens & np.uint64(len(sketch) - 1)).astype(np.int64), return_counts=True)
    sketch[bucket] += hits


def _frequency_classes(rows: DataFrame) -> np.ndarray:
    """uint8 classes of the sketch counters: 0 for ordinary ones, then the logarithm of their hits.

    At most 2**SKETCH_BITS counters reach the driver, whatever the input."""
    hits = rows.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("hits").alias("hits"))
    got = hits.where(F.col("hits") >= FREQUENT).toPandas()
    out = np.zeros(1 << SKETCH_BITS, dtype=np.uint8)
    if len(got):
        out[got["bucket"].to_numpy()] = np.log2(got["hits"].to_numpy()).astype(np.uint8)
    return out


def _prefix_rows(like: Likeness, seed: int, classes):
    """(token, key, n, class) of the first order's prefix, once for each text of a task."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, values, powers = K.space_words(), K.byte_values(), K.Powers()
        cls, seen = classes.value, set()
        names = ["token", "key", "n", "class"]
        for b in batches:
            toks, keys, sizes, lens = [], [], [], []
            for _, tokens, words in _shingle_sets(b.column(0), like.n, table, values, powers):
                if not len(tokens):
                    continue
                key = _digest(words, seed)
                if key in seen:
                    continue
                seen.add(key)
                p = like.prefix(len(tokens))
                toks.append(tokens[_ranks(tokens, 0, cls)[:p]])
                keys.append(key)
                sizes.append(len(tokens))
                lens.append(p)
            if toks:
                t = np.concatenate(toks)
                c = cls[(t & np.uint64(len(cls) - 1)).astype(np.int64)].astype(np.int32)
                cols = [pa.array(t.view(np.int64)), pa.array(np.repeat(np.array(keys, dtype=np.int64), lens)), pa.array(np.repeat(np.array(sizes, dtype=np.int32), lens)), pa.array(c)]
                for k in range(0, len(t), 200_000):
                    yield pa.RecordBatch.from_arrays([x.slice(k, 200_000) for x in cols], names=names)

    return rows


FILTER_WORDS = 1 << 17


def _row_filter(rows: DataFrame) -> np.ndarray:
    """A bit set of fixed size (1 MB) that holds every ``row`` hash, and others if there are many."""
    bit = F.col("row").bitwiseAND(F.lit(FILTER_WORDS * 64 - 1))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))
    got = rows.groupBy(F.shiftright(bit, 6).alias("w")).agg(F.bit_or(mask).alias("m")).toPandas()
    out = np.zeros(FILTER_WORDS, dtype=np.int64)
    out[got["w"].to_numpy(dtype=np.int64)] = got["m"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def _set_rows(like: Likeness, seed: int, some):
    """(key, row, tokens) of the texts whose row hash passes the filter."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, values, powers = K.space_words(), K.byte_values(), K.Powers()
        for b in batches:
            row = b.column(1).to_numpy().astype(np.int64)
            bit = row & (FILTER_WORDS * 64 - 1)
            pick = (some.value[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1
            b = b.filter(pa.array(pick))
            keys, own, sets = [], [], []
            for i, tokens, words in _shingle_sets(b.column(0), like.n, table, values, powers):
                if len(tokens):
                    keys.append(_digest(words, seed))
                    own.append(b.column(1)[i].as_py())
                    sets.append(tokens.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(own, pa.int64()), pa.array(sets, pa.binary())], names=["key", "row", "tokens"])

    return rows


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def links_between(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, like: Likeness, classes: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links between texts of ``left`` and ``right``,
    which may hold those of ``left`` too.

    Candidates share a prefix token under every order; the filters' results are
    intersected before the whole sets are compared.  Pairs that earlier links
    already join need no comparison."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    # dense token numbers within the block pair
    every = np.concatenate(sets)
    names, dense = np.unique(every, return_inverse=True)
    dense = dense.astype(np.int32)
    edge = np.r_[0, np.cumsum(size)]
    dense = [dense[edge[i]: edge[i + 1]] for i in range(len(sets))]
    on_right = np.zeros(len(sets), dtype=bool)
    on_right[right] = True
    postings = []  # by order: for each token the texts that have it in their prefix
    prefixes = []
    for order in range(ORDERS):
        pre = [dense[i][_ranks(sets[i], order, classes)[: like.prefix(len(sets[i]))]] for i in range(len(sets))]
        tok = np.concatenate([pre[i] for i in right])
        own = np.repeat(right.astype(np.int32), [len(pre[i]) for i in right])
        by = np.argsort(tok, kind="stable")
        bounds = np.searchsorted(tok[by], np.arange(len(names) + 1))
        postings.append((own[by], bounds))
        prefixes.append(pre)
    tok = np.concatenate([dense[i] for i in right])
    own = np.repeat(right.astype(np.int32), size[right])
    by = np.argsort(tok, kind="stable")
    full = (own[by], np.searchsorted(tok[by], np.arange(len(names) + 1)))

    def holders(table, tokens: np.ndarray) -> np.ndarray:
        texts, bounds = table
        lo, n = bounds[tokens], bounds[tokens + 1] - bounds[tokens]
        if not n.sum():
            return texts[:0]
        return texts[np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())]

    forest, out = Forest(len(sets)), []
    for a in left:
        a = int(a)
        near = (100 * np.minimum(size, size[a]) >= like.percent * np.maximum(size, size[a])) & on_right
        near[left[left <= a]] = False
        for order in range(ORDERS):
            if not near.any():
                break
            near &= np.bincount(holders(postings[order], prefixes[order][a]), minlength=len(sets)) >= np.maximum(1, np.minimum(size, size[a]) // EXTRA)
        cand = np.flatnonzero(near)
        if len(cand):
            root = forest.find(a)
            cand = np.array([c for c in cand if forest.find(int(c)) != root], dtype=np.int64)
        if not len(cand):
            continue
        both = np.bincount(holders(full, dense[a]), minlength=len(sets))[cand]
        for c in cand[100 * both >= like.percent * (size[a] + size[cand] - both)]:
            if forest.join(a, int(c)):
                out.append((a, int(c)))
    return out


def _verify_blocks(like: Likeness, classes):
    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("key").sort_values("key")
        sets = [np.frombuffer(x, dtype=np.uint64) for x in pdf["tokens"]]
        keys, block = pdf["key"].to_numpy(), pdf["block"].to_numpy()
        left, right = np.flatnonzero(block == pdf["left"].iloc[0]), np.flatnonzero(pdf["is_right"].to_numpy())
        got = links_between(sets, left, right, like, classes.value) if len(left) and len(right) else []
        return pd.DataFrame({"a": [keys[x] for x, _ in got], "b": [keys[y] for _, y in got]}, dtype="int64")

    return group


def components(edges: DataFrame) -> DataFrame:
    """(node, label): connected components of (a, b), labelled by the least node.

    Least neighbouring label, then the label's own label, until nothing
    changes: a number of rounds that grows with the logarithm of the longest
    path.  Each round is written, which cuts the lineage."""
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        seen = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(seen, labels.node == seen.a).select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        up = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        new = materialize(step.join(up, step.label == up._n).select("node", F.least("label", "_l").alias("label"), "old"), "labels")
        if new.where("label != old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def _identify(docs: DataFrame, like: Likeness) -> tuple[DataFrame, int]:
    """Base rows and the seed under which no two different texts share a key."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("text_hash"))
    for seed in range(1, 9):
        base = materialize(rows.mapInArrow(_base_rows(like, seed), "doc_id long, text_hash long, n long, key long, key2 long, bucket long, hits long"), "ngram-base")
        if base.where("key IS NOT NULL").groupBy("key").agg((F.min("key2") != F.max("key2")).alias("clash")).where("clash").isEmpty():
            return base, seed
    raise RuntimeError("eight seeds gave clashing 64-bit text keys")


def jaccard_components(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """A row for each document: doc_id, text_hash, n_shingles and component_id,
    the smallest doc_id that is reachable by links (itself included); and label,
    a number that all rows of a component share, even without any doc_id.

    A document's set has its distinct ``like.n``-word shingles (words
    ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z), or its whole word sequence
    if that is shorter.  Two link when 100 * shared >= ``like.percent`` * union.
    Equal word sequences have equal sets and are compared once.

    Null or empty texts and texts without words: size 0, linked with nothing.
    A null doc_id is never the smallest; a component of such rows alone has
    none.  Repeated rows: a row each, in one component.  Very long texts are
    used whole.  Empty table: no rows.  Extra columns are not read."""
    spark = docs.sparkSession
    base, seed = _identify(docs, like)
    classes = spark.sparkContext.broadcast(_frequency_classes(base))  # 4 MB
    base = base.where("bucket IS NULL").select("doc_id", "text_hash", "n", "key")
    texts = docs.select(F.col("text").cast("string").alias("text")).where("text IS NOT NULL")

    # prefix postings of the first order; a frequent token's are salted by text
    parts = shuffle_partitions(spark)
    posts = texts.mapInArrow(_prefix_rows(like, seed, classes), "token long, key long, n int, class int")
    salt = F.when(F.col("class") > SALT_FROM, 1 + F.pmod(F.hash("key"), F.pow(F.lit(2), F.col("class") - SALT_FROM).cast("int"))).otherwise(F.lit(0))
    posts = posts.select("token", "key", "n", salt.cast("int").alias("salt")).repartition(parts, "token", "salt")
    w = Window.partitionBy("token", "salt")
    shared = posts.withColumns({"least": F.min("key").over(w), "most": F.max("key").over(w)}).where("least < most OR salt > 0")
    shared = materialize(shared.select("token", "key", "n", "least"), "shared-tokens")

    # family: the first text of most of a text's lists; a family's texts are dealt to blocks of bounded size
    by_key = shared.repartition(parts, "key")
    votes = by_key.groupBy("key", "n", "least").agg(F.count("*").alias("votes"))
    family = votes.groupBy("key", "n").agg(F.max(F.struct("votes", F.col("least").alias("family"))).alias("m"), F.sum("votes").alias("tokens"))
    family = family.where(f"tokens >= {like.shared_at_least('n')}").select("key", "n", "m.family")
    blocks = family.groupBy("family").agg(F.ceil(F.sum("n") / BLOCK_TOKENS).cast("int").alias("parts"))
    placed = family.join(blocks, "family").select("key", "n", F.xxhash64("family", F.pmod(F.hash("key"), F.greatest("parts", F.lit(1)))).alias("block"))
    placed = materialize(placed, "blocks")

    # pairs of blocks that share as many tokens as a link between their smallest texts needs
    held = by_key.select("token", "key").join(placed.select("key", "block"), "key").select("token", "block").repartition(parts, "token").distinct()
    other = held.select(F.col("token").alias("_t"), F.col("block").alias("right"))
    pairs = held.join(other, (F.col("token") == F.col("_t")) & (F.col("block") <= F.col("right"))).groupBy(F.col("block").alias("left"), "right").agg(F.count("*").alias("tokens"))
    crowd = materialize(placed.groupBy("block").agg(F.count("*").alias("texts"), F.sum("n").alias("weight"), F.min(F.greatest(F.lit(1), F.expr(f"n DIV {EXTRA}"))).alias("need")), "block-sizes")
    pairs = pairs.join(crowd, pairs.left == crowd.block).where("left != right OR texts > 1").select("left", "right", "tokens", F.col("need").alias("need_left"))
    pairs = pairs.join(crowd, pairs.right == crowd.block).where("tokens >= least(need, need_left)").select("left", "right", "weight")
    pairs = materialize(pairs, "block-pairs")
    # a block meets its partners in as few tasks as their size allows, so its sets move less often
    load = pairs.groupBy("left").agg(F.ceil(F.sum("weight") / (2 * BLOCK_TOKENS)).cast("int").alias("chunks"))
    met = pairs.join(load, "left").withColumn("chunk", F.pmod(F.hash("right"), F.greatest("chunks", F.lit(1))))
    ends = met.select("left", "chunk", F.col("right").alias("block"), F.lit(True).alias("is_right"))
    ends = ends.union(met.select("left", "chunk", F.col("left").alias("block"), F.lit(False).alias("is_right")))
    ends = ends.groupBy("left", "chunk", "block").agg(F.max("is_right").alias("is_right"))

    # whole sets of the texts in these blocks, from one document of each text
    wanted = materialize(ends.select("block").distinct().join(placed, "block").select("key", "block"), "wanted")
    chosen = base.where("key IS NOT NULL").groupBy("key").agg(F.min(F.struct("doc_id", "text_hash")).alias("d"))
    chosen = materialize(chosen.join(wanted, "key").select("key", "block", F.xxhash64("d.doc_id", "d.text_hash").alias("row")), "wanted")
    source = docs.where("text IS NOT NULL").select(F.col("text").cast("string").alias("text"), F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("row"))
    some = spark.sparkContext.broadcast(_row_filter(chosen))  # 1 MB; the join below is exact
    sets = source.mapInArrow(_set_rows(like, seed, some), "key long, row long, tokens binary").join(chosen, ["key", "row"]).select("key", "block", "tokens")
    grouped = ends.join(sets, "block").groupBy("left", "chunk")
    edges = materialize(grouped.applyInPandas(_verify_blocks(like, classes), "a long, b long"), "links")

    # components of texts, then of documents
    least = base.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("least_id"))
    labels = components(edges)
    named = least.join(labels, least.key == labels.node, "left").select("key", "least_id", F.coalesce("label", "key").alias("label"))
    tops = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    by_key = named.join(tops, "label").select(F.col("key").alias("_key"), "component_id", "label")
    out = base.join(by_key, base.key == by_key._key, "left")
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "label")


def keep_one(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """``docs`` with one row of each component: of its smallest doc_id (none, if
    no row has one), and of the least text hash where that id repeats.

    Texts without words are linked with nothing and stay."""
    found = jaccard_components(docs, like)
    copies = found.groupBy("label", "doc_id", "text_hash").agg(F.max("n_shingles").alias("n"), F.count("*").alias("rows"))
    alone = [F.when(F.col("label").isNull(), F.col(c)) for c in ("doc_id", "text_hash")]
    first = copies.groupBy("label", *[c.alias(f"alone{k}") for k, c in enumerate(alone)]).agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "n", "rows")).alias("d"))
    stay = first.select(F.col("d.doc_id").alias("__op_id"), F.col("d.text_hash").alias("__op_hash"), F.col("d.n").alias("__op_n"), F.col("d.rows").alias("__op_rows"))
    kept = docs.join(stay, F.col("doc_id").cast("long").eqNullSafe(F.col("__op_id")) & F.xxhash64("text").eqNullSafe(F.col("__op_hash")))
    once, many = kept.where("__op_rows = 1 OR __op_n = 0"), kept.where("__op_rows > 1 AND __op_n > 0")
    return once.unionByName(many.dropDuplicates(["__op_id", "__op_hash"])).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard_components(docs).select("doc_id", "n_shingles", "component_id")
