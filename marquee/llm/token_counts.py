"""Operator 2: token counts under a unigram model by trie-shared dynamic programming.

Texts are cut into pre-tokens.  The distinct ones form a trie; its nodes are
visited depth first, and a node extends its parent's forward scores by one
byte, so a prefix that many pre-tokens share is scored once.  A terminal node
keeps the number of pieces of the best segmentation, and a text's count is
the sum over its pre-tokens.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Letters, digits or other signs with a leading space, or white space.
PATTERN = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO = 400_000  # terminal counts that a task keeps; it then starts anew


def read_scores(path: str = VOCABULARY) -> dict[bytes, float]:
    """Log-probabilities of the pieces of a rank file: Zipf's law over the ranks.

    Read on the driver and sent to the tasks (a vocabulary file is a few MB)."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
    total = math.log(sum(1 / (r + 1) for r in ranks.values()))
    return {p: -math.log(r + 1) - total for p, r in ranks.items()}


class UnigramTrie:
    """Forward scores along the current trie path, and terminal counts."""

    def __init__(self, scores: dict[bytes, float]) -> None:
        self.scores = scores
        self.tails = {p[i:] for p in scores for i in range(len(p))}  # where a longer piece can still end
        self.counts: dict[str, int] = {}
        self.nodes = 0

    def insert(self, words: Iterable[str]) -> None:
        """Score new pre-tokens; in sorted order the trie is walked depth first."""
        if len(self.counts) > MEMO:
            self.counts.clear()
        fresh = sorted((w.encode(), w) for w in words if w not in self.counts)
        scores, tails = self.scores, self.tails
        best, pieces = [0.0], [0]  # of the prefixes of the path
        path = b""
        for word, text in fresh:
            n, m = 0, min(len(path), len(word))
            while n < m and path[n] == word[n]:
                n += 1
            del best[n + 1:], pieces[n + 1:]
            for end in range(n + 1, len(word) + 1):
                top, count = -math.inf, 0
                for start in range(end - 1, -1, -1):
                    piece = word[start:end]
                    if piece not in tails:
                        break
                    s = scores.get(piece)
                    if s is not None:
                        s += best[start]
                        if s > top or s == top and pieces[start] < count - 1:
                            top, count = s, pieces[start] + 1
                best.append(top)
                pieces.append(count)
            self.nodes += len(word) - n
            path = word
            self.counts[text] = pieces[len(word)]


def _count_rows(scores, pattern: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, cut = UnigramTrie(scores.value), regex.compile(pattern)
        for b in batches:
            _, off = K.utf8_column(b.column(0))
            pre, tok = [], []
            for i, j in K.chunks(off, K.CHUNK_BYTES // 2):
                words = [cut.findall(t) if t else [] for t in b.column(0).slice(i, j - i).to_pylist()]
                trie.insert(set().union(*words))
                get = trie.counts.__getitem__
                pre += [len(w) for w in words]
                tok += [sum(map(get, w)) for w in words]
            kept = [b.column(k) for k in range(1, b.num_columns)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(pre, pa.int64()), pa.array(tok, pa.int64())], names=[*b.schema.names[1:], "n_pretokens", "n_tokens"])

    return rows


def count_tokens(docs: DataFrame, scores: dict[bytes, float], keep: list[str], pattern: str = PATTERN) -> DataFrame:
    """The ``keep`` columns of ``docs`` with n_pretokens and n_tokens: the number
    of pieces of the likeliest segmentation of every pre-token of the whole
    text, fewer pieces first among equally likely ones.

    Null or empty text: 0.  Every byte is a piece, so any text has a count.
    No shuffle; repeated rows get equal counts; empty table: no rows.  Kept
    columns named like an added one are replaced."""
    keep = [c for c in keep if c.lower() not in ("n_pretokens", "n_tokens")]
    sent = docs.sparkSession.sparkContext.broadcast(scores)
    rows = docs.select(F.col("text").cast("string").alias("__op_text"), *[F.col(c) for c in keep])
    schema = docs.select(*keep).withColumns({"n_pretokens": F.lit(0).cast("long"), "n_tokens": F.lit(0).cast("long")}).schema
    return rows.mapInArrow(_count_rows(sent, pattern), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs.select("doc_id", "text"), read_scores(), ["doc_id"])
