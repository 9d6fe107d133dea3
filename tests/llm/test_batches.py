"""Long texts reach Python in small batches, and in small chunks."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from marquee.llm import decontaminate as D
from marquee.llm import kernels as K
from marquee.llm import language_id as L
from marquee.llm import ngram_join as N
from marquee.llm.util import BATCH_BYTES, BATCH_LIMIT, materialize


def long_rows(spark, n=4000):
    """20 MB in one partition."""
    text = F.repeat(F.concat(F.lit("word"), F.col("id").cast("string"), F.lit(" ")), F.lit(625))
    return spark.range(0, n, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"))


def only_small(f, most=2 * BATCH_BYTES):
    def checked(batches):
        for b in batches:
            if b.nbytes > most:
                raise ValueError(f"a batch of {b.nbytes} bytes")
            yield b

    return lambda batches: f(checked(batches))


def test_written_layers(spark):
    before, rows = spark.conf.get(BATCH_LIMIT), long_rows(spark)
    got = materialize(rows.mapInArrow(only_small(iter), rows.schema))
    assert spark.conf.get(BATCH_LIMIT) == before
    assert got.count() == 4000 and got.exceptAll(rows).isEmpty()


def test_training_and_index(spark, monkeypatch):
    monkeypatch.setattr(L, "_count_rows", only_small(L._count_rows))
    monkeypatch.setattr(D, "_index_rows", only_small(D._index_rows))
    rows = long_rows(spark)
    assert L.train(rows).langs == ["en"]
    words = D.directory(D.build_index(rows)).agg(F.count("*"), F.sum("n_words")).first()
    assert tuple(words) == (4000, 4000 * 625)


def test_a_longer_row_is_whole(spark):
    rows = spark.range(0, 3, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a bc "), F.lit(2 * BATCH_BYTES // 5)).alias("text"))
    got = materialize(rows.mapInArrow(lambda batches: batches, rows.schema))
    assert [r.n for r in got.select(F.length("text").alias("n")).collect()] == [2 * BATCH_BYTES // 5 * 5] * 3


def test_hashed_chunks(monkeypatch):
    sizes, real = [], K.span_hashes
    monkeypatch.setattr(K, "span_hashes", lambda data, *a: sizes.append(len(data)) or real(data, *a))
    texts, v = pa.array([f"w{i} x y z " * 500 for i in range(600)]), K.byte_values()
    hashed = [(i, h) for i, _, h, _ in D.hash_words(texts, K.space_words(), v, K.Powers())]
    sets = [s for _, s, _ in N._shingle_sets(texts, 4, K.space_words(), v, K.Powers())]
    assert max(sizes) <= 1 << 19 and sum(len(h) for _, h in hashed) == 600 * 2000 and len(sets) == 600
    monkeypatch.setattr(D, "CHUNK_BYTES", 1 << 23)
    monkeypatch.setattr(N, "CHUNK_BYTES", 1 << 23)
    whole = list(D.hash_words(texts, K.space_words(), v, K.Powers()))
    assert len(whole) == 1 and np.array_equal(whole[0][2], np.concatenate([h for _, h in hashed]))
    assert all(np.array_equal(a, b) for a, (_, b, _) in zip(sets, N._shingle_sets(texts, 4, K.space_words(), v, K.Powers()), strict=True))
