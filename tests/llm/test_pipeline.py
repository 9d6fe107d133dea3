"""The pipeline on small inputs against brute force, stage by stage."""

from collections import Counter

import corpus_pipeline as C
from marquee.llm.util import materialize

from .helpers import CLASH, SF, docs
from .test_decontaminate import brute as contaminated
from .test_ngram_join import brute as components


def test_stages_against_brute_force(spark):
    docs_ = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {}
    for name, stage in C.STAGES:
        docs_ = materialize(stage(spark, docs_, SF), name)
        kept[name] = [(r.doc_id, r.text) for r in docs_.collect()]
        if name != "shard":
            assert docs_.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    first = kept["language_id"]
    assert len(first) >= 0.98 * spark.read.parquet(f"{SF}/documents.parquet").count()
    assert {d for d, _ in kept["ngram_jaccard"]} == {c for _, _, c in components(first, 5, 80)}
    bad = {r[0] for r in contaminated(kept["ngram_jaccard"], items) if r[5]}
    assert bad and {d for d, _ in kept["decontaminate"]} == {d for d, _ in kept["ngram_jaccard"]} - bad
    mixed = Counter(d for d, _ in kept["mix_sources"])
    assert set(mixed) == {d for d, _ in kept["decontaminate"]} and set(mixed.values()) <= {1, 2}
    assert Counter(d for d, _ in kept["shard"]) == mixed
    whole = C.run(spark, SF)
    assert Counter(r.doc_id for r in whole.collect()) == mixed


def test_empty_and_null_rows(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(1, "a passage")], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    docs(spark, []).write.parquet(f"{root}/documents.parquet")
    assert C.run(spark, root).collect() == []
    other = str(tmp_path / "x")
    spark.createDataFrame([(1, "a passage")], "item_id long, text string").write.parquet(f"{other}/benchmark.parquet")
    docs(spark, [(None, None), (None, "words of a text"), (1, "words of a text"), (2, ""), (3, "other words in it here"), (3, "other words in it here")]).write.parquet(f"{other}/documents.parquet")
    got = Counter(r.doc_id for r in C.run(spark, other).collect())
    assert set(got) == {1, 3}


def test_extra_columns_stay(spark):
    from pyspark.sql import functions as F
    plain = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    rows = plain.select("*", *[F.lit(7).alias(c) for c in CLASH])
    for name, stage in C.STAGES[:-1]:
        got = stage(spark, rows, SF)
        assert got.columns == rows.columns, name
        assert {r[c] for r in got.collect() for c in CLASH} == {7}, name
    last = C.STAGES[-1][1](spark, rows, SF)
    added = {"size", "text_crc32", "law", "shard", "slot", "grown_shard"}
    assert last.columns[:5] == plain.columns and set(last.columns) == {*rows.columns, *added}
    assert {r[c] for r in last.collect() for c in set(CLASH) - added} == {7}
