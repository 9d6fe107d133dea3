"""The training-data pipeline: five operators in a row over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before kept; between stages the rows are written as Parquet and read again.

In all stages: very long texts are used whole; an empty table gives no rows;
equal scores, counts and hashes never decide by chance, so reruns agree; and
extra columns, whatever their names, come out as they went in (of the last
stage, those not named like a column that it adds).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import decontaminate, language_id, mixing, ngram_join, sharding
from marquee.llm.util import materialize, table


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a known main language go; null and empty texts have
    none.  Repeated rows stay or go together; a null doc_id or lang only keeps
    a row out of the training."""
    return language_id.reject_unknown(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8 or more: the smallest doc_id of each
    group stays, or one row if none has an id.  Of repeated rows one stays; null
    and empty texts and texts without words are like nothing and stay."""
    return ngram_join.keep_one(docs, ngram_join.Likeness(n=5, percent=80))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages make up a twentieth of go.  Each row is
    judged by its own text, so repeated or null ids do no harm; null and empty
    texts stay; a null item text matches nothing."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The flattest mixture of sources that reads none more than twice; every
    document is used once at least, so rows of small sources repeat.  Null
    sources are one source; null and empty texts cost no tokens; repeated rows
    are used equally often."""
    own = {c: f"__op_own_{k}" for k, c in enumerate(docs.columns) if c.lower() in mixing.ADDED}
    back = {v: k for k, v in own.items()}
    used = mixing.mix(docs.withColumnsRenamed(own), mixing.Target(repetition=2.0))
    return used.select(*[own.get(c, c) for c in docs.columns]).withColumnsRenamed(back)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """40 shards of near equal bytes.  Null ids and texts are keyed like any;
    repeated rows lie side by side.  Columns named size, text_crc32, law, shard,
    slot or grown_shard are replaced."""
    return sharding.histogram_shards(docs, 40)


STAGES = [
    ("language_id", by_language),
    ("ngram_jaccard", without_copies),
    ("decontaminate", without_benchmark),
    ("mix_sources", mixed),
    ("shard", sharded),
]

#: SQL can express neither the language model nor the bisected mixture.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the ``documents`` table of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
