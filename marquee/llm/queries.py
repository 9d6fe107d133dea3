"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, decontaminate, filter_audit, fingerprint, language_id, mixing, ngram_join, pii, sharding, token_counts, url_filter, warc
from .util import table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages against the contract's rules and the list of tracked URLs:
    the canonical URL of every page that was fetched with a campaign tag."""
    pages = table(spark, sf_dir, "pages")
    parts = url_filter.with_parts(pages.select("url"))
    listed = parts.where(F.col("url").contains("utm_")).select(url_filter.canonical_url(F.col("url"), F.col("host"), F.col("path")).alias("canonical"))
    return url_filter.judge_urls(pages.select("page_id", "url"), listed).select("page_id", "host", "path", "rule", "verdict")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.query(spark, sf_dir)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.query(spark, sf_dir)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.query(spark, sf_dir)


def op6_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.query(spark, sf_dir)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.query(spark, sf_dir)


def op8_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.histogram_shards(docs, 40).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.query(spark, sf_dir)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.query(spark, sf_dir)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.query(spark, sf_dir)


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.query(spark, sf_dir)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.query(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_filter, op2_token_counts, op3_fingerprints, op4_ngram_jaccard, op5_warc, op6_temperature_mix, op7_language_id, op8_histogram_sort, op9_pii, op10_decontaminate,
                              op11_centroids, op12_bpe, op13_filter_audit)
}
