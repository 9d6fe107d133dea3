"""Operator 1: URL filter by rules and by a list of canonical URLs.

Rules (host and path prefix) decide first.  Other URLs are looked up in the
list: a blocked Bloom filter passes the possible hits, and a hash join with
the list itself removes its false positives.  DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = r"(?i)^(utm_[a-z]+|ref|fbclid|gclid|sessionid|sid)(=|$)"


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path: both empty for null or where ``://`` is missing."""
    u = F.col(url)
    at = F.locate("://", u)
    rest = F.coalesce(F.when(at > 0, u.substr(at + 3, F.length(u))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return df.withColumns({"host": host, "path": path})


def rule_struct(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """(rule, action) of the longest fitting rule, else null.

    The rules are a short parameter, so they become one CASE.  Among equally
    long ones that fit, the longer host, then block, then the text decides."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.action != "block", r.text))
    out = F.lit(None).cast("struct<rule:string,action:string>")
    for r in reversed(ordered):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.action).alias("action"))).otherwise(out)
    return out


def canonical_url(url: Column, host: Column, path: Column) -> Column:
    """Host without www., m. and default ports, path without index or .html
    ending and closing slashes, other query parameters than tracking ones in
    order; no scheme, no fragment.  Null where the URL has no host."""
    h = F.regexp_replace(F.regexp_replace(host, r"^(www|m)\.", ""), r":(80|443)$", "")
    p = F.regexp_replace(F.regexp_replace(path, r"(/index)?\.html?$", ""), r"/+$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(TRACKING)))
    return F.when(host != "", F.concat(h, p, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


@dataclass(frozen=True)
class BloomShape:
    """``blocks`` blocks of ``words`` 64-bit words; one bit in each word for a key.

    A filter never has more than ``max_blocks`` blocks (24 MB): that bounds
    what is broadcast.  Longer lists get more false positives, which the exact
    join removes, and no other result."""

    blocks: int
    words: int = 8
    max_blocks: int = 1 << 18

    @classmethod
    def for_keys(cls, n: int, keys_per_block: int = 32) -> "BloomShape":
        want = max(1, -(-n // keys_per_block))
        return cls(min(cls.max_blocks, 1 << (want - 1).bit_length()))


def _block(key: Column, shape: BloomShape) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shape.blocks)).cast("int")


def _mask(key: Column, i: int) -> Column:
    """The bit of ``key`` in word ``i``: six bits of a second hash for each word."""
    h = F.xxhash64(key, F.lit(f"bloom-{i // 10}"))
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * (i % 10)).bitwiseAND(F.lit(63)).cast("int"))


def build_filter(listed: DataFrame, shape: BloomShape, key: str = "canonical") -> DataFrame:
    """One row (__op_at, __op_w0, ...) for each block that is not empty."""
    k = F.col(key)
    return listed.groupBy(_block(k, shape).alias("__op_at")).agg(*[F.bit_or(_mask(k, i)).alias(f"__op_w{i}") for i in range(shape.words)])


def judge_urls(pages: DataFrame, listed: DataFrame, rules: tuple[Rule, ...] = RULES, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict and listed added.

    ``listed`` has the canonical URLs to block in its first column.  Rules win;
    else a listed URL is blocked and any other allowed.

    Null URLs or ones without ``://``: host and path empty, no rule, never
    listed, so allowed.  Rows that repeat, or many pages of one URL, are each
    judged: only pages that pass the filter move for the exact join, and the
    list has each URL once, so adaptive execution can split a hot one.  Null or
    repeated list entries don't matter; an empty list or table is fine.
    Columns of ``pages`` named like an added one are replaced."""
    added = ["host", "path", "rule", "verdict", "listed"]
    inner = pages.drop(*[c for c in pages.columns if c.lower() in added])
    inner = with_parts(inner, url)
    inner = inner.withColumn("__op_rule", rule_struct(F.col("host"), F.col("path"), rules))
    inner = inner.withColumn("__op_canonical", F.when(F.col("__op_rule").isNull(), canonical_url(F.col(url), F.col("host"), F.col("path"))))
    urls = materialize(listed.select(F.col(listed.columns[0]).alias("canonical")).where("canonical IS NOT NULL").distinct(), "listed-urls")
    shape = BloomShape.for_keys(urls.count())
    bloom = build_filter(urls, shape)  # at most max_blocks rows: a proven bound for the broadcast
    probe = inner.withColumn("__op_block", F.when(F.col("__op_canonical").isNotNull(), _block(F.col("__op_canonical"), shape)))
    probe = probe.join(F.broadcast(bloom), F.col("__op_block") == F.col("__op_at"), "left")
    hit = F.lit(True)
    for i in range(shape.words):
        mask = _mask(F.col("__op_canonical"), i)
        hit = hit & (F.col(f"__op_w{i}").bitwiseAND(mask) == mask)
    probe = probe.withColumn("__op_maybe", F.col("__op_at").isNotNull() & F.coalesce(hit, F.lit(False)))
    probe = probe.drop("__op_block", "__op_at", *[f"__op_w{i}" for i in range(shape.words)])
    sure = probe.where(~F.col("__op_maybe")).withColumn("listed", F.lit(False))
    exact = (probe.where("__op_maybe").join(urls.hint("shuffle_hash").withColumnRenamed("canonical", "__op_listed"), F.col("__op_canonical") == F.col("__op_listed"), "left")
             .withColumn("listed", F.col("__op_listed").isNotNull()).drop("__op_listed"))
    out = sure.unionByName(exact)
    verdict = F.coalesce(F.col("__op_rule.action"), F.when(F.col("listed"), "block").otherwise("allow"))
    return out.withColumns({"rule": F.col("__op_rule.rule"), "verdict": verdict}).drop("__op_rule", "__op_canonical", "__op_maybe")
