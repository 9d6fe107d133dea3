"""Edge rows and brute-force parts shared by the tests."""

import re

SF = "/root/testdata/sf0.001"
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CLASH = ["size", "shard", "slot", "key", "block", "epoch", "segment", "ordinal", "row", "bucket", "verdict", "fingerprint", "n_tokens", "label", "_text", "left", "items", "score", "Mixture", "lang_pred", "row_order", "law", "token", "class", "ids", "decoded", "fails"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, extra=False):
    """A documents table from texts, or (doc_id, text) pairs; with clashing columns if asked."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "en", "s%d" % (k % 3), len(t or "")) for k, (i, t) in enumerate(rows)], DOCS)
    if extra:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit("x").alias(c) for c in CLASH])
    return df


def edge_texts():
    long = " ".join(f"w{i % 977}x{i}" for i in range(40_000))
    return [None, "", " \n\t ", "a", "Same Text here today", "Same Text here today", "same text HERE today", long, long + " end", "ü ñ 語 " * 30, "\x00\x01", "word " * 5000]
