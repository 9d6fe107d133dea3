"""The filter audit against filters applied one after the other."""

from collections import Counter
from itertools import permutations

import numpy as np

from marquee.llm import filter_audit as A

from .helpers import CLASH, SF, SPACE_WORD, edge_texts

FIELDS = ["part", "filter_order", "step", *A.FIGURES]


def brute(docs, labels):
    good, toxic = {d for d, q, _ in labels if q == 1} - {None}, {d for d, _, t in labels if t == 1} - {None}
    least = {}
    for d, text, _ in docs:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    rows = []
    for d, text, source in docs:
        x = text or ""
        w = SPACE_WORD.findall(x)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in x) > 2 * len(x),
                 "D": any(c in "#$%&*|" for c in x), "E": d is not None and d > least[x]}
        rows.append((source or "", {k for k, v in fails.items() if v}, d))
    out, removed = {}, Counter()
    for part in {r[0] for r in rows}:
        for order in map("".join, permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, x in enumerate(order, 1):
                lost = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                removed[part, x] += len(lost)
                out[part, order, step] = [len(left), len(lost), sum(x in r[1] for r in gone), sum(r[1] == {x} for r in rows if r[0] == part),
                                          sum(r[2] in good for r in lost), sum(r[2] in toxic for r in lost)]
                gone += lost
    return sorted((*k, *v, removed[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def run(spark, docs, labels, extra=False):
    from pyspark.sql import functions as F
    d = spark.createDataFrame(docs, "doc_id long, text string, source string")
    if extra:
        d = d.select("*", *[F.lit("x").alias(c) for c in [*CLASH, "part", "fails", "n", "good", "quality", "is_first"]])
    got = A.audit(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    return sorted(tuple(r[c] for c in FIELDS) for r in got.collect())


def test_edges(spark):
    many = " ".join(f"w{i}" for i in range(250))
    texts = [*edge_texts(), many, many, many + " $5", many.upper(), "same " * 300, "A#" * 40]
    docs = [(i, t, ["a", "b", None, ""][i % 4]) for i, t in enumerate(texts)]
    docs += [(3, "a", "a")] * 2 + [(None, many, "a"), (None, None, "b"), (2, many, "b")] + [(900 + i % 3, "copy", "hot") for i in range(30)]
    labels = [(0, 1, 0), (1, None, 1), (12, 1, 1), (12, 0, 0), (13, 1, 1), (900, 1, None), (5000, 1, 1), (None, 1, 1)]
    assert run(spark, docs, labels, extra=True) == brute(docs, labels)


def test_small_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert run(spark, docs, labels) == brute(docs, labels)


def test_empty(spark):
    assert run(spark, [], []) == []


def test_contraction_selects_along_each_axis():
    rng = np.random.default_rng(3)
    cells = rng.integers(0, 1 << 40, (2, *[2] * 5))
    t = A.contract(cells)
    assert t[1, A.PASS, A.FAIL, A.ALL, A.ALL, A.PASS] == cells[1, 0, 1, :, :, 0].sum()
    assert (t[:, 2, 2, 2, 2, 2] == cells.sum(axis=(1, 2, 3, 4, 5))).all()
