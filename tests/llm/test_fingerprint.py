import hashlib

import numpy as np
import pyarrow as pa

from marquee.llm import fingerprint as P
from marquee.llm import kernels as K

from .helpers import SF, docs, edge_texts


def slow_ends(data):
    """Chunk ends byte by byte."""
    out, s = [], 0
    for i in range(len(data)):
        d = i + 1 - s
        if d < P.LEAST:
            continue
        h = sum(int(P.GEAR[data[i - j]]) << j for j in range(16)) & 0xFFFF
        strong, weak = h >> (16 - P.HARD_BITS) == 0, h >> (16 - P.EASY_BITS) == 0
        if strong or weak and d >= P.NORMAL or d == P.MOST:
            out.append(i + 1)
            s = i + 1
    return out + ([len(data)] if s < len(data) else [])


def sets(texts):
    return P.chunk_sets(pa.array(texts, pa.string()), K.Powers())


def test_chunks_against_bytewise():
    rng = np.random.default_rng(1)
    texts = ["".join(chr(97 + c) for c in rng.integers(0, 6, n)) for n in (0, 1, 15, 16, 17, 127, 128, 129, 2000)] + ["a" * 1000, "é語" * 300]
    data, off = K.utf8_column(pa.array(texts))
    for d, e in enumerate(P.chunk_ends(data, off)):
        assert [x - int(off[d]) for x in e] == slow_ends(texts[d].encode())


def test_shift_resistance_and_round_trip():
    rng = np.random.default_rng(2)
    text = "".join(chr(97 + c) for c in rng.integers(0, 20, 8000))
    a, b, c = sets([text, "inserted " + text, text[:4000]])
    assert P.containment(a, b) > 0.97 and P.containment(c, a) > 0.97 and 0.4 < P.containment(a, c) < 0.6
    assert (P.decode(P.encode(a)) == a).all() and P.encode(a[:0]) == "" and len(P.decode("")) == 0


def expect(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    out = []
    for i, (d, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        edited = t[: len(t) - len(t) // 4] + nxt[: len(t) // 4]
        own, new, follow = sets([t, edited, nxt])
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), P.encode(own), P.encode(new), P.containment(own, new), P.containment(own, follow)))
    return sorted(out, key=repr)


def test_compare_with_next_on_real_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted((tuple(r) for r in P.compare_with_next(df, 7).collect()), key=repr)
    assert got == expect([(r.doc_id, r.text) for r in df.collect()])


def test_edges(spark):
    rows = [(None, None), (None, "no id " * 20), (3, "twice " * 30), (3, "twice " * 30), (3, "Another " * 9), (1 << 62, "big id"), *((100 + i, t) for i, t in enumerate(edge_texts()))]
    got = sorted((tuple(r) for r in P.compare_with_next(docs(spark, rows, extra=True), 4).collect()), key=repr)
    assert got == expect(rows)
    one = P.compare_with_next(docs(spark, ["only one text, which follows itself"])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert P.compare_with_next(docs(spark, [])).collect() == []


def test_fingerprints_keep_the_table(spark):
    df = docs(spark, edge_texts(), extra=True)
    rows = P.fingerprints(df).collect()
    assert set(rows[0].asDict()) == set(df.columns)
    by = {}
    for r in rows:
        by.setdefault(r.text or "", set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by.values()) and by[""] == {""}
