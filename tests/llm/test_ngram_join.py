import numpy as np
from pyspark.sql import functions as F

from marquee.llm import ngram_join as N

from .helpers import FOLD, SF, SPACE_WORD, docs, edge_texts


def shingles(text, n):
    w = SPACE_WORD.findall((text or "").translate(FOLD))
    return frozenset(tuple(w[i: i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, n=4, percent=85):
    """(doc_id, size, component) of every row, all pairs compared."""
    sets = [shingles(t, n) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    up[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def run(df, like=N.Likeness()):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in N.jaccard_components(df, like).collect()), key=repr)


def test_real_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert run(df) == brute([(r.doc_id, r.text) for r in df.collect()])


def near_copies(rng, n, words=120):
    base = [f"b{x}" for x in rng.integers(0, 10_000, words)]
    out = []
    for _ in range(n):
        w = list(base)
        for i in rng.integers(0, words, int(rng.integers(0, 9))):
            w[i] = f"e{rng.integers(0, 1000)}"
        out.append(" ".join(w))
    return out


def test_near_copies_at_every_threshold(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_TOKENS", 900)  # several blocks for a group
    rng = np.random.default_rng(7)
    passage = " ".join(f"p{i}" for i in range(30))
    texts = near_copies(rng, 60) + near_copies(rng, 25, 40) + [passage + " " + " ".join(f"u{x}" for x in rng.integers(0, 10**6, 30)) for _ in range(60)]
    texts += [" ".join(f"s{x}" for x in rng.integers(0, 3, k)) for k in rng.integers(1, 12, 60)]
    rows = list(enumerate(texts))
    for like in (N.Likeness(), N.Likeness(5, 80), N.Likeness(2, 60)):
        assert run(docs(spark, rows), like) == brute(rows, like.n, like.percent)


def test_frequent_tokens_are_salted(spark, monkeypatch):
    monkeypatch.setattr(N, "SALT_FROM", 2)
    rows = list(enumerate(near_copies(np.random.default_rng(9), 80)))
    assert run(docs(spark, rows)) == brute(rows)


def test_edges(spark):
    rows = [(None, "a null id with some words"), (None, "A null id WITH some words"), (7, "seven words are in this text here"), (7, "seven words are in this text here"),
            (7, "another text of the same id"), (2, "seven words are in this text here"), *((100 + i, t) for i, t in enumerate(edge_texts()))]
    df = docs(spark, rows, extra=True)
    assert run(df) == brute(rows)
    assert N.jaccard_components(docs(spark, [])).collect() == []
    kept = N.keep_one(df).collect()
    assert set(kept[0].asDict()) == set(df.columns)
    # rows that stand for nothing smaller stay, once; texts without words all stay
    assert sorted(r.doc_id for r in kept if r.doc_id is not None and r.doc_id < 100) == [2, 7]
    assert [r.text for r in kept if r.doc_id == 7] == ["another text of the same id"]
    assert {100, 101, 102} <= {r.doc_id for r in kept} and {104} == {104, 105, 106} & {r.doc_id for r in kept}


def test_keeps_one_row_of_each_group_without_or_with_repeated_ids(spark):
    a, b, c = [" ".join(f"{x}{i}" for i in range(60)) for x in "abc"]
    rows = [(None, a), (None, a + " more"), (None, a), (5, b), (5, b + " more"), (5, b), (None, b), (6, b), (7, c), (None, c + " more"), (None, None), (None, ""), (None, "")]
    kept = N.keep_one(docs(spark, rows)).collect()
    assert sorted(((r.text or "-")[0], r.doc_id is None) for r in kept) == [("-", True)] * 3 + [("a", True), ("b", False), ("c", False)]
    assert {r.doc_id for r in kept} == {None, 5, 7}


def test_components_of_a_path(spark):
    edges = spark.range(200).select((F.col("id") * 7 % 201).alias("a"), ((F.col("id") + 1) * 7 % 201).alias("b"))
    assert {r.label for r in N.components(edges).collect()} == {0}
    assert N.components(edges.limit(0)).collect() == []
