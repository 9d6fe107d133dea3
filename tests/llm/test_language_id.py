import zlib

import numpy as np

from marquee.llm import language_id as L

from .helpers import SF, docs, edge_texts


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in df.collect()}
    rows = L.identify(df).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {d for d in lang if zlib.crc32(str(d).encode()) % 4 == 2}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_rows_are_not_used(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    wrong = df.withColumn("lang", L.F.when(L.held_out(L.F.col("doc_id")), "xx").otherwise(L.F.col("lang")))
    assert sorted(map(tuple, L.identify(df).drop("mixture").collect())) == sorted(map(tuple, L.identify(wrong).drop("mixture").collect()))


def test_mixture_of_two_languages(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    by = {r.lang: r.text for r in df.orderBy("n_chars").collect()}
    model = L.train(df)
    text = by["en"][:1500] + " " + by["de"][:1500]
    got = L.predict(docs(spark, [text, by["en"], by["fr"]]), model, ["doc_id"]).orderBy("doc_id").collect()
    assert {m.lang for m in got[0].mixture} == {"en", "de"} and 0.3 < got[0].score < 0.7
    assert [m.lang for m in got[1].mixture] == ["en"] and got[2].lang_pred == "fr"


def counted(owner, bucket):
    key, n = np.unique(owner * L.BUCKETS + bucket, return_counts=True)
    return key // L.BUCKETS, key % L.BUCKETS, n


def test_inference_against_plain_em():
    """Each text alone, every subset of its likeliest languages, unpruned."""
    rng = np.random.default_rng(4)
    p = rng.dirichlet(np.full(L.BUCKETS, 0.02), 3).T
    log_p = np.log(p + 1e-9).astype(np.float32)
    mixes = [(1, 0, 0), (0.5, 0.5, 0), (0, 0.2, 0.8), (0.3, 0.3, 0.4)]
    owner, bucket = [], []
    for d, m in enumerate(mixes):
        for k, share in enumerate(m):
            take = rng.choice(L.BUCKETS, int(600 * share), p=p[:, k])
            owner += [d] * len(take)
            bucket += take.tolist()
    order = np.argsort(owner, kind="stable")
    got = L.infer(*counted(np.array(owner)[order], np.array(bucket)[order]), len(mixes), log_p)
    assert np.abs(got - np.array(mixes)).max() < 0.06
    for d in range(len(mixes)):
        alone = L.infer(*counted(np.zeros(owner.count(d), dtype=np.int64), np.array([b for o, b in zip(owner, bucket) if o == d])), 1, log_p)
        assert np.allclose(alone[0], got[d])


def test_edges(spark):
    texts = edge_texts() + ["123 456 !!", "٣٤٥", "語語語"]
    df = docs(spark, texts, extra=True)
    rows = {r.doc_id: r for r in L.identify(df).collect()}
    for i, t in enumerate(texts):
        if not any(c.isalpha() for c in t or ""):
            assert (rows[i].lang_pred, rows[i].score, rows[i].mixture) == ("und", 0.0, [])
        else:
            assert rows[i].lang_pred == "en" and rows[i].score > 0.99
    none = df.withColumn("lang", L.F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.identify(none).collect()} == {"und"}
    assert L.identify(docs(spark, [])).collect() == []
    nulls = L.identify(docs(spark, [(None, "words in a text"), (None, "words in a text"), (1, "other words")])).collect()
    assert [r.held_out for r in nulls if r.doc_id is None] == [False, False]
    kept = L.reject_unknown(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, t in enumerate(texts) if any(c.isalpha() for c in t or "")}


def test_rejects_texts_of_no_learned_language(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = np.random.default_rng(5)
    junk = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz    "), 400)) for _ in range(20)]
    by = {}
    for r in df.where("doc_id >= 0").orderBy("doc_id").collect():
        if len(r.text) >= 1000:
            by.setdefault(r.lang, []).append(r.text)
    even = [" ".join(by[x][k][:1000] for x in sorted(by)) for k in range(20)]
    both = [by["en"][k][:1000] + " " + by["de"][k][:1000] for k in range(20)]

    def table(first, texts, lang):
        rows = spark.createDataFrame([(first + i, t, lang, "s0", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
        return rows.select(*df.columns)

    planted = df.unionByName(table(10**6, junk, None)).unionByName(table(2 * 10**6, junk, "en")).unionByName(table(3 * 10**6, even, None)).unionByName(table(4 * 10**6, both, None))
    kept = [r.doc_id // 10**6 for r in L.reject_unknown(planted).collect()]
    # gibberish goes, labelled or not, and so do most texts in four even parts; two languages and all documents stay
    assert [kept.count(k) for k in (0, 1, 2, 4)] == [df.count(), 0, 0, 20] and kept.count(3) < 10
    # a language without labels is not learned
    es = df.withColumn("lang", L.F.when(L.F.col("lang") != "es", L.F.col("lang")))
    left = [r.lang for r in L.reject_unknown(es).collect()]
    assert left.count(None) <= 0.2 * df.where("lang = 'es'").count() and len(left) - left.count(None) >= 0.995 * df.where("lang != 'es'").count()


def test_columns_named_like_added_ones(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted(r.doc_id for r in L.reject_unknown(df).collect())
    for name in ("score", "Score", "mixture", "lang_pred"):
        named = df.withColumn(name, L.F.lit("mine"))
        kept = L.reject_unknown(named)
        assert kept.columns == named.columns and sorted(r.doc_id for r in kept.collect()) == want
        assert {r[name] for r in kept.collect()} == {"mine"}
        got = L.predict(named, L.train(df), ["doc_id", name])
        assert got.columns == ["doc_id", "lang_pred", "score", "mixture"] and got.where("lang_pred = 'mine'").isEmpty()


def test_long_texts_are_counted_whole(monkeypatch):
    rng = np.random.default_rng(8)
    text = np.frombuffer("".join(rng.choice(list("ab é z1.\n"), 3000)).encode(), dtype=np.uint8)
    off, table = np.array([0, len(text)]), L._letters()
    owner, bucket = L.grams(text, off, table)
    want = np.bincount(bucket, minlength=L.BUCKETS)
    monkeypatch.setattr(L, "CHUNK_BYTES", 97)
    _, got, n = L.counted_grams(text, off, table)
    assert (want[got] == n).all() and n.sum() == want.sum()


def test_many_labels(spark, monkeypatch):
    """600 labels; five languages in a text, which no bound on the set forbids."""
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 9)) for _ in range(1800)]
    rows = [(i, " ".join(rng.choice(words[3 * k: 3 * k + 3], 60)), f"l{k:03}") for k in range(600) for i in (4 * k, 4 * k + 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(df)
    assert len(model.langs) == 600
    mixed = [" ".join(words[3 * k + w] for k in (5, 80, 200, 311, 590) for w in (0, 1, 2) for _ in range(40)), rows[40][1]]
    got = L.predict(docs(spark, mixed), model, ["doc_id"]).orderBy("doc_id").collect()
    assert {m.lang for m in got[0].mixture} == {"l005", "l080", "l200", "l311", "l590"}
    assert got[1].lang_pred == rows[40][2]
    monkeypatch.setattr(L, "MODEL_BYTES", 500 * 4 * L.BUCKETS)
    try:
        L.train(df)
        raise AssertionError("600 labels in a model for 500")
    except ValueError as e:
        assert "500 languages" in str(e)
