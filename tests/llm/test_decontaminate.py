import hashlib

from marquee.llm import decontaminate as D

from .helpers import FOLD, PLAIN_WORD, SF, docs, edge_texts


def words(t):
    return PLAIN_WORD.findall((t or "").translate(FOLD))


def brute(rows, items, window=13):
    win = {}
    for item, t in items:
        w = words(t)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            win.setdefault(tuple(w[i: i + window]), set()).add("null" if item is None else str(item))
    out = []
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in win}:
            for i in range(len(w) - n + 1):
                if x := win.get(tuple(w[i: i + n])):
                    found |= x
                    hit.update(range(i, i + n))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def run(df, items, **kw):
    return sorted((tuple(r)[:6] for r in D.contamination(df, items, **kw).collect()), key=repr)


def test_real_documents_in_one_and_many_blocks(spark):
    df, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in df.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert any(x[2] for x in want)
    assert run(df, items) == want
    assert run(df, items, block_words=300) == want


ITEMS = [(1, "one two three"), (2, "a b c d e f g h i j k l m n"), (2, "word word"), (None, "Same Text"), (9, None), (10, " .,; "), (11, "x" * 1000)]


def test_edges(spark, monkeypatch):
    rows = [(None, "one TWO, three!"), (1, "one two"), (2, "three one two three one two three"), (3, "z a b c d e f g h i j k l m n z"), (3, "a b c d e f g h i j k l m"),
            *((100 + i, t) for i, t in enumerate(edge_texts()))]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    df = docs(spark, rows, extra=True)
    assert run(df, items) == brute(rows, ITEMS)
    assert run(df, items.limit(0)) == brute(rows, [])
    assert run(docs(spark, []), items) == []
    kept = D.drop_contaminated(df, items)
    assert kept.columns == df.columns
    bad = {r[0] for r in brute(rows, ITEMS) if r[5]}
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - bad


def test_clean_rows_stay_beside_contaminated_ones_of_their_id(spark):
    rows = [(None, "one TWO three"), (None, "clean words here"), (None, None), (4, "one two three four"), (4, "more clean words"), (4, "more clean words"), (5, "word word"), (5, "word word"), (6, "")]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = sorted(((r.doc_id, r.text) for r in D.drop_contaminated(docs(spark, rows), items).collect()), key=repr)
    assert kept == sorted([(None, "clean words here"), (None, None), (4, "more clean words"), (4, "more clean words"), (6, "")], key=repr)


def test_no_phrase_crosses_documents_or_segments(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(["one two", "three", "one", "two three", "one two three"])]
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    df = docs(spark, rows).coalesce(1)
    assert run(df, items) == brute(rows, ITEMS[:1])


def test_proximity(spark):
    rows = ["one x two three", "one two three", "three two one", "one", "two three", "one x x x two three"]
    index = D.build_index(docs(spark, rows).coalesce(1))
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    near = lambda slop: sorted({r.doc_id for r in D.search(index, items, slop=slop).collect()})
    assert near(0) == [1] and near(1) == [0, 1] and near(2) == [0, 1, 2, 5], [near(k) for k in range(4)]
