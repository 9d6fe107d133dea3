"""Encoding and decoding against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from marquee.llm import bpe

from .helpers import SF, docs, edge_texts

PARTS = ["'", "s", "'s", "'re", "'ve", "'ll", "'t", "'m", "'d", "''s", " ", "\n", "A", "Σ", "ς", "é", "é", "İ", "ß", "1", "٣", "½", "!", "<|endoftext|>", "<|startoftext|>", "<|", "語",
         "한", "\x1c", "\x85", " ", "🙂", "‍", "ﬁ", "Ω", "\x00", "퟿", "￿", "Ᲊ", "Ɤ", "\U00010d40", "wordle", "THE", "antidisestablishment"]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary()


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(bpe.VOCABULARY)
    t.no_padding()
    t.no_truncation()
    return t


def lexicon(vocabulary, words):
    return bpe.Lexicon.build((w, bpe.merge_word(w, vocabulary)) for w in {x.encode() for x in words})


def test_table_equals_library(spark, vocabulary, library):
    from marquee.llm.queries import QUERIES
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op12_bpe"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert got[r.doc_id] == (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_edges_equal_library(spark, vocabulary, library):
    texts = [*edge_texts(), "x" * 5000, "ab" * 3000 + "'s", "<|endoftext|>", "a<|startoftext|>'S<|endoftext", "'" * 200, "語" * 700]
    rows = bpe.encode(docs(spark, texts, extra=True).withColumnRenamed("n_chars", "ids"), vocabulary, ["doc_id", "key", "ids", "n_tokens"])
    assert rows.columns == ["doc_id", "key", "ids", "n_tokens"]
    got = {r.doc_id: r for r in bpe.decode(rows, vocabulary, ["doc_id", "ids", "n_tokens"]).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i].ids, dtype="<u4").tolist() == ids and got[i].n_tokens == len(ids)
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)


def test_empty_table(spark, vocabulary):
    rows = bpe.encode(docs(spark, []), vocabulary, ["doc_id"])
    assert bpe.decode(rows, vocabulary, ["doc_id"]).collect() == []


def test_any_signs_equal_library(vocabulary, library):
    rng = random.Random(11)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(0, 30))) for _ in range(6000)]
    encoder = bpe.Encoder(vocabulary, lexicon(vocabulary, ["the", "wordle", "é", "'s", "a", "as", "antidisestablishment"]))
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode(texts)] == want


def test_all_characters_are_cut_like_the_library(vocabulary, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::7]
    texts = [f"a{chr(c)}1" for c in points]
    encoder = bpe.Encoder(vocabulary, lexicon(vocabulary, []))
    for i in range(0, len(texts), 20_000):
        want = [e.ids for e in library.encode_batch(texts[i: i + 20_000], add_special_tokens=False)]
        assert [x.tolist() for x in encoder.encode(texts[i: i + 20_000])] == want


def test_long_texts_are_cut_at_white_space(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 50)
    text = " ".join(random.Random(2).choice(PARTS + ["running", "éx"]) for _ in range(2000))
    encoder = bpe.Encoder(vocabulary, lexicon(vocabulary, ["running"]))
    assert len(list(encoder.words.pieces([text]))) > 5
    assert encoder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_transducer_is_minimal_and_exact(vocabulary, tmp_path):
    rng = random.Random(4)
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 7))) for _ in range(400)} | {"walking", "walked", "talking", "talked"}
    table = {w.encode(): bpe.merge_word(w.encode(), vocabulary) for w in words}
    (tmp_path / "lexicon").write_bytes(bpe.Lexicon.build(table.items()).to_bytes())
    lex = bpe.Lexicon.mapped(str(tmp_path / "lexicon"))
    tries = sorted(table) + [w + b"z" for w in table] + [w[:-1] for w in table]
    data, ends = np.frombuffer(b"".join(tries), dtype=np.uint8), np.cumsum([len(w) for w in tries])
    found, word, out = lex.walk(data, np.r_[0, ends[:-1]], ends)
    got = {}
    for w, o in zip(word.tolist(), out.tolist()):
        got.setdefault(w, []).extend(lex.pool[lex.pool_at[o]: lex.pool_at[o + 1]].tolist())
    for i, w in enumerate(tries):
        assert bool(found[i]) == (w in table)
        assert tuple(got.get(i, ())) == table.get(w, ())
    # states with equal futures are one: as many as there are different sets of rests with their outputs
    rests = set()
    arcs = {}
    for k, t, o in zip(lex.keys.tolist(), lex.target.tolist(), lex.output.tolist()):
        arcs.setdefault(k >> 8, []).append((k & 255, t, o))
    for s in range(len(lex.final)):
        rests.add((int(lex.final[s]), tuple(arcs.get(s, []))))
    assert len(rests) == len(lex.final)


def test_frequent_words_are_bounded(spark, vocabulary):
    df = docs(spark, ["aa bb bb cc cc cc dd dd dd dd", "ee 한국 <|endoftext|>", None])
    assert set(bpe.frequent_words(df, vocabulary, 2)) == {b"cc", b"dd"}
    assert set(bpe.frequent_words(df, vocabulary, 100)) >= {b"aa", b"ee", b"dd"}
    assert bpe.frequent_words(df, vocabulary, 0) == []
