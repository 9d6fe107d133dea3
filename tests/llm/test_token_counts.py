import os

import pytest
import regex

from marquee.llm import token_counts as T

from .helpers import SF, docs, edge_texts

pytestmark = pytest.mark.skipif(not os.path.exists(T.VOCABULARY), reason="no vocabulary file")


def pieces(word, scores):
    """Plain Viterbi of one pre-token."""
    w = word.encode()
    best = [(0.0, 0)]
    for e in range(1, len(w) + 1):
        best.append(max(((best[s][0] + scores[w[s:e]], best[s][1] - 1) for s in range(max(0, e - 130), e) if w[s:e] in scores)))
    return -best[-1][1]


def test_counts_against_plain_viterbi(spark):
    scores, cut, memo = T.read_scores(), regex.compile(T.PATTERN), {}
    df = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in T.count_tokens(df, scores, ["doc_id"]).collect():
        words = cut.findall(texts[r.doc_id] or "")
        for w in words:
            if w not in memo:
                memo[w] = pieces(w, scores)
        assert (r.n_pretokens, r.n_tokens) == (len(words), sum(memo[w] for w in words))


def test_library_model_agrees():
    """The same scores in the tokenizers library's unigram model."""
    from tokenizers import models
    scores = {p: s for p, s in T.read_scores().items() if all(32 < b < 127 for b in p)}
    names = [p.decode() for p in scores]
    model = models.Unigram([(n, s) for n, s in zip(names, scores.values())], None, False)
    trie = T.UnigramTrie(scores)
    words = ["tokenization", "interesting", "international", "unigram", "zzzzq", "Spark", "interest", "x" * 40]
    trie.insert(words)
    for w in words:
        assert trie.counts[w] == len(model.tokenize(w))


def test_shared_prefixes_are_scored_once():
    trie = T.UnigramTrie(T.read_scores())
    trie.insert(["international", "internal", "internally", "inter"])
    assert trie.nodes == len("international") + len("l") + len("ly")  # after "interna"; "inter" is a node already
    trie.insert(["inter", "internal"])
    assert trie.nodes == 16


def test_edges(spark):
    scores = T.read_scores()
    rows = T.count_tokens(docs(spark, edge_texts() + ["q" * 200_000], extra=True), scores, ["doc_id", "text", "n_tokens", "block"]).collect()
    assert len(rows) == 13
    for r in rows:
        assert (r.n_tokens == 0) == (not r.text)
    same = [r.n_tokens for r in rows if r.text == "Same Text here today"]
    assert len(same) == 2 and same[0] == same[1] > 0
    assert T.count_tokens(docs(spark, []), scores, ["doc_id"]).collect() == []


def test_vocabulary_needs_all_bytes(tmp_path):
    (tmp_path / "v").write_text("YQ== 0\n")
    with pytest.raises(ValueError):
        T.read_scores(str(tmp_path / "v"))
