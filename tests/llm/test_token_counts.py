"""Token counts against a plain Viterbi search per word."""

import pytest

from promptsieve.llm import token_counts
from promptsieve.llm.queries import PIECE_VOCABULARY, vocabulary


def brute(word, scores, byte_score):
    text = "▁" + word
    best = [(0.0, 0)]
    for end in range(1, len(text) + 1):
        spelt = len(text[end - 1].encode())
        options = [(best[end - 1][0] + spelt * byte_score, best[end - 1][1] - spelt)]
        for begin in range(end):
            if text[begin:end] in scores:
                options.append((best[begin][0] + scores[text[begin:end]], best[begin][1] - 1))
        best.append(max(options))
    return best[-1][0], -best[-1][1]


def check(df):
    scores = token_counts.unigram_scores(vocabulary(PIECE_VOCABULARY))
    byte_score = min(scores.values()) - token_counts.BYTE_PENALTY
    known = {}
    got = sorted(((r.doc_id, r.n_words, r.n_tokens, round(r.score, 3)) for r in token_counts.token_counts(df, vocabulary(PIECE_VOCABULARY)).collect()), key=repr)
    want = []
    for r in df.select("doc_id", "text").collect():
        words = [w.decode() for w in (r.text or "").encode().split()]
        for w in words:
            known.setdefault(w, brute(w, scores, byte_score) if len(w) < 200 else None)
        if any(known[w] is None for w in words):
            got = [g for g in got if g[0] != r.doc_id]
            continue
        want.append((r.doc_id, len(words), sum(known[w][1] for w in words), round(sum(known[w][0] for w in words), 3)))
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want, key=repr)]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in sorted(want, key=repr)])


def test_odd_rows(odd):
    check(odd)


def test_documents(documents):
    check(documents)


def test_prefixes_are_scored_once():
    trie = token_counts.Trie({"▁": -1.0, "ab": -2.0, "abc": -2.5, "a": -3.0, "b": -3.0, "c": -1.0})
    trie.insert(b"abc")
    nodes = len(trie.forward)
    trie.insert(b"abd")
    assert len(trie.forward) == nodes + 1
    assert trie.tokens[trie.ends[b"abc"]] == 2


def test_long_words_are_scored_like_short_ones(monkeypatch):
    scores = token_counts.unigram_scores(vocabulary(PIECE_VOCABULARY))
    byte_score = min(scores.values()) - token_counts.BYTE_PENALTY
    word = "unbreakableÜberschrift東京0123" * 30
    whole = token_counts.Trie(scores)
    kept = whole.insert(word.encode())
    monkeypatch.setattr(token_counts, "LONG_WORD", 10)
    alone = token_counts.Trie(scores)
    end = alone.insert(word.encode())
    assert len(alone.forward) == 2 and len(whole.forward) > 800
    assert (alone.forward[end], alone.tokens[end]) == (whole.forward[kept], whole.tokens[kept])
    assert (alone.forward[end], alone.tokens[end]) == brute(word, scores, byte_score)


def test_a_word_of_a_million_characters(spark):
    text = "abcdefghij" * 100_000
    row = token_counts.token_counts(spark.createDataFrame([(1, text)], "doc_id long, text string"), vocabulary(PIECE_VOCABULARY)).first()
    assert (row.doc_id, row.n_words) == (1, 1) and 100_000 <= row.n_tokens <= 1_000_000


def test_empty_table(odd):
    assert token_counts.token_counts(odd.limit(0), vocabulary(PIECE_VOCABULARY)).collect() == []
