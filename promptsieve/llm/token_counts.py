"""Token counts under a unigram vocabulary, with prefixes shared in a trie.

A pre-token is a word with a word mark in front.  Its count is that of its most
likely segmentation into pieces of the vocabulary, found by dynamic programming
over its characters.  The distinct pre-tokens of a task are inserted into a trie:
a node stands for a prefix, and its forward score, and the number of tokens that
score takes, are computed once, when it is made, from the nodes above it.
The counts at the ends of words are kept, and a text only adds them up.

A piece's score is the logarithm of its share under Zipf's law for its rank in
the vocabulary file.  A character that no piece covers is spelt in bytes, one
token each.  Of equally likely segmentations the one with fewer tokens counts.

Defined cases: a null or blank text has no words, no tokens and score 0.  Texts
and words may be of any length: time grows with a word's length, and a long one
holds no more scores at once than the longest piece has characters.  Repeated rows
are counted each; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from promptsieve.llm.texts import column, in_arrow

# Fixed value: the mark that the vocabulary puts in front of a word.
WORD_MARK = "▁"
# A task begins a new trie when it has so many nodes or words.
NODES_KEPT = 1_000_000
# Words of more characters are scored the same way but leave no prefixes behind.
LONG_WORD = 1_000
# Bytes are this much less likely than the least likely piece.
BYTE_PENALTY = 10.0


def unigram_scores(vocabulary_path: str) -> dict[str, float]:
    """Log-probabilities of the pieces by their rank in the vocabulary file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path)
    plain = [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    whole = sum(1 / (rank + 1) for rank in range(len(plain)))
    return {piece: -math.log((rank + 1) * whole) for rank, piece in enumerate(plain)}


class Trie:
    """Prefixes of pre-tokens with their best score and number of tokens."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.byte_score = min(scores.values(), default=0.0) - BYTE_PENALTY
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.forward, self.tokens = [0.0], [0]
        self.ends: dict[bytes, int] = {}

    def insert(self, word: bytes) -> int:
        """The node at which the pre-token of `word` ends."""
        text, path, node = WORD_MARK + word.decode("utf-8", "replace"), [0], 0
        if len(text) > LONG_WORD:
            node = self.ends[word] = self._add(*self._run_through(text))
            return node
        child = self.child
        for at, character in enumerate(text):
            below = child.get((node, character))
            if below is None:
                below = child[node, character] = self._add(*self._step(text, at, path, self.forward, self.tokens))
            node = below
            path.append(node)
        self.ends[word] = node
        return node

    def _add(self, forward: float, tokens: int) -> int:
        self.forward.append(forward)
        self.tokens.append(tokens)
        return len(self.forward) - 1

    def _step(self, text: str, at: int, path: Sequence[int], forward: list[float], tokens: list[int]) -> tuple[float, int]:
        """Score and tokens of the prefix that ends with the character at `at`.
        `path` has the places of the prefixes before it, the longest one last."""
        end, piece_score = at + 1, self.scores.get
        character, parent = text[at], path[-1]
        spelt = 1 if character.isascii() else len(character.encode("utf-8", "replace"))
        best, fewest = forward[parent] + spelt * self.byte_score, tokens[parent] + spelt
        for back in range(1, min(end, self.longest) + 1):
            score = piece_score(text[end - back : end])
            if score is not None:
                before = path[-back]
                score += forward[before]
                if score > best or (score == best and tokens[before] + 1 < fewest):
                    best, fewest = score, tokens[before] + 1
        return best, fewest

    def _run_through(self, text: str) -> tuple[float, int]:
        """Score and tokens of a long word, keeping those of its last prefixes."""
        places = self.longest + 1
        forward, tokens, path = [0.0] * places, [0] * places, deque([0], self.longest)
        for at in range(len(text)):
            place = (at + 1) % places
            forward[place], tokens[place] = self._step(text, at, path, forward, tokens)
            path.append(place)
        return forward[place], tokens[place]


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_tokens and the score of the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(unigram_scores(vocabulary_path))

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(shared.value)
        for batch in batches:
            if len(trie.forward) > NODES_KEPT or len(trie.ends) > NODES_KEPT:
                trie.clear()
            split = [text.split() if text else [] for text in batch.column(1).cast(pa.binary()).to_pylist()]
            sizes = np.array([len(x) for x in split], dtype=np.int64)
            for word in set().union(*split) - trie.ends.keys():
                trie.insert(word)
            ends = trie.ends.__getitem__
            nodes = np.fromiter((n for x in split for n in map(ends, x)), dtype=np.int64, count=int(sizes.sum()))
            tokens, forward = np.array(trie.tokens)[nodes], np.array(trie.forward)[nodes]
            of = np.repeat(np.arange(len(split)), sizes)
            n_tokens = np.bincount(of, weights=tokens, minlength=len(split)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(n_tokens), pa.array(np.bincount(of, weights=forward, minlength=len(split)).astype(np.float64))],
                names=["doc_id", "n_words", "n_tokens", "score"],
            )

    return in_arrow(
        docs.select(column(id_col).cast("long"), column(text_col)), job, "doc_id long, n_words long, n_tokens long, score double"
    )
