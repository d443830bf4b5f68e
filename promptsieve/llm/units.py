"""Token ids of whole texts, with each distinct word encoded once.

The word tokenizer never lets a token cross ASCII white space: it normalises
within words, splits on white space and merges inside pieces.  The ids of a text
are therefore the ids of its words in a row, and a worker keeps the ids of the
words it has met.  Pieces of plain Latin letters, digits and ASCII signs go
straight to the tokenizer's model; any other word goes through the whole
tokenizer.

A batch of texts is cut and its words are numbered by Arrow, so that each distinct
word of the batch is looked up once; those not met before are cut into pieces
together, and the ids are put in the texts' order by Arrow again.
"""

from __future__ import annotations

import re
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# Words and pieces a worker remembers; beyond that it begins anew.
WORDS_KEPT = 800_000
PIECES_KEPT = 250_000
LONGEST_KEPT = 64
# So many words are cut into pieces together.
LEARNT_AT_ONCE = 1 << 15

# Letters that are lower-cased and composed one by one, and how
# the tokenizer cuts words made of them.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
# The same for words of a line each.
_PLAIN_LINES = re.compile(_PLAIN.pattern.replace("]+", "\n]+"))
_PIECE_OR_BREAK = re.compile(_PIECE.pattern + "|\n")
# Stands for a line break among ids, whose last byte is 0: it is not found in them.
_BREAK = b"\xff" * 4


def _byte_characters() -> dict[int, int]:
    """A printable character for every byte: itself where it is printable, the
    next free one from 256 on otherwise."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return {b: b if b in shown else next(others) for b in range(256)}


class _Pieces(dict):
    def __init__(self, model, size: int):
        self.tokenize, self.characters = model.tokenize, _byte_characters()
        self.coded = [i.to_bytes(4, "little") for i in range(size)]
        self["\n"] = _BREAK

    def __missing__(self, piece: str) -> bytes:
        spelt = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.characters)
        coded = self.coded
        ids = b"".join([coded[t.id] for t in self.tokenize(spelt)])
        if len(self) >= PIECES_KEPT:
            self.clear()
            self["\n"] = _BREAK
        self[piece] = ids
        return ids


class Words(dict):
    """UTF-8 word -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, tokenizer_json: str):
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.pieces = _Pieces(self.tokenizer.model, self.tokenizer.get_vocab_size(with_added_tokens=True))
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.marked = not any(s.isalnum() for s in self.special)

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if _PLAIN.fullmatch(text) and (self.marked and text.isalnum() or not any(s in text for s in self.special)):
            pieces = _PIECE.findall(text.lower())
            ids = self.pieces[pieces[0]] if len(pieces) == 1 else b"".join([self.pieces[p] for p in pieces])
        else:
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(word) <= LONGEST_KEPT:
            if len(self) >= WORDS_KEPT:
                self.clear()
            self[word] = ids
        return ids

    def learn(self, new: list[bytes]) -> None:
        """Keep the ids of new words, as far as they are short and plain."""
        for at in range(0, len(new), LEARNT_AT_ONCE):
            part = [w for w in new[at : at + LEARNT_AT_ONCE] if 0 < len(w) <= LONGEST_KEPT]
            lines = b"\n".join(part).decode("utf-8", "replace")
            if not self._plain(lines):
                part = [w for w, line in zip(part, lines.split("\n")) if self._plain(line)]
                lines = b"\n".join(part).decode()
            if part:
                if len(self) + len(part) > WORDS_KEPT:
                    self.clear()
                pieces = _PIECE_OR_BREAK.findall(lines.lower())
                self.update(zip(part, b"".join(map(self.pieces.__getitem__, pieces)).split(_BREAK), strict=True))

    def _plain(self, lines: str) -> bool:
        return bool(_PLAIN_LINES.fullmatch(lines)) and not any(s in lines for s in self.special)

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, where each text's end in them)."""
        # Cuts at the six ASCII white space characters, with empty words at the ends.
        cut = pc.ascii_split_whitespace(texts.fill_null(""))
        numbered = cut.flatten().dictionary_encode()
        distinct = numbered.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        self.learn(list(filterfalse(self.__contains__, distinct)))
        coded = [self[word] for word in distinct]
        ids = pa.array(coded, pa.large_binary()).take(numbered.indices)
        sizes = np.array([len(c) >> 2 for c in coded], dtype=np.int64)[numbered.indices.to_numpy()]
        ends = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(sizes)])[cut.offsets.to_numpy()[1:]]
        flat = np.frombuffer(ids.buffers()[2] or b"", dtype="<u4", count=int(sizes.sum()))
        return flat, ends

    def encode(self, text: bytes | None) -> bytes:
        # bytes.split() cuts at exactly the six ASCII white space characters.
        return b"".join(map(self.__getitem__, text.split())) if text else b""


_WORDS: dict[int, Words] = {}


def words(tokenizer_json: str) -> Words:
    """The words this worker process knows; they outlive a task."""
    key = hash(tokenizer_json)
    if key not in _WORDS:
        _WORDS.clear()
        _WORDS[key] = Words(tokenizer_json)
    return _WORDS[key]


def vocabulary_size(tokenizer_json: str) -> int:
    return Tokenizer.from_str(tokenizer_json).get_vocab_size(with_added_tokens=True)
