"""Token files: exact round trips, and words against the tokenizer itself."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from promptsieve.llm import token_files, units
from promptsieve.llm.queries import WORD_TOKENIZER, vocabulary

PATH = vocabulary(WORD_TOKENIZER)
TOKENIZER = Tokenizer.from_file(PATH)
KNOWN = units.Words(token_files.read_tokenizer(PATH))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40) | st.integers(0, 5000), max_size=1500), st.integers(13, 20))
def test_pack_and_unpack(values, limit):
    ids = np.array(values, dtype=np.int64)
    counts = np.bincount(ids, minlength=1) if len(ids) else np.zeros(1, dtype=np.int64)
    lengths = token_files.code_lengths(counts, limit)
    used = lengths[lengths > 0]
    assert used.max(initial=0) <= limit and (used == 0).sum() == 0 and sum(2.0**-used) <= 1
    if not len(ids):
        return
    bits, starts = token_files.pack(ids, token_files.canonical(lengths), lengths)
    table, width = token_files.decoding_table(lengths)
    back = token_files.unpack(bits, starts[:: token_files.CHECKPOINT], len(ids), table, width)
    assert back.tolist() == values


def test_code_is_optimal_and_limited():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144])
    free, short = token_files.code_lengths(counts, 20), token_files.code_lengths(counts, 5)
    assert free.tolist() == [11, 11, 10, 9, 8, 7, 6, 5, 4, 3, 2, 1]
    assert short.max() == 5 and sum(2.0**-short) <= 1


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("abzAZ09'’.,!?<|>éÉßÀ×ª \t\n\x1c\x85\xa0́ΣİS's<|endoftext|>", max_size=60))
def test_words_like_the_tokenizer(text):
    coded = text.encode("utf-8", "replace")
    assert np.frombuffer(KNOWN.encode(coded), dtype="<u4").tolist() == TOKENIZER.encode(coded.decode(), add_special_tokens=False).ids


TEXTS = st.text(max_size=60) | st.text("abzAZ09'’.,!?<|>éÉßÀ×ª \t\n\x1c\x85\xa0́ΣİS's<|endoftext|>", max_size=60)


@pytest.mark.parametrize("kept", [800_000, 5])
@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | TEXTS | st.just("ab " * 40 + "x" * 99 + " <|endoftext|>. End"), max_size=12))
def test_batches_like_the_tokenizer(kept, texts):
    texts = [t if t is None else t.encode("utf-8", "replace").decode() for t in texts]
    with pytest.MonkeyPatch.context() as patch:
        for name in ("WORDS_KEPT", "PIECES_KEPT", "LEARNT_AT_ONCE"):
            patch.setattr(units, name, kept)
        flat, ends = KNOWN.encode_all(pa.array(["cut off", *texts], pa.string()).slice(1))
    want = [TOKENIZER.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ends.tolist() == np.cumsum([len(w) for w in want], dtype=int).tolist()
    assert flat.tolist() == [i for w in want for i in w]


def test_a_batch_looks_up_each_distinct_word_once():
    class Counted(units.Words):
        looked_up = missed = 0

        def __getitem__(self, word):
            self.looked_up += 1
            return super().__getitem__(word)

        def __missing__(self, word):
            self.missed += 1
            return super().__missing__(word)

    known = Counted(token_files.read_tokenizer(PATH))
    flat, ends = known.encode_all(pa.array(["One two, three's größe one"] * 500))
    assert (known.looked_up, known.missed) == (5, 0)
    assert flat.tolist() == 500 * TOKENIZER.encode("One two, three's größe one").ids
    assert ends.tolist() == (np.arange(1, 501) * (len(flat) // 500)).tolist()


def brute(df):
    start, out = 0, []
    rows = sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for doc_id, text in rows:
        ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def round_trip(spark, df, path):
    token_files.write(df, path, PATH, end_id=1)
    return [tuple(r) for r in token_files.digests(spark, path).orderBy("start").select("doc_id", "start", "n_tokens", "ids_crc32").collect()]


def test_documents_in_any_order(spark, documents, tmp_path):
    want = brute(documents)
    assert round_trip(spark, documents, f"{tmp_path}/a") == want
    assert round_trip(spark, documents.repartition(6, F.xxhash64("text")), f"{tmp_path}/b") == want


def test_odd_rows(spark, odd, tmp_path):
    got, want = round_trip(spark, odd.repartition(3), f"{tmp_path}/a"), brute(odd)
    strip = lambda rows: sorted(((r[0], *r[2:]) for r in rows), key=repr)
    assert strip(got) == strip(want)  # rows with one id may be in any order
    assert [g[1] for g in got] == np.cumsum([0, *(g[2] for g in got)])[:-1].tolist()
    assert round_trip(spark, odd.limit(0), f"{tmp_path}/b") == []


def test_an_id_repeated_over_files(spark, tmp_path):
    long = spark.createDataFrame([(i, "one two three") for i in range(5, 10)], "doc_id long, text string").coalesce(1)
    short = spark.createDataFrame([(5, "four five")], "doc_id long, text string").coalesce(1)
    for n, df in enumerate((long.union(short), short.union(long))):
        token_files.write(df, str(tmp_path / str(n)), PATH, end_id=1)
        rows = sorted((r.start, r.n_tokens, r.doc_id) for r in token_files.digests(spark, str(tmp_path / str(n))).collect())
        assert [r[2] for r in rows] == [5, 5, 6, 7, 8, 9]
        assert all(a[0] + a[1] == b[0] for a, b in zip(rows, rows[1:]))
