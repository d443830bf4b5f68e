"""Quality classifier: a generalised additive model with pairwise interactions.

Whole texts become a row of measures, and measures become bins.  Boosting goes
round the measures in turn: a tree of three leaves over the bins of one measure
is fitted to what is left of the loss and added, shrunk, to that measure's
lookup table.  Then the pairs of measures that explain most of the rest get
tables of their own, from trees of four leaves.  A score is the logistic of the
added table entries of a text's bins.

Fitting uses labelled rows of a bounded sample: at most about `SAMPLE_ROWS`,
chosen by the hash of their id.  Scoring covers all rows.

Defined cases: a null text is scored as an empty one.  Labels that are null are
left out; of several labels of a document each counts.  Without labels of both
kinds the score is the share of label 1, or a half without any.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptsieve.llm.texts import column, in_arrow

SAMPLE_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 250
PAIR_ROUNDS = 60
RATE = 0.1
PRIOR_WEIGHT = 2.0
THRESHOLD = 0.3

MEASURES = (
    "log_bytes", "letters", "upper", "digits", "spaces", "newlines", "marks", "signs", "bars",
    "exclamations", "word_length", "distinct_words", "sign_words", "distinct_lines", "line_length",
    "longest_word", "initials", "repeats",
)

# Byte classes: 0 other, 1 lower-case letters and all beyond ASCII, 2 upper
# case, 3 digits, 4 space and tab, 5 line ends, 6 common marks, 7 other signs,
# 8 the bar, 9 the exclamation mark.
_CLASSES = np.zeros(256, dtype=np.int64)
_CLASSES[list(b"abcdefghijklmnopqrstuvwxyz")] = 1
_CLASSES[128:] = 1
_CLASSES[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 2
_CLASSES[list(b"0123456789")] = 3
_CLASSES[list(b" \t")] = 4
_CLASSES[list(b"\r\n")] = 5
_CLASSES[list(b".,;:?'\"()-")] = 6
_CLASSES[list(b"#$%&*+/<=>@[\\]^_`{}~")] = 7
_CLASSES[list(b"|")] = 8
_CLASSES[list(b"!")] = 9
_SIGNS = b"#$%&*+/<=>@[\\]^_`{}~|!"


def measures(texts: list[bytes | None]) -> np.ndarray:
    """A row of `MEASURES` per text."""
    texts = [t or b"" for t in texts]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    classes = _CLASSES[np.frombuffer(b"".join(texts), dtype=np.uint8)]
    of = np.repeat(np.arange(len(texts)) * 10, sizes)
    counts = np.bincount(of + classes, minlength=len(texts) * 10).reshape(-1, 10).astype(np.float64)
    total = np.maximum(sizes, 1)
    share = counts / total[:, None]
    letters = counts[:, 1] + counts[:, 2]
    rest = np.zeros((len(texts), 8))
    for i, text in enumerate(texts):
        words, lines = text.split(), text.split(b"\n")
        n = max(1, len(words))
        rest[i] = (
            sum(map(len, words)) / n,
            len(set(words)) / n**0.8,
            sum(w[-1] in _SIGNS for w in words) / n,
            len(set(lines)) / len(lines),
            np.log1p(len(text) / len(lines)),
            np.log1p(max(map(len, words), default=0)),
            sum(65 <= w[0] <= 90 for w in words) / n,
            sum(map(eq, words, words[1:])) / n,
        )
    return np.column_stack(
        [
            np.log1p(sizes), letters / total, counts[:, 2] / np.maximum(letters, 1), share[:, 3], share[:, 4], share[:, 5],
            share[:, 6], share[:, 7], share[:, 8], share[:, 9], rest,
        ]
    )


@dataclass
class Model:
    """Bin edges and lookup tables; `pairs` names the measures of pair tables."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, rows: np.ndarray) -> np.ndarray:
        logit = np.full(len(rows), self.base)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            logit += table[np.searchsorted(edges, rows[:, f], side="right")]
        if self.pairs:
            coarse = _binned(rows, self.pair_edges)
            for (a, b), table in zip(self.pairs, self.pair_tables):
                logit += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts at quantiles, and evenly over the range for what is rare."""
    even = np.linspace(values.min(), values.max(), bins // 4 + 1)[1:]
    return np.unique(np.concatenate([np.quantile(values, np.arange(1, bins) / bins), even]))


def _binned(rows: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
    return [np.searchsorted(e, rows[:, f], side="right") for f, e in enumerate(edges)]


def _gain(g, h):
    return g * g / (h + PRIOR_WEIGHT)


def _line_tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Values per bin of the tree that is grown split by split over the bins."""
    parts = [(0, len(g))]
    for _ in range(leaves - 1):
        best = (1e-9, None, 0)
        for part in parts:
            low, high = part
            if high - low < 2:
                continue
            gs, hs = np.cumsum(g[low:high]), np.cumsum(h[low:high])
            gains = _gain(gs[:-1], hs[:-1]) + _gain(gs[-1] - gs[:-1], hs[-1] - hs[:-1]) - _gain(gs[-1], hs[-1])
            cut = int(np.argmax(gains))
            best = max(best, (float(gains[cut]), part, low + cut + 1), key=lambda b: b[0])
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    values = np.zeros(len(g))
    for low, high in parts:
        values[low:high] = g[low:high].sum() / (h[low:high].sum() + PRIOR_WEIGHT)
    return values


def _square_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, values) of the best cut of both axes of a table of bins."""
    gc, hc = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def quarters(c):
        top, side, all_ = c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        a = c[:-1, :-1]
        return a, top - a, side - a, all_ - top - side + a

    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    parts = list(zip(quarters(gc), quarters(hc)))
    gains = sum(_gain(a, b) for a, b in parts) - _gain(gc[-1, -1], hc[-1, -1])
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    leaf = [a[i, j] / (b[i, j] + PRIOR_WEIGHT) for a, b in parts]
    values = np.empty(g.shape)
    values[: i + 1, : j + 1], values[: i + 1, j + 1 :], values[i + 1 :, : j + 1], values[i + 1 :, j + 1 :] = leaf
    return float(gains[i, j]), values


def fit(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Boost until the loss on every fifth row stops falling."""
    n_measures = rows.shape[1]
    if len(labels) == 0 or labels.min() == labels.max():
        share = float(np.clip(labels.mean(), 0.01, 0.99)) if len(labels) else 0.5
        return Model(float(np.log(share / (1 - share))), [np.empty(0)] * n_measures, [np.zeros(1)] * n_measures, [], [], [])
    edges = [_edges(rows[:, f], BINS) for f in range(n_measures)]
    bins = _binned(rows, edges)
    pair_edges = [_edges(rows[:, f], PAIR_BINS) for f in range(n_measures)]
    coarse = _binned(rows, pair_edges)
    share = np.clip(labels.mean(), 0.001, 0.999)
    base = float(np.log(share / (1 - share)))
    checked = np.arange(len(labels)) % 5 == 4
    weight = (~checked).astype(np.float64)
    tables = [np.zeros(len(e) + 1) for e in edges]
    logit = np.full(len(labels), base)

    def slopes():
        p = 1 / (1 + np.exp(-logit))
        return (labels - p) * weight, p * (1 - p) * weight

    def loss():
        return float(np.mean(np.logaddexp(0, np.where(labels[checked] > 0, -1, 1) * logit[checked]))) if checked.any() else 0.0

    best, since, kept = loss(), 0, [t.copy() for t in tables]
    for _ in range(ROUNDS):
        for f, table in enumerate(tables):
            g, h = slopes()
            step = RATE * _line_tree(np.bincount(bins[f], g, len(table)), np.bincount(bins[f], h, len(table)))
            table += step
            logit += step[bins[f]]
        now = loss()
        best, since, kept = (now, 0, [t.copy() for t in tables]) if now < best - 1e-6 else (best, since + 1, kept)
        if since >= 15:
            break
    tables = kept
    logit = base + sum(t[b] for t, b in zip(tables, bins))

    def histogram(a, b):
        shape = (len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)
        key, (g, h) = coarse[a] * shape[1] + coarse[b], slopes()
        return tuple(np.bincount(key, x, shape[0] * shape[1]).reshape(shape) for x in (g, h))

    ranked = sorted(combinations(range(n_measures), 2), key=lambda ab: -_square_tree(*histogram(*ab))[0])
    pairs = ranked[:PAIRS]
    pair_tables = [np.zeros((len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)) for a, b in pairs]
    best, since, kept = loss(), 0, [t.copy() for t in pair_tables]
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in zip(pairs, pair_tables):
            step = RATE * _square_tree(*histogram(a, b))[1]
            table += step
            logit += step[coarse[a], coarse[b]]
        now = loss()
        best, since, kept = (now, 0, [t.copy() for t in pair_tables]) if now < best - 1e-6 else (best, since + 1, kept)
        if since >= 10:
            break
    return Model(base, edges, tables, pairs, pair_edges, kept)


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label") -> Model:
    """A model of rows with an id, a text and a label, which must be few."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = measures(batch.column(2).cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(rows), pa.list_(pa.float64()))], names=["id", "label", "row"]
            )

    rows = in_arrow(
        labelled.select(column(id_col).cast("long").alias("id"), column(label_col).cast("double").alias("label"), column(text_col)),
        job, "id long, label double, row array<double>",
    )
    # The sample is bounded, and a row of it is a few numbers.
    found = sorted((r.id, r.label, r.row) for r in rows.collect())
    return fit(np.array([r[2] for r in found]).reshape(-1, len(MEASURES)), np.array([r[1] for r in found]))


def held_out(id_col: str = "doc_id") -> F.Column:
    """Rows that fitting never sees: every fifth by the checksum of their id."""
    return F.coalesce(F.crc32(column(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, text, label) of a bounded sample of the labelled documents that
    are not held out."""
    known = labels.where(F.col(label_col).isNotNull() & ~held_out()).select("doc_id", F.col(label_col).alias("label"))
    n = known.count()
    if n > rows:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(n)) < rows)
    # About `rows` rows of two numbers.
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.score(measures(batch.column(2).cast(pa.binary()).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(column(id_col).cast("long"), held_out(id_col), column(text_col))
    return in_arrow(rows, job, "doc_id long, held_out boolean, score double, predicted int")


def keep(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that are predicted to be of quality, all columns."""
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.score(measures(batch.column(place).cast(pa.binary()).to_pylist()))
            yield batch.filter(pa.array(found >= threshold))

    return in_arrow(docs, job, docs.schema)
