"""Language identification by the nearest of several centroids per language.

A text becomes the counts of its byte n-grams of one to three, hashed to
`WIDTH` places: lower case, with anything that is no letter as a gap.  Roots of
the counts are weighed by inverse document frequency and brought to length 1.
The documents of each language are clustered, by cosine, round `CENTROIDS`
centroids, which are fitted per language in parallel, on at most about
`PER_LANGUAGE` documents each, chosen by the hash of their id.  A text gets the
language of the centroid nearest to it; the score is the cosine.  A text that is
farther from that centroid than all but a hundredth of the centroid's own
documents is marked `rejected`.

Defined cases: a text that is null or has no letter is `und` with score 0.
Without anything to learn from, so is every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptsieve.llm.texts import column, importable, in_arrow
from promptsieve.session import shared_dir
from promptsieve.sources.sinks import stage

WIDTH = 4096
PER_LANGUAGE = 600
CENTROIDS = 4
STEPS = 12
UNDETERMINED = "und"

_GAP = 0x20
# Bytes as n-grams see them: letters and all beyond ASCII, else a gap.
_SEEN = np.full(256, _GAP, dtype=np.uint8)
_SEEN[list(b"abcdefghijklmnopqrstuvwxyz")] = list(b"abcdefghijklmnopqrstuvwxyz")
_SEEN[128:] = np.arange(128, 256)


def ngram_counts(texts: list[str]) -> np.ndarray:
    """Rows of hashed n-gram counts."""
    coded = [f" {t.lower()} ".encode("utf-8", "replace") for t in texts]
    sizes = np.array([len(c) for c in coded], dtype=np.int64)
    seen = _SEEN[np.frombuffer(b"".join(coded) + b"  ", dtype=np.uint8)].astype(np.uint32)
    base = np.repeat(np.arange(len(coded), dtype=np.int64) * WIDTH, sizes)
    first, second, third = seen[:-2], seen[1:-1], seen[2:]
    some = (first != _GAP) | (second != _GAP)
    total = np.zeros(len(coded) * WIDTH, dtype=np.int64)
    two = (first << np.uint32(8)) | second
    for n, gram in enumerate((first, two, (two << np.uint32(8)) | third), 1):
        mixed = (gram + np.uint32(n << 24)) * np.uint32(2654435761)
        place = (mixed >> np.uint32(20)).astype(np.int64) % WIDTH
        total += np.bincount((base + place)[some], minlength=len(total))
    return total.reshape(len(coded), WIDTH)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    rows = np.sqrt(counts).astype(np.float32) * idf
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def cluster(rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, radius of each as a least cosine) by spherical k-means."""
    k = min(k, len(rows))
    centres = rows[[0]]
    while len(centres) < k:  # the row farthest from those chosen
        centres = np.vstack([centres, rows[np.argmin((rows @ centres.T).max(axis=1))]])
    for _ in range(STEPS):
        own = np.argmax(rows @ centres.T, axis=1)
        for c in range(k):
            if (own == c).any():
                mean = rows[own == c].mean(axis=0)
                centres[c] = mean / max(np.linalg.norm(mean), 1e-9)
    near = rows @ centres.T
    own = np.argmax(near, axis=1)
    radius = [np.quantile(near[own == c, c], 0.01) if (own == c).any() else 1.0 for c in range(k)]
    return centres, np.array(radius)


def held_out(id_col: str = "doc_id") -> F.Column:
    """Rows that fitting never sees: every fourth by the checksum of their id."""
    return F.coalesce(F.crc32(column(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE):
    """(languages, centroids, radii, idf) of the documents that are not held out."""
    spark = docs.sparkSession
    known = docs.select(
        column(id_col).cast("long").alias("id"), column(text_col).alias("text"), column(lang_col).alias("lang"), held_out(id_col).alias("held_out")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("id").isNotNull() & ~F.col("held_out"))
    # A row per language.
    sizes = stage(known.groupBy("lang").agg(F.count("*").alias("n")), shared_dir(spark, "languages"))
    chosen = known.join(sizes, "lang").where(F.pmod(F.xxhash64("id"), F.col("n")) < per_language).select("id", "lang", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = ngram_counts(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r.astype("<u4").tobytes() for r in counts], pa.binary())], names=["id", "lang", "counts"]
            )

    sampled = stage(in_arrow(chosen, vectors, "id long, lang string, counts binary").repartition("lang", F.col("id") % 8), shared_dir(spark, "vectors"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(WIDTH, dtype=np.int64), 0
        for batch in batches:
            for counts in batch.column(0).to_pylist():
                total += np.frombuffer(counts, dtype="<u4") > 0
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()], pa.list_(pa.int64()))], names=["n", "total"])

    parts = in_arrow(sampled.select("counts"), frequencies, "n long, total array<long>").collect()  # a row per task over the sample
    n = sum(p.n for p in parts)
    if not n:
        return [], np.zeros((0, WIDTH), dtype=np.float32), np.zeros(0), np.ones(WIDTH, dtype=np.float32)
    idf = (np.log((1 + n) / (1 + sum(np.array(p.total) for p in parts))) + 1).astype(np.float32)
    shared = spark.sparkContext.broadcast(idf)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["id", "counts"])
        counts = np.stack([np.frombuffer(c, dtype="<u4") for c in group.counts])
        centres, radius = cluster(weighted(counts, shared.value), CENTROIDS)
        return pd.DataFrame({"lang": group.lang.iloc[0], "place": range(len(radius)), "radius": radius, "centre": list(centres.astype(np.float64))})

    importable(spark)
    fitted = sampled.groupBy("lang").applyInPandas(fit, "lang string, place int, radius double, centre array<double>")
    rows = sorted(fitted.collect(), key=lambda r: (r.lang, r.place))  # some centroids per language
    return [r.lang for r in rows], np.array([r.centre for r in rows], dtype=np.float32), np.array([r.radius for r in rows]), idf


def identify(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, centres, radius, idf = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            lettered = np.array([bool(names) and any(map(str.isalpha, t)) for t in texts], dtype=bool)
            language, score, far = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
            at = np.flatnonzero(lettered)
            if len(at):
                near = weighted(ngram_counts([texts[i] for i in at]), idf) @ centres.T
                best = np.argmax(near, axis=1)
                score[at] = np.clip(near[np.arange(len(at)), best], 0, 1)
                far[at] = score[at] < radius[best]
                for i, b in zip(at, best):
                    language[i] = names[b]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(language, pa.string()), pa.array(score), pa.array(far)],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(column(id_col).cast("long"), held_out(id_col), column(text_col))
    return in_arrow(rows, job, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
