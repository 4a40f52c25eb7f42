"""Quality classifier: similarity-weighted votes of the nearest labelled documents.

Every text becomes hashed counts of word shapes and words plus a few bins of length and repetition.
They are weighted by inverse document frequency over the whole corpus and projected on the leading
right singular vectors of a labelled sample (latent semantic vectors). The labelled vectors are
broadcast: their number is at most ``max_labelled`` and their width ``rank``, whatever the corpus.
Each task multiplies blocks of documents with all of them and lets the ``neighbours`` most similar
ones vote with their cosine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Words, crc_bucket, mapped, mix, powers, release, text_slices

#: Hash buckets of word shapes, of words, and bins of whole-document traits.
SHAPES, WORDS, TRAITS = 1024, 1024, 64
WIDTH = SHAPES + WORDS + TRAITS
#: Weight of each feature family in the cosine.
WEIGHTS = (1.0, 0.35, 0.6)
#: Labelled rows whose counts the driver lays out at once.
ROWS = 256

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = 97
_CLASS[128:] = 97
_CLASS[65:91] = 65
_CLASS[48:58] = 48
_TOKEN = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP, _BACK = 0xC2B2AE3D27D4EB4F, pow(0xC2B2AE3D27D4EB4F, -1, 1 << 64)


def shape_hashes(words: Words) -> np.ndarray:
    """Hash of each word's shape: runs of lower case, upper case and digits, and symbols once each."""
    kind = _CLASS[words.data]
    fresh = np.ones(kind.size, dtype=bool)
    fresh[1:] = kind[1:] != kind[:-1]
    fresh[words.start] = True
    rank = np.cumsum(fresh)
    value = np.where(fresh, _TOKEN[kind] * powers(_STEP, kind.size)[rank], np.uint64(0))
    total = np.zeros(kind.size + 1, dtype=np.uint64)
    np.cumsum(value, out=total[1:])
    return mix((total[words.end] - total[words.start]) * powers(_BACK, kind.size)[rank[words.start]])


def features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Counts of each row's features, ``rows x WIDTH``."""
    words, rows = Words(data, bounds), bounds.size - 1
    out = np.zeros((rows, WIDTH), dtype=np.float32)
    if words.start.size:
        shape = (shape_hashes(words) >> np.uint64(40)).astype(np.int64) % SHAPES
        hashes = words.hashes()
        word = (hashes >> np.uint64(40)).astype(np.int64) % WORDS
        out[:, :SHAPES] = np.bincount(words.row * SHAPES + shape, minlength=rows * SHAPES).reshape(rows, SHAPES)
        out[:, SHAPES : SHAPES + WORDS] = np.bincount(words.row * WORDS + word, minlength=rows * WORDS).reshape(rows, WORDS)
        for r, (lo, hi) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
            if hi > lo:
                own = hashes[lo:hi]
                new = np.unique(own).size / (hi - lo)
                same = float((own[1:] == own[:-1]).mean()) if hi - lo > 1 else 0.0
                long = float((words.end[lo:hi] - words.start[lo:hi]).mean())
                out[r, SHAPES + WORDS + min(15, int(np.log2(hi - lo)))] = 1
                out[r, SHAPES + WORDS + 16 + min(15, int(16 * new))] = 2
                out[r, SHAPES + WORDS + 32 + min(15, int(16 * same))] = 2
                out[r, SHAPES + WORDS + 48 + min(15, int(long))] = 1
    return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Log counts times inverse document frequency, each family brought to its own length."""
    out = np.log1p(counts) * idf
    edges = (0, SHAPES, SHAPES + WORDS, WIDTH)
    for weight, lo, hi in zip(WEIGHTS, edges[:-1], edges[1:]):
        part = out[:, lo:hi]
        length = np.linalg.norm(part, axis=1, keepdims=True)
        part *= weight / np.where(length > 0, length, 1)
    return out


def _dense(at: list[bytes], value: list[bytes], rows: np.ndarray) -> np.ndarray:
    """Counts of some rows of the sample, from the places and values of those that are not zero."""
    out = np.zeros((rows.size, WIDTH), dtype=np.float32)
    for k, r in enumerate(rows.tolist()):
        out[k, np.frombuffer(at[r], np.int16)] = np.frombuffer(value[r], np.float32)
    return out


def document_frequencies(docs: DataFrame, text: str) -> np.ndarray:
    """In how many texts each feature occurs, over all rows; at most WIDTH rows reach the driver."""

    def count(batches):
        total = np.zeros(WIDTH, dtype=np.int64)
        n = 0
        for batch in batches:
            for lo, hi, data, bounds in text_slices(batch.column(0)):
                total += (features(data, bounds) > 0).sum(axis=0)
                n += hi - lo
        yield pa.RecordBatch.from_pydict({"feature": np.arange(-1, WIDTH, dtype=np.int32), "n": np.concatenate([[n], total])})

    rows = mapped(docs.select(F.col(text).alias("text")), count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(WIDTH + 1)
    for r in rows:
        out[r["feature"]] = r["n"]  # the number of texts comes as feature -1, the last place
    return out


def singular_vectors(x: np.ndarray, rank: int, seed: int = 5) -> np.ndarray:
    """Leading right singular vectors by a randomised range finder with two power steps."""
    rank = max(1, min(rank, *x.shape))
    y = x @ np.random.default_rng(seed).standard_normal((x.shape[1], min(rank + 10, x.shape[1]))).astype(x.dtype)
    for _ in range(2):
        y = x @ (x.T @ np.linalg.qr(y)[0])
    q = np.linalg.qr(y)[0]
    return np.linalg.svd(q.T @ x, full_matrices=False)[2][:rank].T.astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(length > 0, length, 1)).astype(np.float32)


def vote(z: np.ndarray, known: np.ndarray, marks: np.ndarray, neighbours: int, prior: float) -> np.ndarray:
    """Share of label 1 among the most similar known rows, weighted by the square of the cosine."""
    if not known.shape[0]:
        return np.full(z.shape[0], prior)
    out = np.full(z.shape[0], prior)
    k = min(neighbours, known.shape[0])
    for lo in range(0, z.shape[0], 256):
        cosine = z[lo : lo + 256] @ known.T
        near = np.argpartition(cosine, known.shape[0] - k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** 2
        total = weight.sum(axis=1)
        share = (weight * marks[near]).sum(axis=1) / np.where(total > 0, total, 1)
        out[lo : lo + 256] = np.where(total > 1e-9, share, prior)
    return np.clip(out, 0.0, 1.0)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    max_labelled: int = 6000,
    rank: int = 48,
    neighbours: int = 25,
) -> DataFrame:
    """``(id, score)`` for every row of ``docs``: how likely its label is 1, between 0 and 1.

    ``labels`` holds ``id_col`` and ``label``; rows without either are ignored. The classifier is
    fitted on at most ``max_labelled`` labelled documents, those with the smallest hash of their id;
    with fewer, on all; where rows share a labelled id, on the least of their texts. Of known documents
    equally near, those that come first in the order of their features vote. A null text counts as empty. Empty texts, and all texts when nothing is
    labelled, get the mean label (0.5 without any). Repeated rows get equal scores. An empty table
    gives an empty result. Further columns of ``docs`` are ignored, whatever their names.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("mark"))
        .where("id IS NOT NULL AND mark IS NOT NULL")
        .groupBy("id").agg(F.max("mark").alias("mark"))
        .orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    )
    frequency = document_frequencies(rows, "text")
    n = frequency[-1]
    idf = (np.log((1 + n) / (1 + frequency[:WIDTH])) + 0.2).astype(np.float32)

    def sparse(batches):
        for batch in batches:
            for lo, hi, data, bounds in text_slices(batch.column(1)):
                counts = features(data, bounds)
                marks = batch.column(0).slice(lo, hi - lo)
                own = [np.flatnonzero(c) for c in counts]
                yield pa.RecordBatch.from_arrays(
                    [marks, pa.array([i.astype(np.int16).tobytes() for i in own], pa.binary()), pa.array([c[i].tobytes() for c, i in zip(counts, own)], pa.binary())],
                    names=["mark", "at", "value"],
                )

    # One text per labelled id, the least, so that the sample is bounded however often an id repeats.
    labelled = rows.join(F.broadcast(known), "id").groupBy("id", "mark").agg(F.min("text").alias("text"))
    sample = mapped(labelled.select("mark", "text"), sparse, "mark int, at binary, value binary").toArrow()
    marks = sample["mark"].to_numpy().astype(np.float64) if sample.num_rows else np.zeros(0)
    # The sample's matrix is the largest thing on the driver: it is there once, and counts a few rows at a time.
    own, parts = (sample["at"].to_pylist(), sample["value"].to_pylist()), [slice(lo, lo + ROWS) for lo in range(0, marks.size, ROWS)]
    del sample
    keys = np.zeros((5, marks.size), dtype=np.float32)
    for part in parts:
        counts = _dense(*own, np.arange(marks.size)[part])
        keys[:4, part], keys[4, part] = counts[:, :4].T, counts.sum(axis=1)
    order = np.lexsort((*keys, marks)) if marks.size else np.zeros(0, dtype=int)
    x, marks = np.empty((marks.size, WIDTH), dtype=np.float32), marks[order]
    for part in parts:
        x[part] = weighted(_dense(*own, order[part]), idf)
    del own
    prior = float(marks.mean()) if marks.size else 0.5
    full = x.any(axis=1)
    if full.any():
        x, marks = x if full.all() else x[full], marks[full]
        axes = singular_vectors(x, rank)
        vectors = unit(x @ axes)
    else:
        axes, vectors, marks = np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0)
    del x
    model = spark.sparkContext.broadcast((idf, axes, vectors, marks, prior))
    release(spark)

    def score(batches):
        idf, axes, vectors, marks, prior = model.value
        for batch in batches:
            for lo, hi, data, bounds in text_slices(batch.column(1), 1 << 20):
                counts = features(data, bounds)
                found = vote(unit(weighted(counts, idf) @ axes), vectors, marks, neighbours, prior)
                found[~counts.any(axis=1)] = prior
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(found)], names=["id", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    return mapped(rows, score, f"id {kind}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``; learns from rows whose crc32(doc_id) mod 5 is not 0."""
    learn = labels.where(crc_bucket("doc_id", 5) != 0)
    return classify(docs, learn).select(
        F.col("id").alias("doc_id"),
        F.coalesce(crc_bucket("id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
