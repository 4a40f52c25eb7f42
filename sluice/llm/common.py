"""What the corpus operators share: tables, scratch copies, words and hashes of whole texts, components.

Texts are handled as UTF-8 bytes in numpy, a few megabytes at a time inside each task. Hashes are
64-bit polynomials over one running sum, so any substring's hash is one subtraction and one product.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.runtime import Folder, scratch_dir

#: Bytes of text handled at once inside a task; one longer document is handled alone, whole.
SLICE_BYTES = 2 << 20

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Values of lower-cased bytes, so that hashing folds A-Z without a copy of the text.
_FOLDED = _BYTE[LOWER]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}

WORD = r"[^\x20\x09-\x0D]+"


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**n`` modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or have.size <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Running:
    """Running polynomial sum over bytes; ``span`` hashes any substrings of it."""

    def __init__(self, data: np.ndarray, fold: bool = False):
        n = data.size
        self._sum = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((_FOLDED if fold else _BYTE)[data] * powers(_BASE, n)[:n], out=self._sum[1:])
        self._inverse = powers(_INVERSE, n)

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self._sum[end] - self._sum[start]) * self._inverse[start]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the bounds of its rows; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), bounds
    return np.frombuffer(column.buffers()[2], dtype=np.uint8), bounds


def slices(bounds: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each; a longer row stands alone."""
    lo, n = 0, bounds.size - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + most, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, bounds from 0)`` of a string column, a few megabytes at a time."""
    data, bounds = text_bytes(column)
    for lo, hi in slices(bounds, most):
        yield lo, hi, data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word (a run of bytes other than ASCII white space) in each row."""
    if not data.size:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    solid = ~SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    at = bounds[:-1][bounds[:-1] < data.size]
    first[at] = solid[at]
    at = bounds[1:][bounds[1:] > 0] - 1
    last[at] = solid[at]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


class Words:
    """Words of a slice of rows: bounds, row numbers, words per row and, on demand, folded hashes."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds
        self.start, self.end = word_bounds(data, bounds)
        self.first = np.searchsorted(self.start, bounds)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(bounds.size - 1), self.count)

    def hashes(self, fold: bool = True) -> np.ndarray:
        """A 64-bit hash per word, equal for words that differ only in the case of A-Z if folded."""
        run = Running(self.data, fold)
        return mix(run.span(self.start, self.end) + (self.end - self.start).astype(np.uint64))


_STEP = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def shingles(words: Words, size: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of each row's word n-grams; a shorter row counts as one whole sequence."""
    h = words.hashes()
    grams = _grams(h, size)
    out = []
    for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        out.append(np.unique(grams[lo : hi - size + 1]) if hi - lo >= size else _whole(h[lo:hi]))
    return out


def shingle_set(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """The set of one text, given the hashes of its words."""
    return np.unique(_grams(hashes, size)) if hashes.size >= size else _whole(hashes)


def _grams(h: np.ndarray, size: int) -> np.ndarray:
    n = max(0, h.size - size + 1)
    grams = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        grams += h[j : j + n] * _STEP[j % 5] if j < 5 else mix(h[j : j + n] * _STEP[j % 5])
    return mix(grams)


def _whole(h: np.ndarray) -> np.ndarray:
    """The one hash of a text of a few words; none for a text without words."""
    if not h.size:
        return np.zeros(0, dtype=np.uint64)
    whole = np.uint64(h.size)
    with np.errstate(over="ignore"):
        for j, x in enumerate(h):
            whole = whole + x * _STEP[j % 5]
    return mix(np.array([whole], dtype=np.uint64) ^ np.uint64(0x5851F42D4C957F2D))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mapped(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow``; the row order inside a partition is kept."""
    return df.mapInArrow(fn, schema)


#: Spark's setting to drop the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage and outlives executors.

    The shuffle files of the write go with its end; nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{label}")
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._sluice_path = path
    return out


def dropped(*frames: DataFrame) -> None:
    """Delete scratch copies that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_sluice_path", None)
        if path:
            Folder(df.sparkSession, path).delete()


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that are written out and no longer referenced.

    The driver's heap shrinks to what is still in use, so that a long run of small queries doesn't fill it.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def crc_bucket(column: str, modulus: int) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(id, component)`` for every node of ``(u, v)`` edges: the smallest id it reaches.

    Alternates large-star and small-star steps over tables in the scratch folder until the edges
    stand still. Minima are aggregated before the shuffle and the joins may be split on a hot node.
    """
    edge = saved(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
    before = None
    while True:
        both = edge.unionByName(edge.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = saved(large.where("u <> v").distinct(), label)
        low = star.groupBy("u").agg(F.min("v").alias("m"))
        hung = star.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = saved(hung.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), label)
        state = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        dropped(edge, star)
        edge = new
        release(edge.sparkSession)
        if state == before:
            roots = edge.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
            return edge.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
        before = state
