"""Hard negatives by inner product, found through angles to reference directions.

Every vector is stored with its norm and its angles to a few reference directions, sorted by label,
nearest reference and angle, so that rows that follow one another point alike. An anchor's angle to a
row lies between the difference and the sum of their angles to any reference. Over a window of rows
that gives an interval of cosines, which the norms turn into an interval of scores, widened by what
rounding may cost. Only windows whose interval meets the scores still wanted are scored, exactly.

Anchors are the query set: blocks of at most ``BLOCK`` of them are broadcast, and each block passes
over all rows twice, first for the best rows of its own labels, then for the negatives of each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import dropped, mapped, saved
from sluice.llm.ranking import ranked

#: Anchors of one pass; with 64 components about 3 MB are broadcast.
BLOCK = 4096
#: Rows of a window, and anchors scored against one at a time.
ROWS, ANCHORS = 512, 512
REFERENCES, SAMPLE = 16, 2048
#: What rounding may move an angle by (radians) and a score by (a share of the product of the norms).
ANGLE_SLACK, SCORE_SLACK = 1e-6, 1e-9
_EXACT = float(1 << 53)
_LAST = np.iinfo(np.int64).max
_INDEX = "row long, vec_id long, label long, vector array<double>, norm double, angles array<double>"


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of numbers as rows, shorter ones filled up with zeros."""
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(size.max()) if size.size else 0
    if size.size and (size == width).all():
        return flat.reshape(size.size, width)
    out = np.zeros((size.size, width))
    out[np.arange(width) < size[:, None]] = flat
    return out


def _shared(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = min(a.shape[1], b.shape[1])
    return a[:, :width], b[:, :width]


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers as 64-bit integers; beyond their range, its ends."""
    a, b = _shared(a, b)
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[0]), dtype=np.int64)
    if a.shape[1] * float(np.abs(a).max()) * float(np.abs(b).max()) < _EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(a) @ whole(b).T, -_LAST, _LAST).astype(np.int64)


def _norms(m: np.ndarray) -> np.ndarray:
    top = np.abs(m).max(axis=1, initial=0)
    scale = np.where(top > 0, top, 1)
    return np.sqrt(((m / scale[:, None]) ** 2).sum(axis=1)) * scale


def angles_to(m: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles of rows to reference directions; a zero row counts as orthogonal to all."""
    unit = m / np.where(norms > 0, norms, 1)[:, None]
    a, b = _shared(unit, references)
    return np.arccos(np.clip(a @ b.T, -1, 1))


def bounds(a_norm: np.ndarray, a_angles: np.ndarray, norms: np.ndarray, angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that each anchor can have with any row of a window."""
    low, high = angles.min(axis=0) - ANGLE_SLACK, angles.max(axis=0) + ANGLE_SLACK
    apart = np.maximum(np.maximum(a_angles - high, low - a_angles).max(axis=1), 0) - ANGLE_SLACK
    near, far = a_angles + low - ANGLE_SLACK, a_angles + high + ANGLE_SLACK
    wide = np.where((near <= np.pi) & (far >= np.pi), np.pi, np.maximum(np.minimum(near, 2 * np.pi - near), np.minimum(far, 2 * np.pi - far))).min(axis=1)
    top, bottom = np.cos(np.clip(apart, 0, np.pi)), np.cos(np.clip(wide, 0, np.pi))
    least, most = norms.min(), norms.max()
    slack = SCORE_SLACK * a_norm * most + 1
    return a_norm * bottom * np.where(bottom >= 0, least, most) - slack, a_norm * top * np.where(top >= 0, most, least) + slack


class Best:
    """The ``k`` best rows per slot: higher scores first, then smaller ids, null ids last, then earlier rows."""

    def __init__(self, least: np.ndarray, k: int):
        self.k, self.bar = k, least.copy()
        self.kept = tuple(np.zeros(0, dtype=np.int64) for _ in range(5))

    def offer(self, slots: np.ndarray, score: np.ndarray, mask: np.ndarray, ids: np.ndarray, none: np.ndarray, rows: np.ndarray) -> None:
        """Take what ``mask`` allows of a table of scores of ``slots`` with a window's rows."""
        mask &= score >= self.bar[slots][:, None]
        if mask.shape[1] > self.k and np.count_nonzero(mask) > 2 * self.k * mask.shape[0]:
            open_ = np.where(mask, score, np.iinfo(np.int64).min)
            mask &= score >= np.partition(open_, -self.k, axis=1)[:, -self.k][:, None]
        at, row = np.nonzero(mask)
        if not at.size:
            return
        new = (slots[at], score[at, row], none[row].astype(np.int64), ids[row], rows[row])
        slot, value, no_id, own, place = (np.concatenate(x) for x in zip(self.kept, new))
        order = np.lexsort((place, own, no_id, -value, slot))
        slot = slot[order]
        first = np.flatnonzero(np.diff(slot, prepend=-1))
        rank = np.arange(slot.size) - np.repeat(first, np.diff(first, append=slot.size))
        keep = order[rank < self.k]
        self.kept = tuple(x[keep] for x in (np.concatenate(x) for x in zip(self.kept, new)))
        full = rank == self.k - 1
        self.bar[slot[full]] = np.maximum(self.bar[slot[full]], value[order][full])

    def batch(self) -> pa.RecordBatch:
        slot, value, no_id, own, place = self.kept
        return pa.RecordBatch.from_arrays(
            [pa.array(slot), pa.array(value), pa.array(own, mask=no_id.astype(bool)), pa.array(place)], names=["slot", "score", "vec_id", "row"]
        )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """``rows, ids, missing ids, labels, vectors, norms, angles`` of a few hundred rows that follow one another."""
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            part = batch.slice(lo, ROWS)
            ids = part.column(1)
            yield (
                part.column(0).to_numpy(), ids.fill_null(_LAST).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), part.column(2).to_numpy(),
                _matrix(part.column(3)), part.column(4).to_numpy(), _matrix(part.column(5)),
            )


def _positives(block, k: int) -> Callable:
    """Best rows of the anchors' own labels, among the rows of one task."""

    def run(batches):
        row, label, vector, norm, angles = block.value
        best = Best(np.full(row.size, np.iinfo(np.int64).min), k)
        for rows, ids, none, labels, vectors, norms, theirs in _windows(batches):
            own = np.flatnonzero(np.isin(label, labels))
            _, top = bounds(norm[own], angles[own], norms, theirs)
            own = own[top >= best.bar[own]]
            for lo in range(0, own.size, ANCHORS):
                some = own[lo : lo + ANCHORS]
                mask = (label[some][:, None] == labels) & (row[some][:, None] != rows)
                best.offer(some, scores(vector[some], vectors), mask, ids, none, rows)
        yield best.batch()

    return run


def _negatives(block, wanted, k: int) -> Callable:
    """Best rows of other labels inside each slot's range of scores, among the rows of one task."""

    def run(batches):
        row, label, vector, norm, angles = block.value
        anchor, least, most = wanted.value
        best = Best(least, k)
        for rows, ids, none, labels, vectors, norms, theirs in _windows(batches):
            bottom, top = bounds(norm, angles, norms, theirs)
            alike = (labels == labels[0]).all() & (label == labels[0])
            slots = np.flatnonzero((top[anchor] >= best.bar) & (bottom[anchor] <= most) & ~alike[anchor])
            for lo in range(0, slots.size, ANCHORS):
                some = slots[lo : lo + ANCHORS]
                of, place = np.unique(anchor[some], return_inverse=True)
                score = scores(vector[of], vectors)[place]
                mask = (label[anchor[some]][:, None] != labels) & (score <= most[some][:, None])
                best.offer(some, score, mask, ids, none, rows)
        yield best.batch()

    return run


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose vectors are whole and finite, components scaled and rounded down."""
    for batch in batches:
        lists = batch.column(3)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
        keep = pa.array(bad[ends] == bad[np.concatenate([[0], ends[:-1]])] if ends.size else np.zeros(0, dtype=bool))
        with np.errstate(all="ignore"):
            flat = np.nan_to_num(np.floor(256 * flat), nan=0.0)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat))
        columns = [batch.column(0), batch.column(1), batch.column(2), lists]
        yield pa.RecordBatch.from_arrays(columns, names=["row", "vec_id", "label", "vector"]).filter(keep)


def _references(sample: np.ndarray, n: int) -> np.ndarray:
    """Directions far from one another: the mean of a sample, then always the row farthest from those taken."""
    norms = _norms(sample)
    unit = sample[norms > 0] / norms[norms > 0][:, None]
    if not unit.shape[0]:
        return np.zeros((1, sample.shape[1]))
    mean = unit.mean(axis=0)
    size = np.linalg.norm(mean)
    taken = [mean / size if size > 1e-9 else unit[0]]
    near = unit @ taken[0]
    while len(taken) < min(n, unit.shape[0]):
        taken.append(unit[int(np.argmin(near))])
        near = np.maximum(near, unit @ taken[-1])
    return np.array(taken)


def _with_angles(references: np.ndarray) -> Callable:
    def run(batches):
        for batch in batches:
            m = _matrix(batch.column(3))
            norms = _norms(m)
            angles = angles_to(m, norms, references)
            nearest = angles.argmin(axis=1) if batch.num_rows else np.zeros(0, dtype=np.int64)
            stored = pa.FixedSizeListArray.from_arrays(pa.array(angles.reshape(-1)), references.shape[0]).cast(pa.list_(pa.float64()))
            columns = [*batch.columns, pa.array(norms), stored, pa.array(nearest.astype(np.int32)), pa.array(angles.min(axis=1, initial=np.pi))]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "vec_id", "label", "vector", "norm", "angles", "cell", "angle"])

    return run


def index(rows: DataFrame, references: int = REFERENCES, sample: int = SAMPLE) -> DataFrame:
    """The written index of ``row, vec_id, label, vector``: norms, angles, sorted by label and direction.

    Reference directions come from the ``sample`` rows with the least hash; they only make windows
    narrower or wider. All rows are indexed.
    """
    some = rows.orderBy(F.xxhash64("row"), "row").limit(sample).select("vector").toArrow().column("vector").combine_chunks()
    directions = _references(_matrix(some), references) if len(some) else np.zeros((1, 1))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["label", "cell", "angle", "row"]
    placed = mapped(rows, _with_angles(directions), f"{_INDEX}, cell int, angle double").repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    return saved(placed.drop("cell", "angle"), "negatives-index")


def _first(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of what all tasks found per slot, with ``rank``."""
    order = Window.partitionBy("slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mined(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, least: int = 3, most: int = 9, block: int = BLOCK) -> DataFrame:
    """Hard negatives of every anchor and each of its positives.

    ``rows`` has ``vec_id, label`` and ``vector``; ``anchors`` says which of them ask. Components are
    scaled by 256 and rounded down; a score is the exact inner product of these whole numbers. An
    anchor's positives are its ``positives`` best other rows of the same label, its negatives the best
    rows of other labels with scores from ``least`` to ``most`` tenths of the positive's score. Returns
    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Rows with a null label or vector, or a null, infinite or NaN component, take no part. Ties go to
    the smaller ``vec_id``, null ids last. Rows with equal ids or vectors are rows of their own. Shorter
    vectors count as filled up with zeros; scores beyond 64 bits count as the ends of that range. A
    positive without negatives gives no row, an empty table an empty result; other columns are ignored.
    """
    spark = rows.sparkSession
    whole = rows.where("label IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL)")
    typed = whole.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("vector").cast("array<double>"))
    clean = saved(mapped(typed, _vectors, "row long, vec_id long, label long, vector array<double>"), "negatives-rows")
    stored = index(clean)
    dropped(clean)
    asking = stored.where(anchors).withColumn("of", F.lit(0))
    asking = saved(ranked(asking, ["of"], ["vec_id", "row"], "negatives-anchors"), "negatives-numbered")
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for first in range(0, asking.count(), block):
        out = out.unionByName(_block(spark, stored, asking.where((F.col("i") >= first) & (F.col("i") < first + block)), positives, negatives, least, most))
    return out


def _block(spark, stored: DataFrame, asking: DataFrame, positives: int, negatives: int, least: int, most: int) -> DataFrame:
    """One block of anchors against all rows."""
    own = asking.select("row", "label", "vector", "norm", "angles", "vec_id").orderBy("i").toArrow().combine_chunks()
    column = lambda name: own.column(name).combine_chunks()
    send = spark.sparkContext.broadcast
    arrays = (column("row").to_numpy(), column("label").to_numpy(), _matrix(column("vector")), column("norm").to_numpy(), _matrix(column("angles")))
    block = send(arrays)
    schema = "slot long, score long, vec_id long, row long"
    best = _first(mapped(stored, _positives(block, positives), schema), positives).select("slot", "score", "vec_id", "rank").toArrow()
    anchor, score = best.column("slot").to_numpy(), best.column("score").to_numpy()
    slots, of = np.unique(np.stack([anchor, score]), axis=1, return_inverse=True)
    # Tenths of the score rounded up and down, without leaving 64 bits.
    tens, rest = slots[1] // 10, slots[1] % 10
    low, high = least * tens - (-least * rest) // 10, most * tens + most * rest // 10
    wanted = send((slots[0], low, np.where(low <= high, high, np.iinfo(np.int64).min)))
    found = _first(mapped(stored, _negatives(block, wanted, negatives), schema), negatives)
    ids = column("vec_id")
    pairs = pa.table({"slot": pa.array(of.reshape(-1).astype(np.int64)), "anchor_id": ids.take(pa.array(anchor)), "positive_id": best.column("vec_id"), "positive_score": best.column("score")})
    pairs = spark.createDataFrame(pairs, "slot long, anchor_id long, positive_id long, positive_score long")
    found = found.select("slot", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    rows = found.join(pairs, "slot").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return saved(rows, "negatives-block")
