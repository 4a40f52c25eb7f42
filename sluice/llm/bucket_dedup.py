"""Removal of repeated byte strings by bucket-pointer refinement of text positions.

Positions are put into buckets by their first q bytes, and a bucket is refined by the identifiers of
the buckets that its members' later offsets lie in: the bucket of 24 bytes at p is named by those of 12
bytes at p and at p + 12, the bucket of 48 bytes by those of 24 bytes at p and p + 24, and any longer
string by the 48-byte buckets at its two ends, which overlap. Every name is made once and used again for
all longer ones. Identifiers are 64-bit mixtures instead of ranks, so that all tasks agree on them
without a sort, and buckets can be dealt over a cluster by name.

Only some positions enter. Of every 50-byte window the position with the smallest 24-byte bucket is
chosen (all of them, on ties), so equal windows choose the same places, about one position in fourteen.
Buckets of one document are done. The others are refined by the identifiers at the two ends of the whole
stretch that windows around the position can reach: where an earlier document is in the same refined
bucket, all those windows repeat. Only buckets that still hold different stretches are refined once
more, to the buckets of their single windows. The result is exact up to equal 64-bit names of
different strings.

Texts are walked in regions of a quarter of a megabyte; a longer one in regions that overlap.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import mapped, mix, release, saved, slices, text_bytes

_MOST = np.uint64(2**64 - 1)
#: Bytes whose positions are named at once; about forty times as much is held for them.
REGION_BYTES = 256 << 10
#: Lengths of the buckets: the first is named from the bytes, each next from the one before.
FIRST, SHORT, LONG = 12, 24, 48
_NEAR, _LATER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` values, by doubling."""
    n, out = 1, x
    while 2 * n <= width:
        out = pick(out[: out.size - n], out[n:])
        n *= 2
    rest = width - n
    return pick(out[: out.size - rest], out[rest:]) if rest else out


def _joined(near: np.ndarray, later: np.ndarray) -> np.ndarray:
    """The bucket of two buckets, one at a later offset."""
    return mix(near * _NEAR + later * _LATER)


def _refined_by(names: np.ndarray, offset: int) -> np.ndarray:
    """Buckets refined by those of the positions ``offset`` further on."""
    n = max(0, names.size - offset)
    return _joined(names[:n], names[names.size - n :])


def _first_buckets(data: np.ndarray) -> np.ndarray:
    """Identifiers of the first ``FIRST`` bytes at every position, from two overlapping words of eight."""
    if data.size < FIRST:
        return np.zeros(0, dtype=np.uint64)
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    words = np.ascontiguousarray(words).view("<u8").reshape(-1)
    return _refined_by(mix(words + _NEAR), FIRST - 8)


class _Region:
    """Buckets of the positions of some documents, or of a part of a long one.

    ``first`` and ``last`` say which windows belong here, by their start; the region reaches further
    to both sides, so that what surrounds them is known.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, length: int, first: int, last: int):
        n, self.length, self.width, self.bounds = data.size, length, length - SHORT + 1, bounds
        self.doc = np.repeat(np.arange(bounds.size - 1), np.diff(bounds))
        self.name = _refined_by(_first_buckets(data), FIRST)
        self.long = _refined_by(self.name, SHORT)
        inside = self.doc[: self.name.size] == self.doc[n - self.name.size :]
        self.name = np.where(inside, self.name, _MOST)
        #: Windows inside one document; the others have the name 0, which no window can have to be chosen.
        start = np.arange(max(0, n - length + 1))
        self.whole = (self.doc[: start.size] == self.doc[n - start.size :]) & (start >= first) & (start < last)
        self.least = np.where(self.whole, sliding(self.name, self.width, np.minimum), np.uint64(0)) if start.size else np.zeros(0, np.uint64)

    def string(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Buckets of strings of ``LONG`` to twice as many bytes, by those at their two ends."""
        return _joined(self.long[start], self.long[end - LONG] + (end - start).astype(np.uint64))

    def chosen(self) -> np.ndarray:
        if not self.least.size:
            return np.zeros(0, dtype=np.int64)
        pad = np.zeros(self.width - 1, dtype=np.uint64)
        reach = sliding(np.concatenate([pad, self.least, pad]), self.width, np.maximum)
        return np.flatnonzero((reach == self.name) & (self.name != _MOST))

    def owned(self, places: np.ndarray) -> np.ndarray:
        """Windows whose smallest bucket is at one of the places."""
        own = np.full(self.name.size, _MOST)
        own[places] = self.name[places]
        return np.flatnonzero(self.whole & (sliding(own, self.width, np.minimum) == self.least)) if self.least.size else places[:0]

    def stretch(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of what the windows around a chosen position reach inside its document."""
        doc = self.doc[places]
        return np.maximum(places - (self.length - SHORT), self.bounds[doc]), np.minimum(places + self.length, self.bounds[doc + 1])


def _regions(column: pa.Array, length: int) -> Iterator[tuple[int, np.ndarray, int, _Region]]:
    """``(first row, bounds, offset in the row, region)``; a long row's regions overlap by what they need."""
    data, bounds = text_bytes(column)
    for lo, hi in slices(bounds, REGION_BYTES):
        begin, end = int(bounds[lo]), int(bounds[hi])
        if end - begin <= REGION_BYTES:
            own = bounds[lo : hi + 1] - begin
            yield lo, own, 0, _Region(data[begin:end], own, length, 0, end - begin)
            continue
        for at in range(begin, end, REGION_BYTES):
            a, b = max(begin, at - 2 * length), min(end, at + REGION_BYTES + 3 * length)
            own = np.array([0, b - a])
            yield lo, own, a - begin, _Region(data[a:b], own, length, at - a, at - a + REGION_BYTES)


def _places(length: int):
    def run(batches):
        for batch in batches:
            ids, tags = batch.column(0), batch.column(1).to_numpy()
            for lo, bounds, offset, region in _regions(batch.column(2), length):
                at = region.chosen()
                start, end = region.stretch(at)
                doc = region.doc[at]
                refined = _joined(region.string(start, end), (at - start).astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(region.name[at].view(np.int64)), pa.array(refined.view(np.int64)),
                        ids.take(pa.array(lo + doc)), pa.array((tags[lo + doc] << 32) | (at - bounds[doc] + offset)),
                    ],
                    names=["h", "c", "d", "loc"],
                )

    return run


def _windows(length: int):
    def run(batches):
        for batch in batches:
            ids, tags, lists = batch.column(0), batch.column(1).to_numpy(), batch.column(3)
            for lo, bounds, offset, region in _regions(batch.column(2), length):
                part = lists.slice(lo, bounds.size - 1)
                at = part.flatten().to_numpy() + np.repeat(bounds[:-1], np.asarray(part.value_lengths())) - offset
                start = region.owned(at[(at >= 0) & (at < region.name.size)])
                doc = region.doc[start]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(region.string(start, start + length).view(np.int64)), ids.take(pa.array(lo + doc)), pa.array((tags[lo + doc] << 32) | (start - bounds[doc] + offset))],
                    names=["w", "d", "loc"],
                )

    return run


def _runs(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the maximal runs that intervals cover; those that touch are one run."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]])) if start.size else np.zeros(0, np.int64)
    return start[new], reach[np.concatenate([new[1:] - 1, [start.size - 1]])] if start.size else reach


def _removed(length: int, with_bytes: bool):
    def run(batches):
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for lo in range(0, batch.num_rows, 256):
                hi = min(lo + 256, batch.num_rows)
                out = []
                for r in range(lo, hi):
                    raw = data[bounds[r] : bounds[r + 1]]
                    wide, single = (np.array(batch.column(c)[r].as_py() or (), dtype=np.int64) for c in (2, 3))
                    start = np.concatenate([np.maximum(wide - (length - SHORT), 0), single])
                    start, end = _runs(start, np.concatenate([np.minimum(wide + length, raw.size), single + length]))
                    digest, kept, at = hashlib.sha256(), [], 0
                    for a, b in zip([*start.tolist(), raw.size], [*end.tolist(), raw.size]):
                        digest.update(raw[at:a])
                        if with_bytes:
                            kept.append(raw[at:a].tobytes())
                        at = b
                    out.append((raw.size, int((end - start).sum()), start.size, digest.hexdigest(), b"".join(kept)))
                columns = [batch.column(0).slice(lo, hi - lo), *(pa.array([o[i] for o in out], pa.int64()) for i in range(3)), pa.array([o[3] for o in out], pa.string())]
                names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if with_bytes:
                    columns.append(pa.array([o[4] for o in out], pa.binary()))
                    names.append("kept")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _position() -> list:
    """The row's tag and the place in its text, from the packed number."""
    return [F.shiftright("loc", 32).alias("tag"), F.col("loc").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("at")]


def _marked(rows: DataFrame, length: int) -> DataFrame:
    """Places whose whole stretch an earlier document has (``wide``), and those to be refined."""
    places = mapped(rows.select("d", "tag", "text"), _places(length), "h long, c long, d long, loc long")
    bucket, refined = Window.partitionBy("h"), Window.partitionBy("h", "c")
    shared = (
        places.withColumns({"low": F.min("d").over(bucket), "high": F.max("d").over(bucket), "c0": F.min("c").over(bucket), "c1": F.max("c").over(bucket)})
        .where("low < high")
        .withColumn("first", F.min("d").over(refined))
    )
    return saved(shared.where("first < d OR c0 <> c1").select("d", *_position(), (F.col("first") < F.col("d")).alias("wide")), "marks")


def _refined(rows: DataFrame, marks: DataFrame, length: int) -> DataFrame:
    """Windows around the places to be refined that an earlier document has."""
    open_ = marks.where("NOT wide").groupBy("d", "tag").agg(F.collect_list("at").alias("at"))
    windows = mapped(rows.select("d", "tag", "text").join(open_, ["d", "tag"]).select("d", "tag", "text", "at"), _windows(length), "w long, d long, loc long")
    single = windows.withColumn("first", F.min("d").over(Window.partitionBy("w"))).where("first < d")
    return saved(single.select("d", *_position(), F.lit(False).alias("wide")), "windows")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, with_bytes: bool = False) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256)`` per row, and ``kept``, the bytes left, if asked.

    A byte goes if a ``length``-byte string over it also starts in a document with a smaller id, judged
    on the input. A null text is empty; texts shorter than ``length`` bytes lose nothing. Rows of one id
    do not remove one another's bytes; equal rows of one id are given alike. A null id counts as larger
    than all others. Ids are integers. Texts of any length are walked in regions. Other columns are
    ignored; an empty table gives no rows. ``length`` is from 48 to 72.
    """
    if not LONG <= length <= 3 * SHORT:
        raise ValueError(f"length must be from {LONG} to {3 * SHORT}")
    id_ = F.col(id_col).cast("long")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(id_.alias("id"), F.coalesce(id_, F.lit(2**63 - 1)).alias("d"), text.alias("text"))
    rows = rows.withColumn("tag", F.crc32(F.col("text").cast("binary")) % (1 << 31))
    marks = _marked(rows, length)
    release(docs.sparkSession)
    single = _refined(rows, marks, length)
    release(docs.sparkSession)
    hits = marks.where("wide").unionByName(single).groupBy("d", "tag")
    hits = hits.agg(F.collect_list(F.when(F.col("wide"), F.col("at"))).alias("wide"), F.collect_list(F.when(~F.col("wide"), F.col("at"))).alias("single"))
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_bytes else "")
    return mapped(rows.join(hits, ["d", "tag"], "left").select("id", "text", "wide", "single"), _removed(length, with_bytes), schema)
