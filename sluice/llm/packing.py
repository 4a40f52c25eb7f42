"""Vector best-fit packing of documents into sequences.

A sequence has three capacities: tokens, documents and attention cost (the sum of the squares of its
pieces' lengths). What a piece takes of them follows from its length, so pieces of one length are
alike, and the whole corpus is packed by how many pieces there are of each length: longest first,
every piece goes to the open sequence that fits it under all three capacities and scores best, by the
residual norm (what would be left, weighted) or by the weighted dot product of the piece with what is
left. Sequences with equal residuals are one class with a count, so placing a million pieces is one
step. The counts have at most ``max_tokens`` rows whatever the corpus holds.

The result is a plan of ranges: pieces ``from .. to`` of a length go to consecutive sequences, so
many in each, at a known offset. Spark numbers the pieces of each length over all tasks and every
piece looks its range up.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import mapped, saved
from sluice.llm.ranking import ranked
from sluice.llm.tokenizing import tokenizer

MAX_TOKENS = 4096


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds at most, and how much each of the three counts in a score.

    A capacity in tokens of 4,096 alone is as tight as one of 4,096 documents and an attention cost
    of 4,096 squared, so by default only tokens bind.
    """

    tokens: int = MAX_TOKENS
    docs: int = MAX_TOKENS
    cost: int = MAX_TOKENS * MAX_TOKENS
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    score: str = "norm"

    def most(self, length: int, left: tuple[int, int, int] | None = None) -> int:
        """How many pieces of a length fit into what is left."""
        tokens, docs, cost = left or (self.tokens, self.docs, self.cost)
        return min(tokens // length, docs, cost // (length * length))


#: The plan's columns: pieces ``low ..`` of ``length`` go, ``per`` to a sequence, to sequences from ``bin`` on, at ``offset``.
PLAN = ("length", "low", "per", "bin", "offset")


class _Open:
    """Open sequences by what they have left; those with equal residuals are a class."""

    def __init__(self, capacity: Capacity):
        self.capacity = capacity
        self.ranges: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
        self.order: list[tuple[int, int, int]] = []
        w = np.array(capacity.weights) / np.array([capacity.tokens, capacity.docs, capacity.cost], dtype=float)
        self._weights = w if capacity.score == "dot" else np.array(capacity.weights) / np.array([capacity.tokens, capacity.docs, capacity.cost], dtype=float) ** 2

    def put(self, left: tuple[int, int, int], first: int, count: int) -> None:
        if left[0] <= 0 or left[1] <= 0 or left[2] <= 0:
            return
        if left not in self.ranges:
            self.ranges[left] = []
            insort(self.order, left)
        self.ranges[left].append((first, count))

    def take(self, left: tuple[int, int, int], most: int) -> tuple[int, int]:
        """A range of at most ``most`` sequences of a class."""
        ranges = self.ranges[left]
        first, count = ranges.pop()
        if count > most:
            ranges.append((first + most, count - most))
            count = most
        if not ranges:
            del self.ranges[left]
            self.order.pop(bisect_right(self.order, left) - 1)
        return first, count

    def ranked(self, length: int) -> list[tuple[int, int, int]]:
        """Classes that fit a piece, best first; the order is (tokens, documents, cost) where scores tie."""
        low = bisect_right(self.order, (length, 0, 0))
        fitting = [c for c in self.order[low:] if c[1] >= 1 and c[2] >= length * length]
        if not fitting:
            return []
        left = np.array(fitting, dtype=float)
        item = np.array([length, 1, length * length], dtype=float)
        if self.capacity.score == "dot":
            value = -(left * item / np.array([self.capacity.tokens, self.capacity.docs, self.capacity.cost])) @ self._weights
        else:
            value = (left - item) ** 2 @ self._weights
        return [fitting[k] for k in np.argsort(value, kind="stable")]


def plan(counts: dict[int, int], capacity: Capacity = Capacity()) -> tuple[dict[str, np.ndarray], int]:
    """Pack ``counts[length]`` pieces of each length; the plan's columns and the number of sequences.

    Placing pieces of one length one at a time, a norm score fills a sequence as far as it goes before
    it takes the next of the class, and a dot product takes one piece to each of the class in turn;
    whole classes are placed in these steps. The plan has one row per step: a sequence holds fewer
    than ``sqrt(2 * tokens)`` different lengths, and each length splits at most a few classes.
    """
    if capacity.score not in ("norm", "dot"):
        raise ValueError("score is norm or dot")
    if counts and capacity.most(max(counts)) < 1:
        raise ValueError("a piece is larger than a sequence")
    opened, out, bins = _Open(capacity), [], 0
    alone = capacity.score == "dot"

    def left_of(left: tuple[int, int, int], length: int, n: int) -> tuple[int, int, int]:
        return left[0] - n * length, left[1] - n, left[2] - n * length * length

    def place(length: int, low: int, left: tuple[int, int, int], first: int, count: int, per: int) -> int:
        out.append((length, low, per, first, capacity.tokens - left[0]))
        opened.put(left_of(left, length, per), first, count)
        return low + count * per

    for length in sorted(counts, reverse=True):
        low, total = 0, counts[length]
        while low < total:
            classes = opened.ranked(length)
            if not classes:
                # A new sequence is filled with this length before another is opened.
                new, per = (capacity.tokens, capacity.docs, capacity.cost), capacity.most(length)
                full = (total - low) // per
                if full:
                    low = place(length, low, new, bins, full, per)
                    bins += full
                if low < total:
                    low = place(length, low, new, bins, 1, total - low)
                    bins += 1
                continue
            for left in classes:
                while left in opened.ranges and low < total:
                    per = 1 if alone else min(capacity.most(length, left), total - low)
                    first, count = opened.take(left, max(1, (total - low) // per))
                    low = place(length, low, left, first, count, per)
                if low == total or alone:
                    break
    columns = np.array(sorted(out), dtype=np.int64).reshape(-1, len(PLAN)).T
    return dict(zip(PLAN, columns)), bins


def _pieces(path: str, end_id: int, most: int) -> Callable:
    """Per piece: id, its number, its start, length and crc32; long texts go through in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = tokenizer(path), np.array([end_id], dtype="<u4")
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows: list[tuple[int | None, int, int, int, int]] = []
            for k, parts in own.texts(batch.column(1)):
                length, crc, start, piece = 0, 0, 0, 0
                for part in [*(p for p in parts if p.size), end]:
                    raw, at = memoryview(np.ascontiguousarray(part)).cast("B"), 0
                    while at < part.size:
                        n = min(most - length, part.size - at)
                        crc, length, at = zlib.crc32(raw[4 * at : 4 * (at + n)], crc), length + n, at + n
                        if length == most:
                            rows.append((ids[k], piece, start, length, crc))
                            length, crc, start, piece = 0, 0, start + most, piece + 1
                if length:
                    rows.append((ids[k], piece, start, length, crc))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["id", "piece", "start", "length", "ids_crc32"])

    return run


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Every text's ids, with ``end_id`` behind them, in pieces of ``max_tokens``; only the last may be shorter."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return mapped(rows, _pieces(tokenizer_path, end_id, max_tokens), "id long, piece int, start long, length long, ids_crc32 long")


def packed(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, capacity: Capacity = Capacity()) -> DataFrame:
    """Pack every text; per piece ``id, piece, start, length, ids_crc32, sequence_id, offset``.

    Pieces in a sequence follow one another without gaps from offset 0. A null or empty text is its
    end id alone. Rows with equal ids, null ids among them, are documents of their own. Texts of any
    length go through in parts. Pieces of one length are placed in order of id, piece and crc32, so
    reruns agree. An empty table gives an empty one; other columns are ignored.
    """
    spark = docs.sparkSession
    found = saved(pieces(docs, tokenizer_path, id_col, text_col, end_id, capacity.tokens), "pack-pieces")
    counts = {r.length: r.n for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    ranges, _ = plan(counts, capacity)
    # Length and place as one number, so that one search finds a piece's range.
    key = (ranges["length"] << 48) + ranges["low"]
    shared = spark.sparkContext.broadcast((key, ranges["per"], ranges["bin"], ranges["offset"], ranges["low"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, per, bins, offset, low = shared.value
        for batch in batches:
            length, i = (batch.column(c).to_numpy() for c in ("length", "i"))
            at = np.searchsorted(key, (length << 48) + i, side="right") - 1
            row, each = i - low[at], per[at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")), pa.array(bins[at] + row // each), pa.array(offset[at] + row % each * length)],
                names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    placed = ranked(found, ["length"], ["id", "piece", "ids_crc32"], "pack-ranked")
    return mapped(placed, run, "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
