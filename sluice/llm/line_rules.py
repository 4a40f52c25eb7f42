"""Quality rules with cross-document line frequency.

Lines are normalised (case of A-Z, digits, white space) and hashed. Per host the distinct documents of
each line are counted; lines above the limits are boilerplate and go. A document that fails the plain
rules, or that loses more than a share of its words with its boilerplate, is rejected.

A copy of a document says nothing about its lines, so documents are counted by a print, the hash of
their whole text: texts that are equal to the byte count once on a host, all others each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import SLICE_BYTES, Running, Words, mapped, mix, powers, saved, text_slices

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_DIGITS = np.arange(256, dtype=np.uint8)
_DIGITS[48:58] = 48
_STEP, _BACK = 0xD1342543DE82EF95, pow(0xD1342543DE82EF95, -1, 1 << 64)


def _line_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every line between line feeds; an empty text has one empty line."""
    feed = np.flatnonzero(data == 10)
    owner = np.searchsorted(bounds, feed, side="right") - 1
    start = np.sort(np.concatenate([bounds[:-1], feed + 1]), kind="stable")
    row = np.sort(np.concatenate([np.arange(bounds.size - 1), owner]), kind="stable")
    last = np.ones(row.size, dtype=bool)
    last[:-1] = row[1:] != row[:-1]
    end = np.empty_like(start)
    end[:-1] = start[1:] - 1
    end[last] = bounds[1:][row[last]]
    return start, end, row


class _Lines:
    """Counts of the plain rules and hashes of normalised lines for a slice of documents.

    A single document that is longer than a slice is taken in parts that end behind a line feed; what
    is kept of all parts is a hash per word and per line. A longer line stays whole.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        n = bounds.size - 1
        parts = [_Part(d, b) for d, b in _parts(data, bounds)]
        for p in parts[:-1]:
            p.drop_rest()
        joined = lambda name: np.concatenate([getattr(p, name) for p in parts])
        added = lambda name: np.add.reduce([getattr(p, name) for p in parts])
        offset = np.cumsum([0] + [p.size for p in parts[:-1]])
        self.start, self.end = (np.concatenate([getattr(p, name) + o for p, o in zip(parts, offset)]) for name in ("start", "end"))
        self.row, self.line_words, self.hash, raw = (joined(x) for x in ("row", "line_words", "hash", "raw"))
        self.n_words, self.word_chars, self.n_symbols = (added(x) for x in ("n_words", "word_chars", "n_symbols"))
        full = self.line_words > 0
        pairs = mix(raw + self.row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, once = np.unique(pairs[full], return_index=True)
        self.n_dup_lines = np.bincount(self.row[full], minlength=n) - np.bincount(self.row[full][once], minlength=n)
        self.n_repeat = self._repeats(joined("words"), joined("word_row"), n)

    @staticmethod
    def _repeats(h: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        """Words inside three-word windows that occur twice or more in their text."""
        m = max(0, h.size - 2)
        gram = mix(h[:m] + h[1 : m + 1] * np.uint64(0xA0761D6478BD642F) + h[2:] * np.uint64(0xE7037ED1A0B428DB) if m else h[:0])
        inside = row[:m] == row[2:] if m else np.zeros(0, dtype=bool)
        at = np.flatnonzero(inside)
        key = mix(gram[at] + row[at].astype(np.uint64) * np.uint64(0x8EBC6AF09C88C6E3))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(at.size, dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = np.zeros(h.size, dtype=bool)
        for j in range(3):
            hit[at[twice] + j] = True
        return np.bincount(row[hit], minlength=n)


class _Part:
    """What a part of the bytes says: counts per document, hashes per word and per line."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        n, self.size = bounds.size - 1, data.size
        words = Words(data, bounds)
        self.n_words, self.word_row = words.count, words.row
        solid = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        self.word_chars = np.bincount(words.row, solid[words.end] - solid[words.start], minlength=n).astype(np.int64)
        marks = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
        self.n_symbols = marks[bounds[1:]] - marks[bounds[:-1]]
        self.start, self.end, self.row = _line_bounds(data, bounds)
        first = np.searchsorted(words.start, self.start)
        last = np.searchsorted(words.start, self.end)
        self.line_words = last - first
        self.raw = mix(Running(data).span(self.start, self.end) + (self.end - self.start).astype(np.uint64))
        own = Words(_DIGITS[data], bounds).hashes()
        total = np.zeros(own.size + 1, dtype=np.uint64)
        np.cumsum(own * powers(_STEP, own.size)[: own.size], out=total[1:])
        self.hash = mix((total[last] - total[first]) * powers(_BACK, own.size)[first] + self.line_words.astype(np.uint64))
        self.words = words.hashes(fold=False)

    def drop_rest(self) -> None:
        """Drop the empty rest behind the last line feed: the line there begins in the next part."""
        for name in ("start", "end", "row", "line_words", "raw", "hash"):
            setattr(self, name, getattr(self, name)[:-1])


def _parts(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and bounds: all of a slice, or a longer document in parts that end behind a line feed."""
    if data.size <= SLICE_BYTES or bounds.size != 2:
        yield data, bounds
        return
    lo = 0
    while lo < data.size:
        hi = min(lo + SLICE_BYTES, data.size)
        while hi < data.size and data[hi - 1] != 10:
            feed = np.flatnonzero(data[hi : hi + SLICE_BYTES] == 10)
            hi = hi + int(feed[0]) + 1 if feed.size else min(hi + SLICE_BYTES, data.size)
        yield data[lo:hi], np.array([0, hi - lo])
        lo = hi


def _measure(batches):
    for batch in batches:
        for lo, hi, data, bounds in text_slices(batch.column(2)):
            x = _Lines(data, bounds)
            hashes, counts = [], []
            edge = np.searchsorted(x.row, np.arange(hi - lo + 1))
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                full = x.line_words[a:b] > 0
                line, back = np.unique(x.hash[a:b][full], return_inverse=True)
                hashes.append(line.view(np.int64))
                counts.append(np.bincount(back, x.line_words[a:b][full], minlength=line.size).astype(np.int64))
            part = batch.slice(lo, hi - lo)
            longs = [x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(3), part.column(4), *(pa.array(c, pa.int64()) for c in longs), *(pa.array(c, pa.list_(pa.int64())) for c in (hashes, counts))],
                names=["id", "host", "tag", "print", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line", "words"],
            )


def _rules(docs: DataFrame, id_col: str, text_col: str, host_col: str, least_documents: int, least_share: float) -> tuple[DataFrame, DataFrame]:
    """Measures per row, and the boilerplate ``(id, tag, line, words)`` of each document."""
    kinds = [docs.schema[c].dataType.simpleString() for c in (id_col, host_col)]
    rows = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.col(text_col).alias("text"), F.xxhash64(id_col, host_col, text_col).alias("tag"), F.xxhash64(text_col).alias("print"))
    longs = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    found = saved(mapped(rows, _measure, f"id {kinds[0]}, host {kinds[1]}, tag long, print long, {longs}, line array<long>, words array<long>"), "lines")
    # A tag names equal rows, which count once.
    lines = found.select("host", "tag", "print", F.explode(F.arrays_zip("line", "words")).alias("l")).select("host", "tag", "print", "l.line", "l.words")
    key = F.xxhash64(F.coalesce(F.col("host").cast("string"), F.lit("")), F.col("host").isNull(), "line")
    lines = lines.withColumn("key", key)
    # Two steps, each added up before its shuffle, so a line of all documents is no hot group.
    seen = lines.groupBy("key", "host", "print").agg(F.lit(1).alias("one")).groupBy("key", "host").agg(F.count("*").alias("n"))
    per_host = found.groupBy("host").agg(F.count_distinct("print").alias("documents")).withColumnRenamed("host", "h")
    above = seen.join(per_host, F.col("host").eqNullSafe(F.col("h"))).where((F.col("n") > least_documents) & (F.col("n") > F.col("documents") * least_share)).select("key", "n")
    gone = lines.join(above, "key").select("tag", "line", "words", "n").distinct()
    return found, gone


def judged(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    least_documents: int = 10, least_share: float = 0.002, most_lost: float = 0.5, least_words: int = 50, most_repeat: float = 0.5,
) -> DataFrame:
    """Per row: ``id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost_words, kept``.

    A line is boilerplate on its host when more than ``least_documents`` documents and more than
    ``least_share`` of the host's have it, equal texts counted once in both. A document is rejected if it fails a plain rule or its
    boilerplate holds more than ``most_lost`` of its words. A null text has no words and fails; a null
    host is a host of its own; equal rows are given alike; an empty table
    gives no rows; further columns are ignored.
    """
    found, gone = _rules(docs, id_col, text_col, host_col, least_documents, least_share)
    lost = gone.groupBy("tag").agg(F.sum("words").alias("lost"))
    failed = (F.col("n_words") < least_words) | (F.col("n_repeat_words") > F.col("n_words") * F.lit(most_repeat))
    out = found.join(lost, "tag", "left").withColumn("lost_words", F.coalesce("lost", F.lit(0))).withColumn("base_failed", failed)
    return out.select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost_words",
        (~F.col("base_failed") & (F.col("lost_words") <= F.col("n_words") * F.lit(most_lost))).alias("kept"),
    )


def without_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", least_documents: int = 10, least_share: float = 0.002) -> DataFrame:
    """``docs`` in all their columns with boilerplate lines cut out of ``text_col``."""
    _, gone = _rules(docs, id_col, text_col, host_col, least_documents, least_share)
    cut = gone.groupBy("tag").agg(F.collect_set("line").alias("cut"))
    both = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text_col].alias("text"), F.xxhash64(id_col, host_col, text_col).alias("tag")).join(cut, "tag", "left")

    def clean(batches):
        for batch in batches:
            for lo, hi, data, bounds in text_slices(batch.column(0)):
                x = _Lines(data, bounds)
                edge = np.searchsorted(x.row, np.arange(hi - lo + 1))
                texts = []
                for r, drop in enumerate(batch.column(1).slice(lo, hi - lo).to_pylist()):
                    a, b = edge[r], edge[r + 1]
                    keep = ~np.isin(x.hash[a:b].view(np.int64), drop or []) | (x.line_words[a:b] == 0)
                    texts.append("\n".join(data[s:e].tobytes().decode() for s, e in zip(x.start[a:b][keep], x.end[a:b][keep])))
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column(2).slice(lo, hi - lo)], names=["text", "row"])

    schema = both.select("text", "row").schema
    cleaned = mapped(both.select("text", "cut", "row"), clean, schema)
    return cleaned.select(*[F.when(F.col(f"row.`{c}`").isNotNull(), F.col("text")).alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
