"""Token ids as files: an adaptive context-mixing range coder in independently reset, checksummed blocks.

A file is a sequence of frames. A frame holds whole documents: their ids and lengths, then their
token ids in blocks of ``BLOCK`` tokens. Each block starts from the same model, so any block can be
decoded alone, and carries the crc32 of its ids.

Per token the model makes three predictions: the id that last followed the two ids before (order 2),
the id that last followed the id before (order 1), and a distribution over all ids (order 0), which
the frame's header holds. Which of the first two is right, or neither, is one symbol. Its
probabilities are a mixture of two adaptive tables, one indexed by the confidence of order 2 and one
by that of order 1, with a weight per block that moves to the table which predicted better. An id
that neither predicted is coded by the order-0 distribution, which counts what blocks see for the
first time. A carry-propagating range coder with 64-bit state writes 32-bit words. The blocks of a
frame are coded side by side in numpy.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import mapped, saved
from sluice.llm.tokenizing import whole_texts
from sluice.runtime import scratch_dir

BLOCK = 2048
#: Blocks coded side by side; a frame holds at most so many, unless one document alone is longer.
LANES = 4096
MAGIC = b"CMRC0002"
_CELLS = 512
_U = np.uint64
_TOP = _U(1 << 32)
_32 = _U(32)
#: An event table entry holds the cumulative frequencies of events 0 and 1 as 16-bit fields; event 2
#: is an id that neither context predicted. They sum to _UNIT; _FLOOR is added per event when coding,
#: so none becomes impossible.
_EVENTS, _FIELD_COUNT = 3, 2
_UNIT, _FLOOR, _RATE = 1 << 13, 16, np.uint32(5)
_TOTAL = _UNIT + _EVENTS * _FLOOR
_FIELDS = sum(1 << 16 * i for i in range(_FIELD_COUNT))
_START = np.uint32(sum(_UNIT * (i + 1) // _EVENTS << 16 * i for i in range(_FIELD_COUNT)))
_CEIL, _STEP = np.uint32(31 * _FIELDS), np.uint32(0x07FF * _FIELDS)
_MIXED = np.uint32(0x3FFF * _FIELDS)
_GAIN = np.array([sum(_UNIT >> 5 << 16 * i for i in range(_FIELD_COUNT) if i >= e) for e in range(_EVENTS)], dtype=np.uint32)
#: Multipliers of the ids before in the number of a cell, modulo 2**16.
_SPREAD, _SPREAD_2 = np.uint16(40503), np.uint16(2654435761 & 0xFFFF)
#: Where an id of the order-0 distribution starts, and its share, packed into one number with the id.
_SHARE = _U(19)
_LOW = _U((1 << 19) - 1)
_BASE = _U(sum(_FLOOR * (i + 1) << 16 * i for i in range(_FIELD_COUNT)) + (_TOTAL << 16 * _FIELD_COUNT))


class _Model:
    """State of all blocks of a frame: prediction tables, event tables, mixing weights.

    Arrays of two rows hold what order 2 and order 1 say, in that order.
    """

    def __init__(self, lanes: int):
        self.table = np.full(2 * lanes * _CELLS, -8, dtype=np.int32)
        self.events = np.full(lanes * 24, _START)
        self.weight = np.full(lanes, 16, dtype=np.int8)
        self.p1 = np.zeros(lanes, dtype=np.uint16)
        self.p2 = np.zeros(lanes, dtype=np.uint16)
        lane = np.arange(lanes, dtype=np.int64)
        self.cell = np.stack([lane, lane + lanes]) * _CELLS
        self.k2, self.k1 = lane * 8, lane * 16 + lanes * 8

    def predict(self, n: int) -> np.ndarray:
        """Predicted ids (``guess``) and the mixed cumulative frequencies of the first ``n`` blocks."""
        # Cells are bits 7 to 15 and 3 to 11 of the products, so 16 bits of them are enough.
        p1 = self.p1[:n] * _SPREAD
        self.at = np.empty((2, n), dtype=np.int64)
        np.add(self.p1[:n] * _SPREAD_2 + self.p2[:n] * _SPREAD >> 7, self.cell[0, :n], out=self.at[0])
        np.add(p1 >> 3 & (_CELLS - 1), self.cell[1, :n], out=self.at[1])
        self.old = self.table.take(self.at)
        self.guess, self.sure = self.old >> 3, self.old & 7
        self.place = np.empty((2, n), dtype=np.int64)
        np.add(self.sure[0], self.k2[:n], out=self.place[0])
        np.add((self.sure[1] << 1) + (self.guess[0] == self.guess[1]), self.k1[:n], out=self.place[1])
        self.freq = self.events.take(self.place)
        w = (self.weight[:n] >> 3).astype(np.uint32)
        return ((self.freq[0] * w + self.freq[1] * (np.uint32(4) - w) >> np.uint32(2)) & _MIXED) + _BASE

    def learn(self, n: int, ids: np.ndarray, hit: np.ndarray, event: np.ndarray) -> None:
        """Move the weight to the table that saw order 2 better, then count the event and the id."""
        first = self.freq.astype(np.uint16)
        right = (first[0] > first[1]) == hit[0]
        weight = self.weight[:n]
        weight += (right.view(np.int8) << 1) - 1
        np.minimum(weight, 31, out=weight)
        np.maximum(weight, 8, out=weight)
        self.events[self.place] = self.freq - ((self.freq + _CEIL >> _RATE) & _STEP) + _GAIN.take(event)
        # No branches: a miss takes the id in where it was not sure, else less sure; a hit is surer.
        fresh = ids << 3
        missed = fresh ^ ((fresh ^ self.old - 2) & (1 - self.sure >> 31))
        self.table[self.at] = missed ^ ((missed ^ self.old - (self.sure - 7 >> 31)) & -hit.astype(np.int32))
        self.p2[:n] = self.p1[:n]
        self.p1[:n] = ids


def _event_range(cum: np.ndarray, event: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and frequency of each block's event."""
    at = (event << 4).view(np.uint64)
    low = (cum << _U(16) >> at) & _U(0xFFFF)
    return low, ((cum >> at) & _U(0xFFFF)) - low


def _lanes(n: int) -> tuple[int, np.ndarray]:
    """Blocks of a frame of ``n`` tokens, and the length of each; only the last may be shorter."""
    lanes = max(1, -(-n // BLOCK))
    size = np.full(lanes, BLOCK)
    size[-1] = n - BLOCK * (lanes - 1)
    return lanes, size


def _bits(vocabulary: int) -> int:
    bits = max(16, int(vocabulary - 1).bit_length())
    if bits > 18:
        raise ValueError("ids of more than 18 bits are not supported")
    return bits


def _order0(ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids of a frame and their order-0 frequencies, at least 1 each, ``2**bits`` in all.

    An id counts once for every block it occurs in: that is how often no context can know it yet.
    """
    blocks = np.zeros(1 << bits, dtype=np.int64)
    for lo in range(0, ids.size, BLOCK):
        # An id that repeats in the index is still written once.
        blocks[ids[lo : lo + BLOCK].astype(np.int64)] += 1
    distinct = np.flatnonzero(blocks)
    count = blocks[distinct]
    if not distinct.size:
        return distinct.astype("<u4"), count.astype("<u4")
    room = (1 << bits) - distinct.size
    share = count * room // int(count.sum())
    share[np.argmax(count)] += room - int(share.sum())
    return distinct.astype("<u4"), (share + 1).astype("<u4")


def encode(ids: np.ndarray, vocabulary: int = 65536) -> bytes:
    """One frame's ids as bytes.

    Magic, bits of the order-0 total, block size, token count, the packed order-0 table, then per
    block its number of words and its crc32, and the words of all blocks.
    """
    ids = np.ascontiguousarray(ids, dtype=np.uint32)
    n, bits = ids.size, _bits(vocabulary)
    if n and int(ids.max()) >= 1 << bits:
        raise ValueError("an id lies outside the vocabulary")
    lanes, size = _lanes(n)
    padded = np.zeros(lanes * BLOCK, dtype=np.int32)
    padded[:n] = ids
    steps = np.ascontiguousarray(padded.reshape(lanes, BLOCK).T)
    distinct, share = _order0(ids, bits)
    # By id; the last entry is for ids that a context predicted, which have all of their event.
    share_of = np.zeros((1 << bits) + 1, dtype=np.uint64)
    share_of[distinct] = ((np.cumsum(share, dtype=np.uint64) - share) << _SHARE) + share
    share_of[-1] = 1 << bits
    model = _Model(lanes)
    low = np.zeros(lanes, dtype=np.uint64)
    span = np.full(lanes, ~_U(0), dtype=np.uint64)
    # Row by row a word of each block, as blocks fill about evenly.
    out = np.empty((BLOCK + 3) * lanes, dtype=np.uint32)
    at = np.arange(lanes, dtype=np.int64)
    total, scale, known = _U(_TOTAL << bits), _U(bits), np.int32(1 << bits)
    for t in range(int(size[0])):
        m = lanes if t < size[-1] else lanes - 1
        token = steps[t, :m]
        cum = model.predict(m)
        hit = token == model.guess
        missed = ~hit
        event = ((missed[1].view(np.int8) + np.int8(1)) * missed[0]).astype(np.int64)
        start, unit = _event_range(cum, event)
        step = span[:m] // total
        unit *= step
        packed = share_of.take((token - known) * (event == 2) + known)
        moved = low[:m] + ((start << scale) * step + (packed >> _SHARE) * unit)
        carry = (moved < low[:m]).nonzero()[0]
        if carry.size:
            back = at[carry] - lanes
            while back.size:
                out[back] += np.uint32(1)
                back = back[out[back] == 0] - lanes
        width = (packed & _LOW) * unit
        full = (width < _TOP).nonzero()[0]
        ready, there = moved[full], at[full]
        out[there] = ready >> _32
        at[full] = there + lanes
        moved[full] = ready << _32
        width[full] <<= _32
        low[:m], span[:m] = moved, width
        model.learn(m, token, hit, event)
    for shift in (32, 0):
        out[at] = (low >> _U(shift)) & _U(0xFFFFFFFF)
        at += lanes
    used = at // lanes
    raw = ids.astype("<u4").tobytes()
    sums = np.array([zlib.crc32(raw[4 * i : 4 * (i + BLOCK)]) for i in range(0, max(n, 1), BLOCK)], dtype="<u4")
    table = zlib.compress(np.diff(distinct.astype("<i8"), prepend=0).astype("<u4").tobytes() + share.tobytes())
    head = MAGIC + np.array([bits, BLOCK], dtype="<u4").tobytes() + np.array([n], dtype="<u8").tobytes()
    head += np.array([len(table)], dtype="<u4").tobytes() + table
    rows = np.ascontiguousarray(out.reshape(-1, lanes)[: int(used.max())].T)
    words = b"".join(row[:k].astype("<u4").tobytes() for row, k in zip(rows, used.tolist()))
    return head + used.astype("<u4").tobytes() + sums.tobytes() + words


def decode(data: bytes) -> np.ndarray:
    """The ids of one frame; a wrong magic or a block whose crc32 differs is an error."""
    if data[:8] != MAGIC:
        raise ValueError("not a frame of token ids")
    bits, block = (int(x) for x in np.frombuffer(data, "<u4", 2, 8))
    n = int(np.frombuffer(data, "<u8", 1, 16)[0])
    if block != BLOCK:
        raise ValueError("frame has another block size")
    packed = int(np.frombuffer(data, "<u4", 1, 24)[0])
    try:
        table = np.frombuffer(zlib.decompress(data[28 : 28 + packed]), "<u4").reshape(2, -1)
    except zlib.error as err:
        raise ValueError("the frame's order-0 table is damaged") from err
    distinct, share = np.cumsum(table[0], dtype=np.uint64), table[1].astype(np.uint64)
    if n and int(share.sum()) != 1 << bits:
        raise ValueError("the frame's order-0 table is damaged")
    # By place in the distribution; the last entry is for ids that a context predicted.
    whole = np.array([1 << bits], dtype=np.uint64)
    share_of = np.concatenate([np.repeat((distinct << _SHARE * _U(2)) + ((np.cumsum(share) - share) << _SHARE) + share, share.astype(np.int64)), whole])
    lanes, size = _lanes(n)
    at = 28 + packed
    used = np.frombuffer(data, "<u4", lanes, at).astype(np.int64)
    sums = np.frombuffer(data, "<u4", lanes, at + 4 * lanes)
    words = np.frombuffer(data, "<u4", int(used.sum()), at + 8 * lanes)
    words = np.concatenate([words, np.zeros(4, dtype=np.uint32)]).astype(np.uint64)
    at = np.concatenate([[0], np.cumsum(used)[:-1]])
    code = (words[at] << _32) | words[at + 1]
    at = at + 2
    span = np.full(lanes, ~_U(0), dtype=np.uint64)
    model = _Model(lanes)
    total, most, scale = _U(_TOTAL << bits), _U((_TOTAL << bits) - 1), _U(bits)
    last, known = _U((1 << bits) - 1), 1 << bits
    steps = np.zeros((BLOCK, lanes), dtype=np.uint32)
    for t in range(int(size[0])):
        m = lanes if t < size[-1] else lanes - 1
        cum = model.predict(m)
        step = span[:m] // total
        value = np.minimum(code[:m] // step, most)
        mark = value >> scale
        beyond = mark >= (cum & _U(0xFFFF))
        event = (beyond.view(np.int8) + (mark >= (cum >> _U(16) & _U(0xFFFF)))).astype(np.int64)
        start, unit = _event_range(cum, event)
        start <<= scale
        spelled = event == 2
        # Where a block is damaged the value may point anywhere; its sum will tell.
        entry = np.minimum((value - start) // np.maximum(unit, _U(1)), last)
        packed = share_of.take((entry.view(np.int64) - known) * spelled + known)
        token = model.guess[0] + (model.guess[1] - model.guess[0]) * beyond
        token += ((packed >> _SHARE * _U(2)).astype(np.int32) - token) * spelled
        unit *= step
        rest = code[:m] - (start * step + ((packed >> _SHARE) & _LOW) * unit)
        width = (packed & _LOW) * unit
        full = (width < _TOP).nonzero()[0]
        there = at[full]
        rest[full] = (rest[full] << _32) | words.take(there, mode="clip")
        at[full] = there + 1
        width[full] <<= _32
        code[:m], span[:m] = rest, width
        steps[t, :m] = token
        model.learn(m, token, token == model.guess, event)
    ids = np.ascontiguousarray(steps.T).reshape(-1)[:n]
    raw = ids.astype("<u4").tobytes()
    for i in range(lanes):
        if zlib.crc32(raw[4 * i * BLOCK : 4 * (i + 1) * BLOCK]) != int(sums[i]):
            raise ValueError(f"block {i} is damaged")
    return ids


def _frames(path: str, end_id: int, by_words: bool, vocabulary: int) -> Callable:
    def run(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        end = np.array([end_id], dtype=np.uint32)
        docs, parts, sizes, held, frame, first = [], [], [], 0, 0, 0

        def flush():
            nonlocal docs, parts, sizes, held, frame, first
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()), pa.array([frame], pa.int32()), pa.array([first], pa.int64()), pa.array([docs], pa.list_(pa.int64())),
                    pa.array([np.array(sizes, dtype="<i8").tobytes()], pa.binary()), pa.array([encode(np.concatenate(parts), vocabulary)], pa.binary()),
                ],
                names=["shard", "frame", "first", "docs", "sizes", "payload"],
            )
            first, frame, docs, parts, sizes, held = first + held, frame + 1, [], [], [], 0
            return row

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for k, tokens in whole_texts(batch.column(1), path, by_words):
                if held and held + tokens.size + 1 > BLOCK * LANES:
                    yield flush()
                docs.append(ids[k])
                parts += [tokens, end]
                sizes.append(tokens.size + 1)
                held += tokens.size + 1
        if held:
            yield flush()

    return run


def write_tokens(
    docs: DataFrame, tokenizer_path: str, path: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = 1, by_words: bool = True, vocabulary: int = 65536, shards: int | None = None,
) -> None:
    """Write the ids of every text, in ascending order of an integer id, as frames under ``path``.

    A null text is empty; every document ends with ``end_id``, so an empty one has that id alone. Rows
    with equal ids follow one another in the order of their texts; null ids come first. A long text is
    encoded whole; one of more than ``BLOCK * LANES`` tokens has a frame to itself. An empty table
    writes no frames. Other columns are ignored. The folder holds Parquet files whose rows are frames
    (``payload``) with the ids and lengths of their documents; Spark commits each task's file once.
    Ids have at most 18 bits; a larger ``vocabulary`` is an error.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if shards is None:
        shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(shards, "id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"), "text")
    schema = "shard int, frame int, first long, docs array<long>, sizes binary, payload binary"
    mapped(ordered, _frames(tokenizer_path, end_id, by_words, vocabulary), schema).write.parquet(path)


def read_tokens(spark, path: str, with_ids: bool = False) -> DataFrame:
    """Per document of the files under ``path``: ``id, shard, at, n_tokens, ids_crc32`` and, if asked, ``ids``.

    ``at`` counts the ids before the document in its shard. Blocks are checked against their sums.
    """
    schema = "id long, shard int, at long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                sizes = np.frombuffer(r["sizes"], "<i8")
                raw = decode(r["payload"]).astype("<u4").tobytes()
                cut = np.concatenate([[0], np.cumsum(sizes)])
                own = [raw[4 * a : 4 * b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
                columns = [
                    pa.array(r["docs"], pa.int64()), pa.array([r["shard"]] * sizes.size, pa.int32()), pa.array(cut[:-1] + r["first"], pa.int64()),
                    pa.array(sizes, pa.int64()), pa.array([zlib.crc32(x) for x in own], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(x, "<i4") for x in own], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "shard", "at", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    frames = spark.read.schema("shard int, frame int, first long, docs array<long>, sizes binary, payload binary").parquet(path)
    # A frame is a few megabytes: few rows at a time reach Python, and frames are dealt over all tasks.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return mapped(frames.repartition(tasks, "shard", "frame"), run, schema)


def token_index(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from files written and read back."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "llm-tokens")
    write_tokens(docs, tokenizer_path, path, id_col, text_col, **options)
    found = saved(read_tokens(spark, path), "token-index")
    # One row per shard, so the running sum over shards is small.
    totals = found.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    return found.join(before, "shard").select(F.col("id").alias("doc_id"), (F.col("at") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
