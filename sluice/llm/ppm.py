"""Prediction by partial matching: byte-context trie with escapes and symbol exclusion.

The trie is counted over all training texts: which byte follows each context of up to ``ORDER`` bytes.
A byte is coded in the longest known context; where it was never seen there, an escape is coded and the
next shorter context is asked, with all symbols of the longer one excluded. Escapes follow method C: as
many counts as the context has distinct symbols left. A symbol unknown everywhere is one of the rest.

No count is left out. Contexts of up to two bytes (at most 2**24 entries) are sent to every task; the
longer ones stay tables dealt by their last three bytes, which all contexts of a byte share, so one
task has all that codes it. Texts are cut into slices of some megabytes. A slice asks for its distinct
windows, each once, with the times it trains on them; the task that holds their contexts adds up the
counts of all slices, codes each window once, and answers; the slice adds up its texts from that.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import LOWER, Words, crc_bucket, dropped, mapped, mix, release, saved, text_slices

ORDER = 6
#: Stands before a text and ends it; no UTF-8 text has this byte.
EDGE = 255
_U = np.uint64
_CACHE = 1 << 20
#: Bytes of text scored at once; each takes about 80 bytes of working arrays.
_SCORED = 1 << 19
#: Longest order that every task has whole.
_SHORT = 2
#: Bytes of text that ask together, and windows that are answered together.
_ASKED, _ANSWERED = 32 << 20, 1 << 19
#: Least number of shares of the contexts; beyond it, one for so many bytes of text.
_SHARES, _SHARE = 1 << 13, 4 << 20


def windows(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of each lower-cased text and its end: the ORDER bytes before it and itself, as a number.

    Returns them in order, and where each text begins among them.
    """
    n = bounds.size - 1
    out = np.full(data.size + n * (ORDER + 1), EDGE, dtype=np.uint8)
    first = bounds[:-1] + np.arange(n) * (ORDER + 1) + ORDER
    at = np.arange(data.size) + np.repeat(first - bounds[:-1], np.diff(bounds))
    out[at] = LOWER[data]
    key = np.zeros(out.size - ORDER if n else 0, dtype=np.uint64)
    for j in range(ORDER + 1):
        key = (key << _U(8)) | out[j : j + key.size]
    # Each text has one window per byte and one for its end; the padding before the next has none.
    size = np.diff(bounds) + 1
    start = first - ORDER
    here = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    return key[here], np.cumsum(size) - size


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if keys.size else np.zeros(0, dtype=np.int64)
    return keys[first], np.add.reduceat(n, first) if keys.size else n


def _count(batches):
    """Windows of the order that every task has."""
    held, size = [], 0
    for batch in batches:
        for _, _, data, bounds in text_slices(batch.column(0)):
            key, n = np.unique(windows(data, bounds)[0] & _U((1 << 8 * (_SHORT + 1)) - 1), return_counts=True)
            held.append((key, n))
            size += key.size
            if size > 1 << 21:
                held = [_merge(held)]
                size = held[0][0].size
    if held:
        key, n = _merge(held)
        yield pa.RecordBatch.from_pydict({"key": key.view(np.int64), "n": n})


def _narrow(x: np.ndarray) -> np.ndarray:
    """Counts in four bytes each, where the largest of them fits."""
    return x.astype(np.int32) if x.max(initial=0) < 1 << 31 else x


class Trie:
    """Contexts of each order with their totals, distinct symbols and entries, all sorted by number."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]], below: Trie | None = None):
        """``levels``: per order the windows of its length and their counts, after the orders of ``below``.

        A window's end is in the order below.
        """
        self.entry, self.count, self.context, self.total, self.kinds, self.left = (list(x) for x in (
            (below.entry, below.count, below.context, below.total, below.kinds, below.left) if below else ([],) * 6))
        for key, n in levels:
            order = np.argsort(key)
            e, c = key[order], n[order].astype(np.int64)
            ctx, first = np.unique(e >> _U(8), return_index=True)
            self.entry.append(e)
            self.count.append(_narrow(c))
            self.context.append(ctx)
            self.total.append(_narrow(np.add.reduceat(c, first) if e.size else c))
            self.kinds.append(np.diff(np.append(first, e.size)).astype(np.int16))
        for o in range(len(self.left), len(self.entry)):
            # How many counts a context's symbols have in the next shorter context: what exclusion takes away there.
            if not o:
                self.left.append(np.zeros(self.context[0].size, dtype=np.int32))
                continue
            short = self.entry[o] & _U((1 << 8 * o) - 1)
            there = self.count[o - 1][np.searchsorted(self.entry[o - 1], short)].astype(np.int64) if short.size else np.zeros(0, np.int64)
            _, first = np.unique(self.entry[o] >> _U(8), return_index=True)
            self.left.append(_narrow(np.add.reduceat(there, first) if short.size else there))

    @staticmethod
    def _find(table: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Place of each number in a sorted table, -1 where it is not there."""
        if not table.size:
            return np.full(x.size, -1)
        at = np.minimum(np.searchsorted(table, x), table.size - 1)
        return np.where(table[at] == x, at, -1)

    def log_probability(self, window: np.ndarray) -> np.ndarray:
        """log10 of the probability of each window's last byte after the bytes before it."""
        out = np.zeros(window.size)
        open_ = np.ones(window.size, dtype=bool)
        gone_total = np.zeros(window.size, dtype=np.int64)
        gone_kinds = np.zeros(window.size, dtype=np.int64)
        for o in range(ORDER, -1, -1):
            ctx = self._find(self.context[o], window >> _U(8) & _U((1 << 8 * o) - 1))
            here = open_ & (ctx >= 0)
            at = np.flatnonzero(here)
            c = ctx[at]
            total, kinds = self.total[o][c] - gone_total[at], self.kinds[o][c] - gone_kinds[at]
            e = self._find(self.entry[o], window[at] & _U((1 << 8 * (o + 1)) - 1))
            seen = e >= 0
            whole = (total + kinds).astype(np.float64)
            out[at[seen]] += np.log10(self.count[o][e[seen]] / whole[seen])
            miss = ~seen & (kinds > 0)
            out[at[miss]] += np.log10(kinds[miss] / whole[miss])
            open_[at[seen]] = False
            gone_total[at] = self.left[o][c]
            gone_kinds[at] = self.kinds[o][c]
        out[open_] -= np.log10(np.maximum(256 - gone_kinds[open_], 1))
        return out


class _Scorer:
    """Sums of log probabilities per text, through a table of windows met before.

    ``code`` and ``value_of`` are the windows of the slice at hand, sorted, and their log probabilities.
    """

    def __init__(self):
        self.code, self.value_of = np.zeros(0, dtype=np.uint64), np.zeros(0)
        self.key = np.full(_CACHE, ~_U(0))
        self.value = np.zeros(_CACHE)

    def learn(self, codes: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Take over the answers of a slice, in as little memory as they need; empties ``codes``."""
        self.code = self.value_of = None
        key, value = np.concatenate([k for k, _ in codes]), np.concatenate([v for _, v in codes])
        codes.clear()
        order = np.argsort(key)
        self.code = key[order]
        del key
        self.value_of = value[order]

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        window, first = windows(data, bounds)
        slot = (window * _U(0x9E3779B97F4A7C15) >> _U(44)).view(np.int64)
        value = self.value.take(slot)
        miss = np.flatnonzero(self.key.take(slot) != window)
        if miss.size:
            new, back = np.unique(window[miss], return_inverse=True)
            found = self.value_of[np.searchsorted(self.code, new)]
            value[miss] = found[back]
            at = (new * _U(0x9E3779B97F4A7C15) >> _U(44)).view(np.int64)
            self.key[at], self.value[at] = new, found
        return np.add.reduceat(value, first) if first.size else np.zeros(0)


def short_orders(texts: DataFrame) -> Trie:
    """The orders up to ``_SHORT``, counted over all rows of ``texts`` (one column)."""
    rows = mapped(texts, _count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    key, n = rows["key"].to_numpy().astype(np.int64).view(np.uint64), rows["n"].to_numpy().astype(np.int64)
    return Trie([_suffixes(key, n, o) for o in range(_SHORT + 1)])


def _suffixes(key: np.ndarray, n: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of one order and their counts, from those of a longer one."""
    return _merge([(key & _U((1 << 8 * (order + 1)) - 1), n)])


def _sliced(batches):
    """Adds the number of a slice: neighbouring rows of a task, up to ``_ASKED`` bytes or one longer text."""
    number, size = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        for lo, hi, data, _ in text_slices(batch.column(3)):
            if size and size + data.size > _ASKED:
                number, size = number + 1, 0
            size += data.size
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(hi - lo, number))], names=["id", "tag", "held_out", "text", "slice"])


def _packed(x: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, which compresses well where they are sorted."""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(x.size, x.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, size: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(raw, decompressed_size=size * width, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(width, size).T).view(kind).ravel()


def _asked(shares: int):
    """Distinct windows of each slice and how often it trains on them, a record for each share of the contexts."""

    def records(number, held):
        key, n = _merge(held)
        share = (mix(key >> _U(8) & _U((1 << 8 * (_SHORT + 1)) - 1)) % _U(shares)).astype(np.int32)
        order = np.argsort(share, kind="stable")
        key, n, share = key[order], n[order].astype(np.int32), share[order]
        edge = np.append(np.flatnonzero(np.concatenate([[True], share[1:] != share[:-1]])), key.size)
        for lo in range(0, edge.size - 1, 1024):
            spans = list(zip(edge[lo : lo + 1024].tolist(), edge[lo + 1 : lo + 1025].tolist()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([share[a] for a, _ in spans], pa.int32()), pa.array([number] * len(spans), pa.int64()), pa.array([b - a for a, b in spans], pa.int32()),
                    pa.array([_packed(key[a:b]) for a, b in spans], pa.binary()), pa.array([_packed(n[a:b]) for a, b in spans], pa.binary()),
                ],
                names=["share", "slice", "size", "keys", "counts"],
            )

    def ask(batches):
        number, held, size = None, [], 0
        for batch in batches:
            slices, trains = batch.column(2).to_numpy(), ~np.asarray(batch.column(1))
            edge = np.append(np.flatnonzero(np.concatenate([[True], slices[1:] != slices[:-1]])) if slices.size else 0, slices.size)
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                if held and slices[a] != number:
                    yield from records(number, held)
                    held, size = [], 0
                number = int(slices[a])
                for lo, hi, data, bounds in text_slices(batch.column(0).slice(a, b - a), 1 << 20):
                    key = windows(data, bounds)[0]
                    learnt = np.repeat(trains[a + lo : a + hi], np.diff(bounds) + 1)
                    held.append(np.unique(key[learnt], return_counts=True))
                    other = np.unique(key[~learnt])
                    held.append((other, np.zeros(other.size, dtype=np.int64)))
                    size += held[-1][0].size + held[-2][0].size
                    if size > 1 << 21:
                        held, size = [_merge(held)], 0
        if held:
            yield from records(number, held)

    return ask


def _answered(below):
    """Log probabilities of the windows that slices ask for; records come share by share."""

    def answers(asked, held):
        key, n = _merge(held)
        learnt = n > 0
        trie = Trie([_suffixes(key[learnt], n[learnt], o) for o in range(_SHORT + 1, ORDER + 1)], below.value)
        value = np.concatenate([trie.log_probability(key[a : a + _ANSWERED]) for a in range(0, key.size, _ANSWERED)])
        for lo in range(0, len(asked), 256):
            part = asked[lo : lo + 256]
            found = [_packed(value[np.searchsorted(key, _unpacked(raw, size, np.uint64))]) for _, size, raw in part]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in part], pa.int64()), pa.array([x[1] for x in part], pa.int32()), pa.array([x[2] for x in part], pa.binary()), pa.array(found, pa.binary())],
                names=["slice", "size", "keys", "codes"],
            )

    def answer(batches):
        share, asked, held, size, taken = None, [], [], 0, 0
        for batch in batches:
            for own, number, count, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if own != share and taken > _ANSWERED:
                    yield from answers(asked, held)
                    asked, held, size, taken = [], [], 0, 0
                share = own
                asked.append((number, count, keys))
                held.append((_unpacked(keys, count, np.uint64), _unpacked(counts, count, np.int32).astype(np.int64)))
                size += count
                taken += count
                if size > 1 << 21:
                    held, size = [_merge(held)], 0
        if asked:
            yield from answers(asked, held)

    return answer


def _scored(batches):
    """Scores of texts; the answers of each slice come before its texts."""
    scorer, number, codes = _Scorer(), None, []
    for batch in batches:
        slices, sizes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        is_text = sizes == 0
        edge = np.append(np.flatnonzero(np.concatenate([[True], (slices[1:] != slices[:-1]) | (is_text[1:] != is_text[:-1])])) if slices.size else 0, slices.size)
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            if slices[a] != number:
                number, codes = slices[a], []
            part = batch.slice(a, b - a)
            if not is_text[a]:
                rows = zip(sizes[a:b].tolist(), part.column(2).to_pylist(), part.column(3).to_pylist())
                codes += [(_unpacked(k, n, np.uint64), _unpacked(v, n, np.float64)) for n, k, v in rows]
                continue
            if codes:
                scorer.learn(codes)
                codes = []
            for lo, hi, data, bounds in text_slices(part.column(7), _SCORED):
                own = part.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*own.columns[4:7], pa.array(Words(data, bounds).count + 1, pa.int64()), pa.array(scorer(data, bounds))], names=["id", "tag", "held_out", "n_tokens", "score"])


def _scores(rows: DataFrame) -> DataFrame:
    """``(id, tag, held_out, n_tokens, score)`` per row of ``(id, tag, held_out, text)``."""
    spark = rows.sparkSession
    kind = rows.schema["id"].dataType.simpleString()
    below = spark.sparkContext.broadcast(short_orders(rows.where("NOT held_out").select("text")))
    texts = saved(mapped(rows, _sliced, f"id {kind}, tag long, held_out boolean, text string, slice long"), "slices")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shares = max(_SHARES, 1 << (size // _SHARE).bit_length())
    asked = mapped(texts.select("text", "held_out", "slice"), _asked(shares), "share int, slice long, size int, keys binary, counts binary")
    asked = asked.repartition("share").sortWithinPartitions("share")
    codes = mapped(asked, _answered(below), "slice long, size int, keys binary, codes binary")
    # Answers have a size, texts have none and come after them.
    both = codes.unionByName(texts.withColumn("size", F.lit(0)), allowMissingColumns=True).select("slice", "size", "keys", "codes", "id", "tag", "held_out", "text")
    both = both.repartition("slice").sortWithinPartitions("slice", F.desc("size"))
    scored = saved(mapped(both, _scored, f"id {kind}, tag long, held_out boolean, n_tokens long, score double"), "scores")
    dropped(texts)
    return scored


def _words(batches):
    """Distinct words of each batch of rows with the rows that have them, packed: few wide records."""
    for batch in batches:
        tags, train = batch.column(1).to_numpy(), np.asarray(batch.column(2))
        held_h, held_r, size = [], [], 0
        lo_row = 0
        for lo, hi, data, bounds in text_slices(batch.column(0)):
            words = Words(data, bounds)
            held_h.append(words.hashes())
            held_r.append(words.row + lo)
            size += held_h[-1].size
            if size > 1 << 20 or hi == batch.num_rows:
                h, r = np.concatenate(held_h), np.concatenate(held_r) - lo_row
                order = np.lexsort((r, h))
                h, r = h[order], r[order]
                new = np.ones(h.size, dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, h.size))
                h, r = h[at], r[at] + lo_row
                edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if h.size else np.zeros(0, dtype=np.int64)
                bounds_ = np.append(edge, h.size)
                learnt = np.add.reduceat(times * train[r], edge) if h.size else edge
                pack = lambda x: pa.ListArray.from_arrays(pa.array(bounds_, pa.int32()), pa.array(x, pa.int64() if x.dtype == np.int64 else pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(h[edge].view(np.int64)), pa.array(learnt, pa.int64()), pack(tags[r]), pack(times.astype(np.int32))], names=["word", "learnt", "tags", "times"])
                held_h, held_r, size, lo_row = [], [], 0, hi


def _known(batches):
    """Per row tag: sum of log10(c + 1), and tokens with c > 0, of the records of a batch."""
    for batch in batches:
        c = batch.column(2).to_numpy()
        tags, times = batch.column(0), batch.column(1)
        size = np.asarray(tags.value_lengths())
        tag, t, c = tags.flatten().to_numpy(), times.flatten().to_numpy(), np.repeat(c, size)
        own, back = np.unique(tag, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own), pa.array(np.bincount(back, t * np.log10(c + 1.0), own.size)), pa.array(np.bincount(back, t * (c > 0), own.size).astype(np.int64))],
            names=["tag", "logs", "known"],
        )


def language_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, held: int = 2) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row of ``docs``.

    Rows whose crc32(id) modulo ``modulus`` is ``held``, or whose id is null, are held out; the others
    train. Texts are lower-cased (A-Z); a null text is empty and has its end alone. ``base_score`` is
    the add-one unigram model over words and ends, ``score`` the trie's log10 probability of the bytes
    and the end. Equal rows are trained on each time and scored alike. Without training rows every
    byte costs log10(256). An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.xxhash64(id_col, text_col).alias("tag"))
    rows = rows.withColumn("held_out", F.coalesce(crc_bucket("id", modulus) == held, F.lit(True)))
    scored = _scores(rows.select("id", "tag", "held_out", "text"))
    release(spark)

    words = mapped(rows.select("text", "tag", (~F.col("held_out")).alias("train")), _words, "word long, learnt long, tags array<long>, times array<int>")
    words = saved(words, "words")
    counts = saved(words.where("learnt > 0").groupBy("word").agg(F.sum("learnt").alias("c")), "word-counts")
    release(spark)
    known = mapped(words.join(counts, "word").select("tags", "times", "c"), _known, "tag long, logs double, known long").groupBy("tag").agg(F.sum("logs").alias("logs"), F.sum("known").alias("known"))
    # Equal rows share a tag, and what they found is theirs in equal parts.
    equal = scored.groupBy("tag").agg(F.count("*").alias("rows"))
    known = known.join(equal, "tag").select("tag", (F.col("logs") / F.col("rows")).alias("logs"), (F.col("known") / F.col("rows")).cast("long").alias("known"))
    ends = scored.where("NOT held_out").count()
    seen = counts.agg(F.count("*").alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    total, kinds = seen["n"] + ends, seen["v"] + (ends > 0)
    found = scored.join(known, "tag", "left")
    end = float(np.log10(ends + 1.0))
    base = F.coalesce("logs", F.lit(0.0)) + F.lit(end) - F.col("n_tokens") * F.lit(float(np.log10(total + kinds + 1.0)))
    return found.select(
        "id", "held_out", "n_tokens", (F.coalesce("known", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
    )
