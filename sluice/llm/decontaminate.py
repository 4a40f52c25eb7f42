"""Benchmark decontamination by latent semantic retrieval.

Documents are cut into blocks of words; a passage is a block, or a block with the next. TF-IDF
passages over hashed words form a matrix that is never built whole: each task multiplies its passages
with a random test matrix and back, and the sum over all passages is a sketch of the Gram matrix. Its
randomised eigenvectors are the right singular vectors (single-pass randomised SVD). Passages and
benchmark items are projected on them, scaled by the inverse singular values, and each passage takes
its nearest items by cosine. Beside them, every item with a run of words of the text is a candidate
where the run stands, so that no item that stands whole in a text is lost. A candidate is decided on words: the longest common subsequence of the
item and first the block, then the stretch around it that could hold the item, and the share of the
item's last words (its answer) in that subsequence. Words are compared in lower case, of any script.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import _STEP, Words, dropped, mapped, mix, release, saved, slices, text_slices

#: Hash buckets of words, words in a block, rank of the latent space.
BUCKETS, STRIDE, RANK = 1 << 14, 12, 96
#: Words of one comparison piece of an item: the width of a machine word.
PIECE = 64
#: Words of a run that makes an item a candidate; a shorter item is one run.
RUN = len(_STEP)
#: Passages handled at once where a matrix has a row for each.
ROWS = 1024


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(50)).astype(np.int64)


class _Passages:
    """Blocks of a slice of documents, the last of a document as long as its words last."""

    def __init__(self, bucket: np.ndarray, first: np.ndarray):
        """The buckets of all words, and where each document's words begin and end."""
        self.bucket, self.first = bucket, first
        per = -(-np.diff(first) // STRIDE)
        self.row = np.repeat(np.arange(per.size), per)
        order = np.arange(self.row.size) - np.repeat(np.cumsum(per) - per, per)
        self.start = first[self.row] + order * STRIDE
        self.end = np.minimum(self.start + STRIDE, first[self.row + 1])
        n = self.row.size
        #: Whether the next block belongs to the same document.
        self.joined = np.zeros(n, dtype=bool)
        if n > 1:
            self.joined[:-1] = self.row[1:] == self.row[:-1]

    def vectors(self, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the words' rows of ``axes``, per block and per pair of blocks; its last row is zero.

        Word by word of the blocks, a few blocks at a time, so that rows and sums stay in the cache.
        """
        n, width = self.row.size, axes.shape[1]
        block = np.zeros((n, width), dtype=axes.dtype)
        if not n:
            return block, block
        at = np.arange(STRIDE)[:, None] + self.start
        word = np.where(at < self.end, self.bucket[np.minimum(at, self.bucket.size - 1)], BUCKETS)
        rows = np.empty((ROWS, width), dtype=axes.dtype)
        for lo in range(0, n, ROWS):
            hi = min(lo + ROWS, n)
            for j in range(STRIDE):
                block[lo:hi] += np.take(axes, word[j, lo:hi], axis=0, out=rows[: hi - lo], mode="clip")
        pair = block.copy()
        pair[:-1] += np.where(self.joined[:-1, None], block[1:], 0)
        return block, pair


def _padded(axes: np.ndarray) -> np.ndarray:
    """``axes`` with a row of zeros for the places of a block beyond its words."""
    return np.vstack([axes, np.zeros((1, axes.shape[1]))]).astype(np.float32)


def bucketed(rows: DataFrame) -> DataFrame:
    """The buckets of every text's words, two bytes each, and per task the documents of each bucket.

    Written once: rows with ``words`` are texts, the others are counts (``bucket`` -1 counts texts).
    """

    def run(batches):
        total, n = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for lo, hi, data, bounds in text_slices(pc.utf8_lower(batch.column(0))):
                words = Words(data, bounds)
                own = _buckets(words.hashes())
                # A few texts at a time: a mark per bucket, then the marks are counted.
                for a in range(0, hi - lo, 64):
                    b = min(a + 64, hi - lo)
                    some = slice(words.first[a], words.first[b])
                    marks = np.zeros((b - a, BUCKETS), dtype=bool)
                    marks[words.row[some] - a, own[some]] = True
                    total += marks.sum(axis=0)
                n += hi - lo
                raw = own.astype("<u2").tobytes()
                cut = (2 * words.first).tolist()
                texts = pa.array([raw[i:j] for i, j in zip(cut[:-1], cut[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.nulls(hi - lo, pa.int32()), pa.nulls(hi - lo, pa.int64()), texts], names=["bucket", "n", "words"])
        counts = pa.array(np.concatenate([[n], total]))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, BUCKETS, dtype=np.int32)), counts, pa.nulls(BUCKETS + 1, pa.binary())], names=["bucket", "n", "words"])

    return saved(mapped(rows.select("text"), run, "bucket int, n long, words binary"), "buckets")


def _document_frequencies(buckets: DataFrame) -> np.ndarray:
    out = np.zeros(BUCKETS + 1)
    rows = buckets.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def latent_axes(buckets: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors and singular values of the TF-IDF passage matrix of all bucketed texts.

    Each task sends one ``BUCKETS x width`` sketch; the width is fixed, so what the driver gets is too.
    """
    width = rank + 8
    test = np.random.default_rng(seed).standard_normal((BUCKETS, width)).astype(np.float32)
    scaled = buckets.sparkSession.sparkContext.broadcast(_padded(test * idf[:, None]))

    def sketch(batches):
        total, seen = np.zeros((width, BUCKETS)), False
        for batch in batches:
            for bucket, first in _word_slices(batch.column(0)):
                p = _Passages(bucket, first)
                if not p.row.size:
                    continue
                seen = True
                y = p.vectors(scaled.value)[1]
                back = y.copy()
                back[1:] += np.where(p.joined[:-1, None], y[:-1], 0)
                owner = np.repeat(np.arange(p.row.size), p.end - p.start)
                order = np.argsort(p.bucket.astype(np.uint16), kind="stable")
                own = p.bucket[order]
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                own, owner, back = own[first], owner[order], np.ascontiguousarray(back.T)
                for i in range(width):
                    total[i, own] += np.add.reduceat(back[i].take(owner), first)
        if seen:
            full = np.flatnonzero(total.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(list(total.T[full]), pa.list_(pa.float64()))], names=["bucket", "y"])

    sums = mapped(buckets.where("words IS NOT NULL").select("words"), sketch, "bucket int, y array<double>").groupBy("bucket").agg(F.array(*[F.sum(F.col("y")[i]) for i in range(width)]).alias("y")).toArrow()
    # As Arrow, since a Python number for each of the sketch's would take several times its size.
    b = np.zeros((BUCKETS, width))
    for part in sums.to_batches():
        b[part.column(0).to_numpy()] = part.column(1).flatten().to_numpy().reshape(part.num_rows, width)
    del sums
    b *= idf[:, None]
    core = test.astype(np.float64).T @ b
    core = (core + core.T) / 2
    value, vector = np.linalg.eigh(core)
    keep = value > max(value.max(), 0) * 1e-9 if value.size else value > 0
    if not keep.any():
        return np.zeros((BUCKETS, 1), dtype=np.float32), np.zeros(1)
    b = b @ (vector[:, keep] / np.sqrt(value[keep]))
    u, s, _ = np.linalg.svd(b, full_matrices=False)
    return u[:, :rank].astype(np.float32), s[:rank]


def _word_slices(column: pa.Array):
    """Buckets of a few hundred thousand words at a time, and where each text's begin and end."""
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    for lo, hi in slices(bounds, 1 << 20):
        words = np.frombuffer(raw, "<u2", int(bounds[hi] - bounds[lo]) // 2, int(bounds[lo])) if raw is not None else np.zeros(0, "<u2")
        yield words.astype(np.int64), (bounds[lo : hi + 1] - bounds[lo]) // 2


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(length > 0, length, 1)


def _runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for every run of ``size`` words."""
    n = max(0, hashes.size - size + 1)
    out = np.full(n, size, dtype=np.uint64)
    for j in range(size):
        out += hashes[j : j + n] * _STEP[j]
    return mix(out)


class _Items:
    """Benchmark pieces: their words as bit masks, vectors, and the bits of their answers."""

    def __init__(self, items: list[tuple], answer_share: float):
        self.item, self.size, self.answer = [], [], []
        pieces = []
        for item, text in items:
            raw = np.frombuffer(pc.utf8_lower(text or "").as_py().encode(), dtype=np.uint8)
            words = Words(raw, np.array([0, raw.size])).hashes()
            whole_answer = words.size - max(1, round(words.size * answer_share))
            for lo in range(0, words.size, PIECE):
                if lo and words.size - lo < PIECE // 4:
                    lo = words.size - PIECE  # a short end is one piece with words of the piece before it
                part = words[lo : lo + PIECE]
                # The item's last words, as far as they are here; a piece before them has its own.
                first = max(0, whole_answer - lo)
                if first >= part.size:
                    first = part.size - max(1, round(part.size * answer_share))
                self.item.append(item)
                self.size.append(part.size)
                self.answer.append(((1 << part.size) - 1) ^ ((1 << first) - 1))
                pieces.append(part)
        self.pieces = pieces
        self.size = np.array(self.size, dtype=np.int64)
        self.answer = np.array(self.answer, dtype=np.uint64)
        #: Per length of a run: hashes in order, their pieces, and which upper 20 bits occur.
        self.runs = {}
        for size in sorted({min(RUN, p.size) for p in pieces}):
            own = [(np.unique(_runs(p, size)), j) for j, p in enumerate(pieces) if min(RUN, p.size) == size]
            run, of = np.concatenate([r for r, _ in own]), np.repeat([j for _, j in own], [r.size for r, _ in own])
            order = np.argsort(run, kind="stable")
            there = np.zeros(1 << 20, dtype=bool)
            there[(run >> np.uint64(44)).astype(np.int64)] = True
            self.runs[size] = run[order], of[order], there
        self.vocabulary = np.unique(np.concatenate(pieces)) if pieces else np.zeros(0, dtype=np.uint64)
        # The last row belongs to words that no item has.
        self.mask = np.zeros((self.vocabulary.size + 1, len(pieces)), dtype=np.uint64)
        for j, part in enumerate(pieces):
            for k, w in enumerate(np.searchsorted(self.vocabulary, part)):
                self.mask[w, j] |= np.uint64(1 << k)

    def vectors(self, axes: np.ndarray) -> np.ndarray:
        return _unit(np.stack([axes[_buckets(p)].sum(axis=0) for p in self.pieces])) if self.pieces else np.zeros((0, axes.shape[1]))

    def sharing(self, p: _Passages, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Blocks and the pieces that share a run of words which begins in the block; each pair once."""
        n, found = len(self.pieces), [np.zeros(0, dtype=np.int64)]
        for size, (run, of, there) in self.runs.items():
            g = _runs(hashes, size)
            at = np.flatnonzero(there[(g >> np.uint64(44)).view(np.int64)])
            row = np.searchsorted(p.first, at, side="right")
            at = at[at + size <= p.first[row]]
            lo, hi = np.searchsorted(run, g[at]), np.searchsorted(run, g[at], side="right")
            many = hi - lo
            place = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            block = np.searchsorted(p.start, np.repeat(at, many), side="right") - 1
            found.append(np.unique(block * n + of[place]))
        pairs = np.unique(np.concatenate(found))
        return pairs // n, pairs % n

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), self.vocabulary.size - 1)
        return np.where(self.vocabulary[at] == hashes, at, self.vocabulary.size)


def common_subsequence(word: np.ndarray, start: np.ndarray, size: np.ndarray, piece: np.ndarray, items: _Items) -> np.ndarray:
    """Bits of each piece's words in one longest common subsequence with a stretch of text, pair by pair."""
    v = np.full(piece.size, ~np.uint64(0))
    for lo in range(0, piece.size, 16 * ROWS):
        own = slice(lo, lo + 16 * ROWS)
        w, begin, words, column = v[own], start[own], size[own], piece[own]
        for t in range(int(words.max(initial=0))):
            m = items.mask[word[np.minimum(begin + t, word.size - 1)], column]
            m[t >= words] = 0
            u = w & m
            w[:] = (w + u) | (w - u)
    full = np.where(items.size[piece] == 64, ~np.uint64(0), (np.uint64(1) << (items.size[piece] % 64).astype(np.uint64)) - np.uint64(1))
    return ~v & full


def _nearest(vectors: tuple[np.ndarray, np.ndarray], targets: np.ndarray, nearest: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks and the pieces nearest to them, alone or with the next block; each pair once."""
    n, found = targets.shape[0], []
    alone, paired = map(_unit, vectors)
    for a in range(0, alone.shape[0], ROWS):
        near = np.zeros((min(ROWS, alone.shape[0] - a), n), dtype=bool)
        row = np.arange(near.shape[0])
        for z in (alone, paired):
            cosine = z[a : a + ROWS] @ targets.T
            for _ in range(min(nearest, n)):
                best = cosine.argmax(axis=1)
                near[row, best] = True
                cosine[row, best] = -np.inf
        found.append(a * n + np.flatnonzero(near))
    pairs = np.concatenate(found)
    return pairs // n, pairs % n


def contaminations(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    nearest: int = 8, least_common: float = 0.6, verbatim: float = 0.8, answer_share: float = 0.25, least_answer: float = 0.5, block_items: int = 1000,
) -> DataFrame:
    """Per row of ``docs`` with a hit: ``(id, item_id, common, answer, n_passages)`` of its best item.

    ``common`` is the share of the item's words in the longest common subsequence, ``answer`` that of
    its last quarter. A hit has ``common`` of ``verbatim`` or more, or of ``least_common`` with half of
    the answer. Each passage is compared with its ``nearest`` items by latent cosine
    and with all items that have a run of ``RUN`` words in common with the text there. Items are taken
    in blocks of about ``block_items``, each a pass over the documents, so what is broadcast is bounded
    however long the benchmark is. Null and empty texts and items hit nothing; an empty table on either side
    gives no rows. Equal rows give equal hits. Ties go to the smaller item.
    """
    kind, item_kind = (df.schema[c].dataType.simpleString() for df, c in ((docs, id_col), (benchmark, item_col)))
    schema = f"id {kind}, item_id {item_kind}, common double, answer double, n_passages long"
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    wanted = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).where("trim(text) <> ''")
    blocks = -(-wanted.count() // block_items)
    if not blocks:
        return spark.createDataFrame([], schema)
    buckets = bucketed(rows)
    frequency = _document_frequencies(buckets)
    idf = np.log((1 + frequency[-1]) / (1 + frequency[:BUCKETS])) + 0.05
    axes, strength = latent_axes(buckets, idf)
    dropped(buckets)
    release(spark)
    scaled = _padded(axes * idf[:, None] / np.maximum(strength, 1e-9))
    found = None
    for block in range(blocks):
        part = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).distinct().orderBy("item_id", "text").collect()
        items = _Items([(r["item_id"], r["text"]) for r in part], answer_share)
        if not items.pieces:
            continue
        model = spark.sparkContext.broadcast((scaled, items, items.vectors(scaled).astype(np.float32)))

        def search(batches, model=model):
            scaled, items, targets = model.value
            for batch in batches:
                ids = batch.column(0)
                for lo, hi, data, bounds in text_slices(pc.utf8_lower(batch.column(1))):
                    words = Words(data, bounds)
                    hashes = words.hashes()
                    p = _Passages(_buckets(hashes), words.first)
                    if not p.row.size:
                        continue
                    word = items.look_up(hashes)
                    at, piece = _nearest(p.vectors(scaled), targets, nearest)
                    inside = np.bitwise_count(common_subsequence(word, p.start[at], p.end[at] - p.start[at], piece, items))
                    some = 2 * inside >= np.minimum(p.end[at] - p.start[at], items.size[piece])
                    whole, of = items.sharing(p, hashes)
                    pairs = np.unique(np.concatenate([at[some], whole]) * items.size.size + np.concatenate([piece[some], of]))
                    at, piece = pairs // items.size.size, pairs % items.size.size
                    begin = np.maximum(p.start[at] - PIECE, p.first[p.row[at]])
                    end = np.minimum(p.end[at] + PIECE, p.first[p.row[at] + 1])
                    bits = common_subsequence(word, begin, end - begin, piece, items)
                    common = np.bitwise_count(bits) / items.size[piece]
                    answer = np.bitwise_count(bits & items.answer[piece]) / np.bitwise_count(items.answer[piece])
                    hit = (common >= verbatim) | (common >= least_common) & (answer >= least_answer)
                    best: dict[int, tuple] = {}
                    count: dict[int, int] = {}
                    for i in np.flatnonzero(hit).tolist():
                        doc, item = int(p.row[at[i]]), items.item[piece[i]]
                        count[doc] = count.get(doc, 0) + 1
                        key = (-float(common[i]), -float(answer[i]), item)
                        best[doc] = min(best.get(doc, key), key)
                    if best:
                        own = sorted(best)
                        yield pa.RecordBatch.from_arrays(
                            [
                                ids.take(pa.array([lo + d for d in own])),
                                pa.array([best[d][2] for d in own]).cast(pa.from_numpy_dtype(np.int64) if item_kind == "bigint" else pa.array([best[d][2] for d in own]).type),
                                pa.array([-best[d][0] for d in own]), pa.array([-best[d][1] for d in own]), pa.array([count[d] for d in own], pa.int64()),
                            ],
                            names=["id", "item_id", "common", "answer", "n_passages"],
                        )

        hits = mapped(rows, search, schema)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return spark.createDataFrame([], schema)
    best = F.min(F.struct((-F.col("common")).alias("c"), (-F.col("answer")).alias("a"), "item_id"))
    return found.groupBy("id").agg(best.alias("b"), F.sum("n_passages").alias("n_passages")).select(
        "id", F.col("b.item_id").alias("item_id"), (-F.col("b.c")).alias("common"), (-F.col("b.a")).alias("answer"), "n_passages"
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` without a hit, all columns kept; rows with a null id are judged by no join and stay."""
    hits = contaminations(docs, benchmark, id_col, **options).where("id IS NOT NULL").select(F.col("id").alias(id_col))
    return docs.join(hits, id_col, "left_anti").select(*[docs[c] for c in docs.columns])
