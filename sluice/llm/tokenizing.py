"""Token ids of whole texts, batch by batch, through a table of the pieces that texts are made of.

The tokenizers used here drop white space and never let a token reach over it, nor from a run of
letters into other characters. So a text's ids are those of its pieces, one after the other. A batch
is cut into pieces on its bytes with numpy, Arrow numbers the distinct ones, only pieces not seen
before reach the tokenizer (many in one call), and the ids of all texts are gathered from the table.
Plain runs of letters, nearly all of the pieces, go to the tokenizer's model as its pre-tokenizer
would spell them, where that is known to be letter by letter.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa

from sluice.llm.common import text_bytes

#: Bytes of text cut at once; a longer text is cut at white space.
CHUNK = 8 << 20
#: Distinct pieces kept; a table that would outgrow it starts anew with the pieces of the text at hand.
MOST_PIECES = 1 << 19

_BLANK, _LETTER, _OTHER, _HARD = 0, 1, 2, 3
_CLASS = np.full(256, _HARD, dtype=np.uint8)
_CLASS[[9, 10, 13, 32]] = _BLANK
_CLASS[33:127] = _OTHER
_CLASS[65:91] = _CLASS[97:123] = _LETTER
# Contractions are cut by the tokenizer; "<" may begin the name of a special token.
_CLASS[[39, 60]] = _HARD
#: The letters of folded runs of letters.
_SMALL = [chr(c) for c in (*range(97, 123), *range(0xDF, 0x100)) if c != 0xF7]
_run = re.compile(f"[{''.join(_SMALL)}]+").fullmatch


class PieceTokenizer:
    """Ids of texts by a tokenizers file; ``texts`` are Arrow string columns, nulls are empty.

    Whole words that hold anything but ASCII, the letters À to ÿ, apostrophes or "<" go to the
    tokenizer as they are. All other words are runs of letters and runs of other characters, letters
    folded to lower case if the tokenizer does so. Where the tokenizer does not mark the ends of
    words, every word goes to it whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        suffix = json.loads(self._tokenizer.to_str())["model"].get("end_of_word_suffix")
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        normalizer = self._tokenizer.normalizer
        self._folds = normalizer is not None and normalizer.normalize_str("AÉ") == "aé"
        self._class = _CLASS if self._ends.any() else np.where(_CLASS == _BLANK, _BLANK, _HARD).astype(np.uint8)
        self._model = self._tokenizer.model
        self._spelled = self._spelling()
        self._known: dict[str, int] = {}
        self._size = np.zeros(0, dtype=np.int32)
        self._start = np.zeros(0, dtype=np.int32)
        self._pool = np.zeros(0, dtype="<u4")

    def _spelling(self) -> dict[int, str] | None:
        """What the model is given for each small letter; nothing if a run of them is not spelled letter by letter."""
        pre, added = self._tokenizer.pre_tokenizer, self._tokenizer.get_added_tokens_decoder().values()
        if not self._folds or self._class is not _CLASS or pre is None or any(t.content.isalpha() for t in added):
            return None
        spelled = {ord(c): "".join(p for p, _ in pre.pre_tokenize_str(c)) for c in _SMALL}
        run = "".join(_SMALL)
        whole = [p for p, _ in pre.pre_tokenize_str(self._tokenizer.normalizer.normalize_str(run))]
        return spelled if whole == [run.translate(spelled)] and whole[0].startswith(run[:26]) else None

    def _keep(self, pieces: list[str], place: np.ndarray) -> None:
        """Start the table anew with these pieces of it."""
        self._known = dict(zip(pieces, range(len(pieces))))
        size = self._size[place]
        ends = np.cumsum(size, dtype=np.int32)
        self._pool = self._pool.take(_spread(self._start[place], size, ends))
        self._size, self._start = size, ends - size

    def encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        """Add pieces to the table; other words of letters are encoded together and told apart by their ends."""
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        order: list[str] = []
        if self._spelled:
            order = [p for p in new if _run(p)]
            new = [p for p in new if not _run(p)]
            for lo in range(0, len(order), 4096):
                got = [self._model.tokenize(p if p.isascii() else p.translate(self._spelled)) for p in order[lo : lo + 4096]]
                ids.append(np.array([t.id for tokens in got for t in tokens], dtype="<u4"))
                sizes.append(np.array([len(tokens) for tokens in got], dtype=np.int64))
        words = [p for p in new if p.isalpha()] if self._ends.any() else []
        single = [p for p in new if not p.isalpha()] if words else new
        for lo in range(0, len(words), 4096):
            some = words[lo : lo + 4096]
            got = self.encoded([" ".join(some)])[0]
            end = np.flatnonzero(self._ends[got]) + 1
            if end.size != len(some):
                single = single + some
                continue
            ids.append(got)
            sizes.append(np.diff(end, prepend=0))
            order += some
        for lo in range(0, len(single), 4096):
            some = single[lo : lo + 4096]
            got = self.encoded(some)
            ids += got
            sizes.append(np.array([x.size for x in got], dtype=np.int64))
            order += some
        first = len(self._known)
        self._known.update(zip(order, range(first, first + len(order))))
        self._size = np.concatenate([self._size, *sizes]).astype(np.int32)
        self._start = (np.cumsum(self._size) - self._size).astype(np.int32)
        self._pool = np.concatenate([self._pool, *ids])

    def _cut(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where pieces begin: at every change of class inside plain words, at the ends of other words and texts."""
        kind = self._class[data]
        if data.size and int(data.max()) >= 128:
            lead = np.flatnonzero(data == 0xC3)
            lead = lead[lead + 1 < data.size]
            tail = data[lead + 1]
            lead = lead[(tail != 0x97) & (tail != 0xB7)]
            if self._class is _CLASS:
                kind[lead] = kind[lead + 1] = _LETTER
        edge = np.zeros(data.size + 1, dtype=bool)
        edge[1:-1] = kind[1:] != kind[:-1]
        hard = np.flatnonzero(kind == _HARD)
        if hard.size:
            blank = kind == _BLANK
            side = np.zeros(data.size + 1, dtype=bool)
            side[1:-1] = blank[1:] != blank[:-1]
            side[bounds] = True
            words = np.flatnonzero(side)
            word = np.unique(np.searchsorted(words, hard, side="right"))
            word = word[word < words.size]
            start, end = words[word - 1] + 1, words[word]
            marks = np.zeros(data.size + 2, dtype=np.int32)
            np.add.at(marks, start, 1)
            np.add.at(marks, end, -1)
            edge &= ~(np.cumsum(marks)[: data.size + 1] > 0)
        edge[bounds] = True
        edge[[0, -1]] = True
        return np.flatnonzero(edge)

    def _folded(self, data: np.ndarray) -> np.ndarray:
        out = data.copy()
        upper = (data >= 65) & (data <= 90)
        out[upper] += 32
        if data.size and int(data.max()) >= 128:
            lead = np.flatnonzero(data[:-1] == 0xC3) + 1
            tail = data[lead]
            out[lead[(tail >= 0x80) & (tail <= 0x9E) & (tail != 0x97)]] += 32
        return out

    def ids(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts ``data[bounds[k]:bounds[k + 1]]`` and where each text's ids begin and end."""
        if not data.size:
            return np.zeros(0, dtype="<u4"), np.zeros(bounds.size, dtype=np.int64)
        cut = self._cut(data, bounds)
        kept = (self._class[data[cut[:-1]]] != _BLANK).nonzero()[0]
        folded = self._folded(data) if self._folds and self._class is _CLASS else data
        column = pa.LargeStringArray.from_buffers(cut.size - 1, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(folded))
        numbered = column.take(pa.array(kept)).dictionary_encode() if kept.size < cut.size - 1 else column.dictionary_encode()
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False)
        place = self._places(distinct)
        new = np.flatnonzero(place < 0)
        if new.size:
            if len(self._known) + new.size > MOST_PIECES:
                old = np.flatnonzero(place >= 0)
                self._keep(distinct[old].tolist(), place[old])
                place[old] = np.arange(old.size)
            pieces = distinct[new].tolist()
            self._learn(pieces)
            place[new] = self._places(pieces)
        piece = numbered.indices.to_numpy(zero_copy_only=False)
        size = self._size[place].take(piece)
        ends = np.cumsum(size, dtype=np.int32)
        at = _spread(self._start[place].take(piece), size, ends)
        passed = np.concatenate([np.zeros(1, dtype=np.int32), ends])
        return self._pool.take(at), passed[np.searchsorted(cut[:-1][kept], bounds)]

    def _places(self, pieces: np.ndarray | list[str]) -> np.ndarray:
        """Where the pieces stand in the table; -1 for those that are not there."""
        return np.fromiter(map(self._known.get, pieces, repeat(-1)), np.int32, len(pieces))

    def texts(self, column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
        """Per text, in order: its row and its ids in parts, each of a few megabytes of text at most.

        A text that has no white space for that long is handled whole from one blank to the next.
        """
        data, bounds = text_bytes(column)
        lo, n = 0, bounds.size - 1
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + CHUNK, side="right")) - 1)
            part = data[bounds[lo] : bounds[hi]]
            if part.size <= CHUNK:
                ids, at = self.ids(part, bounds[lo : hi + 1] - bounds[lo])
                for k in range(lo, hi):
                    yield k, [ids[at[k - lo] : at[k - lo + 1]]]
            else:
                yield lo, [self.ids(p, np.array([0, p.size]))[0] for p in _parts(part)]
            lo = hi


def _spread(start: np.ndarray, size: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the ids of pieces lie one after the other; ``ends`` is the running sum of the sizes."""
    at = np.repeat(start - (ends - size), size)
    at += np.arange(at.size, dtype=np.int32)
    return at


def _parts(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in parts that end behind a blank."""
    lo = 0
    while lo < data.size:
        hi = min(lo + CHUNK, data.size)
        while hi < data.size:
            blank = np.flatnonzero(_CLASS[data[hi - 1 : hi + CHUNK]] == _BLANK)
            if blank.size:
                hi += int(blank[0])
                break
            hi = min(hi + CHUNK, data.size)
        yield data[lo:hi]
        lo = hi


_ready: dict[str, PieceTokenizer] = {}


def tokenizer(path: str) -> PieceTokenizer:
    """One tokenizer per worker process and file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _ready:
        _ready[path] = PieceTokenizer(path)
    return _ready[path]


def whole_texts(column: pa.Array, path: str, by_words: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """Row and ids of every text of a column; a null is empty.

    ``by_words=False`` gives each text to the tokenizer whole, for one whose tokens reach over blanks.
    """
    own = tokenizer(path)
    if by_words:
        for k, parts in own.texts(column):
            yield k, parts[0] if len(parts) == 1 else np.concatenate(parts)
        return
    for lo in range(0, len(column), 64):
        texts = [t or "" for t in column.slice(lo, 64).to_pylist()]
        for k, ids in enumerate(own.encoded(texts)):
            yield lo + k, ids
