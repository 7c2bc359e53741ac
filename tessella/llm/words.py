"""Words and pieces of a column of texts as Arrow dictionaries, without a Python object per word.

White space is ASCII: ``[\\x20\\x09-\\x0D]``.  A *word* is a run of other bytes;
a *piece* is a run of white space with the word after it (the last one may be
white space alone), so that the pieces of a text make it up again.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column end to end (null is empty) and the end of each text."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    return data, offsets[1:] - offsets[0]


def _coded(data: np.ndarray, starts: np.ndarray) -> pa.DictionaryArray:
    offsets = np.append(starts, len(data)).astype(np.int64)
    # a slice is cut where a text ends, so one very long text may need the wide form
    wide = offsets[-1] >= 1 << 31
    kind, offsets = (pa.large_binary(), offsets) if wide else (pa.binary(), offsets.astype(np.int32))
    return pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()


def _after(ends: np.ndarray, n: int) -> np.ndarray:
    """Where texts begin that have a byte at least."""
    first = np.concatenate([[0], ends[:-1]])
    return first[first < np.minimum(ends, n)]


def lower_case(data: np.ndarray) -> np.ndarray:
    """The bytes of UTF-8 text with A-Z in lower case."""
    return _LOWER[data]


def outside(inside: str) -> np.ndarray:
    """Which bytes part words, if words are of the bytes that ``inside`` names and of all beyond ASCII."""
    parts = np.ones(256, bool)
    parts[128:] = False
    parts[[ord(c) for c in inside]] = False
    return parts


def words_of(texts: pa.Array, space: np.ndarray = _SPACE) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts, A-Z in lower case, and the number of words of each text; ``space`` tells which bytes part them."""
    data, ends = bytes_of(texts)
    inside = ~space[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begin = _after(ends, len(data))
    first[begin] = inside[begin]
    at = np.flatnonzero(first)
    n = np.diff(np.searchsorted(at, np.concatenate([[0], ends])))
    return _coded(_LOWER[data[inside]], np.flatnonzero(first[inside])), n


def _wide_spaces(data: np.ndarray) -> np.ndarray:
    """Places of what is, or might be, white space outside ASCII."""
    if len(data) < 2 or data.max() < 0xC2:
        return np.zeros(0, np.int64)
    out = []
    for lead in (0xC2, 0xE1, 0xE2, 0xE3):
        at = np.flatnonzero(data[:-1] == lead)
        one, two = data[at + 1], data[np.minimum(at + 2, len(data) - 1)]
        if lead == 0xC2:
            hit = (one == 0x85) | (one == 0xA0)
        elif lead == 0xE1:
            hit = one == 0x9A
        elif lead == 0xE2:
            hit = (one == 0x80) & ((two <= 0x8A) | (two == 0xA8) | (two == 0xA9) | (two == 0xAF)) | (one == 0x81) & (two == 0x9F)
        else:
            hit = (one == 0x80) & (two == 0x80)
        out.append(at[hit])
    return np.concatenate(out)


def pieces_of(texts: pa.Array, space: np.ndarray = _SPACE, whole: Callable[[np.ndarray], np.ndarray] = _wide_spaces) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The pieces of all texts and their number in each text.

    ``space`` tells which bytes are white space; a text in which ``whole`` finds
    a place is one piece.
    """
    data, ends = bytes_of(texts)
    blank = space[data]
    first = blank.copy()
    first[1:] &= ~blank[:-1]
    begin = _after(ends, len(data))
    for i in np.unique(np.searchsorted(ends, whole(data), side="right")).tolist():
        first[ends[i - 1] if i else 0 : ends[i]] = False
    first[begin] = True
    at = np.flatnonzero(first)
    return _coded(data, at), np.diff(np.searchsorted(at, np.concatenate([[0], ends])))


class PieceTable:
    """Ids of the pieces that a worker has met, end to end in one array."""

    def __init__(self, entries: int, ids: int, long: int):
        """At most about so many entries and ids; pieces of more than ``long`` bytes leave after their batch."""
        self.entries, self.ids, self.long = entries, ids, long
        self.clear()

    def clear(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.start, self.size, self.hits, self.flat = (np.zeros(1 << 16, t) for t in (np.int64, np.int64, np.int64, np.uint32))
        self.n_flat = 0

    def _add(self, pieces: list[bytes], ids: list[bytes]) -> None:
        n, flat, first = np.fromiter(map(len, ids), np.int64, len(ids)) // 4, np.frombuffer(b"".join(ids), "<u4"), len(self.rows)
        n_rows = first + len(pieces)
        if n_rows > len(self.start):
            self.start, self.size, self.hits = (np.concatenate([v, np.zeros(n_rows, np.int64)]) for v in (self.start, self.size, self.hits))
        if self.n_flat + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(self.n_flat + len(flat), np.uint32)])
        self.size[first:n_rows], self.hits[first:n_rows] = n, 0
        self.start[first:n_rows] = self.n_flat + np.cumsum(n) - n
        self.flat[self.n_flat : self.n_flat + len(flat)] = flat
        self.n_flat += len(flat)
        self.rows.update(zip(pieces, range(first, n_rows), strict=True))

    def _forget(self) -> None:
        """Give up the pieces that only one batch has had; all of them if that is not enough."""
        n = len(self.rows)
        keep = self.hits[:n] > 1
        size = self.size[:n][keep]
        if 2 * len(size) > self.entries or 2 * size.sum() > self.ids:
            self.clear()
            return
        begin = np.cumsum(size) - size
        flat = self.flat[np.repeat(self.start[:n][keep] - begin, size) + np.arange(size.sum())]
        names = [p for p, k in zip(self.rows, keep.tolist(), strict=True) if k]
        self.clear()
        self._add(names, [b""] * len(names))
        self.start[: len(names)], self.size[: len(names)], self.flat, self.n_flat = begin, size, flat, len(flat)

    def take(self, coded: pa.DictionaryArray, n_pieces: np.ndarray, encode: Callable[[list[bytes]], list[bytes]], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, after each text ``end_id`` if given, and where each text's ids end.

        ``encode`` gives the ids of pieces as little-endian unsigned 32-bit bytes.
        """
        if len(self.rows) > self.entries or self.n_flat > self.ids:
            self._forget()
        names = coded.dictionary.to_pylist()
        rows = np.fromiter(map(self.rows.get, names, repeat(-1)), np.int64, len(names))
        # long pieces come last, so that their rows can be given up again
        long: list[bytes] = []
        if len(gaps := np.flatnonzero(rows < 0)):
            is_long = pc.binary_length(coded.dictionary).to_numpy()[gaps] > self.long
            for some in (gaps[~is_long], gaps[is_long]):
                kept, first = self.n_flat, len(self.rows)
                long = [names[i] for i in some.tolist()]
                self._add(long, encode(long))
                rows[some] = first + np.arange(len(some))
        codes = coded.indices.to_numpy()
        self.hits[rows] += 1
        size = self.size[rows][codes]
        ends = np.concatenate([[0], np.cumsum(size)])
        place = np.repeat(self.start[rows][codes] - ends[:-1], size)
        ids = self.flat[place + np.arange(len(place))]
        text_ends = ends[np.cumsum(n_pieces)]
        if long:
            for p in long:
                del self.rows[p]
            self.n_flat = kept
            if len(self.flat) > 4 * self.ids:
                self.clear()
        if end_id is not None:
            text_ends = text_ends + np.arange(1, len(text_ends) + 1)
            out = np.full(len(ids) + len(text_ends), end_id, np.uint32)
            own = np.ones(len(out), bool)
            own[text_ends - 1] = False
            out[own] = ids
            ids = out
        return ids, text_ends
