"""Occurrences of benchmark passages in documents by Wu-Manber search.

The windows of all items, ten words or a shorter item's whole, are the
patterns; the symbols are words.  Patterns of one length ``m`` make a
:class:`Machine`.  Its shift table tells for each hashed block of two words how
far the window's end may move before a pattern can end with that block, so most
places of a text are never looked at.  Where the shift is zero, the pattern's
bucket is found by the hashes of its last and first block, and its words are
compared one by one; what the hashes suggest decides nothing.

A text is read by many lanes at once: each takes a stretch of places for the
window's end, so one step moves all lanes.

Items are cut into blocks of bounded text, each broadcast by itself.  Documents
are searched once for each block, without a shuffle of texts.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import map_slices, materialize
from tessella.llm.words import outside, words_of

#: Words of a window; UTF-8 bytes of item texts in a block, on average; places a lane takes; pairs compared at once.
WINDOW, BLOCK_BYTES, LANE, PAIRS = 10, 4 << 20, 128, 1 << 20
_PARTS = outside("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_SCHEMA = "n_words long, hits array<int>, items array<string>"


def _block_hash(first: np.ndarray, last: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ last.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - bits)).astype(np.int64)


class Machine:
    """Wu-Manber search for distinct patterns (rows) of one length over word ids; id 0 is in no pattern."""

    def __init__(self, patterns: np.ndarray):
        n, self.m = patterns.shape
        self.step = 1 if self.m > 1 else 0  # a block's words, less one
        longest = self.m - self.step
        self.bits = max(8, int(4 * n * longest).bit_length())
        self.shift = np.full(1 << self.bits, longest, np.uint8)
        for end in range(self.step, self.m):
            np.minimum.at(self.shift, self._hash(patterns, end), self.m - 1 - end)
        keys = self._key(patterns)
        order = np.argsort(keys, kind="stable")
        self.keys, self.patterns, self.number = keys[order], patterns[order], order

    def _hash(self, rows: np.ndarray, end: int) -> np.ndarray:
        return _block_hash(rows[:, end - self.step], rows[:, end], self.bits)

    def _key(self, rows: np.ndarray) -> np.ndarray:
        """The bucket: the hash of the last block, and the first block's within it."""
        return self._hash(rows, self.m - 1) << 30 | self._hash(rows, self.step) & (1 << 30) - 1

    def candidates(self, ids: np.ndarray) -> np.ndarray:
        """Window ends of shift zero; every end of an occurrence is one."""
        begin = np.arange(0, len(ids), LANE)
        at, stop = np.maximum(begin, self.m - 1), np.minimum(begin + LANE, len(ids))
        found = []
        while len(at):
            here = at < stop
            at, stop = at[here], stop[here]
            move = self.shift[_block_hash(ids[at - self.step], ids[at], self.bits)]
            found.append(at[move == 0])
            at = at + np.maximum(move, 1)
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and pattern number of each occurrence."""
        starts = self.candidates(ids) - (self.m - 1)
        low, high = (np.searchsorted(self.keys, self._key(ids[starts[:, None] + np.arange(self.m)]), side) for side in ("left", "right"))
        full = high > low
        starts, low, size = starts[full], low[full], (high - low)[full]
        held, out = np.cumsum(size), []
        cut = 0
        while cut < len(starts):  # a bounded number of pairs at a time, one place at least
            upto = max(cut + 1, int(np.searchsorted(held, (held[cut - 1] if cut else 0) + PAIRS, "right")))
            n = size[cut:upto]
            at = np.repeat(starts[cut:upto], n)
            row = np.repeat(low[cut:upto] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            for j in range(self.m):
                same = self.patterns[row, j] == ids[at + j]
                at, row = at[same], row[same]
            out.append((at, self.number[row]))
            cut = upto
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


class Index:
    """The machines of a block of items, by pattern length."""

    def __init__(self, names: list[str], texts: pa.Array):
        coded, n = words_of(texts, _PARTS)
        self.vocabulary = {w: i + 1 for i, w in enumerate(coded.dictionary.to_pylist())}
        ids, begin = coded.indices.to_numpy().astype(np.int32) + 1, np.cumsum(n) - n
        self.names = sorted(set(names))  # bytewise, as the items are listed
        number = {x: i for i, x in enumerate(self.names)}
        own = np.array([number[x] for x in names], np.int64)
        self.machines: list[tuple[Machine, np.ndarray, np.ndarray]] = []
        for m in range(1, WINDOW + 1):
            some = np.flatnonzero(n >= m) if m == WINDOW else np.flatnonzero(n == m)
            if not len(some):
                continue
            count = n[some] - m + 1
            start = np.repeat(begin[some] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            patterns, at = np.unique(ids[start[:, None] + np.arange(m)], axis=0, return_inverse=True)
            pairs = np.unique(np.stack([at.ravel(), np.repeat(own[some], count)], 1), axis=0)
            self.machines.append((Machine(patterns), np.searchsorted(pairs[:, 0], np.arange(len(patterns) + 1)), pairs[:, 1]))

    def search(self, texts: pa.Array) -> tuple[list[int], list[list[int]], list[list[str]]]:
        """Number of words, places of hit words and names of items of each text."""
        coded, n = words_of(texts, _PARTS)
        known = np.fromiter((self.vocabulary.get(w, 0) for w in coded.dictionary.to_pylist()), np.int32, len(coded.dictionary))
        ends = np.cumsum(n + 1)  # a place after each text that no pattern has
        ids = np.zeros(int(ends[-1]) if len(n) else 0, np.int32)
        inside = np.ones(len(ids), bool)
        inside[ends - 1] = False
        ids[inside] = known[coded.indices.to_numpy()]
        change, pairs = np.zeros(len(ids) + 1, np.int64), [np.zeros((0, 2), np.int64)]
        for machine, first, items in self.machines:
            start, pattern = machine.search(ids)
            np.add.at(change, start, 1)
            np.add.at(change, start + machine.m, -1)
            found = np.unique(np.stack([np.searchsorted(ends, start, "right"), pattern], 1), axis=0)
            size = first[found[:, 1] + 1] - first[found[:, 1]]
            place = np.repeat(first[found[:, 1]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            pairs.append(np.stack([np.repeat(found[:, 0], size), items[place]], 1))
        hit = np.flatnonzero(np.cumsum(change) > 0)
        of, begin = np.searchsorted(ends, hit, "right"), ends - n - 1
        hits = np.split(hit - begin[of], np.searchsorted(of, np.arange(1, len(n)))) if len(n) else []
        owned = np.unique(np.concatenate(pairs), axis=0)
        items = np.split(owned[:, 1], np.searchsorted(owned[:, 0], np.arange(1, len(n)))) if len(n) else []
        return n.tolist(), [h.tolist() for h in hits], [[self.names[i] for i in x.tolist()] for x in items]


def blocks(items: DataFrame) -> list[Index]:
    """Indexes of blocks of items; a block has about ``BLOCK_BYTES`` of text, or one item."""
    named = items.filter(F.col("text").isNotNull()).select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").distinct()
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES))
    dealt = materialize(named.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n))), "items") if n > 1 else named.withColumn("block", F.lit(0))
    found = (dealt.filter(F.col("block") == b).select("item", "text").toArrow() for b in range(n))
    return [Index(t.column(0).to_pylist(), t.column(1).combine_chunks()) for t in found]


def _scan(table: DataFrame, index: Index, key: str, kind: str) -> DataFrame:
    sent = table.sparkSession.sparkContext.broadcast(index)  # bounded by the block

    def run(batch: pa.RecordBatch) -> dict:
        n, hits, items = sent.value.search(batch.column(1))
        return {key: batch.column(0), "n_words": n, "hits": hits, "items": items}

    return map_slices(table.select(key, "text"), run, f"{key} {kind}, {_SCHEMA}")


def find_passages(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, n_words, hits, items``: places (from 0) of the words inside an occurrence, and the items that occur.

    Words are runs of ASCII letters (A-Z in lower case), digits and all
    characters beyond ASCII.  An item's windows are its ten consecutive words, a
    shorter item's one window is all its words; an item without words, or of
    null text, occurs nowhere.  An item_id is one item however many rows have
    it; items without an id are one, named by the empty string.  Null text has
    no words.  Texts of any length are searched whole, repeated rows each; other
    columns are ignored.  Without items nothing is hit; without documents there
    are no rows.  ``items`` are sorted bytewise.
    """
    found = blocks(items)
    if len(found) == 1:
        return _scan(docs, found[0], "doc_id", "long")
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "rows")
    parts = reduce(DataFrame.unionByName, [_scan(rows, index, "row", "long") for index in found])
    together: dict[str, Column] = {c: F.sort_array(F.array_distinct(F.flatten(F.collect_list(c)))) for c in ("hits", "items")}
    merged = parts.groupBy("row").agg(F.max("n_words").alias("n_words"), *[v.alias(c) for c, v in together.items()])
    return rows.select("row", "doc_id").join(merged, "row").drop("row")


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """:func:`find_passages` as ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    return find_passages(docs, items).select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
