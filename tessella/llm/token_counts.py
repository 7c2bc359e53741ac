"""Token counts by rank-synchronous array merging.

The distinct pre-tokens of a batch lie end to end in one symbol array.  In each
step every sequence finds the lowest merge rank among its adjacent pairs and
all occurrences of those pairs are merged at once, in all sequences together.
Sequences without a mergeable pair leave the array; what is left of a sequence
is its token count.  No per-token Python loop runs, and counts of pre-tokens
are kept by the worker for later batches.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from tessella.llm.common import claim_worker, map_slices, texts_of
from tessella.llm.pretokens import Cached

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 bytes stand for themselves, the others for the code points from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


class MergeTable:
    """Merge ranks of a BPE file as sorted arrays, and the counter over them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        new = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        keep = np.ones(len(order), bool)
        keep[1:] = keys[order][1:] != keys[order][:-1]
        order = order[keep]
        self.keys, self.rank, self.new = keys[order], order.astype(np.int32), new[order]
        self.first = np.array([vocab[s] for s in byte_symbols()], np.int64)
        self.last = np.array([vocab[s + end] for s in byte_symbols()], np.int64)

    def counts(self, pretokens: list[str]) -> np.ndarray:
        """The number of tokens of each pre-token."""
        raw = [p.encode() for p in pretokens]
        n = np.array([len(r) for r in raw], np.int64)
        total = n.copy()
        data = np.frombuffer(b"".join(raw), np.uint8)
        own = np.repeat(np.arange(len(raw)), n)
        symbols = self.first[data]
        tail = np.cumsum(n)[n > 0] - 1
        symbols[tail] = self.last[data[tail]]
        none = np.iinfo(np.int32).max
        while len(symbols) > 1:
            pair = own[:-1] == own[1:]
            key = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(pair & (self.keys[at] == key), self.rank[at], none)
            starts = np.flatnonzero(np.concatenate([[True], ~pair]))
            size = np.diff(np.append(starts, len(symbols)))
            lowest = np.minimum.reduceat(np.append(rank, none), starts)
            # the place after a sequence's last symbol belongs to no pair of it, so its rank is none
            live = lowest != none
            if not live.any():
                break
            hit = rank == np.repeat(np.where(live, lowest, -1), size)[:-1]
            # of overlapping hits (a run of one symbol) every other one merges, from the left
            run = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1]]))
            where = np.flatnonzero(hit)
            begin = run[np.searchsorted(run, where, side="right") - 1]
            where = where[(where - begin) % 2 == 0]
            symbols[where] = self.new[at[where]]
            keep = np.repeat(live, size)
            keep[where + 1] = False
            np.subtract.at(total, own[where], 1)
            symbols, own = symbols[keep], own[keep]
        return total


class _Counter(Cached):
    def __init__(self, path: str):
        super().__init__(path)
        self.table = MergeTable(path)

    def values(self, pretokens: list[str]) -> list[int]:
        counts = self.table.counts(pretokens).tolist()
        return [1 if p in self.special else n for p, n in zip(pretokens, counts, strict=True)]

    def combine(self, values) -> int:
        return sum(values)


_counters: dict[str, _Counter] = {}


def counter(path: str) -> _Counter:
    claim_worker("token_counts", lambda: [c.cache.clear() for c in _counters.values()])
    if path not in _counters:
        _counters[path] = _Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row; one narrow pass, no shuffle.

    Null text counts as empty (0 tokens).  Repeated rows are counted each; a
    null doc_id stays null.  Other columns are ignored.  An empty table gives no
    rows.  A long text is one unit of work, its pre-tokens are shared with the
    rest of its batch.
    """
    path = path or public_tokenizers.path(TOKENIZER)

    def count(batch: pa.RecordBatch) -> dict:
        texts = texts_of(batch)
        n = counter(path).of_texts(texts)
        return {"doc_id": batch.column(0), "n_bytes": [len(t.encode()) for t in texts], "n_tokens": n, "over_limit": [x > limit for x in n]}

    return map_slices(docs.select("doc_id", "text"), count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
