"""Token ids in ascending document order, written as grammar-compressed shards.

Documents are range-partitioned by doc_id; each task encodes its range and
writes shards of about ``SHARD_TOKENS`` ids.  A shard is compressed by Re-Pair:
in each round every pair that is more frequent than the pairs it overlaps with
becomes a nonterminal there, the most frequent pair of all everywhere, until no
pair occurs twice.  Pairs never cross the end of a document, so any document is
decoded by itself from the shard's index.  A shard (see :func:`write_shard`) holds, little-endian:

    magic "RPG1", n_docs u32, n_rules u32, base u32, n_symbols u64, start u64
    doc_id i64[n_docs], has_id u8[n_docs]
    symbol_end u64[n_docs], token_end u64[n_docs]
    rules u32[n_rules][2], expansion_length u32[n_rules], symbols u32[n_symbols]

``base`` is the first nonterminal; ``start`` counts the ids that the same task
wrote before.  Rule ``k`` expands nonterminal ``base + k``.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import materialize, slices
from tessella.llm.pretokens import encoder

TOKENIZER, END_ID = "word_bpe_49k.json", 2
SHARD_TOKENS = 1 << 18
_HEAD = struct.Struct("<4sIIIQQ")


def _groups(key: np.ndarray, bits: int) -> tuple[np.ndarray, int]:
    """The number of each key among the distinct ones in ascending order, and how many these are."""
    shift = max(len(key) - 1, 1).bit_length()
    if bits + shift <= 64:  # the place fits beside the key: sorting values is quicker than sorting places
        packed = np.sort(key << np.uint64(shift) | np.arange(len(key), dtype=np.uint64))
        order, ordered = (packed & np.uint64((1 << shift) - 1)).astype(np.int64), packed >> np.uint64(shift)
    else:
        order = np.argsort(key)
        ordered = key[order]
    edge = np.ones(len(key), bool)
    edge[1:] = ordered[1:] != ordered[:-1]
    group = np.empty(len(key), np.int64)
    group[order] = np.cumsum(edge) - 1
    return group, int(edge.sum())


def compress(symbols: np.ndarray, last: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``symbols, last, rules`` after Re-Pair; ``last`` marks the final symbol of each document.

    A pair that occurs once will never occur more often, so each round looks at
    the pairs alone that occurred more often or are new.
    """
    symbols, last, rules, n_rules = symbols.astype(np.uint64), last.copy(), [], 0
    open_ = ~last
    while len(at := np.flatnonzero(open_)):
        left, right = symbols[at], symbols[at + 1]
        bits = (base + n_rules).bit_length()
        group, n = _groups(left << np.uint64(bits) | right, 2 * bits)
        # of a run of one symbol every other pair counts, from the left
        counted = np.ones(len(at), bool)
        if (same := left == right).any():
            twin = np.flatnonzero(same)
            begin = np.ones(len(twin), bool)
            begin[1:] = (at[twin[1:]] != at[twin[:-1]] + 1) | (left[twin[1:]] != left[twin[:-1]])
            counted[twin] = (np.arange(len(twin)) - np.maximum.accumulate(np.where(begin, np.arange(len(twin)), 0))) % 2 == 0
        count = np.bincount(group[counted], minlength=n)
        count = count[group]
        often = count > 1
        open_[at[~often]] = False
        rank = np.zeros(len(symbols) + 1, np.int64)
        rank[at] = np.where(often & counted, count * n + n - group, 0)
        mine = rank[at]
        chosen = (mine > rank[at - 1]) & (mine > rank[at + 1])
        chosen &= (np.bincount(group[chosen], minlength=n) > 1)[group]
        if not chosen.any():
            break
        where, group = at[chosen], group[chosen]
        first, number = np.full(n, -1, np.int64), np.empty(n, np.int64)
        first[group] = np.arange(len(group))
        used = np.flatnonzero(first >= 0)
        first = first[used]
        number[used] = base + n_rules + np.arange(len(used))
        rules.append(np.stack([symbols[where[first]], symbols[where[first] + 1]], 1).astype(np.uint32))
        n_rules += len(used)
        symbols[where] = number[group]
        last[where] = last[where + 1]
        open_[where] = ~last[where]
        open_[where[where > 0] - 1] = ~last[where[where > 0] - 1]
        keep = np.ones(len(symbols), bool)
        keep[where + 1] = False
        symbols, last, open_ = symbols[keep], last[keep], open_[keep]
    return symbols.astype(np.uint32), last, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def expand(symbols: np.ndarray, rules: np.ndarray, base: int, lengths: np.ndarray) -> np.ndarray:
    """The ids that ``symbols`` stand for: each gets its place, then nonterminals are replaced there level by level."""
    sizes = np.concatenate([np.ones(base, np.int64), lengths.astype(np.int64)])
    size = sizes[symbols]
    out = np.empty(int(size.sum()), np.uint32)
    at = np.cumsum(size) - size
    out[at] = symbols
    at = at[symbols >= base]
    while len(at):
        pair = rules[out[at] - base]
        right = at + sizes[pair[:, 0]]
        out[at], out[right] = pair[:, 0], pair[:, 1]
        at = np.concatenate([at[pair[:, 0] >= base], right[pair[:, 1] >= base]])
    return out


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(rules), np.uint32)
    open_ = np.arange(len(rules))
    while len(open_):
        pair = rules[open_].astype(np.int64)
        size = np.where(pair < base, 1, out[np.maximum(pair - base, 0)])
        known = (size > 0).all(axis=1)
        out[open_[known]] = size[known].sum(axis=1)
        open_ = open_[~known]
    return out


def write_shard(doc_ids: list[int | None], flat: np.ndarray, token_end: np.ndarray, start: int) -> bytes:
    """The file of some documents with ids each, in the order given."""
    last = np.zeros(len(flat), bool)
    last[token_end - 1] = True
    base = int(flat.max()) + 1
    symbols, ends, rules = compress(flat, last, base)
    head = _HEAD.pack(b"RPG1", len(doc_ids), len(rules), base, len(symbols), start)
    arrays = (
        np.array([d or 0 for d in doc_ids], "<i8"), np.array([d is not None for d in doc_ids], "u1"), (np.flatnonzero(ends) + 1).astype("<u8"), token_end.astype("<u8"),
        rules.astype("<u4"), expansion_lengths(rules, base).astype("<u4"), symbols.astype("<u4"),
    )
    return head + b"".join(a.tobytes() for a in arrays)


class Shard:
    """A shard file; documents are read by position."""

    def __init__(self, data: bytes):
        magic, n, n_rules, self.base, n_symbols, self.start = _HEAD.unpack_from(data)
        if magic != b"RPG1":
            raise ValueError("not a shard of token ids")
        at = _HEAD.size

        def take(dtype: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype, count, at)
            at += out.nbytes
            return out

        self.doc_id, self.has_id, self.symbol_end, self.token_end = take("<i8", n), take("u1", n), take("<u8", n).astype(np.int64), take("<u8", n).astype(np.int64)
        self.rules, self.expansion_length, self.symbols = take("<u4", 2 * n_rules).reshape(-1, 2), take("<u4", n_rules), take("<u4", n_symbols)

    def __len__(self) -> int:
        return len(self.doc_id)

    def document(self, i: int) -> np.ndarray:
        """The ids of the document at position ``i``; no other document is decoded."""
        return expand(self.symbols[self.symbol_end[i - 1] if i else 0 : self.symbol_end[i]], self.rules, self.base, self.expansion_length)

    def token(self, i: int, position: int) -> int:
        """One id of a document, found by expansion lengths."""
        symbols = self.symbols[self.symbol_end[i - 1] if i else 0 : self.symbol_end[i]].astype(np.int64)
        size = np.where(symbols < self.base, 1, self.expansion_length[np.maximum(symbols - self.base, 0)] if len(self.rules) else 1)
        k = int(np.searchsorted(np.cumsum(size), position, side="right"))
        position, symbol = position - int(size[:k].sum()), int(symbols[k])
        while symbol >= self.base:
            left, right = self.rules[symbol - self.base].tolist()
            width = 1 if left < self.base else int(self.expansion_length[left - self.base])
            symbol, position = (left, position) if position < width else (right, position - width)
        return symbol

    def ids(self) -> np.ndarray:
        return expand(self.symbols, self.rules, self.base, self.expansion_length)


def write_token_shards(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """``task, shard, n_docs, n_tokens, file``: shards in ascending order of (task, shard)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        doc_ids, ids, ends, held, start, shard = [], [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            file = write_shard(doc_ids, np.concatenate(ids), np.concatenate(ends), start)
            row = [[task], [shard], [len(doc_ids)], [held], [file]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["task", "shard", "n_docs", "n_tokens", "file"])

        for batch in batches:
            for part in slices(batch):
                names = part.column(0).to_pylist()
                new, new_ends = encoder(path).of_column(part.column(1), end_id)
                at, done = 0, 0
                while at < len(names):
                    # documents up to the one that fills the shard
                    upto = min(int(np.searchsorted(new_ends, done + SHARD_TOKENS - held)) + 1, len(names))
                    doc_ids += names[at:upto]
                    ids.append(new[done : new_ends[upto - 1]])
                    ends.append(held + new_ends[at:upto] - done)
                    held += len(ids[-1])
                    at, done = upto, int(new_ends[upto - 1])
                    if held >= SHARD_TOKENS:
                        yield flush()
                        doc_ids, ids, ends, held, start, shard = [], [], [], 0, start + held, shard + 1
        if doc_ids:
            yield flush()

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # rows that share an id, or have none, are dealt by their text
    ordered = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).repartitionByRange(n, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    return ordered.mapInArrow(run, "task long, shard long, n_docs long, n_tokens long, file binary")


def read_token_shards(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task, file in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shard = Shard(file.as_buffer())
                ids = shard.ids().astype("<u4").tobytes()
                begin = np.concatenate([[0], shard.token_end[:-1]])
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(begin.tolist(), shard.token_end.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_id, pa.int64(), mask=shard.has_id == 0), pa.array([task] * len(shard), pa.int64()), pa.array(shard.start + begin, pa.int64()), pa.array(shard.token_end - begin, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "task", "start_in_task", "n_tokens", "ids_crc32"],
                )

    decoded = shards.select("task", "file").mapInArrow(run, "doc_id long, task long, start_in_task long, n_tokens long, ids_crc32 long")
    totals, before, firsts = shards.groupBy("task").agg(F.sum("n_tokens").alias("n")).collect(), 0, []  # a row for each task that wrote
    for task, n in sorted(map(tuple, totals)):
        firsts.append((task, before))
        before += n
    first = shards.sparkSession.createDataFrame(firsts, "task long, first long")
    return decoded.join(F.broadcast(first), "task").select("doc_id", (F.col("first") + F.col("start_in_task")).alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write all ids as shards in the shared folder and return what reading them back gives.

    One row per document: ``doc_id, start, n_tokens, ids_crc32``.  Null text is
    empty and has the end id alone.  Null ids come first, repeated ids are
    ordered by a hash of their text; each row has ids of its own.  A text longer
    than a shard has one of its own.  Other columns are ignored.  An empty table
    writes no shard and gives no rows.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    return read_token_shards(materialize(write_token_shards(docs, path, end_id), "token_shards"))
