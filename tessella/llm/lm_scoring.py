"""Language-model scores by deleted interpolation.

A text is a sequence of words and one end.  As in the add-one base score, the
events are the words of the training documents and one unknown type, which has
as many counts as there are words seen once.  The sequence is modelled by
maximum-likelihood estimates of trigrams, bigrams, unigrams and a uniform floor.
Their weights depend on a bucket of the context's frequency and come from
expectation-maximisation on counts that were held out of the estimates (a tenth
of the training documents); then both parts are counted together.

All n-grams of all words are counted; none is dropped or merged.  The corpus is
cut into slices of bounded text, and the distinct n-grams of each slice meet
those of the others in two rounds, by ranges of their hash:

1.  Short fingerprints tell which n-grams may occur in several slices.  An
    n-gram whose fingerprint no other has is known where it occurs.
2.  The others are sent with their whole 64-bit hash and their counts, and the
    sums go back to each slice, in the order in which it sent them.

So an n-gram has one entry a slice at most, however frequent it is.  A context's
total is the count of the n-gram that it is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import SLICE_BYTES, fold, map_slices, materialize, release, slices
from tessella.llm.words import words_of

ORDER, BUCKETS, EM_STEPS, HELD_OUT = 3, 32, 6, 10
#: What a document is used for.
SCORED, ESTIMATED, HELD = 0, 1, 2
#: Text of a slice, n-grams of a range, bits of a fingerprint beyond those that number all n-grams, events worked on at a time.
CORPUS_SLICE, RANGE, SPARE_BITS, EVENTS = 2 * SLICE_BYTES, 1_500_000, 3, 400_000
_START = np.uint64(0x9E3779B97F4A7C15)
_TAGS = [np.uint64(t) for t in (0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xABC98388FB8FAC03)]
#: The estimates that a bucket's contexts have: all have the floor and unigrams.
_HALF = BUCKETS // 2
_AVAILABLE = np.ones((BUCKETS, ORDER + 1))
_AVAILABLE[0, 2:] = _AVAILABLE[:_HALF, 3] = 0
#: The end of a text; no word has white space.
END = np.uint64(xxhash.xxh64_intdigest(b"\n"))


def packed(values: np.ndarray) -> bytes:
    """Unsigned whole numbers in the fewest bytes that hold the largest, byte by byte of all, compressed."""
    values = np.ascontiguousarray(values, np.uint64)
    width = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
    planes = values.view(np.uint8).reshape(-1, 8).T[:width].tobytes()
    return bytes([width]) + len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    width, n = data[0], int.from_bytes(data[1:9], "little")
    out = np.zeros((n, 8), np.uint8)
    if n:
        out[:, :width] = np.frombuffer(pa.decompress(data[9:], width * n, codec="zstd"), np.uint8).reshape(width, n).T
    return out.reshape(-1).view(np.uint64)


def ascending(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of values of so many bits, and the values in it."""
    shift = max(len(values) - 1, 1).bit_length()
    if bits + shift <= 64:  # the place fits beside the value: sorting values is quicker than sorting places
        both = np.sort(values << np.uint64(shift) | np.arange(len(values), dtype=np.uint64))
        return (both & np.uint64((1 << shift) - 1)).astype(np.int64), both >> np.uint64(shift)
    order = np.argsort(values)
    return order, values[order]


def distinct(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in ascending order, and the place of each value among them."""
    order, ordered = ascending(values, bits)
    edge = np.ones(len(values), bool)
    edge[1:] = ordered[1:] != ordered[:-1]
    at = np.empty(len(values), np.int64)
    at[order] = np.cumsum(edge) - 1
    return ordered[edge], at


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9FB21C651E98DF25) + b
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    return x ^ x >> np.uint64(31)


def _before(values: np.ndarray, n: np.ndarray, first) -> np.ndarray:
    """Each text's values moved on by one; ``first`` comes before them."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[np.cumsum(n) - n] = first
    return out


def _hash(order: int, context: np.ndarray, event: np.ndarray) -> np.ndarray:
    """Hashes of n-grams from those of their contexts (for a unigram 0) and the last word; the lowest bit marks unigrams."""
    h = _mix(context ^ _TAGS[order - 1], event)
    return h | np.uint64(1) if order == 1 else h & ~np.uint64(1)


def ngrams(codes: np.ndarray, n: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the distinct n-grams, by order and then as they come, and which of these end at each symbol (event x order).

    ``codes`` are places in ``words``, the keys of distinct words; ``n`` is the
    number of symbols of each text.
    """
    start = len(words)
    base, event = np.uint64(start + 1), codes.astype(np.uint64)
    keys, bits = np.append(words, _START), int(start + 1).bit_length()
    two, at_two = distinct(_before(event, n, np.uint64(start)) * base + event, 2 * bits)
    context, last = (two // base).astype(np.int64), (two % base).astype(np.int64)
    hash_two = _hash(2, keys[context], keys[last])
    # the bigram before; a text begins with two marks
    before = _before(at_two, n, len(two)).astype(np.uint64)
    three, at_three = distinct(before * base + event, int(len(two) + 1).bit_length() + bits)
    contexts = np.append(hash_two, _START)[(three // base).astype(np.int64)]
    hash_three = _hash(3, contexts, keys[(three % base).astype(np.int64)])
    hashes = np.concatenate([_hash(1, np.zeros_like(words), words), hash_two, hash_three])
    return hashes, np.stack([codes.astype(np.int64), start + at_two, start + len(two) + at_three], axis=1)


def mixed(counts: np.ndarray, totals: np.ndarray, unknown: float, uniform: float) -> tuple[np.ndarray, np.ndarray]:
    """Each event's estimates (uniform, then by order) and the bucket of its context's frequency.

    ``counts`` and ``totals`` are of its n-grams and their contexts (event x
    order); an event without a count is of the unknown type.
    """
    out = np.empty((len(counts), ORDER + 1))
    out[:, 0] = uniform
    out[:, 1:] = counts / np.maximum(totals, 1)
    out[:, 1] = np.where(counts[:, 0] > 0, counts[:, 0], unknown) / np.maximum(totals[:, 0] + unknown, 1)
    long, short = totals[:, ORDER - 1], totals[:, ORDER - 2]
    level = np.minimum(np.log2(1 + np.where(long > 0, long, short)).astype(np.int64), _HALF - 1)
    return out, level + _HALF * (long > 0)


def log10_of(p: np.ndarray, bucket: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.log10((p * weights[bucket]).sum(axis=1))


def uses_of(p: np.ndarray, bucket: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Expected uses of each estimate, by bucket."""
    share = p * weights[bucket]
    share /= share.sum(axis=1, keepdims=True)
    return np.stack([np.bincount(bucket, share[:, j], BUCKETS) for j in range(ORDER + 1)], axis=1)


def first_weights() -> np.ndarray:
    return _AVAILABLE / _AVAILABLE.sum(axis=1, keepdims=True)


def cut(docs: DataFrame, train_mod: int, scored: int) -> DataFrame:
    """``slice, n_tokens, payload``: bounded parts of the corpus as word keys and codes, packed."""
    schema = pa.schema([("slice", pa.int64()), ("n_tokens", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, made = [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal made
            table = pa.Table.from_batches(held).combine_chunks()
            doc_id, part, text = (table.column(i).combine_chunks() for i in range(3))
            coded, n = words_of(text)
            keys = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
            payload = [pc.fill_null(doc_id, 0).to_numpy().view(np.uint64), doc_id.is_valid().to_numpy(zero_copy_only=False), part.to_numpy(), n, keys, coded.indices.to_numpy()]
            made += 1
            row = [[TaskContext.get().partitionId() << 32 | made], [int(n.sum()) + len(n)], [_joined([packed(v) for v in payload])]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            for part in slices(batch, limit=CORPUS_SLICE):
                here = part.column(2).nbytes
                if held and size + here > CORPUS_SLICE:
                    yield flush()
                    held, size = [], 0
                held.append(part)
                size += here
        if held:
            yield flush()

    part = F.when(fold("doc_id", train_mod) == scored, SCORED).when(fold("doc_id", train_mod * HELD_OUT) >= train_mod, ESTIMATED).otherwise(HELD)
    return docs.select("doc_id", part.cast("int").alias("part"), "text").mapInArrow(run, "slice long, n_tokens long, payload binary")


def _joined(parts: list[bytes]) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _parted(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 8], "little")
        out.append(data[at + 8 : at + 8 + n])
        at += 8 + n
    return out


class Slice:
    """The n-grams of one slice in the order of their fingerprints, and their counts in its two training parts."""

    def __init__(self, payload: bytes, bits: int, ranges: int):
        doc_id, known, part, n, words, codes = (unpacked(p) for p in _parted(payload))
        self.doc_id = pa.array(doc_id.view(np.int64), mask=known == 0)
        self.part, self.n = part.astype(np.int64), n.astype(np.int64) + 1
        flat = np.full(int(self.n.sum()), len(words), np.int64)
        own = np.ones(len(flat), bool)
        own[np.cumsum(self.n) - 1] = False
        flat[own] = codes
        hashes, at = ngrams(flat, self.n, np.append(words, END))
        self.n_words = len(words) + 1
        self.order, finger = ascending(hashes >> np.uint64(64 - bits), bits)
        self.keys, self.finger = hashes[self.order], finger
        place = np.empty(len(hashes), np.int64)
        place[self.order] = np.arange(len(hashes))
        self.at = place[at]
        edges = [(r << bits) // ranges for r in range(ranges)]
        self.ends = np.append(np.searchsorted(finger, np.array(edges[1:], np.uint64)), len(finger)).astype(np.int64)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        part = np.repeat(self.part, self.n)
        return tuple(np.bincount(self.at[part == p].ravel(), minlength=len(self.keys)) for p in (ESTIMATED, HELD))

    def by_range(self) -> Iterator[tuple[int, int, int]]:
        """The number, begin and end of each range that has n-grams."""
        begin = 0
        for r, end in enumerate(self.ends.tolist()):
            if end > begin:
                yield r, begin, end
            begin = end


def _deltas(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=np.uint64(0))


_PARTS = "range long, slice long, data binary"
_ANSWER = "slice long, range long, kind int, data binary, types long, once long, types_est long, once_est long"
_STATE = ("types", "once", "types_est", "once_est")


def _answer(slice_: list[int], range_: int, kind: int, data: list[bytes], state: list[int]) -> pa.Table:
    n = len(data)
    columns = [pa.array(slice_, pa.int64()), pa.array([range_] * n, pa.int64()), pa.array([kind] * n, pa.int32()), pa.array(data, pa.binary())]
    columns += [pa.array([int(x)] + [0] * (n - 1), pa.int64()) for x in state]
    return pa.table(columns, names=["slice", "range", "kind", "data", *_STATE])


def shared_ngrams(corpus: DataFrame, bits: int, ranges: int) -> DataFrame:
    """For each slice and range the n-grams (bits in their order) whose fingerprint occurs more than once in all slices."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                s = Slice(payload.as_py(), bits, ranges)
                found = [(r, packed(_deltas(s.finger[a:b]))) for r, a, b in s.by_range()]
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in found], pa.int64()), pa.array([i] * len(found), pa.int64()), pa.array([d for _, d in found], pa.binary())], ["range", "slice", "data"])

    def meet(table: pa.Table) -> pa.Table:
        finger = [np.cumsum(unpacked(d.as_py()), dtype=np.uint64) for d in table.column("data")]
        n = np.cumsum([len(f) for f in finger])
        order, ordered = ascending(np.concatenate(finger), bits)
        same = ordered[1:] == ordered[:-1]
        several = np.zeros(len(order), bool)
        several[order[1:][same]] = several[order[:-1][same]] = True
        data = [np.packbits(b).tobytes() for b in np.split(several, n[:-1])]
        return _answer(table.column("slice").to_pylist(), table.column("range")[0].as_py(), 0, data, [0] * 4)

    return corpus.select("slice", "payload").mapInArrow(send, _PARTS).groupBy("range").applyInArrow(meet, _ANSWER)


def _flags(s: Slice, rows: pa.Table) -> np.ndarray:
    """Which n-grams of a slice are shared, from its answers of kind 0."""
    bits = {r: d for r, k, d in zip(rows.column("range").to_pylist(), rows.column("kind").to_pylist(), rows.column("data"), strict=True) if k == 0}
    parts = [np.unpackbits(np.frombuffer(bits[r].as_py(), np.uint8), count=b - a) for r, a, b in s.by_range()]
    return np.concatenate(parts).astype(bool)


def summed_counts(corpus: DataFrame, flags: DataFrame, bits: int, ranges: int) -> DataFrame:
    """For each slice and range the counts of its shared n-grams in all slices, in their order."""

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        s = Slice(left.column("payload")[0].as_py(), bits, ranges)
        shared, counts = _flags(s, right), s.counts()
        found = []
        for r, a, b in s.by_range():
            mine = a + np.flatnonzero(shared[a:b])
            if len(mine):
                found.append((r, _joined([packed(_deltas(s.keys[mine])), *(packed(c[mine]) for c in counts)])))
        return pa.table([pa.array([r for r, _ in found], pa.int64()), pa.array([left.column("slice")[0].as_py()] * len(found), pa.int64()), pa.array([d for _, d in found], pa.binary())], names=["range", "slice", "data"])

    def total(table: pa.Table) -> pa.Table:
        parts = [_parted(d.as_py()) for d in table.column("data")]
        keys = [np.cumsum(unpacked(p[0]), dtype=np.uint64) for p in parts]
        n = np.cumsum([len(k) for k in keys])
        all_keys, at = distinct(np.concatenate(keys), 64)
        est, held = (np.bincount(at, np.concatenate([unpacked(p[j]) for p in parts]), len(all_keys)).astype(np.int64) for j in (1, 2))
        word = (all_keys & np.uint64(1)).astype(bool)
        both = est + held
        state = [(word & (c > 0)).sum() if some else (word & (c == 1)).sum() for c in (both, est) for some in (True, False)]
        data = [_joined([packed(est[i]), packed(held[i])]) for i in np.split(at, n[:-1])]
        return _answer(table.column("slice").to_pylist(), table.column("range")[0].as_py(), 1, data, state)

    sent = corpus.select("slice", "payload").groupBy("slice").cogroup(flags.groupBy("slice")).applyInArrow(send, _PARTS)
    return sent.groupBy("range").applyInArrow(total, _ANSWER)


def look_up(corpus: DataFrame, answers: DataFrame, bits: int, ranges: int) -> DataFrame:
    """One row per slice: its documents with the counts of their n-grams in all training documents.

    ``held`` has the counts in the estimating part, for the held training
    documents.  The numbers of types, and of types seen once, add up to those of
    the corpus; ``docs`` and ``tokens`` are of training documents.
    """

    def fill(left: pa.Table, right: pa.Table) -> pa.Table:
        s = Slice(left.column("payload")[0].as_py(), bits, ranges)
        shared = _flags(s, right)
        est, held = s.counts()
        back = {r: _parted(d.as_py()) for r, k, d in zip(right.column("range").to_pylist(), right.column("kind").to_pylist(), right.column("data"), strict=True) if k == 1}
        for r, a, b in s.by_range():
            if r in back:
                mine = a + np.flatnonzero(shared[a:b])
                est[mine], held[mine] = (unpacked(d).astype(np.int64) for d in back[r])
        own = (s.keys & np.uint64(1)).astype(bool) & ~shared
        both = est + held
        state = [(own & (c > 0)).sum() if some else (own & (c == 1)).sum() for c in (both, est) for some in (True, False)]
        state = [int(x) + int(pc.sum(right.column(name)).as_py() or 0) for x, name in zip(state, _STATE, strict=True)]
        counts, begin = both[s.at], np.cumsum(s.n) - s.n
        known, base = np.add.reduceat((counts[:, 0] > 0).astype(np.int64), begin), np.add.reduceat(np.log10(counts[:, 0] + 1.0), begin)
        is_held = s.part == HELD
        apart = est[s.at[np.repeat(is_held, s.n)]]
        scored = _joined([packed(v) for v in (s.doc_id.fill_null(0).to_numpy().view(np.uint64), s.doc_id.is_valid().to_numpy(zero_copy_only=False), s.part == SCORED, s.n, known, base.view(np.uint64), *counts.T)])
        out = _joined([packed(v) for v in (s.n[is_held], *apart.T)])
        train = {p: (int((s.part == p).sum()), int(s.n[s.part == p].sum())) for p in (ESTIMATED, HELD)}
        numbers = [*state, train[ESTIMATED][0] + train[HELD][0], train[ESTIMATED][1] + train[HELD][1], *train[ESTIMATED]]
        return pa.table([pa.array([scored], pa.binary()), pa.array([out], pa.binary()), *(pa.array([x], pa.int64()) for x in numbers)], names=["scored", "held", *_NUMBERS])

    schema = "scored binary, held binary, " + ", ".join(f"{c} long" for c in _NUMBERS)
    return corpus.select("slice", "payload").groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(fill, schema)


_NUMBERS = (*_STATE, "docs", "tokens", "docs_est", "tokens_est")


def _numbers(n: np.ndarray, counts: np.ndarray, n_docs: int, n_all: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Counts and context totals (event x order) of runs of documents with a bounded number of events, if no text is longer."""
    ends, first = np.cumsum(n), 0
    while first < len(n):
        done = int(ends[first - 1]) if first else 0
        upto = max(int(np.searchsorted(ends, done + EVENTS)), first + 1)
        here = counts[done : ends[upto - 1]]
        totals = np.empty_like(here)
        totals[:, 0] = n_all
        for k in range(1, ORDER):
            totals[:, k] = _before(here[:, k - 1], n[first:upto], n_docs)
        yield slice(first, upto), here, totals
        first = upto


def fit(looked: DataFrame, n_docs: int, n_all: int, unknown: int, types: int) -> np.ndarray:
    """The weights by bucket, from the held documents; the numbers are of the estimating part."""
    weights = first_weights()
    for _ in range(EM_STEPS):

        def expect(batch: pa.RecordBatch, weights=weights) -> dict:
            uses = np.zeros((BUCKETS, ORDER + 1))
            for row in batch.column(0):
                n, *counts = (unpacked(p).astype(np.int64) for p in _parted(row.as_py()))
                for _, here, totals in _numbers(n, np.stack(counts, axis=1), n_docs, n_all):
                    uses += uses_of(*mixed(here, totals, unknown, 1 / (types + 1)), weights)
            return {"uses": [uses.ravel().tolist()]}

        sums = map_slices(looked.select("held"), expect, "uses array<double>", "held").agg(F.array(*[F.sum(F.col("uses")[i]) for i in range(BUCKETS * (ORDER + 1))])).first()
        uses = np.array([x or 0.0 for x in sums[0]]).reshape(BUCKETS, ORDER + 1)
        if not uses.any():  # nothing was held out
            break
        # a bucket with little evidence leans to the weights of all
        uses += 10 * uses.sum(axis=0) / max(uses.sum(), 1e-9) + 1e-6
        uses *= _AVAILABLE
        weights = uses / uses.sum(axis=1, keepdims=True)
    return weights


def score(docs: DataFrame, train_mod: int = 7, scored: int = 2) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each row.

    Documents whose ``crc32(doc_id as text) mod train_mod`` is ``scored`` are
    held out, all others train.  ``base_score`` is the add-one unigram score,
    ``score`` the model's; both are log10 probabilities of the whole text.  Null
    text is empty: its one token is the end.  A null doc_id counts as the empty
    text in the fold.  Repeated rows are scored each, and count each where they
    train.  A text longer than a slice is a slice of its own.  Other columns are
    ignored.  An empty table gives no rows; without training documents all words
    are unknown and the model is uniform.
    """
    corpus = materialize(cut(docs, train_mod, scored), "corpus", "none")
    n_tokens = corpus.agg(F.sum("n_tokens")).first()[0] or 1
    # every token ends three n-grams; ranges and fingerprints follow their number
    bits, ranges = min(40, (ORDER * n_tokens).bit_length() + SPARE_BITS), -(-ORDER * n_tokens // (2 * RANGE))
    flags = materialize(shared_ngrams(corpus, bits, ranges), "flags", "none")
    sums = materialize(summed_counts(corpus, flags, bits, ranges), "sums", "none")
    looked = materialize(look_up(corpus, flags.unionByName(sums), bits, ranges), "looked", "none")
    for table in (corpus, flags, sums):
        release(table)
    sums = looked.agg(*[F.sum(c) for c in _NUMBERS]).first()
    types, once, types_est, once_est, n_docs, total, docs_est, n_est = (x or 0 for x in sums)
    weights = fit(looked, docs_est, n_est, max(once_est, 1), types_est)

    def evaluate(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("doc_id", "held_out", "n_tokens", "n_known", "base", "score")}
        for row in batch.column(0):
            doc_id, valid, held_out, n, known, base, *counts = (unpacked(p) for p in _parted(row.as_py()))
            n, scores = n.astype(np.int64), np.empty(len(n))
            for at, here, totals in _numbers(n, np.stack([c.astype(np.int64) for c in counts], axis=1), n_docs, total):
                lp = log10_of(*mixed(here, totals, max(once, 1), 1 / (types + 1)), weights)
                scores[at] = np.add.reduceat(lp, np.cumsum(n[at]) - n[at])
            values = (pa.array(doc_id.view(np.int64), mask=valid == 0), pa.array(held_out.astype(bool)), pa.array(n), pa.array(known.astype(np.int64)), pa.array(base.view(float)), pa.array(scores))
            for c, v in zip(out, values, strict=True):
                out[c].append(v)
        return {c: pa.concat_arrays(v) for c, v in out.items()}

    floor = float(np.log10(total + types + 1))
    return map_slices(looked.select("scored"), evaluate, "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double", "scored").select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(floor)).alias("base_score"),
        "score",
    )


def crc_fold(doc_id: int | None, mod: int) -> int:
    """The fold of one id, as :func:`tessella.llm.common.fold` gives it."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % mod
