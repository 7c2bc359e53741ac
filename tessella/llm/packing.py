"""Best-fit packing of token sequences by a configuration linear program.

Only the histogram of piece lengths (as many numbers as a sequence has tokens)
reaches the driver.  The configuration LP asks for the fewest sequences whose
length multisets ("configurations") cover the histogram.  It is solved by
multiplicative weights: each length has a price, a knapsack dynamic program
finds the configurations of highest price, these are used until a length is used
up, and from turn to turn the weights of lengths that were placed with room to
spare grow, until the cover is near the dual bound.  The fractional solution is
rounded, the rest is solved again, and the last few pieces are placed best-fit.  This holds at every size of the table.

Pieces learn their sequence from their length and their rank among the pieces
of that length.  A task numbers its own pieces; the counts by task and length
give each task its first rank.  So a length that very many documents share is
never gathered anywhere.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import map_slices, materialize
from tessella.llm.pretokens import encoder

TOKENIZER, END_ID, CAPACITY = "byte_bpe_50k.json", 2, 1024


def price_configurations(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the highest total price for each room up to ``capacity``, and the length taken there (-1: none)."""
    best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    n_fit = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if k := n_fit[c]:
            value = best[c - lengths[:k]] + prices[:k]
            if value[i := int(value.argmax())] > best[c]:
                best[c], take[c] = value[i], i
    return best, take


def fill(lengths: np.ndarray, take: np.ndarray, room: int) -> Counter:
    """The multiset of length indices of highest price in ``room``."""
    out = Counter()
    while room > 0:
        if take[room] < 0:
            room -= 1
        else:
            out[int(take[room])] += 1
            room -= int(lengths[take[room]])
    return out


def dual_prices(lengths: np.ndarray, capacity: int, thresholds: int = 24) -> Iterator[np.ndarray]:
    """Prices whose total is known to be near the least number of sequences.

    They are a piece's share of a sequence; the share rounded down to ``k``-ths
    as ``k + 1`` pieces would have them, by itself and in the mean with the share;
    and the share with pieces under a threshold for nothing, and those that
    leave less room than it for a whole sequence.
    """
    share = lengths / capacity
    yield share
    for k in range(1, 9):
        steps = np.floor((k + 1) * (lengths - 0.5) / capacity) / k
        yield steps
        yield (share + steps) / 2
    for t in np.unique(np.linspace(1, capacity // 2, thresholds).astype(int)):
        yield np.where(lengths > capacity - t, 1.0, np.where(lengths >= t, share, 0.0))


def dual_bound(counts: dict[int, int], capacity: int) -> float:
    """A lower bound on the number of sequences: for any prices, that of all pieces over the highest of a configuration."""
    lengths = np.array(sorted(counts), np.int64)
    need = np.array([counts[i] for i in lengths], float)
    return max(float(p @ need) / best for p in dual_prices(lengths, capacity) if (best := price_configurations(lengths, p, capacity)[0][capacity]) > 0)


def fractional_cover(counts: dict[int, int], capacity: int, turns: int = 6, rate: float = 0.5, gap: float = 0.0004, at_once: int = 64) -> tuple[dict[tuple, float], float]:
    """Configurations with amounts that cover ``counts`` exactly, and a lower bound on the number of sequences.

    A turn covers all pieces: the configuration of highest price that holds a
    length is used until one of its lengths is used up, which then has no price;
    prices are computed anew after ``at_once`` configurations.  Between turns
    the weight of a length grows by the factor ``exp(rate * room)`` of the room
    that its configurations left, so that lengths that are hard to place come
    earlier.  The bound is the best dual seen, of :func:`dual_prices` and of the
    weights at the beginning of each turn.  Turns end when a cover is within
    ``gap`` of it, and the best cover is taken.
    """
    lengths = np.array(sorted(counts), np.int64)
    need = np.array([counts[i] for i in lengths], float)
    size, weight, bound = lengths / capacity, np.zeros(len(lengths)), dual_bound(counts, capacity) if turns > 1 else 0.0  # one turn needs no bound to end
    best_cover: Counter = Counter()
    for _ in range(turns):
        left, room, amounts, first = need.copy(), np.zeros(len(lengths)), Counter(), True
        while len(low := np.flatnonzero(left > 0)):
            some = lengths[low]
            # long pieces are worth a little more than their share: short ones fill gaps later
            prices = size[low] * (1 + size[low] / 10) * np.exp(weight[low])
            best, take = price_configurations(some, prices, capacity)
            if first:
                bound, first = max(bound, float(prices @ need) / best[capacity]), False
            for i in np.argsort(-prices, kind="stable")[:at_once].tolist():
                if not left[low[i]]:
                    continue
                config = fill(some, take, capacity - int(some[i]))
                config[i] += 1
                step = min(left[low[j]] / a for j, a in config.items())
                if not step:
                    continue
                amounts[tuple(sorted((int(some[j]), a) for j, a in config.items()))] += step
                spare = 1 - sum(int(some[j]) * a for j, a in config.items()) / capacity
                for j, a in config.items():
                    at = low[j]
                    left[at] = rest if (rest := left[at] - step * a) > 1e-9 else 0
                    room[at] += step * a * spare
        if not best_cover or sum(amounts.values()) < sum(best_cover.values()):
            best_cover = amounts
        if sum(best_cover.values()) <= bound * (1 + gap):
            break
        weight += rate * room / need
        weight -= weight.min()
    return dict(best_cover), bound


def best_fit(counts: dict[int, int], capacity: int) -> Counter:
    """Longest piece first into the fullest sequence that has room; configurations with counts."""
    room: dict[int, Counter] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            space = min((s for s in room if s >= length), default=None)
            if space is None:
                per = min(capacity // length, left)
                new = Counter({((length, per),): left // per})
                left -= left // per * per
                room.setdefault(capacity - per * length, Counter()).update(new)
                continue
            config, n = next(iter(room[space].items()))
            per = min(space // length, left)
            times = min(n, left // per)
            room[space][config] -= times
            room[space] += Counter()
            if not room[space]:
                del room[space]
            room.setdefault(space - per * length, Counter())[(*config, (length, per))] += times
            left -= per * times
    out = Counter()
    for c in room.values():
        out.update(c)
    return out


def rounded(amounts: dict[tuple, float], left: dict[int, int], least: int, up: float) -> tuple[list[tuple[tuple, int]], dict[int, int]]:
    """Configurations of ``least`` tokens or more as often as their amount plus ``up``, rounded down, and the pieces that are left."""
    left, plan = dict(left), []
    used = {c: x for c, x in amounts.items() if sum(n * a for n, a in c) >= least}
    for config, x in sorted(used.items(), key=lambda kv: (max(n for n, _ in kv[0]), kv[1]), reverse=True):
        times = min([int(x + up + 1e-9), *(left.get(n, 0) // a for n, a in config)])
        if times > 0:
            plan.append((config, times))
            for n, a in config:
                left[n] -= a * times
    return plan, {k: v for k, v in left.items() if v}


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY, passes: int = 3) -> list[tuple[tuple, int]]:
    """``(configuration, times)`` that use each piece of the histogram exactly once.

    The amounts of the first solution are rounded in several ways, all
    configurations or the full ones alone, of which the one with the fewest
    sequences is taken.  Pieces that a rounding leaves are solved for again
    where it was downwards, and at last placed best-fit.
    """
    left, plans = {k: int(v) for k, v in counts.items() if v}, []
    whole = [(((capacity, 1),), left.pop(capacity))] if left.get(capacity) else []
    first = fractional_cover(left, capacity)[0] if left else {}
    for least, up in ((0, 0.0), (0, 0.5), (capacity, 0.0), (capacity, 0.5), (capacity, 1 - 1e-6)):
        plan, rest = rounded(first, left, least, up)
        for _ in range(passes - 1 if not up else 0):
            more, rest = rounded(fractional_cover(rest, capacity, turns=1)[0], rest, least, up) if rest else ([], rest)
            plan += more
        plans.append([*whole, *plan, *best_fit(rest, capacity).items()])
    return min(plans, key=lambda p: sum(n for _, n in p))


def placements(plan: list[tuple[tuple, int]]) -> tuple[np.ndarray, ...]:
    """Sorted by ``length << 40 | first rank``: that key, first sequence and offset of each run of ranks."""
    rows, used, sequence = [], Counter(), 0
    for config, times in plan:
        offset = 0
        for length, per in config:
            for _ in range(per):
                rows.append((length << 40 | used[length], sequence, offset))
                used[length] += times
                offset += length
        sequence += times
    rows.sort()
    return tuple(np.array([r[i] for r in rows], np.int64) for i in range(3))


def token_pieces(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """The pieces of each document with their task and their rank there among pieces of their length."""
    seen, task = np.zeros(capacity + 1, np.int64), [None]

    def cut(batch: pa.RecordBatch) -> dict:
        here = (TaskContext.get().taskAttemptId(), TaskContext.get().partitionId())
        if task[0] != here:
            seen[:] = 0
            task[0] = here
        ids, ends = encoder(path).of_column(batch.column(1), end_id)
        n = np.diff(np.concatenate([[0], ends]))
        pieces = -(-n // capacity)
        own = np.repeat(np.arange(len(n)), pieces)
        piece = np.arange(len(own)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        # the first piece has what the full ones leave
        first = (n - (pieces - 1) * capacity)[own]
        start = np.where(piece == 0, 0, first + (piece - 1) * capacity)
        length = np.where(piece == 0, first, capacity)
        data, at = memoryview(ids.astype("<u4", copy=False)).cast("B"), ((ends - n)[own] + start) * 4
        crc = [zlib.crc32(data[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist(), strict=True)]
        # ranks among the pieces of a length: those of the task so far, then those before it here
        order = np.argsort(length, kind="stable")
        here_first = np.searchsorted(length[order], np.arange(capacity + 1))
        rank = np.empty(len(length), np.int64)
        rank[order] = np.arange(len(length)) - here_first[length[order]]
        rank += seen[length]
        seen[:] += np.bincount(length, minlength=capacity + 1)
        return {"doc_id": batch.column(0).take(pa.array(own)), "piece": piece, "start": start, "length": length, "ids_crc32": crc, "task": np.full(len(own), here[1]), "task_rank": rank}

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, task_rank long"
    return map_slices(docs.select("doc_id", "text"), cut, schema)


def pack(docs: DataFrame, path: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Documents of up to ``capacity`` tokens (the end id counts) stay whole; a
    longer one, of any length, is cut into full sequences after a first piece
    with the rest.  Null text is empty and gives one piece of the end id.
    Repeated rows and null ids are packed each for itself; which of several
    pieces of one length goes to which sequence follows the order of the rows in
    their tasks.  Other columns are ignored.  An empty table gives no rows.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    pieces = materialize(token_pieces(docs, path, end_id, capacity), "pieces")
    by_task = materialize(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "by_task")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    keys, first, offset = placements(plan_sequences(counts, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ranks = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_rank"))
    plan = docs.sparkSession.sparkContext.broadcast((keys, first, offset))  # bounded by capacity, not by the number of documents

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        keys, first, offset = plan.value
        key = length.to_numpy(np.int64) << 40 | rank.to_numpy(np.int64)
        at = np.searchsorted(keys, key, side="right") - 1
        return pd.DataFrame({"sequence_id": first[at] + key - keys[at], "offset": offset[at]})

    placed = pieces.join(ranks, ["task", "length"]).withColumn("at", place("length", F.col("first_rank") + F.col("task_rank")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")
