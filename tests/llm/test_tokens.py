"""Packing, token output and token counts against the tokenizers library."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tessella.llm import pretokens
from tessella.llm.packing import best_fit, dual_bound, fractional_cover, pack, placements, plan_sequences
from tessella.llm.pretokens import encoder
from tessella.llm.token_counts import counter, token_counts
from tessella.llm.token_output import Shard, read_token_shards, token_output, write_shard, write_token_shards

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def library_ids(path, texts, end=()):
    return [[*e.ids, *end] for e in Tokenizer.from_file(path).encode_batch(list(texts), add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_cached_ids_equal_the_library(path):
    rnd = random.Random(7)
    alphabet = list("ab AB 12.,é's't'll\n\t\x1c\x1f\x85\xa0 ßÄéİǅⅧ²½٣の漢😀́ͅΣ") + ["<|endoftext|>"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    texts += ["", " ", "\n\nx", "x   y    \n  z", "a" * 3000, "aaaa " * 40, "it's  we're\r\n"]
    want = library_ids(path, texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder(path).of_texts(texts)] == want
    texts += [None, "漢字" * 3000, "a\u00a0 b", "a \u3000\u2003 b"]
    want += library_ids(path, [t or "" for t in texts[-4:]])
    for at in range(0, len(texts), 250):
        ids, ends = encoder(path).of_column(pa.array(["x y", *texts[at : at + 250]]).slice(1), 2)
        assert [i.tolist() for i in np.split(ids, ends[:-1])] == [[*w, 2] for w in want[at : at + 250]]
    if path == WORD:
        assert counter(path).of_texts([t or "" for t in texts]) == [len(w) for w in want]


@pytest.mark.parametrize("limit", [40, 400])
def test_a_full_cache_keeps_what_recurs(monkeypatch, docs, limit):
    monkeypatch.setattr(pretokens, "CACHED_PIECES", limit)
    monkeypatch.setattr(pretokens, "GENERATION", limit)
    column, cached = pa.array([r["text"] for r in docs.collect()]), pretokens.CachedEncoder(WORD)
    want = library_ids(WORD, column.to_pylist())
    for at in range(0, len(column), 20):
        ids, ends = cached.of_column(column.slice(at, 20))
        assert [i.tolist() for i in np.split(ids, ends[:-1])] == want[at : at + 20]
        assert all(len(p) <= pretokens.LONG for p in cached.table.rows)


def check_packing(rows, texts):
    want = dict(zip(texts, library_ids(BYTE, texts.values(), [2]), strict=True))
    seen, used = defaultdict(list), defaultdict(list)
    for r in rows:
        seen[r["doc_id"]].append(r)
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    assert seen.keys() == want.keys()
    for doc_id, pieces in seen.items():
        at = 0
        for k, r in enumerate(sorted(pieces, key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            assert r["length"] == 1024 or k == 0
            assert r["ids_crc32"] == crc(want[doc_id][at : at + r["length"]])
            at += r["length"]
        assert at == len(want[doc_id])
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return len(used), sum(map(len, want.values()))


def test_packing_of_documents(docs):
    rows = pack(docs).collect()
    n, tokens = check_packing(rows, {r["doc_id"]: r["text"] for r in docs.collect()})
    assert n <= -(-tokens // 1024) + 2


def test_packing_of_odd_rows(odd, none):
    rows = pack(odd).collect()
    assert sum(r["doc_id"] == 3 for r in rows) == 2
    texts = {r["doc_id"]: r["text"] or "" for r in odd.collect() if r["doc_id"] != 3}
    dropped = [r for r in rows if r["doc_id"] != 3]
    assert sorted((r["doc_id"] or -1, r["length"]) for r in dropped if r["piece"] == 0 and r["length"] < 1024) == sorted(
        (d or -1, len(i) % 1024) for d, i in zip(texts, library_ids(BYTE, texts.values(), [2]), strict=True)
    )
    assert pack(none).collect() == []


def test_plan_uses_each_piece_once_and_is_near_the_bound():
    rng = np.random.default_rng(3)
    counts = dict(Counter(np.clip(rng.lognormal(5.5, 0.8, 20000).astype(int), 1, 1024).tolist()))
    plan = plan_sequences(counts)
    used = Counter()
    for config, times in plan:
        assert sum(n * a for n, a in config) <= 1024
        for n, a in config:
            used[n] += a * times
    assert used == Counter(counts)
    n = sum(t for _, t in plan)
    assert n <= -(-sum(k * v for k, v in counts.items()) // 1024) * 1.002 + 2
    keys, _, _ = placements(plan)
    assert (np.diff(keys) > 0).all()


def test_best_fit_and_lp_bound_of_a_hard_histogram():
    counts = {600: 100, 424: 50, 300: 70}
    _, bound = fractional_cover(counts, 1024)
    n = sum(best_fit(counts, 1024).values())
    assert n >= bound - 1e-6 and n == 107


def test_the_program_packs_small_histograms_too():
    # best fit by itself needs 4 sequences of these pieces: 500 + 300 + 224 and 400 + 324 + 300 are full
    counts = {500: 1, 300: 2, 224: 1, 400: 1, 324: 1}
    amounts, bound = fractional_cover(counts, 1024)
    covered = Counter()
    for config, x in amounts.items():
        for n, a in config:
            covered[n] += a * x
    assert all(covered[n] >= c - 1e-6 for n, c in counts.items()) and 1.9 < bound <= 2 + 1e-6
    assert sum(t for _, t in plan_sequences(counts)) == 2


def test_the_cover_is_near_its_bound_with_every_length():
    counts = {n: 40 for n in range(1, 1024)}
    amounts, bound = fractional_cover(counts, 1024)
    covered = Counter()
    for config, x in amounts.items():
        assert sum(n * a for n, a in config) <= 1024
        for n, a in config:
            covered[n] += a * x
    assert all(covered[n] >= c - 1e-6 for n, c in counts.items())
    assert bound - 1e-6 <= sum(amounts.values()) <= 1.002 * bound


@pytest.mark.parametrize(("draw", "gap"), [(lambda r: r.lognormal(5.5, 0.8, 20000), 0.002), (lambda r: r.lognormal(6.0, 0.7, 20000), 0.002), (lambda r: r.integers(1, 1024, 6000), 0.005), (lambda r: r.integers(300, 1024, 20000), 0.002)])
def test_the_program_is_solved_to_a_gap(draw, gap):
    """A cover that covers exactly, near a bound that holds for any prices, and a plan no worse than best fit alone."""
    counts = dict(Counter(np.clip(draw(np.random.default_rng(7)).astype(int), 1, 1023).tolist()))
    amounts, bound = fractional_cover(counts, 1024)
    covered = Counter()
    for config, x in amounts.items():
        assert x > 0 and sum(n * a for n, a in config) <= 1024
        for n, a in config:
            covered[n] += a * x
    assert all(abs(covered[n] - c) < 1e-5 for n, c in counts.items()) and covered.keys() == counts.keys()
    assert sum(n * c for n, c in counts.items()) / 1024 <= bound <= sum(amounts.values()) <= (1 + gap) * bound
    n = sum(t for _, t in plan_sequences(counts))
    assert bound <= n <= (1 + gap) * bound + 3 and n <= sum(best_fit(counts, 1024).values())


def test_no_prices_are_worth_more_than_the_bound():
    counts = {600: 100, 424: 50, 300: 70}  # 100 with a 600 each, which leave 20 of 300 over: three to a sequence
    assert abs(dual_bound(counts, 1024) - (100 + 20 / 3)) < 1e-6


def check_output(rows, texts):
    want = library_ids(WORD, [t or "" for _, t in texts], [2])
    start = 0
    got = sorted(((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows))
    for (s, d, n, c), (doc_id, _), ids in zip(got, texts, want, strict=True):
        assert (s, d, n, c) == (start, doc_id, len(ids), crc(ids))
        start += len(ids)


def test_token_output(docs, odd, none):
    check_output(token_output(docs).collect(), sorted((r["doc_id"], r["text"]) for r in docs.collect()))
    key = lambda x: (x[0] is not None, x[0] or 0, x[1] or "")
    check_output(token_output(odd).collect(), sorted(((r["doc_id"], r["text"]) for r in odd.collect()), key=key))
    assert token_output(none).collect() == []


def shard_of(doc_ids, ids, start):
    return write_shard(doc_ids, np.concatenate(ids).astype(np.uint32), np.cumsum([len(i) for i in ids]), start)


def test_shard_random_access_and_compression(docs):
    texts = [r["text"] for r in docs.limit(60).collect()]
    ids = library_ids(WORD, texts, [2])
    data = shard_of(list(range(len(ids))), ids, 5)
    shard = Shard(data)
    assert (len(shard), shard.start) == (60, 5)
    assert len(data) < 4 * sum(map(len, ids))
    for i in range(60):
        assert shard.document(i).tolist() == ids[i]
    assert [shard.token(9, k) for k in range(len(ids[9]))] == ids[9]


@pytest.mark.parametrize("seed", range(5))
def test_shard_round_trip_of_runs(seed):
    rng = np.random.default_rng(seed)
    ids = [np.append(rng.integers(0, 3, rng.integers(0, 400)), 2) for _ in range(40)]
    shard = Shard(shard_of([None, *range(39)], ids, 0))
    assert shard.ids().tolist() == np.concatenate(ids).tolist()
    assert shard.has_id.tolist() == [0] + [1] * 39


@pytest.mark.parametrize("seed", range(3))
def test_no_pair_is_left_twice(seed, docs):
    rng = np.random.default_rng(seed)
    ids = library_ids(WORD, [r["text"] for r in docs.limit(40).collect()], [2]) if not seed else [np.append(rng.integers(0, 2 + seed, rng.integers(0, 300)), 2) for _ in range(30)]
    shard, pairs = Shard(shard_of(list(range(len(ids))), ids, 0)), Counter()
    begin = 0
    for end in shard.symbol_end.tolist():
        symbols, begin, k = shard.symbols[begin:end].tolist(), end, 0
        while k + 1 < len(symbols):
            pairs[symbols[k], symbols[k + 1]] += 1
            # of a run every other pair
            k += 2 if symbols[k] == symbols[k + 1] and symbols[k + 1 : k + 3] == [symbols[k]] * 2 else 1
    assert max(pairs.values(), default=0) <= 1
    uses = Counter(shard.symbols.tolist()) + Counter(shard.rules.ravel().tolist())
    assert all(uses[shard.base + k] for k in range(len(shard.rules)))


def test_shards_are_in_order(docs):
    shards = write_token_shards(docs, WORD).orderBy("task", "shard").collect()
    ids = np.concatenate([Shard(bytes(r["file"])).doc_id for r in shards])
    assert (np.diff(ids) > 0).all()
    assert read_token_shards(write_token_shards(docs, WORD)).count() == docs.count()


def test_token_counts(docs, odd, none):
    for table in (docs, odd):
        rows = sorted(((r["doc_id"] or -1, r["text"] or "") for r in table.collect()))
        got = sorted(((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts(table).collect()))
        want = sorted((d, len(t.encode()), len(i), len(i) > 2048) for (d, t), i in zip(rows, library_ids(WORD, [t for _, t in rows]), strict=True))
        assert got == want
    assert token_counts(none).collect() == []
