"""Deleted interpolation: the base score by brute force, the mixture's sums, held-out gain."""

import math
import re
import zlib
from collections import Counter

import numpy as np

from tessella.llm import lm_scoring as L


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def check(rows, texts):
    counts = Counter()
    for d, t in texts:
        if zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2:
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = []
    for d, t in texts:
        k = tokens(t)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in k)
        want.append((str(d), len(k), sum(counts[w] > 0 for w in k), n, round(base, 6)))
    got = [(str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows]
    assert sorted(got) == sorted(want)


def test_base_score_and_gain(docs, monkeypatch):
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    scores = []
    for corpus_slice, n_range in ((20_000, 5_000), (L.CORPUS_SLICE, L.RANGE)):  # many slices and ranges, and one
        monkeypatch.setattr(L, "CORPUS_SLICE", corpus_slice)
        monkeypatch.setattr(L, "RANGE", n_range)
        rows = L.score(docs).collect()
        check(rows, texts)
        held = [r for r in rows if r["held_out"]]
        assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
        assert all(r["score"] < 0 for r in rows)
        scores.append([r["score"] for r in sorted(rows, key=lambda r: r["doc_id"])])
    assert np.allclose(*scores, rtol=1e-9)


def test_odd_rows(odd, none):
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check(L.score(odd).collect(), texts)
    assert L.score(none).collect() == []


def table_of(sequences):
    counts = Counter()
    for s in sequences:
        k = [-1, -1, *s]
        for i in range(2, len(k)):
            counts.update([(k[i],), tuple(k[i - 1 : i + 1]), tuple(k[i - 2 : i + 1])])
    return counts


def features(counts, sequences, uniform):
    c, t = [], []
    for s in sequences:
        k = [-1, -1, *s]
        for i in range(2, len(k)):
            grams = [tuple(k[i - o : i + 1]) for o in range(3)]
            c.append([counts[g] for g in grams])
            t.append([sum(n for g, n in counts.items() if len(g) == o + 1 and g[:-1] == grams[o][:-1]) for o in range(3)])
    return L.mixed(np.array(c), np.array(t), 0, uniform)


def test_probabilities_of_all_symbols_sum_to_one():
    counts = table_of([[3, 4, 3, 2], [4, 4, 1, 2], [3, 2]] * 3)
    for before in ([3, 4], [4, 1], [4, 4]):
        p, bucket = features(counts, [[*before, s] for s in range(5)], 1 / 5)
        assert abs((10 ** L.log10_of(p, bucket, L.first_weights()))[2::3].sum() - 1) < 1e-9


def test_em_raises_held_out_likelihood():
    rng = np.random.default_rng(0)
    make = lambda n: [[*(3 + np.cumsum(rng.integers(0, 2, 30)) % 6), 2] for _ in range(n)]
    p, bucket = features(table_of(make(60)), make(15), 1 / 9)
    weights = L.first_weights()
    before = L.log10_of(p, bucket, weights).sum()
    for _ in range(4):
        uses = L.uses_of(p, bucket, weights) + 1e-9
        weights = uses / uses.sum(axis=1, keepdims=True)
        assert L.log10_of(p, bucket, weights).sum() >= before - 1e-6
        before = L.log10_of(p, bucket, weights).sum()


def test_ngrams_of_texts_that_share_words():
    rng = np.random.default_rng(2)
    words = rng.integers(1, 1 << 63, 6).astype(np.uint64)
    texts = [[*rng.integers(0, 5, rng.integers(0, 12)), 5] for _ in range(80)]
    hashes, at = L.ngrams(np.concatenate(texts), np.array([len(t) for t in texts]), words)
    assert len(np.unique(hashes)) == len(hashes)
    seen = {}
    for k, row in zip([t[max(0, i - o) : i + 1] if i >= o else [-1] * (o - i) + t[: i + 1] for t in [list(map(int, t)) for t in texts] for i in range(len(t)) for o in range(3)], at.ravel(), strict=True):
        assert seen.setdefault(tuple(k), row) == row
    assert len(seen) == len(set(seen.values())) == len(hashes)


def test_packed_numbers():
    rng = np.random.default_rng(3)
    for values in (np.zeros(0, np.uint64), np.array([0, 5], np.uint64), rng.integers(0, 1 << 63, 999).astype(np.uint64), np.array([(1 << 64) - 1], np.uint64)):
        assert (L.unpacked(L.packed(values)) == values).all()
    order, ordered = L.ascending(values := rng.integers(0, 1 << 63, 999).astype(np.uint64), 63)
    assert (values[order] == ordered).all() and (np.sort(values) == ordered).all()


def test_scores_use_every_ngram(spark, monkeypatch):
    """The scores against the same mixture over all words and n-grams of the corpus in plain Python."""
    monkeypatch.setattr(L, "CORPUS_SLICE", 3_000)
    monkeypatch.setattr(L, "RANGE", 2_000)
    rng = np.random.default_rng(1)
    texts = [(i, " ".join(f"w{x}" for x in rng.zipf(1.3, 60) if x < 10**6)) for i in range(300)]
    part = lambda d: 0 if L.crc_fold(d, 7) == 2 else 1 if L.crc_fold(d, 70) >= 7 else 2
    rows = {r["doc_id"]: r for r in L.score(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)).collect()}

    def count(parts):
        grams, ctx, words = Counter(), Counter(), Counter()
        for d, t in texts:
            if part(d) in parts:
                k = [0, 0, *tokens(t)]
                for i in range(2, len(k)):
                    words[k[i]] += 1
                    for o in (1, 2):
                        grams[o, *k[i - o : i + 1]] += 1
                        ctx[o, *k[i - o : i]] += 1
        return grams, ctx, words

    def features(text, counted):
        grams, ctx, words = counted
        n, unknown = sum(words.values()), max(sum(c == 1 for c in words.values()), 1)
        k = [0, 0, *tokens(text)]
        for i in range(2, len(k)):
            short, long = ctx[1, k[i - 1]], ctx[2, k[i - 2], k[i - 1]]
            p = [1 / (len(words) + 1), (words[k[i]] or unknown) / (n + unknown)]
            p += [grams[1, *k[i - 1 : i + 1]] / short if short else 0, grams[2, *k[i - 2 : i + 1]] / long if long else 0]
            yield p, min(int(math.log2(1 + (long or short))), 15) + 16 * (long > 0)

    held = [f for d, t in texts if part(d) == 2 for f in features(t, count({1}))]
    may = np.array([[1, 1, b > 0, b > 15] for b in range(32)], float)
    weights = may / may.sum(axis=1, keepdims=True)
    for _ in range(L.EM_STEPS):
        uses = np.zeros((32, 4))
        for p, b in held:
            uses[b] += np.array(p) * weights[b] / (np.array(p) @ weights[b])
        uses = (uses + 10 * uses.sum(axis=0) / uses.sum() + 1e-6) * may
        weights = uses / uses.sum(axis=1, keepdims=True)
    counted = count({1, 2})
    for d, t in texts:
        assert abs(rows[d]["score"] - sum(math.log10(np.array(p) @ weights[b]) for p, b in features(t, counted))) < 1e-6
