"""Exact dedup and the Jaccard join against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.llm import exact_dedup as D
from tessella.llm import jaccard as J


def check_dedup(rows, texts):
    digest = lambda t: hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()
    groups = defaultdict(list)
    for d, t in texts:
        groups[digest(t)].append(d)
    want = []
    for h, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(str(i), str(keep), len(ids), i == keep, h) for i in ids]
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"], r["text_sha256"]) for r in rows) == sorted(want)


def test_exact_dedup(docs, odd, none):
    for table in (docs, odd):
        check_dedup(D.exact_dedup(table).collect(), [(r["doc_id"], r["text"]) for r in table.collect()])
    assert D.exact_dedup(none).collect() == []


def test_history_and_rest_agree_at_any_cut(docs):
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for cut in (-1, 50, 10**9):
        check_dedup(D.exact_dedup(docs, cut).collect(), texts)


def test_hot_group(spark):
    table = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'same  text' ELSE concat('text ', id) END AS text")
    rows = D.exact_dedup(table).collect()
    assert sum(r["kept"] for r in rows) == 2001 and max(r["group_size"] for r in rows) == 1000


def test_keep_first(odd):
    kept = D.keep_first(odd)
    assert kept.columns == odd.columns
    # 2, 3, 3 and 4 are repeats of others (an empty text, or one up to white space)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 2, 5, 6, 7, None, 9, 10]))


def test_keep_first_by_id_and_text(spark):
    rows = [(1, "alpha", 1), (1, "beta", 2), (2, "gamma", 3), (3, "beta", 4), (1, "alpha", 5), (None, "delta", 6), (None, "delta", 6), (None, "beta", 7)]
    table = spark.createDataFrame(rows, "doc_id long, text string, _n int").repartition(3)
    kept = D.keep_first(table)
    assert kept.columns == table.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(str, [(1, "alpha"), (1, "beta"), (2, "gamma"), (None, "delta")]))


def test_the_look_up_decides(docs, monkeypatch):
    want = sorted(map(tuple, D.exact_dedup(docs).collect()))
    assert any(r[5] for r in want) and not all(r[5] for r in want)
    monkeypatch.setattr(D, "find_slots", lambda keys, sizes, bitmap: np.full(len(keys), -1))
    blind = sorted(map(tuple, D.exact_dedup(docs).collect()))
    assert [r[:4] for r in blind] != [r[:4] for r in want]


def test_many_rows_beside_a_short_history(spark, monkeypatch):
    monkeypatch.setattr(D, "SHARD_DIGESTS", 50)
    table = spark.range(2000).selectExpr("CASE WHEN id < 3 THEN id END AS doc_id", "concat('text ', id div 2) AS text")
    texts = [(r["doc_id"], r["text"]) for r in table.collect()]
    shards = []
    look_up = D.look_up
    monkeypatch.setattr(D, "look_up", lambda groups, index, n: shards.append(n) or look_up(groups, index, n))
    check_dedup(D.exact_dedup(table).collect(), texts)
    assert shards == [1000]  # not the two digests of the history


def test_perfect_hash_is_minimal_and_refuses_strangers():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 256, (5000, 32), np.uint8)
    sizes, bitmap, slot = D.build_shard(keys)
    assert sorted(slot.tolist()) == list(range(5000))
    assert (D.find_slots(keys, sizes, bitmap) == slot).all()
    stored = keys[np.argsort(slot)]
    other = rng.integers(0, 256, (5000, 32), np.uint8)
    at = D.find_slots(other, sizes, bitmap)
    assert not (stored[at[at >= 0]] == other[at >= 0]).all(axis=1).any()


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(texts):
    sets = [(d, shingles(t)) for d, t in texts]
    low = {d: d for d, _ in sets}

    def find(d):
        while low[d] != d:
            d = low[d]
        return d

    for i, (d, a) in enumerate(sets):
        for e, b in sets[:i]:
            shared = len(a & b)
            if shared and 100 * shared >= 80 * len(a | b):
                x, y = sorted((find(d), find(e)))
                low[y] = x
    return {(d, len(s), find(d)) for d, s in sets}


def families(seed, n):
    """Near copies at and about the threshold, chains, stars, passages that all share, and long and short texts."""
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefghij") + str(rnd.randint(0, 400))
    passage = [word() for _ in range(40)]
    texts = []
    while len(texts) < n:
        base = [word() for _ in range(rnd.choice([1, 3, 5, 6, 9, 14, 30, 80, 200]))]
        for _ in range(rnd.choice([1, 1, 2, 4, 12])):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
                copy[rnd.randrange(len(copy))] = word()
            if rnd.random() < 0.3:
                copy += passage
            texts.append(" ".join(copy))
            if rnd.random() < 0.5:
                base = copy
    rnd.shuffle(texts)
    return [(i * 7 % 1009, t) for i, t in enumerate(texts[:n])]


@pytest.mark.parametrize(("seed", "block"), [(1, 2000), (2, 2000), (3, 4)])
def test_join_against_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(J, "BLOCK", block)
    texts = families(seed, 500)
    rows = J.jaccard_components(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows} == brute_components(texts)
    assert len(rows) == 500


def test_join_of_documents(docs):
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert {tuple(r)[:3] for r in J.jaccard_components(docs).collect()} == brute_components(texts)


def test_join_of_odd_rows(odd, none):
    rows = J.jaccard_components(odd).collect()
    assert len(rows) == odd.count()
    got = {(r["doc_id"], r["component_id"]) for r in rows}
    assert {(2, 2), (3, 3), (9, 9), (1, 1), (4, 1), (None, None)} <= got
    assert J.jaccard_components(none).collect() == []
    kept = J.keep_representatives(odd)
    assert kept.columns == odd.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 3, 5, 6, 7, None, 9, 10]))


def test_an_id_with_two_texts_keeps_its_links(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "a short text"), (1, text), (2, text + " more"), (5, "x y z"), (5, text), (4, "x y z"), (1, text)]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(7)).repartition(3)
    kept = J.keep_representatives(table)
    assert kept.columns == table.columns
    assert sorted((r["doc_id"], r["text"][:7]) for r in kept.collect()) == [(1, "a short"), (1, "w0 w1 w"), (1, "w0 w1 w"), (4, "x y z")]
    got = J.jaccard_components(table).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == [(1, 1, 1), (1, 56, 1), (1, 56, 1), (2, 57, 1), (4, 1, 4), (5, 1, 4), (5, 56, 1)]


def test_divide_skip_equals_counting():
    rnd = random.Random(5)
    sets = [np.array(sorted(rnd.sample(range(60), rnd.randint(3, 40))), np.int64) for _ in range(200)]
    sizes = [len(s) for s in sets]
    lists = J.Lists(sets, sizes)
    frequency = Counter(h for s in sets for h in s.tolist())
    for q in sets[:60]:
        want = [i for i, s in enumerate(sets) if J.linked(len(np.intersect1d(q, s)), len(q), len(s))]
        assert sorted(lists.search(np.array(sorted(q.tolist(), key=lambda h: frequency[h])), len(q))) == want
    lists.remove(range(100))
    assert all(i >= 100 for i in lists.search(sets[3], sizes[3]))


def test_forest():
    f = J.Forest()
    for a, b in [(5, 3), (9, 7), (3, 9), (4, 4), (12, 11)]:
        f.join(a, b)
    assert sorted(f.edges()) == [(3, 3), (4, 4), (5, 3), (7, 3), (9, 3), (11, 11), (12, 11)]


def chain(n):
    """Texts of which each is linked with its neighbours only, so that one pivot covers little."""
    words = [f"w{i}" for i in range(4 * n + 60)]
    return [(10 * n - i, " ".join(words[4 * i : 4 * i + 60])) for i in range(n)]


@pytest.mark.parametrize(("partitions", "coalesce", "block"), [(4, "false", 4), (97, "false", 25), (16, "false", 200)])
def test_large_blocks_however_they_are_dealt(spark, monkeypatch, partitions, coalesce, block):
    """No link may depend on which partition a chunk and its queries come to."""
    monkeypatch.setattr(J, "BLOCK", block)
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    for k, v in zip(held, (str(partitions), coalesce), strict=True):
        spark.conf.set(k, v)
    try:
        n = 80 if block < 200 else 450
        rows = J.jaccard_components(spark.createDataFrame(chain(n), "doc_id long, text string").repartition(4)).collect()
        assert len(rows) == n and {r["component_id"] for r in rows} == {9 * n + 1}
        texts = families(7, 150) if partitions == 4 else []
        if texts:
            rows = J.jaccard_components(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)).collect()
            assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows} == brute_components(texts)
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 200, 1) if i != 90] + [(500, 500)], "a long, b long")
    got = {r["node"]: r["component"] for r in J.connected_components(edges).collect()}
    assert got == {i: 0 if i <= 90 else 91 for i in range(201)} | {500: 500}


@pytest.mark.parametrize("block", [2000, 4])
def test_each_block_is_searched_once(spark, monkeypatch, tmp_path, block):
    """The search makes the links, which the components read more than once."""
    monkeypatch.setattr(J, "BLOCK", block)
    search, links, folder = J.block_components, J._links, str(tmp_path)

    def noted(ids, *others):
        with open(f"{folder}/{min(ids)}", "a") as f:
            f.write(".")
        return search(ids, *others)

    def links_noted(*tables):
        def seen(pdf):  # the rows of one link
            with open(f"{folder}/link-{pdf['a'][0]}-{pdf['b'][0]}", "a") as f:
                f.write(".")
            return pdf

        return links(*tables).groupBy("a", "b").applyInPandas(seen, "a long, b long")

    monkeypatch.setattr(J, "block_components", noted)
    monkeypatch.setattr(J, "_links", links_noted)
    texts = families(4, 120)
    rows = J.jaccard_components(spark.createDataFrame(texts, "doc_id long, text string").repartition(3)).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows} == brute_components(texts)
    found = {p.name: p.read_text() for p in tmp_path.iterdir()}
    assert any(k.startswith("link-") for k in found) and not all(k.startswith("link-") for k in found)
    assert set(found.values()) == {"."}
