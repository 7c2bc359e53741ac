"""The Merkle manifest, the divergence audit and decontamination against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessella.llm import decontamination as W
from tessella.llm import divergence as V
from tessella.llm import merkle as M
from tessella.llm import queries as Q


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_source_divergence", "op13_benchmark_decontamination"])
def test_queries_give_the_rows_of_their_sql(spark, sf_dir, name):
    found = Q.queries()[name](spark, sf_dir)
    for t in ("documents", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {t} AS FROM '{sf_dir}/{t}.parquet'")
    want = duckdb.sql(Q.oracle_sql()[name])
    columns = ", ".join(found.columns)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, duckdb.sql(f"SELECT {columns} FROM want").fetchall())) != []


# --- manifest


def leaf(row, text):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(*map(field, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def collapse(nodes):
    """Levels, and each node's (left, right) siblings from its own level up."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    paths = []
    for i in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            run = i // 3 * 3
            path.append(("".join(level[run:i]), "".join(level[i + 1 : run + 3])))
            i //= 3
        paths.append(path)
    return levels[-1][0], paths


def brute_manifest(rows, tamper):
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        own = sorted(by[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[s] = own, *collapse([leaf(r, r["text"]) for r in own])
    root, above = collapse([trees[s][1] for s in order])
    out = []
    for s, up in zip(order, above, strict=True):
        own, subroot, paths = trees[s]
        for r, path in zip(own, paths, strict=True):
            i, path = r["doc_id"], path + up
            text = tamper(r["text"]) if r["text"] is not None and i is not None and zlib.crc32(str(i).encode()) % 2 == 0 else r["text"]
            now = leaf(r, text)
            for a, b in path:
                now = sha(a, now, b)
            out.append((i, leaf(r, r["text"]), subroot, root, sha(*[a + b for a, b in path]), now, now == root))
    return sorted(map(str, out))


def numbered(table):
    return table.withColumn("n_chars", F.when(F.col("doc_id") != 5, F.length("text")).cast("long"))


def test_manifest_of_odd_rows(odd, none):
    table = numbered(odd)
    assert sorted(map(str, map(tuple, M.manifest(table).collect()))) == brute_manifest(table.collect(), lambda t: t.replace("\n", ""))
    assert M.manifest(numbered(none)).collect() == []


def test_manifest_in_small_blocks(spark, monkeypatch):
    """Trees of one, of few and of many blocks of three by three, and more sources than a block holds."""
    monkeypatch.setattr(M, "LEVELS", 2)
    monkeypatch.setattr(M, "BLOCK", 9)
    monkeypatch.setattr(M, "RANGE_ROWS", 40)
    sources = [None, "", "é", "z", *[f"s{i}" for i in range(9)]]
    sizes = [1, 2, 3, 4, 9, 10, 27, 28, 81, 82, 5, 1, 100]
    rows = [(1000 * j + 7 * i % 501, f"a\n{i}" if i % 3 else f"b{i}", "en", s, i) for j, (s, n) in enumerate(zip(sources, sizes, strict=True)) for i in range(n)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("node", F.lit(1)).repartition(5)
    got = M.manifest(table).collect()
    assert sorted(map(str, map(tuple, got))) == brute_manifest(table.collect(), lambda t: t.replace("\n", ""))
    assert {r["verified"] for r in got} == {True, False}


def test_manifest_repeated_rows_and_other_tampering(spark):
    rows = [(1, "x", "en", "a", 1)] * 5 + [(2, None, None, None, None), (4, "y", "en", "a", 1), (6, "", "en", "b", 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = M.manifest(table, lambda t: F.concat(t, F.lit("!"))).collect()
    assert sorted(map(str, map(tuple, got))) == brute_manifest(table.collect(), lambda t: t + "!")
    assert {r["doc_id"]: r["verified"] for r in got} == {i: zlib.crc32(str(i).encode()) % 2 == 1 or i == 2 for i in (1, 2, 4, 6)}


# --- divergence


def brute_divergence(rows, least=30, listed=50):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for r in rows:
        lang, source = r["lang"] or "", r["source"] or ""
        found = re.findall(r"[a-z\u0080-\U0010FFFF]+", lower(r["text"]))
        groups[lang].add(source)
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        share = lambda c: {t: 1 + 1_000_000_000 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}
        whole = share(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: share(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources - {s}]
            terms = [(p[s][t] - whole[t], t) for t in kept if counts[lang, s][t] and p[s][t] > whole[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(items) if part == "pair" or i < listed]
    return sorted(out)


def test_divergence_of_documents_in_many_shards(docs, monkeypatch):
    want = brute_divergence(docs.collect())
    monkeypatch.setattr(V, "SHARD_COUNTS", 37)
    monkeypatch.setattr(V, "SHARD_BYTES", 20_000)
    assert sorted(map(tuple, V.divergence(docs).collect())) == want


def test_divergence_of_odd_rows(spark, odd, none):
    assert V.divergence(none).collect() == []
    assert sorted(map(tuple, V.divergence(odd).collect())) == brute_divergence(odd.collect())
    rows = [(i, "alpha BETA gamma's é" if i % 3 else "beta beta 漢字 ALPHA", "en" if i % 7 else None, ["a", "b", None, ""][i % 4]) for i in range(400)]
    rows += [(500, "rare terms", "de", "a"), (501, None, "de", "b"), (502, "x", "de", "c"), (503, "", "en", "without terms"), (504, "alone", "fr", "a"), *[(7, "beta", "en", "a")] * 40]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("term", F.lit(1)).repartition(5)
    got = sorted(map(tuple, V.divergence(table).collect()))
    assert got == brute_divergence(table.collect())
    assert ("de", "a", "pair", "b", 0, 1) in got and ("de", "a", "pair", "c", 0, 2) in got


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(V, "TEXT_BYTES", 17)
    data = np.frombuffer(("abc déf " * 40 + "ü" * 90).encode(), np.uint8)
    parts = list(V._chunks(data))
    term = re.compile(r"[a-z\u0080-\U0010FFFF]+")
    assert "".join(parts).encode() == data.tobytes() and [w for p in parts for w in term.findall(p)] == term.findall(data.tobytes().decode())


def test_counts_of_a_task_in_slices(monkeypatch):
    """Long texts and many counts leave in parts that add up; a text is one document however it is cut."""
    monkeypatch.setattr(V, "TEXT_BYTES", 40)
    monkeypatch.setattr(V, "HELD_COUNTS", 12)
    rnd = np.random.default_rng(2)
    texts = [" ".join(rnd.choice(["Ab", "ab", "c", "dé", "e7f", "漢字"], n)) for n in (0, 3, 90, 5, 1, 200, 8, 2, 2, 4)]
    batch = pa.record_batch({"lang": ["en"] * 10, "source": ["a", "b"] * 5, "text": texts})
    got = defaultdict(lambda: [0, 0])
    for part in V._counts(iter([batch, batch.slice(0, 0), batch.slice(2, 3)])):
        for r in part.to_pylist():
            got[r["source"], r["term"]][0] += r["n"]
            got[r["source"], r["term"]][1] += r["docs"]
    want = defaultdict(lambda: [0, 0])
    for i in [*range(10), 2, 3, 4]:
        for t, n in Counter(re.findall(r"[a-z\u0080-\U0010FFFF]+", lower(texts[i]))).items():
            want["ab"[i % 2], t][0] += n
            want["ab"[i % 2], t][1] += 1
    assert got == want


# --- decontamination


def words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010FFFF]+", lower(text))


def brute_passages(texts, items):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[i : i + 10])].add("" if item is None else str(item))
    out = []
    for doc_id, text in texts:
        w, hit, found = words(text), set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if names := windows.get(tuple(w[i : i + m])):
                    hit |= set(range(i, i + m))
                    found |= names
        out.append((doc_id, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return sorted(map(str, out))


def some_items(rnd):
    word = lambda: rnd.choice(list("abc")) + str(rnd.integers(0, 3))
    items = [(i, " ".join(word() for _ in range(rnd.choice([1, 2, 3, 7, 9, 10, 11, 25])))) for i in range(60)]
    return [*items, (61, None), (62, " .,!"), (None, "An item, WITHOUT an id"), (3, "a second row of an item"), (3, "a second row of an item"), (63, "é漢字"), (64, "same " * 30)]


@pytest.mark.parametrize("block_bytes", [4 << 20, 300])
def test_passages_against_brute_force(spark, odd, monkeypatch, block_bytes):
    monkeypatch.setattr(W, "BLOCK_BYTES", block_bytes)
    rnd = np.random.default_rng(4)
    items = some_items(rnd)
    long = [t for _, t in items if t and len(t.split()) > 8]
    texts = [(i, " ".join([rnd.choice(long), "x1 c9", *[rnd.choice(list("abc")) + str(rnd.integers(0, 4)) for _ in range(rnd.integers(0, 60))], rnd.choice(long).upper()])) for i in range(80)]
    texts += [(100, "an item -- without\tan ID"), (101, "same " * 500), (102, "é漢字 漢字"), (102, "é漢字 漢字"), *[(r["doc_id"], r["text"]) for r in odd.collect()]]
    table = spark.createDataFrame(texts, "doc_id long, text string").withColumn("items", F.lit(3)).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("block", F.lit(1))
    assert sorted(map(str, map(tuple, W.decontaminate(table, bench).collect()))) == brute_passages(texts, items)


def test_passages_of_nothing(spark, odd, none):
    bench = spark.createDataFrame([(1, "quick brown fox")], "item_id long, text string")
    assert W.find_passages(none, bench).collect() == []
    rows = W.decontaminate(odd, bench.limit(0)).collect()
    assert len(rows) == odd.count() and not any(r["contaminated"] or r["n_items"] for r in rows)
    assert [r["hits"] for r in W.find_passages(odd, bench).collect() if r["doc_id"] == 4] == [[1, 2, 3]]


def test_shifts_skip_and_lose_nothing(monkeypatch):
    rnd = np.random.default_rng(1)
    monkeypatch.setattr(W, "LANE", 7)
    monkeypatch.setattr(W, "PAIRS", 50)
    for m in (1, 2, 3, 10):
        ids = rnd.integers(0, 3, 4000).astype(np.int32)
        patterns = np.unique(np.stack([ids[i : i + m] for i in rnd.integers(0, 3900, 50)] + [rnd.integers(1, 3, m).astype(np.int32)]), axis=0)
        patterns = patterns[(patterns > 0).all(axis=1)]
        start, number = W.Machine(patterns).search(ids)
        want = {(i, j) for i in range(len(ids) - m + 1) for j, p in enumerate(patterns) if (ids[i : i + m] == p).all()}
        assert sorted(zip(start.tolist(), number.tolist(), strict=True)) == sorted(want) and len(start) == len(want)
    # most places of unrelated words are never looked at
    machine = W.Machine(rnd.integers(1, 1000, (20, 10)).astype(np.int32))
    looked, plain = [], W._block_hash
    monkeypatch.setattr(W, "_block_hash", lambda a, b, bits: looked.append(len(a)) or plain(a, b, bits))
    monkeypatch.setattr(W, "LANE", 128)
    machine.candidates(rnd.integers(1000, 100_000, 50_000).astype(np.int32))
    assert sum(looked) < 50_000 / 6


def test_index_of_an_empty_batch():
    index = W.Index(["1"], pa.array(["a b c"]))
    assert index.search(pa.array([], pa.string())) == ([], [], [])
