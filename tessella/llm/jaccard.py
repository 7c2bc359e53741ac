"""Exact N-gram Jaccard join by T-occurrence search.

Documents with the same shingle set form a class, of which one stands for all.
Classes that cannot have a partner are left out by counting alone (pass 1 and
2), the others are cut into blocks that no link crosses (pass 3), and within a
block every class looks for its partners by DivideSkip (pass 4).

1.  A set's *extended prefix* are its smallest hashes: of ``n`` shingles
    ``n - T + k``, with ``T = ceil(0.8 n)`` the least overlap any partner needs.
    Partners share ``k`` or more of them with each other's prefixes, so a class
    of whose prefix fewer than ``k`` occur elsewhere has no partner.
2.  Of the classes that are left all shingles are counted.  A shingle that
    occurs once cannot be shared; who keeps less than ``T`` has no partner.
3.  Ordered by frequency, partners share one of their rarest ``m - T + 1``
    shared shingles.  The components of that relation are the blocks.  Common
    passages are frequent, so they come last and connect nothing.
4.  In a block, inverted lists of the unvisited classes are searched: the
    longest lists are set aside, the short ones heap-merged, and candidates
    that occur often enough are looked up in the long lists by binary search.
    What is found joins the component and leaves the lists, so a dense group is
    scanned once, not once per member.  A block of more than ``BLOCK`` classes
    is cut into chunks: every class is first compared with the block's most
    central one, then those that are not its partners search each chunk, in
    groups of bounded size.

Sets are compared as 64-bit hashes of their shingles.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import attach_groups, filter_slices, map_slices, materialize, release, reread
from tessella.llm.words import words_of

SHINGLE, PERCENT, EXTENSION, BLOCK = 5, 80, 0.1, 2000
#: Bits of the filter that texts pass before a shuffle (8 MB); a text that passes in vain costs its transfer only.
BITMAP_BITS = 1 << 26
_MASK = (1 << 48) - 1


def least_overlap(n):
    """``ceil(0.8 n)``: the shingles that any partner of a set of ``n`` shares with it at least."""
    return (PERCENT * n + 99) // 100


def linked(shared: int, n: int, m: int) -> bool:
    return 100 * shared >= PERCENT * (n + m - shared) and shared > 0


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The distinct shingle hashes of each text in ascending order (unsigned 64-bit).

    Words are lower-cased (A-Z) and lie between ASCII white space.
    """
    coded, n = words_of(texts)
    keys = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    words = keys[coded.indices.to_numpy()]
    sets, at = [], 0
    with np.errstate(over="ignore"):
        # every window of five, also those across two texts, which are not used
        size = max(len(words) - SHINGLE + 1, 0)
        rolled = np.zeros(size, np.uint64)
        for j in range(SHINGLE):
            rolled = (rolled ^ words[j : j + size]) * np.uint64(0x9E3779B97F4A7C15)
            rolled ^= rolled >> np.uint64(29)
        for k in n.tolist():
            if k >= SHINGLE:
                sets.append(np.unique(rolled[at : at + k - SHINGLE + 1]))
            elif k:
                h = np.uint64(k)
                for w in words[at : at + k]:
                    h = (h ^ w) * np.uint64(0xBF58476D1CE4E5B9)
                    h ^= h >> np.uint64(31)
                sets.append(np.array([h], np.uint64))
            else:
                sets.append(np.zeros(0, np.uint64))
            at += k
    return sets


def _text_hash():
    return F.xxhash64("text").alias("text_hash")


def _prefixes(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text_hash, n, digest, need, sure, alone, lead`` of each document.

    ``sure`` counts prefix shingles that another set of the same slice has;
    the slice's first set with such a shingle carries it in ``prefix`` for all.
    """

    def run(batch: pa.RecordBatch) -> dict:
        sets = shingle_sets(batch.column(2))
        digest = [xxhash.xxh128_digest(s.tobytes()) for s in sets]
        first = {d: i for i, d in reversed(list(enumerate(digest)))}
        n = [len(s) for s in sets]
        need = [1 + int(EXTENSION * x) for x in n]
        cut = [(s[: len(s) - least_overlap(len(s)) + k] if first[d] == i else s[:0]) & np.uint64(_MASK) for i, (s, d, k) in enumerate(zip(sets, digest, need, strict=True))]
        own = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
        flat = np.concatenate(cut) if cut else np.zeros(0, np.uint64)
        keys, at, count = np.unique(flat, return_inverse=True, return_counts=True)
        sure = np.bincount(own[count[at] > 1], minlength=len(cut)).tolist()
        # one row for a shingle that several sets of the slice have: it is known to be shared
        leader = np.zeros(len(flat), bool)
        leader[np.unique(at, return_index=True)[1]] = True
        shared = count[at] > 1
        order = np.cumsum([0, *(len(c) for c in cut)])
        alone = [flat[a:b][~shared[a:b]].astype(np.int64).tolist() for a, b in zip(order, order[1:], strict=False)]
        lead = [flat[a:b][shared[a:b] & leader[a:b]].astype(np.int64).tolist() for a, b in zip(order, order[1:], strict=False)]
        return {"row": batch.column(3), "doc_id": batch.column(0), "text_hash": batch.column(1), "n": n, "digest": digest, "need": need, "sure": sure, "alone": alone, "lead": lead}

    rows = docs.select("doc_id", _text_hash(), "text", F.monotonically_increasing_id().alias("row"))
    return map_slices(rows, run, "row long, doc_id long, text_hash long, n long, digest binary, need int, sure int, alone array<long>, lead array<long>")


def _survivors(table: DataFrame) -> DataFrame:
    """Class digests that pass 1 leaves, each with the row whose text stands for it."""
    rows = table.filter("n > 0")
    # the shingles travel with row numbers, which take less room than digests
    alone = rows.select("row", F.explode("alone").alias("h"), F.lit(False).alias("many"))
    lead = rows.select("row", F.explode("lead").alias("h"), F.lit(True).alias("many"))
    w = Window.partitionBy("h")  # a shingle has one row a slice
    seen = alone.unionByName(lead).withColumn("shared", (F.count(F.lit(1)).over(w) > 1) | F.max("many").over(w))
    counts = seen.filter("shared AND NOT many").groupBy("row").agg(F.count(F.lit(1)).alias("elsewhere"))
    # a class may occur in several slices; the largest number of the sure ones holds
    sets = rows.select("row", "digest", "need", "sure", "n", "doc_id", "text_hash").join(counts, "row", "left").groupBy("digest").agg(
        F.max("need").alias("need"), F.max("sure").alias("sure"), F.coalesce(F.sum("elsewhere"), F.lit(0)).alias("elsewhere"), F.min("n").alias("n"), F.min(F.struct("doc_id", "text_hash")).alias("least")
    )
    found = sets.filter(F.col("sure") + F.col("elsewhere") >= F.col("need")).select("digest", "least.doc_id", "least.text_hash", "n")
    # a class is named by its doc_id, which takes little room, or by its digest where an id has several texts
    one = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("of_id"))
    return found.join(one, "doc_id").select(F.when(F.col("of_id") == 1, F.col("doc_id")).otherwise(F.xxhash64("digest")).alias("node"), "digest", "doc_id", "text_hash", "n")


def _bitmap(survivors: DataFrame) -> np.ndarray:
    """A bit for each text hash of a survivor, modulo ``BITMAP_BITS``; of fixed size, whatever the number of them."""
    place = F.col("text_hash").bitwiseAND(BITMAP_BITS - 1)
    words = survivors.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(text_hash & 63 AS INT))")).alias("bits")).toArrow()
    out = np.zeros(BITMAP_BITS // 64, np.int64)
    out[words.column(0).to_numpy()] = words.column(1).to_numpy()
    return out.view(np.uint64)


def _may_survive(texts: DataFrame, survivors: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose bit is set, among them all survivors, so that few other texts are shuffled."""
    sent = texts.sparkSession.sparkContext.broadcast(_bitmap(survivors))

    def keep(batch: pa.RecordBatch) -> list[bool]:
        place = batch.column(1).to_numpy().view(np.uint64) & np.uint64(BITMAP_BITS - 1)
        return (sent.value[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool).tolist()

    return filter_slices(texts, keep)


def _shared_sets(docs: DataFrame, survivors: DataFrame) -> DataFrame:
    """``node, n, shared``: the shingles of each class that others have too, the rarest first, where they reach T."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"node": batch.column(0), "sets": [s.view(np.int64) for s in shingle_sets(batch.column(1))]}

    wanted = survivors.select("node", "doc_id", "text_hash")
    texts = _may_survive(docs.select("doc_id", _text_hash(), "text"), wanted).join(wanted, ["doc_id", "text_hash"]).groupBy("doc_id", "text_hash", "node").agg(F.min("text").alias("text"))
    sets = materialize(map_slices(texts.select("node", "text"), run, "node long, sets array<long>"), "sets")
    rows = sets.select("node", F.size("sets").cast("long").alias("n"), F.explode("sets").alias("h"))
    # counted in part by the tasks that hold them; a join splits what meets a very common one
    often = reread(sets).select(F.explode("sets").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    counted = rows.join(often, "h")
    gathered = counted.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("s"))
    return gathered.filter(F.size("s") >= least_overlap_column(F.col("n"))).select(
        "node", "n", F.col("s.h").alias("shared"), F.aggregate("s", F.lit(0.0), lambda a, x: a + x["df"]).alias("central")
    )


def least_overlap_column(n):
    return F.floor((F.lit(PERCENT) * n + 99) / 100)


def connected_components(edges: DataFrame, steps: int = 60) -> DataFrame:
    """``node, component`` (the smallest node reachable) of undirected ``a, b`` edges; each node is in some edge.

    Large-star and small-star steps in turn; both keep the components and end
    in stars.  Each round is a table, so lineage stays short.
    """
    # read twice, so what makes them, a search perhaps, must not run twice
    links = materialize(edges.select("a", "b"), "links")
    nodes = materialize(links.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    now = materialize(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    release(links)
    for _ in range(steps):
        # large star: neighbours above u go to the smallest of u and its neighbours
        sides = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = sides.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # small star: neighbours below u, and u, go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        following = materialize(small, "edges")
        settled = following.join(reread(now), ["u", "v"], "left_anti").isEmpty() and reread(now).join(following, ["u", "v"], "left_anti").isEmpty()
        release(now)
        now = following
        if settled:
            break
    else:
        raise RuntimeError("the components did not settle")
    return nodes.join(now.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


class Lists:
    """Inverted lists over some sets; members may be taken out."""

    def __init__(self, sets: list[np.ndarray], sizes: list[int]):
        self.sizes = sizes
        self.lists: dict[int, list[int]] = defaultdict(list)
        for i, s in enumerate(sets):
            for h in s.tolist():
                self.lists[h].append(i)
        self.here = np.ones(len(sets), bool)

    def remove(self, members: Iterable[int]) -> None:
        self.here[list(members)] = False

    def _list(self, h: int) -> list[int]:
        """A list without those taken out; it is shortened as it is met."""
        found = self.lists.get(h)
        if found and not self.here[found].all():
            found = self.lists[h] = [i for i in found if self.here[i]]
        return found or []

    def search(self, query: np.ndarray, n: int) -> list[int]:
        """Members linked with a query of ``n`` shingles, of which ``query`` are those that can be shared.

        DivideSkip: a member must occur on ``T`` lists or more.  The ``L = T - 1``
        or fewer longest lists are left out of the merge, which then asks for
        ``T - L``; the long lists are probed for the candidates.
        """
        least = least_overlap(n)
        lists = sorted((x for h in query.tolist() if (x := self._list(h))), key=len)
        if len(lists) < least:
            return []
        split = len(lists) - (least - 1)
        # lists that are hardly longer than the short ones are merged too
        while split < len(lists) and len(lists[split]) <= 2:
            split += 1
        short, long = lists[:split], lists[split:]
        wanted, found, count, last = least - len(long), [], 0, -1
        candidates: list[tuple[int, int]] = []
        for member in heapq.merge(*short):
            if member != last:
                if last >= 0 and count >= wanted:
                    candidates.append((last, count))
                last, count = member, 0
            count += 1
        if last >= 0 and count >= wanted:
            candidates.append((last, count))
        if not candidates:
            return []
        members = np.array([m for m, _ in candidates])
        shared = np.array([c for _, c in candidates])
        for x in long:
            at = np.minimum(np.searchsorted(x, members), len(x) - 1)
            shared += np.asarray(x)[at] == members
        found = [int(m) for m, c in zip(members, shared.tolist(), strict=True) if linked(c, n, self.sizes[m])]
        return found


class Forest:
    """Joined names, as edges to one name of each tree."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y] = up.setdefault(y, y)
            x = up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)

    def edges(self) -> list[tuple[int, int]]:
        return [(x, self.find(x)) for x in list(self.up)]


def block_components(ids: list[int], sets: list[np.ndarray], sizes: list[int], central: list[float]) -> dict[int, int]:
    """Smallest id of each member's component, by search from the most central members on."""
    lists, out = Lists(sets, sizes), {}
    for start in sorted(range(len(ids)), key=lambda i: (-central[i] / max(sizes[i], 1), ids[i])):
        if not lists.here[start]:
            continue
        lists.remove([start])
        group, queue = [start], [start]
        while queue:
            i = queue.pop()
            found = lists.search(sets[i], sizes[i])
            lists.remove(found)
            group += found
            queue += found
        low = min(ids[i] for i in group)
        out |= {ids[i]: low for i in group}
    return out


def _links(sets: DataFrame, blocks: DataFrame) -> DataFrame:
    """``a, b``: edges whose components are those of all links."""
    members = materialize(sets.join(blocks.withColumnRenamed("component", "block"), "node"), "blocks")
    sizes = members.groupBy("block").agg(F.count(F.lit(1)).alias("members"), F.max(F.struct((F.col("central") / F.col("n")).alias("c"), (-F.col("node")).alias("d"))).alias("top"))
    large = sizes.filter(F.col("members") > BLOCK).select("block", "members", (-F.col("top.d")).alias("pivot"))
    large = materialize(large, "large_blocks")

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        found = block_components(pdf["node"].tolist(), list(pdf["shared"]), pdf["n"].tolist(), pdf["central"].tolist())
        return pd.DataFrame({"a": list(found), "b": list(found.values())})

    edges = members.join(large.select("block"), "block", "left_anti").groupBy("block").applyInPandas(whole, "a long, b long")
    if large.isEmpty():
        return edges
    pieces = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")
    # the two sides of a cogroup are dealt by the hash of their keys, so the keys need one type
    chunked = members.join(large, "block").withColumn("chunk", F.pmod(F.xxhash64("node"), pieces).cast("int")).withColumn("pieces", pieces)
    chunked = materialize(chunked.drop("members"), "chunks")

    def near(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """A forest over the links between members of one chunk and queries; a query that finds itself has no link by that."""
        lists, forest = Lists(list(left["shared"]), left["n"].tolist()), Forest()
        names = left["node"].tolist()
        for q, n, s in zip(right["query"], right["n"], right["shared"], strict=True):
            for i in lists.search(s, int(n)):
                forest.join(names[i], int(q))
        return pd.DataFrame(forest.edges(), columns=["a", "b"]).astype("int64")

    def ask(queries: DataFrame) -> DataFrame:
        """Each query meets every chunk of its block; queries come in groups of a bounded size, each in a task of its own."""
        groups = queries.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("groups"))
        dealt = queries.join(groups, "block").withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), F.col("groups")).cast("int"))
        sent = dealt.select("block", "part", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("chunk"), F.col("node").alias("query"), "n", "shared")
        asked = reread(chunked).join(groups, "block").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
        keys = ["block", "chunk", "part"]
        if [asked.schema[k].dataType for k in keys] != [sent.schema[k].dataType for k in keys]:
            raise TypeError("chunks and queries are dealt by keys of different types")
        return asked.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(near, "a long, b long")

    star = materialize(ask(chunked.filter("node = pivot")), "star")
    rest = chunked.join(star.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_anti")
    return edges.unionByName(star).unionByName(ask(rest)).unionByName(chunked.select(F.col("node").alias("a"), F.col("node").alias("b")))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, text_hash`` (of the raw text).

    Two documents link where ``100 * intersection >= 80 * union`` of their sets
    of distinct five-word shingles (a shorter text has one, its whole sequence).
    Null text, and a text without words, has the empty set and links with
    nothing.  A row without a doc_id is compared with nothing and has a null
    component.  Repeated rows share their component; rows that repeat a doc_id
    with other texts are compared each, and each has the component of its text.
    Very long texts are compared whole.  Other columns are ignored.  An empty
    table gives no rows.
    """
    table = materialize(_prefixes(docs.filter(F.col("doc_id").isNotNull())), "prefixes")
    survivors = materialize(_survivors(table), "survivors")
    slim = materialize(table.select("doc_id", "text_hash", "n", "digest"), "slim")
    release(table)
    sets = materialize(_shared_sets(docs, survivors), "shared")
    m, t = F.size("shared"), least_overlap_column(F.col("n")).cast("int")
    rare = sets.select("node", F.explode(F.slice("shared", 1, m - t + 1)).alias("h"))
    star = rare.join(rare.groupBy("h").agg(F.min("node").alias("b")), "h").select(F.col("node").alias("a"), "b").distinct()
    blocks = connected_components(star)
    components = materialize(connected_components(_links(sets, blocks)), "components")
    n_rows = slim.count()
    classes = slim.filter("n > 0").groupBy("digest").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("copies"))
    found = classes.join(survivors.select("digest", "node"), "digest", "left").join(components, "node", "left")
    labelled = materialize(found.select("digest", "low", "copies", F.coalesce("component", "node", F.xxhash64("digest")).alias("component")), "labelled")
    # a component has the smallest doc_id of its classes
    groups = labelled.groupBy("component").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("classes"))
    named = attach_groups(labelled.select("digest", "copies", "component"), groups, "component", "classes", n_rows).select("digest", "copies", "component_id")
    full = attach_groups(slim.filter("n > 0"), named, "digest", "copies", n_rows).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "text_hash")
    bare = slim.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "text_hash")
    nameless = docs.filter(F.col("doc_id").isNull()).select("doc_id", _text_hash(), "text")
    schema = "doc_id long, n_shingles long, component_id long, text_hash long"
    lone = map_slices(nameless, lambda b: {"doc_id": b.column(0), "n_shingles": [len(s) for s in shingle_sets(b.column(2))], "component_id": b.column(0), "text_hash": b.column(1)}, schema)
    return full.unionByName(bare).unionByName(lone)


def keep_representatives(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest doc_id.

    Rows without an id stay, and so do all rows that repeat the doc_id that
    stands for their component.  Rows that share a doc_id and have different
    texts are judged each.  Other columns travel along, whatever their names.
    """
    gone = jaccard_components(docs).filter("doc_id <> component_id").select("doc_id", "text_hash").distinct()
    whole = docs.select(F.struct("*").alias("row"), "doc_id", _text_hash())
    return whole.join(gone, ["doc_id", "text_hash"], "left_anti").select("row.*")
