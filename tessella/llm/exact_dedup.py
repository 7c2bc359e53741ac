"""Exact duplicates by a minimal perfect hash over historical digests.

A history of distinct digests is kept as an index of shards.  A shard is a
minimal perfect hash: levels of bit arrays in which each digest owns the first
bit that no other digest of the shard hits; the rank of that bit is the
digest's slot.  A slot holds the full 32-byte digest, the winner's doc_id and
the group's size.  All digests, those of the history and new ones, are looked up
by slot and compared byte by byte, so a digest outside the history is never
taken for a member.  Members have the winner of their slot, and its size with
what the new members of the same slot add; non-members are grouped by themselves.

Shuffles carry digests that are already counted per task, never texts, so a
text with very many copies costs one row per task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import attach_groups, materialize, release

#: Distinct digests in one shard of the index, on average.
SHARD_DIGESTS = 50_000
#: Bits of a level for each digest that is left.
GAMMA = 2.0
_INDEX = "shard long, level_bits array<long>, bitmap binary, digests binary, winners binary, sizes binary"


def normalized(text):
    """Null as empty; each run of ASCII white space becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, digest`` (SHA-256 of the normalised text in UTF-8)."""
    return docs.select("doc_id", F.unhex(F.sha2(normalized(F.col("text")).cast("binary"), 256)).alias("digest"))


def _words(keys: np.ndarray) -> np.ndarray:
    return keys.view("<u8").reshape(len(keys), 4)


def _slot(words: np.ndarray, level: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = words[:, level % 4] ^ (words[:, (level + 1) % 4] * np.uint64(2 * level + 1))
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15 + 2 * level)
    return ((h >> np.uint64(17)) % np.uint64(bits)).astype(np.int64)


def build_shard(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, bits, and the slot of each of the distinct ``keys`` (n x 32 bytes)."""
    words, left = _words(keys), np.arange(len(keys))
    sizes: list[int] = []
    bitmaps, owners = [], []
    while len(left):
        bits = max(64, int(GAMMA * len(left)))
        at = _slot(words[left], len(sizes), bits)
        alone = np.bincount(at, minlength=bits) == 1
        owner = np.full(bits, -1)
        mine = alone[at]
        owner[at[mine]] = left[mine]
        sizes.append(bits)
        bitmaps.append(alone)
        owners.append(owner)
        left = left[~mine]
    if not sizes:
        return [], np.zeros(0, bool), np.zeros(0, np.int64)
    bitmap, owner = np.concatenate(bitmaps), np.concatenate(owners)
    slot = np.empty(len(keys), np.int64)
    slot[owner[bitmap]] = np.arange(len(keys))
    return sizes, bitmap, slot


def find_slots(keys: np.ndarray, sizes: list[int], bitmap: np.ndarray) -> np.ndarray:
    """The slot of each key, -1 where no level has a bit for it."""
    words, rank = _words(keys), np.cumsum(bitmap) - 1
    out, left, base = np.full(len(keys), -1), np.arange(len(keys)), 0
    for level, bits in enumerate(sizes):
        at = base + _slot(words[left], level, bits)
        hit = bitmap[at]
        out[left[hit]] = rank[at[hit]]
        left, base = left[~hit], base + bits
    return out


def _keys(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, 32)


def _shard_column(n: int):
    return F.pmod(F.xxhash64("digest"), F.lit(max(1, -(-n // SHARD_DIGESTS)))).alias("shard")


def build_index(groups: DataFrame, n_groups: int) -> DataFrame:
    """The index table of ``digest, winner, size`` groups; one row per shard."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = _keys(pdf["digest"])
        sizes, bitmap, slot = build_shard(keys)
        order = np.argsort(slot)
        winners = pdf["winner"].astype("Int64")
        return pd.DataFrame({
            "shard": [pdf["shard"].iloc[0]], "level_bits": [sizes], "bitmap": [np.packbits(bitmap).tobytes()], "digests": [keys[order].tobytes()],
            "winners": [winners.fillna(np.iinfo(np.int64).min).to_numpy(np.int64)[order].tobytes()], "sizes": [pdf["size"].to_numpy(np.int64)[order].tobytes()],
        })

    return groups.select(_shard_column(n_groups), "digest", "winner", "size").groupBy("shard").applyInPandas(build, _INDEX)


def look_up(groups: DataFrame, index: DataFrame, n_groups: int) -> DataFrame:
    """``groups`` (``digest, old, winner, size``) with ``shard, slot, old_winner, old_size`` of members; ``slot`` is null for others.

    ``n_groups`` is the count the index was built for.
    """

    def probe(new: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        out = new[["digest", "old", "winner", "size", "shard"]].copy()
        for c in ("slot", "old_winner", "old_size"):
            out[c] = pd.array([None] * len(new), "Int64")
        if len(new) and len(shard):
            row, keys = shard.iloc[0], _keys(new["digest"])
            sizes = list(row["level_bits"])
            bitmap = np.unpackbits(np.frombuffer(row["bitmap"], np.uint8))[: sum(sizes)].astype(bool)
            slot = find_slots(keys, sizes, bitmap)
            stored = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
            member = slot >= 0
            member[member] = (stored[slot[member]] == keys[member]).all(axis=1)
            at = np.maximum(slot, 0)
            winner, size = np.frombuffer(row["winners"], np.int64)[at], np.frombuffer(row["sizes"], np.int64)[at]
            out["slot"] = pd.array(np.where(member, slot, 0), "Int64").copy()
            out["old_winner"], out["old_size"] = pd.array(winner, "Int64"), pd.array(size, "Int64")
            out.loc[~member, ["slot", "old_winner", "old_size"]] = pd.NA
            out.loc[winner == np.iinfo(np.int64).min, "old_winner"] = pd.NA
        return out

    keyed = groups.select(_shard_column(n_groups), "digest", "old", "winner", "size")
    schema = "digest binary, old boolean, winner long, size long, shard long, slot long, old_winner long, old_size long"
    return keyed.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(probe, schema)


def exact_dedup(docs: DataFrame, cut: int | None = None) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256, in_history``.

    The history is the part of the table with ``doc_id <= cut`` (the median id by
    default), as if it had been loaded before the rest; so the smallest doc_id of
    a group wins whichever part it is in.  Null text counts as empty.  A null
    doc_id is never smallest; where a whole group has null ids, ``keep_id`` is
    null and all of it is kept.  Rows that repeat a doc_id and its text share
    one flag.  A text of any length is one digest.  Other columns are ignored.
    An empty table gives no rows.
    """
    n, middle = docs.agg(F.count(F.lit(1)), F.percentile_approx("doc_id", 0.5)).first()
    cut = middle if cut is None else cut
    rows = materialize(digests(docs).withColumn("old", F.coalesce(F.col("doc_id") <= F.lit(cut), F.lit(False))), "digests")
    # counted per task before any digest is shuffled
    groups = materialize(rows.groupBy("digest", "old").agg(F.min("doc_id").alias("winner"), F.count(F.lit(1)).alias("size")), "groups")
    # shards are sized by all groups, since new digests meet the history's in the same tasks
    n_groups = groups.count()
    index = materialize(build_index(groups.filter("old"), n_groups), "index", "none")
    found = materialize(look_up(groups, index, n_groups), "found")
    release(index)
    # what new members add to a slot; a slot has one new group at most
    added = found.filter("NOT old AND slot IS NOT NULL").groupBy("shard", "slot").agg(F.sum("size").alias("added"))
    members = found.filter("slot IS NOT NULL").join(added, ["shard", "slot"], "left")
    members = members.select("digest", "old", F.col("old_winner").alias("keep_id"), (F.col("old_size") + F.coalesce("added", F.lit(0))).alias("group_size"), F.lit(True).alias("in_history"))
    others = found.filter("slot IS NULL").select("digest", "old", F.col("winner").alias("keep_id"), F.col("size").alias("group_size"), F.lit(False).alias("in_history"))
    known = materialize(members.unionByName(others), "known")
    release(groups)
    release(found)
    parts = [attach_groups(rows.filter(side).drop("old"), known.filter(side).drop("old"), "digest", "group_size", n) for side in ("old", "NOT old")]
    return parts[0].unionByName(parts[1]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "in_history"
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text a smaller doc_id has.

    One row stays of each group of equal texts: that of the smallest doc_id, or
    one without a doc_id where no row has one.  Of rows that share a doc_id and,
    up to white space, a text, the one with the smallest raw text stays; rows
    that share a doc_id and have different texts are different.  Null text
    counts as empty.  Other columns travel along, whatever their names.
    """
    named = F.concat_ws(":", F.lower(F.hex("_digest")), F.col("_id").cast("string"))
    stay = exact_dedup(docs).filter("kept").select(F.unhex("text_sha256").alias("_digest"), F.col("doc_id").alias("_id")).select(named.alias("key")).distinct()
    whole = docs.select(F.struct("*").alias("row"), F.unhex(F.sha2(normalized(F.col("text")).cast("binary"), 256)).alias("_digest"), F.col("doc_id").alias("_id"))
    found = whole.select("row", named.alias("key")).join(stay, "key")
    first = Window.partitionBy("key").orderBy(F.col("row.text").asc_nulls_first())
    return found.withColumn("place", F.row_number().over(first)).filter("place = 1").select("row.*")
