"""A Merkle manifest of a dataset with an inclusion proof for each row.

Every row is a leaf.  The leaves of a source, in ascending order of doc_id, are
folded by threes to the source's root, and the roots of the sources, in order,
to one root.  The trees are built by higher-order SQL functions: ``BLOCK``
consecutive nodes are an array of fixed size, whose levels ``sequence``,
``slice``, ``transform`` and ``aggregate`` collapse to one digest; the block
roots are nodes of the next tree, and so on until each source has one.  Then
the paths come back down, from the root to the leaves, each block adding its
own part to what stands above it.

No window and no array is longer than a range of rows or a block, so a source
may hold any share of the table.  All columns are native expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import materialize, release

#: Children of a node, levels in a block, and rows that one task ranks on average.
ARITY, LEVELS, RANGE_ROWS = 3, 6, 100_000
BLOCK = ARITY**LEVELS


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts end to end."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 bytes' number, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    return digest(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text))


def delete_newlines(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(""))


def leaves(docs: DataFrame, tamper: Callable[[Column], Column]) -> DataFrame:
    """``tree, source, doc_id, node, tampered, row``; the tree is named so that null comes first and then bytewise order."""
    text = F.col("text")
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"),
        "doc_id",
        leaf(text).alias("node"),
        # null where the tampered leaf is the leaf itself
        F.when(changed & ~tamper(text).eqNullSafe(text), leaf(tamper(text))).alias("tampered"),
        F.monotonically_increasing_id().alias("row"),
    )


def ranked(nodes: DataFrame, order: list[str], n_rows: int) -> DataFrame:
    """``nodes`` with their place (from 0) in their tree and the number of its nodes.

    Nodes are dealt by ranges of (tree, ``order``), which must be unique; places
    are taken within a range, and only the ranges' counts meet.
    """
    dealt = nodes.repartitionByRange(max(1, -(-n_rows // RANGE_ROWS)), "tree", *order)
    held = materialize(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy("tree").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = held.groupBy("tree", "_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select("tree", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(Window.partitionBy("tree")).alias("size"))
    own = Window.partitionBy("tree", "_range").orderBy(*order)
    return held.withColumn("_place", F.row_number().over(own) - 1).join(starts, ["tree", "_range"]).withColumn("place", F.col("_start") + F.col("_place")).drop("_range", "_start", "_place")


def collapse(level: Column) -> Column:
    """The next level: the digest of each run of ``ARITY`` nodes, the last one of fewer."""
    runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / ARITY).cast("int"))
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(level, i * ARITY + 1, ARITY), "")))


def blocks(placed: DataFrame, carried: list[str]) -> DataFrame:
    """``tree, block, members, levels``: the levels of each block of ``BLOCK`` nodes, its leaves first.

    A tree of one block collapses until one node remains; where there are more
    blocks, each collapses ``LEVELS`` times, as the whole tree does.
    """
    members = placed.groupBy("tree", F.floor(F.col("place") / BLOCK).cast("long").alias("block"), (F.col("size") > BLOCK).alias("more")).agg(
        F.sort_array(F.collect_list(F.struct("place", "node", *carried))).alias("members")
    )
    first = F.array(F.col("members.node"))
    levels = F.aggregate(
        F.sequence(F.lit(1), F.lit(LEVELS)), first, lambda held, _: F.when(F.col("more") | (F.size(F.element_at(held, -1)) > 1), F.concat(held, F.array(collapse(F.element_at(held, -1))))).otherwise(held)
    )
    return members.withColumn("levels", levels)


def path(levels: Column, place: Column) -> Column:
    """``left, right`` siblings of a block's member at each level, end to end, from its own level up."""

    def at(depth: Column) -> Column:
        level = F.element_at(levels, depth + 1)
        q = F.floor(place / F.pow(F.lit(ARITY), depth)).cast("int")
        left = F.array_join(F.slice(level, q - q % ARITY + 1, q % ARITY), "")
        return F.struct(left.alias("left"), F.array_join(F.slice(level, q + 2, ARITY - 1 - q % ARITY), "").alias("right"))

    return F.when(F.size(levels) > 1, F.transform(F.sequence(F.lit(0), F.size(levels) - 2), at)).otherwise(F.array().cast("array<struct<left:string,right:string>>"))


def fold(node: Column, siblings: Column) -> Column:
    """The root that a node and the siblings on its path give."""
    return F.aggregate(siblings, node, lambda now, s: digest(s["left"], now, s["right"]))


def upwards(placed: DataFrame, carried: list[str]) -> list[DataFrame]:
    """The blocks of all trees, then those of their roots, until each tree is one block."""
    found = []
    while True:
        found.append(materialize(blocks(placed, carried), "blocks"))
        top = found[-1]
        if top.filter("more").isEmpty():
            return found
        sizes = top.groupBy("tree").agg(F.count(F.lit(1)).alias("size"))
        placed = top.select("tree", F.col("block").alias("place"), F.element_at(F.element_at("levels", -1), 1).alias("node")).join(sizes, "tree")
        carried = []


def downwards(levels: list[DataFrame], above: DataFrame, below: Callable[[DataFrame], DataFrame], facts: list[str]) -> DataFrame:
    """Give the members of the lowest blocks the siblings up to the root.

    ``above`` has ``tree, up`` (siblings above a tree's root) and the columns
    ``facts``; ``below`` makes the result from a lowest block with ``up``.
    """
    held = levels[-1].join(above, "tree")
    for lower in reversed(levels[:-1]):
        inner = F.transform("members", lambda m: F.struct(m["place"].alias("block"), F.concat(path(F.col("levels"), (m["place"] % BLOCK).cast("int")), F.col("up")).alias("up")))
        spread = materialize(held.select("tree", *facts, F.explode(inner).alias("m")).select("tree", *facts, "m.block", "m.up"), "paths")
        held = lower.join(spread, ["tree", "block"])
    return below(held)


def manifest(docs: DataFrame, tamper: Callable[[Column], Column] = delete_newlines) -> DataFrame:
    """One row per document: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    A leaf is the digest of doc_id, source, lang, n_chars and text, each marked
    null or led by its length, so null, empty and shifted fields differ.  Rows
    without a source are a tree of their own, which comes first.  Rows without a
    doc_id come first in their source and are not tampered with.  Rows that
    repeat a doc_id are leaves each, in the order of their digests.  A text of any length is one leaf.  ``tamper`` gives
    the text that every other row, by the checksum of its id, is recomputed
    from; where that changes nothing the row still verifies.  Other columns are
    ignored, whatever their names.  An empty table gives no rows.
    """
    wanted = docs.select("doc_id", "source", "lang", "n_chars", "text")
    found = materialize(leaves(wanted, tamper), "leaves")
    own = upwards(ranked(found, ["doc_id", "node", "row"], found.count()), ["doc_id", "tampered"])
    roots = materialize(own[-1].select(F.col("tree").alias("of"), F.element_at(F.element_at("levels", -1), 1).alias("node")), "subroots")
    every = upwards(ranked(roots.withColumn("tree", F.lit("")), ["of"], roots.count()), ["of"])
    root = every[-1].select(F.lit("").alias("tree"), F.array().cast("array<struct<left:string,right:string>>").alias("up"), F.element_at(F.element_at("levels", -1), 1).alias("root"))

    def source_paths(held: DataFrame) -> DataFrame:
        inner = F.transform("members", lambda m: F.struct(m["of"].alias("tree"), m["node"].alias("subroot"), F.concat(path(F.col("levels"), (m["place"] % BLOCK).cast("int")), F.col("up")).alias("up")))
        return held.select("root", F.explode(inner).alias("m")).select("root", "m.*")

    def proofs(held: DataFrame) -> DataFrame:
        def row(m: Column) -> Column:
            siblings = F.concat(path(F.col("levels"), (m["place"] % BLOCK).cast("int")), F.col("up"))
            return F.struct(m["doc_id"].alias("doc_id"), m["node"].alias("leaf"), m["tampered"].alias("tampered"), siblings.alias("siblings"))

        each = held.select("subroot", "root", F.explode(F.transform("members", row)).alias("m")).select("m.*", "subroot", "root")
        proof = F.transform("siblings", lambda s: F.concat(s["left"], s["right"]))
        folded = fold(F.coalesce("tampered", "leaf"), F.col("siblings"))
        out = each.select("doc_id", "leaf", "subroot", "root", digest(F.array_join(proof, "")).alias("proof_sha256"), folded.alias("folded_root"))
        return out.withColumn("verified", F.col("folded_root") == F.col("root"))

    result = downwards(own, downwards(every, root, source_paths, ["root"]), proofs, ["subroot", "root"])
    release(found)
    return result
