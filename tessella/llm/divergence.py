"""How the sources of a language differ in their use of terms.

DuckDB aggregates inside the tasks, Spark deals and merges.  Each task counts
the terms of its texts by language, source and term.  These counts are dealt
into shards by the hash of (language, term), where SQL adds them up and keeps
the terms of enough documents.  With the totals of all groups known, the kept
counts are dealt into shards once more, by language and term, and SQL forms
each shard's part of the pair sums and its highest terms; Spark adds the parts
and ranks them.

The sums are exact and need no dense table of terms by sources.  With ``z`` the
share of a term that a group lacks, a pair's sum over a shard of ``T`` terms is
``T |z_a - z_b|``, corrected for the terms that ``a`` has, for those that ``b``
has, and for those that both have.  The first two corrections depend on the
share alone, so they are formed once for each distinct share of a source.
"""

from __future__ import annotations

from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import materialize, release, slices
from tessella.llm.words import bytes_of, lower_case

#: Documents that a kept term needs in its language, what is added to each count, the scale of shares, and terms listed for a group.
LEAST_DOCUMENTS, PRIOR, SCALE, LISTED = 30, 5, 1_000_000_000, 50
#: Bytes of text for each counting shard, kept counts for each pair shard, bytes of text counted at once, and counts that a task holds.
SHARD_BYTES, SHARD_COUNTS, TEXT_BYTES, HELD_COUNTS = 32 << 20, 50_000, 8 << 20, 2_000_000
_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

_COUNT = f"""
INSERT INTO held SELECT lang, source, term, sum(n), count(*)
FROM (SELECT i, lang, source, term, count(*) AS n FROM (SELECT i, lang, source, unnest(regexp_extract_all(text, '{_TERM}')) AS term FROM batch) GROUP BY ALL) GROUP BY ALL
"""
_HELD = "SELECT lang, source, term, CAST(sum(n) AS BIGINT) AS n, CAST(sum(docs) AS BIGINT) AS docs FROM held GROUP BY ALL"
_KEPT = f"""
SELECT lang, source, term, CAST(sum(n) AS BIGINT) AS n, row_number() OVER (PARTITION BY lang, term ORDER BY source) = 1 AS lead
FROM held GROUP BY lang, source, term QUALIFY sum(sum(docs)) OVER (PARTITION BY lang, term) >= {LEAST_DOCUMENTS}
"""
_SHARE = f"CAST(1 + ({SCALE}::HUGEINT * ({{count}} + {PRIOR})) // ({{total}} + {PRIOR} * terms::HUGEINT) AS BIGINT)"
_PARTS = f"""
WITH g AS (SELECT source, {_SHARE.format(count=0, total="total")} AS z FROM groups),
c AS (SELECT source, term, n, {_SHARE.format(count="n", total="total")} AS p, z FROM counts JOIN groups USING (source) JOIN g USING (source)),
t AS (SELECT term, {_SHARE.format(count="sum(n)", total="any_value(lang_total)")} AS q FROM counts JOIN groups USING (source) GROUP BY term, terms),
base AS (SELECT a.source AS a, b.source AS b, (SELECT count(*) FROM t)::HUGEINT * abs(a.z - b.z) AS value FROM g a JOIN g b ON a.source < b.source),
one AS (SELECT source, p, z, count(*) AS k FROM c GROUP BY ALL),
alone AS (SELECT least(one.source, g.source) AS a, greatest(one.source, g.source) AS b, sum(k::HUGEINT * (abs(p - g.z) - abs(one.z - g.z))) AS value FROM one JOIN g ON one.source <> g.source GROUP BY ALL),
both_have AS (SELECT a.source AS a, b.source AS b, sum((abs(a.p - b.p) - abs(a.p - b.z) - abs(a.z - b.p) + abs(a.z - b.z))::HUGEINT) AS value FROM c a JOIN c b ON a.term = b.term AND a.source < b.source GROUP BY ALL)
SELECT 'pair' AS part, a AS source, b AS item, CAST(sum(value) AS BIGINT) AS value FROM (FROM base UNION ALL FROM alone UNION ALL FROM both_have) GROUP BY ALL
UNION ALL
SELECT 'term', source, term, value FROM (SELECT source, term, p - q AS value FROM c JOIN t USING (term) WHERE p > q AND n > 0 QUALIFY row_number() OVER (PARTITION BY source ORDER BY p - q DESC, term) <= {LISTED})
"""


def _database() -> duckdb.DuckDBPyConnection:
    """One in memory, for one task, that writes no files."""
    return duckdb.connect(config={"threads": 1, "temp_directory": "", "preserve_insertion_order": False})


def _lower(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, ends = bytes_of(texts)
    return lower_case(data), ends


def _chunks(data: np.ndarray) -> Iterator[str]:
    """A long text in parts of about ``TEXT_BYTES`` that end where no term goes on."""
    at = 0
    while at < len(data):
        stop = min(at + TEXT_BYTES, len(data))
        while stop < len(data) and (data[stop] >= 128 or 97 <= data[stop] <= 122):
            stop += 1
        yield data[at:stop].tobytes().decode("utf-8", "replace")
        at = stop


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, source, term, n, docs`` of a task's texts."""
    held = _database()
    create = "CREATE OR REPLACE TABLE held (lang VARCHAR, source VARCHAR, term VARCHAR, n BIGINT, docs BIGINT)"
    held.execute(create)
    rows = 0
    for whole in batches:
        for part in slices(whole, limit=TEXT_BYTES):
            data, ends = _lower(part.column(2))
            if len(part) == 1 and len(data) > TEXT_BYTES:
                held.execute("CREATE OR REPLACE TABLE long (term VARCHAR, n BIGINT)")
                for chunk in _chunks(data):
                    held.execute(f"INSERT INTO long SELECT term, count(*) FROM (SELECT unnest(regexp_extract_all(?, '{_TERM}')) AS term) GROUP BY 1", [chunk])
                held.execute("INSERT INTO held SELECT ?, ?, term, sum(n), 1 FROM long GROUP BY term", [part.column(0)[0].as_py(), part.column(1)[0].as_py()])
                held.execute("DROP TABLE long")
            else:
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                texts = pa.StringArray.from_buffers(len(part), pa.py_buffer(offsets), pa.py_buffer(data))
                batch = pa.table({"i": np.arange(len(part)), "lang": part.column(0), "source": part.column(1), "text": texts})
                held.register("batch", batch)
                held.execute(_COUNT)
                held.unregister("batch")
            rows = held.execute("SELECT count(*) FROM held").fetchall()[0][0]
            if rows > HELD_COUNTS:
                yield from held.sql(_HELD).to_arrow_table().to_batches()
                held.execute(create)
                rows = 0
    if rows:
        yield from held.sql(_HELD).to_arrow_table().to_batches()


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, source, term, n, lead`` of the terms that a counting shard keeps; ``lead`` marks one row of each term."""
    shard = _database()
    shard.execute("CREATE TABLE held (lang VARCHAR, source VARCHAR, term VARCHAR, n BIGINT, docs BIGINT)")
    for part in batches:
        shard.register("part", pa.Table.from_batches([part]))
        shard.execute("INSERT INTO held SELECT * FROM part")
        shard.unregister("part")
    yield from shard.sql(_KEPT).to_arrow_table().to_batches()


def _parts(key: tuple, counts: pa.Table, groups: pa.Table) -> pa.Table:
    """``lang, part, source, item, value`` of a pair shard, all of one language."""
    with _database() as shard:
        shard.register("counts", counts)
        shard.register("groups", groups)
        found = shard.sql(_PARTS).to_arrow_table()
    return found.select(["part", "source", "item", "value"]).add_column(0, "lang", pa.array([key[0].as_py()] * len(found), pa.string()))


def divergence(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank``: what sets the sources of each language apart.

    Null text, lang and source count as empty.  Part ``pair`` has each other
    source of the language, by the sum of differences of shares over all kept
    terms (0 where the language keeps none); part ``term`` has the ``LISTED`` kept
    terms of the source whose share is most above the language's.  Ranks go by
    descending value, ties by the item's UTF-8 bytes.  A source alone in its
    language has no pair.  Repeated rows are counted each; texts of any length
    are counted whole.  Other columns are ignored.  An empty table gives no rows.
    """
    filled = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    groups = materialize(filled.groupBy("lang", "source").agg(F.sum(F.octet_length("text").cast("long")).alias("bytes")), "groups")
    size = groups.agg(F.sum("bytes")).first()[0] or 0
    counted = filled.mapInArrow(_counts, "lang string, source string, term string, n long, docs long")
    dealt = counted.repartition(max(1, -(-size // SHARD_BYTES)), "lang", "term")
    kept = materialize(dealt.mapInArrow(_kept, "lang string, source string, term string, n long, lead boolean"), "kept")

    # what every shard has to know of a language: its groups and their totals
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.sum(F.col("lead").cast("long")).alias("terms"), F.sum("n").alias("lang_total"), F.ceil(F.count(F.lit(1)) / SHARD_COUNTS).cast("int").alias("shards"))
    full = groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    full = materialize(full.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "terms", "lang_total", "shards")]), "totals")
    per_lang = full.groupBy("lang").agg(F.max("shards").alias("shards"))
    shard = F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard")
    left = kept.join(per_lang, "lang").select("lang", shard, "source", "term", "n")
    right = full.filter("shards > 0").select("lang", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "source", "total", "terms", "lang_total")
    formed = left.groupBy("lang", "shard").cogroup(right.groupBy("lang", "shard")).applyInArrow(_parts, "lang string, part string, source string, item string, value long")
    formed = materialize(formed, "parts")

    sums = formed.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    mirrored = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    bare = full.filter("shards = 0").select("lang", "source")
    none = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").filter("source <> item").withColumn("value", F.lit(0).cast("long"))
    pairs = mirrored.unionByName(none.select("lang", "source", "item", "value")).withColumn("part", F.lit("pair"))
    terms = formed.filter("part = 'term'").select("lang", "source", "item", "value", "part")
    by = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    listed = terms.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= LISTED)
    out = pairs.withColumn("rank", F.row_number().over(by)).unionByName(listed)
    return out.select("lang", "source", "part", "item", "value", "rank")
