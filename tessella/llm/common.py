"""Helpers shared by the text operators: scratch tables, id folds, group joins."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a Python task works on at a time; bounds a task's memory.
SLICE_BYTES = 4 << 20
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_caches: dict[str, Callable[[], None]] = {}
_made: list[tuple[SparkSession, str]] = []


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    ``spark.checkpoint.dir`` of the session is used.  A local session without
    that setting, as in tests, gets a folder of its own; on a cluster executors
    would not see one, so there its absence is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tessella-")
        spark.sparkContext.setCheckpointDir(shared)
    return shared.rstrip("/")


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts lineage: a lost executor repeats its own tasks only, and the table is
    read with column pruning as often as it is needed.  Once it is written,
    nothing reads the shuffles it came from, so Spark may delete their files.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/tessella-{uuid.uuid4().hex}/{name}"
    before = spark.conf.get(_CLEAN_UP)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    _made.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._tessella_path = path
    return out


def reread(df: DataFrame) -> DataFrame:
    """The same table as a plan of its own, for joins with itself."""
    return df.sparkSession.read.schema(df.schema).parquet(df._tessella_path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


def release(df: DataFrame) -> None:
    """Delete a table that :func:`materialize` wrote and that is read no more."""
    path = getattr(df, "_tessella_path", None)
    if path:
        _made[:] = [x for x in _made if x[1] != path]
        _delete(df.sparkSession, path)


@atexit.register
def _release_all() -> None:
    for spark, path in _made:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the session has ended already
            return


def fold(doc_id: str = "doc_id", n: int = 3):
    """``crc32(doc_id as text) mod n``; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of ``batch`` with about ``limit`` bytes of text each, one row at least."""
    col = batch.column(batch.schema.get_field_index(column))
    sizes = pc.fill_null(pc.list_value_length(col) if pa.types.is_list(col.type) else pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < len(sizes):
        yield batch.slice(start)


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str, column: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` over text slices; ``fn`` maps a slice to columns of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, limit):
                out = fn(part)
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v := out[f.name], pa.Array) and v.type == f.type else pa.array(v, f.type) for f in arrow], schema=arrow
                )

    return df.mapInArrow(run, schema)


def filter_slices(df: DataFrame, keep: Callable[[pa.RecordBatch], list[bool]], column: str = "text") -> DataFrame:
    """The rows of ``df`` that ``keep`` tells of each text slice; the other columns travel along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                yield part.filter(pa.array(keep(part), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [t if t is not None else "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def claim_worker(owner: str, clear: Callable[[], None] = lambda: None) -> None:
    """Called where an operator turns to its caches; ``clear`` empties them.

    A Python worker outlives its tasks and may serve several operators in turn,
    so the caches of all others are emptied first.
    """
    if owner not in _caches or len(_caches) > 1:
        for name in _caches.keys() - {owner}:
            _caches.pop(name)()
    _caches[owner] = clear


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def attach_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, n_rows: int, hot_groups: int = 1000) -> DataFrame:
    """Give each row the columns of its group without sending a hot group to one task.

    A group of ``n_rows / hot_groups`` rows or more is hot; there are
    ``hot_groups`` of these at most, so their table is broadcast with that bound.
    All other groups are small and meet their rows in an ordinary join.
    """
    least = max(2, -(-n_rows // hot_groups))
    cols = [c for c in groups.columns if c != key]
    hot = F.broadcast(groups.filter(F.col(size) >= least).select(key, *[F.col(c).alias(f"_hot_{c}") for c in cols]))
    marked = rows.join(hot, key, "left")
    done = marked.filter(F.col(f"_hot_{size}").isNotNull()).select(*rows.columns, *[F.col(f"_hot_{c}").alias(c) for c in cols])
    rest = marked.filter(F.col(f"_hot_{size}").isNull()).select(*rows.columns)
    return done.unionByName(rest.join(groups.filter(F.col(size) < least), key))
