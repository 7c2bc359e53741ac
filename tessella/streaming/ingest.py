"""Incremental batches: new files of a folder are taken once and added to a table.

The table has a folder for each batch, named by the stream's batch number, and a
marker that is written when the folder is whole.  A batch that is repeated after
a failure replaces its own folder, and one with a marker is left alone, so each
row is there once; readers see batches with a marker only.  Nothing that is in
the table already is read: repeats of a key are known from the stream's state.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import StructType

from tessella.sources.readers import exists

_MARKER = "batch long, n_rows long, seconds double, at timestamp"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _marker(target: str, batch: int) -> str:
    return f"{target}/_commits/{batch}.json"


def _mark(spark: SparkSession, target: str, batch: int, n_rows: int, seconds: float) -> None:
    """Write the marker under another name first, so that it is never seen in part."""
    at = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
    text = json.dumps({"batch": batch, "n_rows": n_rows, "seconds": round(seconds, 3), "at": at}) + "\n"
    fs, part = _path(spark, f"{target}/_commits/.{batch}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    whole = _path(spark, _marker(target, batch))[1]
    if not fs.rename(part, whole) and not fs.exists(whole):
        raise OSError(f"the marker of batch {batch} could not be written")


def commits(spark: SparkSession, target: str) -> DataFrame:
    """``batch, n_rows, seconds, at`` of the batches that are whole."""
    if not exists(spark, f"{target}/_commits"):
        return spark.createDataFrame([], _MARKER)
    return spark.read.schema(_MARKER).json(f"{target}/_commits/*.json")


def read_ingested(spark: SparkSession, target: str, schema: StructType | str) -> DataFrame:
    """The rows of all whole batches and their ``batch``; other batches' folders are not read."""
    done = sorted(r["batch"] for r in commits(spark, target).filter("n_rows > 0").collect())  # a number for each batch
    whole = spark.createDataFrame([], schema).withColumn("batch", F.lit(0).cast("long"))
    if not done:
        return whole
    paths = [f"{target}/data/batch={b}" for b in done]
    return spark.read.schema(whole.schema).option("basePath", f"{target}/data").parquet(*paths).select(*whole.columns)


def ingest(
    spark: SparkSession, source: str, schema: StructType | str, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None, files_per_batch: int = 100,
    key: str | None = None, event_time: str | None = None, delay: str | None = None, archive: str | None = None,
) -> StreamingQuery:
    """Process the files that are there and not done, ``files_per_batch`` at a time, then stop.

    The checkpoint makes a rerun resume.  With ``key``, of rows that share it the
    first one is kept, whichever batch has it; with ``event_time`` and ``delay``
    keys are forgotten once that time is past, which bounds the state.
    ``transform`` maps the stream row by row before that.  Files of finished
    batches move to ``archive`` if that is given.  Null is a key like others.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if archive:
        stream = stream.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    rows = stream.parquet(source)
    rows = transform(rows) if transform else rows
    if key:
        rows = rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key]) if event_time and delay else rows.dropDuplicates([key])

    def add(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        if exists(session, _marker(target, number)):
            batch.write.format("noop").mode("overwrite").save()  # the state has to come along
            return
        began, folder = time.time(), f"{target}/data/batch={number}"
        batch.write.mode("overwrite").parquet(folder)
        _mark(session, target, number, session.read.schema(batch.schema).parquet(folder).count(), time.time() - began)

    return rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(add).start()


class Progress(StreamingQueryListener):
    """Passes on ``(batch, rows read, rows a second, seconds)`` of every batch, and ``None`` with the error, if any, at the end."""

    def __init__(self, tell: Callable[[tuple | None, str | None], None]):
        self.tell = tell

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.tell((p.batchId, p.numInputRows, p.processedRowsPerSecond, p.batchDuration / 1000), None)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.tell(None, event.exception)


def wait_for_rows(spark: SparkSession, path: str, schema: StructType | str, every: float = 30.0, at_most: float = 3600.0, form: str = "csv") -> DataFrame:
    """The manifest at ``path`` as soon as it is there and has a row; TimeoutError after ``at_most`` seconds."""
    until = time.monotonic() + at_most
    while True:
        if exists(spark, path):
            found = spark.read.schema(schema).format(form).option("header", True).load(path)
            if not found.isEmpty():
                return found
        if time.monotonic() + every > until:
            raise TimeoutError(f"{path} has no rows after {at_most} s")
        time.sleep(every)
