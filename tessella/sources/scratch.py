"""Tables that a job writes on its way, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a local session without it, as in tests, gets a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="tessella-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` written as Parquet and read back: evaluated once, and no longer dependent on any executor's shuffle files.

    Values that depend on how rows were dealt, such as a partition's number, are
    the same for all who read the table; folders by ``partition_by`` let readers
    skip the others.  It is deleted when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tessella-{uuid.uuid4().hex}/{name}"
    df.write.partitionBy(*partition_by).parquet(path)
    _made.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _delete_all() -> None:
    for spark, path in _made:
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001  the session has ended already
            return
