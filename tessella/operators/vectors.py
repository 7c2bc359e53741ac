"""Vectors on rows: batch unions, pooling and frame choice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.functions import arrays


def merge_batches(batches: list[DataFrame]) -> DataFrame:
    """Batches in order under one schema; columns that a batch lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [b.withColumn("batch", F.lit(i)) for i, b in enumerate(batches)])


def read_batches(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """The batches that exist; a folder that is missing is skipped."""
    fs = lambda p: p.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return [spark.read.parquet(path) for path, p in zip(paths, found, strict=True) if fs(p).exists(p)]


def batch_offsets(merged: DataFrame, batch: str = "batch") -> DataFrame:
    """Rows of each batch, and the number of rows in the batches before it."""
    sizes = merged.groupBy(batch).agg(F.count(F.lit(1)).alias("n_rows"))  # a row for each batch
    before = Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("first_row", F.coalesce(F.sum("n_rows").over(before), F.lit(0)))


def pool(df: DataFrame, key: str, vector: str = "embedding", how: str = "mean") -> DataFrame:
    """Element-wise mean or maximum of the vectors of each key, with their number and the result's length.

    Elements are aggregated by key and position with partial sums, so a key of
    very many vectors costs a task one row for each position.
    """
    each = df.filter(F.col(vector).isNotNull()).select(key, F.posexplode(vector).alias("i", "x"))
    value = F.avg(F.col("x").cast("double")) if how == "mean" else F.max(F.col("x").cast("double"))
    cells = each.groupBy(key, "i").agg(value.alias("v"), F.count(F.lit(1)).alias("n"))
    out = cells.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("_c"), F.max("n").alias("n_clips"))
    pooled = F.transform("_c", lambda s: s["v"])
    return out.select(key, pooled.alias(vector), "n_clips").withColumn("embedding_l2_norm", arrays.l2_norm(F.col(vector)))


def frame_scores(df: DataFrame, key: str, order: str, focus: str, contrast: str) -> DataFrame:
    """Focus, motion (change from the frame before; the first has the second's) and their z-scores within a clip."""
    w, whole = Window.partitionBy(key).orderBy(order), Window.partitionBy(key)
    out = df.withColumn("motion", F.abs(F.col(focus) - F.lag(focus).over(w)))
    out = out.withColumn("motion", F.coalesce("motion", F.lead("motion").over(w), F.lit(0.0))).withColumn("idx", F.row_number().over(w) - 1)

    def z(c: str):
        sd = F.stddev_pop(c).over(whole)
        return F.when(sd < 1e-8, 0.0).otherwise((F.col(c) - F.avg(c).over(whole)) / sd)

    return out.withColumn("combo", z(focus) + 0.5 * z(contrast) - 0.5 * z("motion"))


def choose_frame(scores: DataFrame, key: str, by: str, largest: bool = True) -> DataFrame:
    """The index of the best frame of each clip, the first at ties."""
    s = F.col(by) if largest else -F.col(by)
    return scores.groupBy(key).agg(F.max_by("idx", F.struct(s, -F.col("idx"))).alias("selected_index"), F.count(F.lit(1)).alias("n_frames"))


def middle_frame(scores: DataFrame, key: str) -> DataFrame:
    return scores.groupBy(key).agg(F.floor(F.count(F.lit(1)) / 2).cast("int").alias("selected_index"))
