"""Expected against actual files, key audits, set relations and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def completion(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected and present files of each study, and whether all are there."""
    want = expected.groupBy("subject_id", "study_id").agg(F.count("dicom_filepath").alias("expected_dicoms"))
    have = actual.groupBy("study_id").agg(F.count(F.lit(1)).alias("actual_dicoms"))
    out = want.join(have, "study_id", "left").withColumn("actual_dicoms", F.coalesce("actual_dicoms", F.lit(0)))
    return out.withColumn("complete", F.col("actual_dicoms") >= F.col("expected_dicoms"))


def download_status(report: DataFrame, before: str = "before_dicoms", failed: str = "failed") -> DataFrame:
    """The state of each study: complete before, failed, incomplete, or ok."""
    status = (
        F.when(F.col(before) >= F.col("expected_dicoms"), "already_complete").when(F.col(failed), "download_failed").when(F.col("actual_dicoms") < F.col("expected_dicoms"), "incomplete").otherwise("ok")
    )
    return report.withColumn("status", status)


def split_by(df: DataFrame, flag: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a true flag, and all others."""
    on = F.coalesce(F.col(flag), F.lit(False))
    return df.filter(on), df.filter(~on)


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """``n_both, n_left_only, n_right_only`` of two sets of keys, by one union and aggregation."""
    sides = a.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(b.select(key, F.lit(0).alias("l"), F.lit(1).alias("r")))
    each = sides.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return each.agg(F.count_if(F.expr("l = 1 AND r = 1")).alias("n_both"), F.count_if(F.expr("r = 0")).alias("n_left_only"), F.count_if(F.expr("l = 0")).alias("n_right_only"))


def spread(df: DataFrame, key: str, other: str) -> DataFrame:
    """How many keys have more than one ``other``: leakage of subjects over splits, studies over subjects."""
    each = df.groupBy(key).agg(F.countDistinct(other).alias("n"))
    return each.agg(F.count(F.lit(1)).alias("n_keys"), F.count_if(F.expr("n > 1")).alias("n_violations"), F.max("n").alias("max_n"))


def group_size_summary(df: DataFrame, key: str) -> DataFrame:
    each = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return each.agg(F.min("n").alias("min_n"), F.median("n").alias("median_n"), F.max("n").alias("max_n"), F.avg("n").alias("mean_n"))


def split_mismatch(labels: DataFrame, splits: DataFrame) -> DataFrame:
    """Label rows without a split, and with another one than the frozen map."""
    m = labels.select("subject_id", "split").join(splits.select("subject_id", F.col("split").alias("frozen")).distinct(), "subject_id", "left")
    return m.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("frozen").isNull()).alias("n_missing"), F.count_if(F.col("frozen") != F.col("split")).alias("n_mismatch"))


def remaining(all_: DataFrame, done: DataFrame, key: str = "study_id") -> DataFrame:
    return all_.join(done.select(key), key, "left_anti")


def assign_batches(df: DataFrame, size: int, order: str = "study_id", ranges: int = 1000) -> DataFrame:
    """Numbered batches of ``size`` rows in order; ``order`` is a unique whole number.

    Rows are ranked within ``ranges`` ranges of the order column; only the
    counts of the ranges meet in one place.
    """
    low, high = df.agg(F.min(order), F.max(order)).first()
    width = max(1, -(-((high or 0) - (low or 0) + 1) // ranges))
    ranged = df.withColumn("_part", F.floor((F.col(order) - F.lit(low or 0)) / F.lit(width)).cast("long"))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    ranked = ranged.withColumn("_rank", F.row_number().over(Window.partitionBy("_part").orderBy(order)))
    out = ranked.join(before, "_part").withColumn("row", F.col("_before") + F.col("_rank") - 1)
    return out.withColumn("batch", F.floor(F.col("row") / size).cast("long")).drop("_part", "_rank", "_before")


def match_checksums(listed: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted paths with their listed digest; null where none is listed."""
    return wanted.select("path").distinct().join(listed, "path", "left")
