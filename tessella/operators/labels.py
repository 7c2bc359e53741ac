"""Labels per study and roll-ups of clip predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions import numeric, text
from tessella.operators.quantiles import exact_median


def median_labels(measurements: DataFrame, name: str, threshold: float) -> DataFrame:
    """Median value of one measurement per subject and measurement id, with a binary and a four-class label."""
    value = text.try_double(F.col("result"))
    out = exact_median(measurements.filter(F.col("measurement") == name), ["subject_id", "measurement_id"], value, "value")
    return out.select("*", (F.col("value") < threshold).cast("int").alias("reduced"), numeric.severity(F.col("value")).alias("class4"))


def label_studies(studies: DataFrame, labels: DataFrame) -> DataFrame:
    return studies.filter(F.col("measurement_id").isNotNull()).join(labels, ["subject_id", "measurement_id"])


def first_by(column: str, order: str):
    """The non-null value of ``column`` that comes first in ``order``; each column by itself."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.col(order)))


def roll_up(df: DataFrame, key: str, order: str, first: list[str], median: list[str], largest: list[str]) -> DataFrame:
    aggs = [first_by(c, order).alias(c) for c in first] + [F.median(c).alias(c) for c in median] + [F.max(c).alias(c) for c in largest]
    return df.groupBy(key).agg(*aggs, F.count(F.lit(1)).alias("n_clips"))


def study_predictions(clips: DataFrame) -> DataFrame:
    """Clip predictions per study: median target, largest label, mean prediction and probability."""
    return clips.groupBy("split", "subject_id", "study_id").agg(
        F.median("y").alias("y"), F.max("label").alias("label"), F.avg("pred").alias("pred"), F.avg("prob").alias("prob"), F.count(F.lit(1)).alias("n_clips")
    )
