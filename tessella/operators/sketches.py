"""Approximate counts and quantiles from sketches that are kept by part and merged.

A part (a batch, a day, a shard) is read once and leaves one row for each key:
the number of rows, a HyperLogLog sketch of each identifier and a KLL sketch of
each value, of bounded size whatever the part holds.  Any set of parts is merged
from these rows without reading the data again, so a new part costs itself only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the buckets of a HyperLogLog sketch, and the size of a KLL sketch.
LOG_BUCKETS, KLL_SIZE = 14, 800
#: Three standard errors of a merged HyperLogLog estimate, relative; rank error of a KLL quantile at 99 % confidence.
COUNT_ERROR, RANK_ERROR = 3 * 1.04 / 2 ** (LOG_BUCKETS / 2), 2.296 / KLL_SIZE**0.9723


def sketch_parts(df: DataFrame, keys: list[str], part: str, identifiers: list[str], values: list[str]) -> DataFrame:
    """One row for each part and key: ``n_rows``, ``ids_<c>`` and ``kll_<c>``.

    Null identifiers and values leave no trace; null is a part and a key like
    others.  Numbers are sketched as doubles.  An empty table gives no rows.
    """
    ids = [F.hll_sketch_agg(F.col(c).cast("string"), LOG_BUCKETS).alias(f"ids_{c}") for c in identifiers]
    klls = [F.kll_sketch_agg_double(F.col(c).cast("double"), KLL_SIZE).alias(f"kll_{c}") for c in values]
    return df.groupBy(part, *keys).agg(F.count(F.lit(1)).alias("n_rows"), *ids, *klls)


def merge_parts(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key with the sketches of its parts merged; merging in steps gives the same kind of row."""
    ids = [F.hll_union_agg(c).alias(c) for c in sketches.columns if c.startswith("ids_")]
    klls = [F.kll_merge_agg_double(c, KLL_SIZE).alias(c) for c in sketches.columns if c.startswith("kll_")]
    return sketches.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"), *ids, *klls)


def replace_parts(sketches: DataFrame, fresh: DataFrame, part: str) -> DataFrame:
    """The kept rows with those of the parts that ``fresh`` has replaced by it."""
    again = fresh.select(F.struct(part).alias("_part")).distinct()
    kept = sketches.withColumn("_part", F.struct(part)).join(again, "_part", "left_anti").drop("_part")
    return kept.unionByName(fresh)


def distinct_estimate(column: str) -> Column:
    """Distinct identifiers, within ``COUNT_ERROR`` of the truth in all but few cases."""
    return F.hll_sketch_estimate(f"ids_{column}")


def quantile_estimate(column: str, p: float) -> Column:
    """A value whose rank is within ``RANK_ERROR`` of ``p``; null where no value was seen."""
    sketch = F.col(f"kll_{column}")
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(p)))


def rank_within(df: DataFrame, keys: list[str], value: str, estimates: DataFrame, estimate: str, p: float, name: str) -> DataFrame:
    """``keys, name``: whether the measured rank of ``estimate`` among the values of its key is within ``RANK_ERROR`` of ``p``.

    Values are counted before they meet the estimates.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(F.struct(*keys).alias("_k"), F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    met = counted.join(estimates.select(F.struct(*keys).alias("_k"), F.col(estimate).alias("_e")), "_k")
    ranks = met.groupBy("_k").agg(F.sum("_n").alias("n"), F.sum(F.when(F.col("_v") < F.col("_e"), F.col("_n")).otherwise(0)).alias("below"), F.sum(F.when(F.col("_v") <= F.col("_e"), F.col("_n")).otherwise(0)).alias("upto"))
    close = (F.col("below") / F.col("n") <= p + RANK_ERROR) & (F.col("upto") / F.col("n") >= p - RANK_ERROR)
    return ranks.select(*[F.col("_k")[c].alias(c) for c in keys], close.alias(name))
