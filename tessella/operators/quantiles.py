"""Exact quantiles of all groups at once, by distributed selection.

Values are first counted, so a value is one row however often it occurs.  The
distinct values are dealt by ranges of (key, value); what the ranges hold is
added up, which tells for every rank the one range that has it.  Only these
ranges are read again and ordered by themselves, so a group of any size costs no
task more than a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.sources.scratch import stored

#: Distinct values of a range, on average.
RANGE_ROWS = 200_000


def exact_quantiles(df: DataFrame, keys: list[str], value: str | Column, probs: list[float], name: str = "q") -> DataFrame:
    """``keys`` and an array of the quantiles ``probs`` of each group, between neighbours by linear interpolation.

    Null values are left out, and so are groups without another one; null is a
    key like others.  NaN is larger than all numbers.  Without ``keys`` there is
    one group.  An empty table gives no rows.
    """
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("_all"))
    column = F.col(value) if isinstance(value, str) else value
    seen = df.select(key.alias("k"), column.cast("double").alias("v")).filter("v IS NOT NULL")
    counts = stored(seen.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")), "counts")
    ranges = max(1, -(-counts.count() // RANGE_ROWS))
    dealt = counts.withColumn("r", F.lit(0)) if ranges == 1 else stored(counts.repartitionByRange(ranges, "k", "v").withColumn("r", F.spark_partition_id()), "ranges")

    group = Window.partitionBy("k")
    sums = dealt.groupBy("k", "r").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(group.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = sums.select("k", "r", "n", before.alias("start"), F.sum("n").over(group).alias("total"))
    places = [F.lit(float(p)) * (F.col("total") - 1) for p in probs]
    ranks = F.array_distinct(F.array(*[f(x).cast("long") for x in places for f in (F.floor, F.ceil)]))
    here = F.filter(ranks, lambda i: (i >= F.col("start")) & (i < F.col("start") + F.col("n")))
    wanted = placed.select("k", "r", "start", "total", here.alias("ranks")).filter(F.size("ranks") > 0)

    up_to = F.sum("n").over(Window.partitionBy("k", "r").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ordered = dealt.join(wanted, ["k", "r"]).withColumn("end", F.col("start") + up_to)
    mine = F.filter("ranks", lambda i: (i >= F.col("end") - F.col("n")) & (i < F.col("end")))
    hits = ordered.select("k", "total", "v", F.explode(mine).alias("rank"))
    found = hits.groupBy("k").agg(F.max("total").alias("total"), F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))

    def between(x: Column) -> Column:
        low, part = F.floor(x).cast("long"), x - F.floor(x)
        return F.when(part == 0, F.col("at")[low]).otherwise(F.col("at")[low] * (1 - part) + F.col("at")[low + 1] * part)

    return found.select(*[F.col("k")[c].alias(c) for c in keys], F.array(*map(between, places)).alias(name))


def number_rows(df: DataFrame, order: list[str | Column]) -> tuple[DataFrame, int]:
    """``df`` with its rows' numbers from 0 in ``row``, in the order of columns, and their count.

    Rows are dealt by ranges, numbered within theirs, and only the ranges'
    counts meet.  Of rows that are equal in ``order`` any may come first.
    """
    rows = stored(df, "rows")
    n = rows.count()
    dealt = stored(rows.repartitionByRange(max(1, -(-n // RANGE_ROWS)), *order).withColumn("_r", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("_r").agg(F.count(F.lit(1)).alias("_n"))  # a row for each range
    starts = counts.select("_r", F.coalesce(F.sum("_n").over(Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_r").orderBy(*order))
    return dealt.withColumn("_own", own).join(starts, "_r").withColumn("row", F.col("_start") + F.col("_own") - 1).drop("_r", "_own", "_start"), n


def exact_median(df: DataFrame, keys: list[str], value: str | Column, name: str) -> DataFrame:
    return exact_quantiles(df, keys, value, [0.5], "_q").select(*keys, F.col("_q")[0].alias(name))


def attach(df: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` (one row a group) with the columns of ``found``; null keys meet, groups without a value stay."""
    if not keys:
        return df.join(F.broadcast(found), how="left")  # one row
    marked = found.select(F.struct(*keys).alias("_k"), *[c for c in found.columns if c not in keys])
    return df.withColumn("_k", F.struct(*keys)).join(marked, "_k", "left").drop("_k")
