"""Regression and classification metrics as aggregates and windows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.operators.quantiles import attach, exact_quantiles, number_rows


def target_summary(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """Values, median and interquartile range by key."""
    out = attach(df.groupBy(*keys).agg(F.count(value).alias("n")), exact_quantiles(df, list(keys), value, [0.25, 0.5, 0.75], "_q"), list(keys))
    return out.select(*keys, "n", F.col("_q")[1].alias("median"), (F.col("_q")[2] - F.col("_q")[0]).alias("iqr"))


def regression(df: DataFrame, *keys: str, spread: bool = True) -> DataFrame:
    """MAE, RMSE, R2 (null below two rows or without spread) and, with ``spread``, IQR of the target and MAE over IQR, by key."""
    e = F.col("y") - F.col("pred")
    usable = df.filter(F.col("y").isNotNull() & F.col("pred").isNotNull())
    out = usable.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e * e).alias("_mse"), F.var_pop("y").alias("_var"))
    r2 = F.when((F.col("n") >= 2) & (F.col("_var") > 1e-12), 1 - F.col("_mse") / F.col("_var"))
    if not spread:
        return out.select(*keys, "n", "mae", "rmse", r2.alias("r2"))
    out = attach(out, exact_quantiles(usable, list(keys), "y", [0.25, 0.75], "_q"), list(keys))
    iqr = F.col("_q")[1] - F.col("_q")[0]
    return out.select(*keys, "n", "mae", "rmse", r2.alias("r2"), iqr.alias("iqr"), F.when(iqr > 0, F.col("mae") / iqr).alias("mae_norm_iqr"))


def _placed(scores: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``scores`` (one row for each key and ``prob``, with ``pos`` and ``n``) with ``tp`` and ``above``: positives and rows of at least this score.

    Scores are ranked within 1024 ranges of [0, 1]; only the sums of the ranges meet.
    """
    band = F.when(F.isnan("prob"), F.lit(1023)).otherwise(F.greatest(F.lit(0), F.least(F.lit(1023), F.floor(F.col("prob") * 1024)))).cast("int")
    scores, names = scores.withColumn("_band", band), [*keys, "_band"]
    higher = Window.partitionBy(*keys).orderBy(F.desc("_band")).rowsBetween(Window.unboundedPreceding, -1)  # 1024 rows a key at most
    bands = scores.groupBy(*names).agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    before = bands.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(names)], *[F.coalesce(F.sum(c).over(higher), F.lit(0)).alias(f"_{c}_before") for c in ("pos", "n")])
    down = Window.partitionBy(*names).orderBy(F.desc("prob")).rowsBetween(Window.unboundedPreceding, 0)
    placed = scores.join(before, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(names)]))
    return placed.withColumns({"tp": F.sum("pos").over(down) + F.col("_pos_before"), "above": F.sum("n").over(down) + F.col("_n_before")})


def _won():
    """A negative loses to all positives above it, and half to those of its score."""
    return F.sum((F.col("n") - F.col("pos")) * (F.col("tp") - F.col("pos") + F.col("pos") / 2))


def classification(df: DataFrame, *keys: str, threshold: float = 0.5) -> DataFrame:
    """ROC-AUC (null for one class), average precision, F1, prevalence and predicted rate, by key; rows are first counted by score."""
    hit = F.col("prob") >= threshold
    scores = df.filter(F.col("label").isNotNull() & F.col("prob").isNotNull()).groupBy(*keys, "prob").agg(F.sum("label").alias("pos"), F.count(F.lit(1)).alias("n"))
    out = _placed(scores, keys).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("pos").alias("_p"), _won().alias("_won"), F.sum(F.col("pos") * F.col("tp") / F.col("above")).alias("_ap"),
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("_tp"), F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("_hit"),
    )
    p, neg = F.col("_p"), F.col("n") - F.col("_p")
    both = (p > 0) & (neg > 0)
    return out.select(
        *keys, "n", F.when(both, F.col("_won") / (p * neg)).alias("auc"), F.when(both, F.col("_ap") / p).alias("average_precision"),
        F.coalesce(F.try_divide(2.0 * F.col("_tp"), (F.col("_hit") + p).cast("double")), F.lit(0.0)).alias("f1"), (p / F.col("n")).alias("prevalence"), (F.col("_hit") / F.col("n")).alias("predicted_rate"),
    )


def bootstrap_draws(spark: SparkSession, n: int, replicates: int, seed: int | str) -> DataFrame:
    """``rep, row, w``: how often each of ``n`` row numbers is among the ``n`` draws of a replicate.

    The ``i``-th draw of a replicate is a hash of seed, replicate and ``i``, so
    draws are made wherever they are needed, and the same again after a failure.
    """
    draws = spark.range(replicates * n).select(F.expr(f"CAST(id DIV {max(n, 1)} AS INT)").alias("rep"), (F.col("id") % max(n, 1)).alias("i"))
    h = F.conv(F.substring(F.md5(F.concat_ws("-", F.col("rep").cast("string"), F.col("i").cast("string"), F.lit(str(seed)))), 1, 15), 16, 10).cast("long")
    return draws.groupBy("rep", (h % max(n, 1)).alias("row")).agg(F.count(F.lit(1)).alias("w"))


def bootstrap_auc(df: DataFrame, replicates: int, seed: int | str, key: str = "study_id") -> DataFrame:
    """Mean, 2.5, 50 and 97.5 percentiles of AUC over resamples of as many rows with replacement; one-class resamples are skipped.

    Rows are numbered in the order of ``key``, and met by the numbers drawn.
    Scores of a replicate are ranked by bands, so no group is a whole replicate.
    Rows without label or score take no part.
    """
    rows, n = number_rows(df.filter(F.col("label").isNotNull() & F.col("prob").isNotNull()).select(key, "label", "prob"), [key, "prob", "label"])
    drawn = bootstrap_draws(df.sparkSession, n, replicates, seed).join(rows.select("row", "label", "prob"), "row")
    scores = drawn.groupBy("rep", "prob").agg(F.sum(F.col("w") * F.col("label")).alias("pos"), F.sum("w").alias("n"))
    auc = _placed(scores, ("rep",)).groupBy("rep").agg(F.sum("pos").alias("p"), F.sum(F.col("n") - F.col("pos")).alias("m"), _won().alias("won")).filter("p > 0 AND m > 0")
    q = auc.select((F.col("won") / (F.col("p") * F.col("m"))).alias("auc")).agg(  # a row for each replicate
        F.count(F.lit(1)).alias("replicates"), F.avg("auc").alias("mean"), F.percentile("auc", F.array(F.lit(0.025), F.lit(0.5), F.lit(0.975))).alias("q")
    )
    return q.select("replicates", "mean", F.col("q")[0].alias("low"), F.col("q")[1].alias("middle"), F.col("q")[2].alias("high"))
