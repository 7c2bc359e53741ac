"""Reproducible splits by hash, by class and by count, and frozen maps."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions import numeric
from tessella.operators.checks import require_unique

SPLITS = ("train", "val", "test")


def hash_split(subjects: DataFrame, seed: str, train: float = 0.7, val: float = 0.15, version: str = "v1") -> DataFrame:
    """Each subject's split by its hashed id alone, with the settings it was made by."""
    score = numeric.split_score(seed, F.col("subject_id"))
    return subjects.select("subject_id").distinct().select(
        "subject_id", score.alias("split_score"), numeric.split_of(score, train, val).alias("split"), F.lit(version).alias("split_version"), F.lit(seed).alias("seed_string"), F.lit(train).alias("train_frac"), F.lit(val).alias("val_frac")
    )


def _share(part: float) -> Column:
    """``part`` of the ``n`` rows, rounded down; in decimals, since 0.7 of 90,000 is below 63,000 in binary fractions."""
    return F.floor(F.col("n") * F.lit(Decimal(str(part)))).cast("long")


def _split_by_rank(train: float, val: float):
    """Split of rank ``r`` (from 1) among ``n``: one goes to train, of two one to test, else one at least to each."""
    n, r = F.col("n"), F.col("r")
    n_train = F.greatest(F.lit(1), _share(train))
    n_val = F.greatest(F.lit(1), _share(val))
    # the test part takes a row from val, and from train where val has one only
    short = F.greatest(F.lit(0), 1 - (n - n_train - n_val))
    from_val = F.least(short, n_val - 1)
    n_val, n_train = n_val - from_val, n_train - (short - from_val)
    many = F.when(r <= n_train, "train").when(r <= n_train + n_val, "val").otherwise("test")
    return F.when(n == 1, "train").when(n == 2, F.when(r == 1, "train").otherwise("test")).otherwise(many)


def _ranked(keyed: DataFrame, by: list[str]) -> DataFrame:
    """``r``, the place of each row in the order of its hash ``k``, and ``n``, within the groups of ``by``.

    The first byte of the hash deals rows to buckets that are ranked apart; only
    the counts of the buckets meet.
    """
    keyed = keyed.withColumn("b", F.substring("k", 1, 2))
    counts = keyed.groupBy(*by, "b").agg(F.count(F.lit(1)).alias("c"))
    group = Window.partitionBy(*by)  # 256 rows a group at most
    before = counts.select(*by, "b", (F.sum("c").over(group.orderBy("b")) - F.col("c")).alias("before"), F.sum("c").over(group).alias("n"))
    ranked = keyed.withColumn("i", F.row_number().over(Window.partitionBy(*by, "b").orderBy("k", "subject_id")))
    return ranked.join(before.withColumnsRenamed({c: f"_{c}" for c in [*by, "b"]}), reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*by, "b"]])).withColumn("r", F.col("before") + F.col("i"))


def stratified_split(subjects: DataFrame, label: str, seed: int | str, train: float = 0.7, val: float = 0.15) -> DataFrame:
    """Subjects of each class dealt to the splits in a stable pseudo-random order; null is a class."""
    keyed = subjects.select("subject_id", label).distinct().withColumn("k", numeric.tie_key(F.col("subject_id"), seed))
    return _ranked(keyed, [label]).select("subject_id", label, _split_by_rank(train, val).alias("split"))


def shuffle_split(subjects: DataFrame, seed: int | str, train: float = 0.7, val: float = 0.15) -> DataFrame:
    """Exact shares of all subjects in a stable pseudo-random order, that of a hash."""
    keyed = subjects.select("subject_id").distinct().withColumn("k", numeric.tie_key(F.col("subject_id"), seed))
    ranked = _ranked(keyed, [])
    cut = _share(train), _share(train) + _share(val)
    return ranked.select("subject_id", F.when(F.col("r") <= cut[0], "train").when(F.col("r") <= cut[1], "val").otherwise("test").alias("split"))


def frozen_split(df: DataFrame, splits: DataFrame, strict: bool = True) -> DataFrame:
    """``df`` with the split of a frozen map; bad labels and repeated or missing subjects are errors when ``strict``."""
    clean = splits.select("subject_id", F.trim(F.lower("split")).alias("split"))
    if strict:
        require_unique(clean, "subject_id")
        if not clean.filter(~F.coalesce(F.col("split").isin(*SPLITS), F.lit(False))).isEmpty():
            raise ValueError("the split map has labels other than train, val and test")
    out = df.join(clean, "subject_id", "left")
    if strict:
        out = out.withColumn("split", F.coalesce("split", F.raise_error(F.lit("a subject has no split")).cast("string")))
    return out
