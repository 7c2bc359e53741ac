"""Resampling with replacement against plain numpy."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.operators import metrics
from tessella.operators import quantiles as Q


def test_every_replicate_has_n_draws(spark):
    got = metrics.bootstrap_draws(spark, 137, 9, "s").toPandas()
    assert got.groupby("rep")["w"].sum().to_dict() == {r: 137 for r in range(9)}
    assert got["row"].between(0, 136).all() and 70 < got.groupby("rep").size().mean() < 105  # about 63 % of the rows
    assert metrics.bootstrap_draws(spark, 0, 3, 1).collect() == []


@pytest.mark.parametrize("range_rows", [200_000, 30])
def test_auc_of_the_resamples(spark, monkeypatch, range_rows):
    monkeypatch.setattr(Q, "RANGE_ROWS", range_rows)
    rng = np.random.default_rng(6)
    n, reps = 150, 20
    label, prob = rng.integers(0, 2, n), rng.integers(0, 40, n) / 40  # with ties
    rows = [(int(i * 31 % n), int(label[i * 31 % n]), float(prob[i * 31 % n])) for i in range(n)]
    df = spark.createDataFrame([*rows, (n, None, 0.5), (n + 1, 1, None)], "study_id long, label int, prob double").repartition(5)
    aucs = []
    for b in range(reps):
        at = [int(hashlib.md5(f"{b}-{i}-x".encode()).hexdigest()[:15], 16) % n for i in range(n)]
        pos, neg = prob[at][label[at] == 1], prob[at][label[at] == 0]
        aucs.append(((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg)))
    got = metrics.bootstrap_auc(df, reps, "x").first()
    assert got["replicates"] == reps and np.isclose(got["mean"], np.mean(aucs))
    assert np.allclose([got["low"], got["middle"], got["high"]], np.quantile(aucs, [0.025, 0.5, 0.975]))


def test_one_class_and_no_rows(spark):
    df = spark.createDataFrame([(1, 1, 0.5), (2, 1, 0.7)], "study_id long, label int, prob double")
    for table in (df, df.limit(0)):
        assert tuple(metrics.bootstrap_auc(table, 5, 1).first())[:2] == (0, None)


def test_numbered_rows(spark, monkeypatch):
    monkeypatch.setattr(Q, "RANGE_ROWS", 20)
    rows, n = Q.number_rows(spark.range(300).select((F.col("id") * 7 % 300).alias("k"), F.lit("x").alias("row_")), ["k"])
    assert n == 300 and rows.filter("row = k").count() == 300
