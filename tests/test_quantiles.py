"""Quantiles by distributed selection against numpy and the aggregates they stand for."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.operators import quantiles as Q


@pytest.mark.parametrize("range_rows", [200_000, 40])
def test_against_numpy(spark, monkeypatch, range_rows):
    """A hot name with very frequent values, one of few rows, ties, null names, and ranks at either side of a range."""
    monkeypatch.setattr(Q, "RANGE_ROWS", range_rows)
    rnd = random.Random(1)
    sizes = {"hot": 3000, None: 77, "two": 2, "one": 1, "same": 50, "steps": 41}
    value = {"hot": lambda: rnd.choice([5.0, rnd.gauss(0, 9)]), "same": lambda: 2.5, "steps": lambda: float(rnd.randint(-3, 3))}
    rows = [(k, value.get(k, lambda: rnd.uniform(-1e6, 1e6))(), i) for k, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame([*rows, ("hot", None, 0), ("empty", None, 0)], "name string, x double, v int").repartition(6)
    probs = [0.0, 0.05, 0.25, 0.5, 0.95, 0.999, 1.0]
    got = {r["name"]: r["q"] for r in Q.exact_quantiles(df, ["name"], "x", probs).collect()}
    assert got.keys() == sizes.keys()
    for k, q in got.items():
        assert np.allclose(q, np.quantile([x for n, x, _ in rows if n == k], probs), rtol=1e-12)
    plain = df.filter("name IS NOT NULL").groupBy("name").agg(F.percentile("x", F.array(*map(F.lit, probs))).alias("p")).filter("p IS NOT NULL")
    for r in plain.collect():
        assert np.allclose(got[r["name"]], r["p"], rtol=1e-12)


def test_a_hot_name_is_spread_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(Q, "RANGE_ROWS", 100)
    dealt = []
    keep = Q.stored
    monkeypatch.setattr(Q, "stored", lambda df, name: dealt.append((name, t := keep(df, name))) or t)
    df = spark.range(2000).select(F.lit("hot").alias("name"), (F.col("id") * 7919 % 2000).alias("x"))
    assert Q.exact_quantiles(df, ["name"], "x", [0.5]).first()["q"] == [999.5]
    sizes = [r["n"] for r in dict(dealt)["ranges"].groupBy("r").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) > 10 and max(sizes) < 400


def test_several_keys_no_keys_and_no_rows(spark):
    df = spark.createDataFrame([(1, None, 4.0), (1, None, 8.0), (1, "b", math.nan), (1, "b", 1.0), (2, "b", -0.0), (2, "b", 0.0)], "a int, b string, x double")
    got = {(r["a"], r["b"]): r["m"] for r in Q.exact_median(df, ["a", "b"], "x", "m").collect()}
    assert got[1, None] == 6.0 and math.isnan(got[1, "b"]) and got[2, "b"] == 0.0
    assert [r["m"] for r in Q.exact_median(df.filter("x < 5"), [], "x", "m").collect()] == [0.5]
    assert Q.exact_median(df.limit(0), ["a"], "x", "m").collect() == [] == Q.exact_median(df.limit(0), [], "x", "m").collect()
    whole = Q.attach(df.groupBy("a", "b").count(), Q.exact_median(df.filter("x > 3"), ["a", "b"], "x", "m"), ["a", "b"])
    assert whole.count() == 3 and [r["m"] for r in whole.collect() if r["b"] is None] == [6.0]
