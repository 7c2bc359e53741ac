"""Sketches kept by part against exact counts and ranks."""

import numpy as np
from pyspark.sql import functions as F

from tessella.operators import sketches as K

IDS, VALUES = ["who"], ["x"]


def rows(spark, n=60_000):
    """A third of the rows under one key, values of several shapes, many parts."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 4).cast("string"))).alias("name"), (F.col("id") % 17).alias("part"), (F.xxhash64("id") % 9000).alias("who"),
        F.when(F.col("id") % 5 != 0, F.log1p(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100_000)).cast("double"))).alias("x"),
    )


def test_estimates_are_within_the_stated_errors(spark):
    df = rows(spark).cache()
    merged = K.merge_parts(K.sketch_parts(df, ["name"], "part", IDS, VALUES), ["name"])
    ps = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = merged.select("name", "n_rows", K.distinct_estimate("who").alias("who"), *[K.quantile_estimate("x", p).alias(f"q{i}") for i, p in enumerate(ps)]).toPandas().set_index("name")
    exact = df.toPandas()
    assert set(got.index) == set(exact["name"]) and len(got) == 5
    for name, own in exact.groupby("name"):
        assert got.loc[name, "n_rows"] == len(own)
        assert abs(got.loc[name, "who"] - own["who"].nunique()) <= K.COUNT_ERROR * own["who"].nunique()
        x = np.sort(own["x"].dropna())
        for i, p in enumerate(ps):
            e = got.loc[name, f"q{i}"]
            assert np.searchsorted(x, e, "left") / len(x) <= p + K.RANK_ERROR and np.searchsorted(x, e, "right") / len(x) >= p - K.RANK_ERROR
    estimates = merged.select("name", K.quantile_estimate("x", 0.5).alias("e"))
    assert all(r["ok"] for r in K.rank_within(df, ["name"], "x", estimates, "e", 0.5, "ok").collect())
    assert not any(r["ok"] for r in K.rank_within(df, ["name"], "x", estimates, "e", 0.6, "ok").collect())


def test_parts_are_added_and_replaced(spark):
    df = rows(spark, 9000)
    first = K.sketch_parts(df.filter("part < 9"), ["name"], "part", IDS, VALUES)
    stale = K.sketch_parts(df.filter("part = 8 AND who > 0"), ["name"], "part", IDS, VALUES)
    kept = K.replace_parts(first, stale, "part")
    kept = K.replace_parts(kept, K.sketch_parts(df.filter("part >= 8"), ["name"], "part", IDS, VALUES), "part")
    got = {r["name"]: (r["n_rows"], r["n"]) for r in K.merge_parts(kept, ["name"]).select("name", "n_rows", K.distinct_estimate("who").alias("n")).collect()}
    want = {r["name"]: (r["n"], r["d"]) for r in df.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("who").alias("d")).collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(abs(got[k][1] - want[k][1]) <= K.COUNT_ERROR * want[k][1] + 1 for k in want)


def test_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(None, None, None, None), ("a", 1, None, 3.0), ("a", None, 5, None)], "name string, part int, who long, x double")
    merged = K.merge_parts(K.sketch_parts(df, ["name"], "part", IDS, VALUES), ["name"])
    got = {r["name"]: tuple(r)[1:] for r in merged.select("name", "n_rows", K.distinct_estimate("who"), K.quantile_estimate("x", 0.5)).collect()}
    assert got == {None: (1, 0, None), "a": (2, 1, 3.0)}
    assert K.merge_parts(K.sketch_parts(df.limit(0), ["name"], "part", IDS, VALUES), ["name"]).collect() == []
    assert K.replace_parts(merged.withColumn("part", F.lit(1)), merged.withColumn("part", F.lit(1)), "part").count() == 2
