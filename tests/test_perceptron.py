"""The perceptron against plain numpy on the same batches."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.operators import perceptron as P

SIZES = [3, 5, 4, 1]


def rows(spark, n=400, kind="regression", partitions=3):
    rng = np.random.default_rng(2)
    x = rng.normal(3, 2, (n, 3))
    y = np.sin(x[:, 0]) + 0.5 * x[:, 1] if kind == "regression" else (x[:, 0] * x[:, 1] > 9).astype(float)
    split = np.where(np.arange(n) % 5 == 0, "test", "train")
    table = [(i, str(s), a.tolist(), float(b)) for i, (s, a, b) in enumerate(zip(split, x, y, strict=True))]
    return spark.createDataFrame([*table, (n, "train", None, 1.0), (n + 1, "train", [0.0] * 3, None)], "id long, split string, features array<double>, y double").repartition(partitions)


@pytest.mark.parametrize("kind", ["regression", "classification"])
def test_gradient_is_that_of_the_loss(kind):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(20, 3)), rng.integers(0, 2, 20).astype(float)
    flat = P.start(SIZES, 7)
    loss, grad = P.loss_and_gradient(flat, SIZES, x, y, kind)
    for i in range(len(flat)):
        e = np.zeros_like(flat)
        e[i] = 1e-6
        up, down = (P.loss_and_gradient(flat + s * e, SIZES, x, y, kind)[0] for s in (1, -1))
        assert abs((up - down) / 2e-6 - grad[i]) < 1e-4
    z = P.forward(flat, SIZES, x)[-1][:, 0]
    plain = 0.5 * ((z - y) ** 2).sum() if kind == "regression" else -(y * np.log(1 / (1 + np.exp(-z))) + (1 - y) * np.log(1 - 1 / (1 + np.exp(-z)))).sum()
    assert np.isclose(loss, plain)


def by_numpy(table, kind, epochs, rate, decay, seed):
    """The same training on whole arrays."""
    part, x, y = table["part"].to_numpy(), np.stack(table["features"].to_list()), table["y"].to_numpy()
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    flat = P.start(SIZES, seed)
    m, v, step, losses = np.zeros_like(flat), np.zeros_like(flat), 0, []
    for _ in range(epochs):
        for b in range(part.max() + 1):
            some = part == b
            grad = P.loss_and_gradient(flat, SIZES, x[some], y[some], kind)[1]
            decayed = np.concatenate([np.r_[w.ravel(), 0 * c] for w, c in P.layers(flat, SIZES)])
            g = (grad + decay * decayed) / some.sum()
            step += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
            flat = flat - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        out = part == -1
        losses.append(P.loss_and_gradient(flat, SIZES, x[out], y[out], kind)[0] / out.sum())
    return flat, losses


@pytest.mark.parametrize("kind", ["regression", "classification"])
def test_training_equals_numpy(spark, monkeypatch, kind):
    monkeypatch.setattr(P, "BLOCK", 16)
    df = rows(spark, kind=kind)
    model = P.fit(df, "id", kind, hidden=(5, 4), batches=3, epochs=4, rate=0.02, seed=3)
    table = P.deal(df, "id", 3, 0.15).toPandas()
    assert set(table["part"]) == {-1, 0, 1, 2} and len(table) == 320
    flat, losses = by_numpy(table, kind, 4, 0.02, 1e-4, 3)
    assert np.allclose(model.losses, losses, rtol=1e-9)
    assert np.allclose(model.flat, flat, atol=1e-9) == (np.argmin(losses) == 3)
    out = model.predict(df).toPandas().set_index("id").sort_index()
    assert len(out) == 402 and np.isnan(out["pred"][400])
    x = (np.stack(out["features"].loc[:399].to_list()) - model.mean) / model.sd
    z = P.forward(model.flat, SIZES, x)[-1][:, 0]
    assert np.allclose(out["pred"].loc[:399], z if kind == "regression" else 1 / (1 + np.exp(-z)))


def test_it_stops_by_validation_loss(spark):
    df = rows(spark, partitions=2)
    model = P.fit(df, "id", hidden=(4,), batches=1, epochs=30, patience=2, tolerance=10.0, rate=0.01)
    assert len(model.losses) == 3  # the first epoch is the only one that is better by so much
    model = P.fit(df, "id", hidden=(16,), batches=2, epochs=12, rate=0.05)
    assert model.losses[-1] < 0.5 * model.losses[0]
    # the weights kept are the best ones
    held = P.deal(df, "id", 2, 0.15).filter("part = -1").toPandas()
    x = (np.stack(held["features"].to_list()) - model.mean) / model.sd
    assert np.isclose(P.loss_and_gradient(model.flat, model.sizes, x, held["y"].to_numpy(), "regression")[0] / len(held), min(model.losses))


def test_few_rows_and_none(spark):
    df = rows(spark, partitions=1)
    none = P.fit(df.filter("split = 'nothing'"), "id")
    assert [r["pred"] for r in none.predict(df.limit(3)).collect()] == [None] * 3
    constant = df.limit(5).withColumn("features", F.array(F.lit(1.0), F.lit(2.0)))
    model = P.fit(constant.withColumn("split", F.lit("train")), "id", hidden=(3,), batches=7, epochs=2, validation=0.0)
    assert len(model.losses) == 2 and np.isfinite(model.losses).all()
