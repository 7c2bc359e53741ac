"""A perceptron with hidden layers, trained on data that stays where it is.

Rows are packed once into blocks of numbers.  A step sends the weights to the
tasks, each of which adds up loss and gradient of its blocks; the sums meet in a
bounded number of groups, and the driver, which sees nothing but these sums,
takes an Adam step.  A part of the train rows, by the hash of their key, is kept
out; training stops where its loss no longer falls, and the best weights stay.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.sources.scratch import stored

#: Rows of a block, and groups in which the sums of the tasks meet.
BLOCK, GROUPS = 2048, 32
_SHAPES = "bucket int, n long, loss double, gradient binary"


def start(sizes: list[int], seed: int) -> np.ndarray:
    """Weights and biases of all layers end to end, uniform within the bound for rectified units."""
    rng, parts = np.random.default_rng(seed), []
    for a, b in zip(sizes, sizes[1:], strict=False):
        bound = np.sqrt(6.0 / (a + b))
        parts += [rng.uniform(-bound, bound, a * b), rng.uniform(-bound, bound, b)]
    return np.concatenate(parts)


def layers(flat: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for a, b in zip(sizes, sizes[1:], strict=False):
        out.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def forward(flat: np.ndarray, sizes: list[int], x: np.ndarray) -> list[np.ndarray]:
    """Activations of all layers; the last one is linear."""
    out = [x]
    parts = layers(flat, sizes)
    for i, (w, b) in enumerate(parts):
        z = out[-1] @ w + b
        out.append(z if i == len(parts) - 1 else np.maximum(z, 0))
    return out


def loss_and_gradient(flat: np.ndarray, sizes: list[int], x: np.ndarray, y: np.ndarray, kind: str) -> tuple[float, np.ndarray]:
    """Sums over the rows of half the squared error, or of the logistic loss, and their gradient."""
    acts = forward(flat, sizes, x)
    z = acts[-1][:, 0]
    if kind == "regression":
        delta = z - y
        loss = 0.5 * float(delta @ delta)
    else:
        loss = float((np.logaddexp(0, z) - y * z).sum())
        delta = np.exp(-np.logaddexp(0, -z)) - y
    grad, back = [], delta[:, None]
    for i, (w, _) in reversed(list(enumerate(layers(flat, sizes)))):
        grad += [back.sum(axis=0), (acts[i].T @ back).ravel()]
        back = (back @ w.T) * (acts[i] > 0)
    return loss, np.concatenate(grad[::-1])


def pack(rows: DataFrame) -> DataFrame:
    """``part, n, x, y`` blocks of ``part, features, y``; a block is of one part."""

    def run(batches):
        held: dict[int, list] = {}

        def block(part: int, take: list) -> pd.DataFrame:
            x, y = np.stack([a for a, _ in take]), np.array([b for _, b in take])
            return pd.DataFrame({"part": [part], "n": [len(y)], "x": [x.tobytes()], "y": [y.tobytes()]})

        for pdf in batches:
            for part, f, y in zip(pdf["part"], pdf["features"], pdf["y"], strict=True):
                own = held.setdefault(part, [])
                own.append((np.asarray(f, float), y))
                if len(own) == BLOCK:
                    yield block(part, held.pop(part))
        for part, own in held.items():
            yield block(part, own)

    return rows.select("part", "features", F.col("y").cast("double").alias("y")).mapInPandas(run, "part int, n long, x binary, y binary")


@dataclass
class Perceptron:
    """``flat`` are the weights; ``losses`` the mean validation loss after each epoch; ``mean, sd`` of the features."""

    sizes: list[int]
    flat: np.ndarray | None
    kind: str
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    sd: np.ndarray = field(default_factory=lambda: np.zeros(0))
    losses: list[float] = field(default_factory=list)

    def predict(self, rows: DataFrame, features: str = "features", name: str = "pred") -> DataFrame:
        """``rows`` with the prediction, of classes their probability; null without features or a fitted model."""
        if self.flat is None:
            return rows.withColumn(name, F.lit(None).cast("double"))
        sent = rows.sparkSession.sparkContext.broadcast(self)  # the weights

        @F.pandas_udf("double")
        def run(batch: pd.Series) -> pd.Series:
            m, out = sent.value, np.full(len(batch), np.nan)
            has = batch.notna().to_numpy()
            if has.any():
                z = forward(m.flat, m.sizes, (np.stack(batch[has].to_list()).astype(float) - m.mean) / m.sd)[-1][:, 0]
                out[has] = z if m.kind == "regression" else np.exp(-np.logaddexp(0, -z))
            return pd.Series(out)

        return rows.withColumn(name, run(features))


def _sums(blocks: DataFrame, flat: np.ndarray, sizes: list[int], kind: str, gradient: bool) -> tuple[int, float, np.ndarray]:
    sent = blocks.sparkSession.sparkContext.broadcast(flat)

    def add_up(batches):
        from pyspark import TaskContext

        n, loss, total = 0, 0.0, np.zeros(len(flat) if gradient else 0)
        for pdf in batches:
            for size, x, y in zip(pdf["n"], pdf["x"], pdf["y"], strict=True):
                one, grad = loss_and_gradient(sent.value, sizes, np.frombuffer(x).reshape(size, -1), np.frombuffer(y), kind)
                n, loss = n + size, loss + one
                total += grad if gradient else 0
        yield pd.DataFrame({"bucket": [TaskContext.get().partitionId() % GROUPS], "n": [n], "loss": [loss], "gradient": [total.tobytes()]})

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(g) for g in pdf["gradient"]], axis=0)
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "n": [pdf["n"].sum()], "loss": [pdf["loss"].sum()], "gradient": [total.tobytes()]})

    met = blocks.mapInPandas(add_up, _SHAPES).groupBy("bucket").applyInPandas(meet, _SHAPES).orderBy("bucket").collect()  # GROUPS rows of the model's size
    sent.destroy()
    n, loss = sum(r["n"] for r in met), sum(r["loss"] for r in met)
    return n, loss, np.sum([np.frombuffer(r["gradient"]) for r in met], axis=0) if met else np.zeros(0)


def deal(rows: DataFrame, key: str, batches: int, validation: float) -> DataFrame:
    """Train rows with their ``part``: a batch from 0 on, or -1 for validation, by the hash of ``key``."""
    h = F.pmod(F.xxhash64(key), F.lit(1_000_000))
    batch = F.pmod(F.xxhash64(key, F.lit(1)), F.lit(batches))
    return rows.filter("split = 'train' AND features IS NOT NULL AND y IS NOT NULL").withColumn("part", F.when(h < int(validation * 1_000_000), F.lit(-1)).otherwise(batch).cast("int"))


def fit(
    rows: DataFrame, key: str, kind: str = "regression", hidden: tuple[int, ...] = (128, 64), batches: int = 4, epochs: int = 500, patience: int = 10, tolerance: float = 1e-4,
    rate: float = 1e-3, decay: float = 1e-4, validation: float = 0.15, seed: int = 0,
) -> Perceptron:
    """Fit on the train rows of ``split, features, y``; ``key`` deals them to ``batches`` and the validation part.

    Features are standardised by the train rows, a constant one has scale 1.
    Training ends after ``epochs``, or where ``patience`` epochs in a row have
    not lowered the validation loss by ``tolerance``; without validation rows it
    is the loss of the batches that counts.  Without train rows nothing is fitted.
    """
    dealt = deal(rows, key, batches, validation)
    first = dealt.select(F.size("features").alias("p")).first()
    if first is None:
        return Perceptron([], None, kind)
    p = first["p"]
    cells = dealt.select(F.posexplode("features").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect()  # a row for each feature
    mean, sd = np.zeros(p), np.ones(p)
    for r in cells:
        mean[r["i"]], sd[r["i"]] = r["m"], r["s"] if r["s"] > 1e-12 else 1.0
    scaled = F.zip_with("features", F.array(*[F.struct(F.lit(float(m)).alias("m"), F.lit(float(s)).alias("s")) for m, s in zip(mean, sd, strict=True)]), lambda v, c: (v - c["m"]) / c["s"])
    blocks = stored(pack(dealt.withColumn("features", scaled)), "blocks", "part")
    sizes = [p, *hidden, 1]
    flat, model = start(sizes, seed), Perceptron(sizes, None, kind, mean, sd)
    one, two, best, waited, step = np.zeros_like(flat), np.zeros_like(flat), np.inf, 0, 0
    model.flat = flat
    held_out = blocks.filter("part = -1")
    has_validation = not held_out.isEmpty()
    weights = np.concatenate([np.concatenate([np.ones(w.size), np.zeros(b.size)]) for w, b in layers(flat, sizes)])  # biases do not decay
    for _ in range(epochs):
        seen = [0, 0.0]
        for b in range(batches):
            n, loss, grad = _sums(blocks.filter(F.col("part") == b), flat, sizes, kind, True)
            if not n:
                continue
            seen = [seen[0] + n, seen[1] + loss]
            step += 1
            g = (grad + decay * weights * flat) / n
            one, two = 0.9 * one + 0.1 * g, 0.999 * two + 0.001 * g * g
            flat = flat - rate * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.999**step)) + 1e-8)
        n, loss = _sums(held_out, flat, sizes, kind, False)[:2] if has_validation else seen
        model.losses.append(loss / max(n, 1))
        waited = 0 if model.losses[-1] < best - tolerance else waited + 1
        if model.losses[-1] < best:
            best, model.flat = model.losses[-1], flat
        if waited >= patience:
            break
    return model
