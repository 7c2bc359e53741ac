"""Native array expressions for vectors and frame indices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def l2_norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def frame_indices(n: Column, target: int) -> Column:
    """``target`` indices spread evenly over ``n`` frames; a shorter clip repeats its last."""
    steps = F.sequence(F.lit(0), F.lit(target - 1))
    even = F.transform(steps, lambda i: F.floor(i * (n - 1) / F.lit(target - 1)).cast("int"))
    return F.when(n >= target, even).otherwise(F.transform(steps, lambda i: F.least(i, (n - 1).cast("int"))))


def affine(v: Column, mean: float, sd: float) -> Column:
    return F.transform(v, lambda x: (x.cast("double") - mean) / sd)


def affine_channels(v: Column, means: list[float], sds: list[float]) -> Column:
    """Values whose last axis is the channel, each by its channel's mean and deviation."""
    n, at = len(means), lambda values, i: F.element_at(F.array(*map(F.lit, values)), (i % len(values) + 1).cast("int"))
    if n != len(sds) or not n:
        raise ValueError("give a mean and a deviation for each channel")
    return F.transform(v, lambda x, i: (x.cast("double") - at(means, i)) / at(sds, i))


def one_hot(index: Column, size: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: (i == index).cast("double"))


def argmax(v: Column) -> Column:
    """The first index of the largest element."""
    return F.array_position(v, F.array_max(v)).cast("int") - 1


def softmax(v: Column) -> Column:
    e = F.transform(v, lambda x: F.exp(x.cast("double") - F.array_max(v).cast("double")))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))


def top_k(v: Column, k: int) -> Column:
    """``array<struct<p, i>>`` of the ``k`` largest elements, the lower index first at ties."""
    pairs = F.transform(v, lambda x, i: F.struct((-x).alias("p"), i.alias("i")))
    return F.transform(F.slice(F.array_sort(pairs), 1, k), lambda s: F.struct((-s["p"]).alias("p"), s["i"].alias("i")))


def pad_to(v: Column, size: int) -> Column:
    """Exactly ``size`` elements, zeros at the end."""
    return F.slice(F.concat(v, F.array_repeat(F.lit(0).cast("float"), size)), 1, size)


def stride(v: Column, step: int, size: int) -> Column:
    """Every ``step``-th element, then cut or padded with zeros to ``size``."""
    return pad_to(F.filter(v, lambda x, i: i % step == 0), size)


def join_vectors(*vectors: Column) -> Column:
    return F.concat(*vectors)
