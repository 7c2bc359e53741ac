"""Feature matrices without leakage, and closed-form baselines."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions import text
from tessella.operators.checks import require_unique
from tessella.operators.quantiles import exact_median
from tessella.sources.scratch import stored


def coverage(long: DataFrame, name: str, n_studies: int, least: float) -> DataFrame:
    """Studies with each feature, their share, leakage of the name, and whether the feature is kept."""
    out = long.filter(F.col("value").isNotNull()).groupBy(name).agg(F.countDistinct("study_id").alias("n_studies"))
    out = out.withColumns({"coverage": F.col("n_studies") / F.lit(max(n_studies, 1)), "leakage": text.is_leakage(F.col(name))})
    return out.withColumn("kept", ~F.col("leakage") & (F.col("coverage") >= least))


def missing_rate(long: DataFrame, name: str, n_studies: int) -> DataFrame:
    """The share of empty cells of the study by feature matrix."""
    cells = long.filter(F.col("value").isNotNull()).select("study_id", name).distinct()
    return cells.agg(F.countDistinct(name).alias("n_features"), F.count(F.lit(1)).alias("n_cells")).select("*", (1 - F.try_divide(F.col("n_cells"), F.col("n_features") * F.lit(max(n_studies, 1)))).alias("missing_rate"))


def impute_and_scale(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Medians, means and population deviations of the train rows applied to all; a constant feature has scale 1.

    A feature without any train value is left out; without any train row all
    features stay and are null.
    """
    train = rows.filter("split = 'train'")
    cells = train.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    middle = {r["column"]: r["m"] for r in exact_median(cells, ["column"], "value", "m").collect()}  # a row for each column
    if not middle and train.isEmpty():
        return rows.withColumns({c: F.lit(None).cast("double") for c in columns})
    used = [c for c in columns if c in middle]
    filled = rows.withColumns({c: F.coalesce(F.col(c), F.lit(float(middle[c]))) for c in used}).drop(*set(columns) - set(used))
    stats = filled.filter("split = 'train'").agg(*[F.avg(c).alias(f"m_{c}") for c in used], *[F.stddev_pop(c).alias(f"s_{c}") for c in used]).first() if used else None
    return filled.withColumns({c: (F.col(c) - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"] or 1.0) for c in used})


def moments(rows: DataFrame) -> DataFrame:
    """``task_col, n, mean, gram`` of ``task_col, features, y``: the mean of the features with ``y`` last, and their centred products.

    A task of Spark adds up its rows batch by batch and passes on one row for
    each ``task_col``, so a very frequent one is a row a task.
    """
    schema = "task_col string, n long, mean array<double>, gram array<double>"

    def merged(a, b):
        n, step = a[0] + b[0], b[1] - a[1]
        return n, a[1] + step * (b[0] / n), a[2] + b[2] + np.outer(step, step) * (a[0] * b[0] / n)

    def frame(sums: dict) -> pd.DataFrame:
        return pd.DataFrame([(t, n, mean, gram.ravel()) for t, (n, mean, gram) in sums.items()], columns=["task_col", "n", "mean", "gram"])

    def add_up(batches):
        sums: dict = {}
        for pdf in batches:
            for task, part in pdf.groupby("task_col", dropna=False):
                x = np.column_stack([np.stack(part["features"].to_numpy()).astype(float), part["y"].to_numpy(float)])
                mean = x.mean(axis=0)
                new = (len(x), mean, (x - mean).T @ (x - mean))
                sums[task] = merged(sums[task], new) if task in sums else new
        yield frame(sums)

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [(n, np.asarray(mean), np.asarray(gram).reshape(len(mean), -1)) for n, mean, gram in zip(pdf["n"], pdf["mean"], pdf["gram"], strict=True)]
        return frame({pdf["task_col"].iloc[0]: reduce(merged, parts)})

    return rows.select("task_col", "features", "y").mapInPandas(add_up, schema).groupBy("task_col").applyInPandas(join, schema)


def ridge(rows: DataFrame, features: list[str], target: str, alpha: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights and intercept of ridge regression from centred sums over the train rows; only (p + 1)^2 numbers reach the driver."""
    train = rows.filter(F.col("split") == "train").select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], F.col(target).cast("double").alias("y")).dropna()
    whole = moments(train.select(F.lit("").alias("task_col"), F.array(*[f"x{i}" for i in range(len(features))]).alias("features"), "y")).first()
    if whole is None:
        return np.zeros(len(features)), 0.0
    mean, p = np.array(whole["mean"]), len(features)
    gram = np.array(whole["gram"]).reshape(p + 1, p + 1)
    w = np.linalg.solve(gram[:p, :p] + alpha * np.eye(p), gram[:p, p])
    return w, float(mean[p] - w @ mean[:p])


def predict_linear(rows: DataFrame, features: list[str], weights: np.ndarray, intercept: float, name: str = "pred") -> DataFrame:
    out = F.lit(float(intercept))
    for c, w in zip(features, weights, strict=True):
        out = out + F.col(c) * F.lit(float(w))
    return rows.withColumn(name, out)


def ridge_by_task(rows: DataFrame, features: str, alpha: float = 1.0) -> DataFrame:
    """``task_col, study_id, split, y, pred`` of one ridge model per task over standardised array features.

    A task with fewer than two train rows has no prediction (NaN).
    """
    train = rows.filter("split = 'train'").select("task_col", F.col(features).alias("features"), F.col("y").cast("double").alias("y"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for task, n, mean, gram in zip(pdf["task_col"], pdf["n"], pdf["mean"], pdf["gram"], strict=True):
            mean, p = np.asarray(mean), len(mean) - 1
            gram = np.asarray(gram).reshape(p + 1, p + 1)
            sd = np.sqrt(np.maximum(np.diag(gram)[:p], 0) / n)
            sd = np.where(sd > 0, sd, 1)
            w = np.linalg.solve(gram[:p, :p] / np.outer(sd, sd) + alpha * np.eye(p), gram[:p, p] / sd) / sd
            if n > 1:
                out.append((task, w, mean[p] - w @ mean[:p]))
        return pd.DataFrame(out, columns=["task_col", "_w", "_b"])

    # one small row a task
    models = moments(train).mapInPandas(lambda batches: map(solve, batches), "task_col string, _w array<double>, _b double")
    found = rows.join(models, "task_col", "left")
    dot = F.aggregate(F.zip_with(F.col(features), "_w", lambda x, w: x.cast("double") * w), F.col("_b"), lambda a, x: a + x)
    return found.select("task_col", "study_id", "split", F.col("y").cast("double").alias("y"), F.coalesce(dot, F.lit(float("nan"))).alias("pred"))


def top_coefficients(names: list[str], weights, spark, k: int = 20) -> DataFrame:
    """``feature, coefficient, rank`` of the ``k`` weights of largest size, the first name at ties."""
    rows = [(str(n), float(w)) for n, w in zip(names, weights, strict=True)]
    top = spark.createDataFrame(rows, "feature string, coefficient double").orderBy(F.abs("coefficient").desc(), "feature").limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.abs("coefficient").desc(), "feature")))  # k rows


def _nothing(rows: DataFrame, column: str, kind: str):
    """A fitted pipeline that adds a null column, for no train rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import SQLTransformer

    return Pipeline(stages=[SQLTransformer(statement=f"SELECT *, CAST(NULL AS {kind}) AS {column} FROM __THIS__")]).fit(rows)


def fit_logistic(rows: DataFrame, features: list[str], label: str):
    """Balanced logistic regression of standardised features; a fitted ``pyspark.ml`` pipeline, whose ``prediction`` is null without train rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    train = rows.filter(F.col("split") == "train")
    counts = {r[label]: r["count"] for r in train.groupBy(label).count().collect()}
    n = sum(counts.values())
    if not n:
        return _nothing(rows, "prediction", "DOUBLE")
    weight = F.coalesce(*[F.when(F.col(label) == v, F.lit(n / (len(counts) * c))) for v, c in counts.items()])
    stages = [VectorAssembler(inputCols=features, outputCol="features"), LogisticRegression(labelCol=label, weightCol="_w", regParam=1.0 / max(n, 1), standardization=False)]
    return Pipeline(stages=stages).fit(train.withColumn("_w", weight))


def fit_pca(rows: DataFrame, features: list[str], k: int):
    """``max(2, min(k, n - 1, p))`` principal components of centred features; a fitted ``pyspark.ml`` pipeline, whose ``components`` are null below two train rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler

    train = rows.filter(F.col("split") == "train")
    n = train.count()
    if n < 2:
        return _nothing(rows, "components", "ARRAY<DOUBLE>")
    size = max(2, min(k, n - 1, len(features)))
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="_raw"), StandardScaler(withMean=True, withStd=False, inputCol="_raw", outputCol="_centred"), PCA(k=size, inputCol="_centred", outputCol="components")]).fit(train)


def leave_one_out(wide: DataFrame, columns: list[str]) -> DataFrame:
    """Per task the other tasks as features: ``study_id, split, task_col, y, features`` for studies that have the task."""
    rows = [F.struct(F.lit(c).alias("task_col"), F.col(c).cast("double").alias("y"), F.array(*[F.col(o).cast("double") for o in columns if o != c]).alias("features")) for c in columns]
    return wide.select("study_id", "split", F.explode(F.array(*rows)).alias("_t")).select("study_id", "split", "_t.*").filter(F.col("y").isNotNull())


def masked_moments(rows: DataFrame, x: list[str], y: list[str]) -> DataFrame:
    """``target, n, mean, gram`` of each of ``y`` over the rows that have it: means of ``x`` and the target, and their centred products.

    One pass over the rows, which are not copied for each target: a task of
    Spark adds up all targets at once and passes on one row for each.  These
    meet in two steps, so that no group grows with the number of tasks.
    """
    p = len(x)
    schema = "target int, n long, mean array<double>, gram array<double>, bucket int"

    def merge(a, b):
        n = a[0] + b[0]
        step = b[1] - a[1]
        return n, a[1] + step * (b[0] / n), a[2] + b[2] + np.outer(step, step) * (a[0] * b[0] / n)

    def frame(sums: dict, bucket: int) -> pd.DataFrame:
        return pd.DataFrame([(t, n, mean, gram.ravel(), bucket) for t, (n, mean, gram) in sums.items()], columns=["target", "n", "mean", "gram", "bucket"])

    def add_up(batches):
        from pyspark import TaskContext

        sums: dict = {}
        for pdf in batches:
            values, targets = pdf[x].to_numpy(float), pdf[y].to_numpy(float)
            for t in range(len(y)):
                has = ~np.isnan(targets[:, t])
                if has.any():
                    z = np.column_stack([values[has], targets[has, t]])
                    mean = z.mean(axis=0)
                    new = (len(z), mean, (z - mean).T @ (z - mean))
                    sums[t] = merge(sums[t], new) if t in sums else new
        yield frame(sums, TaskContext.get().partitionId() % 64)

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [(n, np.asarray(mean), np.asarray(gram).reshape(p + 1, p + 1)) for n, mean, gram in zip(pdf["n"], pdf["mean"], pdf["gram"], strict=True)]
        return frame({pdf["target"].iloc[0]: reduce(merge, parts)}, 0)

    added = rows.select(*[F.col(c).cast("double").alias(c) for c in (*x, *y)]).mapInPandas(add_up, schema)
    met = added.groupBy("target", "bucket").applyInPandas(meet, schema).groupBy("target").applyInPandas(meet, schema)
    return met.drop("bucket")


def leave_one_out_ridge(wide: DataFrame, tasks: list[str], alpha: float = 1.0) -> DataFrame:
    """:func:`ridge_for_tasks` of every task from all others."""
    return ridge_for_tasks(wide, tasks, tasks, alpha)


def ridge_for_tasks(wide: DataFrame, tasks: list[str], inputs: list[str], alpha: float = 1.0) -> DataFrame:
    """``task_col, study_id, split, y, pred``: every task predicted from ``inputs`` by a ridge model of the train studies that have it.

    ``wide`` has ``study_id, split`` and a column for each task and input.
    Missing inputs get the train median of their column; each model standardises
    by its own rows.  The inputs of a task are all but its own column, a
    sub-block of its moments.  A task of fewer than two train values, or
    without inputs, has no prediction (null).  An empty table gives no rows.
    """
    p = len(tasks)
    shape = "task_col string, study_id long, split string, y double, pred double"
    y = [f"_y{i}" for i in range(p)]
    targets = wide.withColumns({b: F.col(a).cast("double") for a, b in zip(tasks, y, strict=True)})
    scaled = impute_and_scale(targets, inputs) if p and inputs else targets
    x = [c for c in inputs if c in scaled.columns]
    full = stored(scaled.select("study_id", "split", *x, *y), "features")
    weights, bias = np.zeros((p, len(x))), np.full(p, np.nan)
    for r in masked_moments(full.filter("split = 'train'"), x, y).collect() if x else []:  # a row for each task, of a number for each pair of columns
        t, mean, gram = r["target"], np.array(r["mean"]), np.array(r["gram"]).reshape(len(x) + 1, -1)
        others = np.array([i for i, c in enumerate(x) if c != tasks[t]], int)
        if r["n"] < 2 or not len(others):
            continue
        sd = np.sqrt(np.maximum(np.diag(gram)[others], 0) / r["n"])
        sd = np.where(sd > 1e-12, sd, 1)
        block = gram[np.ix_(others, others)] / np.outer(sd, sd)
        weights[t, others] = np.linalg.solve(block + alpha * np.eye(len(others)), gram[others, -1] / sd) / sd
        bias[t] = mean[-1] - weights[t] @ mean[:-1]
    names = np.array(tasks, object)

    def predict(batches):
        for pdf in batches:
            known = pdf[y].to_numpy(float)
            pred = pdf[x].to_numpy(float) @ weights.T + bias
            row, task = np.nonzero(~np.isnan(known))
            yield pd.DataFrame({"task_col": names[task], "study_id": pdf["study_id"].to_numpy()[row], "split": pdf["split"].to_numpy(object)[row], "y": known[row, task], "pred": pred[row, task]})

    return full.mapInPandas(predict, shape)


def concat_modalities(a: DataFrame, b: DataFrame, key: str = "study_id") -> DataFrame:
    """Studies of both tables with their feature arrays joined end to end; an error where ``b`` has a study twice."""
    require_unique(b, key)
    return a.join(b.select(key, F.col("features").alias("_more")), key).withColumn("features", F.concat("features", "_more")).drop("_more")
