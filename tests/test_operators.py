"""Edge cases of expressions and operators."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.functions import arrays, numeric, text
from tessella.operators import checks, cohort, completeness, features, measurements, metrics, neighbours, reporting, splits, vectors
from tessella.sources import readers


def values(spark, expression, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", expression(F.col("v")).alias("o")).orderBy("i").collect()]


def test_numbers(spark):
    got = values(spark, text.try_double, ["55", " 55 ", "1e2", ".5", "5.", "", ">70", "n/a", "NaN", "5d", "1_000", None])
    assert got == [55.0, 55.0, 100.0, 0.5, 5.0] + [None] * 7


def test_units(spark):
    got = values(spark, text.norm_unit, ["Percent", "%", "mm Hg", "m / s", "m/sec", "cm sec", "meters per second", "square centimeter", "centimeter^2", "ml/m^2", "g/m2", "µm", "", None])
    assert got == ["%", "%", "mmhg", "m/s", "m/s", "cm/s", "meter per sec", "cm2", "centim2", "ml/m2", "g/m2", "um", "unknown", "unknown"]


def test_names(spark):
    raw = ["LV_EF", "a-b", "lv - ef", "E/e'", "", None]
    assert values(spark, text.norm_text, raw) == ["lv ef", "a b", "lv   ef", "e e", "", ""]
    assert values(spark, lambda c: text.norm_text(c, keep_hyphen=True), raw) == ["lv ef", "a-b", "lv - ef", "e e", "", ""]
    canonical = lambda c: text.canonical_name(text.norm_text(c), F.lit(""))["canonical"]
    got = values(spark, canonical, ["LVEF", "LA volume index", "LA volume", "mv e a ratio", "LV mass index", "lv mass", "own name", ""])
    assert got == [
        "left_ventricular_ejection_fraction", "left_atrial_volume_index", "left_atrial_volume", "mitral_e_velocity", "left_ventricular_mass_index", "left_ventricular_mass", "own_name", "unknown_measurement",
    ]
    manual = lambda c: text.canonical_name(text.norm_text(c), F.lit(""), {"lvef": "mine"})["source"]
    assert values(spark, manual, ["lvef", "lv mass", "x"]) == ["manual", "auto_rule", "fallback"]
    assert values(spark, text.column_name, ["a b--c", "_x_"]) == ["task__a_b_c", "task__x"]
    assert values(spark, text.is_leakage, [" LVEF", "global_ef", "simpson biplane ef", None]) == [True, False, True, False]


def test_text_helpers(spark):
    assert values(spark, text.as_boolean, ["Yes", " t ", "0", None]) == [True, True, False, False]
    assert values(spark, lambda c: text.join_url("h://x/", c), ["//a", "b"]) == ["h://x/a", "h://x/b"]
    with pytest.raises(ValueError):
        text.rewrite_prefix(F.lit("x"), "a", "")
    assert values(spark, readers.log_text, ["a,b\nc"]) == ["a;b c"]


def test_hash_split(spark):
    import hashlib

    ids = list(range(200))
    got = values(spark, lambda c: numeric.split_score("s", c), ids, "long")
    want = [int(hashlib.sha256(f"s:{i}".encode()).hexdigest()[:15], 16) / 16**15 for i in ids]
    assert got == want
    with pytest.raises(ValueError):
        numeric.split_of(F.lit(0.1), 0.9, 0.2)


@pytest.mark.parametrize(("n", "want"), [(1, (1, 0, 0)), (2, (1, 0, 1)), (3, (1, 1, 1)), (10, (7, 1, 2)), (100, (70, 15, 15))])
def test_stratified_sizes(spark, n, want):
    df = spark.range(n).select(F.col("id").alias("subject_id"), F.lit("x").alias("label"))
    got = [r["split"] for r in splits.stratified_split(df, "label", 1).collect()]
    assert tuple(got.count(s) for s in splits.SPLITS) == want


def test_shares_are_exact(spark):
    got = {r["split"]: r["count"] for r in splits.shuffle_split(spark.range(90_000).withColumnRenamed("id", "subject_id"), 5).groupBy("split").count().collect()}
    assert got == {"train": 63_000, "val": 13_500, "test": 13_500}  # 90,000 * 0.7 is 62,999.99... in binary fractions
    one = spark.range(90_000).select(F.col("id").alias("subject_id"), F.lit("x").alias("label"))
    assert splits.stratified_split(one, "label", 5).filter("split = 'train'").count() == 63_000


@pytest.fixture
def static(spark):
    """Plans as they are made, with no table known to be small but those whose size is known."""
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_checksums_are_dealt_by_path_once(static):
    from tessella.plans import registry

    static.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    # two joins of the records and the two sides of the match
    assert shuffles(registry.queries()["checksum_match"](static, "/root/testdata/sf0.001")) == 6


def test_studies_without_a_measurement_are_dealt_to_all_tasks(static):
    static.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    ids = static.range(400)
    records = ids.select(F.col("id").alias("study_id"), F.lit(1).alias("subject_id"), F.lit("f").alias("dicom_filepath"), F.lit(0).alias("acquisition_datetime"))
    studies = ids.select(F.lit(1).alias("subject_id"), F.col("id").alias("study_id"), F.when(F.col("id") < 4, F.col("id")).alias("measurement_id"), F.lit(None).cast("long").alias("note_id"))
    kinds = static.createDataFrame([(0, "TTE"), (0, "TEE"), (1, "TTE"), (1, "TTE"), (None, "TTE")], "measurement_id long, test_type string")
    got = cohort.manifest(records, studies, kinds).select("study_id", "test_type", F.spark_partition_id().alias("p")).collect()
    assert len(got) == 401 and sorted((r["study_id"], r["test_type"]) for r in got if r["test_type"]) == [(0, "TEE"), (0, "TTE"), (1, "TTE")]
    assert len({r["p"] for r in got if r["study_id"] >= 4}) == 4


def test_harmonised_rows_are_not_dealt_by_name(static, tmp_path):
    rows = [(i % 7, i, ("LVEF", "TAPSE")[i % 2], None, "50", "%") for i in range(60)]
    static.createDataFrame(rows, "subject_id long, study_id long, measurement string, measurement_description string, result string, unit string").write.parquet(f"{tmp_path}/m")
    h = measurements.harmonise(static.read.parquet(f"{tmp_path}/m"))
    assert h.count() == 60 and shuffles(h) == 0
    assert shuffles(measurements.panel_long(h, measurements.preferred_units(h))) == 1  # by study


def test_frozen_split_refuses(spark):
    df = spark.createDataFrame([(1,), (2,)], "subject_id long")
    good = [(1, " Train "), (2, "test")]
    make = lambda rows: spark.createDataFrame(rows, "subject_id long, split string")
    assert {r["split"] for r in splits.frozen_split(df, make(good)).collect()} == {"train", "test"}
    for bad in ([(1, "train"), (1, "test"), (2, "val")], [(1, "train"), (2, "holdout")]):
        with pytest.raises(ValueError):
            splits.frozen_split(df, make(bad))
    with pytest.raises(Exception, match="no split"):
        splits.frozen_split(df, make(good[:1])).collect()


@pytest.mark.parametrize("n", [1, 31, 32, 33, 100])
def test_frame_indices(spark, n):
    got = values(spark, lambda c: arrays.frame_indices(c, 32), [n], "int")[0]
    assert got == (np.linspace(0, n - 1, 32).astype(int).tolist() if n >= 32 else [min(i, n - 1) for i in range(32)])


def test_metrics_edges(spark):
    df = spark.createDataFrame([("one", 1, 0.5, 1.0, 1.0), ("one", 1, 0.6, 1.0, 2.0), ("tie", 1, 0.5, 1.0, 0.0), ("tie", 0, 0.5, 3.0, 3.0)], "k string, label int, prob double, y double, pred double")
    c = {r["k"]: r for r in metrics.classification(df, "k").collect()}
    assert c["one"]["auc"] is None and c["tie"]["auc"] == 0.5
    r = {r["k"]: r for r in metrics.regression(df, "k").collect()}
    assert r["one"]["r2"] is None and r["tie"]["r2"] == 0.5
    assert metrics.regression(df.limit(0)).first()["r2"] is None


def test_preferred_unit_and_panel(spark):
    rows = [(1, 1, "x", "5", "cm"), (1, 1, "x", "7", "cm"), (1, 2, "x", "9", "g/m2"), (1, 3, "x", "1", "g/m2"), (1, 4, "x", "2", "g/m2"), (1, 5, "x", "n/a", "cm")]
    h = measurements.harmonise(spark.createDataFrame(rows, "subject_id long, study_id long, measurement string, result string, unit string"))
    tasks = measurements.preferred_units(h)
    assert [r["preferred_unit"] for r in tasks.collect()] == ["mm"]
    assert [(r["study_id"], r["task_value"], r["n_rows_used"]) for r in measurements.panel_long(h, tasks).collect()] == [(1, 60.0, 2)]
    counts = measurements.top_counts(h, ["canonical_measurement"], "unit_norm", 2, "t").first()["t"]
    assert counts == "cm:3;g/m2:3"
    with pytest.raises(ValueError):
        measurements.harmonise(spark.range(1).toDF("study_id"))


def test_pooling_and_neighbours(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 0.0]), (2, [3.0, 4.0]), (3, None)], "study_id long, embedding array<float>")
    got = {r["study_id"]: (r["embedding"], r["n_clips"], r["embedding_l2_norm"]) for r in vectors.pool(df, "study_id").collect()}
    assert got[1][:2] == ([2.0, 1.0], 2) and got[2] == ([3.0, 4.0], 1, 5.0) and 3 not in got
    assert [r["embedding"] for r in vectors.pool(df.filter("study_id = 1"), "study_id", how="max").collect()] == [[3.0, 2.0]]
    bank = spark.createDataFrame([(i, [float(i), 1.0], i) for i in range(6)], "bank_id long, embedding array<float>, label int")
    q = bank.select(F.col("bank_id").alias("query_id"), "embedding").filter("bank_id = 5")
    assert neighbours.nearest(q, bank, 2).collect()[0]["predicted"] == 4.5
    assert neighbours.nearest(q.limit(0), bank, 2).collect() == []


def test_batches_and_checks(spark):
    df = spark.range(10, 45).withColumnRenamed("id", "study_id")
    got = {r["study_id"]: r["batch"] for r in completeness.assign_batches(df, 10, ranges=4).collect()}
    assert got == {i: (i - 10) // 10 for i in range(10, 45)}
    with pytest.raises(ValueError):
        checks.require_unique(spark.createDataFrame([(1,), (1,)], "k int"), "k")
    with pytest.raises(ValueError):
        checks.require_rows(df.limit(0))
    assert cohort.prefer(df, "absent", "x").count() == 35


def test_imputation_is_fitted_on_train_only(spark):
    rows = spark.createDataFrame([("train", 1.0, 5.0, None), ("train", 3.0, 5.0, None), ("test", None, 9.0, 1.0)], "split string, a double, b double, c double")
    out = features.impute_and_scale(rows, ["a", "b", "c"]).collect()
    assert [(r["a"], r["b"]) for r in out] == [(-1.0, 0.0), (1.0, 0.0), (0.0, 4.0)] and "c" not in out[0].asDict()


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x , y\n1,b\n")
    assert readers.read_csv(spark, str(tmp_path / "a.csv"), "x int, y string").collect()[0].asDict() == {"x": 1, "y": "b"}
    (tmp_path / "s.txt").write_text("ABC  ./a/b.dcm\n\n")
    assert [tuple(r) for r in readers.parse_checksums(readers.read_lines(spark, str(tmp_path / "s.txt"))).collect()] == [("a/b.dcm", "abc")]
    assert readers.first_existing(spark, [str(tmp_path / "no"), str(tmp_path / "a.csv")]).endswith("a.csv")
    assert readers.read_json_document(spark, str(tmp_path / "no.json"), "a int").collect() == []
    (tmp_path / "d.json").write_text(json.dumps({"a": 3}))
    assert readers.read_json_document(spark, str(tmp_path / "d.json"), "a int").collect()[0]["a"] == 3
    np.savez(tmp_path / "e.npz", embeddings=np.eye(3, dtype=np.float32))
    assert readers.read_arrays(spark, str(tmp_path)).count() == 3
    assert readers.list_files(spark, str(tmp_path), "*.npz").count() == 1


def test_small_helpers(spark, tmp_path):
    assert values(spark, lambda c: text.swap_suffix(c, ".npz"), ["a/b.dcm", "x"]) == ["a/b.npz", "x.npz"]
    assert values(spark, lambda c: text.frame_name(c, F.lit(7)), ["a/b.npz"]) == ["b_f007.png"]
    assert values(spark, lambda c: text.up_to(c, "/files/"), ["g/files/p1/files/", "none"]) == ["g/files/", None]
    assert values(spark, numeric.elapsed_seconds, ["01:02", "1:01:02", "2-00:00:01", "x", None]) == [62, 3662, 172801, None, None]
    assert values(spark, lambda c: arrays.stride(c, 2, 4), [[1.0, 2.0, 3.0]], "array<float>") == [[1.0, 3.0, 0.0, 0.0]]
    (tmp_path / "r.md").write_text("x")
    assert readers.missing_artifacts(spark, [str(tmp_path / "r.md"), str(tmp_path / "q")]) == [str(tmp_path / "q")]
    assert readers.snapshot(spark, [str(tmp_path / "r.md")], str(tmp_path / "to")).first()["length"] == 1
    with pytest.raises(FileNotFoundError):
        readers.snapshot(spark, [str(tmp_path / "q")], str(tmp_path / "to"))


def test_leave_one_out(spark):
    wide = spark.createDataFrame([(1, "train", 1.0, 2.0, None), (2, "test", None, 3.0, 4.0)], "study_id long, split string, a double, b double, c double")
    got = {(r["study_id"], r["task_col"]): (r["y"], r["features"]) for r in features.leave_one_out(wide, ["a", "b", "c"]).collect()}
    assert got == {(1, "a"): (1.0, [2.0, None]), (1, "b"): (2.0, [1.0, None]), (2, "b"): (3.0, [None, 4.0]), (2, "c"): (4.0, [None, 3.0])}
    both = features.concat_modalities(features.leave_one_out(wide, ["a", "b"]).drop("task_col"), spark.createDataFrame([(1, [9.0])], "study_id long, features array<double>"))
    assert sorted(r["features"] for r in both.collect()) == [[1.0, 9.0], [2.0, 9.0]]


def test_nearest_note(spark):
    import datetime
    import random

    rng, start = random.Random(4), datetime.datetime(2020, 1, 1)
    when = lambda: start + datetime.timedelta(hours=rng.randrange(0, 4000, 6))
    notes = [(i, rng.choice([1, 1, 1, 2, None]), rng.choice([when(), when(), when(), None])) for i in range(150)]
    studies = [(i, rng.choice([1, 1, 2, 3, None]), rng.choice([when(), when(), when(), None])) for i in range(150)]
    want = {}
    for i, subject, t in studies:
        near = [(abs(t - n), n, k) for k, s, n in notes if s == subject and n and abs(t - n) <= datetime.timedelta(3)] if t and subject else []
        gap, _, note = min(near, default=(None, None, None))
        want[i] = (note, None if gap is None else gap // datetime.timedelta(microseconds=1))
    frames = [spark.createDataFrame(rows, f"{n}_id long, subject_id long, {n}_datetime timestamp") for n, rows in (("study", studies), ("note", notes))]
    got = {r["study_id"]: (r["note_id"], r["gap_us"]) for r in cohort.nearest_note(*frames, 3).collect()}
    assert got == want


def test_nearest_note_forms_no_pairs(spark):
    times = spark.range(20_000).select(F.lit(1).alias("subject_id"), F.col("id").alias("study_id"), F.timestamp_seconds(F.col("id") % 1000).alias("study_datetime"))
    out = cohort.nearest_note(times, times.select("subject_id", F.col("study_id").alias("note_id"), F.col("study_datetime").alias("note_datetime")), 1)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "(subject_id" not in "".join(line for line in plan.splitlines() if "Join" in line)
    assert out.filter("gap_us = 0 AND note_id = study_id % 1000").count() == 20_000


def test_nearest_note_query_asks_for_all_subjects(spark, tmp_path):
    """Subjects of any id are searched, beyond those of the smallest tables too."""
    from tessella.plans import registry

    spark.sql("SELECT CAST(7 AS BIGINT) AS event_id, CAST(151 AS BIGINT) AS user_id, TIMESTAMP '2020-01-02' AS ts").write.parquet(f"{tmp_path}/events.parquet")
    spark.sql("SELECT CAST(151 AS BIGINT) AS o_custkey, CAST(5 AS BIGINT) AS o_orderkey, TIMESTAMP '2020-01-01' - INTERVAL 9500 DAY AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    assert [tuple(r) for r in registry.queries()["nearest_note_in_time"](spark, str(tmp_path)).collect()] == [(5, 7, 86_400_000_000)]


def _regression_rows(spark, n=400, p=16):
    rng = np.random.default_rng(4)
    x = rng.normal(100, 3, (n, p))  # far from zero, so that sums that are not centred would cancel
    y = x @ rng.normal(0, 1, p) + rng.normal(0, 0.1, n)
    rows = [(f"t{i % 3 % 2}", i, "train" if i % 4 else "test", float(y[i]), x[i].tolist()) for i in range(n)]
    return x, y, spark.createDataFrame(rows, "task_col string, study_id long, split string, y double, embedding array<double>").repartition(5)


def test_ridge_equals_the_closed_form(spark):
    x, y, rows = _regression_rows(spark)
    names = [f"f{i}" for i in range(x.shape[1])]
    w, b = features.ridge(rows.select("split", "y", *[F.col("embedding")[i].alias(n) for i, n in enumerate(names)]), names, "y", 2.0)
    train = np.arange(len(x)) % 4 > 0
    z, t = x[train] - x[train].mean(axis=0), y[train] - y[train].mean()
    want = np.linalg.solve(z.T @ z + 2.0 * np.eye(len(names)), z.T @ t)
    assert np.allclose(w, want, atol=1e-8) and abs(b - (y[train].mean() - x[train].mean(axis=0) @ want)) < 1e-6
    top = features.top_coefficients(names, w, spark, 5).collect()
    assert [r["feature"] for r in top] == [names[i] for i in np.argsort(-np.abs(want))[:5]] and [r["rank"] for r in top] == [1, 2, 3, 4, 5]


def test_ridge_by_task_equals_the_closed_form(spark):
    x, y, rows = _regression_rows(spark)
    got = {r["study_id"]: r["pred"] for r in features.ridge_by_task(rows, "embedding").collect()}
    task, train = np.arange(len(x)) % 3 % 2, np.arange(len(x)) % 4 > 0
    for k in (0, 1):
        fit = (task == k) & train
        mean, sd = x[fit].mean(axis=0), x[fit].std(axis=0)
        z = (x - mean) / sd
        w = np.linalg.solve(z[fit].T @ z[fit] + np.eye(x.shape[1]), z[fit].T @ (y[fit] - y[fit].mean()))
        assert np.allclose([got[i] for i in np.flatnonzero(task == k)], (z @ w + y[fit].mean())[task == k], atol=1e-6)


def test_harmonised_rows_keep_nulls_and_number(spark):
    m = spark.createDataFrame([(1, 1, None, None, "5", None), (1, 2, None, None, "6", None), (2, 3, "LVEF", None, "x", "%")], "subject_id long, study_id long, measurement string, measurement_description string, result string, unit string")
    got = sorted((r["study_id"], r["measurement_clean"], r["unit_norm"], r["result_canonical"]) for r in measurements.harmonise(m).collect())
    assert got == [(1, "", "unknown", 5.0), (2, "", "unknown", 6.0), (3, "lvef", "%", None)]


def test_checked_choices(spark, tmp_path):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    assert checks.exactly(a.orderBy("k"), 2).count() == 2
    with pytest.raises(ValueError, match="fewer than 3"):
        checks.exactly(a, 3)
    with pytest.raises(ValueError, match="not unique"):
        checks.join_one_to_one(a, a.union(a), "k")
    assert checks.join_one_to_one(a, a.withColumn("w", F.lit(1)), "k").columns == ["k", "v", "w"]
    assert checks.columns_with_prefix(a, "v") == ["v"]
    with pytest.raises(ValueError):
        checks.columns_with_prefix(a, "task__")
    a.write.parquet(f"{tmp_path}/there")
    assert [b.count() for b in vectors.read_batches(spark, [f"{tmp_path}/there", f"{tmp_path}/missing"])] == [2]
    assert values(spark, numeric.seed_of, ["abc", None]) == [int("ba7816bf", 16), None]


def test_logistic_and_pca_against_plain_numpy(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (300, 3)) @ np.array([[2.0, 0.3, 0.1], [0.0, 1.0, 0.2], [0.0, 0.0, 0.4]])
    y = (x @ [1.0, -1.0, 0.5] + rng.normal(0, 1, 300) > 0.5).astype(float)
    rows = spark.createDataFrame([(*map(float, r), float(t), "train") for r, t in zip(x, y, strict=True)], "a double, b double, c double, label double, split string")
    weights = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    model = features.fit_logistic(rows, ["a", "b", "c"], "label").stages[-1]
    w, b = np.zeros(3), 0.0
    for _ in range(40):  # Newton steps of the balanced loss with the same penalty
        z = np.column_stack([x, np.ones(300)])
        p = 1 / (1 + np.exp(-(x @ w + b)))
        ridge = np.diag([1.0, 1.0, 1.0, 0.0]) * weights.sum() / len(y)
        step = np.linalg.solve((z * (weights * p * (1 - p))[:, None]).T @ z + ridge, z.T @ (weights * (y - p)) - ridge @ np.append(w, 0))
        w, b = w + step[:3], b + step[3]
    assert np.allclose(model.coefficients.toArray(), w, atol=1e-3) and abs(model.intercept - b) < 1e-3
    _, s, v = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    pca = features.fit_pca(rows, ["a", "b", "c"], 2).stages[-1]
    assert np.allclose(pca.explainedVariance.toArray(), (s**2 / (s**2).sum())[:2]) and np.allclose(np.abs(pca.pc.toArray()), np.abs(v[:2].T), atol=1e-6)


def test_leave_one_out_ridge_equals_the_closed_form(spark):
    """Every task from the others, fitted on its own train rows; a hot split, missing cells, a constant and an empty task."""
    rng = np.random.default_rng(8)
    n, tasks = 300, ["a", "b", "c", "d", "gone"]
    z = rng.normal(size=(n, 4))
    z[:, 2] += 2 * z[:, 0]
    z[:, 3] = 5.0
    z[rng.random((n, 4)) < 0.3] = np.nan
    split = np.where(np.arange(n) % 4 == 0, "test", "train")
    rows = [(i, str(s), *[None if np.isnan(v) else float(v) for v in r], None) for i, (s, r) in enumerate(zip(split, z, strict=True))]
    wide = spark.createDataFrame(rows, "study_id long, split string, a double, b double, c double, d double, gone double").repartition(7)
    got = {(r["task_col"], r["study_id"]): (r["y"], r["pred"]) for r in features.leave_one_out_ridge(wide, tasks, 0.7).collect()}
    assert len(got) == np.isfinite(z).sum()
    train = split == "train"
    filled = np.where(np.isnan(z), np.nanmedian(z[train], axis=0), z)
    for t in range(4):
        has, others = ~np.isnan(z[:, t]), [j for j in range(4) if j != t]
        fit = has & train
        x = filled[:, others]
        # columns of the whole train part are scaled first; the model standardises again by its own rows
        mean, sd = x[fit].mean(axis=0), x[fit].std(axis=0)
        x = (x - mean) / np.where(sd > 1e-12, sd, 1)
        y = z[fit, t]
        w = np.linalg.solve(x[fit].T @ x[fit] + 0.7 * np.eye(3), x[fit].T @ (y - y.mean()))
        want = x @ w + y.mean()
        for i in np.flatnonzero(has):
            assert np.allclose(got[tasks[t], i], (z[i, t], want[i]), atol=1e-8)


def test_leave_one_out_ridge_of_little(spark):
    shape = "study_id long, split string, a double, b double"
    one = spark.createDataFrame([(1, "train", 1.0, 2.0), (2, "test", None, 3.0)], shape)
    got = [(r["task_col"], r["y"], r["pred"]) for r in features.leave_one_out_ridge(one, ["a", "b"]).collect()]
    assert sorted(got) == [("a", 1.0, None), ("b", 2.0, None), ("b", 3.0, None)]
    assert features.leave_one_out_ridge(one.limit(0), ["a", "b"]).collect() == [] == features.leave_one_out_ridge(one, []).collect()
    single = features.leave_one_out_ridge(spark.createDataFrame([(i, "train", float(i), None) for i in range(4)], shape), ["a"])
    assert [r["pred"] for r in single.collect()] == [None] * 4


def test_models_of_no_rows(spark):
    none = spark.createDataFrame([], "split string, a double, b double, label double")
    assert features.impute_and_scale(none, ["a", "b"]).columns == none.columns
    rows = spark.createDataFrame([("test", 1.0, 2.0, 1.0)], none.schema)
    for table in (none, rows):
        assert all(r["prediction"] is None for r in features.fit_logistic(table, ["a", "b"], "label").transform(table).collect())
        assert all(r["components"] is None for r in features.fit_pca(table, ["a", "b"], 2).transform(table).collect())


def test_checked_joins_and_gathers(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (3, "w")], "k long, v string")
    b = spark.createDataFrame([(1, "p", 10), (2, "q", 20)], "k long, v string, n long")
    got = {(r["k"], r["v"], r["n"]) for r in checks.join_many_to_one(a, b, "k", how="left").collect()}
    assert got == {(1, "x", 10), (1, "y", 10), (2, "z", 20), (3, "w", None)}
    with pytest.raises(ValueError):
        checks.join_many_to_one(a, b.unionByName(b), "k")
    assert checks.gather(a.filter("k < 3"), b, "k").count() == 3
    with pytest.raises(IndexError, match="3"):
        checks.gather(a, b, "k")
    twice = spark.createDataFrame([(1, [1.0]), (1, [2.0])], "study_id long, features array<double>")
    with pytest.raises(ValueError):
        features.concat_modalities(twice.limit(1), twice)


def test_mixed_directions_with_missing_values_last(spark, monkeypatch):
    from tessella.operators import quantiles

    monkeypatch.setattr(quantiles, "RANGE_ROWS", 2)
    rows = [("ok", 0.5, 1), ("ok", None, 9), ("ok", float("nan"), 2), ("ok", 0.9, 3), ("skipped", 1.0, 4), ("ok", 0.5, 7), (None, 2.0, 5)]
    df = spark.createDataFrame(rows, "status string, r2 double, n long").repartition(3)
    got = [(r["place"], r["status"], r["n"]) for r in reporting.ordered(df, "status", "-r2", "-n").orderBy("place").collect()]
    assert got == [(1, "ok", 3), (2, "ok", 7), (3, "ok", 1), (4, "ok", 9), (5, "ok", 2), (6, "skipped", 4), (7, None, 5)]
    assert reporting.ordered(df.limit(0), "-n").collect() == []


def test_reports_and_logs_cut_nothing_in_silence(spark, tmp_path):
    df = spark.range(5)
    assert reporting.to_markdown(df, ["id"], 5).count("\n") == 6
    with pytest.raises(ValueError):
        reporting.to_markdown(df, ["id"], 4)
    assert readers.export_csv(df, str(tmp_path / "all")) == (5, False) == readers.export_csv(df, str(tmp_path / "five"), 5)
    assert readers.export_csv(df.orderBy("id"), str(tmp_path / "two"), 2) == (2, True)
    assert readers.export_csv(df.limit(0), str(tmp_path / "none"), 2) == (0, False)
    for detail in ("a,b\nc", None):
        readers.append_log(spark, str(tmp_path / "log"), "probe", "ok", detail)
    log = spark.read.option("header", True).csv(str(tmp_path / "log")).collect()
    assert sorted(str(r["detail"]) for r in log) == ["None", "a;b c"] and all(r["at"] and r["status"] == "ok" for r in log)
    empty = reporting.write_summary(spark.createDataFrame([], "study_id long, write_ok boolean, status string, output_size_bytes long")).first()
    assert tuple(empty) == (0,) * 7


def test_more_text_and_arrays(spark):
    assert values(spark, text.boolean_or_error, ["Yes", " f", "0", None]) == [True, False, False, None]
    with pytest.raises(Exception, match="no boolean: maybe"):
        values(spark, text.boolean_or_error, ["maybe"])
    assert values(spark, text.listed_bytes, [" 12  gs://b/x", "x 12 gs://b", "99999999999999999999 gs://b", "", None]) == [12, None, None, None, None]
    got = values(spark, lambda c: arrays.affine_channels(c, [1.0, 2.0], [2.0, 4.0]), [[1.0, 2.0, 3.0, 6.0], []], "array<float>")
    assert got == [[0.0, 0.0, 1.0, 1.0], []]


def test_vision_and_fusion_models_equal_the_closed_form(spark):
    rng = np.random.default_rng(12)
    n = 200
    x, z = rng.normal(size=(n, 3)), rng.normal(size=(n, 2))
    z[:, 0] += x @ [1, -1, 2] + z[:, 1]
    z[rng.random((n, 2)) < 0.2] = np.nan
    rows = [(i, "test" if i % 5 == 0 else "train", *map(float, x[i]), *[None if np.isnan(v) else float(v) for v in z[i]]) for i in range(n)]
    wide = spark.createDataFrame(rows, "study_id long, split string, v0 double, v1 double, v2 double, a double, b double").repartition(4)
    train = np.arange(n) % 5 > 0
    filled = np.where(np.isnan(z), np.nanmedian(z[train], axis=0), z)
    for inputs in (["v0", "v1", "v2"], ["v0", "v1", "v2", "a", "b"]):
        got = {(r["task_col"], r["study_id"]): r["pred"] for r in features.ridge_for_tasks(wide, ["a", "b"], inputs).collect()}
        for t, name in enumerate("ab"):
            full = np.column_stack([x, filled[:, [1 - t]]]) if "a" in inputs else x
            has = ~np.isnan(z[:, t])
            fit = has & train
            s = (full - full[fit].mean(axis=0)) / full[fit].std(axis=0)
            y = z[fit, t]
            want = s @ np.linalg.solve(s[fit].T @ s[fit] + np.eye(s.shape[1]), s[fit].T @ (y - y.mean())) + y.mean()
            assert np.allclose([got[name, i] for i in np.flatnonzero(has)], want[has], atol=1e-8)


def test_unions_and_look_ups(spark):
    a, b = spark.createDataFrame([(1, 2.0)], "k long, x double"), spark.createDataFrame([(3,)], "k long")
    assert sorted(map(str, (tuple(r) for r in reporting.tagged_union({"a": a, "b": b}, "part").select("k", "x", "part").collect()))) == ["(1, 2.0, 'a')", "(3, None, 'b')"]
    assert reporting.tagged_union({}, "part", "k long").columns == ["k", "part"]
    with pytest.raises(ValueError):
        reporting.tagged_union({}, "part")
    m = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "measurement string, study_id long")
    names = spark.createDataFrame([("a", "A")], "measurement string, canonical_measurement string")
    assert sorted((r["study_id"], r["canonical_measurement"]) for r in measurements.map_names(m, names).collect()) == [(1, "A"), (2, ""), (3, "")]
    assert measurements.map_names(m, names, ["A"]).count() == 1
    studies = spark.createDataFrame([(1, 9), (1, 9), (2, 8)], "study_id long, subject_id long")
    assert sorted((r["study_id"], r["subject_id"]) for r in measurements.with_subjects(m, studies).collect()) == [(1, 9), (2, 8), (3, None)]
    with pytest.raises(ValueError):
        measurements.with_subjects(m, studies.unionByName(spark.createDataFrame([(2, 7)], studies.schema)))
