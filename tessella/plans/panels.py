"""Queries of measurement harmonisation, the registry, panels and features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions import text
from tessella.operators import features, measurements, sketches
from tessella.plans.registry import query
from tessella.sources.scratch import stored
from tessella.sources.views import cte, table, view


def _text(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce({c}, ''))), '[_/]+', ' ', 'g'), '[^a-z0-9%+\\]', ' ', 'g'), '\\s+', ' ', 'g'))"


def _unit() -> str:
    t = r"trim(regexp_replace(regexp_replace(translate(lower(trim(unit)), 'μµ', 'uu'), '[^a-z0-9/%^.\s]', ' ', 'g'), '\s+', ' ', 'g'))"
    for a, b in text.UNIT_REWRITES:
        t = f"replace({t}, '{a}', '{b}')"
    return t


_PAIRS = ", ".join(f"('{s}', '{u}')" for s, u in text.UNIT_SPELLINGS.items())
_UNITS = ", ".join(f"('{u}', '{c}', '{k}', {f})" for u, (c, k, f) in text.UNITS.items())
_RULES = "\n".join("WHEN regexp_matches(hay, '{}') THEN '{}'".format(p.replace("'", "''"), c) for p, c in text.CANONICAL_RULES)
_NUMBER = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"
_HARMONISED = (
    cte("measurements")
    + f""", spelling(s, u) AS (VALUES {_PAIRS}), units(u, category, canonical, factor) AS (VALUES {_UNITS}),
c0 AS (SELECT *, {_text("measurement")} AS measurement_clean, {_text("measurement_description")} AS description_clean, {_unit()} AS ut, CASE WHEN regexp_matches(result, {_NUMBER}) THEN CAST(trim(result) AS DOUBLE) END AS result_numeric FROM measurements),
c1 AS (SELECT c0.*, trim(concat(measurement_clean, ' ', description_clean)) AS hay, regexp_replace(regexp_replace(replace(measurement_clean, ' ', '_'), '_+', '_', 'g'), '^_|_$', '', 'g') AS fb,
  CASE WHEN coalesce(ut, '') = '' THEN 'unknown' ELSE coalesce(spelling.u, CASE WHEN contains(ut, '%') THEN '%' END, ut) END AS unit_norm FROM c0 LEFT JOIN spelling ON ut = s),
c2 AS (SELECT *, CASE {_RULES} WHEN fb = '' THEN 'unknown_measurement' ELSE fb END AS canonical_measurement, CASE {_RULES.replace("THEN '", "THEN 'auto_rule' --")}
  ELSE 'fallback' END AS canonical_source FROM c1),
h AS (SELECT c2.*, coalesce(category, 'unknown') AS unit_category, coalesce(canonical, 'unknown') AS canonical_value_unit, result_numeric * coalesce(factor, 1.0) AS result_canonical FROM c2 LEFT JOIN units ON unit_norm = units.u)"""
)
_PROFILE = (
    _HARMONISED
    + """, pu AS (SELECT canonical_measurement, canonical_value_unit AS preferred_unit, row_number() OVER (PARTITION BY canonical_measurement ORDER BY CAST(canonical_value_unit = 'unknown' AS INT), count(*) DESC, canonical_value_unit) AS rn
  FROM h WHERE result_numeric IS NOT NULL GROUP BY 1, 2), pref AS (SELECT canonical_measurement, preferred_unit FROM pu WHERE rn = 1),
q AS (SELECT canonical_measurement, preferred_unit, round(quantile_cont(CAST(result_canonical AS DOUBLE), 0.05), 4) AS p05_canonical, round(quantile_cont(CAST(result_canonical AS DOUBLE), 0.5), 4) AS p50_canonical, round(quantile_cont(CAST(result_canonical AS DOUBLE), 0.95), 4) AS p95_canonical
  FROM h JOIN pref USING (canonical_measurement) WHERE preferred_unit = 'unknown' OR canonical_value_unit = preferred_unit GROUP BY 1, 2),
uc AS (SELECT canonical_measurement, unit_norm, count(*) AS n, row_number() OVER (PARTITION BY canonical_measurement ORDER BY count(*) DESC, unit_norm) AS rn FROM h GROUP BY 1, 2),
ut10 AS (SELECT canonical_measurement, string_agg(concat(unit_norm, ':', CAST(n AS STRING)), ';' ORDER BY rn) AS unit_norm_top10 FROM uc WHERE rn <= 10 GROUP BY 1),
b AS (SELECT canonical_measurement, count(*) AS n_rows, count(result_numeric) AS n_result_rows, round(count(result_numeric) / count(*), 4) AS result_rate, count(DISTINCT study_id) AS n_studies_any,
  count(DISTINCT study_id) FILTER (WHERE result_numeric IS NOT NULL) AS n_studies_with_result, count(DISTINCT subject_id) FILTER (WHERE result_numeric IS NOT NULL) AS n_subjects_with_result, count(DISTINCT measurement) AS n_original_measurements,
  count(DISTINCT unit_category) FILTER (WHERE unit_category <> 'unknown') AS n_unit_categories FROM h GROUP BY 1),
p AS (SELECT b.*, round(n_studies_with_result / (SELECT greatest(count(DISTINCT study_id), 1) FROM measurements), 4) AS study_coverage_with_result, coalesce(preferred_unit, 'unknown') AS preferred_unit, p05_canonical, p50_canonical, p95_canonical, unit_norm_top10
  FROM b LEFT JOIN q USING (canonical_measurement) JOIN ut10 USING (canonical_measurement)),
s AS (SELECT *, concat_ws(',', CASE WHEN n_studies_with_result < 2000 THEN 'low_study_count' END, CASE WHEN n_result_rows < 3000 THEN 'low_result_rows' END, CASE WHEN result_rate < 0.75 THEN 'low_result_rate' END,
  CASE WHEN n_unit_categories > 4 THEN 'mixed_unit_categories' END, CASE WHEN regexp_matches(canonical_measurement, '^left_ventricular_ejection_fraction$') THEN 'excluded_by_regex' END) AS exclude_reasons FROM p)"""
)
_PANEL = (
    _PROFILE
    + """, v AS (SELECT h.subject_id, h.study_id, h.canonical_measurement, pref.preferred_unit, CASE WHEN preferred_unit = 'unknown' THEN result_numeric WHEN canonical_value_unit = preferred_unit THEN result_canonical END AS val FROM h JOIN pref USING (canonical_measurement)),
panel AS (SELECT subject_id, study_id, canonical_measurement, preferred_unit, median(CAST(val AS DOUBLE)) AS task_value, count(*) AS n_rows_used,
  concat('task__', regexp_replace(regexp_replace(regexp_replace(canonical_measurement, '[^a-zA-Z0-9_]+', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g')) AS task_col FROM v WHERE val IS NOT NULL GROUP BY 1, 2, 3, 4)"""
)
#: Studies and subjects with a value that a task of the wide panel needs, and the tasks that the test tables have (for SQL, which has to name its columns).
_STUDIES, _SUBJECTS = 50, 50
_TASKS = [
    f"task__{t}" for t in (
        "aortic_root_diameter", "aortic_valve_mean_gradient", "global_longitudinal_strain", "heart_rate", "left_atrial_volume", "left_atrial_volume_index", "left_ventricular_ejection_fraction",
        "left_ventricular_mass", "mitral_e_velocity", "tricuspid_annular_plane_systolic_excursion", "unknown_measurement",
    )
]


#: Columns of measurements that harmonised names and values need.
_NAMED = ["measurement", "measurement_description", "unit"]
_VALUED = ["subject_id", "study_id", *_NAMED, "result"]


def _measured(spark, sf_dir, *columns: str) -> DataFrame:
    """Columns of the measurements, joined once for all that read them."""
    return stored(view(spark, sf_dir, "measurements").select(*(columns or _VALUED)), "measured")


def _h(spark, sf_dir, *more: str):
    return measurements.harmonise(_measured(spark, sf_dir, *_VALUED, *more))


def _n_studies(m: DataFrame) -> int:
    """The studies of the table, with or without a usable value."""
    return m.agg(F.countDistinct("study_id")).first()[0]


def _profile(spark, sf_dir):
    m = _measured(spark, sf_dir)
    return measurements.canonical_profile(measurements.harmonise(m), m.select("study_id").distinct().count())


def _panel(spark, sf_dir):
    h = _h(spark, sf_dir)
    return measurements.panel_long(h, measurements.preferred_units(h))


def wide(spark, sf_dir):
    """The wide panel of all studies and supported tasks, and their columns in order."""
    m = _measured(spark, sf_dir)
    h = measurements.harmonise(m)
    units = measurements.preferred_units(h)
    panel = stored(measurements.panel_long(h, units), "panel")
    found = measurements.supported(measurements.task_metadata(panel, units, _n_studies(m)), _STUDIES, _SUBJECTS).filter("supported")
    tasks = sorted({r["c"] for r in found.select(text.column_name(F.col("canonical_measurement")).alias("c")).collect()})  # columns of one table
    return measurements.panel_wide(panel, m.select("study_id").distinct(), tasks), tasks


@query(_HARMONISED + " SELECT DISTINCT measurement, measurement_clean, description_clean, canonical_measurement, canonical_source, unit, unit_norm, unit_category FROM h")
def registry_mapping_distinct(spark, sf_dir):
    return measurements.mapping(_h(spark, sf_dir))


@query(
    _HARMONISED
    + """ SELECT measurement, count(*) AS n_rows, count(result_numeric) AS n_result_rows, round(count(result_numeric) / count(*), 4) AS result_rate, count(DISTINCT study_id) AS n_studies_any, count(DISTINCT study_id) FILTER (WHERE result_numeric IS NOT NULL) AS n_studies_with_result,
count(DISTINCT subject_id) AS n_subjects_any, count(DISTINCT subject_id) FILTER (WHERE result_numeric IS NOT NULL) AS n_subjects_with_result, coalesce(string_agg(DISTINCT unit_category, ',' ORDER BY unit_category) FILTER (WHERE unit_category <> 'unknown'), 'unknown') AS unit_categories FROM h GROUP BY 1"""
)
def registry_raw_profile(spark, sf_dir):
    return measurements.raw_profile(_h(spark, sf_dir))


@query(_PROFILE + " SELECT * FROM p")
def registry_canonical_profile(spark, sf_dir):
    return _profile(spark, sf_dir)


@query(_PROFILE + " SELECT canonical_measurement, exclude_reasons, exclude_reasons = '' AS selected_for_multitask FROM s")
def registry_select_reasons(spark, sf_dir):
    chosen = measurements.select_tasks(_profile(spark, sf_dir), 2000, 3000, 0.75, 4, "^left_ventricular_ejection_fraction$")
    return chosen.select("canonical_measurement", "exclude_reasons", "selected_for_multitask")


@query(_PANEL + " SELECT subject_id, study_id, canonical_measurement, task_col, preferred_unit, round(task_value, 6) AS task_value, n_rows_used FROM panel")
def panel_long(spark, sf_dir):
    return _panel(spark, sf_dir).select("subject_id", "study_id", "canonical_measurement", "task_col", "preferred_unit", F.round("task_value", 6).alias("task_value"), "n_rows_used")


@query(
    _PANEL
    + f", sup AS (SELECT canonical_measurement FROM panel GROUP BY 1 HAVING count(DISTINCT study_id) >= {_STUDIES} AND count(DISTINCT subject_id) >= {_SUBJECTS}), w AS (SELECT study_id, count(*) AS n, "
    + ", ".join(f"round(max(task_value) FILTER (WHERE task_col = '{t}'), 6) AS {t}" for t in _TASKS)
    + " FROM panel JOIN sup USING (canonical_measurement) GROUP BY 1) SELECT b.study_id, "
    + ", ".join(_TASKS)
    + ", CAST(coalesce(n, 0) AS INT) AS n_tasks_available FROM (SELECT DISTINCT study_id FROM measurements) b LEFT JOIN w USING (study_id)"
)
def panel_wide(spark, sf_dir):
    found, tasks = wide(spark, sf_dir)
    return found.withColumns({t: F.round(t, 6) for t in tasks})


@query(
    _PANEL
    + """, t AS (SELECT canonical_measurement, preferred_unit FROM pref UNION ALL SELECT 'no_such_task', 'mm'), st AS (SELECT canonical_measurement, count(DISTINCT study_id) AS ns, count(DISTINCT subject_id) AS nj, CAST(sum(n_rows_used) AS BIGINT) AS nr, quantile_cont(task_value, 0.05) AS p05, quantile_cont(task_value, 0.5) AS p50, quantile_cont(task_value, 0.95) AS p95 FROM panel GROUP BY 1)
SELECT canonical_measurement, preferred_unit, coalesce(ns, 0) AS n_studies_with_value, coalesce(nj, 0) AS n_subjects_with_value, coalesce(nr, 0) AS n_rows_with_value, round(coalesce(ns, 0) / (SELECT count(DISTINCT study_id) FROM measurements), 6) AS study_coverage_with_value, round(1 - coalesce(ns, 0) / (SELECT count(DISTINCT study_id) FROM measurements), 6) AS missing_rate, round(p05, 6) AS p05, round(p50, 6) AS p50, round(p95, 6) AS p95,
coalesce(ns, 0) >= 2000 AND coalesce(nj, 0) >= 500 AS supported FROM t LEFT JOIN st USING (canonical_measurement)"""
)
def panel_task_metadata(spark, sf_dir):
    m = _measured(spark, sf_dir)
    h = measurements.harmonise(m)
    tasks = measurements.preferred_units(h)
    more = tasks.unionByName(spark.createDataFrame([("no_such_task", "mm")], "canonical_measurement string, preferred_unit string"))
    out = measurements.supported(measurements.task_metadata(stored(measurements.panel_long(h, tasks), "panel"), more, _n_studies(m)), 2000, 500)
    return out.withColumns({c: F.round(c, 6) for c in ("study_coverage_with_value", "missing_rate", "p05", "p50", "p95")})


@query(_HARMONISED + " SELECT canonical_measurement, count(*) AS n_rows, true AS studies_within, true AS subjects_within, CASE WHEN count(result_numeric) > 0 THEN true END AS p05_within, CASE WHEN count(result_numeric) > 0 THEN true END AS p50_within, CASE WHEN count(result_numeric) > 0 THEN true END AS p95_within FROM h GROUP BY 1")
def sketch_profile_error(spark, sf_dir):
    """Sketches kept by test type and merged: whether counts and percentiles are within the stated errors of the exact ones."""
    key = ["canonical_measurement"]
    h = stored(_h(spark, sf_dir, "test_type").select(*key, "test_type", "study_id", "subject_id", "result_numeric"), "measurements")
    kept = stored(sketches.sketch_parts(h, key, "test_type", ["study_id", "subject_id"], ["result_numeric"]), "sketches")
    merged = sketches.merge_parts(kept, key)
    ids = {"studies_within": "study_id", "subjects_within": "subject_id"}
    ps = {"p05": 0.05, "p50": 0.5, "p95": 0.95}
    found = stored(merged.select(*key, "n_rows", *[sketches.distinct_estimate(c).alias(c) for c in ids.values()], *[sketches.quantile_estimate("result_numeric", p).alias(n) for n, p in ps.items()]), "estimates")
    out = found.select(*key, "n_rows")
    for name, c in ids.items():
        exact = h.filter(F.col(c).isNotNull()).groupBy(*key, c).agg(F.lit(1).alias("_one")).groupBy(*key).agg(F.count(F.lit(1)).alias("_exact"))
        near = F.abs(F.col(c) - F.col("_exact")) <= F.ceil(sketches.COUNT_ERROR * F.col("_exact"))
        out = out.join(found.join(exact, key).select(*key, near.alias(name)), key, "left")
    for n, p in ps.items():
        out = out.join(sketches.rank_within(h, key, "result_numeric", found, n, p, f"{n}_within"), key, "left")
    return out


@query(_HARMONISED + " SELECT measurement, min(canonical_measurement) AS canonical_measurement FROM h GROUP BY 1")
def panel_mapping_dedupe(spark, sf_dir):
    return measurements.one_canonical(_h(spark, sf_dir))


@query(_HARMONISED + """, o AS (SELECT measurement, min(canonical_measurement) AS c FROM h WHERE measurement <> 'lvef' GROUP BY 1)
SELECT coalesce(o.c, '') AS canonical_measurement, count(*) AS n_rows FROM measurements m LEFT JOIN o ON m.measurement = o.measurement WHERE coalesce(o.c, '') IN ('', 'heart_rate', 'left_ventricular_mass') GROUP BY 1""")
def panel_mapping_join(spark, sf_dir):
    """Rows by the canonical name of a mapping that lacks one raw name, of three wanted names."""
    m = _measured(spark, sf_dir, *_NAMED)
    known = measurements.harmonised_names(m).select("_name.measurement", "canonical_measurement")
    names = stored(measurements.one_canonical(known).filter("measurement <> 'lvef'"), "canonical")  # a row for each raw name
    out = measurements.map_names(m, names, ["", "heart_rate", "left_ventricular_mass"])
    return out.groupBy("canonical_measurement").agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT vec_id AS study_id, o_custkey AS subject_id FROM embeddings LEFT JOIN orders ON o_orderkey = vec_id")
def study_subject_lookup(spark, sf_dir):
    """Studies with their subjects, those that are not listed too."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("study_id"))
    return measurements.with_subjects(rows, table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("study_id"), F.col("o_custkey").alias("subject_id")))


_LEAK = "(" + "|".join(text.LEAKAGE_PATTERNS).replace("'", "''") + ")"


@query(
    _HARMONISED
    + f""", f AS (SELECT measurement_clean AS feature, count(DISTINCT study_id) AS n_studies FROM h WHERE result_numeric IS NOT NULL GROUP BY 1)
SELECT feature, n_studies, round(n_studies / (SELECT count(DISTINCT study_id) FROM measurements), 6) AS coverage, regexp_matches(lower(trim(feature)), '{_LEAK}') AS leakage, NOT regexp_matches(lower(trim(feature)), '{_LEAK}') AND n_studies / (SELECT count(DISTINCT study_id) FROM measurements) >= 0.25 AS kept FROM f"""
)
def feature_coverage(spark, sf_dir):
    m = _measured(spark, sf_dir)
    long = measurements.harmonise(m).select("study_id", F.col("measurement_clean").alias("feature"), F.col("result_numeric").alias("value"))
    return features.coverage(long, "feature", _n_studies(m), 0.25).withColumn("coverage", F.round("coverage", 6))


@query(_HARMONISED + ", f AS (SELECT DISTINCT study_id, measurement_clean FROM h WHERE result_numeric IS NOT NULL) SELECT count(DISTINCT measurement_clean) AS n_features, count(*) AS n_cells, round(1 - count(*) / (count(DISTINCT measurement_clean) * (SELECT count(DISTINCT study_id) FROM measurements)), 6) AS missing_rate FROM f")
def feature_missing_rate(spark, sf_dir):
    m = _measured(spark, sf_dir)
    long = measurements.harmonise(m).select("study_id", F.col("measurement_clean").alias("feature"), F.col("result_numeric").alias("value"))
    return features.missing_rate(long, "feature", _n_studies(m)).withColumn("missing_rate", F.round("missing_rate", 6))


@query(cte("measurements") + rf""" SELECT DISTINCT p_type AS raw, {_text("p_type")} AS v1, trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(p_type)), '[_/]+', ' ', 'g'), '[^a-z0-9%+\-\s]', ' ', 'g'), '\s+', ' ', 'g')) AS v2 FROM part
UNION SELECT DISTINCT measurement, {_text("measurement")}, trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(measurement)), '[_/]+', ' ', 'g'), '[^a-z0-9%+\-\s]', ' ', 'g'), '\s+', ' ', 'g')) FROM measurements""")
def text_normalisation(spark, sf_dir):
    from tessella.sources.views import table

    raw = table(spark, sf_dir, "part").select(F.col("p_type").alias("raw")).union(view(spark, sf_dir, "measurements").select("measurement")).distinct()
    return raw.select("raw", text.norm_text(F.col("raw")).alias("v1"), text.norm_text(F.col("raw"), keep_hyphen=True).alias("v2"))
