"""Harmonised measurements, their registry, and target panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions import text
from tessella.operators.checks import join_many_to_one, require_columns, with_column_if_absent
from tessella.operators.quantiles import attach, exact_quantiles
from tessella.sources.scratch import stored


def harmonised_names(m: DataFrame, manual: dict[str, str] | None = None) -> DataFrame:
    """``_name`` (each raw name, description and unit once) with clean and canonical name, unit, category and ``_factor``.

    It is written, and so a table of known size: a small one is broadcast, and
    what it is joined to is not dealt out by few hot names.
    """
    names = m.select(F.struct("measurement", "measurement_description", "unit").alias("_name")).distinct()
    names = names.withColumns({
        "measurement_clean": text.norm_text(F.col("_name.measurement")), "description_clean": text.norm_text(F.col("_name.measurement_description")), "unit_norm": text.norm_unit(F.col("_name.unit")),
    })
    named, unit = text.canonical_name(F.col("measurement_clean"), F.col("description_clean"), manual), F.col("unit_norm")
    names = names.withColumn("_c", named).withColumns({
        "canonical_measurement": F.col("_c.canonical"), "canonical_source": F.col("_c.source"), "unit_category": text.unit_category(unit), "canonical_value_unit": text.canonical_unit(unit), "_factor": text.unit_factor(unit),
    }).drop("_c")
    return stored(names, "names")


def harmonise(m: DataFrame, manual: dict[str, str] | None = None) -> DataFrame:
    """Long measurements with clean and canonical name, unit, category, numeric and converted value.

    Names and units repeat in nearly every row, so the rules are applied to the
    distinct ones, which are joined back.  ``m`` is read twice and should be a
    stored table.
    """
    require_columns(m, "subject_id", "study_id", "measurement", "result")
    m = with_column_if_absent(with_column_if_absent(m, "unit", F.lit(None).cast("string")), "measurement_description", F.lit(None).cast("string"))
    # a struct with nulls in its fields is equal to itself
    out = m.withColumn("_name", F.struct("measurement", "measurement_description", "unit")).join(harmonised_names(m, manual), "_name")
    number = text.try_double(F.col("result"))
    return out.withColumns({"result_numeric": number, "result_canonical": number * F.col("_factor")}).drop("_name", "_factor")


def top_counts(df: DataFrame, keys: list[str], column: str, limit: int, name: str) -> DataFrame:
    """The most frequent values of each group as ``value:n;value:n``; null is ``unknown``, ties go to the smaller value."""
    value = F.coalesce(F.col(column), F.lit("unknown"))
    counts = df.groupBy(*keys, value.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    ranked = counts.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_n"), "_v"))).filter(F.col("_rn") <= limit)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rn", "_v", "_n"))), lambda s: F.concat_ws(":", s["_v"], s["_n"].cast("string"))), ";")
    return ranked.groupBy(*keys).agg(joined.alias(name))


def _known(column: str) -> Column:
    """Sorted distinct values but ``unknown``."""
    return F.array_sort(F.collect_set(F.when(F.col(column) != "unknown", F.col(column))))


def _distinct(h: DataFrame, key: str, column: str, name: str, with_result: str) -> DataFrame:
    """Distinct values of ``column`` by ``key``, of all rows and of those with a number; each pair is counted once before the key's rows meet."""
    pairs = h.groupBy(key, column).agg(F.max(F.col("result_numeric").isNotNull().cast("int")).alias("_has"))
    own = F.col(column).isNotNull()
    return pairs.groupBy(key).agg(F.count(column).alias(name), F.count_if(own & (F.col("_has") == 1)).alias(with_result))


def raw_profile(h: DataFrame) -> DataFrame:
    """One row per raw name (null a group too): rows, numeric rows and rate, studies and subjects, unit categories."""
    h = stored(h.select("measurement", "study_id", "subject_id", "result_numeric", "unit_category"), "measurements")
    categories = F.array_join(_known("unit_category"), ",")
    base = h.groupBy("measurement").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("result_numeric").alias("n_result_rows"), F.round(F.count("result_numeric") / F.count(F.lit(1)), 4).alias("result_rate"),
        F.when(categories == "", "unknown").otherwise(categories).alias("unit_categories"),
    )
    for c, what in (("study_id", "studies"), ("subject_id", "subjects")):
        base = attach(base, _distinct(h, "measurement", c, f"n_{what}_any", f"n_{what}_with_result"), ["measurement"])
    return base


def preferred_units(h: DataFrame, key: str = "canonical_measurement", unit: str = "canonical_value_unit") -> DataFrame:
    """The most frequent known unit of each name, ``unknown`` only where there is no other."""
    counts = h.filter(F.col("result_numeric").isNotNull()).groupBy(key, unit).agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(key).orderBy((F.col(unit) == "unknown").cast("int"), F.desc("_n"), unit)
    found = counts.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").select(key, F.col(unit).alias("preferred_unit"))
    return stored(found, "units")  # a row for each name, of known size


def canonical_profile(h: DataFrame, n_reference: int) -> DataFrame:
    """One row per canonical name: counts, coverage of ``n_reference`` studies, units, and percentiles in the preferred unit."""
    h = stored(h.select("measurement", "canonical_measurement", "study_id", "subject_id", "result_numeric", "result_canonical", "unit_category", "unit_norm", "canonical_value_unit"), "measurements")
    base = h.groupBy("canonical_measurement").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("result_numeric").alias("n_result_rows"), F.round(F.count("result_numeric") / F.count(F.lit(1)), 4).alias("result_rate"),
        F.size(F.collect_set(F.when(F.col("unit_category") != "unknown", F.col("unit_category")))).alias("n_unit_categories"),
    )
    for c, a, b in (("study_id", "n_studies_any", "n_studies_with_result"), ("subject_id", "_any", "n_subjects_with_result"), ("measurement", "n_original_measurements", "_with")):
        base = base.join(_distinct(h, "canonical_measurement", c, a, b), "canonical_measurement").drop("_any", "_with")
    base = base.withColumn("study_coverage_with_result", F.round(F.col("n_studies_with_result") / F.lit(max(n_reference, 1)), 4))
    preferred = preferred_units(h)
    same = h.join(preferred, "canonical_measurement").filter((F.col("preferred_unit") == "unknown") | (F.col("canonical_value_unit") == F.col("preferred_unit")))
    q = attach(preferred, exact_quantiles(same, ["canonical_measurement"], "result_canonical", [0.05, 0.5, 0.95]), ["canonical_measurement"])
    q = q.select("canonical_measurement", "preferred_unit", *[F.round(F.col("q")[i], 4).alias(f"{n}_canonical") for i, n in enumerate(("p05", "p50", "p95"))])
    units = top_counts(h, ["canonical_measurement"], "unit_norm", 10, "unit_norm_top10")
    return base.join(q, "canonical_measurement", "left").join(units, "canonical_measurement").withColumn("preferred_unit", F.coalesce("preferred_unit", F.lit("unknown")))


def select_tasks(profile: DataFrame, min_studies: int, min_rows: int, min_rate: float, max_categories: int, exclude: str = "") -> DataFrame:
    """The profile with the reasons against each name, and whether it is selected."""
    reasons = [
        F.when(F.col("n_studies_with_result") < min_studies, "low_study_count"), F.when(F.col("n_result_rows") < min_rows, "low_result_rows"), F.when(F.col("result_rate") < min_rate, "low_result_rate"),
        F.when(F.col("n_unit_categories") > max_categories, "mixed_unit_categories"), F.when(F.col("canonical_measurement").rlike(exclude), "excluded_by_regex") if exclude else F.lit(None).cast("string"),
    ]
    out = profile.withColumn("exclude_reasons", F.concat_ws(",", *reasons))
    return out.withColumn("selected_for_multitask", F.col("exclude_reasons") == "")


def mapping(h: DataFrame) -> DataFrame:
    return h.select("measurement", "measurement_clean", "description_clean", "canonical_measurement", "canonical_source", "unit", "unit_norm", "unit_category").distinct()


def one_canonical(h: DataFrame) -> DataFrame:
    """The lexically smallest canonical name of each raw name."""
    return h.groupBy("measurement").agg(F.min("canonical_measurement").alias("canonical_measurement"))


def map_names(m: DataFrame, names: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """Measurements with the canonical name that a mapping (each raw name once) gives; empty where it has none.

    With ``wanted``, only rows of these names.  A null raw name meets nothing.
    """
    out = join_many_to_one(m, names, "measurement", how="left").withColumn("canonical_measurement", F.coalesce("canonical_measurement", F.lit("")))
    return out.filter(F.col("canonical_measurement").isin(wanted)) if wanted is not None else out


def with_subjects(rows: DataFrame, studies: DataFrame) -> DataFrame:
    """Rows with the subject of their study; null where the study is not listed, an error where one has two subjects."""
    return join_many_to_one(rows, studies.select("study_id", "subject_id").distinct(), "study_id", how="left")


def panel_long(h: DataFrame, tasks: DataFrame) -> DataFrame:
    """Median per study and task over values in the task's unit; ``tasks`` has ``canonical_measurement, preferred_unit``."""
    joined = h.join(tasks.select("canonical_measurement", "preferred_unit"), "canonical_measurement")
    value = F.when(F.col("preferred_unit") == "unknown", F.col("result_numeric")).when(F.col("canonical_value_unit") == F.col("preferred_unit"), F.col("result_canonical"))
    usable = joined.withColumn("_v", value).filter(F.col("_v").isNotNull() & F.col("study_id").isNotNull())
    # bare values take less room on the way than the states of medians
    dealt = usable.select("subject_id", "study_id", "canonical_measurement", "preferred_unit", "_v").repartition("study_id")
    return dealt.groupBy("subject_id", "study_id", "canonical_measurement", "preferred_unit").agg(F.median("_v").alias("task_value"), F.count(F.lit(1)).alias("n_rows_used")).withColumn(
        "task_col", text.column_name(F.col("canonical_measurement"))
    )


def panel_wide(panel: DataFrame, base: DataFrame, columns: list[str]) -> DataFrame:
    """One row per study of ``base`` with a column per task and the number of tasks it has."""
    wide = panel.groupBy("study_id").pivot("task_col", columns).agg(F.first("task_value"))
    out = base.join(wide, "study_id", "left")
    n = F.lit(0)
    for c in columns:
        n = n + F.col(c).isNotNull().cast("int")
    return out.withColumn("n_tasks_available", n)


def task_metadata(panel: DataFrame, tasks: DataFrame, n_studies: int) -> DataFrame:
    """Support and percentiles of every task; tasks without a value stay.  ``panel`` is read several times and should be a stored table."""
    panel = panel.withColumn("result_numeric", F.col("task_value"))
    stats = panel.groupBy("canonical_measurement").agg(F.sum("n_rows_used").alias("n_rows_with_value"))
    for c, name in (("study_id", "n_studies_with_value"), ("subject_id", "n_subjects_with_value")):
        stats = stats.join(_distinct(panel, "canonical_measurement", c, "_any", name), "canonical_measurement").drop("_any")
    stats = stats.join(exact_quantiles(panel, ["canonical_measurement"], "task_value", [0.05, 0.5, 0.95], "_q"), "canonical_measurement")
    out = tasks.select("canonical_measurement", "preferred_unit").join(stats, "canonical_measurement", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_studies_with_value", "n_subjects_with_value", "n_rows_with_value")}
    coverage = F.col("n_studies_with_value") / F.lit(max(n_studies, 1))
    return out.withColumns(zero).select("*", coverage.alias("study_coverage_with_value"), (1 - coverage).alias("missing_rate"), *[F.col("_q")[i].alias(n) for i, n in enumerate(("p05", "p50", "p95"))]).drop("_q")


def supported(metadata: DataFrame, min_studies: int, min_subjects: int) -> DataFrame:
    return metadata.withColumn("supported", (F.col("n_studies_with_value") >= min_studies) & (F.col("n_subjects_with_value") >= min_subjects))


def unpivot(wide: DataFrame, key: str, columns: list[str], prefix: str = "") -> DataFrame:
    """``key, task_col, y`` of the values that a wide table has; ``prefix`` is cut from the names."""
    long = wide.unpivot(key, columns, "task_col", "y").filter(F.col("y").isNotNull())
    return long.withColumn("task_col", F.substr("task_col", F.lit(len(prefix) + 1)))
