"""Cohort selection, study manifests and record linkage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions import numeric, text
from tessella.operators.quantiles import attach, exact_median, exact_quantiles
from tessella.sources.scratch import stored


def per_study(records: DataFrame) -> DataFrame:
    """Files of each study, with the first and last time."""
    return records.groupBy("subject_id", "study_id").agg(
        F.count(F.lit(1)).alias("n_dicoms"), F.min("acquisition_datetime").alias("first_acquisition_datetime"), F.max("acquisition_datetime").alias("last_acquisition_datetime")
    )


def candidates(records: DataFrame, studies: DataFrame) -> DataFrame:
    """Counted studies with what the study list knows of them."""
    return per_study(records).join(studies, ["subject_id", "study_id"], "left")


def rank_by_subject(df: DataFrame, order: list[Column], cap: int) -> DataFrame:
    """At most ``cap`` rows of each subject in the given order; 0 keeps all."""
    if cap <= 0:
        return df
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy("subject_id").orderBy(*order))).filter(F.col("_rn") <= cap).drop("_rn")


def select_cohort(
    records: DataFrame, studies: DataFrame, low: int, high: int, n: int | None, cap: int = 1, seed: int | str = 1337, need_measurement: bool = True, need_note: bool = False,
    tie: Callable[[Column, int | str], Column] = numeric.tie_key,
) -> DataFrame:
    """Studies of median size first: filter, distance to the median, stable tie-break (``tie``), cap per subject, the first ``n``."""
    base = candidates(records, studies).filter(F.col("n_dicoms").between(low, high))
    if need_measurement:
        base = base.filter(F.col("measurement_id").isNotNull())
    if need_note:
        base = base.filter(F.col("note_id").isNotNull())
    middle = exact_median(base, [], "n_dicoms", "median_n")  # one row
    scored = base.crossJoin(F.broadcast(middle)).withColumn("score", F.abs(F.col("n_dicoms") - F.col("median_n"))).withColumn("tie", tie(F.col("study_id"), seed))
    order = [F.col("score"), F.col("tie")]
    out = rank_by_subject(scored, order, cap).drop("median_n")
    return out.orderBy(*order).limit(n) if n else out


def select_by_hash(records: DataFrame, studies: DataFrame, low: int, high: int, cap: int = 1, seed: int | str = 1337, tie: Callable[[Column, int | str], Column] = numeric.tie_key) -> DataFrame:
    """All eligible studies, one (or ``cap``) of each subject by a stable order (``tie``)."""
    base = candidates(records, studies).filter(F.col("n_dicoms").between(low, high) & F.col("measurement_id").isNotNull())
    return rank_by_subject(base.withColumn("tie", tie(F.col("study_id"), seed)), [F.col("tie")], cap)


def records_of(records: DataFrame, selected: DataFrame, base_url: str) -> DataFrame:
    """The files of the selected studies with relative path and address."""
    path = text.relative_path(F.col("dicom_filepath"))
    return records.join(selected.select("subject_id", "study_id"), ["subject_id", "study_id"], "left_semi").select(
        "subject_id", "study_id", path.alias("relative_path"), F.replace(path, F.lit("files/"), F.lit("")).alias("object_path"), text.join_url(base_url, F.col("dicom_filepath")).alias("url")
    )


def filter_audit(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """Rows left after each of a chain of filters, in one pass; null counts as false."""
    kept, out = F.lit(True), [F.count(F.lit(1)).alias("initial_rows")]
    for name, condition in steps:
        kept = kept & F.coalesce(condition, F.lit(False))
        out.append(F.count_if(kept).alias(name))
    return df.agg(*out)


def prefer(df: DataFrame, column: str, wanted: str) -> DataFrame:
    """Rows whose ``column`` contains ``wanted`` in any case; all rows where none does, or where the column is absent."""
    if not wanted or column not in df.columns:
        return df
    match = F.coalesce(F.lower(F.col(column)).contains(wanted.lower()), F.lit(False))
    any_match = df.agg(F.coalesce(F.bool_or(match), F.lit(False)).alias("_any"))  # one row
    return df.crossJoin(F.broadcast(any_match)).filter(match | ~F.col("_any")).drop("_any")


def manifest(records: DataFrame, studies: DataFrame, measurements: DataFrame) -> DataFrame:
    """One row per study and test type of its measurement, with link flags; a null study is kept as a group."""
    grouped = records.groupBy("study_id").agg(
        F.min("subject_id").alias("subject_id"), F.count("dicom_filepath").alias("n_dicoms"), F.min("acquisition_datetime").alias("first_acquisition_datetime"), F.max("acquisition_datetime").alias("last_acquisition_datetime")
    )
    # dealt out before it is made distinct, so that the task of a join below does not hold groups too
    kinds = measurements.select("measurement_id", "test_type").filter("measurement_id IS NOT NULL").repartition("measurement_id").distinct()
    linked = grouped.join(studies.withColumnRenamed("subject_id", "subject_id_study"), "study_id", "left")
    # studies without a measurement meet nothing; by their own id they are dealt to all tasks, not to that of null
    spread = F.when(F.col("measurement_id").isNull(), F.xxhash64("study_id")).otherwise(F.xxhash64("measurement_id"))
    linked = linked.withColumn("_spread", spread).join(kinds.withColumn("_spread", F.xxhash64("measurement_id")), ["measurement_id", "_spread"], "left").drop("_spread")
    return linked.withColumns({"has_measurement_link": F.col("measurement_id").isNotNull(), "has_note_link": F.col("note_id").isNotNull()})


def manifest_summary(m: DataFrame) -> DataFrame:
    """Sizes, percentiles of files per study and link rates in one row."""
    m = stored(m.select("study_id", "subject_id", "n_dicoms", "has_measurement_link", "has_note_link"), "manifest")
    whole = m.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("study_id").alias("n_studies"), F.countDistinct("subject_id").alias("n_subjects"), F.avg("n_dicoms").alias("mean_n"), F.max("n_dicoms").alias("max_n"),
        F.avg(F.col("has_measurement_link").cast("int")).alias("measurement_rate"), F.avg(F.col("has_note_link").cast("int")).alias("note_rate"),
    )
    return attach(whole, exact_quantiles(m, [], "n_dicoms", [0.1, 0.5, 0.9], "_q"), []).select("*", F.col("_q")[0].alias("p10_n"), F.col("_q")[1].alias("median_n"), F.col("_q")[2].alias("p90_n")).drop("_q")


def value_counts(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Counts by value, nulls counted too; the most frequent, then the smallest, first."""
    out = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.col(column).asc_nulls_last())
    return out.limit(limit) if limit else out


def measurements_of(selected: DataFrame, measurements: DataFrame) -> DataFrame:
    """Selected studies with all their measurements, or none; the large side is reduced before the join."""
    wanted = selected.select("subject_id", "study_id", "measurement_id").filter(F.col("measurement_id").isNotNull())
    m = measurements.drop("study_id").join(wanted.select("subject_id", "measurement_id"), ["subject_id", "measurement_id"], "left_semi")
    return wanted.join(m, ["subject_id", "measurement_id"], "left")


def notes_of(selected: DataFrame, notes: DataFrame) -> DataFrame:
    """Notes by id, compared as text; studies without a note stay."""
    keyed = notes.select(F.col("note_id").cast("string").alias("_key"), "text")
    return selected.withColumn("_key", F.col("note_id").cast("string")).join(keyed, "_key", "left").drop("_key")


def nearest_note(studies: DataFrame, notes: DataFrame, days: int) -> DataFrame:
    """Each study with the subject's note nearest in time within ``days``; the earlier one at ties.

    Studies meet the notes of their subject and bucket of ``days``, and of the
    buckets beside it.  The nearest note is the last one up to the study or the
    first one after it, so both are merged in time order and no pairs are formed.
    """
    width = days * 86_400_000_000
    at = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    bucket = F.floor(F.col("_t") / max(width, 1))
    one_each = notes.groupBy("subject_id", "note_datetime").agg(F.min(F.struct("note_id")).alias("_id")).withColumn("_t", at("note_datetime"))
    told = one_each.select("subject_id", "_t", F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("_bucket"), F.struct("_t", "note_datetime", "_id.note_id").alias("_note"))
    asked = studies.select("subject_id", "study_id", at("study_datetime").alias("_t")).withColumn("_bucket", bucket)
    rows = told.unionByName(asked, allowMissingColumns=True).filter("subject_id IS NOT NULL AND _t IS NOT NULL")
    group, is_study = Window.partitionBy("subject_id", "_bucket"), F.col("_note").isNull()
    up_to, back_to = group.orderBy("_t", is_study), group.orderBy(F.desc("_t"), is_study.desc())
    beside = rows.withColumns({n: F.last("_note", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) for n, w in (("_a", up_to), ("_b", back_to))})
    pairs = beside.filter(is_study).select("study_id", "_t", F.explode(F.array("_a", "_b")).alias("_n")).withColumn("gap", F.abs(F.col("_t") - F.col("_n._t"))).filter(F.col("gap") <= width)
    best = pairs.groupBy("study_id").agg(F.min(F.struct("gap", "_n.note_datetime", "_n.note_id")).alias("b"))
    return studies.join(best, "study_id", "left").select(*studies.columns, F.col("b.note_id").alias("note_id"), F.col("b.gap").alias("gap_us"))
