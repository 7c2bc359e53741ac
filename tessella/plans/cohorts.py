"""Queries of cohort selection, linkage, completeness, batches and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import numeric, text
from tessella.operators import checks, cohort, completeness, intervals, splits
from tessella.plans.registry import query
from tessella.sources.views import cte, table, view

_PER_STUDY = ", per_study AS (SELECT subject_id, study_id, count(*) AS n_dicoms, min(acquisition_datetime) AS first_t, max(acquisition_datetime) AS last_t FROM records GROUP BY 1, 2)"
_BASE = _PER_STUDY + ", base AS (SELECT p.*, s.measurement_id, s.note_id FROM per_study p LEFT JOIN studies s USING (subject_id, study_id))"
_RANKED = (
    _BASE
    + """, f AS (SELECT * FROM base WHERE n_dicoms BETWEEN 2 AND 8 AND measurement_id IS NOT NULL),
scored AS (SELECT *, abs(n_dicoms - (SELECT median(n_dicoms) FROM f)) AS score, md5(concat(CAST(study_id AS STRING), '-1337')) AS tie FROM f),
ranked AS (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY score, tie) AS rn FROM scored)"""
)
_SELECTED = _RANKED + ", sel AS (SELECT * FROM ranked WHERE rn <= 1 ORDER BY score, tie LIMIT 200)"


#: Up to ``sel``, the selected studies.
COHORT = cte("records", "studies") + _SELECTED


def selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.select_cohort(view(spark, sf_dir, "records"), view(spark, sf_dir, "studies"), 2, 8, 200)


@query(cte("records", "studies") + _SELECTED + " SELECT subject_id, study_id, n_dicoms, CAST(score AS DOUBLE) AS score, tie FROM sel")
def cohort_select(spark, sf_dir):
    return selected(spark, sf_dir).select("subject_id", "study_id", "n_dicoms", "score", "tie")


@query(cte("records", "studies") + _SELECTED + """ SELECT subject_id, study_id, ltrim(dicom_filepath, '/') AS relative_path, replace(ltrim(dicom_filepath, '/'), 'files/', '') AS object_path,
concat('gs://bucket/root/', ltrim(dicom_filepath, '/')) AS url FROM records WHERE (subject_id, study_id) IN (SELECT (subject_id, study_id) FROM sel)""")
def cohort_records(spark, sf_dir):
    return cohort.records_of(view(spark, sf_dir, "records"), selected(spark, sf_dir), "gs://bucket/root/")


_M64 = "18446744073709551616::UHUGEINT"


def _get(at: str, size: int) -> str:
    """``size`` bytes of ``s`` from the place ``at`` (from 1), the first one lowest."""
    return " + ".join(f"ascii(substr(s, {at} + {i}, 1))::UHUGEINT * {1 << 8 * i}::UHUGEINT" for i in range(size))


def _times(a: str, b: str) -> str:
    return f"(({a}) * ({b})) % {_M64}"


def _fold(a: str) -> str:
    return f"xor({a}, {a} // 140737488355328::UHUGEINT)"


def _fingerprints(table: str, ident: str, seed: int) -> str:
    """CTEs up to ``fp(id, fp)``: signed fingerprints of ``id-seed``, of 4 to 16 ASCII bytes."""
    k2 = f"{0x9AE16A3B2F90404F}::UHUGEINT"
    rotated = lambda v, r: f"(({v}) // {1 << r}::UHUGEINT + (({v}) % {1 << r}::UHUGEINT) * {1 << 64 - r}::UHUGEINT)"
    return f""", fp0 AS (SELECT DISTINCT {ident} AS id, concat(CAST({ident} AS VARCHAR), '-{seed}') AS s FROM {table}), fp1 AS (SELECT *, length(s) AS n, ({k2} + (2 * length(s))::UHUGEINT) % {_M64} AS m FROM fp0),
fp2 AS (SELECT *, CASE WHEN n >= 8 THEN ({_get("1", 8)} + {k2}) % {_M64} ELSE n::UHUGEINT + 8::UHUGEINT * ({_get("1", 4)}) END AS a, CASE WHEN n >= 8 THEN {_get("(n - 7)", 8)} ELSE {_get("(n - 3)", 4)} END AS b FROM fp1),
fp3 AS (SELECT *, CASE WHEN n >= 8 THEN ({_times(rotated("b", 37), "m")} + a) % {_M64} ELSE a END AS u, CASE WHEN n >= 8 THEN {_times("(" + rotated("a", 25) + " + b) % " + _M64, "m")} ELSE b END AS v FROM fp2),
fp4 AS (SELECT *, {_times("xor(u, v)", "m")} AS c FROM fp3), fp5 AS (SELECT *, {_times("xor(v, " + _fold("c") + ")", "m")} AS e FROM fp4), fp6 AS (SELECT id, {_times(_fold("e"), "m")} AS f FROM fp5),
fp AS (SELECT id, CASE WHEN f >= 9223372036854775808::UHUGEINT THEN CAST(f::HUGEINT - 18446744073709551616::HUGEINT AS BIGINT) ELSE CAST(f AS BIGINT) END AS fp FROM fp6)"""


@query("WITH x AS (SELECT 1)" + _fingerprints("orders", "o_orderkey", 1337) + " SELECT id AS study_id, fp FROM fp")
def fingerprint_keys(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("study_id"), numeric.fingerprint_key(F.col("o_orderkey"), 1337).alias("fp")).distinct()


@query(
    cte("records", "studies") + _BASE + _fingerprints("orders", "o_orderkey", 1337)
    + """, f AS (SELECT base.*, fp.fp AS tie FROM base JOIN fp ON study_id = id WHERE n_dicoms BETWEEN 2 AND 8 AND measurement_id IS NOT NULL), scored AS (SELECT *, abs(n_dicoms - (SELECT median(n_dicoms) FROM f)) AS score FROM f),
ranked AS (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY score, tie) AS rn FROM scored) SELECT subject_id, study_id, CAST(score AS DOUBLE) AS score, tie FROM ranked WHERE rn <= 1 ORDER BY score, tie LIMIT 200"""
)
def cohort_select_fingerprint(spark, sf_dir):
    """The first 200 studies in the order of the fingerprint."""
    found = cohort.select_cohort(view(spark, sf_dir, "records"), view(spark, sf_dir, "studies"), 2, 8, 200, tie=numeric.fingerprint_key)
    return found.select("subject_id", "study_id", "score", "tie")


@query(cte("records", "studies") + _BASE + """, r AS (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY md5(concat(CAST(study_id AS STRING), '-7'))) AS rn FROM base WHERE n_dicoms BETWEEN 1 AND 99 AND measurement_id IS NOT NULL)
SELECT subject_id, study_id, n_dicoms FROM r WHERE rn <= 1""")
def cohort_all_hash_order(spark, sf_dir):
    return cohort.select_by_hash(view(spark, sf_dir, "records"), view(spark, sf_dir, "studies"), 1, 99, 1, 7).select("subject_id", "study_id", "n_dicoms")


@query(cte("records", "studies") + _BASE + """ SELECT count(*) AS initial_rows, count(*) FILTER (WHERE measurement_id IS NOT NULL) AS after_measurement, count(*) FILTER (WHERE measurement_id IS NOT NULL AND note_id IS NOT NULL) AS after_note,
count(*) FILTER (WHERE measurement_id IS NOT NULL AND note_id IS NOT NULL AND n_dicoms BETWEEN 2 AND 8) AS after_bounds FROM base""")
def subset_filter_audit(spark, sf_dir):
    steps = [("after_measurement", F.col("measurement_id").isNotNull()), ("after_note", F.col("note_id").isNotNull()), ("after_bounds", F.col("n_dicoms").between(2, 8))]
    return cohort.filter_audit(cohort.candidates(view(spark, sf_dir, "records"), view(spark, sf_dir, "studies")), steps)


@query(cte("records", "studies") + _RANKED + " SELECT subject_id, study_id, CAST(score AS DOUBLE) AS score FROM ranked WHERE rn <= 2")
def subject_cap_head_k(spark, sf_dir):
    return cohort.select_cohort(view(spark, sf_dir, "records"), view(spark, sf_dir, "studies"), 2, 8, None, cap=2).select("subject_id", "study_id", "score")


@query(cte("measurements") + """ SELECT 'found' AS kind, count(*) AS n FROM measurements WHERE contains(lower(test_type), 'stress') UNION ALL SELECT 'absent', count(*) FROM measurements""")
def prefer_test_type(spark, sf_dir):
    m = view(spark, sf_dir, "measurements")
    part = lambda kind, wanted: cohort.prefer(m, "test_type", wanted).agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")
    return part("found", "STRESS").unionByName(part("absent", "no such type"))


_MANIFEST = """, g AS (SELECT study_id, min(subject_id) AS subject_id, count(dicom_filepath) AS n_dicoms, min(acquisition_datetime) AS first_t, max(acquisition_datetime) AS last_t FROM records GROUP BY 1),
kinds AS (SELECT DISTINCT measurement_id, test_type FROM measurements),
m AS (SELECT g.*, s.subject_id AS subject_id_study, s.measurement_id, s.note_id, k.test_type, s.measurement_id IS NOT NULL AS has_measurement_link, s.note_id IS NOT NULL AS has_note_link
FROM g LEFT JOIN studies s USING (study_id) LEFT JOIN kinds k ON k.measurement_id = s.measurement_id)"""


def _manifest(spark, sf_dir):
    return cohort.manifest(view(spark, sf_dir, "records"), view(spark, sf_dir, "studies"), view(spark, sf_dir, "measurements"))


@query(cte("records", "studies", "measurements") + _MANIFEST + " SELECT study_id, subject_id, subject_id_study, n_dicoms, test_type, has_measurement_link, has_note_link FROM m")
def study_manifest(spark, sf_dir):
    return _manifest(spark, sf_dir).select("study_id", "subject_id", "subject_id_study", "n_dicoms", "test_type", "has_measurement_link", "has_note_link")


@query(cte("records", "studies", "measurements") + _MANIFEST + """ SELECT count(*) AS n_rows, count(DISTINCT study_id) AS n_studies, count(DISTINCT subject_id) AS n_subjects, round(avg(n_dicoms), 6) AS mean_n, max(n_dicoms) AS max_n,
round(avg(CAST(has_measurement_link AS INT)), 6) AS measurement_rate, round(avg(CAST(has_note_link AS INT)), 6) AS note_rate,
quantile_cont(CAST(n_dicoms AS DOUBLE), 0.1) AS p10_n, quantile_cont(CAST(n_dicoms AS DOUBLE), 0.5) AS median_n, quantile_cont(CAST(n_dicoms AS DOUBLE), 0.9) AS p90_n FROM m""")
def manifest_summary(spark, sf_dir):
    out = cohort.manifest_summary(_manifest(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in ("mean_n", "measurement_rate", "note_rate")})


@query(cte("measurements") + " SELECT test_type, count(*) AS n FROM measurements GROUP BY 1")
def test_type_counts(spark, sf_dir):
    return cohort.value_counts(view(spark, sf_dir, "measurements"), "test_type")


@query(cte("studies") + " SELECT study_id, s.note_id, length(d.text) AS n_chars FROM studies s LEFT JOIN documents d ON CAST(d.doc_id AS STRING) = CAST(s.note_id AS STRING)")
def note_join(spark, sf_dir):
    notes = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("note_id"), "text")
    return cohort.notes_of(view(spark, sf_dir, "studies"), notes).select("study_id", "note_id", F.length("text").cast("long").alias("n_chars"))


@query(cte("studies") + " SELECT count(*) AS n_rows, count(note_id) AS n_notes, count(DISTINCT subject_id) FILTER (WHERE note_id IS NOT NULL) AS n_subjects, count(*) FILTER (WHERE measurement_id IS NULL) AS n_unmeasured FROM studies")
def note_link_probe(spark, sf_dir):
    s = view(spark, sf_dir, "studies")
    return s.agg(F.count(F.lit(1)).alias("n_rows"), F.count("note_id").alias("n_notes"), F.countDistinct(F.when(F.col("note_id").isNotNull(), F.col("subject_id"))).alias("n_subjects"), F.count_if(F.col("measurement_id").isNull()).alias("n_unmeasured"))


@query("""WITH n AS (SELECT event_id AS note_id, user_id AS subject_id, ts AS note_datetime FROM events), s AS (SELECT o_custkey AS subject_id, o_orderkey AS study_id, o_orderdate + INTERVAL 9500 DAY AS study_datetime FROM orders),
p AS (SELECT study_id, note_id, abs(epoch_us(study_datetime) - epoch_us(note_datetime)) AS gap, note_datetime FROM s JOIN n USING (subject_id) WHERE abs(epoch_us(study_datetime) - epoch_us(note_datetime)) <= 30 * 86400000000),
b AS (SELECT *, row_number() OVER (PARTITION BY study_id ORDER BY gap, note_datetime, note_id) AS rn FROM p) SELECT s.study_id, b.note_id, b.gap AS gap_us FROM s LEFT JOIN b ON b.study_id = s.study_id AND rn = 1""")
def nearest_note_in_time(spark, sf_dir):
    notes = table(spark, sf_dir, "events").select(F.col("event_id").alias("note_id"), F.col("user_id").alias("subject_id"), F.col("ts").alias("note_datetime"))
    studies = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("subject_id"), F.col("o_orderkey").alias("study_id"), (F.col("o_orderdate") + F.expr("INTERVAL 9500 DAY")).alias("study_datetime"))
    return cohort.nearest_note(studies, notes, 30).select("study_id", "note_id", "gap_us")


_ADMISSIONS = """WITH a AS (SELECT o_custkey AS subject_id, o_orderkey AS interval_id, o_orderdate + INTERVAL 9500 DAY AS first, CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate + INTERVAL 9500 DAY + to_days(CAST(o_orderkey % 41 AS INT)) END AS last FROM orders),
n AS (SELECT event_id AS note_id, user_id AS subject_id, ts AS moment FROM events), s AS (SELECT o_custkey AS subject_id, o_orderkey AS study_id, o_orderdate + INTERVAL 9502 DAY AS moment FROM orders),
"""


def _within(table: str, ident: str) -> str:
    return f"""{table}_in AS (SELECT {table}.{ident}, {table}.moment, interval_id FROM {table} LEFT JOIN a ON {table}.subject_id = a.subject_id AND moment >= first AND (last IS NULL OR moment <= last)
QUALIFY row_number() OVER (PARTITION BY {table}.{ident} ORDER BY first DESC, interval_id) = 1)"""


def _admissions(spark, sf_dir):
    """Stays of up to forty days from orders, some still open, with events as notes."""
    begin = F.col("o_orderdate") + F.expr("INTERVAL 9500 DAY")
    o = table(spark, sf_dir, "orders")
    stays = o.select(
        F.col("o_custkey").alias("subject_id"), F.col("o_orderkey").alias("interval_id"), begin.alias("start"),
        F.when(F.col("o_orderkey") % 50 != 0, begin + F.make_dt_interval((F.col("o_orderkey") % 41).cast("int"))).alias("end"),
    )
    studies = o.select(F.col("o_custkey").alias("subject_id"), F.col("o_orderkey").alias("study_id"), (F.col("o_orderdate") + F.expr("INTERVAL 9502 DAY")).alias("study_datetime"))
    return stays, studies, table(spark, sf_dir, "events").select(F.col("event_id").alias("note_id"), F.col("user_id").alias("subject_id"), F.col("ts").alias("note_datetime"))


@query(_ADMISSIONS + _within("n", "note_id") + " SELECT note_id, interval_id FROM n_in")
def admission_of_note(spark, sf_dir):
    stays, _, notes = _admissions(spark, sf_dir)
    return intervals.interval_of(notes.withColumnRenamed("note_datetime", "at"), stays).select("note_id", "interval_id")


@query(
    _ADMISSIONS + _within("n", "note_id") + ", " + _within("s", "study_id")
    + """, p AS (SELECT study_id, note_id, n_in.moment, abs(epoch_us(s_in.moment) - epoch_us(n_in.moment)) AS gap FROM s_in JOIN n_in USING (interval_id)),
b AS (SELECT * FROM p WHERE gap <= 20 * 86400000000 QUALIFY row_number() OVER (PARTITION BY study_id ORDER BY gap, moment, note_id) = 1) SELECT s_in.study_id, interval_id AS admission_id, b.note_id, b.gap AS gap_us FROM s_in LEFT JOIN b USING (study_id)"""
)
def note_by_admission(spark, sf_dir):
    stays, studies, notes = _admissions(spark, sf_dir)
    return intervals.note_by_admission(studies, notes, stays, 20).select("study_id", "admission_id", "note_id", "gap_us")


@query(cte("records", "studies", "measurements") + _SELECTED + """, w AS (SELECT subject_id, study_id, measurement_id FROM sel)
SELECT w.subject_id, w.study_id, w.measurement_id, m.measurement, m.result, m.unit, m.test_type FROM w LEFT JOIN measurements m ON m.subject_id = w.subject_id AND m.measurement_id = w.measurement_id""")
def export_measurements(spark, sf_dir):
    return cohort.measurements_of(selected(spark, sf_dir), view(spark, sf_dir, "measurements")).select("subject_id", "study_id", "measurement_id", "measurement", "result", "unit", "test_type")


_COMPLETE = """, e AS (SELECT subject_id, study_id, count(dicom_filepath) AS expected_dicoms FROM records GROUP BY 1, 2),
a AS (SELECT l_orderkey AS study_id, count(*) AS actual_dicoms FROM lineitem WHERE l_linenumber <> 4 GROUP BY 1),
c AS (SELECT subject_id, study_id, expected_dicoms, coalesce(actual_dicoms, 0) AS actual_dicoms, coalesce(actual_dicoms, 0) >= expected_dicoms AS complete FROM e LEFT JOIN a USING (study_id))"""


def _completion(spark, sf_dir):
    actual = table(spark, sf_dir, "lineitem").filter("l_linenumber <> 4").select(F.col("l_orderkey").alias("study_id"))
    return completeness.completion(view(spark, sf_dir, "records"), actual)


@query(cte("records") + _COMPLETE + " SELECT * FROM c")
def completion_report(spark, sf_dir):
    return _completion(spark, sf_dir)


@query(cte("records") + _COMPLETE + " SELECT r.study_id, concat('https://host/', ltrim(dicom_filepath, '/')) AS url FROM records r WHERE study_id IN (SELECT study_id FROM c WHERE NOT complete)")
def resume_urls(spark, sf_dir):
    _, incomplete = completeness.split_by(_completion(spark, sf_dir), "complete")
    return view(spark, sf_dir, "records").join(incomplete.select("study_id"), "study_id", "left_semi").select("study_id", text.join_url("https://host", F.col("dicom_filepath")).alias("url"))


@query(cte("records") + _COMPLETE + """ SELECT study_id, CASE WHEN study_id % 3 = 0 AND actual_dicoms >= expected_dicoms THEN 'already_complete' WHEN study_id % 11 = 0 THEN 'download_failed' WHEN actual_dicoms < expected_dicoms THEN 'incomplete' ELSE 'ok' END AS status,
printf('files/p%02d/p%d/s%d', CAST(floor(subject_id / 100) AS BIGINT), subject_id, study_id) AS dir FROM c""")
def download_status(spark, sf_dir):
    report = _completion(spark, sf_dir).withColumns({"before_dicoms": F.when(F.col("study_id") % 3 == 0, F.col("actual_dicoms")).otherwise(F.lit(-1)), "failed": F.col("study_id") % 11 == 0})
    return completeness.download_status(report).select("study_id", "status", text.study_dir(F.col("subject_id"), F.col("study_id"), 100).alias("dir"))


@query(cte("records") + " SELECT count(*) AS n_rows, 4 AS n_columns, count(DISTINCT study_id) AS distinct_study_id, count(DISTINCT dicom_filepath) AS distinct_dicom_filepath, count(*) - count(DISTINCT study_id) AS repeats_study_id, count(*) - count(DISTINCT dicom_filepath) AS repeats_dicom_filepath FROM records")
def audit_uniqueness(spark, sf_dir):
    return checks.profile(view(spark, sf_dir, "records"), "study_id", "dicom_filepath")


@query("SELECT (SELECT count(*) FROM (SELECT o_orderkey FROM orders INTERSECT SELECT doc_id FROM documents)) AS n_both, (SELECT count(*) FROM (SELECT o_orderkey FROM orders EXCEPT SELECT doc_id FROM documents)) AS n_left_only, (SELECT count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT o_orderkey FROM orders)) AS n_right_only")
def audit_intersections(spark, sf_dir):
    return completeness.overlap(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("study_id")), table(spark, sf_dir, "documents").select(F.col("doc_id").alias("study_id")), "study_id")


@query(cte("scored") + " SELECT count(*) AS n_keys, count(*) FILTER (WHERE n > 1) AS n_violations, max(n) AS max_n FROM (SELECT subject_id, count(DISTINCT split) AS n FROM scored GROUP BY 1)")
def audit_split_leakage(spark, sf_dir):
    return completeness.spread(view(spark, sf_dir, "scored"), "subject_id", "split")


@query(cte("records") + " SELECT min(n) AS min_n, median(CAST(n AS DOUBLE)) AS median_n, max(n) AS max_n, round(avg(n), 6) AS mean_n FROM (SELECT study_id, count(*) AS n FROM records GROUP BY 1)")
def files_per_study(spark, sf_dir):
    return completeness.group_size_summary(view(spark, sf_dir, "records"), "study_id").withColumn("mean_n", F.round("mean_n", 6))


@query(cte("records") + """, l AS (SELECT DISTINCT ltrim(dicom_filepath, '/') AS path, sha256(dicom_filepath) AS sha256 FROM records WHERE study_id % 4 <> 1)
SELECT path, sha256 FROM (SELECT DISTINCT ltrim(dicom_filepath, '/') AS path FROM records) LEFT JOIN l USING (path)""")
def checksum_match(spark, sf_dir):
    r = view(spark, sf_dir, "records")
    path = text.relative_path(F.col("dicom_filepath"))
    # dealt by path before the digest is made, which does not compress; the join finds the rows where they are
    files = r.filter("study_id % 4 <> 1").select(path.alias("path"), "dicom_filepath").repartition("path").distinct()
    listed = files.select("path", F.sha2(F.col("dicom_filepath"), 256).alias("sha256"))
    return completeness.match_checksums(listed, r.select(path.alias("path")))


@query("SELECT o_orderkey AS study_id FROM orders WHERE o_orderkey NOT IN (SELECT doc_id FROM documents)")
def remaining_studies(spark, sf_dir):
    return completeness.remaining(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("study_id")), table(spark, sf_dir, "documents").select(F.col("doc_id").alias("study_id")))


@query("SELECT study_id, row_number() OVER (ORDER BY study_id) - 1 AS row, CAST(floor((row_number() OVER (ORDER BY study_id) - 1) / 500) AS BIGINT) AS batch FROM (SELECT o_orderkey AS study_id FROM orders WHERE o_orderstatus <> 'P')")
def batch_assign(spark, sf_dir):
    return completeness.assign_batches(table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("study_id")), 500)


_SCORE = "CAST(('0x' || substr(sha256(concat('seed:', CAST(c_custkey AS STRING))), 1, 15)) AS UBIGINT)::DOUBLE / 1152921504606846976.0"


@query(f"SELECT subject_id, round(s, 9) AS split_score, CASE WHEN s < 0.7 THEN 'train' WHEN s < 0.85 THEN 'val' ELSE 'test' END AS split, 'v1' AS split_version, 'seed' AS seed_string, CAST(0.7 AS DOUBLE) AS train_frac, CAST(0.15 AS DOUBLE) AS val_frac FROM (SELECT c_custkey AS subject_id, {_SCORE} AS s FROM customer)")
def split_hash(spark, sf_dir):
    out = splits.hash_split(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("subject_id")), "seed")
    return out.withColumn("split_score", F.round("split_score", 9))


@query("""WITH r AS (SELECT c_custkey AS subject_id, c_mktsegment AS label, row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(concat(CAST(c_custkey AS STRING), '-11'))) AS r, count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer)
SELECT subject_id, label, CASE WHEN r <= floor(n * 0.7) THEN 'train' WHEN r <= floor(n * 0.7) + floor(n * 0.15) THEN 'val' ELSE 'test' END AS split FROM r""")
def split_stratified(spark, sf_dir):
    return splits.stratified_split(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("subject_id"), F.col("c_mktsegment").alias("label")), "label", 11)


@query("""WITH r AS (SELECT c_custkey AS subject_id, row_number() OVER (ORDER BY md5(concat(CAST(c_custkey AS STRING), '-5'))) AS r, count(*) OVER () AS n FROM customer)
SELECT subject_id, CASE WHEN r <= floor(n * 0.7) THEN 'train' WHEN r <= floor(n * 0.7) + floor(n * 0.15) THEN 'val' ELSE 'test' END AS split FROM r""")
def split_shuffle(spark, sf_dir):
    return splits.shuffle_split(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("subject_id")), 5)


@query(f"SELECT o_orderkey AS study_id, CASE WHEN s < 0.7 THEN 'train' WHEN s < 0.85 THEN 'val' ELSE 'test' END AS split FROM orders JOIN (SELECT c_custkey, {_SCORE} AS s FROM customer) ON o_custkey = c_custkey")
def split_frozen_join(spark, sf_dir):
    frozen = splits.hash_split(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("subject_id")), "seed")
    studies = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("subject_id"), F.col("o_orderkey").alias("study_id"))
    return splits.frozen_split(studies, frozen).select("study_id", "split")


@query(cte("scored") + f", f AS (SELECT subject_id, CASE WHEN s < 0.7 THEN 'train' WHEN s < 0.85 THEN 'val' ELSE 'test' END AS frozen FROM (SELECT c_custkey AS subject_id, {_SCORE} AS s FROM customer)) SELECT count(*) AS n_rows, count(*) FILTER (WHERE frozen IS NULL) AS n_missing, count(*) FILTER (WHERE frozen <> split) AS n_mismatch FROM scored LEFT JOIN f USING (subject_id)")
def split_map_audit(spark, sf_dir):
    s = view(spark, sf_dir, "scored")
    frozen = splits.hash_split(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("subject_id")), "seed")
    return completeness.split_mismatch(s, frozen.select("subject_id", "split"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, coalesce(CAST(json_extract(props, '$.absent.deep') AS BIGINT), -1) AS absent FROM events""")
def json_extract(spark, sf_dir):
    props = F.col("props")
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object(props, "$.k").cast("long").alias("k"), F.coalesce(F.get_json_object(props, "$.absent.deep").cast("long"), F.lit(-1)).alias("absent"))


@query("""SELECT page_id, CASE WHEN starts_with(url, 'https://') THEN concat('gs://', substr(url, 9)) ELSE url END AS path, regexp_extract(CASE WHEN starts_with(url, 'https://') THEN concat('gs://', substr(url, 9)) ELSE url END, '^gs://([^/]+)/?', 1) AS bucket,
regexp_extract(CASE WHEN starts_with(url, 'https://') THEN concat('gs://', substr(url, 9)) ELSE url END, '^gs://[^/]+/?(.*)$', 1) AS object_key FROM pages""")
def path_rewrite(spark, sf_dir):
    path = text.rewrite_prefix(F.col("url"), "https://", "gs://")
    parts = text.bucket_and_key(path)
    return table(spark, sf_dir, "pages").select("page_id", path.alias("path"), parts["bucket"].alias("bucket"), parts["key"].alias("object_key"))


@query("SELECT c_custkey AS subject_id, md5(concat(CAST(c_custkey AS STRING), '-3')) AS tie FROM customer ORDER BY tie, subject_id LIMIT 50")
def seeded_sample(spark, sf_dir):
    """A seeded sample of 50 subjects."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("subject_id"), numeric.tie_key(F.col("c_custkey"), 3).alias("tie")).orderBy("tie", "subject_id").limit(50)
