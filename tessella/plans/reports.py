"""Queries of batch offsets, checked joins, summaries and choices."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessella.functions import arrays, numeric, text
from tessella.operators import checks, features, metrics, reporting, vectors
from tessella.plans import cohorts, panels
from tessella.plans.registry import query
from tessella.sources import npz
from tessella.sources.scratch import shared_folder, stored
from tessella.sources.views import cte, table, view
from tessella.streaming import ingest


@query(cohorts.COHORT + " SELECT subject_id, study_id, tie FROM sel ORDER BY score, tie LIMIT 50")
def cohort_exactly(spark, sf_dir):
    ordered = cohorts.selected(spark, sf_dir).orderBy("score", "tie")
    return checks.exactly(ordered, 50).select("subject_id", "study_id", "tie")


@query("""WITH n AS (SELECT CAST(vec_id % 3 AS INT) AS batch, count(*) AS n_rows FROM embeddings GROUP BY 1)
SELECT batch, n_rows, CAST(coalesce(sum(n_rows) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_row FROM n""")
def batch_offsets(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return vectors.batch_offsets(vectors.merge_batches([e.filter(F.col("vec_id") % 3 == i).select("vec_id") for i in range(3)]))


@query("""SELECT e.vec_id, e.label AS study_id, concat('f', CAST(e.vec_id AS STRING)) AS dicom_filepath, length(d.text) AS n_chars, len(e.embedding) AS dims FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id""")
def clip_label_join(spark, sf_dir):
    clips = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("study_id"), F.concat(F.lit("f"), F.col("vec_id").cast("string")).alias("dicom_filepath"), F.size("embedding").cast("long").alias("dims"))
    names = clips.select("vec_id", "study_id", "dicom_filepath")
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), F.length("text").cast("long").alias("n_chars"), F.lit(0).alias("dims"))
    return checks.join_one_to_one(clips, names.join(texts, "vec_id"), "vec_id", "study_id", "dicom_filepath")


@query(cte("scored") + " SELECT split, count(y) AS n, round(median(y), 6) AS median, round(quantile_cont(y, 0.75) - quantile_cont(y, 0.25), 6) AS iqr FROM scored GROUP BY 1")
def target_summary(spark, sf_dir):
    return metrics.target_summary(view(spark, sf_dir, "scored"), "y", "split").withColumns({c: F.round(c, 6) for c in ("median", "iqr")})


@query(cte("scored") + """, c AS (SELECT concat('config', CAST(subject_id % 4 AS STRING)) AS name, round(avg(prob), 6) AS metric FROM scored GROUP BY 1)
SELECT 'listed' AS preference, name, metric FROM c WHERE name = 'config2' UNION ALL (SELECT 'absent', name, metric FROM c ORDER BY metric DESC NULLS LAST, name LIMIT 1)""")
def best_configuration(spark, sf_dir):
    name = F.concat(F.lit("config"), (F.col("subject_id") % 4).cast("string"))
    c = view(spark, sf_dir, "scored").groupBy(name.alias("name")).agg(F.round(F.avg("prob"), 6).alias("metric"))
    picked = [reporting.best_configuration(c, "name", "metric", p).select(F.lit(k).alias("preference"), "name", "metric") for k, p in (("listed", "config2"), ("absent", "config9"))]
    return picked[0].unionByName(picked[1])


@query("SELECT o_orderkey, CAST(concat('0x', substr(sha256(CAST(o_orderkey AS STRING)), 1, 8)) AS BIGINT) AS seed FROM orders")
def seed_of_digest(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", numeric.seed_of(F.col("o_orderkey")).alias("seed"))


def _embedded(spark, sf_dir):
    c = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("double").alias("y"), "embedding")
    return c.withColumn("split", F.when(F.col("vec_id") % 5 == 0, "test").otherwise("train"))


@query()
def top_coefficients(spark, sf_dir):
    rows = _embedded(spark, sf_dir)
    first = rows.first()
    p = len(first["embedding"]) if first else 0
    names = [f"dim{i:03}" for i in range(p)]
    wide = rows.select("split", "y", *[F.col("embedding")[i].alias(n) for i, n in enumerate(names)])
    weights, _ = features.ridge(wide, names, "y")
    return features.top_coefficients(names, weights, spark, 20).withColumn("coefficient", F.round("coefficient", 9))


def _tasks_and_vectors(spark, sf_dir):
    """Studies with a split and the wide panel, the names of tasks, and of the 64 columns of a study's vector (null without one)."""
    wide, tasks = panels.wide(spark, sf_dir)
    names = [f"dim{i:03}" for i in range(64)]
    vectors_ = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("study_id"), *[F.col("embedding")[i].alias(n) for i, n in enumerate(names)])
    joined = checks.join_many_to_one(wide, vectors_, "study_id", how="left")
    return stored(joined.withColumn("split", numeric.split_of(numeric.split_score("v1", F.col("study_id")), 0.7, 0.15)), "wide"), tasks, names


@query()
def multitask_tabular(spark, sf_dir):
    """Each task from the others: imputed and scaled on train studies, a ridge model per task, metrics by split."""
    wide, tasks, _ = _tasks_and_vectors(spark, sf_dir)
    return metrics.regression(features.leave_one_out_ridge(wide, tasks), "task_col", "split", spread=False)


@query()
def multitask_vision(spark, sf_dir):
    """Each task from the study's vector, over the studies that have one."""
    wide, tasks, names = _tasks_and_vectors(spark, sf_dir)
    return metrics.regression(features.ridge_for_tasks(wide.filter(F.col(names[0]).isNotNull()), tasks, names), "task_col", "split", spread=False)


@query()
def multitask_fusion(spark, sf_dir):
    """Each task from the study's vector and the other tasks."""
    wide, tasks, names = _tasks_and_vectors(spark, sf_dir)
    return metrics.regression(features.ridge_for_tasks(wide.filter(F.col(names[0]).isNotNull()), tasks, [*names, *tasks]), "task_col", "split", spread=False)


@query()
def multitask_compare(spark, sf_dir):
    """Test metrics of the three runs side by side over the same studies, and which is best, in report order."""
    wide, tasks, names = _tasks_and_vectors(spark, sf_dir)
    both = stored(wide.filter(F.col(names[0]).isNotNull()), "both")
    runs = {"vision": names, "tabular": tasks, "fusion": [*names, *tasks]}
    found = {n: stored(metrics.regression(features.ridge_for_tasks(both, tasks, x), "task_col", "split", spread=False).filter("split = 'test'"), n) for n, x in runs.items()}
    out = reporting.compare({n: t.withColumn("n", F.col("n").cast("long")) for n, t in found.items()}, "task_col", ["n", "mae", "r2"])
    return reporting.ordered(reporting.with_winner(out, list(runs), "r2", "best_by_r2"), "best_by_r2", "-fusion_r2", "task_col")


@query("""WITH e AS (SELECT vec_id, vec_id % 50 AS study_id, embedding FROM embeddings), x AS (SELECT study_id, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x FROM e),
p AS (SELECT study_id, i, avg(CAST(x AS DOUBLE)) AS v, count(*) AS n FROM x GROUP BY 1, 2), v AS (SELECT study_id, max(n) AS n_clips, round(sqrt(sum(v * v)), 5) AS norm FROM p GROUP BY 1),
l AS (SELECT doc_id % 60 AS study_id, median(quality) AS value, max(toxic) AS label, count(*) AS n_rows FROM labels GROUP BY 1)
SELECT v.study_id, v.n_clips, v.norm, l.value, CAST(l.label AS BIGINT) AS label, l.n_rows FROM v JOIN l USING (study_id)""")
def study_vectors_labels(spark, sf_dir):
    """Pooled study vectors with their rolled-up labels, a study once on either side."""
    pooled = vectors.pool(view(spark, sf_dir, "clips"), "study_id").select("study_id", "n_clips", F.round("embedding_l2_norm", 5).alias("norm"))
    rows = table(spark, sf_dir, "labels").withColumn("study_id", F.col("doc_id") % 60)
    rolled = rows.groupBy("study_id").agg(F.median("quality").alias("value"), F.max("toxic").cast("long").alias("label"), F.count(F.lit(1)).alias("n_rows"))
    return checks.join_one_to_one(pooled, rolled, "study_id")


@query("""SELECT e.vec_id, e.label AS study_id, l.toxic, coalesce(CAST(l.quality AS VARCHAR), 'NA') AS quality FROM embeddings e LEFT JOIN (SELECT doc_id, toxic, quality FROM labels) l ON l.doc_id = e.vec_id""")
def keyframe_labels(spark, sf_dir):
    """Frames with the label of their study, many frames to a study; NA where there is none."""
    frames = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("study_id"))
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("vec_id"), "toxic", "quality")
    return checks.join_many_to_one(frames, known, "vec_id", how="left").withColumn("quality", F.coalesce(F.col("quality").cast("string"), F.lit("NA")))


@query("SELECT c_custkey AS row_id, c_custkey % (SELECT count(*) FROM embeddings) AS vec_id, e.label, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 5) AS norm FROM customer JOIN embeddings e ON e.vec_id = c_custkey % (SELECT count(*) FROM embeddings)")
def matrix_gather(spark, sf_dir):
    """Rows of the matrix by their index, with a check of bounds."""
    matrix = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.round(arrays.l2_norm(F.col("embedding")), 5).alias("norm"))
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row_id"), (F.col("c_custkey") % matrix.count()).alias("vec_id"))
    return checks.gather(rows, matrix, "vec_id").select("row_id", "vec_id", "label", "norm")


@query("""WITH s AS (SELECT source, CASE WHEN count(*) % 3 = 0 THEN 'skipped' ELSE 'ok' END AS status, CASE WHEN count(*) % 4 > 0 THEN count(*) END AS n, max(n_chars) AS longest FROM documents GROUP BY 1)
SELECT source, status, n, longest, row_number() OVER (ORDER BY status, n DESC NULLS LAST, longest DESC NULLS LAST, source) AS place FROM s""")
def report_order(spark, sf_dir):
    """Rows of a report in mixed directions, missing values last."""
    n = F.count(F.lit(1))
    s = table(spark, sf_dir, "documents").groupBy("source").agg(F.when(n % 3 == 0, "skipped").otherwise("ok").alias("status"), F.when(n % 4 > 0, n).alias("n"), F.max("n_chars").alias("longest"))
    return reporting.ordered(s, "status", "-n", "-longest", "source")


@query("""SELECT count(*) AS requested_rows, count(*) FILTER (WHERE doc_id % 7 > 0 AND doc_id % 5 > 0 AND doc_id % 3 > 0) AS successful_writes, count(*) FILTER (WHERE doc_id % 7 > 0 AND doc_id % 5 > 0 AND doc_id % 3 = 0) AS skipped_existing,
count(*) FILTER (WHERE doc_id % 7 > 0 AND doc_id % 5 > 0) AS successful_total, count(*) FILTER (WHERE doc_id % 7 = 0 OR doc_id % 5 = 0) AS failed_writes, count(DISTINCT source) FILTER (WHERE doc_id % 7 > 0 AND doc_id % 5 > 0) AS n_studies,
CAST(sum(strlen(text)) FILTER (WHERE doc_id % 7 > 0 AND doc_id % 5 > 0) AS BIGINT) AS total_output_size_bytes FROM documents""")
def write_summary(spark, sf_dir):
    """Counts and bytes of a run that wrote every document, some before and some not."""
    d = table(spark, sf_dir, "documents")
    ok = F.when(F.col("doc_id") % 7 > 0, F.col("doc_id") % 5 > 0)
    status = F.when(F.col("doc_id") % 3 > 0, "written").otherwise("skipped_existing")
    return reporting.write_summary(d.select(F.col("source").alias("study_id"), ok.alias("write_ok"), status.alias("status"), F.octet_length("text").cast("long").alias("output_size_bytes")))


@query(r"""WITH t AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN concat('  ', CAST(strlen(html) AS VARCHAR), '   gs://b/', url) WHEN 1 THEN concat('about ', url) END AS line, CASE page_id % 4 WHEN 0 THEN ' Yes' WHEN 1 THEN 'F' WHEN 2 THEN '1' END AS flag FROM pages)
SELECT page_id, TRY_CAST(nullif(regexp_extract(line, '^\s*(\d+)\s+gs://', 1), '') AS BIGINT) AS n_bytes, CASE page_id % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END AS flag FROM t""")
def listed_sizes(spark, sf_dir):
    """Bytes from the lines of a storage listing, and flags that must be booleans."""
    p, i = table(spark, sf_dir, "pages"), F.col("page_id")
    line = F.when(i % 3 == 0, F.concat(F.lit("  "), F.octet_length("html").cast("string"), F.lit("   gs://b/"), "url")).when(i % 3 == 1, F.concat(F.lit("about "), "url"))
    flag = F.when(i % 4 == 0, " Yes").when(i % 4 == 1, "F").when(i % 4 == 2, "1")
    return p.select("page_id", text.listed_bytes(line).alias("n_bytes"), text.boolean_or_error(flag).alias("flag"))


_Z = "CASE WHEN stddev_pop({c}) OVER w < 1e-8 THEN 0.0 ELSE ({c} - avg({c}) OVER w) / stddev_pop({c}) OVER w END"


@query("""WITH s AS (SELECT user_id, event_id, CAST(floor(value) AS DOUBLE) AS focus, CAST(floor(value) % 7 AS DOUBLE) AS contrast, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS idx FROM events),
m0 AS (SELECT *, abs(focus - lag(focus) OVER (PARTITION BY user_id ORDER BY event_id)) AS m FROM s), m AS (SELECT *, coalesce(m, lead(m) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS motion FROM m0),
z AS (SELECT user_id, idx, round(""" + _Z.format(c="focus") + " + 0.5 * " + _Z.format(c="contrast") + " - 0.5 * " + _Z.format(c="motion") + """, 6) AS combo FROM m WINDOW w AS (PARTITION BY user_id))
SELECT user_id, arg_max(idx, {'a': combo, 'b': -idx}) AS combo_index, count(*) // 2 AS middle_index FROM z GROUP BY 1""")
def frame_choice_combo(spark, sf_dir):
    """The frame that is sharp and still, and the one in the middle, of each clip."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.floor("value").cast("double").alias("focus"), (F.floor("value") % 7).cast("double").alias("contrast"))
    s = vectors.frame_scores(e, "user_id", "event_id", "focus", "contrast").withColumn("combo", F.round("combo", 6))
    best = vectors.choose_frame(s, "user_id", "combo").select("user_id", F.col("selected_index").cast("long").alias("combo_index"))
    middle = vectors.middle_frame(s, "user_id").select("user_id", F.col("selected_index").cast("long").alias("middle_index"))
    return best.join(middle, "user_id")


@query("SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def ingest_events(spark, sf_dir):
    """The events taken in by batches of files, each once."""
    work = f"{shared_folder(spark)}/tessella-{uuid.uuid4().hex}"
    schema = table(spark, sf_dir, "events").schema
    run = lambda: ingest.ingest(spark, f"{sf_dir}/events.parque[t]", schema, f"{work}/events", f"{work}/state", files_per_batch=8, key="event_id").awaitTermination()
    run()
    run()  # finds nothing new
    events = ingest.read_ingested(spark, f"{work}/events", schema)
    return events.select("event_id", "user_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT vec_id, len(embedding) AS dims, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 5) AS norm FROM embeddings")
def array_round_trip(spark, sf_dir):
    """The vectors written as NPZ files by several tasks and read back in ranges."""
    spark.dataSource.register(npz.NpzSource)
    path = f"{shared_folder(spark)}/tessella-{uuid.uuid4().hex}/vectors"
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("values"))
    rows.repartition(4).write.format("npz").option("fileRows", 500).mode("overwrite").save(path)
    read = lambda **o: spark.read.format("npz").options(**o).load(path)
    ids = read(array="ids", ndim=1, type="long").select("path", "entry", F.col("values")[0].alias("vec_id"))
    found = read().join(ids, ["path", "entry"])
    return found.select("vec_id", F.size("values").cast("long").alias("dims"), F.round(arrays.l2_norm(F.col("values")), 5).alias("norm"))
