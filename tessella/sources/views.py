"""Domain views over the test tables, in SQL that Spark and DuckDB both read.

``{table}`` stands for a table; missing values are made here, since the tables
have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

VIEWS = {
    "records": """
SELECT o_custkey AS subject_id, l_orderkey AS study_id, l_shipdate AS acquisition_datetime,
       concat('/files/p', CAST(o_custkey % 97 AS STRING), '/p', CAST(o_custkey AS STRING), '/s', CAST(l_orderkey AS STRING), '/', CAST(l_partkey AS STRING), '-', CAST(l_linenumber AS STRING), '.dcm') AS dicom_filepath
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "studies": """
SELECT o_custkey AS subject_id, o_orderkey AS study_id, o_orderdate AS study_datetime,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS measurement_id, doc_id AS note_id
FROM {orders} LEFT JOIN {documents} ON doc_id = o_orderkey""",
    "measurements": """
SELECT o_custkey AS subject_id, l_orderkey AS study_id, l_orderkey AS measurement_id, l_shipdate AS measurement_datetime,
       CASE WHEN l_returnflag = 'A' THEN 'TTE' WHEN l_returnflag = 'N' THEN 'TEE' ELSE 'Stress' END AS test_type,
       CASE l_partkey % 12 WHEN 0 THEN 'LVEF' WHEN 1 THEN 'lv_mass' WHEN 2 THEN 'LA volume index' WHEN 3 THEN 'LA-volume' WHEN 4 THEN 'MV E A ratio' WHEN 5 THEN 'AV mean gradient'
            WHEN 6 THEN 'TAPSE' WHEN 7 THEN 'Aortic/Root' WHEN 8 THEN 'Heart  Rate' WHEN 9 THEN 'lvef' WHEN 10 THEN 'GLS' ELSE '' END AS measurement,
       CASE WHEN l_partkey % 5 = 0 THEN 'LV mass' WHEN l_partkey % 5 = 1 THEN lower(p_type) END AS measurement_description,
       CASE l_linenumber WHEN 3 THEN '' WHEN 5 THEN 'n/a' WHEN 6 THEN concat(' ', CAST(CAST(l_quantity AS INT) AS STRING), ' ') ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS result,
       CASE (l_linenumber + l_partkey) % 7 WHEN 0 THEN 'cm' WHEN 1 THEN 'mm' WHEN 2 THEN 'Percent' WHEN 3 THEN 'm / s' WHEN 4 THEN 'centimeter^2' WHEN 5 THEN 'g/m2' END AS unit
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey""",
    "clips": """
SELECT vec_id AS clip_id, vec_id % 50 AS study_id, (vec_id % 50) % 25 AS subject_id, embedding, label FROM {embeddings}""",
    "scored": """
SELECT doc_id AS study_id, doc_id % 40 AS subject_id, CASE doc_id % 5 WHEN 0 THEN 'test' WHEN 1 THEN 'val' ELSE 'train' END AS split,
       CAST(n_chars AS DOUBLE) / 100 AS y, CAST(n_chars AS DOUBLE) / 110 + CAST(doc_id % 7 AS DOUBLE) - 2 AS pred,
       quality AS label, CAST((doc_id * 37 + quality * 40) % 100 AS DOUBLE) / 100 AS prob
FROM {documents} JOIN {labels} USING (doc_id)""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql})


def cte(*names: str) -> str:
    """``WITH`` clause of views for DuckDB."""
    plain = {n: VIEWS[n] for n in names}
    for t in TABLES:
        plain = {n: s.replace("{" + t + "}", t) for n, s in plain.items()}
    return "WITH " + ", ".join(f"{n} AS ({s})" for n, s in plain.items())
