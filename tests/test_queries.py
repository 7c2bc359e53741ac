"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pyarrow.parquet as pq
import pytest

from tessella.plans import registry
from tessella.sources.views import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


@pytest.mark.parametrize("name", registry.queries())
def test_query(spark, con, name):
    df = registry.queries()[name](spark, SF)
    got = [tuple(map(plain, r)) for r in df.select(*sorted(df.columns)).collect()]
    if name not in registry.oracle_sql():
        assert got
        return
    cursor = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    want = [tuple(plain(r[i]) for i in order) for r in cursor.fetchall()]
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(str, ([float(x) if isinstance(x, int) and not isinstance(x, bool) else x for x in r] for r in got))) == sorted(
        map(str, ([float(x) if type(x).__name__ in ("int", "Decimal") else x for x in r] for r in want))
    )


@pytest.fixture(scope="module")
def empty(tmp_path_factory):
    path = tmp_path_factory.mktemp("empty")
    for t in TABLES:
        pq.write_table(pq.read_schema(f"{SF}/{t}.parquet").empty_table(), path / f"{t}.parquet")
    return str(path)


#: Queries that look at their data before they plan.
EAGER = [
    "top_coefficients", "multitask_compare", "feature_matrix_imputed_scaled", "feature_missing_rate", "logistic_fit", "pca_fit", "perceptron_regression", "perceptron_classification", "nearest_exact", "nearest_recall",
    "panel_wide", "panel_task_metadata", "bootstrap_auc_ci", "registry_canonical_profile", "manifest_summary", "note_by_admission", "ingest_events", "array_round_trip", "matrix_gather", "report_order",
]


@pytest.mark.parametrize("name", EAGER)
def test_empty_tables(spark, empty, name):
    assert len(registry.queries()[name](spark, empty).collect()) <= 1  # a summary has its one row


def test_entry():
    import __spark_entry__ as e

    assert {"cohort_select", "panel_long"} <= e.queries().keys() and set(registry.oracle_sql()) <= set(e.oracle_sql())
