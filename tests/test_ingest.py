"""Ingestion by batches: resuming, repeated and broken batches, repeats of a key."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from tessella.streaming import ingest as I

SCHEMA = "id long, v string"


def put(spark, folder, ids, name, v="x"):
    spark.createDataFrame([(i, v) for i in ids], SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def run(spark, tmp_path, **more):
    I.ingest(spark, f"{tmp_path}/source/*", SCHEMA, f"{tmp_path}/target", f"{tmp_path}/state", **more).awaitTermination()


def rows(spark, tmp_path):
    return sorted((r["id"], r["batch"]) for r in I.read_ingested(spark, f"{tmp_path}/target", SCHEMA).collect())


def test_files_are_taken_once_and_repeats_dropped(spark, tmp_path):
    source = f"{tmp_path}/source"
    put(spark, source, [1, 2, 2, 3], "a")
    run(spark, tmp_path, key="id")
    assert [i for i, _ in rows(spark, tmp_path)] == [1, 2, 3]
    put(spark, source, [3, 4, None], "b")
    put(spark, source, [None, 5, 1], "c")
    run(spark, tmp_path, key="id", files_per_batch=1)
    run(spark, tmp_path, key="id")
    got = rows_with_null(spark, tmp_path)
    assert sorted(map(str, got)) == sorted(map(str, [1, 2, 3, 4, 5, None]))
    done = I.commits(spark, f"{tmp_path}/target").collect()
    assert sum(r["n_rows"] for r in done) == 6 and len({r["batch"] for r in done}) == len(done) >= 3


def rows_with_null(spark, tmp_path):
    return [r["id"] for r in I.read_ingested(spark, f"{tmp_path}/target", SCHEMA).collect()]


@pytest.mark.parametrize("broken", ["before the marker", "in the folder"])
def test_a_batch_that_breaks_off_and_is_repeated_leaves_each_row_once(spark, tmp_path, monkeypatch, broken):
    put(spark, f"{tmp_path}/source", range(50), "a")
    mark = I._mark

    def fail(session, target, batch, n_rows, seconds):
        if broken == "in the folder":  # as if only a part of other files had been written
            put(spark, f"{target}/data/batch={batch}", [999], "part")
        raise RuntimeError("lost")

    monkeypatch.setattr(I, "_mark", fail)
    with pytest.raises(Exception, match="lost"):
        run(spark, tmp_path, key="id")
    # what is not whole is not seen
    assert rows(spark, tmp_path) == [] and (tmp_path / "target/data/batch=0").exists()
    monkeypatch.setattr(I, "_mark", mark)
    run(spark, tmp_path, key="id")
    assert rows(spark, tmp_path) == [(i, 0) for i in range(50)]
    # a batch that is whole is left alone if it comes again, as after a loss of the stream's own log
    state = tmp_path / "state/commits"
    for name in ("0", ".0.crc"):
        if (state / name).exists():
            (state / name).rename(tmp_path / f"moved{name}")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "target/data").rglob("*.parquet")}
    run(spark, tmp_path, key="id")
    assert rows(spark, tmp_path) == [(i, 0) for i in range(50)]
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "target/data").rglob("*.parquet")} == before


def test_the_table_is_not_read_again(spark, tmp_path):
    """A later batch works although the data of the earlier ones are out of reach."""
    put(spark, f"{tmp_path}/source", [1, 2], "a")
    run(spark, tmp_path, key="id")
    (tmp_path / "target/data").rename(tmp_path / "away")
    put(spark, f"{tmp_path}/source", [2, 3], "b")
    run(spark, tmp_path, key="id")
    new = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/target/data")
    assert [r["id"] for r in new.collect()] == [3]


def test_transform_and_no_key(spark, tmp_path):
    put(spark, f"{tmp_path}/source", [1, 1, 2], "a")
    run(spark, tmp_path, transform=lambda d: d.withColumn("id", F.col("id") * 10).filter("id > 0"))
    assert [i for i, _ in rows(spark, tmp_path)] == [10, 10, 20]


def test_progress_is_told(spark, tmp_path):
    put(spark, f"{tmp_path}/source", [1, 2, 3], "a")
    told = []
    listener = I.Progress(lambda p, error: told.append((p, error)))
    spark.streams.addListener(listener)
    try:
        run(spark, tmp_path)
        for _ in range(50):
            if any(p is None for p, _ in told):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert sum(p[1] for p, _ in told if p) == 3 and told[-1] == (None, None)


def test_waiting_for_a_manifest(spark, tmp_path):
    path = f"{tmp_path}/manifest.csv"
    with pytest.raises(TimeoutError):
        I.wait_for_rows(spark, path, "id long", every=0.05, at_most=0.2)
    (tmp_path / "manifest.csv").write_text("id\n")
    with pytest.raises(TimeoutError):  # a header alone is no row
        I.wait_for_rows(spark, path, "id long", every=0.05, at_most=0.2)
    threading.Timer(0.6, lambda: (tmp_path / "manifest.csv").write_text("id\n7\n")).start()
    assert [r["id"] for r in I.wait_for_rows(spark, path, "id long", every=0.2, at_most=30).collect()] == [7]


def test_nothing_taken_in(spark, tmp_path):
    assert I.read_ingested(spark, f"{tmp_path}/target", SCHEMA).collect() == [] == I.commits(spark, f"{tmp_path}/target").collect()
