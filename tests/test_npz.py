"""NPZ files read in ranges and written with a commit."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.sources.npz import NpzReader, NpzSource


@pytest.fixture
def npz(spark):
    spark.dataSource.register(NpzSource)
    return lambda path, **o: spark.read.format("npz").options(**o).load(str(path))


def frames_of(tmp_path):
    rng = np.random.default_rng(0)
    out = {}
    for i, (n, save) in enumerate([(7, np.savez), (5, np.savez_compressed), (1, np.savez)]):
        a = rng.integers(0, 255, (n, 4, 3, 2)).astype([np.uint8, np.float32, np.float64][i])
        (tmp_path / f"d{i}").mkdir()
        save(tmp_path / f"d{i}" / "clip.npz", frames=a, other=np.zeros(3))
        out[f"d{i}/clip.npz"] = a
    return out


def test_frames_are_read_in_ranges_by_several_tasks(spark, npz, tmp_path):
    want = frames_of(tmp_path)
    df = npz(tmp_path, array="frames", ndim=4, partitionBytes=200)
    assert df.rdd.getNumPartitions() == 4 + 3 + 1  # two frames of 96 bytes each
    rows = df.collect()
    assert len(rows) == 13 and all(r["shape"] == [4, 3, 2] and r["error"] is None for r in rows)
    for name, a in want.items():
        own = sorted((r for r in rows if r["path"].endswith(name)), key=lambda r: r["entry"])
        assert [r["entry"] for r in own] == list(range(len(a)))
        assert np.array_equal(np.array([r["values"] for r in own]).reshape(a.shape), a.astype(np.float32))


def test_a_bad_file_is_reported_alone(spark, npz, tmp_path):
    frames_of(tmp_path)
    (tmp_path / "text.npz").write_text("no archive")
    np.savez(tmp_path / "flat.npz", frames=np.zeros((3, 4)))
    np.savez(tmp_path / "named.npz", something=np.zeros(3))
    np.savez(tmp_path / "object.npz", frames=np.array([{}, {}], object))
    np.savez(tmp_path / "none.npz", frames=np.zeros((0, 4, 3, 2)))
    whole = (tmp_path / "d0" / "clip.npz").read_bytes()
    cut = tmp_path / "cut.npz"
    cut.write_bytes(whole[: len(whole) // 2])
    (tmp_path / "_temporary-x").mkdir()
    (tmp_path / "_temporary-x" / "clip.npz").write_bytes(whole)
    rows = npz(tmp_path, array="frames", ndim=4).collect()
    errors = {r["path"].rsplit("/", 1)[1]: r["error"] for r in rows if r["error"]}
    assert errors.keys() == {"text.npz", "flat.npz", "named.npz", "object.npz", "cut.npz"}
    assert "2 dimensions, not 4" in errors["flat.npz"] and "no array frames" in errors["named.npz"]
    assert sum(r["error"] is None for r in rows) == 13
    with pytest.raises(Exception, match="flat.npz"):
        npz(tmp_path, array="frames", ndim=4, strict="true", pattern="flat*").collect()


def test_round_trip_of_several_files_by_several_tasks(spark, npz, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(250).select((F.col("id") + (1 << 40)).alias("id"), F.array(*[(F.col("id") * 3 + i).cast("float") for i in range(5)]).alias("values")).repartition(4)
    df.write.format("npz").option("fileRows", 30).mode("overwrite").save(path)
    files = sorted((tmp_path / "out").glob("*.npz"))
    assert len(files) >= 8 and not list((tmp_path / "out").glob("_temporary*"))
    assert sum(f["rows"] for f in json.loads((tmp_path / "out" / "_files.json").read_text())) == 250
    vectors = npz(path).select("path", "entry", "values")
    ids = npz(path, array="ids", ndim=1, type="long").select("path", "entry", (F.col("values")[0] - (1 << 40)).alias("id"))
    got = {r["id"]: r["values"] for r in vectors.join(ids, ["path", "entry"]).collect()}
    assert got == {i: [float(3 * i + j) for j in range(5)] for i in range(250)}
    # overwriting replaces, appending adds
    df.limit(10).write.format("npz").mode("overwrite").save(path)
    assert npz(path).count() == 10
    df.limit(4).write.format("npz").mode("append").save(path)
    assert npz(path).count() == 14


def test_a_failed_write_leaves_what_was_there(spark, npz, tmp_path):
    path = str(tmp_path / "out")
    good = spark.createDataFrame([(1, [1.0, 2.0])], "id long, values array<float>")
    good.write.format("npz").mode("overwrite").save(path)
    for bad in ([(2, [1.0]), (3, [1.0, 2.0])], [(4, None)], [(None, [1.0])]):
        with pytest.raises(Exception, match="values|id"):
            spark.createDataFrame(bad, good.schema).coalesce(1).write.format("npz").mode("overwrite").save(path)
        assert npz(path).count() == 1 and not list((tmp_path / "out").glob("_temporary*"))
    with pytest.raises(Exception, match="id and values"):
        spark.range(1).write.format("npz").mode("overwrite").save(path)


def test_nothing_to_read_or_write(spark, npz, tmp_path):
    assert npz(tmp_path).collect() == []
    with pytest.raises(FileNotFoundError):
        NpzReader({"path": str(tmp_path / "no")}).partitions()
    spark.createDataFrame([], "id long, values array<float>").write.format("npz").mode("overwrite").save(str(tmp_path / "empty"))
    assert npz(tmp_path / "empty").collect() == []
