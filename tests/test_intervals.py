"""Interval containment against brute force."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tessella.operators import intervals as V

START = datetime.datetime(2020, 1, 1)


def brute(moments, spans):
    out = []
    for s, i, t in moments:
        near = [(-(a - START).total_seconds(), k) for u, k, a, b in spans if u == s and s is not None and k is not None and t and a and a <= t and (b is None or t <= b)]
        out.append((i, min(near)[1] if near else None))
    return sorted(map(str, out))


@pytest.mark.parametrize(("piece", "days"), [(50_000, 30), (7, 30), (3, 400)])
def test_against_brute_force(spark, monkeypatch, piece, days):
    """A subject with most rows, nested and touching intervals, open and empty ones, ties and repeated rows."""
    monkeypatch.setattr(V, "PIECE", piece)
    rnd = random.Random(piece)
    when = lambda: START + datetime.timedelta(hours=rnd.randrange(0, 6000, 4))
    subject = lambda: rnd.choice([1, 1, 1, 1, 2, 3, None])
    moments = [(subject(), i, rnd.choice([when()] * 8 + [None])) for i in range(300)]
    moments += moments[:5]
    spans = []
    for k in range(120):
        a = when()
        spans.append((subject(), k if k % 40 else None, rnd.choice([a] * 9 + [None]), rnd.choice([None, a, a - datetime.timedelta(1), *[a + datetime.timedelta(hours=rnd.choice([4, 40, 400, 4000])) for _ in range(4)]])))
    spans += [(1, 900, spans[3][2], spans[3][3]), (1, 901, START - datetime.timedelta(900), START + datetime.timedelta(900)), (9, 902, START, None)]
    m = spark.createDataFrame(moments, "subject_id long, row long, at timestamp").withColumn("bucket", F.lit("x")).repartition(4)
    s = spark.createDataFrame(spans, "subject_id long, interval_id long, start timestamp, end timestamp").repartition(3)
    got = V.interval_of(m, s, days)
    assert got.columns == [*m.columns, "interval_id"]
    assert sorted(map(str, [(r["row"], r["interval_id"]) for r in got.collect()])) == brute(moments, spans)


def test_a_hot_subject_is_cut_in_time(spark, monkeypatch):
    monkeypatch.setattr(V, "PIECE", 100)
    sizes = spark.sparkContext.accumulator(0)
    most = []
    sweep = V._sweep

    def watched(left, right):
        assert len(left) <= 900, len(left)
        sizes.add(1)
        return sweep(left, right)

    monkeypatch.setattr(V, "_sweep", watched)
    m = spark.range(3000).select(F.lit(1).cast("long").alias("subject_id"), "id", F.timestamp_seconds(F.col("id") * 600).alias("at"))
    s = spark.range(300).select(F.lit(1).cast("long").alias("subject_id"), F.col("id").alias("interval_id"), F.timestamp_seconds(F.col("id") * 6000).alias("start"), F.timestamp_seconds(F.col("id") * 6000 + 5999).alias("end"))
    most = V.interval_of(m, s).collect()
    assert all(r["interval_id"] == r["id"] // 10 for r in most) and sizes.value >= 10


def test_nothing_to_meet(spark):
    m = spark.createDataFrame([(1, 5, START)], "subject_id long, row long, at timestamp")
    s = spark.createDataFrame([(1, 2, START, None)], "subject_id long, interval_id long, start timestamp, end timestamp")
    assert [r["interval_id"] for r in V.interval_of(m, s.limit(0)).collect()] == [None]
    assert V.interval_of(m.limit(0), s).collect() == []
    assert [r["interval_id"] for r in V.interval_of(m, s).collect()] == [2]


def test_notes_of_the_same_admission(spark):
    day = lambda n: START + datetime.timedelta(n)
    studies = spark.createDataFrame([(1, 10, day(3)), (1, 11, day(50)), (2, 12, day(3))], "subject_id long, study_id long, study_datetime timestamp")
    # the note of day 2.5 is nearer to study 10, but of another subject; that of day 11 lies outside
    notes = spark.createDataFrame([(1, 100, day(1)), (1, 101, day(6)), (2, 102, day(2.5)), (1, 103, day(11))], "subject_id long, note_id long, note_datetime timestamp")
    stays = spark.createDataFrame([(1, 7, day(0), day(10)), (1, 8, day(49), day(60))], "subject_id long, interval_id long, start timestamp, end timestamp")
    got = {r["study_id"]: (r["admission_id"], r["note_id"]) for r in V.note_by_admission(studies, notes, stays, 5).collect()}
    assert got == {10: (7, 100), 11: (8, None), 12: (None, None)}
