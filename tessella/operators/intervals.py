"""Which interval of its subject a moment lies in, by a sweep over buckets of time.

Intervals are sent to the buckets of time that they cover and moments to the one
they are in; a bucket with many moments is cut into shorter pieces, and pieces
are dealt to tasks by hash.  A task sweeps starts and moments of a subject in
order of time, with the open intervals in a heap, so no pairs are formed and a
subject of any size is many pieces.
"""

from __future__ import annotations

import bisect
import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.operators.cohort import nearest_note
from tessella.sources.scratch import stored

#: Distinct moments of a piece at most, and of a task's shard, on average.
PIECE = 50_000
_DAY = 86_400_000_000


def _micros(c: str):
    return F.unix_micros(F.col(c).cast("timestamp"))


def _sweep(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """For each moment the interval that holds it and started last, the smaller id at ties."""
    out, opened, of = [], [], None
    # an interval may have come with several pieces
    waiting = sorted(set(zip(right["subject_id"], right["first"], right["last"], right["interval_id"], strict=True)))
    i = 0
    for subject, t in sorted(zip(left["subject_id"], left["t"], strict=True)):
        if subject != of:
            of, opened = subject, []
            i = bisect.bisect_left(waiting, (subject,), i)
        while i < len(waiting) and waiting[i][0] == subject and waiting[i][1] <= t:
            heapq.heappush(opened, (-waiting[i][1], waiting[i][3], waiting[i][2]))
            i += 1
        while opened and opened[0][2] < t:
            heapq.heappop(opened)
        if opened:
            out.append((subject, t, opened[0][1]))
    return pd.DataFrame(out, columns=["subject_id", "t", "interval_id"]).astype("int64")


def interval_of(moments: DataFrame, intervals: DataFrame, days: int = 30) -> DataFrame:
    """``moments`` (``subject_id, at``, and more) with ``interval_id``: the interval of the subject that holds ``at``.

    ``intervals`` has ``subject_id, interval_id, start, end``; both ends belong to
    it, and without an end it is still open.  Of several the one that started
    last is taken, the smaller id at ties; without one it is null, and so for
    moments or intervals without subject, time or start.  Repeated rows are
    answered each.  Buckets are ``days`` wide: an interval is sent as often as
    it covers buckets that are not after the last moment.
    """
    width = days * _DAY
    # moments are equal where subject and time are, however many rows have them
    points = moments.select("subject_id", _micros("at").alias("t")).filter("subject_id IS NOT NULL AND t IS NOT NULL").distinct()
    points = stored(points, "points")
    shards = max(1, -(-points.count() // PIECE))
    bucket = lambda c: F.floor(F.col(c) / F.lit(width)).cast("long")
    points = points.withColumn("bucket", bucket("t"))
    pieces = points.groupBy("subject_id", "bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(PIECE)).cast("int").alias("pieces"))
    final = F.broadcast(points.agg(F.max("t").alias("_final")))  # one row
    spans = intervals.filter("subject_id IS NOT NULL AND interval_id IS NOT NULL").select("subject_id", "interval_id", _micros("start").alias("first"), _micros("end").alias("_end")).crossJoin(final)
    spans = spans.withColumn("last", F.least(F.coalesce("_end", "_final"), F.col("_final"))).filter("first <= last")
    spans = spans.select("subject_id", "interval_id", "first", "last", F.explode(F.sequence(bucket("first"), bucket("last"))).alias("bucket"))

    def piece(t):
        """The piece of a time, kept within its bucket."""
        inside = F.least(F.greatest(t - F.col("bucket") * width, F.lit(0)), F.lit(width - 1))
        return F.floor(inside / F.lit(width) * F.col("pieces")).cast("int")

    key = ["subject_id", "bucket"]
    asked = points.join(pieces, key).select("subject_id", "bucket", piece(F.col("t")).alias("piece"), "t")
    told = spans.join(pieces, key).select("subject_id", "bucket", F.explode(F.sequence(piece(F.col("first")), piece(F.col("last")))).alias("piece"), "interval_id", "first", "last")
    shard = F.pmod(F.xxhash64("subject_id", "bucket", "piece"), F.lit(shards)).cast("int").alias("shard")
    asked, told = asked.select(shard, "subject_id", "t"), told.select(shard, "subject_id", "interval_id", "first", "last")
    found = asked.groupBy("shard").cogroup(told.groupBy("shard")).applyInPandas(_sweep, "subject_id long, t long, interval_id long")
    marked = moments.withColumn("_t", _micros("at"))
    return marked.join(found.select("subject_id", F.col("t").alias("_t"), "interval_id"), ["subject_id", "_t"], "left").select(*moments.columns, "interval_id")


def note_by_admission(studies: DataFrame, notes: DataFrame, admissions: DataFrame, days: int) -> DataFrame:
    """Each study with the note nearest in time of the admission that both lie in, within ``days``; the earlier one at ties.

    ``studies`` has ``subject_id, study_id, study_datetime``, ``notes`` the same
    for notes.  A study outside all admissions, or alone in its own, has none.
    """
    of = lambda df, time: interval_of(df.withColumn("at", F.col(time)), admissions).drop("at")
    asked = stored(of(studies, "study_datetime").select(F.col("interval_id").alias("subject_id"), "study_id", "study_datetime"), "asked")
    told = of(notes, "note_datetime").filter("interval_id IS NOT NULL").select(F.col("interval_id").alias("subject_id"), "note_id", "note_datetime")
    found = nearest_note(asked, told, days).select("study_id", F.col("subject_id").alias("admission_id"), "note_id", "gap_us")
    return studies.join(found, "study_id", "left").select(*studies.columns, "admission_id", "note_id", "gap_us")
