"""Task states and stated times, case by case."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewire.operators import ops, quality


@pytest.mark.parametrize(("events", "most", "want"), [
    (["started"], None, (0, "processing", None, False)),
    (["submitted"], None, (0, "pending", 0, True)),
    (["started", "failed"], None, (1, "pending", 1 + 2, True)),
    (["started", "failed", "started"], None, (1, "processing", None, False)),
    (["started", "failed"] * 2, None, (2, "pending", 3 + 4, False)),
    (["started", "failed"] * 4, None, (3, "failed", None, False)),
    (["started", "failed"] * 2, 1, (1, "failed", None, False)),
    (["started", "failed"], 0, (0, "failed", None, False)),
    (["failed", "failed"], None, (0, "pending", 0, True)),
    (["started", "failed", "failed"], None, (1, "pending", 1 + 2, True)),
    (["started", "completed", "failed", "started", "failed"], None, (0, "completed", None, False)),
    (["started", "failed"] * 5 + ["started", "completed"], None, (3, "completed", None, False)),
    (["unknown", "started"], None, (0, "processing", None, False)),
])
def test_task_states(spark, events, most, want):
    rows = [(1, e, datetime(2024, 1, 1, 0, i), most) for i, e in enumerate(events)] + [(None, "failed", datetime(2024, 1, 1), None), (2, "started", None, None)]
    df = spark.createDataFrame(rows, "task_id long, event string, at timestamp, max_retries int")
    found = ops.task_states(df, F.lit("2024-01-01 00:05:00").cast("timestamp")).collect()
    assert [r["task_id"] for r in found] == [1]
    due = None if want[2] is None else datetime(2024, 1, 1, 0, want[2])
    assert tuple(found[0])[1:] == (want[0], want[1], due, want[3])


@pytest.mark.parametrize(("text", "want"), [
    ("2024-01-31T12:00:00+08:00", "2024-01-31 12:00:00"), ("2024-01-31T12:00:00Z", "2024-01-31 12:00:00"), ("2024-01-31 12:00:00.25", "2024-01-31 12:00:00.25"), ("20240131T120000-0330", "2024-01-31 12:00:00"),
    ("2024-01-31", "2024-01-31 00:00:00"), ("20240131", "2024-01-31 00:00:00"), ("2024-01-31T09:05", "2024-01-31 09:05:00"), ("2024-13-01", None), ("2024", None), ("yesterday", None), ("", None), (None, None), ("2024-01-31T25:00", None),
])
def test_written_times(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(quality.written_time(F.col("t")).cast("string")).first()[0]
    assert got == want


def test_the_next_field_counts_where_one_cannot_be_read(spark):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    rows = [("2024-01-31T12:00:00+08:00", None, None), ("soon", "", "2024-01-31T00:00:00"), (None, "never", None)]
    df = spark.createDataFrame(rows, "crawl_time string, extraction_time string, timestamp string")
    assert [r[0] for r in df.select(quality.age_hours(now, *map(F.col, df.columns))).collect()] == [12, 24, None]
