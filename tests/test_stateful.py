"""Streams with state and timers: silence, restarts from the checkpoint, batch forms of the same operators."""

from __future__ import annotations

import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.test_streams import as_stream, rows_of
from tidewire.operators import dedup, folds
from tidewire.streaming import stateful

START = datetime(2024, 1, 1)


class Run:
    """A query that may be stopped and started again; its rows are those its sink has committed."""

    def __init__(self, spark, tmp_path, df):
        self.spark, self.df, self.out, self.cp = spark, df, str(tmp_path / "out"), str(tmp_path / "cp")

    def started(self, once=False):
        trigger = {"availableNow": True} if once else {"processingTime": "200 milliseconds"}
        self.query = self.df.writeStream.format("parquet").option("path", self.out).option("checkpointLocation", self.cp).trigger(**trigger).start()
        return self

    def rows(self, *cols):
        try:
            return rows_of(self.spark.read.schema(self.df.schema).parquet(self.out), *cols)
        except Exception:
            return []

    def until(self, n, *cols, seconds=60):
        """Waits for n rows, and then a little for any too many."""
        end = time.time() + seconds
        while time.time() < end and len(self.rows(*cols)) < n:
            assert self.query.exception() is None
            time.sleep(0.3)
        time.sleep(1)
        return self.rows(*cols)

    def done(self):
        assert self.query.awaitTermination(120) and self.query.exception() is None
        return self

    def stopped(self):
        self.query.stop()
        return self


def now():
    return datetime.now(timezone.utc).replace(tzinfo=None)


def test_changes_follow_versions_through_a_restart(spark, tmp_path):
    schema = "seq long, site string, url string, content string"
    rows = [(i, "s" if i % 3 else None, f"u{i % 4}", (None, "a", "a ", "b")[i * 7 % 11 % 4]) for i in range(60)]
    run = Run(spark, tmp_path, stateful.changes(as_stream(spark, tmp_path, [rows[:20], rows[20:25]], schema)))
    run.started(once=True).done()
    as_stream(spark, tmp_path, [rows[25:]], schema)
    run.started(once=True).done()
    columns = ("site", "url", "seq", "fp", "status")
    assert run.rows(*columns) == rows_of(dedup.change_status(spark.createDataFrame(rows, schema)), *columns)


def test_pages_fall_due_in_silence_and_after_a_restart(spark, tmp_path):
    t = now()
    visits = [("a", t), ("a", t - timedelta(seconds=30)), ("late", t - timedelta(days=1)), ("b", t + timedelta(seconds=20)), ("none", None)]
    run = Run(spark, tmp_path, stateful.refresh_events(as_stream(spark, tmp_path, [visits], "page string, ts timestamp"), "page", "ts", 2)).started()
    assert {"a", "late"} <= {r[0] for r in run.until(2, "page")}
    assert run.rows("page", "due")[0] == ("a", t + timedelta(seconds=2))
    run.stopped().started()  # the timer of b was set before and is still to fire
    assert run.until(3, "page") == [("a",), ("b",), ("late",)]
    run.stopped()


def test_a_worker_goes_offline_when_nothing_comes(spark, tmp_path):
    t = now()
    beats = [("w", t - timedelta(seconds=1)), ("w", t), ("old", t - timedelta(hours=1)), ("x", None), ("v", t + timedelta(days=1))]
    run = Run(spark, tmp_path, stateful.liveness_events(as_stream(spark, tmp_path, [beats], "worker string, ts timestamp"), "worker", "ts", 20)).started()
    assert {("v", "online"), ("w", "online")} <= set(run.until(2, "worker", "state"))
    run.stopped().started()
    assert run.until(3, "worker", "state") == [("v", "online"), ("w", "offline"), ("w", "online")]
    as_stream(spark, tmp_path, [[("w", now())]], "worker string, ts timestamp")
    assert run.until(4, "worker", "state").count(("w", "online")) == 2
    run.stopped()


def test_changes_settle(spark, tmp_path):
    rows = [("a", START, 1), ("a", START + timedelta(seconds=2), 2), ("a", START + timedelta(seconds=1), 3), ("b", START, None), ("c", None, 4), (None, START, 5)]
    run = Run(spark, tmp_path, stateful.settled(as_stream(spark, tmp_path, [rows], "k string, ts timestamp, v int"), "k", "ts", 1)).started()
    assert run.until(3, "k", "v", "changes") == [("a", 2, 3), ("b", None, 1), (None, 5, 1)]
    run.stopped()


SIGNALS = [("k" if i % 5 else "m", START + timedelta(seconds=i * 2 + (30 if i > 25 else 0) + i % 3 / 8)) for i in range(60)] + [("k", None), (None, START)]


def test_idle_streaks_and_their_stream(spark, tmp_path):
    df = spark.createDataFrame(SIGNALS, "k string, ts timestamp")
    want = rows_of(folds.idle_streaks(df, "k", "ts", 6, 5), "k", "ts", "streak", "closes")
    assert sum(r[3] for r in want) >= 6 and len(want) == 61
    run = Run(spark, tmp_path, stateful.idle_events(as_stream(spark, tmp_path, [SIGNALS[:20], SIGNALS[20:33]], "k string, ts timestamp"), "k", "ts", 6, 5))
    run.started(once=True).done()
    as_stream(spark, tmp_path, [SIGNALS[33:]], "k string, ts timestamp")
    assert run.started(once=True).done().rows("k", "at", "streak", "closes") == want


def test_debounce_and_its_stream(spark, tmp_path):
    rows = [(k, START + timedelta(seconds=s), i) for i, (k, s) in enumerate((k, s) for k in ("a", "b") for s in (0, 0.4, 0.9, 1.0, 1.5, 2.0, 2.1, 9, 9.5))] + [("a", None, 99), (None, START, 98)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v long")
    want = rows_of(folds.debounced(df, "k", "ts", 1.0), "k", "ts", "v")
    assert [(k, (t - START).total_seconds()) for k, t, _ in want] == [(k, s) for k in ("a", "b") for s in (0, 1, 2, 9)]
    run = Run(spark, tmp_path, stateful.accepted(as_stream(spark, tmp_path, [rows[:5] + rows[9:14], rows[5:9] + rows[14:18]], df.schema), "k", "ts", 1.0))
    assert run.started(once=True).done().rows("k", "ts", "v") == want
    equal = spark.createDataFrame([("a", START, 1), ("a", START, 2)], "k string, ts timestamp, v long")
    assert folds.debounced(equal, "k", "ts").count() == 1 and folds.debounced(equal.limit(0), "k", "ts").count() == 0


@pytest.mark.parametrize("parts", [1, 3])
def test_sets_with_a_lifetime(spark, tmp_path, parts):
    at = lambda s: START + timedelta(seconds=s)
    first = [("s", "x", at(0)), ("s", "x", at(5)), ("s", "y", at(6)), ("t", "x", at(1)), (None, "x", at(2)), ("s", None, at(3)), ("s", "z", None)]
    second = [("s", "x", at(9)), ("s", "x", at(10)), ("s", "y", at(11)), ("s", "y", at(12))]
    schema = "scope string, k string, ts timestamp"
    run = Run(spark, tmp_path, stateful.seen_in_scope(as_stream(spark, tmp_path, [first], schema), ["scope"], "k", "ts", 10, parts=parts))
    run.started(once=True).done()
    as_stream(spark, tmp_path, [second, [("u", "q", at(90_000))], [("s", "x", at(90_001))]], schema)
    got = run.started(once=True).done().rows("scope", "k", "ts", "fresh")
    old = {("s", "x", at(5)), ("s", "x", at(9))} | ({("s", "y", at(12))} if parts == 1 else set())
    if parts == 1:
        assert {r[:3] for r in got if not r[3]} == old
    else:  # each part of the set has a first key of its own
        assert old <= {r[:3] for r in got if not r[3]}
    assert len(got) == 12
    assert spark.read.parquet(run.out).where(F.col("fresh")).count() >= 7
