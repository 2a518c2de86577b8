"""Streams against the batch forms of the same operators, over several micro-batches."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidewire.operators import dedup
from tidewire.sources.tables import seeds
from tidewire.streaming import streams

START = datetime(2024, 1, 1)


def as_stream(spark, tmp_path, parts, schema):
    """A file stream that takes one of ``parts`` a micro-batch."""
    where = str(tmp_path / "in")
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(where)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(where)


def drained(spark, tmp_path, df, mode="append"):
    name = f"t{uuid.uuid4().hex}"
    run = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert run.exception() is None
    return spark.table(name)


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_change_status_follows_versions_across_batches(spark, tmp_path):
    schema = "seq long, site string, url string, content string"
    rows = [(i, "s" if i % 3 else None, f"u{i % 4}", (None, "a", "a ", "b")[i * 7 % 11 % 4]) for i in range(60)]
    stream = as_stream(spark, tmp_path, [rows[:20], rows[20:25], rows[25:]], schema)
    got = drained(spark, tmp_path, streams.change_status(stream))
    want = dedup.change_status(spark.createDataFrame(rows, schema))
    columns = ("site", "url", "seq", "fp", "status")
    assert rows_of(got, *columns) == rows_of(want, *columns)


def test_tumbling_counts(spark, tmp_path):
    schema = "ts timestamp, kind string"
    rows = [(START + timedelta(minutes=7 * i), "ab"[i % 2]) for i in range(50)] + [(None, "a")]
    stream = as_stream(spark, tmp_path, [rows[:25], rows[25:]], schema)
    want = rows_of(streams.tumbling_counts(spark.createDataFrame(rows, schema), "ts", ["kind"]), "start", "kind", "n")
    assert sum(r[2] for r in want) == 50
    got = drained(spark, tmp_path, streams.tumbling_counts(stream, "ts", ["kind"]), "complete")
    assert rows_of(got, "start", "kind", "n") == want


def test_first_seen_forgets_after_the_watermark(spark, tmp_path):
    schema = "ts timestamp, k string"
    rows = [(START, "x"), (START + timedelta(minutes=1), "x"), (START, None), (START + timedelta(minutes=2), "y")]
    stream = as_stream(spark, tmp_path, [rows[:2], rows[2:], rows[:1]], schema)
    assert rows_of(drained(spark, tmp_path, streams.first_seen(stream, ["k"])), "k") == sorted([("x",), ("y",), (None,)], key=repr)
    assert drained(spark, tmp_path, streams.first_seen(stream, ["k"], "ts")).count() == 3


def test_sessions_retention_and_liveness(spark):
    beats = spark.createDataFrame([("w", START + timedelta(seconds=s)) for s in (0, 5, 10, 30)] + [("v", START + timedelta(seconds=400)), ("u", None)], "worker string, ts timestamp")
    got = rows_of(streams.sessions(beats, "ts", ["worker"]), "worker", "n")
    assert got == [("v", 1), ("w", 1), ("w", 3)]
    now = START + timedelta(seconds=401)
    assert rows_of(streams.liveness(beats, "worker", "ts", now=now), "worker", "online") == [("u", False), ("v", True), ("w", False)]
    assert streams.retained(beats, "ts", "380 seconds", now).count() == 2
    assert beats.where(F.col("ts").isNull()).count() == 1


def test_sets_with_a_lifetime(spark, tmp_path):
    schema = "site string, fp string, ts timestamp"
    at = lambda s: START + timedelta(seconds=s)
    # the set lives 10 s from its first key on, however often it is asked
    rows = [("s", "a", at(0)), ("s", "a", at(9)), ("s", "b", at(9.5)), ("s", "a", at(10)), ("s", "b", at(11)), ("t", "a", at(11)), ("s", "a", at(19.9)), (None, "a", at(0)), (None, "a", at(30))]
    stream = as_stream(spark, tmp_path, [rows[:3], rows[3:6], rows[6:]], schema)
    got = drained(spark, tmp_path, streams.seen_within(stream, ["site"], "fp", "ts", 10))
    fresh = {(r["site"], r["ts"]): r["fresh"] for r in got.collect()}
    assert fresh == {("s", at(0)): True, ("s", at(9)): False, ("s", at(9.5)): True, ("s", at(10)): True, ("s", at(11)): True, ("t", at(11)): True, ("s", at(19.9)): False, (None, at(0)): True, (None, at(30)): True}


def test_refresh_and_metrics(spark, tmp_path):
    schema = "k string, value int, ts timestamp"
    rows = [("a", 3, START), ("a", 30, START + timedelta(seconds=100)), ("b", 7, START)]
    stream = as_stream(spark, tmp_path, [rows[:2], rows[2:]], schema)
    due = drained(spark, tmp_path, streams.refresh_due(stream, "k", "ts", 900), "complete")
    assert rows_of(due, "k", "next_ts") == [("a", START + timedelta(seconds=1000)), ("b", START + timedelta(seconds=900))]
    assert rows_of(streams.refresh_due(spark.createDataFrame(rows, schema), "k", "ts", 900, START + timedelta(seconds=950)), "k") == [("b",)]
    got = drained(spark, tmp_path, streams.metrics(stream, ["k"], [5, 50]), "complete")
    assert rows_of(got, "k", "n", "total", "last", "le_5", "le_50") == [("a", 2, 33, 30, 1, 2), ("b", 1, 7, 7, 0, 1)]


def test_dimension_is_read_again_when_it_changes(spark, tmp_path):
    now = [("a", 1)]
    dimension = streams.Dimension(lambda: spark.createDataFrame(now, "k string, v int"))
    seen = []
    stream = as_stream(spark, tmp_path, [[("a",)], [("a",)], [("b",)]], "k string")

    def write(batch):
        seen.append(sorted((r["k"], r["v"]) for r in batch.collect()))
        now[:] = [("a", 1)] if len(seen) < 2 else [("b", 2)]

    streams.with_dimension(stream, dimension, "k", write, str(tmp_path / "cp")).awaitTermination(120)
    assert seen == [[("a", 1)], [("a", 1)], [("b", 2)]] and dimension.reads == 2


def test_messages_are_a_stream_of_seeds(spark, tmp_path):
    (tmp_path / "queue").mkdir()
    (tmp_path / "queue" / "one").write_text('http://a\n{"u": "http://b", "site": "s"}\n\n')
    got = drained(spark, tmp_path, seeds(streams.messages(spark, str(tmp_path / "queue"))))
    assert rows_of(got, "url", "site") == [("http://a", None), ("http://b", "s")]
