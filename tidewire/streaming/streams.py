"""Structured Streaming forms of the keyed and windowed operators.

Fed with the same rows in order, each gives what its batch form gives. All but the change follower are
built-in stateful operators, so they take batch tables as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from ..functions.text import content_fingerprint


def first_seen(stream: DataFrame, keys: Sequence[str], ts: str | None = None, late: str = "1 hour") -> DataFrame:
    """The first row to arrive for each key. With ``ts`` a key is forgotten ``late`` after its event time; else state grows with the keys."""
    if ts is None:
        return stream.dropDuplicates(list(keys))
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def tumbling_counts(stream: DataFrame, ts: str, by: Sequence[str] = (), width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """(start, ``by``, n) for each window. Rows without a time are in no window."""
    counted = stream.withWatermark(ts, late).groupBy(F.window(ts, width), *by).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("start"), *by, "n")


def sessions(stream: DataFrame, ts: str, by: Sequence[str], gap: str = "6 seconds", late: str = "1 minute") -> DataFrame:
    """(``by``, start, last, n): runs of rows of which none follows the one before after more than ``gap``."""
    found = stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap), *by).agg(F.min(ts).alias("start"), F.max(ts).alias("last"), F.count(F.lit(1)).alias("n"))
    return found.select(*by, "start", "last", "n")


def retained(rows: DataFrame, ts: str, age: str, now: Column | datetime | None = None) -> DataFrame:
    """Rows no older than ``age`` (an interval, as "7 days"); rows without a time go."""
    at = F.current_timestamp() if now is None else F.lit(now)
    return rows.where(F.col(ts) >= at - F.expr(f"interval {age}"))


def liveness(beats: DataFrame, key: str, ts: str, limit: str = "300 seconds", now: Column | datetime | None = None) -> DataFrame:
    """(key, last, online): offline once the last beat is over ``limit`` ago. On a stream, for update or complete mode."""
    at = F.current_timestamp() if now is None else F.lit(now)
    last = beats.groupBy(key).agg(F.max(ts).alias("last"))
    return last.withColumn("online", F.coalesce(F.col("last") >= at - F.expr(f"interval {limit}"), F.lit(False)))


def change_status(versions: DataFrame) -> DataFrame:
    """(site, url, seq, fp, status) of a stream of versions: created, modified or unchanged against the last one of the URL.

    One fingerprint a URL is kept as state. Versions of a micro-batch go in order of ``seq``; one that
    comes in a later batch follows what came before, whatever its ``seq``.
    """

    def follow(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(parts).sort_values("seq", kind="stable", ignore_index=True)
        before = rows["fp"].shift(1)
        if state.exists:
            before.iloc[0] = state.get[0]
        state.update((rows["fp"].iloc[-1],))
        status = np.where(before.isna(), "created", np.where(before != rows["fp"], "modified", "unchanged"))
        yield pd.DataFrame({"site": key[0], "url": key[1], "seq": rows["seq"], "fp": rows["fp"], "status": status})

    # the fingerprint stands for the content from here on, so contents are neither shuffled nor kept
    named = versions.select("site", "url", F.col("seq").cast("long").alias("seq"), content_fingerprint(F.col("content")).alias("fp"))
    return named.groupBy("site", "url").applyInPandasWithState(follow, "site string, url string, seq long, fp string, status string", "fp string", "append", GroupStateTimeout.NoTimeout)


def seen_within(stream: DataFrame, scope: Sequence[str], key: str, ts: str, lifetime: float) -> DataFrame:
    """``stream`` (scope, key, ts) with ``fresh``: whether the key is new to its scope's set.

    A set lives ``lifetime`` seconds from its first key on and is then dropped as a whole, whatever
    came meanwhile. Rows of a micro-batch go in order of ``ts``. State is one set of 64-bit hashes a scope.
    """
    schema = StructType([*(stream.schema[c] for c in (*scope, key, ts))]).add("fresh", "boolean")

    def follow(at: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(parts).sort_values(["__ts", "__hash"], kind="stable", ignore_index=True)
        began, known = (state.get[0], set(state.get[1])) if state.exists else (None, set())
        fresh = []
        for t, h in zip(rows["__ts"].tolist(), rows["__hash"].tolist(), strict=True):
            if began is None or t - began >= lifetime * 1_000_000:
                began, known = t, set()
            fresh.append(h not in known)
            known.add(h)
        state.update((began, sorted(known)))
        out = rows.drop(columns=["__ts", "__hash"])
        out["fresh"] = fresh
        yield out

    named = stream.select(*scope, key, ts, F.unix_micros(F.col(ts).cast("timestamp")).alias("__ts"), F.xxhash64(key).alias("__hash"))
    return named.groupBy(*scope).applyInPandasWithState(follow, schema, "began long, known array<long>", "append", GroupStateTimeout.NoTimeout)


def refresh_due(visits: DataFrame, key: str, ts: str, seconds: int = 900, now: Column | datetime | None = None) -> DataFrame:
    """(key, next_ts): when a page is due again after its last visit; with ``now`` only those that are due. On a stream, for update or complete mode."""
    last = visits.groupBy(key).agg((F.max(ts) + F.make_interval(secs=F.lit(seconds))).alias("next_ts"))
    return last if now is None else last.where(F.col("next_ts") <= F.lit(now))


class Dimension:
    """A small table that batches of a stream read, read again only when its checksum changes."""

    def __init__(self, load: Callable[[], DataFrame], most_rows: int = 100_000) -> None:
        self.load, self.most_rows, self.checksum, self.table, self.reads = load, most_rows, None, None, 0

    def current(self) -> DataFrame:
        now = self.load()
        n, checksum = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64(F.struct("*")).cast("decimal(38,0)"))).first()
        if (n, checksum) != self.checksum:
            self.checksum, self.table, self.reads = (n, checksum), now, self.reads + 1
            if n <= self.most_rows:
                self.table = F.broadcast(now)
        return self.table


def with_dimension(stream: DataFrame, dimension: Dimension, on: str, write: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Each micro-batch joined with the dimension as it then is, handed to ``write``."""
    return stream.writeStream.foreachBatch(lambda batch, _: write(batch.join(dimension.current(), on, "left"))).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def metrics(samples: DataFrame, by: Sequence[str], bounds: Sequence[int]) -> DataFrame:
    """Counter (sum), gauge (latest by ``ts``) and cumulative histogram of ``value`` for each label set. On a stream, for update or complete mode."""
    return samples.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.max_by("value", "ts").alias("last"), *[F.count_if(F.col("value") <= b).alias(f"le_{b}") for b in bounds])


def messages(spark: SparkSession, path: str) -> DataFrame:
    """An endless list of messages: lines of text files that arrive in a folder."""
    return spark.readStream.text(path)
