"""Keyed operators with state of their own: values and maps with a lifetime, and timers that fire when no row comes.

All are ``transformWithState`` processors; their state is kept by RocksDB, a key's entries are read and
written one by one, and a restarted query goes on from its checkpoint with the timers that were set.
Operators with timers on the clock (``refresh_events``, ``liveness_events``, ``settled``, ``changes`` with a
lifetime) are for triggers that go on by themselves; for them there is always another batch to come, so
a query that is to take what there is and end would not end.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import StructType

from ..functions.text import content_fingerprint
from ..operators.folds import Streak

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Timers on the clock.
CLOCK = "processingTime"


def keeps_state(spark: SparkSession) -> None:
    """State of this kind needs RocksDB; a session with a provider of its own is left alone."""
    name = "spark.sql.streaming.stateStore.providerClass"
    if "HDFSBacked" in spark.conf.get(name):
        spark.conf.set(name, ROCKS)


def ticking(like: DataFrame) -> DataFrame:
    """A row of nulls every second. A query that was started again runs no batch, and so fires no timer, before something comes; rows without a time are ignored."""
    ticks = like.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    return ticks.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema])


def processed(stream: DataFrame, keys: Sequence[str], processor: StatefulProcessor, added: str, time: str = "none", event_time: str = "", ticks: bool = False) -> DataFrame:
    keeps_state(stream.sparkSession)
    if ticks:
        stream = stream.unionByName(ticking(stream))
    schema = StructType([*(stream.schema[k] for k in keys), *StructType.fromDDL(added)])
    return stream.groupBy(*keys).transformWithStateInPandas(processor, schema, "append", time, eventTimeColumnName=event_time)


class Keyed(StatefulProcessor):
    """What the processors share: rows of a key in order of ``t`` (microseconds), and frames that begin with the key."""

    def __init__(self, keys: Sequence[str]) -> None:
        self.keys = list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def close(self) -> None:
        pass

    def of(self, key: tuple, **columns: list) -> pd.DataFrame:
        n = len(next(iter(columns.values())))
        return pd.DataFrame({k: [v] * n for k, v in zip(self.keys, key, strict=True)} | columns)

    def times(self, rows: Iterator[pd.DataFrame]) -> list[int]:
        return sorted(t for frame in rows for t in frame["t"].dropna().astype("int64").tolist())

    def wakes(self, at_ms: int) -> None:
        """One timer a key, at that time of the clock (at once, if it has passed)."""
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old[0] if isinstance(old, tuple) else old)
        self.handle.registerTimer(max(at_ms, 1))


def in_micros(stream: DataFrame, keys: Sequence[str], ts: str, *others: Column | str) -> DataFrame:
    return stream.select(*keys, F.unix_micros(F.col(ts).cast("timestamp")).alias("t"), *others)


def stamped(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.timestamp_micros(name))


class _Changes(Keyed):
    def __init__(self, keys: Sequence[str], lifetime_ms: int | None) -> None:
        super().__init__(keys)
        self.lifetime_ms = lifetime_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "fp string", self.lifetime_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        all_rows = pd.concat(list(rows)).sort_values("seq", kind="stable")
        last = self.last.get()[0] if self.last.exists() else None
        status = []
        for fp in all_rows["fp"].tolist():
            status.append("created" if last is None else "unchanged" if fp == last else "modified")
            last = fp
        self.last.update((last,))
        yield self.of(key, seq=all_rows["seq"].tolist(), fp=all_rows["fp"].tolist(), status=status)


def changes(versions: DataFrame, lifetime: float | None = None) -> DataFrame:
    """(site, url, seq, fp, status): created, modified or unchanged against the last version of the URL.

    With ``lifetime`` (seconds) a URL that had no version for so long is forgotten, and its next one is created.
    """
    named = versions.select("site", "url", F.col("seq").cast("long").alias("seq"), content_fingerprint(F.col("content")).alias("fp"))
    return processed(named, ["site", "url"], _Changes(["site", "url"], None if lifetime is None else int(lifetime * 1000)), "seq long, fp string, status string", "none" if lifetime is None else CLOCK)


class _Refresh(Keyed):
    def __init__(self, keys: Sequence[str], interval: int, again: bool) -> None:
        super().__init__(keys)
        self.interval, self.again = interval, again

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.due = handle.getValueState("due", "due long")

    def set_due(self, due: int) -> None:
        self.due.update((due,))
        self.wakes(-(-due // 1000))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        if times := self.times(rows):
            self.set_due(max(times[-1] + self.interval, self.due.get()[0] if self.due.exists() else 0))
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.due.exists():
            due = self.due.get()[0]
            yield self.of(key, due=[due])
            self.due.clear()
            if self.again:
                self.set_due(due + self.interval)


def refresh_events(visits: DataFrame, key: str, ts: str, seconds: float = 900, again: bool = False) -> DataFrame:
    """(key, due): a row for each page when it is due again, ``seconds`` after its latest visit, whether or not any row comes.

    A visit before that moves it; once due a page is not due again before its next visit, or with ``again``
    every ``seconds``. Visits without a time are ignored.
    """
    out = processed(in_micros(visits, [key], ts), [key], _Refresh([key], int(seconds * 1_000_000), again), "due long", CLOCK, ticks=True)
    return stamped(out, "due")


class _Liveness(Keyed):
    def __init__(self, keys: Sequence[str], limit: int) -> None:
        super().__init__(keys)
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.beat = handle.getValueState("beat", "last long, online boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        if not (times := self.times(rows)):
            return
        before, online = self.beat.get() if self.beat.exists() else (None, False)
        now = timerValues.getCurrentProcessingTimeInMs() * 1000
        last = max(times[-1], before or times[-1])
        alive = last + self.limit > now
        if alive and not online:
            yield self.of(key, at=[last], state=["online"])
        self.beat.update((last, alive or online))
        self.wakes(-(-(last + self.limit) // 1000))

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.beat.exists():
            last, online = self.beat.get()
            if online:
                yield self.of(key, at=[last + self.limit], state=["offline"])
            self.beat.clear()


def liveness_events(beats: DataFrame, key: str, ts: str, limit: float = 300) -> DataFrame:
    """(key, at, state): ``online`` at a worker's first beat and at the first after a silence, ``offline`` when no beat came for ``limit`` seconds.

    A silent stream tells too. Beats older than ``limit`` when they arrive make no worker online; beats without a time are ignored.
    """
    out = processed(in_micros(beats, [key], ts), [key], _Liveness([key], int(limit * 1_000_000)), "at long, state string", CLOCK, ticks=True)
    return stamped(out, "at")


class _Idle(Keyed):
    def __init__(self, keys: Sequence[str], gap: int, most: int) -> None:
        super().__init__(keys)
        self.gap, self.most = gap, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.streak = handle.getValueState("streak", "n int, last long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        if not (times := self.times(rows)):
            return
        streak = Streak(self.gap, self.most, *(self.streak.get() if self.streak.exists() else ()))
        results = [streak(t) for t in times]
        self.streak.update((streak.n, streak.last))
        yield self.of(key, at=times, streak=[n for n, _ in results], closes=[c for _, c in results])


def idle_events(signals: DataFrame, key: str, ts: str, gap: float = 6.0, most: int = 5) -> DataFrame:
    """(key, at, streak, closes): as ``folds.idle_streaks``, with the streak kept between batches."""
    out = processed(in_micros(signals, [key], ts), [key], _Idle([key], int(gap * 1_000_000), most), "at long, streak int, closes boolean")
    return stamped(out, "at")


class _Accepted(Keyed):
    def __init__(self, keys: Sequence[str], width: int) -> None:
        super().__init__(keys)
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "t long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        every = pd.concat(list(rows)).dropna(subset=["t"]).sort_values(["t", "row"], kind="stable")
        last, keeps = self.last.get()[0] if self.last.exists() else None, []
        for t in every["t"].astype("int64").tolist():
            keeps.append(last is None or t - last >= self.width)
            last = t if keeps[-1] else last
        if last is not None:
            self.last.update((last,))
        if any(keeps):
            yield self.of(key, row=every["row"][keeps].tolist())


def accepted(changes: DataFrame, key: str, ts: str, seconds: float = 1.0) -> DataFrame:
    """A stream's changes less those within ``seconds`` of the last one accepted of the same key, as ``folds.debounced``; earlier batches count. Columns must have a JSON form."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in changes.columns])).alias("row")
    out = processed(in_micros(changes, [key], ts, row), [key], _Accepted([key], int(seconds * 1_000_000)), "row string")
    return out.select(F.from_json("row", changes.schema).alias("row")).select("row.*")


class _Settled(Keyed):
    def __init__(self, keys: Sequence[str], quiet_ms: int) -> None:
        super().__init__(keys)
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "t long, row string, n long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        t, row, n = before = self.last.get() if self.last.exists() else (None, None, 0)
        for frame in rows:
            for one in frame.dropna(subset=["t"]).itertuples():
                n += 1
                if t is None or (one.t, one.row) >= (t, row):
                    t, row = int(one.t), one.row
        if n > before[2]:
            self.last.update((t, row, n))
            self.wakes(timerValues.getCurrentProcessingTimeInMs() + self.quiet_ms)
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.last.exists():
            _, row, n = self.last.get()
            self.last.clear()
            yield self.of(key, row=[row], changes=[n])


def settled(changes: DataFrame, key: str, ts: str, quiet: float = 1.0) -> DataFrame:
    """The latest change of each key (by ``ts``) and ``changes``, how many it stands for, once no more came for ``quiet`` seconds. Changes without a time are ignored."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in changes.columns])).alias("row")
    out = processed(in_micros(changes, [key], ts, row), [key], _Settled([key], int(quiet * 1000)), "row string, changes long", CLOCK, ticks=True)
    return out.select(F.from_json("row", changes.schema).alias("row"), "changes").select("row.*", "changes")


class _Seen(Keyed):
    def __init__(self, keys: Sequence[str], lifetime: int) -> None:
        super().__init__(keys)
        self.lifetime = lifetime

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.began = handle.getValueState("began", "t long")
        self.known = handle.getMapState("known", "h long", "one boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        every = pd.concat(list(rows)).sort_values(["t", "hash"], kind="stable")
        began, fresh = self.began.get()[0] if self.began.exists() else None, []
        for t, h in zip(every["t"].tolist(), every["hash"].tolist(), strict=True):
            if began is None or t - began >= self.lifetime:
                self.known.clear()
                began = int(t)
                self.began.update((began,))
                for old in list(self.handle.listTimers()):
                    self.handle.deleteTimer(old[0] if isinstance(old, tuple) else old)
                self.handle.registerTimer(-(-(began + self.lifetime) // 1000))
            fresh.append(not self.known.containsKey((int(h),)))
            if fresh[-1]:
                self.known.updateValue((int(h),), (True,))
        yield self.of(key, row=every["row"].tolist(), fresh=fresh)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.known.clear()
        self.began.clear()
        yield from ()


def seen_in_scope(stream: DataFrame, scope: Sequence[str], key: str, ts: str, lifetime: float, late: str = "1 hour", parts: int = 1) -> DataFrame:
    """``stream`` with ``fresh``: whether the key is new to its scope's set.

    A set lives ``lifetime`` seconds from its first key on, by ``ts``, and is then dropped as a whole,
    whatever came meanwhile; once the watermark (``late`` behind) is past that, an idle scope's state goes
    too. Every key is an entry of its own. A large scope is dealt into ``parts`` by its keys' hashes;
    each part's set then has its own first key. Rows without a time, or later than the watermark, are
    left out. Columns must have a JSON form.
    """
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in stream.columns])).alias("row")
    h = F.xxhash64(F.col(f"`{key}`"))
    own = stream.where(F.col(ts).isNotNull()).withWatermark(ts, late)
    named = own.select(*scope, F.pmod(h, F.lit(parts)).cast("int").alias("part"), F.col(ts).alias("at"), F.unix_micros(F.col(ts).cast("timestamp")).alias("t"), h.alias("hash"), row)
    keys = [*scope, "part"]
    out = processed(named, keys, _Seen(keys, int(lifetime * 1_000_000)), "row string, fresh boolean", "eventTime")
    return out.select(F.from_json("row", stream.schema).alias("row"), "fresh").select("row.*", "fresh")
