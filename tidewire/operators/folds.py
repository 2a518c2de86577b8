"""What depends on all earlier rows of a key: a fold over sorted rows, in one pass and with the state of one key at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType


def folded(rows: DataFrame, key: str, ts: str, start: Callable[[], Callable[[int], tuple]], fields: str) -> DataFrame:
    """``rows`` with ``fields``: what a function made by ``start`` for each key gives for its rows' times, in order.

    Times are whole microseconds, equal ones go in the order of the rows' hashes; rows without a time are left out; null keys are one key. Rows are
    sorted in Spark, which spills, and stream through Python, so a key may have any number of rows;
    its rows are one task's, as each depends on the one before.
    """
    own = rows.where(F.col(ts).isNotNull()).select(F.struct("*").alias("row"), F.col(key).alias("key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("t"))
    added = StructType.fromDDL(fields)
    schema, kinds = StructType([own.schema["row"], *added]), [to_arrow_type(f.dataType) for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, step = object(), None
        for batch in batches:
            out = []
            for k, t in zip(batch.column("key").to_pylist(), batch.column("t").to_pylist(), strict=True):
                if k != now:
                    now, step = k, start()
                out.append(step(t))
            columns = zip(*out, strict=True) if out else [[] for _ in added]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *map(pa.array, columns, kinds)], schema.names)

    sorted_rows = own.repartition("key").sortWithinPartitions("key", "t", F.xxhash64("row"))
    return sorted_rows.mapInArrow(run, schema).select("row.*", *added.names)


def debounced(changes: DataFrame, key: str, ts: str, seconds: float = 1.0) -> DataFrame:
    """Changes less those within ``seconds`` of the last one accepted of the same key. Rows without a key or a time are left out."""
    width = int(seconds * 1_000_000)

    def start() -> Callable[[int], tuple[bool]]:
        last: list[int] = []

        def step(t: int) -> tuple[bool]:
            accepted = not last or t - last[0] >= width
            if accepted:
                last[:] = [t]
            return (accepted,)

        return step

    return folded(changes.where(F.col(key).isNotNull()), key, ts, start, "__accepted boolean").where("__accepted").drop("__accepted")


class Streak:
    """Idle signals in a row: a gap of over ``gap`` microseconds begins anew (not at the second signal), over ``most`` in a row close and begin anew."""

    def __init__(self, gap: int, most: int, n: int = 0, last: int = 0) -> None:
        self.gap, self.most, self.n, self.last = gap, most, n, last

    def __call__(self, t: int) -> tuple[int, bool]:
        n, between = self.n + 1, t - self.last
        n, closes = (1, False) if n > 2 and between > self.gap else (n, n > self.most)
        self.n, self.last = (0 if closes else n), t
        return n, closes


def idle_streaks(signals: DataFrame, key: str, ts: str, gap: float = 6.0, most: int = 5) -> DataFrame:
    """Idle signals with ``streak`` (how many in a row) and ``closes`` (whether there are over ``most``, after which the count begins anew)."""
    width = int(gap * 1_000_000)
    return folded(signals, key, ts, lambda: Streak(width, most), "streak int, closes boolean")

