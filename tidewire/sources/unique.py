"""A store in which a key stands once, whatever is retried or written at the same time.

Rows are written to a folder of their own and count only when a numbered record names that folder.
Records are never replaced, so of two writers that reach for one number only one gets it; the
other looks at what has come in between, takes its keys out of its own rows, and tries the next.
A record states the batch it is of, so a batch that is written again changes nothing.
"""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TURN = threading.Lock()


class UniqueStore:
    """Rows of a schema in a folder, each ``key`` once; on file systems whose rename does not replace a file (not on plain object stores)."""

    def __init__(self, spark: SparkSession, path: str, key: str) -> None:
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def records(self, after: int = -1) -> list[tuple[int, dict]]:
        """The records with higher numbers than ``after``, in order."""
        where = self._path(f"{self.path}/_records")
        if not self._fs.exists(where):
            return []
        numbers = sorted(n for f in self._fs.listStatus(where) if (name := f.getPath().getName()).endswith(".json") and (n := int(name[:-5])) > after)
        return [(n, self._record(n)) for n in numbers]

    def _record(self, n: int) -> dict:
        with_stream = self._fs.open(self._path(f"{self.path}/_records/{n:020d}.json"))
        try:
            return json.loads(bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(with_stream)).decode())
        finally:
            with_stream.close()

    def _claim(self, n: int, record: dict) -> bool:
        """Whether this record became the n-th; false if another writer was first.

        It is written whole under another name and then renamed, which HDFS refuses, in one step, where
        the name is taken; on a local disk, which would replace it, writers of one process take turns.
        """
        ready, final = (self._path(f"{self.path}/_records/{name}") for name in (f".{uuid.uuid4().hex}", f"{n:020d}.json"))
        out = self._fs.create(ready, False)
        try:
            out.write(json.dumps(record).encode())
        finally:
            out.close()
        with _TURN:
            if not self._fs.exists(final) and self._fs.rename(ready, final):
                return True
        self._fs.delete(ready, False)
        return False

    def rows(self, after: int = -1) -> DataFrame | None:
        """What stands in the store (of records beyond ``after``); None if nothing does."""
        folders = [f"{self.path}/{r['folder']}" for _, r in self.records(after) if r["folder"]]
        return self.spark.read.parquet(*folders) if folders else None

    def write(self, rows: DataFrame, writer: str, batch: int) -> bool:
        """Adds the rows whose key the store lacks, one for each key; false if this writer's batch stands there already. Rows without a key are left out."""
        seen = self.records()
        if any(r["writer"] == writer and r["batch"] == batch for _, r in seen):
            return False
        known, last = self.rows(), seen[-1][0] if seen else -1
        fresh = self._less(rows.where(F.col(self.key).isNotNull()).dropDuplicates([self.key]), known)
        while True:
            folder = f"rows-{uuid.uuid4().hex}"
            fresh.write.parquet(f"{self.path}/{folder}")
            if self._claim(last + 1, {"writer": writer, "batch": batch, "folder": folder}):
                return True
            came = self.records(last)
            if any(r["writer"] == writer and r["batch"] == batch for _, r in came):
                self._fs.delete(self._path(f"{self.path}/{folder}"), True)
                return False
            written = self.spark.read.schema(fresh.schema).parquet(f"{self.path}/{folder}")
            fresh, last = self._less(written, self.rows(last)), came[-1][0]

    def _less(self, rows: DataFrame, known: DataFrame | None) -> DataFrame:
        return rows if known is None else rows.join(known.select(self.key), self.key, "left_anti").select(rows.columns)

    def stream(self, rows: DataFrame, writer: str, checkpoint: str):
        """A stream's rows, a batch each; a batch that is tried again after a failure adds nothing twice. Takes what there is and ends."""
        return rows.writeStream.foreachBatch(lambda batch, n: self.write(batch, writer, n) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
