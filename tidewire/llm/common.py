"""What the corpus operators share: the shared folder, table reads, Arrow row maps."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Bytes of one Arrow batch handed to Python; bounds a worker's memory when texts are long.
BATCH_BYTES = 4 << 20

_own_dir: str | None = None
#: Paths made and not yet removed.
_made: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one of our own only where that is unset and all tasks run in this process (tests)."""
    global _own_dir
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if _own_dir is None:
        _own_dir = "file://" + tempfile.mkdtemp(prefix="tidewire-")
        spark.sparkContext.setCheckpointDir(_own_dir)
    return _own_dir


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; removed when this driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may have ended before the driver; nothing is lost but the clean-up
        pass


def made() -> list[str]:
    return list(_made)


def release(spark: SparkSession, paths: Sequence[str]) -> None:
    """Remove tables that nothing reads any more."""
    for path in paths:
        if path in _made:
            _made.remove(path)
            _remove(spark, path)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, survives lost executors, has known size."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


_holding: dict = {}


def held(key, make: Callable):
    """What a worker process keeps between tasks; only the latest is kept, so operators that follow each other don't add up."""
    if key not in _holding:
        _holding.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _holding[key] = make()
    return _holding[key]


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, unless the session does so already."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(name) and spark.conf.get(name) == _default_batch(spark, name):
        spark.conf.set(name, str(BATCH_BYTES))


def _default_batch(spark: SparkSession, name: str) -> str:
    return spark.newSession().conf.get(name)


def map_column(df: DataFrame, keep: Sequence[str], column: str, fields: Sequence[StructField], make: Callable[[], Callable[[pa.Array], list[pa.Array]]]) -> DataFrame:
    """Add ``fields``, computed in Arrow batches from ``column``, to the ``keep`` columns.

    ``make`` runs once per task and returns the batch function. A kept column whose name a new
    field takes is replaced by the new field. Only ``column`` goes to Python and only the new fields
    come back; the others stay in the JVM.
    """
    small_batches(df.sparkSession)
    names = [f.name for f in fields]
    kept = [F.col(f"`{c}`") for c in dict.fromkeys(keep) if c not in names]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for values in batches:
            yield pa.StructArray.from_arrays(work(values), names)

    # as a nondeterministic column it is computed once, however many fields are used
    new = F.arrow_udf(run, StructType(list(fields))).asNondeterministic()(F.col(f"`{column}`"))
    return df.select(*kept, new.alias("__new")).select(*kept, *[F.col("__new")[n].alias(n) for n in names])
