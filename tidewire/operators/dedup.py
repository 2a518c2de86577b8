"""Keep-first deduplication and change detection, as windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import content_fingerprint


def keep_first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The first row of each key; rows without an order come last, ties are decided by the whole row.

    The aggregate is partial per task, so a hot key needs no task of its own.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    whole = F.struct(F.col(order).isNull().alias("__none"), F.col(order).alias("__order"), *[F.col(c).alias(c) for c in rest])
    first = df.groupBy(*keys).agg(F.min(whole).alias("__r"))
    return first.select(*keys, *([F.col("__r.__order").alias(order)] if order not in keys else []), *[F.col(f"__r.{c}").alias(c) for c in rest]).select(*df.columns)


def change_status(versions: DataFrame) -> DataFrame:
    """created, modified or unchanged against the version before of the same site and URL. The content itself is not kept, so it is not shuffled."""
    w = Window.partitionBy("site", "url").orderBy("seq")
    before = F.lag("fp").over(w)
    return versions.withColumn("fp", content_fingerprint(F.col("content"))).drop("content").withColumn("status", F.when(before.isNull(), "created").when(before != F.col("fp"), "modified").otherwise("unchanged"))


def content_updates(versions: DataFrame, per_site: bool = True) -> DataFrame:
    """Changed versions whose content was not seen before in its scope (site, or all)."""
    changed = change_status(versions).where("status <> 'unchanged'")
    return keep_first(changed.withColumn("scope", F.col("site") if per_site else F.lit("*")), ["scope", "fp"], "seq").drop("scope")


def latest(df: DataFrame, key: str, order: str, n: int) -> DataFrame:
    """The newest ``n`` rows of each key."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")
