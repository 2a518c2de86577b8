"""Connected components of a link table by repeated local contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Rounds shrink the graph by a constant factor on average; more than this means something is wrong.
MAX_ROUNDS = 200
#: Rounds in which vertices keep their rank: stars fall together in two, and no order of ids is bad for long.
SAME_RANK = 4
#: Rounds after which the moves so far are put together in a table.
FOLDED = 8


def components(links: DataFrame) -> DataFrame:
    """(v, root) for every vertex of ``links`` (a, b: long); vertices share a root if and only if links join them.

    In each round every vertex moves to that of its neighbours and itself which a hash ranks first;
    links between moved vertices remain. Aggregates are partial per task and joins may be split when
    skewed, so a vertex with very many links needs no group of its own. Each round's moves and links
    are written to the shared folder. Only row counts reach the driver. Null ends are ignored.
    """
    edges = links.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = written(both, "links")
    # a link of a vertex with itself names it
    moved = both.select("a").distinct().select(F.col("a").alias("v"), F.col("a").alias("root"))
    both = both.where("a <> b")
    for k in range(MAX_ROUNDS):
        if both.isEmpty():
            return written(moved, "roots")
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(k // SAME_RANK)).alias("rank"), F.col(c).alias("to"))  # noqa: B023, E731
        best = both.groupBy("a").agg(F.min(rank("b")).alias("m")).select("a", F.least(F.col("m"), rank("a"))["to"].alias("to"))
        best = written(best, "moves")
        one, two = best.select(F.col("a").alias("a1"), F.col("to").alias("to1")), best.select(F.col("a").alias("a2"), F.col("to").alias("to2"))
        moved = moved.join(one, F.col("root") == F.col("a1"), "left").select("v", F.coalesce("to1", "root").alias("root"))
        if k % FOLDED == FOLDED - 1:
            moved = written(moved, "roots")
        both = both.join(one, F.col("a") == F.col("a1")).join(two, F.col("b") == F.col("a2")).select(F.col("to1").alias("a"), F.col("to2").alias("b")).where("a <> b").distinct()
        both = written(both, "links")
    raise RuntimeError("components did not converge")
