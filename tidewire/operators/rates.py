"""Rates of counters and quantiles of histograms over sliding ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ops import LATENCY_BOUNDS, bucket_quantile


def increases(samples: DataFrame, series: Sequence[str], ts: str, value: str, tie: str | None = None) -> DataFrame:
    """``samples`` with ``increase``: what the counter grew by since the series' sample before.

    A value below the one before is a counter that began anew, and counts as a whole; a series' first
    sample, and one without a value, count nothing. Samples without a time are left out.
    """
    by_time = Window.partitionBy(*series).orderBy(ts, *([tie] if tie else []))
    before = F.last(value, ignorenulls=True).over(by_time.rowsBetween(Window.unboundedPreceding, -1))
    grown = F.when(F.col(value) < before, F.col(value)).otherwise(F.col(value) - before)
    return samples.where(F.col(ts).isNotNull()).withColumn("increase", F.coalesce(grown, F.lit(0)))


def sliding(rows: DataFrame, by: Sequence[str], ts: str, sums: Sequence[Column], width: int, step: int) -> DataFrame:
    """(``by``, start, sums) for windows of ``width`` seconds that begin every ``step`` seconds (which divide the width); only windows with rows.

    Rows are added up for each step first, so that what is copied to the windows it lies in is one row a step.
    """
    if step <= 0 or width % step:
        raise ValueError("the step must divide the width")
    cells = rows.where(F.col(ts).isNotNull()).groupBy(*by, F.expr(f"floor(unix_micros(cast(`{ts}` as timestamp)) / 1000000 / {step}) * {step}").cast("long").alias("__cell")).agg(*sums)
    names = [c for c in cells.columns if c not in (*by, "__cell")]
    spread = cells.withColumn("__start", F.explode(F.sequence(F.col("__cell") - (width - step), F.col("__cell"), F.lit(step).cast("long"))))
    found = spread.groupBy(*by, F.timestamp_seconds("__start").alias("start")).agg(*[F.sum(c).alias(c) for c in names])
    return found.select(*by, "start", *names)


def counter_rates(samples: DataFrame, series: Sequence[str], ts: str, value: str, width: int = 300, step: int = 60, tie: str | None = None) -> DataFrame:
    """(series, start, increase, per_second_ppm): growth of counters in each window, and by the second in millionths."""
    grown = increases(samples, series, ts, value, tie)
    found = sliding(grown, series, ts, [F.sum("increase").alias("increase")], width, step)
    return found.withColumn("per_second_ppm", F.expr(f"cast(1000000 * increase / {width} as bigint)"))


def failure_ratio(requests: DataFrame, by: Sequence[str], ts: str, failed: Column, width: int = 300, step: int = 60) -> DataFrame:
    """(``by``, start, n, bad, ratio_ppm): failed requests of each window against all, in millionths."""
    found = sliding(requests, by, ts, [F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(failed, F.lit(False))).alias("bad")], width, step)
    return found.withColumn("ratio_ppm", F.expr("1000000 * bad div n"))


def sliding_quantile(requests: DataFrame, by: Sequence[str], ts: str, ms: Column, thousandths: int = 950, width: int = 300, step: int = 60) -> DataFrame:
    """(``by``, start, n, quantile) of latencies in thousandths of a second, interpolated within cumulative buckets, for each window."""
    counts = [F.count(F.lit(1)).alias("n"), *[F.count_if(F.coalesce(ms <= b, F.lit(False))).alias(f"le_{b}") for b in LATENCY_BOUNDS]]
    found = sliding(requests.where(ms.isNotNull()), by, ts, counts, width, step)
    return bucket_quantile(found, thousandths).select(*by, "start", "n", "quantile")
