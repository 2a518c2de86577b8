"""Counters that begin anew, and windows that overlap."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewire.operators import rates

START = datetime(2024, 1, 1)


def test_counters_that_begin_anew(spark):
    rows = [("a", 0, 5), ("a", 60, 9), ("a", 120, 2), ("a", 180, None), ("a", 240, 3), ("b", 0, 7), (None, 0, 1), (None, 30, 4), ("a", None, 100)]
    df = spark.createDataFrame([(k, None if s is None else START + timedelta(seconds=s), v) for k, s, v in rows], "k string, ts timestamp, v long")
    got = sorted(((r["k"] or "", (r["ts"] - START).seconds, r["increase"]) for r in rates.increases(df, ["k"], "ts", "v").collect()))
    assert got == [("", 0, 0), ("", 30, 3), ("a", 0, 0), ("a", 60, 4), ("a", 120, 2), ("a", 180, 0), ("a", 240, 1), ("b", 0, 0)]
    found = {(r["k"], int((r["start"] - START).total_seconds())): (r["increase"], r["per_second_ppm"]) for r in rates.counter_rates(df, ["k"], "ts", "v", 120, 60).collect()}
    assert found["a", -60] == (0, 0) and found["a", 0] == (4, 33333) and found["a", 60] == (6, 50000) and found["a", 240] == (1, 8333) and len(found) == 6 + 2 + 2
    assert rates.counter_rates(df.limit(0), ["k"], "ts", "v").count() == 0
    with pytest.raises(ValueError, match="divide"):
        rates.counter_rates(df, ["k"], "ts", "v", 100, 60)


def test_ratios_and_quantiles(spark):
    rows = [(START + timedelta(seconds=10 * i), i % 4 == 0, None if i == 3 else 40 * i) for i in range(12)]
    df = spark.createDataFrame(rows, "ts timestamp, bad boolean, ms int")
    ratio = {int((r["start"] - START).total_seconds()): (r["n"], r["bad"], r["ratio_ppm"]) for r in rates.failure_ratio(df, [], "ts", F.col("bad"), 120, 60).collect()}
    assert ratio == {-60: (6, 2, 333333), 0: (12, 3, 250000), 60: (6, 1, 166666)}
    quantile = {int((r["start"] - START).total_seconds()): (r["n"], round(r["quantile"], 3)) for r in rates.sliding_quantile(df, [], "ts", F.col("ms"), 500, 120, 60).collect()}
    assert quantile[-60] == (5, round(50 + 50 * 0.5 / 1, 3)) and quantile[0][0] == 11
