"""The pipeline's quality rules: one joint series for each stratum, and all strata together for small ones."""

from __future__ import annotations

import random

import corpus_pipeline
from pyspark.sql import functions as F
from tidewire.llm import rules


def test_joint_series(spark, tmp_path):
    rng = random.Random(5)
    word = lambda bad, i: f"{rng.choice('abcdefgh')}{i}" + ("#$%" if bad else "")
    groups = [("en", 500, False), ("en", 30, True), ("fr", 100, False), ("fr", 30, True), ("xx", 20, True)]
    rows = [(lang, " ".join(word(bad, i) for i in range(60)), bad) for lang, n, bad in groups for _ in range(n)]
    docs = spark.createDataFrame([(i, t, lang, bad) for i, (lang, t, bad) in enumerate(rows)], "doc_id long, text string, lang string, bad boolean")
    docs.select("doc_id", F.when(F.col("bad"), 0).otherwise(1).alias("quality")).where("quality = 1").write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, str(tmp_path))
    # fr has too few labels of its own; xx has none at all and keeps what the base rules keep
    assert {tuple(r) for r in kept.groupBy("lang", "bad").count().collect()} == {("en", False, 500), ("fr", False, 100), ("xx", True, 20)}


def test_false_rejection_ends_the_series(spark):
    values = [("en", v) for v in [250] * 20 + [0] * 980] + [("fr", v) for v in [400] * 3 + [0] * 97]
    cols = [F.col("v").alias("symbol_rate"), *[F.lit(0).alias(m) for m in rules.GRID if m != "symbol_rate"]]
    measured = spark.createDataFrame([(i, s, v) for i, (s, v) in enumerate(values)], "doc_id long, lang string, v long").select("doc_id", "lang", F.lit(False).alias("base_failed"), *cols)
    got = {r["stratum"]: (r["own"], r["step"]) for r in rules.joint_limits(measured, measured).collect()}
    # 2 % of en lie above 200, 3 % of fr above 300, which is found on fr's own texts
    assert got == {"en": (True, rules.STEPS.index(("symbol_rate", 200)) - 1), "fr": (False, rules.STEPS.index(("symbol_rate", 300)) - 1)}
