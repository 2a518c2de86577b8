"""Quality rules whose cutoffs carry a guarantee: risk-controlled thresholds.

Every rule rejects a text if one of its measures exceeds a cutoff. On labelled holdouts an exact
binomial bound tests, per stratum, whether cutoffs reject more than the allowed share of good texts.
The rules of a stratum are one joint series, tightened side by side from the loosest cutoffs on; the
first step that cannot be shown safe ends the series (a fixed-sequence test, so it needs no
correction of its own), and the level is divided by the number of series (Bonferroni). All of it is
DataFrame code without Python workers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: White space between words: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"
#: Measure (thousandths) -> cutoffs from the loosest to the tightest.
GRID: dict[str, tuple[int, ...]] = {
    "symbol_rate": (3000, 2000, 1500, 1000, 700, 500, 300, 200),
    "upper_rate": (900, 700, 600, 500, 400, 300),
    "dup_line_rate": (900, 700, 500, 400, 300, 200),
    "repeat_rate": (500, 400, 300, 200, 150),
    "word_length": (30000, 20000, 15000, 12000),
}
#: The joint series: (rule, cutoff) in the order in which they are added, all rules tightened side by side.
STEPS = [(m, c) for _, _, m, c in sorted(((k + 1) / len(cs), at, m, c) for at, (m, cs) in enumerate(GRID.items()) for k, c in enumerate(cs))]
#: False rejection of good texts allowed per stratum, over all rules together, and the error level of that claim.
RISK, LEVEL = 0.01, 0.05
#: Result columns; kept columns of these names give way to them.
RESULTS = frozenset(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines", "base_failed", "kept", *GRID))
#: Strata (a row each) that may be broadcast.
BROADCAST_LIMITS = 50_000
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def measures(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns, the counts of each whole text and the rates derived from them.

    Null and empty texts have no words and all counts 0. Each row is measured by itself: ties,
    repeated rows and extra columns have no influence; an empty table gives an empty result.
    """
    kept = [F.col(f"`{c}`") for c in dict.fromkeys(keep) if c not in RESULTS]
    w, h = F.col("__w"), F.col("__h")
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    a = docs.select(*kept, t.alias("__t"), F.btrim(t, F.lit(SPACE)).alias("__b"))
    # filters stand between the steps' heavy columns and their users, so that no column is computed twice
    a = a.select(
        *kept,
        F.when(F.col("__b") == "", F.array().cast("array<string>")).otherwise(F.split("__b", WORD_GAP)).alias("__w"),
        F.filter(F.split("__t", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "").alias("__l"),
        F.regexp_count("__t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("__t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
    )
    grams = F.transform(F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)))
    a = a.select(
        *kept, "n_symbols", "n_upper",
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(w) >= 3, grams).alias("__h"),
    )
    again = F.size(F.array_distinct(h)) < F.size(h)
    a = a.withColumn("__s", F.when(again, F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col("__s")

    def twice(p: Column, j: Column) -> Column:
        before = (j > 0) & (F.get(s, j - 1)["h"] == p["h"])
        after = F.coalesce(F.get(s, j + 1)["h"] == p["h"], F.lit(False))
        return before | after

    # starts of the windows found more than once, in order
    a = a.withColumn("__i", F.when(s.isNotNull(), F.sort_array(F.transform(F.filter(s, twice), lambda p: p["i"]))))
    i = F.col("__i")
    # windows cover three words each, less what the next one covers again
    covered = F.aggregate(i, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), lambda acc, x: F.struct((acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n"), x.alias("last")))["n"]
    a = a.select(*kept, "n_words", "word_chars", "n_symbols", "n_dup_lines", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), "n_upper", "n_lines")
    per = lambda n, d: F.expr(f"1000 * {n} div greatest({d}, 1)")
    return a.withColumns({
        "symbol_rate": per("n_symbols", "n_words"),
        "upper_rate": per("n_upper", "word_chars"),
        "dup_line_rate": per("n_dup_lines", "n_lines"),
        "repeat_rate": per("n_repeat_words", "n_words"),
        "word_length": per("word_chars", "n_words"),
        "base_failed": F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"),
    })


def log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series from 20 on (error below 1e-12)."""
    x = n.cast("double")
    series = x * F.log(x) - x + F.log(x * (2 * math.pi)) / 2 + 1 / (x * 12) - 1 / (F.pow(x, 3) * 360) + 1 / (F.pow(x, 5) * 1260)
    return F.when(n < 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def binomial_cdf(x: Column, n: Column, p: float) -> Column:
    """P(X <= x) for X ~ Bin(n, p) if x < n p, else 1 (no use to the test). Summed down from x; what ten deviations below add is under 1e-20 of it."""
    top = F.exp(log_factorial(n) - log_factorial(x) - log_factorial(n - x) + x * math.log(p) + (n - x) * math.log(1 - p))
    steps = F.least(x, (F.ceil(F.sqrt(n * p)) * 10 + 50).cast("long"))
    terms = F.aggregate(
        F.sequence(F.lit(0).cast("long"), steps),
        F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term")),
        lambda acc, k: F.struct((acc["sum"] + acc["term"]).alias("sum"), (acc["term"] * (x - k) * (1 - p) / ((n - x + k + 1) * p)).alias("term")),
    )["sum"]
    return F.when(x < n * p, F.least(top * terms, F.lit(1.0))).otherwise(1.0)


def first_step() -> Column:
    """The number of the first step of the joint series that rejects a measured text; null if none does."""
    each = []
    for m in GRID:
        over = F.lit(None).cast("int")
        for k, (rule, c) in reversed(list(enumerate(STEPS))):
            over = F.when(F.col(m) > c, k).otherwise(over) if rule == m else over
        each.append(over)
    return F.least(*each)


def joint_limits(measured: DataFrame, good: DataFrame, key: str = "doc_id", stratum: str = "lang", risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """Rows (stratum, n, own, step): the last step of the joint series shown safe for each stratum with labelled good texts.

    Every step is tested with all its rules together against the whole risk, so a stratum is one
    series; all strata together are one more. Steps are taken in their fixed order until the first
    that cannot be shown safe. A stratum whose labels are too few for any step (even if none of its
    good texts were rejected) takes those of all strata together, as far as its own good texts are
    not rejected beyond the risk; ``own`` tells which. ``step`` is null where no step is safe.
    """
    keys = good.select(F.col(key).alias("__key")).where(F.col(key).isNotNull()).distinct()
    hold = measured.where(~F.col("base_failed")).join(keys, F.col(key) == F.col("__key"), "left_semi")
    hold = hold.select(F.col(stratum).alias("stratum"), first_step().alias("first"))
    wide = hold.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.count_if(F.col("first") <= k) for k in range(len(STEPS))]).alias("x"))
    # a row for each stratum from here on
    total = wide.agg(
        (F.count(F.lit(1)) + 1).alias("series"),
        F.sum("n").alias("n_all"),
        F.array(*[F.sum(F.get("x", F.lit(k))) for k in range(len(STEPS))]).alias("x_all"),
    )
    each = wide.crossJoin(F.broadcast(total)).select("*", F.posexplode("x").alias("step", "rejected"))
    bound = F.lit(level) / F.col("series")
    each = each.select(
        "stratum", "n", "step",
        (F.pow(F.lit(1 - risk), F.col("n")) <= bound).alias("own"),
        (binomial_cdf(F.col("rejected"), F.col("n"), risk) <= bound).alias("safe"),
        (binomial_cdf(F.get("x_all", F.col("step")), F.col("n_all"), risk) <= bound).alias("safe_all"),
        (F.col("rejected") <= F.col("n") * risk).alias("fair"),
    )
    each = each.withColumn("safe", F.when(F.col("own"), F.col("safe")).otherwise(F.col("safe_all") & F.col("fair")))
    last = F.coalesce(F.min(F.when(~F.col("safe"), F.col("step"))), F.lit(len(STEPS))) - 1
    return each.groupBy("stratum", "n", "own").agg(last.alias("step")).withColumn("step", F.when(F.col("step") >= 0, F.col("step")))


def apply_rules(docs: DataFrame, good: DataFrame, keep: Sequence[str], key: str = "doc_id", stratum: str = "lang", text: str = "text") -> DataFrame:
    """``keep`` columns, measures and ``kept`` for each row of ``docs``: false if the base rules fail or a step of its stratum's series rejects it.

    Strata without labelled good texts keep what the base rules keep. Measured once, written, then judged.
    """
    measured = written(measures(docs, list(dict.fromkeys([*keep, key, stratum])), text), "measures")
    limits = written(joint_limits(measured, good, key, stratum).select(F.col("stratum").alias("__stratum"), F.col("step").alias("__step")), "limits")
    if limits.count() <= BROADCAST_LIMITS:
        limits = F.broadcast(limits)
    out = measured.join(limits, F.col(stratum).eqNullSafe(F.col("__stratum")), "left")
    over = F.coalesce(first_step() <= F.col("__step"), F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & ~over).drop("__stratum", "__step")
