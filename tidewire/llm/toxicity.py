"""Toxicity scores from a logistic model over words, with a counterfactual penalty.

For each labelled text that names an identity, a second version has its identity terms swapped.
Training adds the squared change of the score between the two, so that a neutral mention of a group
alone moves no score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField

from .common import map_column, written

#: Labelled rows fitted at most, taken by a hash of the id.
SAMPLE_ROWS = 6_000
#: A word needs this many labelled rows, and this many standard errors of its log-odds, to get a weight: the sample's bound and this bound the model.
LEAST_ROWS, LEAST_Z = 4, 3.0
STEPS, RATE, RIDGE, FAIRNESS = 200, 0.1, 0.0005, 16.0
#: Beginnings of words that are features too: inflected and compound insults share them.
STEMS = (4, 5, 6)
THRESHOLD = 0.3
#: Share of toxic texts assumed, with the weight of one row, before any label is seen.
PRIOR = 0.1
#: Words of one language in groups whose members may stand for one another.
IDENTITIES = (
    "women men girls boys".split(), "woman man girl boy".split(), "female male".split(),
    "muslims christians jews hindus buddhists sikhs atheists catholics protestants".split(), "muslim christian jewish hindu buddhist sikh atheist catholic protestant".split(),
    "black white asian latino arab african european indian chinese mexican american".split(), "africans europeans asians indians mexicans americans arabs latinos".split(),
    "gay straight lesbian bisexual transgender queer heterosexual homosexual".split(),
    "immigrants refugees foreigners natives migrants".split(), "immigrant refugee foreigner native migrant".split(),
    "old young elderly disabled blind deaf".split(),
    "frauen männer mädchen jungen".split(), "muslime christen juden hindus buddhisten".split(), "ausländer einwanderer flüchtlinge einheimische".split(), "schwarze weiße".split(), "türken deutsche polen franzosen".split(),
    "femmes hommes filles garçons".split(), "musulmans chrétiens juifs hindous bouddhistes".split(), "étrangers immigrés réfugiés".split(), "noirs blancs arabes asiatiques".split(),
    "mujeres hombres niñas niños".split(), "musulmanes cristianos judíos hindúes budistas".split(), "extranjeros inmigrantes refugiados".split(), "negros blancos asiáticos".split(),
)
SWAPS = {w: g[(i + 1) % len(g)] for g in reversed(IDENTITIES) for i, w in enumerate(g)}
WORD = regex.compile(r"[\p{L}\p{M}]+(?:['’][\p{L}\p{M}]+)*")


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def features(words: set[str]) -> set[str]:
    """The words and their beginnings; identity terms count as whole words only, so that swapping them swaps all they add."""
    return words | {w[:k] + "*" for w in words if w not in SWAPS for k in STEMS if len(w) > k}


def counterfactual(words: set[str]) -> set[str]:
    """The words of the text with its identity terms swapped."""
    return {SWAPS.get(w, w) for w in words}


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, words: set[str]) -> float:
        z = self.bias + sum(map(self.weights.__getitem__, sorted(self.weights.keys() & features(words))))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


@dataclass
class Examples:
    """Rows as indices of the model's words; ``swapped`` has rows that name an identity as (row, swapped row)."""

    words: list[str]
    rows: list[list[int]]
    toxic: list[int]
    swapped: list[tuple[list[int], list[int]]]


def prior(toxic: int, rows: int) -> float:
    """Log-odds of the share of toxic rows."""
    return math.log((toxic + PRIOR) / (rows - toxic + 1 - PRIOR))


def fit(examples: Examples) -> Model:
    """Without both classes or without words the score is the share of toxic rows, smoothed."""
    n, positives, size = len(examples.toxic), sum(examples.toxic), len(examples.words)
    bias = prior(positives, n)
    if not positives or positives == n or not size:
        return Model({}, bias)

    def flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(rows)), [len(x) for x in rows]), np.array([i for x in rows for i in x], np.int64)

    y, named = np.array(examples.toxic, float), len(examples.swapped)
    r, c = flat(examples.rows)
    r1, c1 = flat([x for x, _ in examples.swapped])
    r2, c2 = flat([x for _, x in examples.swapped])
    w, m, v, b = np.zeros(size), np.zeros(size + 1), np.zeros(size + 1), bias
    for k in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-(np.bincount(r, w[c], n) + b)))
        g, gb = np.bincount(c, (p - y)[r], size) / n + RIDGE * w, (p - y).mean()
        if named:
            # the squared change of the score itself, by the slope of either version's score
            p1, p2 = (1 / (1 + np.exp(-(np.bincount(rows, w[at], named) + b))) for rows, at in ((r1, c1), (r2, c2)))
            a1, a2 = (2 * FAIRNESS / named * (p1 - p2) * q * (1 - q) for q in (p1, p2))
            g += np.bincount(c1, a1[r1], size) - np.bincount(c2, a2[r2], size)
            gb += (a1 - a2).sum()
        g = np.r_[g, gb]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8) * min(1, 4 * (1 - k / (STEPS + 1)))
        w, b = w - step[:-1], b - step[-1]
    return Model(dict(zip(examples.words, w.tolist(), strict=True)), float(b))


def held_out(key: Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 2 on division by 4 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def sampled_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: int = SAMPLE_ROWS) -> DataFrame:
    """(toxic, words) of at most ``sample`` labelled rows, with all distinct words of their whole texts.

    Null labels are left out, 1 means toxic and any other label not; of several labels of a key the
    largest counts, of several texts the first in order.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key))).groupBy(F.col(key).alias("__key")).agg(F.max((F.col(label) == 1).cast("int")).alias("toxic"))
    # by a hash, so that any bound takes a random part
    known = known.orderBy(F.xxhash64(F.col("__key"), F.lit(9)), "__key").limit(sample)
    chosen = docs.select(F.col(f"`{key}`").alias("__id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text")).join(known, F.col("__id") == F.col("__key"))
    chosen = chosen.groupBy("__id").agg(F.max("toxic").alias("toxic"), F.min("__text").alias("__text"))
    work = lambda texts: [pa.array([sorted(words_of(t)) for t in texts.to_pylist()], pa.list_(pa.string()))]
    return map_column(chosen, ["toxic"], "__text", [StructField("words", ArrayType(StringType()))], lambda: work)


def model_words(rows: DataFrame) -> list[str]:
    """All features that tell (LEAST_ROWS, LEAST_Z), and all identity terms seen often enough, so that the penalty can act on them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for y, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = list(features(set(words)))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([y] * len(found), pa.int32())], names=["word", "toxic"])

    total, positives = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    counts = rows.select("toxic", "words").mapInArrow(run, "word string, toxic int").groupBy("word").agg(F.sum("toxic").alias("yes"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_ROWS)
    a, b, c, d = F.col("yes") + 0.5, positives - F.col("yes") + 0.5, F.col("n") - F.col("yes") + 0.5, total - positives - (F.col("n") - F.col("yes")) + 0.5
    z = F.abs(F.log(a * d / (b * c)) / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d))
    scored = written(counts.select("word", F.round(z, 9).alias("z")), "features")
    best = scored.where(F.col("z") >= LEAST_Z)
    named = scored.where(F.col("word").isin(list(SWAPS)))
    return sorted(r["word"] for r in best.select("word").union(named.select("word")).distinct().toLocalIterator())


def examples(rows: DataFrame, words: list[str]) -> Examples:
    """What the fit needs of ``rows``: for each of at most SAMPLE_ROWS rows the indices of the model's words come to the driver."""
    sent = rows.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(words)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        own = lambda words: sorted(index[w] for w in index.keys() & features(words))
        for batch in batches:
            sets = [set(x) for x in batch.column(1).to_pylist()]
            swapped = [own(counterfactual(s)) if not SWAPS.keys().isdisjoint(s) else None for s in sets]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([own(s) for s in sets], kind), pa.array(swapped, kind)], names=["toxic", "own", "swapped"])

    got = sorted(((r["toxic"], r["own"], r["swapped"]) for r in rows.select("toxic", "words").mapInArrow(run, "toxic int, own array<int>, swapped array<int>").toLocalIterator()), key=lambda r: (r[0], r[1], r[2] or []))
    return Examples(words, [r[1] for r in got], [r[0] for r in got], [(r[1], r[2]) for r in got if r[2] is not None])


def score_documents(docs: DataFrame, model: Model, keep: list[str], text: str = "text", output: str = "score") -> DataFrame:
    """``keep`` columns and the score of each whole text. Null and empty texts get the model's base rate."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        score = sent.value.score
        return lambda texts: [pa.array([score(words_of(t)) for t in texts.to_pylist()], pa.float64())]

    return map_column(docs, keep, text, [StructField(output, DoubleType())], make)


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(key, held_out, score, predicted) for each row of ``docs``.

    Learned from ``labels`` that are not held out. Repeated rows are scored each; extra columns are
    ignored; with an empty label table every text gets the prior, which is below the threshold.
    """
    rows = written(sampled_rows(docs, labels, key, text, label), "training")
    model = fit(examples(rows, model_words(rows)))
    scored = score_documents(docs, model, [key], text)
    return scored.select(F.col(f"`{key}`"), held_out(F.col(f"`{key}`")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
