"""Drops by a classifier that is plugged in, and rules whose tests may fail."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import Rule
from ..functions.text import strip

#: The answer that keeps a document (a fixed value).
RELEVANT = "相关"


def _answers(classify: Callable[[list[str]], Sequence[str | None]], texts: list[str]) -> list[tuple[str | None, str | None]]:
    """(answer, error) for each text; if the batch fails, each text is asked for by itself."""
    try:
        found = list(classify(texts))
        if len(found) == len(texts):
            return [(None if a is None else str(a), None) for a in found]
        fault = f"{len(found)} answers to {len(texts)} texts"
    except Exception as e:  # the classifier is not ours
        fault = f"{type(e).__name__}: {e}"
    if len(texts) == 1:
        return [(None, fault)]
    return [pair for t in texts for pair in _answers(classify, [t])]


def relevant(docs: DataFrame, classify: Callable[[list[str]], Sequence[str | None]] | None, title: str = "title", answer: str = "relevance", keep_all: bool = False) -> DataFrame:
    """``docs`` less those that ``classify`` does not call relevant, with ``answer``: a struct of what it said and the error it met.

    ``classify`` takes titles in batches, in the workers. A document stays if the answer is exactly RELEVANT, if
    it has no title (which is not asked for), or if its own title met an error, which costs the
    others of its batch nothing; without a classifier all stay. ``keep_all`` only adds the answers.
    """
    if classify is None:
        return docs.withColumn(answer, F.lit(None).cast("struct<said: string, error: string>"))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            titles = batch.to_pylist()
            asked = [i for i, t in enumerate(titles) if t]
            said, error = [None] * len(titles), [None] * len(titles)
            for i, (a, e) in zip(asked, _answers(classify, [titles[i] for i in asked]) if asked else [], strict=True):
                said[i], error[i] = a, e
            yield pa.StructArray.from_arrays([pa.array(said, pa.string()), pa.array(error, pa.string())], ["said", "error"])

    found = F.arrow_udf(run, "said string, error string").asNondeterministic()(F.nullif(strip(F.col(title)), F.lit("")))
    out = docs.withColumn(answer, found)
    asked = F.coalesce(strip(F.col(title)), F.lit("")) != ""
    stays = ~asked | F.col(answer)["error"].isNotNull() | F.coalesce(F.btrim(F.col(answer)["said"]) == RELEVANT, F.lit(False))
    return out if keep_all else out.where(stays)


def by_function(message: str, test: Callable[..., bool], *others: str) -> Rule:
    """A rule whose ``test`` takes the value and the columns ``others`` of its row as texts, in Python; where it raises, the rule fails for that row and no other."""

    def holds(c: Column) -> Column:
        return F.arrow_udf(_kept_to_rows(test), "boolean")(c.cast("string"), *[F.col(o).cast("string") for o in others])

    return Rule(message, holds)


def _kept_to_rows(test: Callable[..., bool]) -> Callable[..., pa.Array]:
    def run(*columns: pa.Array) -> pa.Array:
        good = []
        for values in zip(*[c.to_pylist() for c in columns], strict=True):
            try:
                good.append(bool(test(*values)))
            except Exception:  # the test is not ours
                good.append(False)
        return pa.array(good, pa.bool_())

    return run
