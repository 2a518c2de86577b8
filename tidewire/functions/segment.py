"""Words of texts without spaces: the most probable path through a graph of dictionary words."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



class Segmenter:
    """``counts`` (word -> how often) and the most probable way to cut a text into words.

    The probability of a word is its share of all counts; a character that begins no word stands alone,
    as if it had been seen once. Of equally probable ways the one whose first word is longest is taken.
    """

    def __init__(self, counts: Mapping[str, int]) -> None:
        self.logs = {w: math.log(n) for w, n in counts.items() if w and n > 0}
        self.total = math.log(max(1, sum(n for n in counts.values() if n > 0)))
        self.longest = max(map(len, self.logs), default=1)
        self.begins = {w[:i] for w in self.logs for i in range(1, len(w))}

    def words(self, text: str) -> list[str]:
        n = len(text)
        best, step = [0.0] * (n + 1), [1] * (n + 1)
        for i in range(n - 1, -1, -1):
            top, by = -math.inf, 1
            for j in range(i + 1, min(n, i + self.longest) + 1):
                piece = text[i:j]
                log = self.logs.get(piece, 0.0 if j == i + 1 else None)
                if log is not None and (score := log - self.total + best[j]) >= top:
                    top, by = score, j - i
                if piece not in self.begins:
                    break
            best[i], step[i] = top, by
        out, at = [], 0
        while at < n:
            out.append(text[at : at + step[at]])
            at += step[at]
        return out


def word_counts(texts: DataFrame, column: str, most: int) -> dict[str, int]:
    """The ``most`` commonest words of texts that have spaces (ties by the word): a dictionary whose size is bounded."""
    words = texts.select(F.explode(F.regexp_extract_all(F.lower(column), F.lit(r"\p{L}+"), F.lit(0))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return {r["w"]: r["n"] for r in words.orderBy(F.desc("n"), "w").limit(most).collect()}


def segmented(spark, col: Column, counts: Mapping[str, int], drop: Sequence[str] = ()) -> Column:
    """An array of a text's words, less some; what is no letter or digit separates words and is left out. Null for null.

    The dictionary is sent to each executor once. Runs of letters are cut as a whole, however long they are.
    """
    sent, less = spark.sparkContext.broadcast(dict(counts)), frozenset(drop)

    def make() -> Callable[[str], list[str]]:
        own = Segmenter(sent.value)
        return lambda run: [w for w in own.words(run) if w not in less]

    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = make()
        for batch in batches:
            yield pa.array([None if runs is None else [w for run in runs for w in words(run)] for runs in batch.to_pylist()], pa.list_(pa.string()))

    runs = F.regexp_extract_all(F.lower(col), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.arrow_udf(cut, "array<string>")(runs)
