"""Benchmark decontamination by winnowing.

Of every window of w k-gram hashes the least is kept as a fingerprint, so any span of w + k - 1
words that a document shares with an item yields a common fingerprint. Common ones are joined and
extended word by word; a run of SPAN words is contamination. Items shorter than SPAN have windows
of one hash of their own length: for them every k-gram is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .common import held, map_column, written

#: Shared words that count, and the k of the k-grams; the window is SPAN - GRAM + 1 hashes.
SPAN, GRAM = 10, 5
#: Bits of the filter over item fingerprints (128 kB to 16 MB for each run length); it only spares work, whatever passes is joined.
LEAST_FILTER_BITS, MOST_FILTER_BITS = 1 << 20, 1 << 27
#: Item fingerprints that may be broadcast (under 20 MB); more are joined by shuffling.
BROADCAST_ROWS = 100_000
#: Contaminated rows (a number, a count and item keys each) that may be broadcast.
BROADCAST_FOUND = 20_000
CACHE_WORDS = 200_000
#: Lower-cases A-Z; all other bytes below 0x80 that are no digit or letter end a word.
FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
HIT = pa.struct([("need", pa.int32()), ("fp", pa.int64()), ("pos", pa.int32()), ("first", pa.int32()), ("around", pa.list_(pa.int64()))])
HIT_TYPE = StructType([StructField("need", IntegerType()), StructField("fp", LongType()), StructField("pos", IntegerType()), StructField("first", IntegerType()), StructField("around", ArrayType(LongType()))])


class WordHashes(dict):
    """Word -> XXH64; forgets everything when full, which bounds a worker's memory."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def word_hashes() -> WordHashes:
    return held("words", WordHashes)


def hashed_words(text: str | None) -> np.ndarray:
    return np.fromiter(map(word_hashes().__getitem__, (text or "").encode().translate(FOLD).split()), np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    if len(words) < k:
        return np.empty(0, np.uint64)
    out = words[: len(words) - k + 1].copy()
    for i in range(1, k):
        out = out * BASE + words[i : len(words) - k + 1 + i]
    return mixed(out)


def winnowed(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions kept: the rightmost least hash of every window (of all hashes, if fewer)."""
    if window == 1 or not len(hashes):
        return np.arange(len(hashes))
    window = min(window, len(hashes))
    views = np.lib.stride_tricks.sliding_window_view(hashes[::-1], window)
    at = np.argmin(views, axis=1) + np.arange(len(views))
    return np.unique(len(hashes) - 1 - at)


def scheme(need: int) -> tuple[int, int]:
    """(k, hashes in a window) that find every shared run of ``need`` words."""
    return (GRAM, SPAN - GRAM + 1) if need == SPAN else (need, 1)


def fingerprints(words: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept positions and their hashes."""
    k, window = scheme(need)
    hashes = gram_hashes(words, k)
    at = winnowed(hashes, window)
    return at, hashes[at]


def around(words: np.ndarray, pos: int, need: int) -> tuple[int, list[int]]:
    """The words that a run of ``need`` around a kept k-gram can hold, after the place of the first."""
    first = max(0, pos - (need - scheme(need)[0]))
    return first, words[first : pos + need].view(np.int64).tolist()


def item_fingerprints(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, need, fp, pos, first, around) of each distinct item. Null keys and items without words have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = hashed_words(t)
                if not len(words) or key is None:
                    continue
                need = min(SPAN, len(words))
                for pos, fp in zip(*(x.tolist() for x in fingerprints(words, need)), strict=True):
                    rows.append((key, need, fp - (fp >> 63 << 64), pos, *around(words, pos, need)))
            types = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
            cols = list(zip(*rows, strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["item", "need", "fp", "pos", "first", "around"])

    kind = items.schema[item].dataType.simpleString()
    chosen = items.select(F.col(f"`{item}`").alias("item"), F.col(f"`{text}`").alias("text")).distinct()
    return chosen.mapInArrow(run, f"item {kind}, need int, fp bigint, pos int, first int, around array<bigint>")


def slots(fp: np.ndarray, bits: int) -> np.ndarray:
    return (fp & np.uint64(bits - 1)).astype(np.int64)


def set_bits(bits: np.ndarray, fp: np.ndarray) -> None:
    at = slots(fp, 8 * len(bits))
    np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))


def has_bits(bits: np.ndarray, fp: np.ndarray) -> np.ndarray:
    at = slots(fp, 8 * len(bits))
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def filter_bits(fingerprints: int) -> int:
    """A power of two of at least 16 bits for each fingerprint, so that at most 1 in 16 others passes, within fixed bounds."""
    return min(MOST_FILTER_BITS, max(LEAST_FILTER_BITS, 1 << (16 * max(1, fingerprints) - 1).bit_length()))


def filters(fps: DataFrame, n: int) -> dict[int, np.ndarray]:
    """For each run length a bitmap with a bit for every item fingerprint, sized by their number ``n``. Set in tasks, merged as bits."""
    size = filter_bits(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: dict[int, np.ndarray] = {}
        for batch in batches:
            need, fp = np.asarray(batch.column(0)), np.asarray(batch.column(1)).view(np.uint64)
            for n in np.unique(need).tolist():
                set_bits(bits.setdefault(n, np.zeros(size // 8, np.uint8)), fp[need == n])
        yield pa.RecordBatch.from_arrays([pa.array(list(bits), pa.int32()), pa.array([b.tobytes() for b in bits.values()], pa.binary())], names=["need", "bits"])

    # SPAN lengths at most in eight partitions: what comes to the driver has a fixed bound
    found: dict[int, np.ndarray] = {}
    for row in fps.select("need", "fp").coalesce(8).mapInArrow(run, "need int, bits binary").toLocalIterator():
        one = np.frombuffer(row["bits"], np.uint8)
        found[row["need"]] = found[row["need"]] | one if row["need"] in found else one
    return found


def document_hits(docs: DataFrame, maps: dict[int, np.ndarray], keep: list[str], text: str) -> DataFrame:
    """``keep`` columns, n_words and __hits: the kept k-grams of each whole text that pass the filter, with the words around."""
    sent = docs.sparkSession.sparkContext.broadcast({n: b.tobytes() for n, b in maps.items()})

    def make():
        word_hashes()
        # views of the broadcast bytes: a bit stays a bit
        bits = {n: np.frombuffer(b, np.uint8) for n, b in sent.value.items()}

        def work(texts: pa.Array) -> list[pa.Array]:
            counts, hits = [], []
            for t in texts:
                words, own = hashed_words(t.as_py()), []
                counts.append(len(words))
                for need, seen in bits.items():
                    at, fps = fingerprints(words, need)
                    passed = has_bits(seen, fps)
                    for pos, fp in zip(at[passed].tolist(), fps[passed].tolist(), strict=True):
                        first, near = around(words, pos, need)
                        own.append({"need": need, "fp": fp - (fp >> 63 << 64), "pos": pos, "first": first, "around": near})
                hits.append(own)
            return [pa.array(counts, pa.int64()), pa.array(hits, pa.list_(HIT))]

        return work

    return map_column(docs, keep, text, [StructField("n_words", LongType()), StructField("__hits", ArrayType(HIT_TYPE))], make)


def _agreeing(left: Column, right: Column) -> Column:
    """How many elements two arrays share from their start on."""
    same = F.concat(F.zip_with(left, right, lambda x, y: F.coalesce(x == y, F.lit(False))), F.array(F.lit(False)))
    return F.array_position(same, F.lit(False)) - 1


def contaminated_spans(hits: DataFrame, fps: DataFrame, n: int) -> DataFrame:
    """(__row, item, start, stop): runs of words that documents share with items, long enough to count."""
    d = hits.where(F.size("__hits") > 0).select("__row", F.explode("__hits").alias("h")).select("__row", "h.*")
    i = fps.select(F.col("need").alias("i_need"), F.col("fp").alias("i_fp"), F.col("pos").alias("i_pos"), F.col("first").alias("i_first"), F.col("around").alias("i_around"), "item")
    if n <= BROADCAST_ROWS:
        i = F.broadcast(i)
    both = d.join(i, (F.col("fp") == F.col("i_fp")) & (F.col("need") == F.col("i_need")))
    before = lambda p: F.reverse(F.slice(f"{p}around", F.lit(1), F.col(f"{p}pos") - F.col(f"{p}first")))
    after = lambda p: F.slice(f"{p}around", F.col(f"{p}pos") - F.col(f"{p}first") + 1, F.size(f"{p}around"))
    run = both.select("__row", "item", "need", "pos", _agreeing(before(""), before("i_")).alias("left"), _agreeing(after(""), after("i_")).alias("right"))
    return run.where(F.col("left") + F.col("right") >= F.col("need")).select("__row", "item", (F.col("pos") - F.col("left")).alias("start"), (F.col("pos") + F.col("right")).alias("stop"))


def union_length(spans: Column) -> Column:
    """Words that sorted (start, stop) spans cover."""
    step = lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), s["stop"] - F.greatest(s["start"], acc["at"]))).alias("n"), F.greatest(acc["at"], s["stop"]).alias("at"))
    zero = F.lit(0).cast("long")
    return F.aggregate(spans, F.struct(zero.alias("n"), zero.alias("at")), step)["n"]


def decontaminate(docs: DataFrame, items: DataFrame, keep: list[str], text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``keep`` columns, n_words, n_hit, items (keys as strings, sorted) and contaminated, for each row of ``docs``.

    Null and empty texts have no words and are clean. Repeated rows and items, ties and null keys are
    judged row by row; items with a null key are ignored. Without items every text is clean. Kept
    columns that clash with a result column give way to it.
    """
    keep = [c for c in dict.fromkeys(keep) if c not in {"n_words", "n_hit", "items", "contaminated"}]
    fps = written(item_fingerprints(items, item, item_text), "items")
    n = fps.count()
    hits = document_hits(docs, filters(fps, n), keep, text)
    hits = written(hits.withColumn("__row", F.monotonically_increasing_id()), "hits")
    spans = contaminated_spans(hits, fps, n)
    found = spans.groupBy(F.col("__row").alias("__r")).agg(
        F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("__spans"), F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("__items")
    )
    found = written(found.select("__r", union_length(F.col("__spans")).alias("__n_hit"), "__items"), "found")
    if found.count() <= BROADCAST_FOUND:
        found = F.broadcast(found)
    out = hits.join(found, F.col("__row") == F.col("__r"), "left")
    return out.select(
        *[F.col(f"`{c}`") for c in keep], "n_words", F.coalesce("__n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("__items", F.array().cast("array<string>")).alias("items"), (F.coalesce("__n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
