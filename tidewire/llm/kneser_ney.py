"""Quality by an interpolated modified Kneser-Ney model of words, trained on trusted texts.

Words are 64-bit hashes. A text is a row of (word before, word, word after); a task packs those of many
texts into one compressed row for each shard of the middle word. A shard then has all trigrams with its
middle words, so their counts, the totals of both contexts and the continuation counts of the bigrams
are its own, for training and for scoring from the same rows. Only the words' own continuation counts
and the discounts come from all shards: a round over the trusted texts makes them first and sends each
shard those it needs. Each shard gives a sum for each text, and the sums of a text are added up. No
table of n-grams is written. The texts are scored in PASSES rounds, each over its part of the shards,
so that what is on disk at a time is bounded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

from .common import held, made, release, small_batches, written
from .winnow import mixed

ORDER = 3
#: Stand before a text ORDER - 1 times, and after it once.
PAD, END = (np.uint64(xxhash.xxh64_intdigest(b"", seed)) for seed in (1, 2))
#: Labelled keys that may be broadcast (16 bytes each).
BROADCAST_LABELS = 4_000_000
#: One in so many trusted texts is kept out of the counts and sets the thresholds, at this quantile of their perplexity.
HOLDOUT, QUANTILE, ACCURACY = 5, 0.99, 10_000
#: Bytes of a text that are split into words at a time; bounds what a very long text takes.
SLICE = 4 << 20
#: Words that a task packs at a time (one text may be longer), and texts of such a pack.
PACK_WORDS, PACK_TEXTS = 2_500_000, 1 << 16
#: Bytes of text for each shard.
SHARD_BYTES = 12 << 20
#: Rounds of scoring.
PASSES = 3
#: Bytes of text (about) in which frequent words are looked for, and how many of them have fixed numbers in all packs; any choice gives the same results.
SAMPLE_BYTES, FREQUENT = 32 << 20, 65_000
#: A sum's unit; whole numbers add up to the same in any order.
UNIT = 2.0**-24
CACHE_WORDS = 300_000
SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Types of a pack's arrays: the words without a fixed number, the three words of each trigram by their numbers (fixed ones first), steps of the text's number, whether a text is trained on.
TRIGRAMS = (np.uint64, np.uint32, np.uint32, np.uint32, np.uint16, np.uint8)
COUNTED = (np.uint64, np.uint32)
SUMS = (np.uint16, np.int64)
#: Whether what a finished execution has shuffled is removed.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class WordHashes(dict):
    """Word -> XXH64; forgets everything when full, which bounds a worker's memory."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def hashed(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased words (A-Z), what stands between white space."""
    data, found, at = (text or "").encode().lower(), [], 0
    known = held("model words", WordHashes).__getitem__
    while at < len(data):
        gap = SPACE.search(data, at + SLICE)
        end = gap.start() if gap else len(data)
        found.append(np.fromiter(map(known, data[at:end].split()), np.uint64))
        at = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes of equal weight next to each other, compressed."""
    raw = np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(data: bytes, kinds: tuple) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    at, found = 8 * len(kinds), []
    for n, kind in zip(np.frombuffer(raw, np.int64, len(kinds)).tolist(), kinds, strict=True):
        wide = np.dtype(kind).itemsize
        found.append(np.frombuffer(raw, np.uint8, n * wide, at).reshape(wide, n).T.copy().view(kind).ravel())
        at += n * wide
    return found


def numbered(values: np.ndarray, limit: int = 1 << 64) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique`` with the inverse, of whole numbers below ``limit``: numbers and places are sorted as one word as far as they fit."""
    values, bits = values.astype(np.uint64, copy=False), np.uint64(len(values).bit_length())
    whole = (limit - 1).bit_length() + int(bits) <= 64
    both = np.sort((values if whole else values >> bits) << bits | np.arange(len(values), dtype=np.uint64))
    order = (both & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    values, both = values[order], both >> bits
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    if not whole and (new[1:] != (both[1:] != both[:-1])).any():
        # different numbers of equal first bits may be mixed up
        again = np.argsort(values, kind="stable")
        order, values = order[again], values[again]
        new[1:] = values[1:] != values[:-1]
    found = np.empty(len(values), np.int32)
    found[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return values[new], found


def trigrams(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, before, middle, after, text): every word of every text as the middle, and a last PAD before each text. Places among ``words``."""
    rows = [(i, np.r_[PAD, PAD, w, END]) for i, w in enumerate(texts) if len(w)]
    if not rows:
        return (np.empty(0, np.uint64), *[np.empty(0, np.int32)] * 4)
    sizes = np.array([len(x) for _, x in rows])
    words, at = numbered(np.concatenate([x for _, x in rows]))
    ends = np.cumsum(sizes)
    inner = np.ones(len(at), bool)
    inner[ends - 1] = inner[ends - sizes] = False
    mid = np.flatnonzero(inner)
    return words, at[mid - 1], at[mid], at[mid + 1], np.repeat(np.array([i for i, _ in rows], np.int32), sizes - 2)


def fixed_numbers(words: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Each word's place in ``frequent``, or -1."""
    order = np.argsort(frequent)
    at = np.minimum(np.searchsorted(frequent[order], words), len(frequent) - 1)
    return np.where(frequent[order][at] == words, order[at], -1)


def packed(words: np.ndarray, number: np.ndarray, first: int, before: np.ndarray, mid: np.ndarray, after: np.ndarray, text: np.ndarray, trained: np.ndarray) -> bytes:
    order = np.argsort(mid, kind="stable")
    there = np.zeros(len(words), bool)
    for x in (before, mid, after):
        there[x] = True
    rare = np.flatnonzero(there & (number < 0))
    place = number.astype(np.uint32)
    place[rare] = first + np.arange(len(rare), dtype=np.uint32)
    return pack(np.diff(words[rare], prepend=np.uint64(0)), place[before[order]], place[mid[order]], place[after[order]], np.diff(text[order].astype(np.uint16), prepend=np.uint16(0)), trained)


def shard_of(words: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(words) % np.uint64(shards)).astype(np.int64)


class Shard:
    """The trigrams of some packs, whose middle words are all here."""

    def __init__(self, packs: list[bytes], frequent: np.ndarray):
        rare, places, docs, trained, self.sizes = [], [], [], [], []
        for data in packs:
            words, *at, steps, flags = unpack(data, TRIGRAMS)
            rare.append(np.cumsum(words, dtype=np.uint64))
            places.append(at)
            docs.append(np.cumsum(steps, dtype=np.uint16).astype(np.int32) + np.int32(sum(self.sizes)))
            trained.append(flags)
            self.sizes.append(len(flags))
        unique, where = numbered(np.concatenate(rare))
        self.words, first = np.r_[frequent, unique], 0
        for i, w in enumerate(rare):
            number = np.r_[np.arange(len(frequent), dtype=np.int32), np.int32(len(frequent)) + where[first : first + len(w)]]
            places[i] = [number[p] for p in places[i]]
            first += len(w)
        before, self.mid, after = (np.concatenate(x) for x in zip(*places, strict=True))
        del places, rare, where
        self.text, flags = np.concatenate(docs), np.concatenate(trained).view(bool)
        self.scored = after != 1
        size = len(self.words)
        contexts, context = numbered(self.mid.astype(np.uint64) * np.uint64(size) + before.astype(np.uint64), size * size)
        pairs, pair = numbered(self.mid.astype(np.uint64) * np.uint64(size) + after.astype(np.uint64), size * size)
        del before, after
        self.pair_mid, self.pair_after = (x.astype(np.int32) for x in np.divmod(pairs, np.uint64(size)))
        grams, self.gram = numbered(context.astype(np.uint64) * np.uint64(len(pairs)) + pair.astype(np.uint64), len(contexts) * len(pairs))
        self.gram_context, self.gram_pair = (x.astype(np.int32) for x in np.divmod(grams, np.uint64(len(pairs))))
        self.contexts = len(contexts)
        del contexts, context, pairs, pair, grams
        use = flags[self.text] & self.scored
        #: How often each trigram is in a text to train on, and how many words stand before each pair there.
        self.n3 = np.bincount(self.gram[use], minlength=len(self.gram_pair))
        self.n2 = np.bincount(self.gram_pair[self.n3 > 0], minlength=len(self.pair_mid))

    def asked(self) -> tuple[np.ndarray, np.ndarray]:
        """The words that end a pair to train on, and after how many of the middle words each stands."""
        n = np.bincount(self.pair_after[self.n2 > 0], minlength=len(self.words))
        at = np.flatnonzero(n)
        at = at[np.argsort(self.words[at])]
        return self.words[at], n[at]

    def sums(self, counts: tuple[np.ndarray, np.ndarray], model: Model) -> np.ndarray:
        """The part of each text's log-probability that its middle words here hold: what pairs and trigrams add, and the middle words' own."""
        words, n = counts
        at = np.searchsorted(words, self.words)
        n1 = np.where(np.r_[words, END][at] == self.words, np.r_[n, 0][at], 0)
        p1 = model.word(n1)
        # all probabilities as multiples of the last word's own
        total, weight, ratio = model.context(2, self.n2, self.pair_mid, len(self.words))
        low = np.where(total > 0, weight, 1.0)[self.pair_mid] + ratio / p1[self.pair_after]
        total, weight, ratio = model.context(3, self.n3, self.gram_context, self.contexts)
        high = np.where(total > 0, weight, 1.0)[self.gram_context] * low[self.gram_pair] + ratio / p1[self.pair_after][self.gram_pair]
        own = np.log(p1)
        own[0] = 0.0  # PAD
        value = np.where(self.scored, np.log(high)[self.gram], 0.0) + own[self.mid]
        return np.bincount(self.text, weights=value, minlength=sum(self.sizes))


class Model:
    """What all shards share: counts of counts and, of the words, how many pairs there are in all and how many words."""

    def __init__(self, seen: dict[int, list[int]], total: int, size: int):
        self.cut = {k: np.array([0.0, *discounts(*x)]) for k, x in seen.items()}
        self.total, self.size = total, size
        n1, n2, n3, n4 = seen[1]
        held_back = self.cut[1][1] * n1 + self.cut[1][2] * n2 + self.cut[1][3] * (size - n1 - n2)
        self.floor = held_back / total / (size + 1) if size else 1.0

    def word(self, n: np.ndarray) -> np.ndarray:
        return (n - self.cut[1][np.minimum(n, 3)]) / max(self.total, 1) + self.floor

    def context(self, order: int, n: np.ndarray, context: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(total, share held back) of each context, and each n-gram's own share."""
        cut = self.cut[order][np.minimum(n, 3)]
        total = np.bincount(context, weights=n, minlength=size)
        weight = np.bincount(context, weights=cut, minlength=size) / np.maximum(total, 1)
        return total, weight, (n - cut) / np.maximum(total, 1)[context]


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and more; estimates that few data put out of range are clipped."""
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    raw = [i - (i + 1) * y * b / a if a else 0.5 * i for i, (a, b) in enumerate([(n1, n2), (n2, n3), (n3, n4)], 1)]
    return tuple(min(max(d, 0.1), 0.95 * i) for i, d in enumerate(raw, 1))


def count_of_counts(n: np.ndarray) -> list[int]:
    return [int((n == i).sum()) for i in (1, 2, 3, 4)]


def labelled(docs: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """``docs`` with ``__use``: 1 to train on, 2 to set thresholds by, else null. A key is trusted if a label of it is 1."""
    use = F.when(F.crc32(F.col("__key").cast("string").cast("binary")) % HOLDOUT == 0, 2).otherwise(1)
    trusted = labels.where((F.col(label) == 1) & F.col(key).isNotNull()).select(F.col(key).alias("__key")).distinct().withColumn("__use", use)
    if labels.count() <= BROADCAST_LABELS:
        trusted = F.broadcast(trusted)
    return docs.join(trusted, F.col(f"`{key}`") == F.col("__key"), "left").drop("__key")


def frequent_words(docs: DataFrame, size: int) -> np.ndarray:
    """PAD, END and the words that are most frequent in some of the texts. They only make packs small: FREQUENT at most come to the driver."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = np.unique(np.concatenate([np.empty(0, np.uint64), *[hashed(t.as_py()) for t in batch.column(0)]]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n, pa.int64())], names=["word", "n"])

    some = docs.select("__text").sample(min(1.0, SAMPLE_BYTES / max(size, 1)), seed=1).mapInArrow(run, "word long, n long")
    rows = some.groupBy("word").agg(F.sum("n").alias("n")).where("n > 2").orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    return np.r_[PAD, END, np.array([x["word"] for x in rows], np.int64).view(np.uint64)]


def packs(used: DataFrame, frequent: Broadcast, shards: int, part: int, parts: int) -> DataFrame:
    """(shard, pack, data, at, __id, __lang, __use, words, fp): a row for each pack and shard of this part, and one for each text under a shard below 0."""
    small_batches(used.sparkSession)
    own = [used.schema[c] for c in ("__id", "__lang", "__use")]
    schema = StructType([StructField("shard", LongType()), StructField("pack", StringType()), StructField("data", BinaryType()), StructField("at", LongType()), *own, StructField("words", LongType()), StructField("fp", LongType())])

    def flushed(k: int, texts: list[np.ndarray], rows: list[pa.RecordBatch], prints: list[int], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
        task, size = TaskContext.get().partitionId(), len(texts)
        name = f"{task}-{k}"
        columns = pa.Table.from_batches(rows).combine_chunks()
        use = columns.column(2).to_numpy(zero_copy_only=False)
        words, before, mid, after, text = trigrams(texts)
        number, first = fixed_numbers(words, frequent.value), len(frequent.value)
        if parts:
            own = [pa.array(np.full(size, -1 - task)), pa.array([name] * size), pa.nulls(size, pa.binary()), pa.array(np.arange(size)), *[c.combine_chunks() for c in columns.columns[:3]]]
            yield from pa.Table.from_arrays([*own, pa.array([len(w) for w in texts], pa.int64()), pa.array(np.array(prints, np.uint64).view(np.int64))], names=schema.names).to_batches()
        shard = shard_of(words, shards)[mid] if len(words) else mid
        order = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(shards + 1))
        for s in range(shards):
            at = order[bounds[s] : bounds[s + 1]]
            if len(at) and (not parts or s % parts == part):
                data = packed(words, number, first, before[at], mid[at], after[at], text[at], (use == 1).astype(np.uint8))
                none = [pa.nulls(1, t) for t in types]
                yield pa.RecordBatch.from_arrays([pa.array([s]), pa.array([name]), pa.array([data], pa.binary()), pa.nulls(1, pa.int64()), *none, pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64())], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, rows, prints, n, k = [], [], [], 0, 0
        for batch in batches:
            types = [batch.schema.field(i).type for i in range(3)]
            first = 0
            for i, t in enumerate(batch.column(3)):
                t = t.as_py()
                texts.append(hashed(t))
                prints.append(xxhash.xxh64_intdigest((t or "").encode()))
                n += len(texts[-1])
                if n >= PACK_WORDS or len(texts) == PACK_TEXTS:
                    rows.append(batch.slice(first, i + 1 - first))
                    yield from flushed(k, texts, rows, prints, types)
                    texts, rows, prints, n, k, first = [], [], [], 0, k + 1, i + 1
            if first < batch.num_rows:
                rows.append(batch.slice(first))
        if texts:
            yield from flushed(k, texts, rows, prints, types)

    return used.select("__id", "__lang", "__use", "__text").mapInArrow(run, schema)


def trained(used: DataFrame, frequent: Broadcast, shards: int) -> tuple[DataFrame, Model]:
    """((shard, data), model): the counts of the words that each shard needs, and what all shards share."""
    numbers = [f"c{k}{i}" for k in (3, 2) for i in (1, 2, 3, 4)]

    def count(table: pa.Table) -> pa.Table:
        found = Shard(table.column("data").to_pylist(), frequent.value)
        words, n = found.asked()
        owner, stats = shard_of(words, shards), [*count_of_counts(found.n3), *count_of_counts(found.n2)]
        order = np.argsort(owner, kind="stable")
        bounds, out = np.searchsorted(owner[order], np.arange(shards + 1)), []
        for s in range(shards):
            at = order[bounds[s] : bounds[s + 1]]
            if len(at):
                out.append((s, table.column("shard")[0].as_py(), pack(np.diff(words[at], prepend=np.uint64(0)), n[at].astype(np.uint32)), *(stats if not out else [0] * 8)))
        return pa.table({c: pa.array([r[i] for r in out], pa.binary() if c == "data" else pa.int64()) for i, c in enumerate(["owner", "asker", "data", *numbers])})

    def add(table: pa.Table) -> pa.Table:
        got = [unpack(x, COUNTED) for x in table.column("data").to_pylist()]
        asked = [np.cumsum(w, dtype=np.uint64) for w, _ in got]
        words, where = numbered(np.concatenate(asked))
        n = np.bincount(where, weights=np.concatenate([x for _, x in got])).astype(np.int64)
        owner, places, first = table.column("owner")[0].as_py(), {}, 0
        for who, w in zip(table.column("asker").to_pylist(), asked, strict=True):
            places[who] = where[first : first + len(w)]
            first += len(w)
        # the owner scores these words as middle words
        places[owner] = np.arange(len(words))
        out = [(who, pack(np.diff(words[at], prepend=np.uint64(0)), n[at].astype(np.uint32))) for who, at in places.items()]
        stats = [*count_of_counts(n), int(n.sum()), len(n)]
        return pa.table({"shard": pa.array([x for x, _ in out], pa.int64()), "data": pa.array([x for _, x in out], pa.binary()), **{f"c1{i}": pa.array([v] + [0] * (len(out) - 1), pa.int64()) for i, v in enumerate(stats, 1)}})

    spark = used.sparkSession
    rows = packs(used.where("__use = 1"), frequent, shards, 0, 0)
    asked, gone = written_once(rows.groupBy("shard").applyInArrow(count, "owner long, asker long, data binary, " + ", ".join(f"{c} long" for c in numbers)), "asked")
    answers, _ = written_once(asked.groupBy("owner").applyInArrow(add, "shard long, data binary, " + ", ".join(f"c1{i} long" for i in range(1, 7))), "words")
    high = [x or 0 for x in asked.agg(*[F.sum(c) for c in numbers]).first()]
    low = [x or 0 for x in answers.agg(*[F.sum(f"c1{i}") for i in range(1, 7)]).first()]
    release(spark, [gone])
    return answers.select("shard", "data"), Model({3: high[:4], 2: high[4:], 1: low[:4]}, *low[4:])


def written_once(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` as a table, and its path; what was shuffled for it is given up."""
    spark, before = df.sparkSession, set(made())
    kept = spark.conf.get(CLEAN)
    spark.conf.set(CLEAN, "true")
    try:
        out = written(df, name)
    finally:
        spark.conf.set(CLEAN, kept)
    return out, next(p for p in made() if p not in before)


def scored(used: DataFrame, frequent: Broadcast, answers: DataFrame, model: Model, shards: int, part: int) -> DataFrame:
    """(__id, __lang, __use, words, fp, log_p) of each row: what the shards of this part add to its log-probability."""
    own = ["__id", "__lang", "__use", "words", "fp"]
    both = packs(used, frequent, shards, part, PASSES).withColumn("counts", F.lit(False))
    counts = answers.where(F.col("shard") % PASSES == part).select("shard", "data", F.lit(True).alias("counts"))
    fields = [both.schema[c] for c in ("pack", "data", "at", *own)]
    shape = StructType(fields)

    def judge(table: pa.Table) -> pa.Table:
        if table.column("shard")[0].as_py() < 0:
            return table.select(shape.names)
        is_count = table.column("counts").to_numpy(zero_copy_only=False).astype(bool)
        data = table.column("data").to_pylist()
        got = [unpack(d, COUNTED) for d, c in zip(data, is_count, strict=True) if c]
        mine, names = [d for d, c in zip(data, is_count, strict=True) if not c], [p for p, c in zip(table.column("pack").to_pylist(), is_count, strict=True) if not c]
        schema = table.select(shape.names).schema
        if not mine:
            return schema.empty_table()
        words, at = np.unique(np.concatenate([np.empty(0, np.uint64), *[np.cumsum(w, dtype=np.uint64) for w, _ in got]]), return_index=True)
        found = Shard(mine, frequent.value)
        sums = np.rint(1 / UNIT * found.sums((words, np.concatenate([np.empty(0, np.uint32), *[n for _, n in got]])[at]), model)).astype(np.int64)
        out, first = [], 0
        for n in found.sizes:
            own_sums = sums[first : first + n]
            there = np.flatnonzero(own_sums)
            out.append(pack(there.astype(np.uint16), own_sums[there]))
            first += n
        return pa.Table.from_arrays([pa.array(names), pa.array(out, pa.binary()), *[pa.nulls(len(out), f.type) for f in list(schema)[2:]]], names=shape.names)

    def gather(table: pa.Table) -> pa.Table:
        data = table.column("data").to_pylist()
        rows = table.filter(pa.array([d is None for d in data]))
        sums = np.zeros(PACK_TEXTS, np.int64)
        for at, x in (unpack(d, SUMS) for d in data if d is not None):
            sums[at] += x
        return rows.select(own).append_column("log_p", pa.array(sums[rows.column("at").to_numpy()] * UNIT))

    parts = both.unionByName(counts, allowMissingColumns=True).groupBy("shard").applyInArrow(judge, shape)
    return parts.groupBy("pack").applyInArrow(gather, StructType([*[both.schema[c] for c in own], StructField("log_p", DoubleType())]))


def perplexity(log_p: Column, words: Column) -> Column:
    return F.when(words > 0, F.exp(-log_p / words))


def quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", label: str = "quality") -> DataFrame:
    """(key, lang, perplexity, cutoff, kept): a text is kept if its perplexity is at most its language's cutoff.

    The cutoff is a quantile over trusted texts that the model has not counted. Null and empty texts
    have no perplexity and are not kept. A language (or null) without such texts has no cutoff and
    keeps its texts. Repeated rows are scored each; extra columns are ignored; without labels all
    texts with words are kept.
    """
    base = docs.select(F.col(f"`{key}`").alias("__id"), F.col(f"`{lang}`").alias("__lang"), F.col(f"`{text}`").alias("__text"))
    used = labelled(base, labels if key == "__id" else labels.withColumnRenamed(key, "__id"), "__id", label)
    size = base.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    shards = 1 + size // SHARD_BYTES
    frequent = base.sparkSession.sparkContext.broadcast(frequent_words(base, size))
    answers, model = trained(used, frequent, shards)
    keys, parts = ["__id", "__lang", "__use", "words", "fp"], None
    for part in range(PASSES):
        one, _ = written_once(scored(used, frequent, answers, model, shards, part), "sums")
        parts = one if parts is None else parts.union(one)
    # equal rows have equal sums; each of them is given back
    summed = parts.groupBy(*keys).agg(F.sum("log_p").alias("log_p"), (F.count(F.lit(1)) / PASSES).cast("int").alias("n"))
    scored_rows = summed.withColumn("log_p", F.col("log_p") / F.col("n")).withColumn("one", F.explode(F.sequence(F.lit(1), F.col("n"))))
    # sums of floating-point terms depend on their order; this many digits do not
    rows = written(scored_rows.withColumn("perplexity", F.round(perplexity(F.col("log_p"), F.col("words")), 6)), "perplexity")
    limits = rows.where("__use = 2").groupBy(F.col("__lang").alias("__l")).agg(F.percentile_approx("perplexity", QUANTILE, ACCURACY).alias("cutoff"))
    out = rows.join(limits, F.col("__lang").eqNullSafe(F.col("__l")), "left")
    kept = F.col("perplexity").isNotNull() & (F.col("cutoff").isNull() | (F.col("perplexity") <= F.col("cutoff")))
    return out.select(F.col("__id").alias(key), F.col("__lang").alias(lang), "perplexity", "cutoff", kept.alias("kept"))
