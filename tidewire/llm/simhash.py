"""SimHash fingerprints and near-duplicate groups, by a Gray-order hierarchical index.

Fingerprints that differ in few bits share most of their bits, so they stand under common masked
patterns. The upper nodes of the index are those patterns: with the 64 bits in four blocks, two
fingerprints that differ in at most two bits agree on two whole blocks, so they meet under at least
one of six nodes. A crowded node has six children by the same rule: the bits it leaves open, in four
blocks, of which members of a child agree on two. After three levels 8 bits are open, so no node is
large. Below a node, fingerprints are sorted by Gray rank and every run of eight becomes a node of
the bits they share. A pair of nodes whose shared bits already differ in more than the limit is
pruned with all its members.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from .common import map_column, written
from .components import components

#: Shingle words and the differing bits at which fingerprints link.
WORDS, DIFFERENCES = 3, 2
#: A node with more members has children instead of runs.
CROWDED = 128
RUN = 8
SEED = 42
#: Shingles summed at a time; bounds what a very long text takes.
SLICE = 1 << 18


def children(mask: int) -> list[int]:
    """The masks below a mask of shared bits: two of the four blocks that it leaves open are shared too."""
    still_open = [b for b in range(63, -1, -1) if not mask >> b & 1]
    size = len(still_open) // 4
    blocks = [sum(1 << b for b in still_open[i : i + size]) for i in range(0, 4 * size, size)]
    return [mask | a | b for a, b in combinations(blocks, 2)]


#: The masks of each level; below the last, 8 bits are open and a node has 256 members at most.
LEVELS = [children(0)]
while 64 - LEVELS[-1][0].bit_count() > 8:
    LEVELS.append([m for mask in LEVELS[-1] for m in children(mask)])


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def bit_sums(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set; bytes are summed side by side, 255 rows at a time."""
    n, ones = len(hashes), np.uint64(0x0101010101010101)
    rows = -(-n // 255)
    if rows * 255 != n:
        hashes = np.concatenate([hashes, np.zeros(rows * 255 - n, np.uint64)])
    lanes = hashes.reshape(rows, 255)
    sums = np.empty(64, np.int64)
    for k in range(8):
        part = ((lanes >> np.uint64(k)) & ones).sum(axis=1, dtype=np.uint64)
        sums[k::8] = part.view(np.uint8).reshape(rows, 8).sum(axis=0, dtype=np.int64)
    return sums


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """SimHash over word shingles with repeats; 0 for a text without words. Unsigned."""
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    digest, n = xxhash.xxh64_intdigest, max(1, len(w) - words + 1)
    sums = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        part = w[at : min(at + SLICE, n) + words - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(words)), strict=False)) if len(w) > words else [b" ".join(w)]
        sums += bit_sums(np.array([digest(g, SEED) for g in grams], np.uint64))
    return sum(1 << b for b in range(64) if 2 * sums[b] > n)


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", output: str = "fp", words: int = WORDS) -> DataFrame:
    """``keep`` columns and the fingerprint as a signed long. Row-local."""

    def make():
        return lambda texts: [pa.array([signed(fingerprint(t, words)) for t in texts.to_pylist()], pa.int64())]

    return map_column(docs, keep, text, [StructField(output, LongType())], make)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _pairs(first: np.ndarray, count: np.ndarray, other: np.ndarray, other_count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All members of one node with all members of the other, for each pair of nodes."""
    total = count * other_count
    which = np.repeat(np.arange(len(total)), total)
    at = np.arange(len(which)) - np.repeat(np.cumsum(total) - total, total)
    return first[which] + at // other_count[which], other[which] + at % other_count[which]


def node_links(node: np.ndarray, code: np.ndarray, limit: int = DIFFERENCES) -> tuple[np.ndarray, np.ndarray]:
    """Links among codes under equal nodes: each linked code with the smallest index its group reaches.

    ``node`` must be sorted. The members of each node are put in Gray order first.
    """
    order = np.lexsort((gray_rank(code), node))
    node, code = node[order], code[order]
    start = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    size = np.diff(np.r_[start, len(node)])
    # runs of up to RUN members, none across nodes
    runs = -(-size // RUN)
    owner = np.repeat(np.arange(len(start)), runs)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    run_at = start[owner] + nth * RUN
    run_size = np.minimum(RUN, size[owner] - nth * RUN)
    same = ~(np.bitwise_or.reduceat(code, run_at) ^ np.bitwise_and.reduceat(code, run_at))
    pattern = code[run_at]
    first_run = np.cumsum(runs) - runs
    a, b = _pairs(first_run, runs, first_run, runs)
    keep = a <= b
    a, b = a[keep], b[keep]
    near = popcount((pattern[a] ^ pattern[b]) & same[a] & same[b]) <= limit
    a, b = a[near], b[near]
    left, right = _pairs(run_at[a], run_size[a], run_at[b], run_size[b])
    keep = left < right
    left, right = left[keep], right[keep]
    near = popcount(code[left] ^ code[right]) <= limit
    left, right = left[near], right[near]
    # a star for each group: less to shuffle than all its pairs
    root = np.arange(len(code))
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if np.array_equal(root, before):
            break
    moved = np.flatnonzero(root != np.arange(len(code)))
    return code[moved], code[root[moved]]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (mask, node, fp) batches to links; the last node of a batch waits for the next one."""
    rest: list[np.ndarray] | None = None

    def links(view: np.ndarray, node: np.ndarray, fp: np.ndarray):
        key = np.cumsum(np.r_[0, (view[1:] != view[:-1]) | (node[1:] != node[:-1])])
        a, b = node_links(key, fp.view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        now = [np.asarray(batch.column(i)) for i in range(3)]
        if rest is not None:
            now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
        if not len(now[0]):
            continue
        last = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
        cut = int(np.argmax(last))
        rest = [x[cut:] for x in now]
        if cut:
            yield links(*(x[:cut] for x in now))
    if rest is not None:
        yield links(*rest)


def links(fps: DataFrame) -> DataFrame:
    """(a, b) links that join all fingerprints (distinct ``fp``) differing in at most two bits, within their groups.

    A node is a mask and the bits under it. Each level searches its small nodes and hands the members
    of crowded ones to their children.
    """
    found, crowded = None, fps.select("fp", F.lit(0).alias("mask"))
    for level, masks in enumerate(LEVELS):
        below = len(LEVELS[0]) * F.col("mask")
        node = lambda m: F.struct(m.alias("mask"), F.col("fp").bitwiseAND(F.get(F.array(*[F.lit(signed(x)) for x in masks]), m)).alias("node"))  # noqa: B023, E731
        nodes = crowded.select("fp", F.explode(F.transform(F.sequence(F.lit(0), F.lit(len(LEVELS[0]) - 1)), lambda i: node(below + i))).alias("n")).select("fp", "n.*")  # noqa: B023
        sizes = nodes.groupBy("mask", "node").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        sizes = sizes.select(F.col("mask").alias("m"), F.col("node").alias("n"), "members")
        shared = written(nodes.join(sizes, (F.col("mask") == F.col("m")) & (F.col("node") == F.col("n"))).select("mask", "node", "fp", "members"), "nodes")
        last = level == len(LEVELS) - 1
        small = (shared if last else shared.where(F.col("members") <= CROWDED)).select("mask", "node", "fp")
        here = small.repartition("mask", "node").sortWithinPartitions("mask", "node").mapInArrow(_search, "a long, b long")
        found = here if found is None else found.union(here)
        crowded = shared.where(F.col("members") > CROWDED).select("fp", "mask")
        if last or crowded.isEmpty():
            return found


def hex_fp(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def named_fingerprints(rows: DataFrame) -> DataFrame:
    """(fp, root, component_id) for every fingerprint of ``rows`` (__key, fp)."""
    # copies are one fingerprint from here on
    fps = written(rows.groupBy("fp").agg(F.min("__key").alias("least")), "distinct")
    roots = components(links(fps.select("fp")))
    placed = fps.join(roots, F.col("fp") == F.col("v"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id")).select(F.col("root").alias("__root"), "component_id")
    return placed.join(least, F.col("root") == F.col("__root")).select(F.col("fp").alias("__fp"), "root", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(key, fp, component_id): component_id is the smallest key of the group of linked fingerprints.

    Null and empty texts have fingerprint 0 and link like others. Repeated rows are kept as rows.
    Null keys get the component of their fingerprint, and never name one unless all keys of it are
    null. Extra columns are ignored; an empty table gives an empty result.
    """
    base = docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text"))
    rows = written(fingerprints(base, ["__key"], "__text", "fp", words), "fingerprints")
    named = named_fingerprints(rows)
    return rows.join(named, F.col("fp") == F.col("__fp"), "left").select(F.col("__key").alias(key), "fp", "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` less near-duplicates: of each group the row with the smallest key stays (of equal keys, one)."""
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text"))
    rows = written(fingerprints(base, ["__doc", "__key"], "__text", "fp", words).withColumn("__row", F.monotonically_increasing_id()), "fingerprints")
    small = rows.select("__key", "fp", "__row")
    placed = small.join(named_fingerprints(small), F.col("fp") == F.col("__fp"))
    first = placed.groupBy("root").agg(F.min(F.struct(F.col("__key").isNull(), "__key", "__row")).alias("m")).select(F.col("m.__row").alias("__first"))
    return rows.join(first, F.col("__row") == F.col("__first"), "left_semi").select("__doc.*")
