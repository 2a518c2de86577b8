"""Near-duplicates at a Jaccard similarity over whole shingle sets, by a Gray-order index with a large radius.

Each text has a SimHash fingerprint of 64 bits over its set of five-word shingles, and 64 min-wise
hashes of that set. The upper nodes of the index are pairs of the first eight min-wise hashes: texts at
similarity 0.8 share one of twelve nodes with probability 0.9993. Texts of crowded nodes go to 24
narrower nodes of six hashes each, of which such texts share one with probability 0.9993 again, but
texts that only share a passage hardly any. Shingles that few crowded texts hold are joined, so that
their common number is known for every pair that shares one; in any other pair they are shared by
none, and a text with over a fifth of them goes no further. Within a node all are compared with one
member first (in narrow nodes the one that shares most), as copies of one text then join in linear
work. Below a small node fingerprints stand in Gray order in runs of eight, and runs whose shared
bits differ in more than the radius are pruned; in a narrow node that is still crowded, those outside
its largest group are compared with all in blocks, less pairs that their rare shingles rule out. What
remains are candidates: only pairs whose full shingle sets reach the similarity link.

The index joins nearly all that is similar, but a radius, a sketch or a node may miss a pair. What it
has not joined is therefore searched once more without loss: in one order of all shingles, the least
frequent first, two similar sets have a shingle in common among the first fifth of each. Lists of sets
by such shingles, if they hold more than one group, are compared in blocks, less pairs that places,
sizes or the parities of the sets rule out for certain, and the rest is compared on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from .common import held, made, map_column, release, written
from .components import components
from .simhash import RUN, SEED, SLICE, _pairs, bit_sums, gray_rank, popcount

#: Shingle words and the Jaccard similarity from which texts link.
WORDS, SIMILAR = 5, 0.8
#: Differing bits of candidates: at similarity 0.8, 9.7 of 64 differ on average (12 in sets of four and five) and over 24 in fewer than 1 of 10,000 pairs.
RADIUS = 24
#: Of 64 min-wise hashes, cut to four bits each, at least so many are equal: at similarity 0.8, 52 on average and under 40 in 1 of 20,000 pairs.
ALIKE = 40
NIBBLES = np.uint64(0x1111111111111111)
#: Members of a node that are compared with each other in one task; and of a block in fuller ones.
CROWDED = 128
#: Hashes of shingles that a verifying task keeps.
CACHED = 4_000_000
#: Shingles in at most so many crowded texts are rare.
RARE = 8
#: Shingles whose frequency counts in the order, and of how many sets one is counted for it. They change no result: any order finds all.
COMMON, COUNTED = 1 << 16, 16
#: Bits of a shingle by which sets meet (others with the same bits only make more candidates), such bits in a shard, and shards at least.
KEY, SHARD, SHARDS = 40, 1 << 20, 64
#: Bits of a set's parities in the packed lists; and of those that pairs are compared by before their texts are.
NARROW_BITS, WIDE_BITS = 256, 4096
#: Pairs that are looked at together.
TOGETHER = 1 << 18
BITS, BANDED = 64, 8
VIEWS = [(i, j) for part in range(0, BANDED, 4) for i, j in combinations(range(part, part + 4), 2)]
_random = np.random.default_rng(SEED)
#: The hashes of each narrow node.
NARROW = np.sort(np.array([np.random.default_rng((SEED, k)).permutation(BITS)[:6] for k in range(24)]), axis=1)
MULTIPLIERS = _random.integers(0, 1 << 63, BITS, np.uint64) * np.uint64(2) + np.uint64(1)
ADDENDS = _random.integers(0, 1 << 63, BITS, np.uint64)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a shorter text is one shingle, a text without words none."""
    w = (text or "").encode().lower().split()
    if not w:
        return np.empty(0, np.uint64)
    digest, n, parts = xxhash.xxh64_intdigest, max(1, len(w) - words + 1), []
    for at in range(0, n, SLICE):
        part = w[at : min(at + SLICE, n) + words - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(words)), strict=False)) if len(w) > words else [b" ".join(w)]
        parts.append(np.unique(np.fromiter((digest(g, SEED) for g in grams), np.uint64)))
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


def signature(hashes: np.ndarray) -> tuple[int, int, list[int], list[int]]:
    """(identity of the set, SimHash fingerprint, node of each view and then the narrow nodes, sketch of four bits of each min-wise hash); unsigned."""
    if not len(hashes):
        return 0, 0, [], [0] * 4
    least = np.full(BITS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 4096):
        # the high half of a product is mixed best, so it comes down before the next product
        x = hashes[at : at + 4096, None] * MULTIPLIERS + ADDENDS
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        least = np.minimum(least, (x ^ (x >> np.uint64(29))).min(axis=0))
    code = int(np.packbits(2 * bit_sums(hashes) > len(hashes), bitorder="little").view(np.uint64)[0])
    pair = lambda k, i, j: xxhash.xxh64_intdigest(least[[i, j]].tobytes(), k)
    nodes = [pair(k, i, j) for k, (i, j) in enumerate(VIEWS)]
    nodes += [xxhash.xxh64_intdigest(least[own].tobytes(), 100 + k) for k, own in enumerate(NARROW)]
    four = ((least >> np.uint64(8)) & np.uint64(15)).reshape(4, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4))
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED), code, nodes, four.sum(axis=1, dtype=np.uint64).tolist()


def parity(hashes: np.ndarray, bits: int = NARROW_BITS) -> np.ndarray:
    """Whether the set has an odd number of hashes in each of ``bits`` classes, as bits. Sets differ in as many hashes as bits at least."""
    return np.packbits((np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).view(np.uint64)


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def signatures(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """``keep`` columns, ``fp`` (identity of the shingle set), its ``size``, ``code``, ``nodes``, ``sketch`` and ``parity``. Row-local."""

    def work(texts: pa.Array) -> list[pa.Array]:
        sizes, found, odd = [], [], []
        for t in texts:
            own = shingles(t.as_py())
            sizes.append(len(own))
            found.append(signature(own))
            odd.append(parity(own).tolist())
        nodes = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *[len(f[2]) for f in found]]), pa.int32()), pa.array(_signed([n for f in found for n in f[2]])))
        sketch, parities = (pa.ListArray.from_arrays(pa.array(np.arange(0, 4 * len(found) + 1, 4), pa.int32()), pa.array(_signed([n for x in own for n in x]))) for own in ([f[3] for f in found], odd))
        return [pa.array(_signed([f[0] for f in found])), pa.array(sizes, pa.int64()), pa.array(_signed([f[1] for f in found])), nodes, sketch, parities]

    def make():
        # what another operator keeps in this worker is let go
        held("near", dict)
        return work

    return map_column(docs, keep, text, [StructField("fp", LongType()), StructField("size", LongType()), StructField("code", LongType()), StructField("nodes", ArrayType(LongType())), StructField("sketch", ArrayType(LongType())), StructField("parity", ArrayType(LongType()))], make)


def alike(x: np.ndarray) -> np.ndarray:
    """Which differences of sketches (rows of four parts) leave enough hashes equal."""
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    return popcount(x & NIBBLES).sum(axis=1) <= BITS - ALIKE


def node_pairs(node: np.ndarray, code: np.ndarray, fp: np.ndarray, root: np.ndarray, sketch: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Pairs under equal nodes (sorted) whose codes are within the radius, whose sketches are alike and whose roots differ."""
    order = np.lexsort((gray_rank(code), node))
    node, code, fp, root, sketch = node[order], code[order], fp[order], root[order], sketch[order]
    start = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    size = np.diff(np.r_[start, len(node)])
    runs = -(-size // RUN)
    first_run = np.cumsum(runs) - runs
    nth = np.arange(runs.sum()) - np.repeat(first_run, runs)
    run_at = np.repeat(start, runs) + nth * RUN
    run_size = np.minimum(RUN, np.repeat(size, runs) - nth * RUN)
    same = ~(np.bitwise_or.reduceat(code, run_at) ^ np.bitwise_and.reduceat(code, run_at))
    a, b = _pairs(first_run, runs, first_run, runs)
    near = (a <= b) & (popcount((code[run_at[a]] ^ code[run_at[b]]) & same[a] & same[b]) <= radius)
    a, b = a[near], b[near]
    left, right = _pairs(run_at[a], run_size[a], run_at[b], run_size[b])
    near = (left < right) & (root[left] != root[right])
    left, right = left[near], right[near]
    near = popcount(code[left] ^ code[right]) <= radius
    left, right = left[near], right[near]
    near = alike(sketch[left] ^ sketch[right])
    return fp[left[near]], fp[right[near]]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, code, fp, root, four parts of the sketch) batches to pairs; the last node of a batch waits for the next one."""
    rest: list[np.ndarray] | None = None

    def found(node: np.ndarray, code: np.ndarray, fp: np.ndarray, root: np.ndarray, *sketch: np.ndarray) -> pa.RecordBatch:
        key = np.cumsum(np.r_[0, node[1:] != node[:-1]])
        a, b = node_pairs(key, code.view(np.uint64), fp, root, np.stack(sketch, axis=1).view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    for batch in batches:
        now = [np.asarray(batch.column(i)) for i in range(8)]
        if rest is not None:
            now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
        if not len(now[0]):
            continue
        cut = int(np.argmax(now[0] == now[0][-1]))
        rest = [x[cut:] for x in now]
        if cut:
            yield found(*(x[:cut] for x in now))
    if rest is not None:
        yield found(*rest)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets have a Jaccard similarity of SIMILAR or more."""
    if min(len(a), len(b)) < SIMILAR * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared >= SIMILAR * (len(a) + len(b) - shared)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, text of a, text of b) to the pairs that link. Sets used lately are kept, up to CACHED hashes."""
    sets: dict[int, np.ndarray] = {}
    held = 0

    def of(key: int, text: str | None) -> np.ndarray:
        nonlocal held
        found = sets.pop(key, None)
        if found is None:
            found = shingles(text)
            held += len(found)
        sets[key] = found  # the last used stands last
        while held > CACHED and len(sets) > 1:
            held -= len(sets.pop(next(iter(sets))))
        return found

    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)
        good = [(a, b) for a, b, s, t in rows if similar(of(a, s), of(b, t))]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in good], pa.int64()) for k in (0, 1)], names=["a", "b"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts (fp, __text) are similar enough."""
    left, right = texts.select(F.col("fp").alias("a"), F.col("__text").alias("s")), texts.select(F.col("fp").alias("b"), F.col("__text").alias("t"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "s", "t").mapInArrow(_verify, "a long, b long")


def _search_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, block, asked, code, fp, root, own, size, four parts of the sketch) batches sorted with the asked ones of each block first: pairs of an asked one with any of another group.

    ``own`` shingles are shared by none of these pairs, so two sets share no more than the lesser rest.
    """
    at, queries = None, []

    for batch in batches:
        a, b = [], []
        columns = [np.asarray(batch.column(i)) for i in range(12)]
        key = np.stack(columns[:2])
        starts = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)]) if batch.num_rows else []
        for start, stop in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            asked, code, fp, root, own_, size = (c[start:stop] for c in columns[2:8])
            sketch = np.stack([c[start:stop] for c in columns[8:]], axis=1).view(np.uint64)
            if at != (own := tuple(key[:, start].tolist())):
                at, queries = own, []
            # a block's asked ones may come in two batches, but all stand before the others
            queries += list(zip(*(x[asked].tolist() for x in (code, fp, root, own_, size)), sketch[asked], strict=True))
            code, fp, root, own_, size, sketch = (x[~asked] for x in (code, fp, root, own_, size, sketch))
            for c, f, r, o, n, k in queries:
                rest = np.minimum(size - own_, n - o)
                near = (root != r) & (popcount((code ^ np.int64(c)).view(np.uint64)) <= RADIUS) & (rest * (1 + SIMILAR) >= SIMILAR * (size + n))
                near[near] = alike(sketch[near] ^ k)
                b.append(fp[near])
                a.append(np.full(len(b[-1]), f))
        a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (a, b))
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def resembles(code: Column, sketch: Column, other_code: Column, other_sketch: Column) -> Column:
    """Whether fingerprints are within the radius and enough of the min-wise hashes are equal."""
    differ = F.lit(0)
    for i in range(4):
        x = F.get(sketch, F.lit(i)).bitwiseXOR(F.get(other_sketch, F.lit(i)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        differ = differ + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(int(NIBBLES))))
    return (F.bit_count(code.bitwiseXOR(other_code)) <= RADIUS) & (differ <= BITS - ALIKE)


def star_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b) of each member of a node and its ``least`` one, if they resemble each other; each pair once, the lesser first. ``open_pairs`` finds the similar ones among the others."""
    close = resembles(F.col("code"), F.col("sketch"), F.col("least.code"), F.col("least.sketch"))
    return nodes.where((F.col("fp") != F.col("least.fp")) & close).select(F.least("fp", "least.fp").alias("a"), F.greatest("fp", "least.fp").alias("b")).distinct()


def possible(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Pairs that may be similar although they share no rare shingle; ``sizes`` has (fp, own, size)."""
    of = lambda end: sizes.select(F.col("fp").alias(f"__{end}"), F.col("own").alias(f"own_{end}"), F.col("size").alias(f"size_{end}"))
    known = pairs.join(of("a"), F.col("a") == F.col("__a")).join(of("b"), F.col("b") == F.col("__b"))
    most = F.least(F.col("size_a") - F.col("own_a"), F.col("size_b") - F.col("own_b"))
    return known.where(most * (1 + SIMILAR) >= (F.col("size_a") + F.col("size_b")) * SIMILAR).select("a", "b")


def shared_nodes(each: DataFrame, central: bool = False) -> DataFrame:
    """(node, fp, code, sketch, least) of nodes with more than one member; ``least`` is the least member or, if ``central``, the one with most fellows in all its nodes."""
    sizes = each.groupBy("node").agg(F.count(F.lit(1)).alias("members"), F.min(F.struct("fp", "code", "sketch")).alias("least")).where("members > 1")
    shared = each.join(sizes.withColumnRenamed("node", "__node"), F.col("node") == F.col("__node"))
    if not central:
        return written(shared.select("node", "fp", "code", "sketch", "least"), "nodes")
    shared = written(shared.select("node", "fp", "code", "sketch", "members"), "nodes")
    fellows = shared.groupBy(F.col("fp").alias("__fp")).agg(F.sum("members").alias("fellows"))
    centres = shared.join(fellows, F.col("fp") == F.col("__fp")).groupBy(F.col("node").alias("__node")).agg(F.max(F.struct("fellows", "fp", "code", "sketch")).alias("c"))
    return shared.join(centres.select("__node", F.struct("c.fp", "c.code", "c.sketch").alias("least")), F.col("node") == F.col("__node")).select("node", "fp", "code", "sketch", "least")


def rare_shingles(texts: DataFrame, places: DataFrame) -> DataFrame:
    """(fp, shingle) of shingles that at most RARE of the sets of ``texts`` (distinct fp, __text) hold.

    Texts of a node (``places``: __fp, __node, __members) meet in parts of about CROWDED. A shingle that more
    than RARE sets of a batch hold is no rare one, so it gives one row with their number and not one for each set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py()) for t in batch.column(1)]
            if not sets:
                continue
            of, found = np.repeat(np.asarray(batch.column(0)), [len(x) for x in sets]), np.concatenate(sets).view(np.int64)
            kinds, at, n = np.unique(found, return_inverse=True, return_counts=True)
            many = n > RARE
            own = ~many[at]
            fp = pa.concat_arrays([pa.array(of[own], pa.int64()), pa.nulls(int(many.sum()), pa.int64())])
            count = np.concatenate([np.ones(int(own.sum()), np.int64), n[many].astype(np.int64)])
            yield pa.RecordBatch.from_arrays([fp, pa.array(np.concatenate([found[own], kinds[many]])), pa.array(count)], names=["fp", "shingle", "n"])

    part = F.pmod(F.xxhash64("fp"), F.ceil(F.col("__members") / CROWDED)).alias("__part")
    dealt = texts.join(places, F.col("fp") == F.col("__fp")).select("fp", "__text", "__node", part)
    dealt = dealt.repartition("__node", "__part").sortWithinPartitions("__node", "__part").select("fp", "__text")
    each = written(dealt.mapInArrow(run, "fp long, shingle long, n long"), "shingles")
    few = each.groupBy(F.col("shingle").alias("__s")).agg(F.sum("n").alias("__n")).where(F.col("__n") <= RARE)
    return written(each.where("fp is not null").join(few, F.col("shingle") == F.col("__s")).select("fp", "shingle"), "rare")


def rare_partners(rare: DataFrame, sizes: DataFrame) -> DataFrame:
    """(a, b) that share a rare shingle and may be similar by their number; ``sizes`` has (fp, code, sketch, own, size)."""
    groups = rare.groupBy("shingle").agg(F.array_sort(F.collect_set("fp")).alias("fps")).where(F.size("fps") > 1)
    both = F.flatten(F.transform("fps", lambda x, i: F.transform(F.slice("fps", i + 2, RARE), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    shared = groups.select(F.explode(both).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("shared"))
    of = lambda end: sizes.select(F.col("fp").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in ("code", "own", "size", "sketch")])
    known = shared.join(of("a"), "a").join(of("b"), "b")
    most = F.least(F.col("size_a") - F.col("own_a"), F.col("size_b") - F.col("own_b")) + F.col("shared")
    near = resembles(F.col("code_a"), F.col("sketch_a"), F.col("code_b"), F.col("sketch_b"))
    return known.where(near & (most * (1 + SIMILAR) >= (F.col("size_a") + F.col("size_b")) * SIMILAR)).select("a", "b")


def mixed_nodes(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, fp, code, sketch, root, members) of nodes whose members are in different groups; the others have nothing left to search."""
    placed = nodes.join(roots, F.col("fp") == F.col("v"), "left").select("node", "fp", "code", "sketch", F.coalesce("root", "fp").alias("root"))
    mixed = placed.groupBy("node").agg(F.count(F.lit(1)).alias("members"), (F.min("root") != F.max("root")).alias("mixed")).where("mixed")
    return written(placed.join(mixed.select(F.col("node").alias("__node"), "members"), F.col("node") == F.col("__node")).select("node", "fp", "code", "sketch", "root", "members"), "mixed")


def sketch_parts() -> list[Column]:
    return [F.get("sketch", F.lit(i)).alias(f"sketch_{i}") for i in range(4)]


def within_nodes(mixed: DataFrame) -> DataFrame:
    """Candidates of small nodes."""
    small = mixed.where(F.col("members") <= CROWDED).select("node", "code", "fp", "root", *sketch_parts())
    return small.repartition("node").sortWithinPartitions("node").mapInArrow(_search, "a long, b long")


def within_blocks(mixed: DataFrame, sizes: DataFrame) -> DataFrame:
    """Candidates of crowded nodes: every member outside the node's largest group with all members, a block of the former at a time. ``sizes`` has (fp, own, size)."""
    crowded = mixed.where(F.col("members") > CROWDED).join(sizes.withColumnRenamed("fp", "__f"), F.col("fp") == F.col("__f")).drop("__f")
    groups = crowded.groupBy("node", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = groups.groupBy("node").agg(F.max(F.struct("n", "root")).alias("m"), F.sum("n").alias("all")).select(F.col("node").alias("__node"), F.col("m.root").alias("__largest"), F.ceil((F.col("all") - F.col("m.n")) / CROWDED).cast("int").alias("__blocks"))
    each = crowded.join(largest, F.col("node") == F.col("__node"))
    outside = F.col("root") != F.col("__largest")
    columns = ["code", "fp", "root", "own", "size", *sketch_parts()]
    own = F.pmod(F.xxhash64("fp", "node"), F.col("__blocks").cast("long")).cast("int")
    asked = each.where(outside).select("node", own.alias("block"), F.lit(True).alias("asked"), *columns)
    others = each.select("node", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)).alias("block"), F.lit(False).alias("asked"), *columns)
    dealt = asked.union(others).repartition("node", "block").sortWithinPartitions("node", "block", F.desc("asked"))
    return dealt.mapInArrow(_search_blocks, "a long, b long")


def common_shingles(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, COMMON at most, in one of COUNTED sets of ``rows`` (fp, __text), sorted, and their ranks by frequency. They only decide the order in which all sets are searched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            fresh = {fp: t for fp, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) if fp not in seen}
            seen = seen | fresh.keys() if len(seen) < 1 << 20 else set(fresh)
            kinds, n = np.unique(np.concatenate([np.empty(0, np.uint64), *[shingles(t.as_py()) for t in fresh.values()]]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(n.astype(np.int64))], names=["shingle", "n"])

    some = rows.where(F.pmod(F.xxhash64("fp"), F.lit(COUNTED)) == 0)
    times = written(some.mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 1"), "times")
    # from which count on there are few enough
    least, total = None, 0
    for step, kinds, n in sorted(times.groupBy(F.floor(F.log2("n") * 16).alias("step")).agg(F.count(F.lit(1)), F.min("n")).collect(), reverse=True):
        total += kinds
        if total > COMMON:
            break
        least = n
    found = times.where(F.col("n") >= least).collect() if least else []
    kinds, n = (np.array([r[c] for r in found], np.int64) for c in ("shingle", "n"))
    order = np.argsort(kinds.view(np.uint64))
    rank = np.argsort(np.lexsort((kinds, n)))
    return kinds.view(np.uint64)[order], rank[order]


def first_shingles(sets: DataFrame, common: tuple[np.ndarray, np.ndarray], shards: int) -> DataFrame:
    """(shard, fps, roots, sizes, keys, nth, places) of ``sets`` (fp, root, size, __text): of each set's shingles in order (``common`` ones last, the most frequent at the end) so many that two similar sets share one.

    Similar sets share at least four fifths of either, so the first shingle that they share has less than a fifth of each set before it.
    A row has all that some sets have for a shard: the sets, and of each shingle its low bits, which set's it is, and its place in 256ths of that set.
    """
    frequent, rank = common

    def packs(fps: np.ndarray, roots: np.ndarray, texts: pa.Array) -> Iterator[tuple]:
        keys, places = [np.empty(0, np.uint64)], [np.empty(0, np.uint8)]
        sizes = np.empty(len(texts), np.uint32)
        for k, text in enumerate(texts):
            own = shingles(text.as_py())
            at = np.searchsorted(frequent, own)
            often = at < len(frequent)
            often[often] = frequent[at[often]] == own[often]
            last = own[often][np.argsort(rank[at[often]])]
            sizes[k] = len(own)
            keys.append(np.concatenate([own[~often], last])[: len(own) - -(-4 * len(own) // 5) + 1] & np.uint64((1 << KEY) - 1))
            places.append((np.arange(len(keys[-1])) * 256 // max(1, len(own))).astype(np.uint8))
        nth = np.repeat(np.arange(len(texts)), list(map(len, keys[1:])))
        keys, places = np.concatenate(keys), np.concatenate(places)
        shard = keys % np.uint64(shards)
        order = np.argsort(shard, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if len(order) else ():
            those, which = np.unique(nth[own], return_inverse=True)
            short = keys[own].view(np.uint8).reshape(-1, 8)[:, : KEY // 8]
            yield int(shard[own[0]]), *(x.tobytes() for x in (fps[those], roots[those], sizes[those], short, which.astype(np.uint16), places[own]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [batch.slice(i, 1 << 16) for i in range(0, batch.num_rows, 1 << 16)]  # which set it is has 16 bits
            found = [x for part in cut for x in packs(np.asarray(part.column(0)), np.asarray(part.column(1)), part.column(2))]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.binary() if i else pa.int64()) for i in range(7)], names=["shard", "fps", "roots", "sizes", "keys", "nth", "places"])

    packed = "shard long, fps binary, roots binary, sizes binary, keys binary, nth binary, places binary"
    return sets.select("fp", "root", "__text").mapInArrow(run, packed)


def _may_link(who: np.ndarray, end: np.ndarray, root: np.ndarray, size: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(left, right, most) of members ``who`` of lists with those that follow in the list, up to ``end``: pairs of different groups that may be similar, and in how many shingles they may differ. TOGETHER at a time.

    ``at`` shingles at least stand before that of the list. Pairs are left out only for certain: if it is the first
    that they share, what stands before it in either differs, and no more can be shared than what follows.
    """
    n = end[who] - who - 1
    for part in np.split(np.arange(len(who)), np.flatnonzero(np.diff(np.cumsum(n) // TOGETHER)) + 1):
        left = np.repeat(who[part], n[part])
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(n[part]) - n[part], n[part])
        other = root[left] != root[right]
        left, right = left[other], right[other]
        both = size[left] + size[right]
        shared = -(-4 * both // 9)
        may = (np.minimum(size[left] - at[left], size[right] - at[right]) >= shared) & (at[left] + at[right] <= both - 2 * shared)
        yield left[may], right[may], (both - 2 * shared)[may]


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (shard, fps, roots, sizes, keys, nth, places) to (key, fp, place, members) of lists: the sets with a key that may be similar to another one of it. In crowded lists with more than one group this is not tried."""
    now, packs = None, []

    def found() -> pa.RecordBatch:
        key, fp, root, size, place = (np.concatenate([np.empty(0, np.int64), *[x[i] for x in packs]]) for i in range(5))
        order = np.argsort(key)
        order = order[np.r_[False, np.diff(key[order]) == 0] | np.r_[np.diff(key[order]) == 0, False]] if len(key) else order
        key, fp, root, size, place = (x[order] for x in (key, fp, root, size, place))
        start = np.flatnonzero(np.r_[True, np.diff(key) != 0]) if len(key) else np.empty(0, np.int64)
        members = np.diff(np.r_[start, len(key)])
        mixed = np.minimum.reduceat(root, start) != np.maximum.reduceat(root, start) if len(key) else np.empty(0, bool)
        full = np.repeat(mixed & (members > CROWDED), members)
        good = full.copy()
        for left, right, _ in _may_link(np.flatnonzero(~full & np.repeat(mixed, members)), np.repeat(start + members, members), root, size, place * size >> 8):
            good[left] = good[right] = True
        n = np.repeat(np.add.reduceat(good.astype(np.int64), start), members) if len(key) else key
        return pa.RecordBatch.from_arrays([pa.array(x[good]) for x in (key, fp, place, n)], names=["key", "fp", "place", "members"])

    for batch in batches:
        for shard, *pack in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
            if shard != now:
                yield found()
                now, packs = shard, []
            fps, roots, sizes, keys, nth, places = (np.frombuffer(x, t) for x, t in zip(pack, (np.int64, np.int64, np.uint32, np.uint8, np.uint16, np.uint8), strict=True))
            wide = np.zeros((len(nth), 8), np.uint8)
            wide[:, : KEY // 8] = keys.reshape(-1, KEY // 8)
            packs.append((wide.view(np.int64)[:, 0], fps[nth], roots[nth], sizes.astype(np.int64)[nth], places.astype(np.int64)))
    yield found()


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, block, asked, fp, root, size, at, four parts of the parity) batches sorted with the asked ones of each block first: pairs of an asked one with any other of another group that may be similar. Sets differ at least where their parities do."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        now = [np.asarray(batch.column(i)) for i in range(11)]
        if rest is not None:
            now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
        if not len(now[0]):
            continue
        key, block, asked, fp, root, size, at = now[:7]
        odd = np.stack(now[7:], axis=1).view(np.uint64)
        start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])])
        members = np.diff(np.r_[start, len(key)])
        pairs = [np.empty((2, 0), np.int64)]
        for left, right, most in _may_link(np.flatnonzero(asked), np.repeat(start + members, members), root, size, at):
            may = popcount(odd[left] ^ odd[right]).sum(axis=1, dtype=np.int64) <= most
            left, right = fp[left[may]], fp[right[may]]
            pairs.append(np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)]), axis=1))
        a, b = np.unique(np.concatenate(pairs, axis=1), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        # the asked ones of the last block also meet those that follow
        rest = [x[start[-1] :][asked[start[-1] :]] for x in now]


def open_pairs(sets: DataFrame, rows: DataFrame, text: str, roots: DataFrame) -> DataFrame:
    """(a, b) of all ``sets`` (distinct fp, __row, size, parity) of ``rows`` (fp, __doc, __row) that are similar and have different ``roots`` (v, root), among others; each pair once, the lesser first."""
    placed = written(sets.join(roots, F.col("fp") == F.col("v"), "left").select(F.col("__row").alias("__r"), F.col("fp").alias("__fp"), F.coalesce("root", "fp").alias("root"), "size", "parity"), "placed")
    texts = rows.select("fp", "__row", F.col("__doc")[text].alias("__text"))
    common = common_shingles(texts.select("fp", "__text"))
    shards = max(SHARDS, (sets.agg(F.sum("size")).first()[0] or 0) // (5 * SHARD))
    each = texts.join(placed.select("__r", "root"), F.col("__row") == F.col("__r")).select("fp", "root", "__text")
    firsts = first_shingles(each, common, shards).repartition("shard").sortWithinPartitions("shard")
    lists = written(firsts.mapInArrow(_lists, "key long, fp long, place long, members long"), "lists")
    columns = ["fp", "root", "size", F.expr("(place * size) div 256").alias("at"), *[F.get("parity", F.lit(i)).alias(f"parity_{i}") for i in range(4)]]
    met = lists.join(placed, F.col("fp") == F.col("__fp")).select("key", "members", *columns)
    columns[3:] = ["at", *[f"parity_{i}" for i in range(4)]]
    small = met.where(F.col("members") <= CROWDED).select("key", F.lit(0).cast("long").alias("block"), F.lit(True).alias("asked"), *columns)
    crowded = met.where(F.col("members") > CROWDED)
    groups = crowded.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = groups.groupBy(F.col("key").alias("__key")).agg(F.max(F.struct("n", "root")).alias("m"), F.sum("n").alias("all")).select("__key", F.col("m.root").alias("__largest"), F.ceil((F.col("all") - F.col("m.n")) / CROWDED).alias("__blocks"))
    # those outside the largest group meet all, a block of the former at a time
    dealt = crowded.join(largest, F.col("key") == F.col("__key")).withColumn("__own", F.when(F.col("root") != F.col("__largest"), F.pmod(F.xxhash64("fp", "key"), "__blocks")))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__blocks") - 1)))
    dealt = dealt.select("key", "block", F.coalesce(F.col("block") == F.col("__own"), F.lit(False)).alias("asked"), *columns)
    dealt = small.union(dealt).repartition("key", "block").sortWithinPartitions("key", "block", F.desc("asked"))
    return dealt.mapInArrow(_meet, "a long, b long").distinct()


def near_enough(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts (fp, __text) are not told apart for certain by wide parities, which are much smaller than texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py()) for t in batch.column(1)]
            odd = np.concatenate([np.empty(0, np.uint64), *[parity(x, WIDE_BITS) for x in sets]]).view(np.int64)
            odd = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * (WIDE_BITS // 64), pa.int32()), pa.array(odd))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in sets], pa.int64()), odd], names=["fp", "size", "odd"])

    wide = written(texts.select("fp", "__text").mapInArrow(run, "fp long, size long, odd array<long>"), "wide")
    of = lambda end: wide.select(F.col("fp").alias(end), F.col("size").alias(f"size_{end}"), F.col("odd").alias(f"odd_{end}"))
    differ = F.aggregate(F.zip_with("odd_a", "odd_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    both = F.col("size_a") + F.col("size_b")
    return pairs.join(of("a"), "a").join(of("b"), "b").where(differ <= both - 2 * F.ceil(both * 4 / 9)).select("a", "b")


def links(sets: DataFrame, rows: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """(a, b) links among ``sets`` (distinct fp, code, nodes, __row) of ``rows`` (fp, __doc, __row) and all pairs compared for them: first with the least of each node, then among what is not joined yet. The index may miss some."""
    wide = shared_nodes(sets.select("fp", "code", "sketch", F.explode(F.slice("nodes", 1, len(VIEWS))).alias("node")))
    # only texts that share a node are moved to be verified
    needed = sets.join(wide.select("fp").distinct(), "fp", "left_semi").select(F.col("__row").alias("__r"))
    texts = written(rows.join(needed, F.col("__row") == F.col("__r"), "left_semi").select("fp", F.col("__doc")[text].alias("__text")), "texts")
    tried = written(star_pairs(wide), "pairs")
    found = written(verified(tried, texts), "stars")
    mixed = mixed_nodes(wide, components(found))
    pairs = within_nodes(mixed)
    crowded = mixed.where(F.col("members") > CROWDED)
    if not crowded.isEmpty():
        places = crowded.groupBy(F.col("fp").alias("__fp")).agg(F.max(F.struct("members", "node")).alias("p"))
        places = written(places.select("__fp", F.col("p.node").alias("__node"), F.col("p.members").alias("__members")), "crowd")
        members = places.select(F.col("__fp").alias("__m"))
        rare = rare_shingles(texts, places)
        own = rare.groupBy(F.col("fp").alias("__fp")).agg(F.count(F.lit(1)).alias("own"))
        crowd = sets.join(members, F.col("fp") == F.col("__m"), "left_semi").join(own, F.col("fp") == F.col("__fp"), "left")
        crowd = written(crowd.select("fp", "code", "nodes", "sketch", F.coalesce("own", F.lit(0)).alias("own"), "size"), "crowd")
        partners = rare_partners(rare, crowd)
        crowd = crowd.where(F.col("size") - F.col("own") >= F.col("size") * SIMILAR)
        narrow = shared_nodes(crowd.select("fp", "code", "sketch", F.explode(F.slice("nodes", len(VIEWS) + 1, len(NARROW))).alias("node")), central=True)
        more = written(possible(star_pairs(narrow), crowd).join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = tried.union(more)
        found = written(found.union(verified(more, texts)), "stars")
        roots = components(found)
        mixed = mixed_nodes(narrow, roots)
        of = lambda end: roots.select(F.col("v").alias(end), F.col("root").alias(f"root_{end}"))
        partners = partners.join(of("a"), "a", "left").join(of("b"), "b", "left").where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")
        pairs = pairs.union(partners).union(within_nodes(mixed)).union(within_blocks(mixed, crowd.select("fp", "own", "size")))
    # what was compared before is not compared again
    pairs = written(pairs.distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
    # its users read it twice
    return written(found.union(verified(pairs, texts)), "links"), tried.union(pairs)


def all_roots(sets: DataFrame, rows: DataFrame, text: str) -> DataFrame:
    """(v, root) of ``sets`` that similar pairs join, whichever they are: what the index has not joined is searched without loss."""
    before = set(made())
    found, tried = links(sets, rows, text)
    # what the index has written, other than links and pairs, is read no more
    release(rows.sparkSession, [p for p in made() if p not in before and p.rsplit("/", 1)[1].split("-")[0] not in ("links", "pairs")])
    roots = components(found)
    pairs = written(open_pairs(sets, rows, text, roots).join(tried, ["a", "b"], "left_anti"), "pairs")
    if pairs.isEmpty():
        return roots
    needed = sets.join(pairs.select(F.explode(F.array("a", "b")).alias("__f")).distinct(), F.col("fp") == F.col("__f"), "left_semi").select(F.col("__row").alias("__r"))
    texts = written(rows.join(needed, F.col("__row") == F.col("__r"), "left_semi").select("fp", F.col("__doc")[text].alias("__text")), "texts")
    more = written(verified(written(near_enough(pairs, texts), "pairs"), texts), "links")
    return roots if more.isEmpty() else components(found.union(more))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` less near-duplicates: of each group of linked texts the row with the smallest key stays (of equal keys, one).

    Texts link if their sets of five-word shingles have a Jaccard similarity of SIMILAR or more. Null
    texts and texts without words have the empty set and link with each other. Null keys come last.
    """
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text"))
    rows = written(signatures(base, ["__doc", "__key"], "__text").withColumn("__row", F.monotonically_increasing_id()), "signatures")
    # equal sets are one from here on, with one text for all
    sets = written(rows.groupBy("fp").agg(F.min(F.struct("__row", "size", "code", "nodes", "sketch", "parity")).alias("m"), F.min(F.struct(F.col("__key").isNull(), "__key", "__row")).alias("least")).select("fp", "m.*", "least"), "sets")
    roots = all_roots(sets, rows, text)
    placed = sets.join(roots, F.col("fp") == F.col("v"), "left").select("least", F.coalesce("root", "fp").alias("root"))
    first = placed.groupBy("root").agg(F.min("least").alias("m")).select(F.col("m.__row").alias("__first"))
    return rows.join(first, F.col("__row") == F.col("__first"), "left_semi").select("__doc.*")
