"""The prefix trie of conversations, from sorted conversations.

Conversations are sorted by their turns, so that those with a common beginning stand together, and
each gets the number of turns it shares with its predecessor (LCP). The nearest smaller values to the
left and right of each LCP (found in blocks at the same time, across blocks by the blocks' minima)
are the ends of the Cartesian tree's subtrees; positions of one interval and value are one node. An
interval stands for all depths between its parent's and its own; numbers of members, leaves and
saved bytes are differences of running sums over its ends.

Turns are compared by 128 bits of SHA-256. A conversation's key holds ``TURNS`` turns; those that agree
on all of them and go on are sorted by the next ones in a further round, so rows stay small. A hot
group (equal conversations, a common first turn, one very long conversation) is split by position
everywhere, never gathered: what a block or a range partition hands over is a few rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, written

#: Turns of one key, and characters of one turn in it.
TURNS, WIDE = 64, 32
#: Positions of a block at least, and blocks at most: the driver and the tasks hold a few numbers for each block.
BLOCK, MOST_BLOCKS = 1024, 65_536
#: Depths or members that one row is expanded to or from at once.
AT_ONCE = 4096


def turn_key(role: Column, text: Column) -> Column:
    return F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, WIDE)


def placed(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their positions from 0, and a row for each conversation with its number of turns.

    Turns are sorted over all conversations, so one that is very long is spread over many tasks.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_key(role, text).alias("key"), F.octet_length(text).cast("long").alias("bytes"))
    # the row's number keeps many equal rows from being one value to the sort
    order = ["conv_id", F.col("turn").asc_nulls_first(), "key", "row"]
    ordered = turns.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(ordered.select(F.monotonically_increasing_id().alias("at"), "conv_id", "key", "bytes"), "turns").withColumn("part", F.shiftright("at", 33))
    # a conversation's rows of one partition stand together
    by_part = Window.partitionBy("conv_id").orderBy("part")
    runs = rows.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    runs = written(runs.withColumn("before", F.sum("n").over(by_part) - F.col("n")).withColumn("turns", F.sum("n").over(Window.partitionBy("conv_id"))), "runs")
    at = rows.join(runs.select("conv_id", "part", "first", "before"), ["conv_id", "part"])
    return at.select("conv_id", (F.col("at") - F.col("first") + F.col("before")).alias("pos"), "key", "bytes"), runs.where("before = 0").select("conv_id", "turns")


def rebuilt(conversations: DataFrame, family: int = 5, most: int = 9, width: int = TURNS) -> DataFrame:
    """Conversations that begin as the first of their family does: chunks (conv_id, n_turns, chunk, key, sizes).

    A conversation c takes the first h turns of conversation c - c % family (floor; all if it has fewer, none if
    it is absent) and goes on with its own turns after its first h; h = crc32(c) % most. Turns are
    ordered by ``turn``, null first, equal ones by their hash; null roles and texts are empty; rows
    without a conv_id are ignored; other columns are not looked at. ``chunk`` numbers pieces of
    ``width`` turns; a conversation without turns has one chunk without any.
    """
    turns, found = placed(conversations)
    start = F.col("conv_id") - F.pmod("conv_id", F.lit(family))
    own = found.select("conv_id", "turns", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"), start.alias("start"))
    taken = F.least("h", F.coalesce("given", F.lit(0)))
    given = found.select(F.col("conv_id").alias("start"), F.col("turns").alias("given"))
    convs = written(own.join(given, "start", "left").select("conv_id", "h", taken.alias("taken"), (taken + F.greatest(F.col("turns") - F.col("h"), F.lit(0))).alias("n_turns")), "conversations")
    kept = turns.join(convs, "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "key", "bytes")
    first = turns.where((F.pmod("conv_id", F.lit(family)) == 0) & (F.col("pos") < most - 1))
    copies = first.withColumn("conv_id", F.explode(F.sequence(F.col("conv_id"), F.col("conv_id") + family - 1))).join(convs, "conv_id").where("pos < h")
    all_turns = kept.unionByName(copies.select("conv_id", "pos", "key", "bytes")).groupBy("conv_id", F.expr(f"pos div {width}").alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("pos", "key", "bytes"))).alias("t"))
    chunks = all_turns.select("conv_id", "chunk", F.array_join("t.key", "").alias("key"), F.col("t.bytes").alias("sizes"))
    none = convs.where("n_turns = 0").select("conv_id", F.lit(0).cast("long").alias("chunk"), F.lit("").alias("key"), F.array().cast("array<bigint>").alias("sizes"))
    return chunks.unionByName(none).join(convs.select("conv_id", "n_turns"), "conv_id")


def common(a: str, b: str) -> int:
    """Turns that two keys share at their beginnings."""
    if a == b:
        return len(a) // WIDE
    low, high = 0, min(len(a), len(b)) // WIDE
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[: mid * WIDE] == b[: mid * WIDE] else (low, mid - 1)
    return low


def _compared(one: tuple, two: tuple, turns: int, width: int) -> tuple[int | None, int | None, int | None, bool]:
    """Of two rows (group, key, sizes, before, n_turns) that follow each other: shared turns, their bytes, whether the first's last node is a leaf, whether both go on."""
    if one[0] != two[0]:
        return None, None, None, False
    same = common(one[1], two[1])
    shared = turns + same
    return shared, two[3] + sum(two[2][:same]), int(shared < one[4]), same == width and min(one[4], two[4]) > turns + width


def _round(active: DataFrame, turns: int, width: int) -> tuple[DataFrame, int]:
    """``active`` (grp, conv_id, n_turns, key, sizes, before) in order, each row compared with the one before it in its group.

    The driver sees two rows for each partition of the sort, to compare across their borders.
    """
    order = ["grp", "key", "longer", "conv_id"]
    ordered = active.withColumn("longer", F.col("n_turns") > turns + width).repartitionByRange(*order).sortWithinPartitions(*order)
    names = ["part", "idx", "grp", "conv_id", "n_turns", "lcp", "shared", "leaf", "tie", "edge"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx, last, part = 0, None, 0  # the last row waits until it is known whether it ends the partition
        out: list[tuple] = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), edge]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        edge = pa.struct([("key", pa.string()), ("sizes", pa.list_(pa.int64())), ("before", pa.int64())])
        for batch in batches:
            for part, grp, conv, n, key, sizes, before in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                row = (grp, key, sizes, before, n)
                if last is None:
                    result, shown = (None, None, None, None), dict(key=key, sizes=sizes, before=before)
                else:
                    out.append(last[1])
                    result, shown = _compared(last[0], row, turns, width), None
                last = (row, (part, idx, grp, conv, n, *result, shown))
                idx += 1
            if out:
                yield batch_of(out)
                out = []
        if last is not None:
            row, shown = last
            yield batch_of([(*shown[:-1], dict(key=row[1], sizes=row[2], before=row[3]))])

    kinds = "part int, idx long, grp long, conv_id long, n_turns long, lcp long, shared long, leaf long, tie boolean, edge struct<key: string, sizes: array<bigint>, before: bigint>"
    small_batches(active.sparkSession)
    compared = written(ordered.select(F.spark_partition_id().alias("part"), "grp", "conv_id", "n_turns", "key", "sizes", "before").mapInArrow(run, kinds), "sorted")
    edges: dict[int, list] = {}
    for r in compared.where("edge is not null").collect():
        edges.setdefault(r["part"], []).append(r)
    parts, offset, last = [], 0, None
    for part in sorted(edges):
        ends = sorted(edges[part], key=lambda r: r["idx"])
        rows = [(r["grp"], r["edge"]["key"], r["edge"]["sizes"], r["edge"]["before"], r["n_turns"]) for r in (ends[0], ends[-1])]
        result = _compared(last, rows[0], turns, width) if last else (None, None, None, False)
        if parts:
            parts[-1] = (*parts[-1][:-1], result[3])
        parts.append((part, offset, ends[-1]["idx"] + 1, *result, False))
        offset, last = offset + ends[-1]["idx"] + 1, rows[1]
    borders = active.sparkSession.createDataFrame(parts, "part int, offset long, size long, b_lcp long, b_shared long, b_leaf long, b_tie boolean, b_next boolean")
    here, first = compared.drop("edge").join(F.broadcast(borders), "part"), F.col("idx") == 0
    fixed = {c: F.when(first, F.col(f"b_{c}")).otherwise(F.col(c)) for c in ("lcp", "shared", "leaf", "tie")}
    return here.withColumns(fixed | {"q": F.col("offset") + F.col("idx")}).select("part", "idx", "size", "q", "conv_id", "n_turns", "lcp", "shared", "leaf", "tie", "b_next"), offset


def sorted_conversations(chunks: DataFrame, width: int = TURNS) -> tuple[DataFrame, DataFrame, int]:
    """Positions (at, conv_id, n_turns, lcp, shared, leaf), the chunks read for them (conv_id, chunk, before, sizes), and the number of conversations.

    ``lcp`` is the number of turns shared with the position before (-1 at the first), ``shared``
    their bytes, ``leaf`` 1 where the position before ends at a node without children.
    """
    zero = F.lit(0).cast("long")
    active = chunks.where("chunk = 0").select(zero.alias("grp"), "conv_id", "n_turns", "key", "sizes", zero.alias("before"))
    slots, order, read, places, turns, total = [], [], [], None, 0, 0
    while True:
        active = written(active, "round") if turns else active
        rows, n = _round(active, turns, width)
        total = total or n
        read.append(active.select("conv_id", F.lit(turns // width).cast("long").alias("chunk"), "before", "sizes"))
        # the q-th row takes the q-th of the places that are dealt anew
        rows = rows.withColumn("at", F.col("q")) if places is None else rows.join(places, "q")
        in_part = Window.partitionBy("part").orderBy("idx")
        tie = F.coalesce("tie", F.lit(False))
        rows = rows.withColumns({"tie": tie, "goes_on": tie | F.when(F.col("idx") == F.col("size") - 1, F.col("b_next")).otherwise(F.coalesce(F.lead(tie).over(in_part), F.lit(False)))})
        known = F.col("lcp").isNotNull() | F.lit(turns == 0)
        first = [F.coalesce("lcp", F.lit(-1).cast("long")).alias("lcp"), F.coalesce("shared", zero).alias("shared"), F.coalesce("leaf", zero).alias("leaf")]
        longer = rows.where("goes_on")
        counts = longer.groupBy("part").agg(F.count("*").alias("n"), F.sum((~F.col("tie")).cast("long")).alias("g")).collect() if chunks_follow(chunks, turns // width) else []
        if not counts and turns == 0:
            return written(rows.select("at", "conv_id", "n_turns", *first), "positions"), read[0], total
        slots.append(rows.where(known & ~F.col("tie")).select("at", *first))
        order.append(rows.where("not goes_on").select("at", "conv_id", "n_turns"))
        if not counts:
            break
        before, n, g = [], 0, 0
        for r in sorted(counts):
            before.append((r["part"], n, g))
            n, g = n + r["n"], g + r["g"]
        starts = F.broadcast(active.sparkSession.createDataFrame(before, "part int, n long, g long"))
        again = written(longer.join(starts, "part").select((F.row_number().over(in_part) - 1 + F.col("n")).alias("q"), "at", "conv_id", "n_turns", (F.sum((~F.col("tie")).cast("long")).over(in_part) + F.col("g")).alias("grp")), "places")
        places, turns = again.select("q", "at"), turns + width
        spent = active.select("conv_id", (F.col("before") + F.aggregate("sizes", zero, lambda a, b: a + b)).alias("before"))
        following = chunks.where(F.col("chunk") == turns // width).select("conv_id", "key", "sizes")
        active = again.join(spent, "conv_id").join(following, "conv_id").select("grp", "conv_id", "n_turns", "key", "sizes", "before")

    def union(frames: list[DataFrame]) -> DataFrame:
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    return written(union(slots).join(union(order), "at").select("at", "conv_id", "n_turns", "lcp", "shared", "leaf"), "positions"), union(read), total


def chunks_follow(chunks: DataFrame, chunk: int) -> bool:
    return bool(chunks.where(F.col("chunk") > chunk).take(1))


class Blocks:
    """What every task knows of the blocks: four numbers for each of at most MOST_BLOCKS."""

    def __init__(self, positions: DataFrame, n: int, least: int = BLOCK) -> None:
        self.n, self.size = n, max(least, -(-n // MOST_BLOCKS))
        rows = positions.groupBy(self.block_of().alias("block")).agg(F.min("lcp"), F.min("conv_id"), F.sum("shared"), F.sum("leaf"), F.min_by(F.struct("lcp", "n_turns", "leaf"), "at").alias("head")).collect()
        rows.sort(key=lambda r: r[0])
        self.low = np.array([r[1] for r in rows])
        self.conv = [np.array([r[2] for r in rows])]
        while 2 << len(self.conv) - 1 <= len(rows):
            half, top = 1 << len(self.conv) - 1, self.conv[-1]
            self.conv.append(np.minimum(top[:-half], top[half:]))
        self.shared, self.leaf = (np.concatenate([[0], np.cumsum([r[k] for r in rows])[:-1]]) for k in (3, 4))
        # what the position after a block's last one has
        heads = [r["head"] for r in rows[1:]]
        self.next = [(h["lcp"], h["lcp"] == h["n_turns"], h["leaf"]) for h in heads] + [(-1, False, 1)]

    def block_of(self) -> Column:
        return F.expr(f"at div {self.size}")

    def right(self, block: int, value: int) -> int:
        """The first later block that has a value below ``value``; -1 if there is none."""
        after = np.flatnonzero(self.low[block + 1 :] < value)
        return block + 1 + int(after[0]) if len(after) else -1

    def left(self, block: int, value: int) -> int:
        return int(np.flatnonzero(self.low[:block] < value)[-1])

    def smallest(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The smallest conv_id of the blocks from ``first`` to before ``last``; the largest long if there is none."""
        width = last - first
        out = np.full(len(first), np.iinfo(np.int64).max)
        for k, row in enumerate(self.conv):
            here = (width >= 1 << k) & (width < 2 << k)
            out[here] = np.minimum(row[first[here]], row[last[here] - (1 << k)])
        return out


def ordered_by(table: pa.Table, column: str) -> dict[str, np.ndarray]:
    by = np.argsort(table.column(column).to_numpy(), kind="stable")
    return {c: table.column(c).to_numpy()[by] for c in table.column_names}


def smaller_values(lcp: np.ndarray) -> tuple[list[int], list[int]]:
    """The nearest strictly smaller value to the left and to the right of each, as positions; -1 and the length where there is none."""
    values, n = lcp.tolist(), len(lcp)
    left, right, stack = [-1] * n, [n] * n, []
    for i, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            right[stack.pop()] = i
        # of an equal value the left neighbour is the same
        left[i] = -1 if not stack else left[stack[-1]] if values[stack[-1]] == v else stack[-1]
        stack.append(i)
    return left, right


class RangeMin:
    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while 2 << len(self.levels) - 1 <= len(values):
            half, top = 1 << len(self.levels) - 1, self.levels[-1]
            self.levels.append(np.minimum(top[:-half], top[half:]))

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        out, width = np.empty(len(first), np.int64), last - first
        for k, row in enumerate(self.levels):
            here = (width >= 1 << k) & (width < 2 << k)
            out[here] = np.minimum(row[first[here]], row[last[here] - (1 << k)])
        return out


def cartesian(positions: DataFrame, blocks: Blocks) -> DataFrame:
    """Positions with the ends ``l`` and ``r`` of their LCP's interval, and running sums and minima.

    ``low`` is the interval's smallest conv_id if it lies in one block. Values whose neighbour lies in
    another block are asked for once a block; the answer comes from the other block's running minima.
    """
    rows = positions.withColumn("block", blocks.block_of())
    schema = "at long, block long, conv_id long, n_turns long, lcp long, l long, r long, low long, low_before long, low_after long, shared_sum long, leaf_sum long, next_leaf_sum long, next_lcp long, dup boolean, next_dup boolean"
    names = [x.split()[0] for x in schema.split(", ")]

    def tree(own: pa.Table, outside: dict[tuple[bool, int], int]) -> pa.Table:
        x = ordered_by(own, "at")
        at, lcp, conv, block = x["at"], x["lcp"], x["conv_id"], int(x["block"][0])
        left, right = smaller_values(lcp)
        first, n = int(at[0]), len(at)
        l = [0 if v <= 0 else first + a if a >= 0 else outside[False, v] for a, v in zip(left, lcp.tolist(), strict=True)]
        r = [blocks.n if v <= 0 else first + b if b < n else outside.get((True, v), blocks.n) for b, v in zip(right, lcp.tolist(), strict=True)]
        l, r = np.array(l), np.array(r)
        inside = (l >= first) & (r <= first + n)
        low = np.zeros(n, np.int64)
        low[inside] = RangeMin(conv)(l[inside] - first, r[inside] - first)
        after_lcp, after_dup, after_leaf = blocks.next[block]
        dup = (lcp == x["n_turns"]) & (at > 0)
        leaf = blocks.leaf[block] + np.cumsum(x["leaf"])
        columns = [
            at, np.full(n, block), conv, x["n_turns"], lcp, l, r, pa.array(low, mask=~inside), np.minimum.accumulate(conv), np.minimum.accumulate(conv[::-1])[::-1],
            blocks.shared[block] + np.cumsum(x["shared"]), leaf, np.append(leaf[1:], leaf[-1] + after_leaf), np.append(lcp[1:], after_lcp), dup, np.append(dup[1:], after_dup),
        ]
        return pa.table([pa.array(c) for c in columns], names=names)

    if len(blocks.low) == 1:
        return written(rows.groupBy("block").applyInArrow(lambda own: tree(own, {}), schema), "tree")

    pair = "array<struct<v: bigint, x: bigint>>"

    def summary(own: pa.Table) -> pa.Table:
        x = ordered_by(own, "at")
        at, lcp, block = x["at"], x["lcp"], int(x["block"][0])
        firsts, lasts = [], []
        for out, values, places in ((firsts, lcp, at), (lasts, lcp[::-1], at[::-1])):
            least = np.minimum.accumulate(values)
            new = np.append(True, values[1:] < least[:-1])
            out += [dict(v=int(v), x=int(p)) for v, p in zip(values[new], places[new], strict=True)]
        ask_right = [dict(v=f["v"], x=to) for f in lasts if f["v"] > 0 and (to := blocks.right(block, f["v"])) >= 0]
        ask_left = [dict(v=f["v"], x=blocks.left(block, f["v"])) for f in firsts if f["v"] > 0]
        kind = pa.list_(pa.struct([("v", pa.int64()), ("x", pa.int64())]))
        return pa.table([pa.array([block]), *[pa.array([c], kind) for c in (firsts, lasts, ask_right, ask_left)]], names=["block", "firsts", "lasts", "ask_right", "ask_left"])

    known = written(rows.groupBy("block").applyInArrow(summary, f"block long, firsts {pair}, lasts {pair}, ask_right {pair}, ask_left {pair}"), "blocks")
    answers = []
    for ask, told, to_right in (("ask_right", "firsts", True), ("ask_left", "lasts", False)):
        asked = known.select(F.col("block").alias("for_block"), F.explode(ask).alias("q")).select("for_block", F.col("q.v").alias("v"), F.col("q.x").alias("block"))
        found = F.expr(f"filter({told}, f -> f.v < v)[0].x")
        answers.append(asked.join(known.select("block", told), "block").select(F.col("for_block").alias("block"), F.lit(to_right).alias("to_right"), "v", found.alias("x")))
    told = answers[0].unionByName(answers[1])

    def joined(own: pa.Table, outside: pa.Table) -> pa.Table:
        return tree(own, {(a, v): x for a, v, x in zip(*[outside.column(c).to_pylist() for c in ("to_right", "v", "x")], strict=True)})

    return written(rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(joined, schema), "tree")


def end_hashes(tree: DataFrame) -> DataFrame:
    """For conversations that have equal ones: ``l`` (their first position) and the SHA-256 of their ids, comma-joined in ascending order.

    Ids are joined in pieces of AT_ONCE positions; a hash is read over its pieces one after another.
    """
    members = tree.where("dup or next_dup").select(F.when(F.col("dup"), F.col("l")).otherwise(F.col("at")).alias("l"), "at", "conv_id")
    pieces = members.groupBy("l", F.expr(f"at div {AT_ONCE}").alias("piece")).agg(F.sort_array(F.collect_list(F.struct("at", "conv_id"))).alias("m"))
    texts = pieces.select("l", "piece", F.array_join(F.transform("m.conv_id", lambda c: c.cast("string")), ",").alias("ids")).repartition("l").sortWithinPartitions("l", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done: list[tuple[int, str]] = []
            for l, _, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if l != now:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = l, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["l", "ends_hash"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([digest.hexdigest()])], ["l", "ends_hash"])

    return texts.mapInArrow(run, "l long, ends_hash string")


NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def prefix_trie(chunks: DataFrame, width: int = TURNS, block: int = BLOCK) -> DataFrame:
    """A row per node of the trie of conversations, given as ``rebuilt`` gives them with the same ``width``.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. Conversations without turns are members of the root; equal ones are
    members of the same nodes; no conversation at all gives no node, not even the root.
    """
    spark = chunks.sparkSession
    chunks = written(chunks, "chunks")
    if not chunks.take(1):
        return spark.createDataFrame([], NODE)
    positions, read, n = sorted_conversations(chunks, width)
    blocks = Blocks(positions, n, block)
    tree = cartesian(positions, blocks)
    smallest = F.pandas_udf(lambda a, b: _series(blocks.smallest(a.to_numpy(), b.to_numpy())), "long")

    # one node for all positions of an interval and value
    nodes = tree.where("at > 0").groupBy("l", "r", F.col("lcp").alias("v")).agg(F.count("*").alias("m"), F.sum((F.col("n_turns") == F.col("lcp")).cast("long")).alias("dups"), F.min("low").alias("low"))
    at_l = tree.select(F.col("at").alias("l"), F.col("conv_id").alias("conv"), (F.col("n_turns")).alias("turns_l"), F.col("lcp").alias("lcp_l"), F.col("block").alias("block_l"), "low_after", F.col("shared_sum").alias("shared_l"), F.col("leaf_sum").alias("leaf_l"))
    at_r = tree.select((F.col("at") + 1).alias("r"), F.col("next_lcp").alias("lcp_r"), F.col("block").alias("block_r"), "low_before", F.col("shared_sum").alias("shared_r"), F.col("next_leaf_sum").alias("leaf_r"))
    across = F.least("low_after", "low_before", smallest(F.col("block_l") + 1, F.col("block_r"))) if len(blocks.low) > 1 else F.lit(None).cast("long")
    wide = nodes.join(at_l, "l").join(at_r, "r")
    wide = wide.withColumns({"crosses": F.col("low").isNull(), "low": F.coalesce("low", across)})
    ends = F.col("dups") + (F.col("turns_l") == F.col("v")).cast("long")
    wide = written(wide.select(
        "l", "r", "v", "low", "crosses", "conv", F.greatest("lcp_l", "lcp_r").alias("floor"), F.when(F.col("lcp_l") >= F.col("lcp_r"), F.col("l")).otherwise(F.col("r")).alias("p"),
        (F.col("m") + 1 - ends).alias("children"), (F.col("leaf_r") - F.col("leaf_l")).alias("leaves"), (F.col("shared_r") - F.col("shared_l")).alias("shared"), ends.alias("ends"), (F.col("dups") > 0).alias("many"),
    ), "nodes")
    floor = F.greatest("lcp", "next_lcp")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    single = tree.where(F.col("n_turns") > floor).select(
        F.col("at").alias("l"), (F.col("at") + 1).alias("r"), F.col("n_turns").alias("v"), F.col("conv_id").alias("low"), F.lit(False).alias("crosses"), F.col("conv_id").alias("conv"), floor.alias("floor"),
        F.when(F.col("lcp") >= F.col("next_lcp"), F.col("at")).otherwise(F.col("at") + 1).alias("p"), zero.alias("children"), one.alias("leaves"), zero.alias("shared"), one.alias("ends"), F.lit(False).alias("many"),
    )
    # the parent is the interval of whichever end's LCP is larger
    parent = tree.select(F.col("at").alias("p"), F.col("l").alias("pl"), F.col("r").alias("pr"), F.col("lcp").alias("pv"), F.col("low").alias("parent_low"))
    edges = wide.unionByName(single).join(parent, "p", "left")
    if len(blocks.low) > 1:
        large = wide.where("crosses").select(F.col("l").alias("pl"), F.col("r").alias("pr"), F.col("v").alias("pv"), F.col("low").alias("large_low"))
        edges = edges.join(large, ["pl", "pr", "pv"], "left").withColumn("parent_low", F.coalesce("parent_low", "large_low"))
    hashes = end_hashes(tree)
    edges = written(edges.join(hashes.withColumn("many", F.lit(True)), ["l", "many"], "left").withColumn("parent_low", F.when(F.col("floor") >= 0, F.col("parent_low"))), "edges")

    # all depths below the parent's; shared ones with the bytes of the turns before them
    alone = edges.where("r - l = 1")
    step = F.col("v") - F.col("floor") > AT_ONCE
    pieces = F.explode(F.sequence(F.col("floor") + 1, F.col("v"), F.lit(AT_ONCE).cast("long")))
    long_ones = alone.where(step).withColumn("from", pieces).repartition(F.xxhash64("l", "from"))
    depths = alone.where(~step).withColumn("from", F.col("floor") + 1).unionByName(long_ones)
    depths = depths.withColumn("depth", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + AT_ONCE - 1, F.col("v"))))).withColumn("saved", zero)
    chunk = F.explode(F.sequence(F.expr(f"greatest(floor, 0) div {width}"), F.expr(f"greatest(v - 1, 0) div {width}")))
    shared = edges.where("r - l > 1").withColumn("chunk", chunk).join(read.select(F.col("conv_id").alias("conv"), "chunk", "before", "sizes"), ["conv", "chunk"])
    lower = F.when((F.col("chunk") == 0) & (F.col("floor") < 0), zero).otherwise(F.greatest(F.col("floor") + 1, F.col("chunk") * width + 1))
    shared = shared.withColumn("depth", F.explode(F.sequence(lower, F.least(F.col("v"), (F.col("chunk") + 1) * width))))
    earlier = F.expr(f"before + aggregate(slice(sizes, 1, cast(greatest(depth - 1 - chunk * {width}, 0) as int)), cast(0 as bigint), (a, b) -> a + b)")
    shared = shared.withColumn("saved", F.col("shared") - (F.col("r") - F.col("l") - 1) * earlier)
    columns = ["l", "r", "v", "low", "conv", "floor", "children", "leaves", "ends", "hashed", "parent_low", "depth", "saved"]
    every = depths.withColumnRenamed("ends_hash", "hashed").select(*columns).unionByName(shared.withColumnRenamed("ends_hash", "hashed").select(*columns))
    bottom = F.col("depth") == F.col("v")
    digest = F.when(bottom & (F.col("ends") > 0), F.coalesce("hashed", F.sha2(F.col("conv").cast("string"), 256))).otherwise(F.sha2(F.lit(""), 256))
    return every.select(
        F.col("low").alias("conv_id"), "depth", F.when(F.col("depth") > F.col("floor") + 1, F.col("low")).otherwise(F.col("parent_low")).alias("parent_conv_id"), (F.col("r") - F.col("l")).alias("n_convs"),
        F.when(bottom, F.col("children")).otherwise(one).alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), digest.alias("ends_sha256"),
    )


def _series(values: np.ndarray):
    import pandas as pd

    return pd.Series(values)
