"""Packing documents' tokens into sequences of a fixed capacity by minimum bin slack.

A document is its ids and an end id. What fills whole sequences is cut off first; the remainders are
gathered into groups of bounded size and each group is packed on its own, in the task that encoded
it: a bitset of the sums that remaining lengths can reach (subset-sum dynamic programming) gives the
multiset of lengths that fills the next window closest to its capacity, going back through the
bitsets gives its counts, and the window is used as often as the counts allow. Where no multiset
fills a window, a remaining piece is cut to close the gap. What is left of a group is cut into
sequences whose lengths are powers of two, which need no padding. So no shuffle is needed, a lost
task is made again alone, and hot lengths or sources make no difference.
"""

from __future__ import annotations

import json
from array import array
from bisect import insort
from collections import deque
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import held, small_batches

CAPACITY = 1024
#: Bytes of buffered remainders (and kept columns) at which a group is packed; bounds a task's memory.
GROUP_BYTES = 24 << 20
#: Bytes of ids in one batch that goes back to Spark.
OUT_BYTES = 4 << 20

FIELDS = [StructField("start", LongType()), StructField("length", LongType()), StructField("ids", BinaryType()), StructField("doc_tokens", LongType()), StructField("sequence_id", LongType()), StructField("offset", LongType())]


def fullest(have: dict[int, int], lengths: Sequence[int], capacity: int) -> tuple[int, list[tuple[int, int]]]:
    """The largest sum of at most ``capacity`` that the multiset ``have`` (length -> count) reaches, and counts that give it.

    ``lengths`` are the lengths in ascending order. Long ones come first, and going back takes as
    few of the short ones as will do, so that short pieces remain for later windows.
    """
    reach, full, stages = 1, 1 << capacity, []
    mask = (full << 1) - 1
    for size in reversed(lengths):
        left, step = min(have[size], capacity // size), 1
        stages.append((size, reach))
        while left > 0:
            reach |= reach << size * min(step, left) & mask
            left, step = left - step, 2 * step
        if reach & full:
            break
    at = total = reach.bit_length() - 1
    chosen = []
    for size, before in reversed(stages):
        n = 0
        while not before >> at & 1:
            at, n = at - size, n + 1
        if n:
            chosen.append((size, n))
    return total, chosen[::-1]


def windows(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int, int]], int]:
    """A plan for pieces of lengths below ``capacity``, and its number of sequences.

    Rows (length, rank, n, start, size, sequence, offset): of the pieces of that length those with
    ranks rank to rank + n - 1 give their ids from start to start + size to the sequences from
    ``sequence`` on, one each, at ``offset``. Each step uses up at least half of a length's pieces,
    so the rows grow with the capacity and the logarithm of the counts.
    """
    runs: dict[int, deque] = {}
    have: dict[int, int] = {}
    lengths: list[int] = []
    rows, sequence = [], 0

    def put(size: int, origin: int, rank: int, n: int, start: int) -> None:
        if size not in have:
            insort(lengths, size)
            have[size], runs[size] = 0, deque()
        have[size] += n
        runs[size].append((origin, rank, n, start))

    def take(size: int, n: int) -> list[tuple[int, int, int, int]]:
        got = []
        have[size] -= n
        while n:
            origin, rank, most, start = runs[size].popleft()
            used = min(n, most)
            got.append((origin, rank, used, start))
            if used < most:
                runs[size].appendleft((origin, rank + used, most - used, start))
            n -= used
        if not have[size]:
            del have[size], runs[size]
            lengths.remove(size)
        return got

    for size, n in counts.items():
        if n:
            put(size, size, 0, n, 0)
    while have:
        total, chosen = fullest(have, lengths, capacity)
        used, slack = dict(chosen), capacity - total
        donor = next((x for x in reversed(lengths) if have[x] > used.get(x, 0)), None) if slack else None
        if slack and donor is None:  # the last pieces: sequences of lengths that are powers of two
            room, offset, at = 1 << total.bit_length() - 1, 0, sequence
            for size, n in chosen:
                for origin, rank, m, start in take(size, n):
                    for k in range(m):
                        begin, end = start, start + size
                        while begin < end:
                            part = min(room - offset, end - begin)
                            rows.append((origin, rank + k, 1, begin, part, at, offset))
                            begin, offset, total = begin + part, offset + part, total - part
                            if offset == room:
                                room, offset, at = 1 << max(0, total.bit_length() - 1), 0, at + 1
            return rows, at
        if donor is not None:
            used[donor] = used.get(donor, 0) + 1
        times, offset = min(have[size] // n for size, n in used.items()), 0
        for size, n in chosen:
            for _ in range(n):
                at = sequence
                for origin, rank, m, start in take(size, times):
                    rows.append((origin, rank, m, start, size, at, offset))
                    at += m
                offset += size
        if donor is not None:
            at = sequence
            for origin, rank, m, start in take(donor, times):
                rows.append((origin, rank, m, start, slack, at, offset))
                put(donor - slack, origin, rank, m, start + slack)
                at += m
        sequence += times
    return rows, sequence


class Encoder:
    """Ids of texts as the ``tokenizers`` library gives them for a byte-level BPE file, special tokens in a text included.

    Where ids follow the merges' order, as in the usual files, a plain rank encoder gives the same
    ids in a fifth of the time; any other file is left to the library.
    """

    def __init__(self, file: str) -> None:
        spec = json.loads(file)
        ranks = self._ranks(spec)
        if ranks is None:
            from tokenizers import Tokenizer

            library = Tokenizer.from_str(file)
            self.size = max(library.get_vocab(with_added_tokens=True).values()) + 1
            self._ids: Callable[[str], list[int]] = lambda text: library.encode(text, add_special_tokens=False).ids
        else:
            import public_tokenizers
            import tiktoken

            special = {t["content"]: t["id"] for t in spec["added_tokens"]}
            plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
            self.size = plain.n_vocab
            self._ids = lambda text: plain.encode(text, allowed_special="all")

    @staticmethod
    def _ranks(spec: dict) -> dict[bytes, int] | None:
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model["type"] == "BPE" and not spec.get("normalizer") and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        plain = plain and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "ignore_merges"))
        plain = plain and all(t["special"] and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec["added_tokens"])
        if not plain:
            return None
        # bytes that print stand for themselves, the others for the characters from 256 on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        special = {t["content"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in model["vocab"].items() if t not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merged = [vocab[a + b] for a, b in merges]
        if len(vocab) != 256 + len(merged) or merged != sorted(merged):
            return None
        return {bytes(byte_of[c] for c in t): i for t, i in vocab.items()}

    def packed(self, text: str | None, end: int) -> bytes:
        """The ids and ``end``, as little-endian unsigned 32-bit integers."""
        ids = self._ids(text) if text else []
        ids.append(end)
        return np.frombuffer(array("I", ids), np.uint32).astype("<u4", copy=False).tobytes()


def pack(docs: DataFrame, file: str, keep: Sequence[str], text: str = "text", end: int = 0, capacity: int = CAPACITY, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """A row per piece: the ``keep`` columns of its document, ``start``, ``length``, ``ids`` (packed, 32 bit), ``doc_tokens``, ``sequence_id``, ``offset``.

    ``file`` is the path of a ``tokenizers`` file, read on the driver. Every id of a document, its
    end included, lies in exactly one piece. All sequences hold ``capacity`` ids but the last few of
    each group, whose lengths are powers of two. ``sequence_id`` is unique within one evaluation,
    not consecutive, and depends on how the input is partitioned. Null and empty texts are a
    document of the end id alone; repeated rows are documents each; null keys stay; kept columns
    that bear the name of a new one give way to it; an empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    with open(file, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    names = {f.name for f in FIELDS}
    kept = [c for c in dict.fromkeys(keep) if c not in names]
    # the partition's number is taken in the JVM, where it stays right when partitions are read together
    source = docs.select(F.spark_partition_id().alias("part"), F.struct(*[F.col(f"`{c}`") for c in kept], F.lit(0).alias("")).alias("row"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held(("packing", sent.value), lambda: Encoder(sent.value))
        task = Group(capacity)
        for batch in batches:
            ids = [encoder.packed(t, end) for t in batch.column("text").to_pylist()]
            yield from task.add(batch.column("part")[0].as_py() if len(batch) else 0, batch.column("row"), ids)
            if task.bytes >= group_bytes:
                yield from task.packed()
        yield from task.packed()

    packed = source.mapInArrow(run, StructType([source.schema["row"], *FIELDS]))
    return packed.select(*[F.col("row")[c].alias(c) for c in kept], *[f.name for f in FIELDS])


class Group:
    """The documents of a task whose remainders wait to be packed."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.next, self.part = capacity, 0, 0
        self.clear()

    def clear(self) -> None:
        self.rows: list[pa.Array] = []
        self.rests: list[tuple[int, int, bytes]] = []  # document, its ids, the ids of its remainder
        self.docs = self.bytes = 0

    def add(self, part: int, rows: pa.Array, ids: list[bytes]) -> Iterator[pa.RecordBatch]:
        """Takes documents in and gives their whole sequences out."""
        self.part, size, out = part, 4 * self.capacity, []
        for k, data in enumerate(ids):
            whole, total = len(data) // size, len(data) // 4
            for i in range(whole):
                out.append((k, i * self.capacity, data[i * size : (i + 1) * size], total, self.next, 0))
                self.next += 1
            if len(data) > whole * size:
                self.rests.append((self.docs + k, total, data[whole * size :]))
                self.bytes += len(data) - whole * size + 64
        self.rows.append(rows)
        self.docs += len(ids)
        self.bytes += rows.nbytes
        yield from self.rendered(rows, out)

    def packed(self) -> Iterator[pa.RecordBatch]:
        """Packs what waits."""
        of_length: dict[int, list[tuple[int, int, bytes]]] = {}
        for rest in self.rests:
            of_length.setdefault(len(rest[2]) // 4, []).append(rest)
        plan, n = windows({size: len(rests) for size, rests in of_length.items()}, self.capacity)
        out = []
        for size, rank, count, start, length, sequence, offset in plan:
            for i in range(count):
                doc, total, data = of_length[size][rank + i]
                out.append((doc, total - size + start, data[4 * start : 4 * (start + length)], total, self.next + sequence + i, offset))
        self.next += n
        if out:
            yield from self.rendered(pa.concat_arrays(self.rows), out)
        self.clear()

    def rendered(self, rows: pa.Array, pieces: list[tuple[int, int, bytes, int, int, int]]) -> Iterator[pa.RecordBatch]:
        most = max(1, OUT_BYTES // (4 * self.capacity))
        for i in range(0, len(pieces), most):
            docs, start, ids, total, sequence, offset = zip(*pieces[i : i + most], strict=True)
            columns = [rows.take(pa.array(docs, pa.int64())), pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(total, pa.int64()), pa.array([self.part << 33 | s for s in sequence], pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["row", *[f.name for f in FIELDS]])
