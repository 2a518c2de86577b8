"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece exactly one token can come last in the prefix's encoding. The table
of those tokens is built left to right: token ``t`` ends prefix ``i`` if the token that ends the
prefix before ``t`` may stand before ``t``, that is, if merging their joined bytes gives the same
two tokens back. A table is therefore exact under appends (earlier entries never change) and an
edit only recomputes entries until they agree with the old ones over the longest token's length.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField

from .common import held, map_column

#: Stretches, pairs of tokens and moves of the matcher that a worker remembers before it starts afresh (bounds its memory).
CACHE_ENTRIES, CACHE_PAIRS, CACHE_MOVES = 150_000, 400_000, 400_000
#: Characters of a stretch that is remembered at most; longer ones hardly come again.
CACHE_LENGTH = 256
#: Patterns whose matches never reach over a lone space except from it onwards.
SPLIT_AT_SPACES = frozenset([r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"])
#: White space other than the space and the line feed, and characters that some libraries take for it.
ODD_SPACE = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"
#: Texts that are not cut at spaces: with odd white space, or a space next to white space or to an end.
ODD = f"[{ODD_SPACE}]|  | \n|\n |^ | \\z"


class Vocabulary:
    """Ranks of a ``.tiktoken`` file (base64 token, rank; a line each) and the pattern that splits texts.

    ``alone`` holds the ids of tokens that merging their own bytes gives; no other can occur within a
    piece. It follows from the ranks and takes seconds, so workers are given it.
    """

    def __init__(self, rank_file: bytes, pattern: str, alone: frozenset[int] | None = None) -> None:
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.pattern = regex.compile(pattern)
        self.none = max(self.tokens) + 2
        self._pairs: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int]] = {}
        self.alone = frozenset(i for t, i in self.ranks.items() if len(t) < 3 or self.merged(t) == [i]) if alone is None else alone
        # states of the matcher: beginnings of tokens; moves between them are found when first needed
        self._state = {b"": 0}
        for i in sorted(self.alone):
            for size in range(1, len(self.tokens[i]) + 1):
                self._state.setdefault(self.tokens[i][:size], len(self._state))
        self._text = list(self._state)
        self._moves: dict[int, int] = {}
        self._ends: list[tuple[tuple[int, int], ...] | None] = [None] * len(self._text)

    def merged(self, data: bytes) -> list[int]:
        """Plain rank-order merging; decides which tokens may be neighbours."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, -1) for a, b in zip(parts, parts[1:], strict=False)]
            best = min((r for r in ranks if r >= 0), default=-1)
            if best < 0:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge makes ``token``; for a single byte, itself twice."""
        if (known := self._halves.get(token)) is None:
            data = self.tokens[token]
            parts = [data[i : i + 1] for i in range(len(data))]
            while len(parts) > 2:
                ranks = [self.ranks.get(x + y, self.none) for x, y in zip(parts, parts[1:], strict=False)]
                i = ranks.index(min(ranks))
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            known = self._halves[token] = (self.ranks[parts[0]], self.ranks[parts[-1]])
        return known

    def may_follow(self, left: int, right: int) -> bool:
        """True if merging the joined bytes of two tokens leaves the same two.

        Their merges are undone, latest first. The parts then next to the border stood there before
        the merge just undone; had their own merge a lower rank, it would have crossed the border.
        Of equal merges the left one comes first.
        """
        key = left << 32 | right
        a, b, limit, ok = left, right, self.none, True
        while True:
            if self.ranks.get(self.tokens[a] + self.tokens[b], self.none) < limit:
                ok = False
                break
            whole_a, whole_b = len(self.tokens[a]) == 1, len(self.tokens[b]) == 1
            if whole_a and whole_b:
                break
            if whole_b or not whole_a and a > b:
                limit, a = a, self.halves(a)[1]
            else:
                limit, b = b + 1, self.halves(b)[0]
        if len(self._pairs) >= CACHE_PAIRS:
            self._pairs.clear()
        self._pairs[key] = ok
        return ok

    def move(self, state: int, byte: int) -> int:
        """The longest beginning of a token that the bytes read end with, after one more byte."""
        text = self._text[state] + bytes((byte,))
        while (to := self._state.get(text)) is None:
            text = text[1:]
        if self._ends[to] is None:
            # the tokens that end here, longest first
            ends = [(len(text) - i, self.ranks[text[i:]]) for i in range(len(text)) if self.ranks.get(text[i:], -1) in self.alone]
            if not ends:
                raise ValueError("the vocabulary lacks a single byte")
            self._ends[to] = tuple(ends)
        if len(self._moves) >= CACHE_MOVES:
            self._moves.clear()
        self._moves[state << 8 | byte] = to
        return to

    def prefix_table(self, data: bytes, last: list[int] | None = None, states: list[int] | None = None, until: int | None = None) -> list[int]:
        """``last`` grown to the prefixes of ``data`` up to ``until`` bytes; entry 0 stands for the empty prefix.

        Entry ``i`` is the token that comes last in the encoding of ``data[:i]``. ``states`` is the
        matcher's state after each prefix and grows with it.
        """
        last = [-1] if last is None else last
        states = [0] if states is None else states
        moves, pairs, ends, may_follow = self._moves.get, self._pairs.get, self._ends, self.may_follow
        state = states[-1]
        for end in range(len(last), (len(data) if until is None else until) + 1):
            byte = data[end - 1]
            if (to := moves(state << 8 | byte)) is None:
                to = self.move(state, byte)
            states.append(state := to)
            # some token always fits: every prefix has an encoding
            for size, token in ends[state]:
                if size == end:
                    break
                left = last[end - size]
                ok = pairs(left << 32 | token)
                if may_follow(left, token) if ok is None else ok:
                    break
            last.append(token)
        return last

    def encode_sorted(self, pieces: list[bytes]) -> Iterator[list[int]]:
        """Encodings of sorted pieces; each table goes on from the prefix shared with the piece before."""
        last, states, before = [-1], [0], b""
        for data in pieces:
            if (token := self.ranks.get(data)) is not None:
                yield [token]
                continue
            shared = 0
            for x, y in zip(before, data, strict=False):
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :], states[shared + 1 :]
            before = data
            yield self.read_back(self.prefix_table(data, last, states), len(data))

    def read_back(self, last: list[int], size: int) -> list[int]:
        ids: list[int] = []
        while size:
            ids.append(last[size])
            size -= len(self.tokens[last[size]])
        return ids[::-1]

    def encode_piece(self, data: bytes) -> list[int]:
        """One match of the pattern. A piece that is a token is that token, whatever merges would give."""
        if (token := self.ranks.get(data)) is not None:
            return [token]
        return self.read_back(self.prefix_table(data), len(data))

    def encode(self, text: str) -> list[int]:
        return [i for piece in self.pattern.findall(text) for i in self.encode_piece(piece.encode())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class PrefixTable:
    """The last-token table of one piece, kept so that it can be appended to and edited."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.data, self.states = vocabulary, data, [0]
        self.last = vocabulary.prefix_table(data, None, self.states)

    def append(self, more: bytes) -> None:
        self.data += more
        self.vocabulary.prefix_table(self.data, self.last, self.states)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of bytes ``start:stop``; returns how many entries were recomputed."""
        old, old_states, shift = self.last, self.states, start + len(new) - stop
        self.data = self.data[:start] + new + self.data[stop:]
        self.last, self.states, same, done = old[: start + 1], old_states[: start + 1], 0, 0
        for end in range(start + 1, len(self.data) + 1):
            self.vocabulary.prefix_table(self.data, self.last, self.states, end)
            done += 1
            before = end - shift
            same = same + 1 if before > stop and (old[before], old_states[before]) == (self.last[end], self.states[end]) else 0
            # entries look back over one token; once so many agree, so do all that follow
            if same >= self.vocabulary.longest:
                self.last.extend(old[before + 1 :])
                self.states.extend(old_states[before + 1 :])
                break
        return done

    def become(self, data: bytes) -> int:
        """Replace what differs from ``data``; returns how many entries were recomputed."""
        start = next((i for i, (x, y) in enumerate(zip(self.data, data, strict=False)) if x != y), min(len(self.data), len(data)))
        room = min(len(self.data), len(data)) - start
        end = next((i for i, (x, y) in enumerate(zip(reversed(self.data), reversed(data), strict=False)) if x != y or i >= room), room)
        return self.replace(start, len(self.data) - end, data[start : len(data) - end])

    def ids(self) -> list[int]:
        if (token := self.vocabulary.ranks.get(self.data)) is not None:
            return [token]
        return self.vocabulary.read_back(self.last, len(self.data))


class EditableText:
    """A text with its encoding, a kept table for each piece.

    Appends and edits split again only what they can touch, and a piece that takes the place of an
    old one goes on from its table: only entries from the first changed byte on are made anew, until
    they agree with the old ones.
    """

    def __init__(self, vocabulary: Vocabulary, text: str = "") -> None:
        self.vocabulary, self.text = vocabulary, text
        self.pieces = vocabulary.pattern.findall(text)
        self.tables = [PrefixTable(vocabulary, p.encode()) for p in self.pieces]

    def append(self, more: str) -> int:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> int:
        """Put ``new`` in place of characters ``start:stop``; returns how many table entries were computed."""
        bounds = [0, *accumulate(map(len, self.pieces))]
        # a match depends on what follows its start, with one character of look-ahead
        first = max(0, next((i for i, b in enumerate(bounds) if b >= start), len(bounds) - 1) - 2)
        self.text = self.text[:start] + new + self.text[stop:]
        shift, old_ends = len(new) - (stop - start), {b: i for i, b in enumerate(bounds) if b >= stop}
        pieces, at, tail = [], bounds[first], len(self.pieces)
        for match in self.vocabulary.pattern.finditer(self.text, at):
            if match.start() >= start + len(new) and (i := old_ends.get(match.start() - shift)) is not None:
                tail = i
                break
            pieces.append(match.group())
        old, done, tables = self.tables[first:tail], 0, []
        for k, piece in enumerate(pieces):
            data = piece.encode()
            table = old[k] if k < len(old) else PrefixTable(self.vocabulary)
            done += table.become(data)
            tables.append(table)
        self.pieces = self.pieces[:first] + pieces + self.pieces[tail:]
        self.tables = self.tables[:first] + tables + self.tables[tail:]
        return done

    def ids(self) -> list[int]:
        return [i for table in self.tables for i in table.ids()]


class Packer:
    """Encodes many texts; ids come packed as little-endian unsigned 32-bit integers.

    Texts are cut at lone spaces (every match of the pattern ends before such a space; texts with
    other white space next to spaces are split by the pattern as a whole). Each different stretch of
    a batch is encoded once, in sorted order, so that the tables of those with a common prefix are
    built once; what a worker has encoded before is remembered, up to a bound.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        if vocabulary.pattern.pattern not in SPLIT_AT_SPACES:
            raise ValueError("the stretches between lone spaces are known to hold whole matches only for the patterns in SPLIT_AT_SPACES")
        self.vocabulary = vocabulary
        self.chunks: dict[str, bytes] = {}
        size = max(vocabulary.tokens) + 1
        self.token_bytes = pa.array([vocabulary.tokens.get(i, b"") for i in range(size)], pa.large_binary())
        self.packed_tokens = [struct.pack("<I", i) for i in range(size)]

    def joined(self, split: list[list[str]]) -> list[bytes]:
        """Packed ids of texts already split; each different piece is encoded once."""
        new = sorted((p.encode(), p) for p in set().union(*split))
        packed = self.packed_tokens.__getitem__
        known = {p: b"".join(map(packed, ids)) for (_, p), ids in zip(new, self.vocabulary.encode_sorted([b for b, _ in new]), strict=True)}
        return [known[ps[0]] if len(ps) == 1 else b"".join(map(known.__getitem__, ps)) for ps in split]

    def stretches(self, texts: list[str]) -> list[bytes]:
        """Packed ids of stretches as they stand, none of which is remembered."""
        return self.joined(list(map(self.vocabulary.pattern.findall, texts)))

    def spaced(self, chunks: list[str]) -> list[bytes]:
        """Packed ids of different stretches that follow a lone space."""
        missing, now = [c for c in chunks if c not in self.chunks], {}
        if missing:
            if len(self.chunks) + len(missing) > CACHE_ENTRIES:
                self.chunks = {c: self.chunks[c] for c in chunks if c in self.chunks}
            split = self.vocabulary.pattern.findall
            now = dict(zip(missing, self.joined([[f" {c}"] if c.isalpha() else split(f" {c}") for c in missing]), strict=True))
            self.chunks.update((c, ids) for c, ids in now.items() if len(c) <= CACHE_LENGTH)
        return [now[c] if c in now else self.chunks[c] for c in chunks]

    def pack(self, texts: pa.Array) -> pa.Array:
        """Packed ids of each text (null: none)."""
        if not len(texts):
            return pa.array([], pa.binary())
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
        bounds, pieces = np.asarray(split.offsets), split.values.dictionary_encode()
        # the first stretch of a text follows no space; each has an entry of its own behind the different others
        which = np.asarray(pieces.indices).astype(np.int64)
        at, first = bounds[:-1], split.values.take(pa.array(bounds[:-1]))
        whole = pc.if_else(pa.array(odd), texts, first).to_pylist()
        which[at] = len(pieces.dictionary) + np.arange(len(texts))
        found = pa.array(self.spaced(pieces.dictionary.to_pylist()) + self.stretches(whole), pa.large_binary())
        return _joined(found.take(pa.array(which)), bounds)

    def unpack(self, packed: pa.Array) -> pa.Array:
        """The bytes that packed ids stand for (null: empty)."""
        if not len(packed):
            return pa.array([], pa.binary())
        packed = pc.fill_null(packed.cast(pa.large_binary()), b"")
        bounds = np.frombuffer(packed.buffers()[1], np.int64)[packed.offset : packed.offset + len(packed) + 1]
        data = packed.buffers()[2]
        ids = np.frombuffer(data, "<u4", (bounds[-1] - bounds[0]) // 4, bounds[0]) if data is not None and bounds[-1] > bounds[0] else np.empty(0, "<u4")
        return _joined(self.token_bytes.take(pa.array(ids)), (bounds - bounds[0]) // 4)


def _joined(values: pa.Array, bounds: np.ndarray) -> pa.Array:
    """Binary values joined from each bound to the next."""
    ends = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    joined = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(np.ascontiguousarray(ends[bounds])), values.buffers()[2] or pa.py_buffer(b"")])
    return joined.cast(pa.binary())


@lru_cache(2)
def _driver_vocabulary(rank_file: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(rank_file, pattern)


def _sent(docs: DataFrame, rank_file: str, pattern: str):
    """The rank file (under 1 MB, read on the driver) and what follows from it, broadcast."""
    with open(rank_file, "rb") as f:
        ranks = f.read()
    Packer(_driver_vocabulary(ranks, pattern))  # rejects a pattern that cannot be cut at spaces before any task runs
    return docs.sparkSession.sparkContext.broadcast((ranks, pattern, _driver_vocabulary(ranks, pattern).alone))


def worker_packer(sent) -> Packer:
    """One packer for all tasks of a worker process."""
    return held(("bpe", sent[0], sent[1]), lambda: Packer(Vocabulary(*sent)))


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, keep: list[str], text: str = "text", output: str = "token_ids") -> DataFrame:
    """``keep`` columns and ``output``: the text's ids, packed as little-endian unsigned 32-bit integers.

    Null and empty texts give no ids (an empty value). Row-local: repeated rows, null ids and extra
    columns need no care; no shuffle. ``pattern`` must be one of SPLIT_AT_SPACES.
    """
    sent = _sent(docs, rank_file, pattern)
    return map_column(docs, keep, text, [StructField(output, BinaryType())], lambda: lambda texts: [worker_packer(sent.value).pack(texts)])


def decode_documents(encoded: DataFrame, rank_file: str, pattern: str, keep: list[str], column: str = "token_ids", output: str = "decoded") -> DataFrame:
    """``keep`` columns and ``output``: the bytes that packed ids stand for (null: empty)."""
    sent = _sent(encoded, rank_file, pattern)
    return map_column(encoded, keep, column, [StructField(output, BinaryType())], lambda: lambda packed: [worker_packer(sent.value).unpack(packed)])


def round_trip_documents(docs: DataFrame, rank_file: str, pattern: str, keep: list[str], text: str = "text", ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """``encode_documents`` and ``decode_documents`` of its ids, in one pass over the texts."""
    sent = _sent(docs, rank_file, pattern)

    def work(texts: pa.Array) -> list[pa.Array]:
        packer = worker_packer(sent.value)
        packed = packer.pack(texts)
        return [packed, packer.unpack(packed)]

    return map_column(docs, keep, text, [StructField(ids, BinaryType()), StructField(decoded, BinaryType())], lambda: work)


def token_count(column: str = "token_ids"):
    return F.expr(f"cast(octet_length({column}) div 4 as bigint)")
