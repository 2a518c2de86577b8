"""Packing: plans by themselves, and whole tables against the library's ids."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.test_operators import TEXTS
from tidewire.llm import packing, queries

FILE = public_tokenizers.path("byte_bpe_50k.json")


@given(st.dictionaries(st.integers(1, 31), st.integers(0, 40), max_size=20), st.sampled_from([32, 64, 100]))
@settings(max_examples=200, deadline=None)
def test_plans_hold_every_id_once_and_fill_their_windows(counts, capacity):
    rows, n = packing.windows(dict(counts), capacity)
    pieces, held = {}, {}
    for size, rank, many, start, length, sequence, offset in rows:
        for i in range(many):
            pieces.setdefault((size, rank + i), []).append((start, length))
            held.setdefault(sequence + i, []).append((offset, length))
    assert set(pieces) == {(size, k) for size, m in counts.items() for k in range(m)}
    assert set(held) == set(range(n))
    ends = [sorted(x) for x in (*pieces.values(), *held.values())]
    assert all(x[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(x, x[1:], strict=False)) for x in ends)
    assert all(sum(x) == size for (size, _), at in pieces.items() for x in [[length for _, length in at]])
    filled = [sum(length for _, length in x) for x in held.values()]
    assert all(f == capacity or f & (f - 1) == 0 for f in filled)
    assert sum(f != capacity for f in filled) <= capacity.bit_length()


@given(st.dictionaries(st.integers(1, 20), st.integers(1, 3), min_size=1, max_size=6))
@settings(max_examples=200, deadline=None)
def test_a_window_is_as_full_as_any_multiset_makes_it(have):
    total, chosen = packing.fullest(have, sorted(have), 32)
    sums = {0}
    for size, n in have.items():
        sums = {s + k * size for s in sums for k in range(n + 1)}
    assert total == max(s for s in sums if s <= 32) == sum(a * b for a, b in chosen)
    assert all(n <= have[size] for size, n in chosen)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@given(st.text(max_size=60))
@settings(max_examples=100, deadline=None)
def test_ids_as_the_library_gives_them(library, text):
    if not hasattr(test_ids_as_the_library_gives_them, "own"):
        test_ids_as_the_library_gives_them.own = packing.Encoder(open(FILE, encoding="utf-8").read())
    for t in (text, text + "<|endoftext|> " + text):
        assert np.frombuffer(test_ids_as_the_library_gives_them.own.packed(t, 0), "<u4").tolist() == [*library.encode(t, add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("group_bytes", [1, 24 << 20])
def test_pieces_make_up_their_documents(spark, library, group_bytes):
    texts = [*TEXTS, "word " * 5000, *[f"text number {i} " * (i % 90) for i in range(400)]]
    docs = spark.createDataFrame([(i // 2 if i % 7 == 0 else i, t, "clash", i) for i, t in enumerate(texts)] + [(None, "a b", "x", 0)], "doc_id long, text string, ids string, start int").repartition(3)
    rows = packing.pack(docs, FILE, ["doc_id", "text", "start"], group_bytes=group_bytes).collect()
    sequences, held = {}, {}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] > 0
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        held.setdefault((r["doc_id"], r["text"]), []).append((r["start"], r["ids"], r["doc_tokens"]))
    for x in map(sorted, sequences.values()):
        assert x[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(x, x[1:], strict=False))
        total = sum(n for _, n in x)
        assert total == 1024 or total < 1024 and total & (total - 1) == 0
    if group_bytes > 1:
        assert sum(sum(n for _, n in x) < 1024 for x in sequences.values()) <= 3 * 10
    want = {}
    for r in docs.collect():
        want.setdefault((r["doc_id"], r["text"]), []).append([*library.encode(r["text"] or "", add_special_tokens=False).ids, 0])
    assert set(held) == set(want)
    for key, pieces in held.items():
        copies = want[key]
        assert sum(len(p[1]) for p in pieces) == sum(4 * len(c) for c in copies) and {p[2] for p in pieces} == {len(copies[0])}
        if len(copies) == 1:
            assert np.frombuffer(b"".join(p[1] for p in sorted(pieces)), "<u4").tolist() == copies[0]


def test_packing_of_no_documents(spark):
    none = packing.pack(spark.createDataFrame([], "doc_id long, text string"), FILE, ["doc_id"])
    assert none.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"] and none.count() == 0


def test_partitions_read_together_keep_their_sequences_apart(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text")).repartition(4)
    rows = packing.pack(docs, FILE, ["doc_id"]).coalesce(1).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)


def test_the_query_over_its_whole_table(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = queries.op12_packing(spark, "/root/testdata/sf0.001").collect()
    ids = {k: np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes() for k, t in docs.items()}
    assert {r["doc_id"] for r in rows} == set(docs)
    assert all(r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][4 * r["start"] : 4 * (r["start"] + r["length"])]) and r["doc_tokens"] == len(ids[r["doc_id"]]) // 4 for r in rows)
    assert sum(r["length"] for r in rows) == sum(len(x) // 4 for x in ids.values())
