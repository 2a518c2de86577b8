"""The prefix trie against a plain one; small widths and blocks take every path across their borders."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from tests.llm import brute
from tidewire.llm import queries, tries

TURNS = "conv_id long, turn long, role string, text string, depth int, l string"


def trie_of(spark, rows, width=64, block=4096):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS)
    return Counter(tuple(r) for r in tries.prefix_trie(tries.rebuilt(df, width=width), width, block).collect())


def sample(seed):
    r = random.Random(seed)
    rows = [(c, t, r.choice(["u", "a", None]), r.choice(["x", "yé", "", None])) for c in range(60) for t in r.choice([[0], [0, 1, 2], [None, 3, 3], list(range(6))])]
    return rows + rows[:9]


@pytest.mark.parametrize("rows,width,block", [
    ([], 64, 4096), ([(1, 0, "u", "x")], 64, 4096), ([(None, 0, "u", "x"), (7, None, None, None)], 64, 4096),
    (sample(1), 64, 4096), (sample(2), 2, 7),
    ([(c, t, "u", "same") for c in range(40) for t in range(12)], 2, 7),
    ([(c, t, "u", f"same{t if t < c % 9 else c}") for c in range(100, 200) for t in range(10)], 3, 5),
    ([(c, t, "u", str(random.Random(c * 31 + t).randint(0, 1))) for c in range(1, 300) for t in range(1 + c % 13)], 3, 5),
    ([(5 * c, t, "u", "é" * 3000) for c in range(3) for t in range(200)], 64, 2),
], ids=["empty", "one", "null ids", "mixed", "mixed, small blocks", "copies", "nested", "random", "long"])
def test_trie_as_a_plain_one(spark, monkeypatch, rows, width, block):
    monkeypatch.setattr(tries, "AT_ONCE", 3)
    assert trie_of(spark, rows, width, block) == Counter(brute.trie(brute.rebuilt(rows)))


def test_nearest_smaller_values():
    r = random.Random(0)
    for _ in range(200):
        v = [r.randint(0, 4) for _ in range(r.randint(1, 30))]
        left, right = tries.smaller_values(__import__("numpy").array(v))
        for i, x in enumerate(v):
            assert left[i] == max((j for j in range(i) if v[j] < x), default=-1)
            assert right[i] == min((j for j in range(i + 1, len(v)) if v[j] < x), default=len(v))


def test_the_query_over_its_whole_table(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect()]
    assert Counter(tuple(r) for r in queries.op13_prefix_trie(spark, "/root/testdata/sf0.01").collect()) == Counter(brute.trie(brute.rebuilt(rows)))
