"""Free-form dates, words without spaces, a plugged-in classifier, a store of unique keys."""

from __future__ import annotations

import itertools
import math
import threading

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewire.functions import dates, rules, segment
from tidewire.operators import relevance
from tidewire.sources.unique import UniqueStore


def test_free_dates(spark):
    want = {
        "Jan 2, 2024": "2024-01-02", "2 January 2024": "2024-01-02", "Tuesday, January 2nd, 2024 10:00 PST": "2024-01-02", "02-Jan-2024": "2024-01-02", "Tue, 02 Jan 2024 15:04:05 GMT": "2024-01-02", "2024 Feb 29": "2024-02-29", "2023 Feb 29": None,
        "the 3rd of March 2021": "2021-03-03", "Sept. 9, 1999": "1999-09-09", "13/2/2024": "2024-02-13", "2/13/2024": "2024-02-13", "1/2/2024": None, "5.5.2024": "2024-05-05", "2024/1/2": "2024-01-02", "31/4/2024": None, "1/2/24": None,
        "Tue Jan  2 15:04:05 UTC 2024": "2024-01-02", "may 2024": None, "Jan 32, 2024": None, "maybe 3, 2024": None, "": None, None: None, "posted 2May2024": None, "v1.13.2024.5": None, "12 dec 2020 and 1 jan 2021": "2020-12-12",
    }
    df = spark.createDataFrame(list(want.items()), "s string, w string")
    assert [tuple(r) for r in df.select("s", dates.free_date(F.col("s")).alias("d")).collect()] == list(want.items())
    both = spark.createDataFrame([("2024年1月2日",), ("2 Jan 2024",), ("20240102",), ("soon",)], "s string")
    assert [r[0] for r in both.select(dates.any_date(F.col("s"))).collect()] == ["2024-01-02"] * 3 + [None]


COUNTS = {"a": 5, "ab": 3, "abc": 1, "b": 2, "bc": 4, "ca": 2, "cab": 1, "": 9, "dd": 3}


@given(st.text("abcd", max_size=9))
@settings(max_examples=200, deadline=None)
def test_segments_are_the_most_probable(text):
    own = segment.Segmenter(COUNTS)
    total = sum(COUNTS.values())

    def log(words):
        return sum(math.log(COUNTS.get(w, 1)) - math.log(total) for w in words)

    ways = []
    for cuts in itertools.product([False, True], repeat=max(0, len(text) - 1)):
        at, words = 0, []
        for i, cut in enumerate([*cuts, True], 1):
            if cut:
                words.append(text[at:i])
                at = i
        if all(w in COUNTS or len(w) == 1 for w in words):
            ways.append(words if text else [])
    got = own.words(text)
    assert "".join(got) == text and log(got) == pytest.approx(max(map(log, ways)))


def test_segments_of_texts(spark):
    df = spark.createDataFrame([("中国人民，北京ab",), (None,), ("",), ("。。",), ("x" * 20_000,)], "s string")
    counts = {"中国": 9, "人民": 8, "国人": 1, "北京": 5}
    got = [r[0] for r in df.select(segment.segmented(spark, F.col("s"), counts, ["人民"])).collect()]
    assert got[:4] == [["中国", "北京", "a", "b"], None, [], []] and len(got[4]) == 20_000
    words = spark.createDataFrame([("b a. B c",), (None,), ("a",)], "t string")
    assert segment.word_counts(words, "t", 2) == {"a": 2, "b": 2}


def test_a_classifier_and_its_failures(spark):
    def classify(titles):
        if any("boom" in t for t in titles):
            raise RuntimeError("no answer")
        return [relevance.RELEVANT if "flu" in t else None if "mute" in t else "不相关" for t in titles]

    docs = spark.createDataFrame([(1, "flu"), (2, "sport"), (3, None), (4, " "), (5, "boom"), (6, "flu again"), (7, "mute")], "k int, title string").coalesce(1)
    kept = {r["k"]: tuple(r["relevance"]) for r in relevance.relevant(docs, classify).collect()}
    assert set(kept) == {1, 3, 4, 5, 6} and kept[5] == (None, "RuntimeError: no answer") and kept[1] == ("相关", None) and kept[3] == (None, None)
    assert relevance.relevant(docs, None).count() == 7 and relevance.relevant(docs, classify, keep_all=True).count() == 7
    assert set(r["k"] for r in relevance.relevant(docs, lambda titles: titles[:-1]).collect()) == {1, 2, 3, 4, 5, 6, 7}
    assert relevance.relevant(docs.limit(0), classify).count() == 0


def test_a_test_that_raises_fails_its_rule_for_its_row(spark):
    own = {"n": (relevance.by_function("inverse", lambda n: 1 / int(n) > 0.1),), "s": (relevance.by_function("starts", lambda s, n: s.startswith(n), "n"),)}
    df = spark.createDataFrame([("5", "5x"), ("0", "0"), ("x", "x"), (None, None), ("50", "6")], "n string, s string")
    assert [r[0] for r in df.select(rules.field_errors(own)).collect()] == [[], ["n:inverse"], ["n:inverse"], ["n:inverse", "s:starts"], ["n:inverse", "s:starts"]]


def test_keys_stand_once_after_retries_and_with_two_writers(spark, tmp_path):
    store = UniqueStore(spark, f"file://{tmp_path}/store", "url")
    rows = lambda *urls: spark.createDataFrame([(u, 1) for u in urls], "url string, n int")
    assert store.rows() is None
    assert store.write(rows("a", "a", "b", None), "w", 0) and not store.write(rows("x"), "w", 0) and store.write(rows("b", "c"), "w", 1)
    urls = lambda: sorted(r["url"] for r in store.rows().collect())
    assert urls() == ["a", "b", "c"]
    # a batch that died before its record leaves rows that nobody sees
    rows("ghost").write.parquet(f"{tmp_path}/store/rows-dead")
    assert urls() == ["a", "b", "c"]
    # another writer comes in between the look at the store and the record
    late, plain = UniqueStore(spark, f"file://{tmp_path}/store", "url"), store._claim

    def interrupted(n, record):
        store._claim = plain
        assert late.write(rows("d", "e"), "other", 0)
        return plain(n, record)

    store._claim = interrupted
    assert store.write(rows("d", "f"), "w", 2) and urls() == ["a", "b", "c", "d", "e", "f"]
    writers = [threading.Thread(target=UniqueStore(spark, f"file://{tmp_path}/store", "url").write, args=(rows("g", f"h{i}"), f"t{i}", 0)) for i in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert urls() == ["a", "b", "c", "d", "e", "f", "g", "h0", "h1", "h2", "h3"]
    rows("a", "s").write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run has lost its checkpoint and sends its batch again
        q = store.stream(spark.readStream.schema("url string, n int").parquet(str(tmp_path / "in")), "stream", str(tmp_path / f"cp{_}"))
        assert q.awaitTermination(60) and q.exception() is None
    assert urls().count("s") == 1
