"""JSON paths: Columns against the plain walk, and configurations reshaped."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidewire.functions import jsonpath

DOCS = [
    {"a": {"b": [{"c": 1, "d": "x"}, {"c": 2}, {"c": None}, "s"], "e f": {"c": 3}}, "z": [], "n": None}, {"a": {"b": {"c": True}}, "z": [[1, 2], [3]]}, [1, {"c": "é\"q"}, [4, 5, 6]], {"a": None}, {}, [], "text", None,
]


@pytest.mark.parametrize("path", ["$.a.b[*].c", "a.b[0].d", "$.a.b[-1]", "$.a.b[1:3]", "$.a.b[:-1].c", "$.a.b[::2]", "$.*", "$.a['e f'].c", "$['a','z']", "$[1].c", "$[0,2]", "$.z[*][0]", "$..c", "$..b[0]", "$.a..c", "$", "$[2][-2:]", "$.a.b[5]", "$.a.b[3:1]", "$..*"])
def test_paths_as_a_plain_walk(spark, path):
    df = spark.createDataFrame([(i, json.dumps(d, ensure_ascii=False)) for i, d in enumerate(DOCS)] + [(100, None), (101, "{bad")], "i int, j string")
    got = {r["i"]: r["v"] for r in df.select("i", jsonpath.json_values(F.col("j"), path).alias("v")).collect()}
    want = {i: [jsonpath.shown(v) for v in jsonpath.walked([d], jsonpath.steps(path))] for i, d in enumerate(DOCS)} | {100: None, 101: None}
    assert got == want


@pytest.mark.parametrize("path", ["$.a[", "$.a[x]", "$.a[]", "$.", "$.a b", "$[?(@.x)]", "$[::0]", "$...a"])
def test_paths_that_cannot_be_read(path):
    with pytest.raises(jsonpath.PathError):
        jsonpath.steps(path)


def test_first_values(spark):
    df = spark.createDataFrame([('{"a": [{"b": 1}, {"b": 2}]}',), ("{}",)], "j string")
    assert [r[0] for r in df.select(jsonpath.json_value(F.col("j"), "$.a[*].b")).collect()] == ["1", None]


def test_old_configurations_are_reshaped(spark):
    old = {
        "name": "N", "base_url": "http://x", "request_settings": {"delay": 1.5}, "follow": {"allow": ["/a"]}, "start_urls": [{"url": "u", "description": "d"}, {"url": "v", "type": "detail_page"}],
        "fields": {"title": {"method": "xpath", "selector": "//h1", "required": True}, "body": {"method": "css", "selector": "p", "required": True}, "date": {"method": "xpath", "selector": "//i"}},
    }
    df = spark.createDataFrame([(1, json.dumps(old)), (2, "{}"), (3, None), (4, "no")], "i int, j string")
    got = {r["i"]: r["v"] and json.loads(r["v"]) for r in df.select("i", jsonpath.reshaped(F.col("j")).alias("v")).collect()}
    assert got[3] is None and got[4] is None
    new = got[1]
    assert new["selectors"] == {"title_selectors": ["//h1"], "date_selectors": ["//i"]} and new["data_extraction"]["required_fields"] == ["title"]
    assert new["target_pages"] == [{"url": "u", "name": "d", "type": "list_page"}, {"url": "v", "name": "", "type": "detail_page"}]
    assert new["crawling_strategy"] == {"delays": {"between_requests": 1.5, "random_delay": True}, "limits": {"max_pages": 10, "max_items_per_page": 30}, "retry": {"max_attempts": 3, "retry_delay": 5.0}}
    assert new["site_info"]["description"] == "N数据爬取" and new["follow_rules"] == {"allow": ["/a"], "deny": []}
    assert got[2]["site_info"] == {"name": "", "base_url": "", "description": "数据爬取"} and got[2]["target_pages"] == [] and got[2]["selectors"] == {}


def test_paths_share_one_parsed_text(spark):
    """The query parses each text once for all its paths, and steps to names and places are one look-up."""
    from tidewire.plans import sources  # noqa: F401  it registers the query
    from tidewire.plans.queries import QUERIES

    plan = QUERIES["x4_json_paths"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
    text = '{"a": [{"b": {"c": null}}, {"b": {"c": [1, {"d": 2}]}}, {"b": 3}], "e": {"a": {}}}'
    df = spark.createDataFrame([(text,), ("[]",), ("{",), (None,)], "s string").withColumn("v", F.try_parse_json("s"))
    for path in ("$.a[1].b.c[0]", "$.a[*].b.c", "$.a[0].b.c", "$.a[-1].b", "$.a.b", "$['a'][2]['b']", "$.a[1:].b.c[1].d", "$..c[1].d", "$..a", "$.*.a"):
        got = df.select(jsonpath.json_values(F.col("s"), path), jsonpath.json_values(F.col("s"), path, F.col("v"))).collect()
        want = [[jsonpath.shown(x) for x in jsonpath.walked([json.loads(t)], jsonpath.steps(path))] for t in (text, "[]")]
        assert [r[0] for r in got] == [r[1] for r in got] == [*want, None, None], path
