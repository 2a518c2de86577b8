"""Configurations in YAML, rules that stand in tables, and queues of messages."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidewire.functions import rules
from tidewire.sources import configs, queues

SITE = """# a site
site_info:
  name: "北京"   # with a comment
  tags: [a, 'b, c', "d\\te", 1.5, {x: y, z: ~}]
start_urls:
  - url: "http://x/#top"
    name: it's fine
    type: list_page
  -
    url: http://y/?a=1&b=#2
- 
"""
GOOD = SITE[:-3] + """extraction:
  fields:
    title: {method: css, selector: "h1, .t", required: true}
    when:
      selector: '//p[@class=''d'']/text()'
      type: date
  list_page:
    fields: {}
    list_items:
      container: ul li
      max_items: 50
      fields:
        url: {method: css, selector: a, attr: href, multiple: yes}
validation:
  required_fields:
  - title
  - url
  field_rules:
    title: {min_length: 5, max_length: 20}
    url:
      pattern: "^https?://"
    n: {minimum: 1, maximum: 9.5, type: number}
notes: |
  first # not a comment
    second

  third
folded: >-
  one
  two

  three
plain: goes
  on here
params: {
  id: 680a29,
  page: 1,
}
empty:
octal: 010
"""  # fmt: skip


def test_yaml_values():
    v = configs.yaml_value(GOOD)
    assert v["site_info"] == {"name": "北京", "tags": ["a", "b, c", "d\te", 1.5, {"x": "y", "z": None}]}
    assert v["start_urls"] == [{"url": "http://x/#top", "name": "it's fine", "type": "list_page"}, {"url": "http://y/?a=1&b=#2"}]
    assert v["notes"] == "first # not a comment\n  second\n\nthird\n" and v["folded"] == "one two\nthree" and v["plain"] == "goes on here"
    assert v["params"] == {"id": "680a29", "page": 1} and v["empty"] is None and v["octal"] == "010"
    assert v["extraction"]["fields"]["when"]["selector"] == "//p[@class='d']/text()"
    assert configs.yaml_value("") is None and configs.yaml_value("- a\n- - b\n  - c\n-\n  k: v") == ["a", ["b", "c"], {"k": "v"}]
    assert configs.yaml_value(json.dumps(v, indent=1)) == v and configs.yaml_value("'a b': 1") == {"a b": 1}


@pytest.mark.parametrize("text", [SITE, "a: [1, 2", "a: {b: 1", "a: 'x", "a: b: c", "a: 1\n  b: 2", "a: &x 1", "a: *x", "a: 1\nb", "---\na: 1\n---\nb: 1", 'a: "\\q"', "a: [1 2] 3"])
def test_yaml_faults(text):
    with pytest.raises(configs.YamlError):
        configs.yaml_value(text)


def test_site_configurations_become_rules(spark, tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "bj.yaml").write_text(GOOD, encoding="utf-8")
    (tmp_path / "deep" / "er" / "a b.yml").write_text("extraction: {fields: {title: {selector: //h1}}}")
    (tmp_path / "deep" / "bad.yaml").write_text(SITE)
    (tmp_path / "deep" / "j.json").write_text('{"validation": {"required_fields": ["x"]}}')
    (tmp_path / "empty.yaml").write_text("")  # no text, no configuration
    (tmp_path / "other.txt").write_text("a: 1")
    found = configs.site_configs(spark, str(tmp_path)).cache()
    assert {r["site"]: r["error"] is None for r in found.collect()} == {"bj": True, "a b": True, "bad": False, "j": True}
    fields = {(r["site"], r["page_type"], r["field"]): r for r in configs.field_rules(found).collect()}
    assert set(fields) == {("bj", None, "title"), ("bj", None, "when"), ("bj", "list_item", "url"), ("a b", None, "title")}
    assert (fields["bj", None, "title"]["method"], fields["bj", None, "title"]["required"], fields["bj", None, "when"]["method"], fields["bj", "list_item", "url"]["multiple"]) == ("css", True, "xpath", True)
    said = {(r["site"], r["field"]): tuple(r)[2:] for r in configs.validation_rules(found).collect()}
    assert said == {
        ("bj", "title"): (True, None, 5, 20, None, None, None), ("bj", "url"): (True, None, None, None, "^https?://", None, None),
        ("bj", "n"): (False, "number", None, None, None, 1.0, 9.5), ("j", "x"): (True, None, None, None, None, None, None),
    }
    records = spark.createDataFrame([(1, "bj", "short", "ftp://x", "3"), (2, "bj", "abc", None, "12"), (3, "bj", " ", "http://y", "x"), (4, "j", None, "u", None), (5, None, "t", "u", None), (6, "none", "t", "u", None)], "k int, site string, title string, url string, n string")
    got = {r["k"]: r["errors"] for r in rules.errors_by_table(records, configs.validation_rules(found), "site", ["title", "url", "n"]).collect()}
    assert got == {1: ["url:pattern"], 2: ["n:range", "title:length", "url:required"], 3: ["n:type", "n:range", "title:required", "title:length"], 4: ["x:required"], 5: [], 6: []}


def test_rules_with_faults_and_rules_for_all(spark):
    said = [(None, "t", True, None, None, None), ("s", "t", None, "(", None, None), ("s", "u", None, None, "color", None), ("s", "v", None, None, None, 3), ("s", None, True, None, None, 1)]
    table = spark.createDataFrame(said, "site string, field string, required boolean, pattern string, kind string, max_length int")
    records = spark.createDataFrame([("s", "x", "y", "long", "kept"), ("s", None, None, None, "kept"), ("o", "", "y", "long", "kept")], "site string, t string, u string, v string, errors string")
    out = rules.errors_by_table(records, table, "site", ["t", "u", "v"], output="faults").orderBy("site", F.desc("t"))
    assert [(r["faults"], r["errors"]) for r in out.collect()] == [(["t:required"], "kept"), (["t:pattern", "u:type", "v:length"], "kept"), (["t:required"], "kept")]
    assert rules.errors_by_table(records, table.limit(0), "site", ["t"]).where(F.size("errors") > 0).count() == 0
    assert rules.errors_by_table(records.limit(0), table, "site", ["t"]).count() == 0


def test_messages(spark):
    lines = ['{"url": "http://a", "meta": {"k": 1, "site": "m"}, "headers": {"H": "v"}, "site": "s", "callback": "f"}', ' {"u": "http://b", "site": "s"} ', "http://c ", "  ", None, '{"x": 1}', "{broken", '{"url": "", "u": "http://d", "meta": [1]}']
    got = [tuple(r) for r in queues.requests(spark.createDataFrame([(x,) for x in lines], "value string")).collect()]
    assert got == [
        ("http://a", "m", "f", {"k": "1", "site": "m"}, {"H": "v"}), ("http://b", "s", None, {"site": "s"}, {}), ("http://c", None, None, {}, {}), ('{"x": 1}', None, None, {}, {}), ("{broken", None, None, {}, {}), ("http://d", None, None, {}, {}),
    ]


def test_a_queue_is_read_on_and_again_after_a_failure(spark, tmp_path):
    folder = tmp_path / "queue"
    folder.mkdir()
    assert queues.queue(spark, str(folder)).count() == 0
    (folder / "a").write_bytes("\n".join(f"http://x/é/{i}" for i in range(200)).encode() + b"\npart")
    (folder / "_skip").write_text("no\n")
    everything = lambda: sorted(r["value"] for r in queues.queue(spark, f"file://{folder}", piece=100).collect())
    assert everything() == sorted(f"http://x/é/{i}" for i in range(200))
    out, fail = str(tmp_path / "out"), [True]
    got: dict[int, list] = {}

    def write(batch, number):
        rows = sorted((r["segment"], r["offset"], r["value"]) for r in batch.collect())
        got.setdefault(number, []).append(rows)
        if number == 1 and fail[0]:
            raise RuntimeError("lost")

    def start():
        return queues.queue(spark, str(folder), stream=True, piece=64).writeStream.foreachBatch(write).option("checkpointLocation", out).start()

    q = start()
    q.processAllAvailable()
    (folder / "a").write_bytes((folder / "a").read_bytes() + b"ial\nnext\r\n")
    (folder / "b").write_text("first of b\nopen")
    with pytest.raises(Exception, match="lost"):
        q.processAllAvailable()
    (folder / "b").write_text("first of b\nopened\n")  # goes on meanwhile
    fail[0] = False
    q = start()
    q.processAllAvailable()
    q.stop()
    assert [v for _, _, v in got[1][0]] == ["partial", "next", "first of b"] and got[1][0] == got[1][1]
    assert [v for _, _, v in got[2][0]] == ["opened"] and len(got[0][0]) == 200
