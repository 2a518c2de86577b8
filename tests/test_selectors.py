"""Selectors by themselves, and rules over pages with faults."""

from __future__ import annotations

import json

import pytest

from tidewire.functions import extract, selectors
from tidewire.sources import tables

PAGE = """<html><head><title>T</title></head><body><div class="page a"><h3>H</h3><p>one <b>bold</b></p><p>two</p><span>s</span></div><!-- c -->
<table><tr><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td><td class="date time">5</td></tr></table><a href="x.pdf" title="x y">pdf</a><a href="y.doc">doc</a><br><img src="i.png"/></body></html>"""


@pytest.mark.parametrize(("selector", "want"), [
    ("//title/text() | //h3/text()", ["T", "H"]), ("//h3/text() | //title/text()", ["T", "H"]), ("tr:nth-child(2) td:nth-child(2)", ["4"]), ("h3+ p", ["one bold"]), ("p ~ span", ["s"]), ("h3 + span", []),
    ("a[href$='.pdf']::attr(href), a[href*='.doc']::attr(href)", ["x.pdf", "y.doc"]), ('a[title="x y"]', ["pdf"]), ("//div[1]/p/text()", ["one", "two"]), ("/html/body/div[1]/p[2]", ["two"]), ("//td[1]", ["1", "3"]), ("(//td)[1]", ["1"]),
    ("//*[contains(concat(' ', @class, ' '), concat(' ', 'time', ' '))]/text()", ["5"]), ("//p[b]", ["one bold"]), ("//p[not(b)]", ["two"]), ("//td[last()]", ["2", "5"]), ("count(//td)", ["5"]), ("//a/@href", ["x.pdf", "y.doc"]),
    ("img::attr(src)", ["i.png"]), ("p::text", ["one", "two"]), ("concat(//p[1]/b/text(), '-', //p[2])", ["bold-two"]), ("td:not(.date)", ["1", "2", "3", "4"]), ("td:nth-child(odd)", ["1", "3", "5"]), ("td:nth-child(2n)", ["2", "4"]),
    ("td:nth-last-child(-n+1)", ["2", "5"]), ("//p[position()>1]", ["two"]), ("//td[.='4']/..", ["345"]), ("p:first-of-type", ["one bold"]), ("normalize-space(//p[1])", ["one bold"]), ("//tr[2]/td[2]/following-sibling::td", ["5"]),
    ("//td[3]/preceding-sibling::td[1]", ["4"]), ("//b/ancestor::div/@class", ["page a"]), ("//tr[td>4]", ["345"]), ("//a[@href='x.pdf' or @href='y.doc'][2]", ["doc"]), ("*::attr(title)", ["x y"]), ("b, h3, b", ["H", "bold"]),
    ("div > b", []), ("div:has(b) > span", ["s"]), ("p:last-of-type, :root > head", ["T", "two"]), ("tr[class], .none, #none", []), ("translate(//h3, 'H', 'h')", ["h"]), ("substring-after(//a/@href, '.')", ["pdf"]),
])
def test_selectors_find(selector, want):
    assert selectors.values(selectors.Tree(PAGE).root, selector) == want


@pytest.mark.parametrize("selector", ["p:first", "//p[", "a[", "p..x", "//p[foo()]", "", "//p/", "a >", "p,,q", "contains(//p)", "img::(attrsrc)", "//p]", "a[b='c]", "p:nth-child(x)", "namespace::p"])
def test_selectors_that_cannot_be_read(selector):
    with pytest.raises(selectors.SelectorError):
        selectors.compiled(selector)


def test_deep_and_broken_pages():
    tree = selectors.Tree("<div>" * 5000 + "<p>x</p>" + "</div>" * 5000 + "<p>y").root
    assert [n.parent.at for n in selectors.select(tree, "p")] == [5000, 0]
    assert len(selectors.select(tree, "div div div")) == 4998
    assert selectors.values(selectors.Tree("</b><i>a</p></b>b</i>c").root, "i") == ["ab"]
    assert selectors.values(selectors.Tree("").root, "//p") == []
    rows = selectors.Tree("<ul>" + "<li>x" * 3 + "<li>y</li></ul>" + "<b></b>" * 20000).root
    assert len(selectors.select(rows, "b:nth-child(2n+1)")) == 10000


def test_a_fault_in_one_field_stays_there(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None)], "id int, html string")
    rules = {
        "title": {"method": "xpath", "selector": "//title/text() | //h3/text()"}, "bad_path": {"method": "xpath", "selector": "//p["}, "bad_pattern": {"method": "regex", "selector": "(a", "multiple": True}, "odd": {"method": "magic", "selector": "x"},
        "pair": {"method": "regex", "selector": r"<td>(\d)</td><td>(\d)"}, "bracket": {"method": "regex", "selector": r"\(?(?:title)>([^<(]+)"}, "cells": {"method": "css", "selector": "td", "multiple": True, "type": "string"}, "none": {"method": "css"},
        "count": {"method": "xpath", "selector": "count(//td)", "type": "integer"}, "fails": {"method": "xpath", "selector": "//p | concat('a', 'b')"},
    }
    got = {r["id"]: r.asDict() for r in extract.rule_values(pages, ["id"], rules, errors="errors").collect()}
    one = got[1]
    assert (one["title"], one["pair"], one["bracket"], one["cells"], one["count"]) == ("T", "1\t2", "T", "1 2 3 4 5", 5)
    assert all(one[f] is None for f in ("bad_path", "bad_pattern", "odd", "none", "fails"))
    assert set(one["errors"]) == {"bad_path", "bad_pattern", "odd", "none", "fails"} and all(v.startswith(f"{f}: ") for f, v in one["errors"].items())
    assert set(got[2]["errors"]) == {"bad_path", "bad_pattern", "odd", "none"} and got[2]["title"] is None
    assert extract.rule_values(pages, ["id"], rules).columns == ["id", *rules]


def test_classes_by_selectors(spark):
    lists = "<ul>" + "<li><a href='/n'>n</a></li>" * 4 + "</ul>"
    pages = spark.createDataFrame([(1, "http://x/A/12.shtml", "<p>x"), (2, "http://x/", lists), (3, "http://x/", f"<div class=body><p>{'a' * 60} News</p></div>"), (4, None, None), (5, "http://x/b", "")], "id int, url string, html string")
    types = {
        "broken": {"url_patterns": [r"a/\d+", "("], "structure_features": {"required_selectors": ["p["]}},
        "list": {"structure_features": {"required_selectors": ["//li"], "min_elements": {"//li/a": 4, "ul": 1}}},
        "detail": {"content_features": {"min_content_length": 50, "keywords": ["news"]}, "structure_features": {"required_selectors": [".none"]}},
    }
    got = {r["id"]: r["page_type"] for r in extract.classify_pages(pages, types).collect()}
    assert got == {1: "broken", 2: "list", 3: "detail", 4: "unknown_page", 5: "unknown_page"}


def test_links_of_list_rows_get_their_site(spark):
    pages = spark.createDataFrame([(1, "https://s.org/", "<li><a href='/a'>A</a></li><li><a href='http://o/b'>B</a></li><li><a href='//c'>C</a>")], "id int, site string, html string")
    say = {"title": {"selector": "a"}, "url": {"selector": "a", "attr": "href"}}
    assert [r["url"] for r in extract.list_rows(pages, ["id"], "li", say, base_url=pages["site"]).orderBy("index").collect()] == ["https://s.org/a", "http://o/b", "//c"]


def test_list_answers_of_three_kinds(spark):
    html = "<div class='page-content'><ul><li><a href='/1' title='T1'>t</a> 2024-01-02</li><li>none</li><li><a href='/3'> t3 </a><b>2024-1-2</b></li></ul></div>"
    rows = [(1, json.dumps({"list": [{"title": "a", "url": 7, "date": None}, {"title": "b", "url": ""}, "odd", {"url": "c"}]})), (2, json.dumps({"list": "x", "h": {"t": html}})), (3, "{bad"), (4, None), (5, "[]"), (6, json.dumps({"list": {}, "h": 1}))]
    df = spark.createDataFrame(rows, "k int, body string")
    found = tables.list_answers(df, ["k"], {"json_path": "list", "json_html_field": "h.t", "url_template": "u={url}"})
    got = sorted((tuple(r) for r in found.collect()), key=lambda r: (r[0], r[4]))
    assert got == [(1, "a", "u=7", None, 1), (1, None, "u=c", None, 4), (2, "T1", "/1", "2024-01-02", 1), (2, "t3", "/3", None, 3)]
    whole = spark.createDataFrame([(1, json.dumps([{"n": "x", "url": "y"}])), (2, html)], "k int, body string")
    assert [tuple(r) for r in tables.list_answers(whole, ["k"], {"field_mappings": {"title": "n"}}).collect()] == [(1, "x", "y", None, 1)]
    assert [r["k"] for r in tables.list_answers(whole, ["k"], {"response_type": "HTML"}).collect()] == [2, 2]
