"""Each registered query of the base library against DuckDB, over the smallest tables; and fixed examples."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewire.functions import extract, fields, rules, settings
from tidewire.functions import text as fn
from tidewire.operators import antibot, dedup, joins, ops, quality
from tidewire.plans import checks, crawl, operations, pages, sources  # noqa: F401  they register their queries
from tidewire.plans.queries import ORACLE_SQL, QUERIES
from tidewire.sources import tables
from tidewire.sources.tables import json_lines, text_list, write_by_site

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        table = name.removesuffix(".parquet")
        con.execute(f"create view {table} as select * from '{SF}/{name}'")
    return con


def plain(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else str(v) for v in r) for r in rows))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert plain(tuple(r[c] for c in columns) for r in df.collect()) == plain(result.fetchall())


def test_queries_without_sql_run(spark):
    assert set(QUERIES) - set(ORACLE_SQL) == {"f11_segments"}
    rows = QUERIES["f11_segments"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count() and max(r["n_words"] for r in rows) > 10


def one(spark, f, value):
    return spark.createDataFrame([(value,)], "s string").select(f(F.col("s"))).first()[0]


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (fn.clean_html, "<p>a&amp;lt;b</p><style>x{}</style>", "a<b"), (fn.clean_html, None, ""), (fn.clean_number, "1,234.50元", 1234.5), (fn.clean_region, "北京市朝阳区", "北京朝阳"),
        (fn.clean_region, "宁夏回族自治区", "宁夏回族自治"), (fn.title_slug, "tdclasshanggao30zi18市疾控中心 开展", "开展"), (fn.clean_phone, "138-0013-8000", "13800138000"), (fn.clean_phone, "12345", None),
        (fn.clean_source, "来源：新华网 作者：张三", "新华网"), (fn.clean_source, "市卫健委 发布", "卫生健康委"), (fn.digits_number, "1,234人", 1234), (fn.digits_number, None, 0), (fn.tags_of, "新冠疫苗接种", ["新冠疫情", "疫苗接种"]),
        (lambda c: fn.case_count(c, "confirmed"), "新增确诊病例12例，死亡3例", 12), (lambda c: fn.case_count(c, "death"), "新增确诊病例12例，死亡3例", 3), (fn.next_page, "http://x/list.shtml", "http://x/list_2.shtml"),
        (fn.next_page, "http://x/list_9.shtml", "http://x/list_10.shtml"), (fn.loader_date, "2024年1月2日", "2024-01-02"), (fn.date_in_text, "发布于2024年1月2日", "2024年1月2日"), (fn.safe_name, "..a b/c", "a_b_c"),
        (fn.collapse, "　a  b ", "a b"),
    ],
)
def test_examples(spark, f, value, want):
    assert one(spark, f, value) == want


def test_change_detection_drops_content_seen_before(spark):
    rows = [(1, "s", "u", "A"), (2, "s", "u", "B"), (3, "s", "u", "A"), (4, "s", "v", "B"), (5, "s", "v", None)]
    got = dedup.content_updates(spark.createDataFrame(rows, "seq long, site string, url string, content string"))
    assert sorted((r["seq"], r["status"]) for r in got.collect()) == [(1, "created"), (2, "modified"), (5, "modified")]


def test_antibot_thresholds(spark):
    rows = [(1, "<a style='display:none'>", 200, None, None, "u"), (2, "", 412, None, None, "u"), (3, None, 200, None, "30", "u"), (4, "please ENABLE\rcookies", 200, "a=Test", None, "u"), (5, "<a class='hidden'> Disallow: /", 200, None, "", "http://x/robots.txt")]
    pages = spark.createDataFrame(rows, "id int, html string, status int, set_cookie string, retry_after string, url string")
    got = {r["id"]: (r["honeypot"], r["rate_limit"], r["cookie_check"], r["detected"]) for r in antibot.detect(pages).collect()}
    assert got == {1: (3, 0, 0, []), 2: (0, 7, 0, ["rate_limit"]), 3: (0, 5, 0, []), 4: (0, 0, 10, ["cookie_check"]), 5: (5, 0, 0, ["honeypot"])}
    # of the six patterns that a probe of a public site looks for, each is seen
    seen = {"验证码": "captcha", "访问频率": "rate_limit", "访问被拒绝": "ip_block", "cloudflare": "js_challenge"}
    marks = spark.createDataFrame([(k, f"<p>{k}</p>", 200, None, None, "u") for k in seen], "id string, html string, status int, set_cookie string, retry_after string, url string")
    assert all(r[seen[r["id"]]] > 0 for r in antibot.detect(marks).collect())


def test_carry_and_files(spark, tmp_path):
    details = spark.createDataFrame([(1, None), (2, "own")], "k int, title string")
    assert sorted(r["title"] for r in joins.carry(details, spark.createDataFrame([(1, "list"), (2, "other")], "k int, title string"), "k", "title").collect()) == ["list", "own"]
    (tmp_path / "seeds").write_text("# c\n\n a \nb\n")
    assert sorted(r["entry"] for r in text_list(spark, str(tmp_path / "seeds")).collect()) == ["a", "b"]
    (tmp_path / "lines").write_text('{"a": 1}\nbad\n')
    lines = json_lines(spark, str(tmp_path / "lines"), "a int").collect()
    assert sorted((r["a"], r["_corrupt_record"]) for r in lines if r["a"]) == [(1, None)] and [r["_corrupt_record"] for r in lines if r["a"] is None] == ["bad"]
    with pytest.raises(Exception):  # noqa: B017
        json_lines(spark, str(tmp_path / "lines"), "a int", strict=True).collect()
    write_by_site(spark.createDataFrame([("s", 1)], "site string, n int"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_keep_first_keeps_whole_rows(spark):
    rows = [("a", None, "x"), ("b", 2, "y"), ("b", 1, None), ("b", None, "z"), ("c", 1, "q"), ("c", 1, "p")]
    got = dedup.keep_first(spark.createDataFrame(rows, "k string, o int, v string"), ["k"], "o")
    assert sorted(map(tuple, got.collect())) == [("a", None, "x"), ("b", 1, None), ("c", 1, "p")]
    assert got.columns == ["k", "o", "v"]


def test_selectors(spark):
    html = '<ul class="list x"><li><a href="/1" title="T">A &amp; B</a><li><a href="/2">C</a></ul><div id=m><p>t<br>u<p>v</div><!-- <p>no</p> --><table><tr><td>x'
    pages = spark.createDataFrame([(1, html), (2, None), (3, ""), (4, "<div>" * 5000 + "deep")], "id int, html string")
    say = {"a": {"selector": "ul.list > li a"}, "h": {"selector": "//ul[contains(@class,'list')]//a/@href".replace("/@href", ""), "attr": "href"}, "p": {"selector": ["b", "#m p"]}, "t": {"selector": "a[title]", "attr": "title"}, "d": {"selector": "td, a[href$=2]"}}
    got = {r["id"]: r for r in extract.select_fields(pages, ["id"], say).collect()}
    assert (got[1]["a"], got[1]["h"], got[1]["t"], got[1]["d"]) == (["A & B", "C"], ["/1", "/2"], ["T"], ["C", "x"])
    assert got[1]["p"][-1] == "v" and got[2]["a"] is None and got[3]["a"] == [] and got[4]["p"] == []
    rows = extract.list_rows(pages, ["id"], "ul li", {"title": {"selector": "a"}, "date": {"selector": "a", "attr": "href"}}, most=1).collect()
    assert [(r["id"], r["index"], r["title"], r["date"]) for r in rows] == [(1, 1, "A & B", "/1")]
    with pytest.raises(ValueError):
        extract.select_fields(pages, ["id"], {"a": {"selector": "p:first"}})


def test_rules_compose(spark):
    own = rules.compiled({"n": {"type": "integer", "minimum": 2, "maximum": 5}, "s": {"required": True, "pattern": "ab", "max_length": 3}}, base={})
    own["n"] = (*own["n"], rules.custom("even", lambda c: c.try_cast("int") % 2 == 0))
    rows = [("4", "abc"), ("x", " "), (None, "xab"), ("7", "abcd"), ("3", None)]
    got = spark.createDataFrame(rows, "n string, s string").select(rules.field_errors(own).alias("e"), rules.field_results(own).alias("r")).collect()
    assert [r["e"] for r in got] == [[], ["n:type", "n:range", "n:even", "s:required", "s:pattern"], ["n:even", "s:pattern"], ["n:range", "n:even", "s:length"], ["n:even", "s:required"]]
    assert got[0]["r"] == {"n": True, "s": True} and got[3]["r"] == {"n": False, "s": False}
    empty = spark.createDataFrame([], "errors array<string>")
    assert tuple(rules.validation_stats(empty).first()) == (0, 0, 0, 0, 0)


def test_consistency_by_names(spark):
    names = [["a_b", "c_d", "e_f", "g_h", "x"], ["a_b", "cD"], ["Ab", "Cd"], []]
    got = spark.createDataFrame([(n,) for n in names], "n array<string>").select(quality.consistency(F.col("n")).alias("c"), quality.consistency(F.col("n"), F.lit(True)).alias("d")).collect()
    assert [(r["c"], r["d"]) for r in got] == [(100, 90), (90, 80), (100, 90), (100, 90)]


def test_files_and_sinks(spark, tmp_path):
    (tmp_path / "bj.json").write_text('{"name": "Beijing", "urls": ["u"]}')
    configs = tables.json_configs(spark, str(tmp_path / "bj.json"), "urls array<string>").collect()
    assert [(r["name"], r["urls"]) for r in configs] == [("bj", ["u"])]
    docs = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "url string, n int")
    tables.write_unique(docs, str(tmp_path / "store"), "url")
    tables.write_unique(docs.union(spark.createDataFrame([("c", 4)], docs.schema)), str(tmp_path / "store"), "url")
    assert sorted(r["url"] for r in tables.scan(spark, str(tmp_path / "store")).collect()) == ["a", "b", "c"] and tables.scan(spark, str(tmp_path / "store"), 2).count() == 2
    assert not tables.write_json_lines(docs.limit(0), str(tmp_path / "j"), empty=False) and tables.write_json_lines(docs, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 3
    docs.select(F.lit("s").alias("site"), "n").write.parquet(str(tmp_path / "in"))
    query = tables.stream_by_site(spark.readStream.schema("site string, n int").parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2024-01-02 08:30:05", "2024-01-02T08:30:05"), ("2024-01-02", "2024-01-02T00:00:00"), ("Jan 2, 2024 8:30", "2024-01-02T08:30:00"), ("2024-01-02T08:30:00+0800", "2024-01-02T08:30:00+08:00"),
        ("2024-01-02T08:30:00Z", "2024-01-02T08:30:00+00:00"), ("no date", "no date"), ("", ""), (None, None),
    ],
)
def test_date_kind(spark, text, want):
    assert one(spark, lambda c: extract.cast_value(c, "date"), text) == want


def test_settings(spark):
    rows = [("a", "SECRET_KEY", "your-" + "x" * 40), ("a", "SECRET_KEY", None), ("a", "RETRY_TIMES", "1e1"), ("a", "DOWNLOAD_DELAY", "1d"), ("a", "REDIS_PORT", ""), ("a", "SMTP_HOST", "h"), (None, "NOT_KNOWN", "x"), ("b", None, None)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "scope string, name string, value string, level string")
    got = {}
    for r in settings.setting_problems(df).collect():
        got.setdefault(r["scope"], set()).add((r["level"], r["name"], r["problem"]))
    assert {("error", "SECRET_KEY", "default_value"), ("error", "DOWNLOAD_DELAY", "not_a_number"), ("error", "REDIS_PORT", "incomplete"), ("warning", "SMTP_PORT", "incomplete"), ("error", "ENVIRONMENT", "missing")} <= got["a"]
    assert not {n for _, n, _ in got["a"]} & {"RETRY_TIMES", "SMTP_HOST", "REDIS_HOST", "SLACK_WEBHOOK_URL"}
    assert got["b"] == got[None] and ("error", "SECRET_KEY", "empty") in got["b"] and ("warning", "REDIS_PASSWORD", "empty") in got["b"]
    assert settings.setting_problems(df.limit(0)).count() == 0
    faults = lambda p: one(spark, settings.password_faults, p)
    assert faults("Ab1!efgh") == [] and faults("abc") == ["short", "no_upper", "no_digit", "no_special"] and faults(None) is None
    assert faults("") == ["short", "no_upper", "no_lower", "no_digit", "no_special"]


def test_config_formats(spark):
    texts = [None, "", "[1]", "{bad", '{"fields": [1]}', '{"fields": {}}', '{"site_info": null, "target_pages": 1}', '{"name": 1, "base_url": 2, "fields": {}}']
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "i int, json string, valid int")
    got = [(r["format"], r["missing"], r["valid"]) for r in settings.checked_configs(df).orderBy("i").collect()]
    assert got == [("unknown", None, False)] * 5 + [("old", ["name", "base_url"], False), ("new", ["browser_config", "selectors", "crawling_strategy"], False), ("old", [], True)]


REFERENCES = [
    (1, '<html lang="en"><title>a&amp;b&amp</title><body><nav><ul><li><a href="/xy">x&quot;y</a></li><li><a href="/z">z</a></li></ul></nav><article><h1>say &quot;a&amp;b&amp</h1></article><div class="ad">&middot; c&amp;</div>'),
    (2, '<html lang="de"><title>&#39;&amp;lt;&lt</title><body><nav><ul><li><a href="/b">b</a></li></ul></nav><article><h1>&am</h1></article><div class="ad">d</div>'),
]


@pytest.mark.parametrize("name", ["x1_selectors", "x1_x7_rules"])
def test_references_of_titles_are_read_as_in_sql(spark, tmp_path, name):
    """Titles cut within a reference, and references other than that of the ampersand."""
    spark.createDataFrame(REFERENCES, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    df, result = QUERIES[name](spark, str(tmp_path)), con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    assert plain(tuple(r[c] for c in columns) for r in df.collect()) == plain(result.fetchall())
    got = extract.rule_values(spark.createDataFrame(REFERENCES, "page_id long, html string"), ["page_id"], {"h": {"method": "css", "selector": "h1"}})
    assert [r["h"] for r in got.orderBy("page_id").collect()] == ['say "a&b&', "&am"]


def test_words_are_counted_only_in_texts_with_tags(spark):
    """A text without a tag is scored without an array of its words."""
    import time

    c = F.col("content")
    texts = spark.range(1).select(F.repeat(F.lit("ab "), 3_000_000).alias("content")).cache()
    texts.count()
    took = []
    for text in (c, c, F.concat(F.lit("<b>"), c)):
        at = time.perf_counter()
        assert texts.select(quality.validity(F.lit("http://x"), text)).first()[0] == 100
        took.append(time.perf_counter() - at)
    assert took[1] < took[2] / 2
    rows = [(None,), ("",), ("<b>",), ("<b>" * 3 + "a",), ("a b c d <i>",), ("a < b",)]
    got = spark.createDataFrame(rows, "content string").select(quality.validity(F.lit("http://x"), c))
    assert [r[0] for r in got.collect()] == [100, 100, 80, 80, 100, 100]


@pytest.mark.parametrize("blank", [None, "", " \t\r\n", "　 \x85\xa0"])
def test_blank_texts_have_no_text(spark, blank):
    df = spark.createDataFrame([(blank, "x" if blank is None else f"{blank}x{blank}")], "s string, t string")
    got = df.select(*[quality.present(F.coalesce(c, F.lit(""))) for c in ("s", "t")], rules.required().holds(F.col("s")), rules.required().holds(F.col("t"))).first()
    assert tuple(got) == (False, True, False, True)


def test_blanks_are_told_without_rewriting_the_text(spark):
    """Neither presence nor a required field makes a stripped copy of a text."""
    df = spark.range(1).select(F.col("id").cast("string").alias("s")).select(quality.present(F.col("s")), rules.required().holds(F.col("s")))
    assert "regexp_replace" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_titles_are_cut_without_splitting_the_text(spark, tmp_path):
    rows = [(1, "one\ntwo\n"), (2, "one"), (3, ""), (4, None), (5, "\nx"), (6, "y" * 300)]
    spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = tables.articles(spark, str(tmp_path)).orderBy("doc_id").select("title")
    assert [r[0] for r in got.collect()] == ["one", "one", "", None, "", "y" * 200]
    assert "split" not in got._jdf.queryExecution().optimizedPlan().toString().lower()


def test_capable_workers_are_dealt_out_and_packed(spark, tmp_path):
    """Every pair once for each task row, in partitions of bounded rows and in an order that packs well."""
    workers = spark.range(1200).select(F.col("id").alias("worker_id"), F.array(F.col("id") % 3, F.col("id") % 2, F.col("id") % 3).alias("sites"))
    tasks = spark.range(0, 2000, 1, 1).select((F.col("id") * 7).alias("task_id"), (F.col("id") % 4).alias("site"))
    got = ops.capable_workers(workers, tasks, rows=100_000)
    got.write.parquet(str(tmp_path / "pairs"))
    each = workers.select("worker_id", F.explode("sites").alias("s")).distinct()
    want = tasks.join(each, F.col("site") == F.col("s")).select("task_id", "worker_id")
    n = want.count()
    back = spark.read.parquet(str(tmp_path / "pairs"))
    assert back.count() == n == 1_000_000 and back.exceptAll(want).isEmpty()
    assert max(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()) < 400_000
    assert sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet")) < 0.2 * n


@pytest.mark.parametrize("rows", [1, 1 << 24])
def test_capable_workers_with_nulls_and_repeats(spark, rows):
    tasks = [(1, 0), (1, 0), (None, 0), (None, 0), (2, 1), (3, None), (4, 9), (1, 1)]
    workers = [(10, [0, 1, 0]), (10, [0]), (11, [1, None]), (None, [0]), (12, []), (13, None), (14, [5])]
    t, w = spark.createDataFrame(tasks, "task_id long, site long"), spark.createDataFrame(workers, "worker_id long, sites array<long>")
    want = [(a, k) for a, site in tasks if site is not None for k in {k for k, sites in workers if site in (sites or [])}]
    assert sorted(map(str, map(tuple, ops.capable_workers(w, t, rows=rows).collect()))) == sorted(map(str, want))
    assert ops.capable_workers(w.limit(0), t, rows=rows).collect() == ops.capable_workers(w, t.limit(0), rows=rows).collect() == []
