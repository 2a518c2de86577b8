"""Registered queries over messages and rules that stand in tables; each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, extract, jsonpath, rules, segment
from ..operators import ops, rates, relevance
from ..sources import queues, tables
from ..sources.tables import articles, table
from .operations import _quantile_sql
from .queries import ARTICLES, QUERIES, _strip, query


@query("""with m as (select page_id, url, page_id % 6 as k, 's' || page_id % 4 as s from pages)
select page_id, case when k = 4 then '{"url": ' || url else url end as url, case k when 0 then s when 1 then 'own' when 2 then 't' when 3 then null end as site, case when k in (0, 2) then 'parse_list' end as callback,
case k when 0 then 'depth=2,site=' || s when 1 then 'site=own' when 2 then 'site=t' else '' end as meta, case k when 0 then 'X-Id=' || page_id else '' end as headers from m where k < 5""")
def s7_requests(spark, sf_dir):
    k, s, u = F.col("page_id") % 6, F.concat(F.lit("s"), (F.col("page_id") % 4).cast("string")), F.to_json(F.struct(F.col("url").alias("u")))
    bare = F.expr("substring(u, 6, length(u) - 6)")
    p = table(spark, sf_dir, "pages").select("page_id", "url", k.alias("k"), s.alias("s"), u.alias("u"))
    message = (
        F.when(F.col("k") == 0, F.concat(F.lit('{"url": '), bare, F.lit(', "callback": "parse_list", "site": "'), "s", F.lit('", "meta": {"depth": 2}, "headers": {"X-Id": "'), F.col("page_id").cast("string"), F.lit('"}}')))
        .when(F.col("k") == 1, F.concat(F.lit(' {"u": '), bare, F.lit(', "meta": {"site": "own"}, "site": "other"} ')))
        .when(F.col("k") == 2, F.concat(F.lit('{"u": '), bare, F.lit(', "callback": "parse_list", "site": "x", "meta": null}')))
        .when(F.col("k") == 3, F.concat(F.lit("  "), "url", F.lit(" "))).when(F.col("k") == 4, F.concat(F.lit('{"url": '), "url")).otherwise(" ")
    )
    messages = p.select(message.alias("value"), "page_id", "k")
    found = queues.requests(messages, target=F.when(F.col("k") == 2, F.lit("t")), keep=["page_id"])
    shown = lambda c: F.array_join(F.array_sort(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",")
    return found.select("page_id", "url", "site", "callback", shown("meta").alias("meta"), shown("headers").alias("headers"))


#: Rules of each site, which follow from its name, and one for all.
SITE_RULES = """rules as (select distinct source as site, length(source) as n, ascii(source) as a from documents)"""
CHECKED = (
    ARTICLES
    + f""", {SITE_RULES}, t as (select x.*, r.n, r.a from articles x left join rules r on x.site = r.site), e as (select doc_id, list_filter([
  case when a % 2 = 0 and not regexp_matches(author, '^(?:author [0-4])') then 'author:pattern' end,
  case when n is not null and {_strip("coalesce(author, '')")} = '' and a % 3 = 0 then 'author:required' end,
  case when length(content) < 10 * n or length(content) > 400 * n then 'content:length' end,
  case when n % 2 = 1 and publish_date is not null then 'publish_date:pattern' end,
  case when title is null or {_strip("title")} = '' then 'title:required' end,
  case when n is not null and length(title) > 60 + n then 'title:length' end], lambda x: x is not null) as errors from t)"""
)


@query(f"with {CHECKED} select doc_id, array_to_string(list_sort(errors), ',') as errors from e")
def v14_rules_by_table(spark, sf_dir):
    """Each site's rules from its name: lengths, a pattern, one pattern that cannot be read; a title is needed everywhere."""
    n, a = F.length("source"), F.ascii("source")
    none = F.lit(None)
    row = lambda field, required=none, low=none, high=none, pattern=none: F.struct(F.lit(field).alias("field"), required.cast("boolean").alias("required"), low.cast("int").alias("min_length"), high.cast("int").alias("max_length"), pattern.cast("string").alias("pattern"))
    each = F.array(
        row("author", a % 3 == 0, pattern=F.when(a % 2 == 0, "author [0-4]")), row("content", low=10 * n, high=400 * n), row("title", high=60 + n), row("publish_date", pattern=F.when(n % 2 == 1, "(")),
    )
    own = table(spark, sf_dir, "documents").select("source").distinct().select(F.col("source").alias("site"), F.explode(each).alias("r")).select("site", "r.*")
    base = spark.range(1).select(F.lit(None).cast("string").alias("site"), F.lit("title").alias("field"), F.lit(True).alias("required"))
    checked = rules.errors_by_table(articles(spark, sf_dir), own.unionByName(base, allowMissingColumns=True), "site", ["title", "content", "author", "publish_date"])
    return checked.select("doc_id", F.array_join(F.array_sort("errors"), ",").alias("errors"))


@query("""with i as (select l_orderkey as k, l_linenumber as n, l_partkey as p, l_quantity::bigint as q from lineitem),
g as (select k, list(p order by n, p, q) as ps, list(q order by n, p, q) as qs, count(*) as c from i group by k)
select k as order_key, array_to_string(ps, ',') as parts, qs[1] || '|' || qs[c] as ends, array_to_string(qs[2:3], ',') as second_third, c::bigint as n_deep, k || ',' || c as members, array_to_string(list_filter(ps, lambda x, j: j % 2 = 1), ',') as odd from g""")
def x4_json_paths(spark, sf_dir):
    """Orders as nested JSON, and paths with wildcards, places, slices and a descent into them."""
    item = F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("part"), F.col("l_quantity").cast("long").alias("qty"))
    orders = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("order_key")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    doc = F.to_json(F.struct("items", F.struct(F.col("order_key").alias("a"), F.size("items").alias("b")).alias("meta")))
    text = lambda path: F.array_join(jsonpath.json_values(F.col("doc"), path, F.col("tree")), ",")
    ends = F.concat_ws("|", *[jsonpath.json_value(F.col("doc"), path, F.col("tree")) for path in ("$.items[0].qty", "items[-1]['qty']")])
    return orders.select("order_key", doc.alias("doc")).select("*", F.try_parse_json("doc").alias("tree")).select(
        "order_key", text("$.items[*].part").alias("parts"), ends.alias("ends"), text("$.items[1:3].qty").alias("second_third"), F.size(jsonpath.json_values(F.col("doc"), "$..part")).cast("long").alias("n_deep"), text("$.meta.*").alias("members"), text("$.items[::2].part").alias("odd"),
    )


@query("""select s_suppkey, s_name as name, s_name || '数据爬取' as description, case when s_suppkey % 3 = 0 then s_suppkey / 4.0 else 2.0 end as delay, case when s_suppkey % 2 = 0 then 'title_selectors' else 'date_selectors,title_selectors' end as selectors,
case when s_suppkey % 5 = 0 then 'title' else '' end as required, 'http://x/' || s_suppkey || ' list_page' as first_page from supplier""")
def p15_reshaped(spark, sf_dir):
    """Suppliers as old flat configurations, reshaped and read by paths."""
    k = F.col("s_suppkey")
    path = lambda s, needed: F.struct(F.lit("xpath").alias("method"), F.lit(s).alias("selector"), needed.alias("required"))
    fields = F.map_filter(F.create_map(F.lit("date"), path("//i", F.lit(False)), F.lit("title"), path("//h1", k % 5 == 0)), lambda name, _: (name == "title") | (k % 2 == 1))
    old = F.to_json(F.struct(F.col("s_name").alias("name"), F.when(k % 3 == 0, F.struct((k / 4).alias("delay"))).alias("request_settings"), F.array(F.struct(F.concat(F.lit("http://x/"), k.cast("string")).alias("url"))).alias("start_urls"), fields.alias("fields")))
    new = table(spark, sf_dir, "supplier").select("s_suppkey", jsonpath.reshaped(old).alias("c"))
    one = lambda p: jsonpath.json_value(F.col("c"), p)
    return new.select(
        "s_suppkey", one("$.site_info.name").alias("name"), one("$.site_info.description").alias("description"), one("$.crawling_strategy.delays.between_requests").cast("double").alias("delay"),
        F.array_join(F.array_sort(F.map_keys(F.from_json(one("$.selectors"), "map<string,array<string>>"))), ",").alias("selectors"), F.array_join(jsonpath.json_values(F.col("c"), "$.data_extraction.required_fields[*]"), ",").alias("required"),
        F.concat_ws(" ", one("$.target_pages[0].url"), one("$.target_pages[0].type")).alias("first_page"),
    )


_SLIDING = "unnest(list_transform(range(6), lambda i: epoch_us(ts) // 3600000000 * 3600 - i * 3600))"


_BY_TIME = "over (partition by spider order by ts, event_id)"


@query(f"""with s as (select event_type as spider, ts, event_id, (event_id * 7) % 1000 as v from events),
i as (select *, case when lag(v) {_BY_TIME} is null then 0 when v < lag(v) {_BY_TIME} then v else v - lag(v) {_BY_TIME} end as grown from s),
e as (select spider, grown, {_SLIDING} as began from i)
select spider, make_timestamp(began * 1000000) as start, sum(grown)::bigint as increase, (1000000 * sum(grown) // 21600)::bigint as per_second_ppm from e group by spider, began""")
def a25_counter_rates(spark, sf_dir):
    s = table(spark, sf_dir, "events").select(F.col("event_type").alias("spider"), F.col("ts").cast("timestamp").alias("ts"), "event_id", (F.col("event_id") * 7 % 1000).alias("v"))
    found = rates.counter_rates(s, ["spider"], "ts", "v", 21600, 3600, "event_id")
    return found.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query(f"""with e as (select user_id % 8 as site, event_type = 'error' as bad, event_id % 12000 as ms, {_SLIDING} as began from events),
g as (select site, began, count(*) as n, count(*) filter (bad) as bad, {', '.join(f'count(*) filter (ms <= {b}) as le_{b}' for b in ops.LATENCY_BOUNDS)} from e group by all)
select site, make_timestamp(began * 1000000) as start, n, bad, 1000000 * bad // n as ratio_ppm, {_quantile_sql()} as quantile from g""")
def a25_sliding_requests(spark, sf_dir):
    r = table(spark, sf_dir, "events").select((F.col("user_id") % 8).alias("site"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") == "error").alias("bad"), (F.col("event_id") % 12000).alias("ms"))
    ratios = rates.failure_ratio(r, ["site"], "ts", F.col("bad"), 21600, 3600)
    quantiles = rates.sliding_quantile(r, ["site"], "ts", F.col("ms"), 950, 21600, 3600).drop("n")
    return ratios.join(quantiles, ["site", "start"]).withColumn("start", F.col("start").cast("timestamp_ntz"))


_FORMS = ("MMM d, yyyy", "d MMMM yyyy", "EEE, dd MMM yyyy HH:mm:ss", "d/M/yyyy", "yyyy/M/d", "dd-MMM-yyyy")


@query("""with x as (select doc_id, date '2024-01-01' + (doc_id % 366)::int as d, doc_id % 7 as k from documents)
select doc_id, case when k = 6 or (k = 3 and day(d) <= 12 and day(d) <> month(d)) then null else strftime(d, '%Y-%m-%d') end as day from x""")
def f4_free_dates(spark, sf_dir):
    """Dates in six forms, of which day/month/year is often open; every seventh text holds none."""
    at = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 366).cast("int")).cast("timestamp")
    text = F.lit("posted in may by 2024")
    for i, form in enumerate(_FORMS):
        text = F.when(F.col("doc_id") % 7 == i, F.concat(F.lit("on "), F.date_format(at, form), F.lit(" by x"))).otherwise(text)
    return table(spark, sf_dir, "documents").select("doc_id", dates.free_date(text).alias("day"))


def _by_length(titles: list[str]) -> list[str]:
    """A stand-in for a classifier, which cannot answer for every seventh length."""
    if any(len(t) % 7 == 0 for t in titles):
        raise ValueError("no answer")
    return [relevance.RELEVANT if len(t) % 2 == 0 else "不相关" for t in titles]


@query(f"""with {ARTICLES}, t as (select doc_id, length({_strip("coalesce(title, '')")}) as n from articles)
select doc_id, case when n > 0 and n % 7 > 0 then '相关' end as said, n > 0 and n % 7 = 0 as failed from t where n = 0 or n % 7 = 0 or n % 2 = 0""")
def p8_relevance(spark, sf_dir):
    kept = relevance.relevant(articles(spark, sf_dir).select("doc_id", "title"), _by_length)
    return kept.select("doc_id", F.col("relevance.said").alias("said"), F.col("relevance.error").isNotNull().alias("failed"))


#: Words of the dictionary by which titles are cut.
DICTIONARY = 5000


def f11_segments(spark, sf_dir):
    """Titles without their spaces, cut by the commonest words of all texts. No SQL has its like; tests hold it against all ways to cut."""
    counts = segment.word_counts(table(spark, sf_dir, "documents"), "text", DICTIONARY)
    words = segment.segmented(spark, F.replace(F.col("title"), F.lit(" "), F.lit("")), counts, ("the",))
    return articles(spark, sf_dir).select("doc_id", F.array_join(words, " ").alias("words"), F.size(words).alias("n_words"))


QUERIES["f11_segments"] = f11_segments


@query("""with n as (select page_id, page_id % 3 as k, regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<li><a href="([^"]*)">', 1) as links,
  list_transform(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<li><a href="[^"]*">([^<]*)</a>', 1), lambda x: replace(x, '&amp;', '&')) as names from pages),
e as (select page_id, k, unnest(links) as link, unnest(names) as name, unnest(range(1, len(links) + 1)) as i from n)
select page_id, nullif(case k when 0 then 't' || link else name end, '') as title, case k when 0 then 'https://s/item?id=' || link else link end as url, case k when 0 then '2024-01-0' || (i % 9 + 1) end as date, i::int as index from e where link <> '' and not (k = 0 and i = 2)""")
def s11_list_answers(spark, sf_dir):
    """A page's navigation as three kinds of answers: an array in JSON, HTML in JSON, and HTML."""
    k = F.col("page_id") % 3
    links = extract.by_pattern(F.regexp_extract("html", "(?s)<nav>(.*?)</nav>", 1), '<li><a href="([^"]*)">')
    item = lambda link, i: F.struct(F.concat(F.lit("t"), link).alias("name"), F.when(i != 1, link).alias("id"), F.concat(F.lit("2024-01-0"), ((i + 1) % 9 + 1).cast("string")).alias("day"))
    pages = table(spark, sf_dir, "pages").select("page_id", k.alias("k"), "html", links.alias("links"))
    array, nested = F.to_json(F.struct(F.struct(F.transform("links", item).alias("list")).alias("data"))), F.to_json(F.struct(F.struct(F.col("html").alias("text")).alias("page")))
    r = pages.select("page_id", "k", F.when(F.col("k") == 0, array).when(F.col("k") == 1, nested).otherwise(F.col("html")).alias("body"))
    json_form = {"json_path": "data.list", "field_mappings": {"title": "name", "url": "id", "date": "day"}, "url_template": "https://s/item?id={url}", "json_html_field": "page.text", "html_item_selector": "nav ul li"}
    found = tables.list_answers(r.where("k < 2"), ["page_id"], json_form)
    return found.unionByName(tables.list_answers(r.where("k = 2"), ["page_id"], {"response_type": "html", "html_item_selector": "nav ul li"}))
