"""Registered queries of the document and metrics operators, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as fn
from ..operators import analysis, antibot, dedup, joins, ops, quality
from ..sources.tables import NOW, articles, between_dates, one_of, revisions, search_hits, table, task_metrics

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

ARTICLES = """articles as (select doc_id, 'https://' || source || '.example.org/' || lang || '/' || doc_id || '.html' as url, substr(split_part(text, chr(10), 1), 1, 200) as title,
  text as content, source as site, lang, strftime(date '2024-01-01' + (doc_id % 30)::int, '%Y-%m-%d') as publish_date, case when doc_id % 3 > 0 then 'author ' || doc_id % 50 end as author,
  case when doc_id % 9 > 0 then strftime(timestamp '2024-02-01 00:00:00' - to_hours(doc_id % 400), '%Y-%m-%dT%H:%M:%S') || case when doc_id % 10 = 0 then 'Z' else '' end end as crawl_time from documents)"""
TASKS = """tasks as (select event_id as task_id, user_id % 16 as worker_id, ts as start_time, value::decimal(18,4) as duration, case when event_type = 'error' then 'failed' else 'completed' end as status,
  (props->>'$.k')::bigint as items, user_id % 8 as site, event_type as spider, event_id % 7 as pages from events)"""
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Latin stand-ins for the default dictionaries, which the stored tables cannot hit.
WORDS = {"first": ("thon", "haer", "erst"), "second": ("ciónado", "eauou", "keit"), "third": ("licen", "idiot", "token")}
PLACES = ("and the", "que", "der", "zzz")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def planted(spark: SparkSession, sf_dir: str, values: tuple[str, ...], lead: int | None = 0) -> DataFrame:
    """A text ``s`` for each document: one of ``values`` in turn, after the first ``lead`` characters of its own whole text (none: at its end)."""
    t = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(*([t, one_of("doc_id", values)] if lead is None else [F.substring(t, 1, lead), one_of("doc_id", values), F.expr(f"substring(coalesce(text, ''), {lead + 1})")])).alias("s"))


def _planted(values: tuple[str, ...], lead: int | None = 0) -> str:
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    one = f"([{listed}])[1 + (doc_id % {len(values)})::int]"
    whole = f"coalesce(text, '') || {one}" if lead is None else f"substr(coalesce(text, ''), 1, {lead}) || {one} || substr(coalesce(text, ''), {lead + 1})"
    return f"v as (select doc_id, {whole} as s from documents)"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


CSS_RULE = r"(?:^(?:" + WS + r"|[\x{feff}\x{200b}])*|" + WS + r")[.#][\p{L}\p{N}_\-]+[^{}]{0,80}\{[^{}]*\}"


def _html(x: str) -> str:
    return rf"""trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce({x}, ''), '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]+>', ' ', 'g'),
  '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&nbsp;', ' '), '{CSS_RULE}', ' ', 'g'), '{WS}+', ' ', 'g'))"""


#: Every third page gets a bare CSS rule after its first tag.
STYLED = "(select page_id, case when page_id % 3 = 0 then replace(html, '<h1>', '<h1> .TRS_Editor p' || chr(10) || ' { color: red; } #x{}') else html end as html from pages)"


def styled(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.replace("html", F.lit("<h1>"), F.lit("<h1> .TRS_Editor p\n { color: red; } #x{}"))
    return table(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 3 == 0, marked).otherwise(F.col("html")).alias("html"))


@query(f"select page_id, {_html('html')} as plain from {STYLED}")
def f1_clean_html(spark, sf_dir):
    return styled(spark, sf_dir).select("page_id", fn.clean_html(F.col("html")).alias("plain"))


@query(f"with p as (select page_id, {_html('html')} as h from {STYLED}), t as (select page_id, substr(h, 1, 300) as t, substr(regexp_replace(h, '[^\\p{{L}}\\p{{N}}_{WS[1:-1]}]', '', 'g'), 1, 50) as w from p) select page_id, case when length(t) >= 20 then t end as cleaned, nullif(w, '') as words from t")
def f2_clean_text(spark, sf_dir):
    h = F.col("html")
    return styled(spark, sf_dir).select("page_id", fn.clean_text(h, 20, 300).alias("cleaned"), fn.clean_text(h, 0, 50, True).alias("words"))


NUMBERS = ("1,234.50元", "1,200", "约-3.5度", "无", "12,345,678", "7", "第2名")


@query(f"""with {_planted(NUMBERS)}, n as (select *, try_cast(nullif(regexp_extract(replace(replace(s, ',', ''), '，', ''), '(-?\\d+\\.?\\d*)', 1), '') as double) as number from v)
select doc_id, number, trunc(number)::bigint as whole, case when number between 0 and 1000 then number end as bounded, coalesce(try_cast(nullif(regexp_replace(s, '[^0-9]', '', 'g'), '') as bigint), 0) as digits from n""")
def f3_clean_number(spark, sf_dir):
    s = F.col("s")
    return planted(spark, sf_dir, NUMBERS).select("doc_id", fn.clean_number(s).alias("number"), fn.clean_integer(s).alias("whole"), fn.clean_number(s, 0, 1000).alias("bounded"), fn.digits_number(s).alias("digits"))


DATES = ("2024年1月2日", "2024-01-02T03:04:05Z", "2024.3.9 发布", "20240102", "01-02", "2024", "昨天", "2024-13-40")


@query(
    f"""with {_planted(DATES)}, t as (select doc_id, regexp_replace(regexp_replace(regexp_replace(s, '[年月]', '-', 'g'), '日', '', 'g'), '[^\\d\\-\\s:.+TZtz]', '', 'g') as t from v)
select doc_id, strftime(coalesce(try_strptime(nullif(replace(regexp_extract(t, '(\\d{{4}})[-.](\\d{{1,2}})[-.](\\d{{1,2}})'), '.', '-'), ''), '%Y-%m-%d'),
  try_strptime(nullif(regexp_extract(t, '(?:^|[^0-9])(\\d{{8}})(?:[^0-9]|$)', 1), ''), '%Y%m%d')), '%Y-%m-%d') as day from t"""
)
def f4_clean_date(spark, sf_dir):
    return planted(spark, sf_dir, DATES).select("doc_id", fn.clean_date(F.col("s")).alias("day"))


API_DATES = ("2024-01-02T03:04:05Z", "20240102", "20240102T0304", "2024/1/2 x", "2024.01.02 03", "yesterday", "2 Jan 2024")
TEXT_DATES = ("发布于2024年1月2日 ", "2024-01-02", " 2024 - 01 - 02 ", "2024/1/2日", "none ")
LOADER_DATES = ("2024-1-2", "2024年1月2日", "01/02/2024", "1/2/2024", "2024-13-01 2024年1月2日", "x")


@query(
    f"""with a as (select doc_id, ([{', '.join(f"'{x}'" for x in API_DATES)}])[1 + (doc_id % {len(API_DATES)})::int] as a, ([{', '.join(f"'{x}'" for x in TEXT_DATES)}])[1 + (doc_id % {len(TEXT_DATES)})::int] || doc_id % 3 as t, ([{', '.join(f"'{x}'" for x in LOADER_DATES)}])[1 + (doc_id % {len(LOADER_DATES)})::int] || ' ' as l from documents)
select doc_id, coalesce(strftime(try_strptime(nullif(regexp_extract(a, '^(\\d{{8}})(?:T.*)?$', 1), ''), '%Y%m%d'), '%Y-%m-%d'), case when substr(a, 5, 1) in ('-', '/', '.') then replace(substr(a, 1, 10), '/', '-') else a end) as api,
  {_strip(f"regexp_replace(coalesce(nullif(regexp_extract(t, '(\\d{{4}}[-/年]\\d{{1,2}}[-/月]\\d{{1,2}}日?)', 1), ''), t), '{WS}*-{WS}*', '-', 'g')")} as in_text,
  strftime(coalesce(try_strptime(nullif(regexp_extract(l, '(\\d{{4}}-\\d{{1,2}}-\\d{{1,2}})', 1), ''), '%Y-%m-%d'), try_strptime(nullif(regexp_replace(regexp_extract(l, '(\\d{{4}}年\\d{{1,2}}月\\d{{1,2}})日', 1), '[年月]', '-', 'g'), ''), '%Y-%m-%d'), try_strptime(nullif(regexp_extract(l, '(\\d{{2}}/\\d{{1,2}}/\\d{{4}})', 1), ''), '%m/%d/%Y')), '%Y-%m-%d') as loader from a"""
)
def f31_f33_dates(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    t = F.concat(one_of("doc_id", TEXT_DATES), (F.col("doc_id") % 3).cast("string"))
    return d.select("doc_id", fn.api_date(one_of("doc_id", API_DATES)).alias("api"), fn.date_in_text(t).alias("in_text"), fn.loader_date(F.concat(one_of("doc_id", LOADER_DATES), F.lit(" "))).alias("loader"))


REGIONS = ("北京市朝阳区", "宁夏回族自治区", "广东省", "香港特别行政区 ", "市", "\t台湾省台北市", "京津冀")


def _region_sql(x: str) -> str:
    out = _strip(x)
    for a, b in fn.REGION_NAMES:
        out = f"replace({out}, '{a}', '{b}')"
    for end in fn.REGION_SUFFIXES:
        out = f"regexp_replace({out}, '(?s)(.){end}$', '\\1')"
    return out


LISTED_REGIONS = ", ".join(f"'{r}'" for r in REGIONS)


@query(f"with {_planted(REGIONS, None)} select doc_id, {_region_sql('s')} as region, {_region_sql(f'([{LISTED_REGIONS}])[1 + (doc_id % {len(REGIONS)})::int]')} as alone from v")
def f5_clean_region(spark, sf_dir):
    return planted(spark, sf_dir, REGIONS, None).select("doc_id", fn.clean_region(F.col("s")).alias("region"), fn.clean_region(one_of("doc_id", REGIONS)).alias("alone"))


CONTACTS = ("http://a.cn/x?q=1", " https://b.org ", "\thttp://a.cn\n", "ftp://c.d", "A.B@Example.COM ", "a@b", "138-0013-8000", "12345", "010 8888 9999")


@query(
    f"""with v as (select doc_id, ([{', '.join("'" + x.replace(chr(9), "' || chr(9) || '").replace(chr(10), "' || chr(10) || '") + "'" for x in CONTACTS)}])[1 + (doc_id % {len(CONTACTS)})::int] || case when doc_id % 2 = 1 then (doc_id % 10)::varchar else '' end as s from documents),
u as (select doc_id, s, case when regexp_matches({_strip('s')}, '^https?://[^\\s<>"{{}}|\\\\^`\\[\\]]+') then {_strip('s')} end as url from v)
select doc_id, url, string_split(url, '?')[1] as bare,
case when regexp_matches(lower({_strip('s')}), '^[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}$') then lower({_strip('s')}) end as email,
case when length(regexp_replace(s, '[^0-9]', '', 'g')) >= 7 then regexp_replace(s, '[^0-9]', '', 'g') end as phone from u"""
)
def f6_f8_contacts(spark, sf_dir):
    s = F.col("s")
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(one_of("doc_id", CONTACTS), F.when(F.col("doc_id") % 2 == 1, (F.col("doc_id") % 10).cast("string")).otherwise("")).alias("s"))
    return d.select("doc_id", fn.clean_url(s).alias("url"), fn.clean_url(s, True).alias("bare"), fn.clean_email(s).alias("email"), fn.clean_phone(s).alias("phone"))


SOURCES = ("来源：新华网 作者：张三", "市卫健委 发布", "<b>北京日报</b> 作者：李四", "疾控中心", "浏览次数 10", "发布时间：2024", "晚报 分享到微信", None)
NO_SOURCE = "一二三四五六七八九十一二三四五六七八九十一二三四五六七八九十长"


def _source_sql(x: str) -> str:
    rest = _html(x)
    for noise in fn.SOURCE_NOISE:
        rest = f"regexp_replace({rest}, '(?i){noise}', '', 'g')"
    return rest


@query(
    f"""with v as (select doc_id, case when doc_id % 10 = 9 then '{NO_SOURCE}' else ([{', '.join('null' if x is None else f"'{x}'" for x in SOURCES)}])[1 + (doc_id % {len(SOURCES)})::int] || case when doc_id % 2 = 1 then ' ' || lang else '' end end as s from documents),
r as (select *, {_html('s')} as h, {_strip(_source_sql('s'))} as r from v),
e as (select *, {_strip("regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(r, '" + fn.SOURCE_ENDS[0] + "', '', 'g'), '" + "', '', 'g'), '".join(fn.SOURCE_ENDS[1:]) + "', '', 'g')")} as e from r)
select doc_id, case when s is null then null when regexp_matches(h, '(?:新闻来源|来源|发布机构)\\s*[:：]\\s*(\\S+)') then regexp_extract(h, '(?:新闻来源|来源|发布机构)\\s*[:：]\\s*(\\S+)', 1) when r = '' then null
{" ".join(f"when regexp_matches(r, '{p}') then '{n}'" for p, n in fn.SOURCE_NAMES)} when length(e) between 1 and 30 then e end as origin from e"""
)
def f9_clean_source(spark, sf_dir):
    s = F.when(F.col("doc_id") % 10 == 9, NO_SOURCE).otherwise(F.concat(one_of("doc_id", SOURCES), F.when(F.col("doc_id") % 2 == 1, F.concat(F.lit(" "), "lang")).otherwise("")))
    return table(spark, sf_dir, "documents").select("doc_id", fn.clean_source(s).alias("origin"))


TITLES = ("疫情通报：确诊病例12例", "关于政策的通知", "工作会议动态", "数据报告", "其他内容", "新冠疫苗接种", "医院诊疗与卫生防控", "上海新增死亡3例，治愈5例")


def _any_sql(col: str, words) -> str:
    return "(" + " or ".join(f"contains({col}, '{w}')" for w in words) + ")"


@query(
    f"""with {_planted(TITLES, 4)} select doc_id, case {" ".join(f"when {_any_sql('lower(s)', w)} then '{n}'" for n, w in fn.CATEGORIES)} else '其他' end as category,
array_to_string(list_filter([{", ".join(f"case when {_any_sql('lower(s)', w)} then '{n}' end" for n, w in fn.TAGS)}], lambda x: x is not null), ',') as tags,
case {" ".join(f"when contains(s, '{p}') then '{p}'" for p in fn.PROVINCES)} else '全国' end as region,
{", ".join("coalesce(" + ", ".join(f"try_cast(nullif(regexp_extract(s, '{p}', 1), '') as bigint)" for p in ps) + f", 0) as {k}" for k, ps in fn.CASE_PATTERNS.items())} from v"""
)
def f22_f25_annotations(spark, sf_dir):
    s = F.col("s")
    return planted(spark, sf_dir, TITLES, 4).select("doc_id", fn.category_of(s).alias("category"), F.array_join(fn.tags_of(s), ",").alias("tags"), fn.region_of(s).alias("region"), *[fn.case_count(s, k).alias(k) for k in fn.CASE_PATTERNS])


@query(f"with {ARTICLES} select doc_id, substr(sha1(url), 1, 16) as article_id, sha256(regexp_replace(coalesce(content, ''), '{WS}+', '', 'g')) as content_fp, md5(concat_ws('|', url, title, content)) as item_fp from articles")
def f15_f17_fingerprints(spark, sf_dir):
    c = F.col
    return articles(spark, sf_dir).select("doc_id", fn.article_id(c("url")).alias("article_id"), fn.content_fingerprint(c("content")).alias("content_fp"), fn.item_fingerprint(c("url"), c("title"), c("content")).alias("item_fp"))


@query(f"with {ARTICLES} select doc_id, length(content) as content_length, len(regexp_extract_all(content, '[\\x{{4e00}}-\\x{{9fff}}]')) as n_cjk, array_to_string((regexp_extract_all(content, '\\d+'))[1:10], ',') as numbers from articles")
def f18_key_info(spark, sf_dir):
    c = F.col("content")
    return articles(spark, sf_dir).select("doc_id", F.length(c).cast("long").alias("content_length"), fn.cjk_count(c).alias("n_cjk"), F.array_join(fn.first_numbers(c), ",").alias("numbers"))


LIST_URLS = ("http://x/list.shtml", "http://x/list_9.shtml", "http://x/list_9/a.html", "http://x/list_9/list_12.shtml", "http://x/12.htm", "http://x/12.html?a", "http://x/7.shtml", "http://x/ARTICLE/1")


@query(rf"""with u as (select page_id, case when page_id % 2 = 0 then url else ([{', '.join(f"'{x}'" for x in LIST_URLS)}])[1 + (page_id // 2 % {len(LIST_URLS)})::int] end as url, page_id % 5 as n_items, case when page_id % 4 > 0 then regexp_replace(html, '<[^>]+>', '', 'g') else '' end as content from pages),
n as (select *, regexp_extract(url, 'list_(\d+)\.shtml', 1) as n from u)
select page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) as host, lower(regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '\.([A-Za-z0-9]+)$', 1)) as ext,
case when regexp_matches(lower(url), 'list|index|category|列表') then 'list_page' when regexp_matches(lower(url), '/\d+\.s?html$|detail|article') then 'detail_page' when n_items >= 3 then 'list_page' when length({_strip("content")}) > 50 then 'detail_page' else 'unknown_page' end as page_type,
case when ends_with(url, 'list.shtml') then replace(url, 'list.shtml', 'list_2.shtml') when ends_with(url, '.shtml') and n <> '' then replace(url, 'list_' || n || '.shtml', 'list_' || (n::int + 1) || '.shtml') end as next_url from n""")
def f21_f27_page_urls(spark, sf_dir):
    k = F.col("page_id")
    other = F.get(F.array(*map(F.lit, LIST_URLS)), (F.floor(k / 2) % len(LIST_URLS)).cast("int"))
    content = F.when(k % 4 > 0, F.regexp_replace("html", "<[^>]+>", "")).otherwise("")
    p = table(spark, sf_dir, "pages").select("page_id", F.when(k % 2 == 0, F.col("url")).otherwise(other).alias("url"), (k % 5).alias("n_items"), content.alias("content"))
    u = F.col("url")
    return p.select("page_id", fn.url_host(u).alias("host"), fn.url_extension(u).alias("ext"), fn.page_type(u, F.col("n_items"), F.col("content")).alias("page_type"), fn.next_page(u).alias("next_url"))


ERRORS_SQL = f"""array_to_string(list_filter([case when {_strip("coalesce(url, '')")} = '' then 'url:required' end, case when not regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+') then 'url:format' end,
case when not (length(title) between 1 and 500) then 'title:length' end, case when length(content) < 10 then 'content:length' end, case when {_any_sql("lower(content)", quality.ERROR_PAGE)} then 'content:error_page' end], lambda x: x is not null), ';')"""


@query(f"with {ARTICLES} select doc_id, {ERRORS_SQL} as errors from articles")
def v10_validate(spark, sf_dir):
    c = F.col
    return articles(spark, sf_dir).select("doc_id", F.array_join(quality.validation_errors(c("url"), c("title"), c("content")), ";").alias("errors"))


@query(f"with {ARTICLES}, e as (select site, unnest(string_split({ERRORS_SQL}, ';')) as error from articles) select site, error, count(*) as n from e where error <> '' group by all")
def a9_validation_summary(spark, sf_dir):
    c = F.col
    return articles(spark, sf_dir).select("site", F.explode(quality.validation_errors(c("url"), c("title"), c("content"))).alias("error")).groupBy("site", "error").agg(F.count(F.lit(1)).alias("n"))


FIELDS_SQL = "[" + ", ".join(f"'{f}'" for f in quality.ARTICLE_FIELDS) + "]"
SCORED = (
    ARTICLES
    + f""", parts as (select *,
  (case when {_strip("coalesce(title, '')")} <> '' then 30 else 0 end) + (case when {_strip("coalesce(content, '')")} <> '' then 40 else 0 end) + 10 + 10 + (case when author is not null then 5 else 0 end) + (case when {_strip("coalesce(site, '')")} <> '' then 5 else 0 end) as completeness,
  100 - (case when coalesce(content, '') = '' then 0 when length(content) < 50 then 20 when length(content) > 100000 then 10 else 0 end) - (case when coalesce(title, '') = '' then 0 when length(title) < 5 or length(title) > 200 then 10 else 0 end) as accuracy,
  case when greatest(len(list_filter({FIELDS_SQL}, lambda f: contains(f, '_') and f = lower(f))), len(list_filter({FIELDS_SQL}, lambda f: regexp_matches(substr(f, 2), '[A-Z]'))), len(list_filter({FIELDS_SQL}, lambda f: regexp_matches(f, '^[A-Z]')))) * 10 < len({FIELDS_SQL}) * 8 then 90 else 100 end as consistency,
  case when crawl_time is null then 80 when epoch(timestamp '{NOW}') - epoch(replace(crawl_time, 'Z', '')::timestamp) > 168 * 3600 then 70 when epoch(timestamp '{NOW}') - epoch(replace(crawl_time, 'Z', '')::timestamp) > 24 * 3600 then 90 else 100 end as timeliness,
  greatest(0, 100 - (case when {_any_sql("lower(content)", quality.ERROR_TOKENS)} then 40 else 0 end)
    - (case when len(regexp_extract_all(content, '<[^>]+>')) * 10 > len(regexp_extract_all(content, '[^{WS[1:-1]}]+')) * 3 then 20 else 0 end)) as validity from articles),
scored as (select *, completeness * 25 + accuracy * 25 + consistency * 20 + timeliness * 15 + validity * 15 as overall from parts),
leveled as (select *, case when overall >= 9000 then '优秀' when overall >= 8000 then '良好' when overall >= 7000 then '中等' when overall >= 6000 then '较差' else '很差' end as level from scored)"""
)
LEVEL_NAMES = [*[n for n, _ in quality.LEVELS], quality.LOWEST_LEVEL]


def _scored(spark, sf_dir):
    return quality.score_articles(articles(spark, sf_dir), F.lit(NOW).cast("timestamp"))


@query(f"""with t as (select doc_id, timestamp '{NOW}' - to_hours((doc_id % 400)::int) as at from documents)
select doc_id, case when doc_id % 11 = 10 then 80 when age > 168 then 70 when age > 24 then 90 else 100 end as timeliness, case when doc_id % 11 <> 10 then age::double end as hours from (select doc_id, (doc_id % 400)::bigint as age from t)""")
def g1d_timeliness(spark, sf_dir):
    """Times with zones, compact ones, and such as cannot be read, after which the next field counts."""
    k = F.col("doc_id")
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(NOW).cast("timestamp")) - k % 400 * 3600)
    iso, compact = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.date_format(at, "yyyyMMdd'T'HHmmss")
    first = F.when(k % 11 == 0, F.concat(iso, F.lit("+08:00"))).when(k % 11 == 1, F.concat(iso, F.lit(".250Z"))).when(k % 11 == 2, compact).when(k % 11 == 3, "yesterday").when(k % 11 == 4, "").when(k % 11 == 5, "2024-13-01").when(k % 11 == 6, F.concat(compact, F.lit("-0330"))).when(k % 11 == 7, iso)
    second = F.when(k % 11 == 10, "n/a").when((k % 11).isin(3, 4, 5), F.concat(iso, F.lit("Z"))).when(k % 11 == 8, F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
    third = F.when(k % 11 == 9, iso).when(k % 11 == 10, "2024").otherwise("1999-01-01")
    hours = quality.age_hours(F.lit(NOW).cast("timestamp"), first, second, third)
    return table(spark, sf_dir, "documents").select("doc_id", quality.timeliness(hours).alias("timeliness"), hours.alias("hours"))


@query(f"with {SCORED} select doc_id, completeness, accuracy, consistency, timeliness, validity, overall, level from leveled")
def g1_quality_scores(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", "completeness", "accuracy", "consistency", "timeliness", "validity", "overall", "level")


@query(f"""with {SCORED}, g as (select site, count(*) as n, sum(overall)::bigint as total, min(overall) as least, max(overall) as most, sum(overall)::bigint // (10 * count(*)) as mean_milli, {', '.join(f"count(*) filter (level = '{x}') as n_{k}" for k, x in enumerate(LEVEL_NAMES))}, count(*) filter (level in ('较差', '很差')) as n_poor from leveled group by site)
select *, array_to_string(list_filter([case when mean_milli < 700 then 'low_mean' when mean_milli < 800 then 'fair_mean' end, case when n_poor * 5 > n then 'many_poor' end], lambda x: x is not null), ',') as advice from g""")
def quality_summary(spark, sf_dir):
    s = quality.quality_summary(_scored(spark, sf_dir), "site")
    return s.withColumn("advice", F.array_join(quality.summary_advice(F.col("mean_milli"), F.col("n"), F.col("n_poor")), ","))


@query(f"with {SCORED} select doc_id, site, floor(sum(overall) over w / count(*) over w)::bigint as mean from leveled window w as (partition by site order by doc_id rows unbounded preceding)")
def w5_running_mean(spark, sf_dir):
    return quality.running_mean(_scored(spark, sf_dir), "site", "doc_id").select("doc_id", "site", "mean")


@query(f"""with {SCORED}, r as (select site, overall, row_number() over (partition by site order by doc_id desc) as r from leveled),
g as (select site, (sum(overall) filter (r <= 10))::bigint as late, count(*) filter (r <= 10) as n_late, (sum(overall) filter (r > 10))::bigint as early, count(*) filter (r > 10) as n_early from r where r <= 20 group by site)
select *, case when n_late < 10 or n_early = 0 then '数据不足' when late * n_early - early * n_late > n_late * n_early * 500 then '上升' when late * n_early - early * n_late < -n_late * n_early * 500 then '下降' else '稳定' end as trend from g""")
def w4_quality_trend(spark, sf_dir):
    return quality.quality_trend(_scored(spark, sf_dir), "site", "doc_id")


REVISIONS = f"""rev as (select doc_id as seq, source as site, source || '/' || (doc_id % 20) as url, sha256(regexp_replace(coalesce(text, ''), '{WS}+', '', 'g')) as fp from documents),
st as (select *, lag(fp) over (partition by site, url order by seq) as before from rev), ch as (select seq, site, url, fp, case when before is null then 'created' when before <> fp then 'modified' else 'unchanged' end as status from st)"""


@query(f"with {REVISIONS} select seq, site, url, fp, status from ch")
def w2_change_status(spark, sf_dir):
    return dedup.change_status(revisions(spark, sf_dir)).select("seq", "site", "url", "fp", "status")


@query(f"with {REVISIONS} select seq, site, url, fp, status from (select *, row_number() over (partition by site, fp order by seq) as n from ch where status <> 'unchanged') where n = 1")
def w3_content_updates(spark, sf_dir):
    return dedup.content_updates(revisions(spark, sf_dir)).select("seq", "site", "url", "fp", "status")


@query(f"with {ARTICLES} select doc_id, site, key from (select doc_id, site, md5(concat_ws('|', site, lang, publish_date)) as key, row_number() over (partition by site, lang, publish_date order by doc_id) as n from articles) where n = 1")
def w1_keep_first(spark, sf_dir):
    c = F.col
    a = articles(spark, sf_dir).select("doc_id", "site", fn.item_fingerprint(c("site"), c("lang"), c("publish_date")).alias("key"))
    return dedup.keep_first(a, ["key"], "doc_id").select("doc_id", "site", "key")


@query("select event_id, user_id, ts from (select event_id, user_id, ts, row_number() over (partition by user_id order by event_id desc) as n from events) where n <= 5")
def w7_latest_versions(spark, sf_dir):
    return dedup.latest(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "user_id", "event_id", 5)


HITS = ARTICLES + f""", words as (select * from (values {", ".join(f"('{c}', '{w}')" for c, ws in WORDS.items() for w in ws)}) t(category, keyword)),
hits as (select doc_id, publish_date, category, keyword from articles join words on contains(lower(coalesce(content, '')), lower(keyword)))"""


def _hits(spark, sf_dir):
    a = articles(spark, sf_dir).select("doc_id", "publish_date", "content")
    return analysis.keyword_hits(a, F.col("content"), WORDS).select("doc_id", "publish_date", "category", "keyword")


@query(f"with {HITS} select doc_id, category, keyword from hits")
def j7_keyword_hits(spark, sf_dir):
    return _hits(spark, sf_dir).select("doc_id", "category", "keyword")


@query(f"with {ARTICLES} select publish_date as day, count(*) as n from articles group by 1")
def a1_daily_counts(spark, sf_dir):
    return analysis.daily_counts(articles(spark, sf_dir))


@query(f"with {HITS} select publish_date as day, category, count(*) as n from hits group by all")
def a2_category_by_day(spark, sf_dir):
    return analysis.category_by_day(_hits(spark, sf_dir))


@query(f"with {HITS} select category, keyword, count(*) as n from hits group by all")
def a3_keyword_counts(spark, sf_dir):
    return _hits(spark, sf_dir).groupBy("category", "keyword").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {HITS}, places as (select * from (values {", ".join(f"('{p}')" for p in PLACES)}) t(place)) select place, category, count(*) as n
from articles a join places on contains(a.content, place) join hits h on a.doc_id = h.doc_id group by all""")
def a4_place_by_category(spark, sf_dir):
    a = articles(spark, sf_dir).select("doc_id", "content")
    both = analysis.keyword_hits(analysis.place_hits(a, F.col("content"), PLACES), F.col("content"), WORDS)
    return both.groupBy("place", "category").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {HITS}, m as (select *, doc_id in (select doc_id from hits) as hit from articles)
select count(*) as total, count(*) filter (title <> '') as with_title, count(*) filter (content <> '') as with_content, count(*) filter (publish_date <> '') as with_date, count(*) filter (hit) as with_keywords,
coalesce(1000 * sum(length(title)) filter (title <> '') // count(*) filter (title <> ''), 0)::bigint as title_milli, coalesce(1000 * sum(length(content)) filter (content <> '') // count(*) filter (content <> ''), 0)::bigint as content_milli,
coalesce(1000000 * count(*) filter (hit) // count(*), 0) as relevance_ppm, case when 1000000 * count(*) filter (hit) // count(*) > 800000 then 'high' when 1000000 * count(*) filter (hit) // count(*) > 500000 then 'medium' else 'low' end as insight from m""")
def a5_a8_content_profile(spark, sf_dir):
    some = fn.contains_any(F.lower("content"), [w.lower() for ws in WORDS.values() for w in ws])
    return analysis.content_profile(articles(spark, sf_dir), some).withColumn("insight", analysis.insight(F.col("relevance_ppm")))


@query(f"with {HITS} select keyword, n from (select keyword, count(*) as n from hits group by 1) order by n desc, keyword limit 5")
def a6_top_keywords(spark, sf_dir):
    return analysis.top_k(_hits(spark, sf_dir).groupBy("keyword").agg(F.count(F.lit(1)).alias("n")), "n", "keyword", 5)


@query("select count(*) as n_groups, coalesce(sum(n), 0)::bigint as n_rows from (select url, count(*) as n from (select source || '/' || (doc_id % 997) as url from documents) group by 1 having count(*) > 1)")
def a13_duplicate_urls(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.concat("source", F.lit("/"), (F.col("doc_id") % 997).cast("string")).alias("url"))
    return analysis.duplicate_groups(d, "url")


PERF = "count(*) as total, count(*) filter (status = 'completed') as completed, count(*) filter (status = 'failed') as failed, sum(duration) as duration, sum(items)::bigint as items, sum(pages)::bigint as pages, 1000000 * count(*) filter (status = 'completed') // count(*) as success_ppm, sum(duration)::double / count(*) as avg_duration"


@query(f"with {TASKS} select {PERF} from tasks")
def a15_task_performance(spark, sf_dir):
    return ops.task_performance(task_metrics(spark, sf_dir))


@query(f"with {TASKS}, f as (select timestamp '2024-01-05 00:00:00' + to_hours(unnest(range(48))) as h) select strftime(h, '%Y-%m-%d %H:%M') as hour, count(task_id) as total, count(*) filter (status = 'completed') as completed, count(*) filter (status = 'failed') as failed, coalesce(sum(items), 0)::bigint as items, coalesce(sum(duration), 0) as duration, coalesce((select string_agg(w, ',' order by k) from (select worker_id as k, worker_id || ':' || count(*) as w from tasks t where date_trunc('hour', t.start_time) = h group by worker_id)), '') as workers from f left join tasks on date_trunc('hour', start_time) = h group by h")
def a16_hourly_stats(spark, sf_dir):
    found = ops.hourly_stats(task_metrics(spark, sf_dir), "2024-01-05 00:00:00", 48)
    return found.withColumn("workers", F.array_join(F.transform(F.map_entries("workers"), lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string"))), ","))


@query(f"with {TASKS} select worker_id, {PERF} from tasks group by worker_id")
def a17_worker_performance(spark, sf_dir):
    return ops.task_performance(task_metrics(spark, sf_dir), "worker_id")


@query(f"with {TASKS} select spider, site, status, count(*) as n, {', '.join(f'count(*) filter (duration * 10 <= {b}) as le_{b}' for b in ops.LATENCY_BOUNDS)} from tasks group by all")
def a23_request_histogram(spark, sf_dir):
    return ops.request_histogram(task_metrics(spark, sf_dir))


@query(f"with {TASKS} select spider, site, count(*) as total, count(*) filter (status = 'completed') as completed from tasks group by all having count(*) filter (status = 'completed') * 100 < count(*) * 85")
def a24_failing_groups(spark, sf_dir):
    return ops.failing_groups(task_metrics(spark, sf_dir))


@query(f"""with {TASKS}, h as (select *, items >= 20 as hot, lag(items >= 20) over w as was from tasks window w as (partition by worker_id order by start_time, task_id)),
i as (select *, sum(case when was is null or not was then 1 else 0 end) over (partition by worker_id order by start_time, task_id) as g from h)
select worker_id, min(start_time)::timestamp as first, max(start_time)::timestamp as last, count(*) as n from i where hot group by worker_id, g having max(start_time) - min(start_time) >= interval 60 minutes""")
def w8_sustained(spark, sf_dir):
    runs = ops.sustained(task_metrics(spark, sf_dir).select("worker_id", "task_id", "items", "start_time"), "worker_id", "start_time", "items", F.lit(20), 60, "task_id")
    return runs.select("worker_id", F.col("first").cast("timestamp_ntz").alias("first"), F.col("last").cast("timestamp_ntz").alias("last"), "n")


@query(f"""with {HITS}, c as (select keyword, count(*) filter (publish_date between '2024-01-20' and '2024-01-30') as now, count(*) filter (publish_date >= '2024-01-15' and publish_date < '2024-01-20') as was from hits group by 1),
k as (select *, case when was > 0 and now > was * 2 then 'surge' when was = 0 and now >= 5 then 'new' end as kind from c) select * from k where kind is not null""")
def g10_keyword_surges(spark, sf_dir):
    return analysis.keyword_surges(_hits(spark, sf_dir), "2024-01-20", "2024-01-30", "2024-01-15", factor=2)


@query("""with d as (select strftime(ts, '%Y-%m-%d') as day, count(*) as n from events group by 1), w as (select day, n, sum(n) over o as before, count(*) over o as days from d window o as (order by day rows between unbounded preceding and 1 preceding))
select day, n from w where days + 1 >= 3 and n * days * 100 > before * 103""")
def w6_spikes(spark, sf_dir):
    daily = table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return analysis.spikes(daily, factor=1.03)


@query("""with h as (select page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) as host from pages), s as (select * from (values ('example.org', 'org'), ('spam-farm.example.org', 'spam'), ('example.com', 'com')) t(domain, site))
select page_id, host, (select site from s where ends_with('.' || host, '.' || domain) order by length(domain) desc limit 1) as site from h""")
def j2_site_of_host(spark, sf_dir):
    sites = spark.createDataFrame([("example.org", "org"), ("spam-farm.example.org", "spam"), ("example.com", "com")], "domain string, site string")
    pages = table(spark, sf_dir, "pages").select("page_id", fn.url_host(F.col("url")).alias("host"))
    return joins.site_of_host(pages, sites)


@query("select doc_id, source from documents where doc_id not in (select doc_id from labels)")
def j5_unseen(spark, sf_dir):
    return joins.unseen(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


@query("select d.doc_id, coalesce(case when d.doc_id % 3 > 0 then d.lang end, case when l.quality = 1 then 'good' else 'poor' end, case when l.doc_id is null then null end) as mark from documents d left join (select doc_id, max(quality) as quality from labels group by 1) l on d.doc_id = l.doc_id where d.doc_id % 3 > 0 or l.doc_id is not null union all select doc_id, null from documents where doc_id % 3 = 0 and doc_id not in (select doc_id from labels)")
def j4_carried(spark, sf_dir):
    details = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("lang")).alias("mark"))
    rows = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.when(F.max("quality") == 1, "good").otherwise("poor").alias("mark"))
    return joins.carry(details, rows, "doc_id", "mark")


@query(f"with {ARTICLES} select doc_id, site, publish_date from articles where publish_date between '2024-01-10' and '2024-01-12'")
def s3_date_range(spark, sf_dir):
    return between_dates(articles(spark, sf_dir), "2024-01-10", "2024-01-12").select("doc_id", "site", "publish_date")


@query("""select 'http://x/' || doc_id as url, case when doc_id % 3 = 0 then 'about ' || lang else source end as title, lang as source, case when doc_id % 2 = 0 then '2024-01-02' else '2024-1-2 x' end as day from documents where doc_id % 7 > 0 and doc_id % 11 > 0""")
def s10_search_hits(spark, sf_dir):
    k = F.col("doc_id")
    hit = F.struct(
        F.concat(F.lit("http://x/"), k.cast("string")).alias("url"), F.when(k % 3 == 0, "").otherwise(F.col("source")).alias("name"), F.concat(F.lit("about "), "lang").alias("snippet"),
        F.col("lang").alias("siteName"), F.when(k % 2 == 0, "2024-01-02T03:04:05Z").otherwise("2024/1/2 x").alias("datePublished"),
    )
    answer = F.to_json(F.struct(F.when(k % 7 == 0, 500).otherwise(200).alias("code"), F.struct(F.struct(F.array(hit).alias("value")).alias("webPages")).alias("data")))
    bodies = table(spark, sf_dir, "documents").select(F.when(k % 11 == 0, "not json").otherwise(answer).alias("body"))
    return search_hits(bodies).select("url", "title", "source", fn.api_date(F.col("published")).alias("day"))


STATUSES = (200, 200, 200, 429, 403, 412, 503, 451)


def _detector_sql(name: str) -> str:
    out = " + ".join(f"(case when regexp_matches(h, '(?i){p}') then {tenths} else 0 end)" for tenths, ps in antibot.DETECTORS[name][1] for p in ps)
    for code, tenths in {"rate_limit": antibot.STATUS_TENTHS, "ip_block": antibot.BLOCK_STATUS_TENTHS}.get(name, {}).items():
        out += f" + (case when status = {code} then {tenths} else 0 end)"
    out += {
        "js_challenge": " + (case when length(h) < 1000 and len(regexp_extract_all(h, '<script')) > 3 then 4 else 0 end)", "user_agent_check": " + (case when contains(h, 'upgrade') and contains(h, 'browser') then 3 else 0 end)",
        "cookie_check": " + (case when contains(lower(cookie), 'test') then 3 else 0 end)", "rate_limit": " + (case when retry <> '' then 5 else 0 end)", "honeypot": " + (case when contains(url, 'robots.txt') and contains(h, 'disallow') then 2 else 0 end)",
    }.get(name, "")
    return f"least(10, {out}) as {name}"


@query(
    f"""with p as (select page_id, lower(html || case when page_id % 6 = 0 then '<p>Please enable cookies, DISALLOW: browser' || chr(13) || 'upgrade <a style="display: none" class="hidden">' else '' end) as h, ([{', '.join(map(str, STATUSES))}])[1 + (page_id % {len(STATUSES)})::int] as status,
([null, 'a=1', 'TEST=1'])[1 + (page_id % 3)::int] as cookie, ([null, '', '30', null, null])[1 + (page_id % 5)::int] as retry, case when page_id % 4 = 0 then 'http://x/robots.txt' else url end as url from pages),
t as (select page_id, {', '.join(map(_detector_sql, antibot.DETECTORS))} from p), d as (select *, list_filter([{', '.join(f"case when {n} > {least} then '{n}' end" for n, (least, _) in antibot.DETECTORS.items())}], lambda x: x is not null) as d from t)
select * exclude (d), array_to_string(d, ',') as detected, array_to_string(list_transform(d, lambda x: map([{', '.join(f"'{x}'" for x in antibot.ACTIONS)}], [{', '.join(f"'{x}'" for x in antibot.ACTIONS.values())}])[x]), ',') as actions,
array_to_string(list_filter([case when len(d) > 3 then '{antibot.SUGGESTIONS[0]}' end, case when list_has_all(d, ['captcha', 'js_challenge']) then '{antibot.SUGGESTIONS[1]}' end, case when list_has_all(d, ['rate_limit', 'ip_block']) then '{antibot.SUGGESTIONS[2]}' end], lambda x: x is not null), ';') as advice from d"""
)
def g7_g8_antibot(spark, sf_dir):
    k = F.col("page_id")
    more = F.when(k % 6 == 0, '<p>Please enable cookies, DISALLOW: browser\rupgrade <a style="display: none" class="hidden">').otherwise("")
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.concat("html", more).alias("html"), F.get(F.array(*map(F.lit, STATUSES)), (k % len(STATUSES)).cast("int")).alias("status"), one_of("page_id", (None, "a=1", "TEST=1")).alias("set_cookie"),
        one_of("page_id", (None, "", "30", None, None)).alias("retry_after"), F.when(k % 4 == 0, "http://x/robots.txt").otherwise(F.col("url")).alias("url"),
    )
    d = F.col("detected")
    return antibot.detect(pages).select("page_id", *antibot.DETECTORS, F.array_join(d, ",").alias("detected"), F.array_join(antibot.actions(d), ",").alias("actions"), F.array_join(antibot.suggestions(d), ";").alias("advice"))


@query("""select s_suppkey as worker_id, ((s_suppkey % 12) * 10000000 + (s_suppkey % 97) * 500000 + (s_suppkey % 89) * 300000 + coalesce(100000000 * (s_suppkey % 5) // nullif(s_suppkey % 5 + s_suppkey % 11, 0), 0) + (case when s_suppkey % 2 = 0 then 0 else 1 end) * 50000000)::bigint as score
from supplier where s_suppkey % 12 < 10 and s_suppkey % 97 <= 90 and s_suppkey % 89 <= 90 and s_suppkey % 400 <= 300""")
def g2_worker_scores(spark, sf_dir):
    return ops.worker_scores(_workers(spark, sf_dir), F.array(F.lit("js"))).select("worker_id", F.col("score").cast("long").alias("score"))


def _workers(spark, sf_dir):
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        k.alias("worker_id"), (k % 12).alias("active"), (k % 97).alias("cpu"), (k % 89).alias("memory"), (k % 5).alias("failed"), (k % 11).alias("completed"), (k % 400).alias("heartbeat_age"),
        F.when(k % 2 == 0, F.array(F.lit("js"))).otherwise(F.array(F.lit("plain"))).alias("features"),
    )


@query("""select c_custkey as proxy_id, case when c_custkey % 8 = 0 then 0 else ((case when c_custkey * 37 % 12000 < 2000 then 400 when c_custkey * 37 % 12000 < 5000 then 300 when c_custkey * 37 % 12000 < 10000 then 200 else 100 end)
+ case c_mktsegment when 'BUILDING' then 300 when 'MACHINERY' then 250 when 'FURNITURE' then 150 when 'HOUSEHOLD' then 50 else 0 end + (c_custkey % 101) * 2 + (case when c_custkey % 4 = 0 then 100 when c_custkey % 4 < 3 then 50 else 0 end)) end::bigint as score from customer""")
def g3_proxy_scores(spark, sf_dir):
    k = F.col("c_custkey")
    kinds = {"BUILDING": "elite", "MACHINERY": "anonymous", "FURNITURE": "transparent", "HOUSEHOLD": "unknown"}
    kind = F.create_map(*[F.lit(x) for p in kinds.items() for x in p])[F.col("c_mktsegment")]
    return table(spark, sf_dir, "customer").select(k.alias("proxy_id"), ops.proxy_score(k * 37 % 12000, F.coalesce(kind, F.lit("other")), k % 101, k % 4, k % 8 > 0).cast("long").alias("score"))
