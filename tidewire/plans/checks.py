"""Registered queries over settings, configurations and distributions of keywords and places; each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import settings
from ..operators import analysis
from ..sources.tables import articles, table
from .queries import ARTICLES, PLACES, WORDS, query

#: Settings of one deployment for each document, made of its text, language and source; read by both Spark and DuckDB.
H = "md5(coalesce(text, ''))"
SETTINGS = {
    "ENVIRONMENT": "lang",
    "MONGODB_ROOT_USERNAME": "case when doc_id % 5 = 0 then '' else source end",
    "MONGODB_ROOT_PASSWORD": f"case doc_id % 4 when 0 then {H} when 1 then upper({H}) || lang || '!' when 2 then lang else '' end",
    "MONGODB_DATABASE": "case when doc_id % 7 > 0 then source end",
    "SECRET_KEY": f"case doc_id % 4 when 0 then 'your-' || {H} || {H} when 1 then {H} when 2 then {H} || 'change-this' else lang end",
    "API_TOKEN": H,
    "JWT_SECRET": f"case when doc_id % 3 > 0 then {H} || {H} end",
    "REDIS_PASSWORD": f"case when doc_id % 2 > 0 then {H} end",
    "MONGO_EXPRESS_PASSWORD": f"upper({H})",
    "MINIO_ROOT_PASSWORD": f"'Aa1!' || {H}",
    "CONCURRENT_REQUESTS": "cast(length(text) % 300 as string)",
    "DOWNLOAD_DELAY": "case when doc_id % 6 = 0 then lang else cast(length(text) % 20 as string) || '.5' end",
    "PROXY_POOL_SIZE": "cast(length(text) as string)",
    "REDIS_HOST": "case when doc_id % 8 = 0 then '' when doc_id % 8 < 4 then source end",
    "SMTP_HOST": "case when doc_id % 3 = 1 then source end",
    "SMTP_PORT": "case when doc_id % 6 = 1 then cast(length(text) as string) end",
    "SLACK_WEBHOOK_URL": f"case doc_id % 10 when 1 then 'https://hooks.slack.com/' || {H} when 6 then 'http://' || source end",
    "UNKNOWN_SETTING": "source",
}


def _settings_sql() -> str:
    v = lambda n: n if n in SETTINGS else "null::varchar"
    unset = lambda n: f"coalesce({v(n)}, '') = ''"
    rows = [("'error'", n, "'missing'", unset(n)) for n in settings.REQUIRED]
    for n in settings.PASSWORDS:
        tests = {"short": f"length({n}) < 8", "no_upper": f"not regexp_matches({n}, '\\p{{Lu}}')", "no_lower": f"not regexp_matches({n}, '\\p{{Ll}}')", "no_digit": f"not regexp_matches({n}, '\\p{{Nd}}')", "no_special": f"translate({n}, '{settings.SPECIAL}', '') = {n}"}
        weak = f"concat_ws(',', {', '.join(f'''case when {t} then '{name}' end''' for name, t in tests.items())})"
        rows += [("'warning'" if n in settings.MAY_BE_EMPTY else "'error'", n, "'empty'", unset(n)), ("'warning'", n, f"'weak: ' || {weak}", f"not {unset(n)} and {weak} <> ''")]
    for n in settings.KEYS:
        rows += [("'error'", n, "'empty'", unset(n)), ("'warning'", n, "'short'", f"length({n}) between 1 and 31"), ("'error'", n, "'default_value'", f"length({n}) >= 32 and ({n} like 'your-%' or contains({n}, 'change-this'))")]
    rows += [("'error'", n, "'incomplete'", unset(n)) for n in settings.STORE] + [("'error'", n, "'incomplete'", f"{v(n)} = ''") for n in settings.WITH_DEFAULTS]
    for n, (least, most) in settings.RANGES.items():
        number = f"try_cast({v(n)} as double)"
        rows += [("'warning'", n, "'unset'", unset(n)), ("'error'", n, "'not_a_number'", f"not {unset(n)} and {number} is null"), ("'warning'", n, "'out_of_range'", f"{number} not between {least} and {most}")]
    some = " or ".join(f"not {unset(n)}" for n in settings.MAIL)
    rows += [("'warning'", n, "'incomplete'", f"({some}) and {unset(n)}") for n in settings.MAIL]
    rows.append(("'warning'", settings.WEBHOOK, "'bad_url'", f"not {unset(settings.WEBHOOK)} and {settings.WEBHOOK} not like '{settings.WEBHOOK_START}%'"))
    wide = ", ".join(f"{x} as {n}" for n, x in SETTINGS.items())
    return f"with s as (select doc_id, {wide} from documents) " + " union all ".join(f"select doc_id, {level} as level, '{n}' as name, {problem} as problem from s where {where}" for level, n, problem, where in rows)


@query(_settings_sql())
def g11_v16_settings(spark, sf_dir):
    wide = table(spark, sf_dir, "documents").select("doc_id", *[F.expr(x).alias(n) for n, x in SETTINGS.items()])
    rows = wide.unpivot("doc_id", list(SETTINGS), "name", "value").where("value is not null")
    return settings.setting_problems(rows, "doc_id")


#: Sections by the digits of the text's length in base two; every fifth one lists its fields.
SECTIONS = (*settings.NEW_SECTIONS, *settings.OLD_SECTIONS)
CONFIG = " || ".join(
    ["'{\"lang\": \"' || lang || '\"'"]
    + [f"""case when (coalesce(length(text), 0) // {1 << i}) % 2 = {0 if s in ('site_info', 'target_pages') else 1} then ', "{s}": {{"of": "' || source || '"}}' else '' end""" for i, s in enumerate(SECTIONS[:-1])]
    + ["""case when doc_id % 5 = 0 then ', "fields": ["' || lang || '"]' when doc_id % 5 < 4 then ', "fields": {"title": {}}' else '' end""", "case when doc_id % 11 = 0 then '' else '}' end"]
)


def _lacking(sections) -> str:
    return f"array_to_string(list_filter([{', '.join(f'{chr(39)}{s}{chr(39)}' for s in sections)}], lambda s: not list_contains(k, s)), ',')"


@query(f"""with c as (select doc_id, {CONFIG} as j from documents), k as (select doc_id, case when json_valid(j) then json_keys(j) else [] end as k, case when json_valid(j) then json_type(j, '$.fields') end as t from c),
f as (select *, case when list_contains(k, 'site_info') and list_contains(k, 'target_pages') then 'new' when t = 'OBJECT' then 'old' else 'unknown' end as format from k),
m as (select doc_id, format, case format when 'new' then {_lacking(settings.NEW_SECTIONS)} when 'old' then {_lacking(settings.OLD_SECTIONS)} end as missing from f)
select doc_id, format, missing, coalesce(missing = '', false) as valid from m""")
def v16_config_formats(spark, sf_dir):
    configs = table(spark, sf_dir, "documents").select("doc_id", F.expr(CONFIG.replace("//", "div")).alias("json"))
    return settings.checked_configs(configs).select("doc_id", "format", F.array_join("missing", ",").alias("missing"), "valid")


LISTED = f"""words as (select * from (values {", ".join(f"('{c}', '{w}')" for c, ws in WORDS.items() for w in ws)}) t(category, keyword)), places as (select * from (values {", ".join(f"('{p}')" for p in PLACES)}) t(place)),
a as (select doc_id, case when doc_id % 4 > 0 then publish_date end as publish_date, crawl_time, title, coalesce(title, '') || coalesce(content, '') as whole from articles)"""
STATED = "coalesce('【' || publish_date || '】', substr(crawl_time, 1, 10))"


@query(f"""with {ARTICLES}, {LISTED}, d as (select regexp_replace({STATED}, '[【】]', '', 'g') as day, title from a), s as (select * from d where day is not null)
select day, null as category, count(*) as n from s group by day union all select day, category, count(*) as n from s join words on contains(lower(coalesce(title, '')), lower(keyword)) group by day, category""")
def a1_a2_title_trends(spark, sf_dir):
    a = articles(spark, sf_dir).withColumn("publish_date", F.when(F.col("doc_id") % 4 > 0, F.concat(F.lit("【"), "publish_date", F.lit("】"))))
    return analysis.trends(a, [F.col("publish_date"), F.substring("crawl_time", 1, 10)], [F.col("title")], WORDS)


@query(f"""with {ARTICLES}, {LISTED}, h as (select category, keyword from a join words on contains(lower(whole), lower(keyword)))
select 'category' as kind, category as name, count(*) as n from h group by category union all select 'keyword', keyword, count(*) from h group by keyword""")
def a3_disease_distribution(spark, sf_dir):
    return analysis.distribution(articles(spark, sf_dir), [F.col("title"), F.col("content")], WORDS)


@query(f"""with {ARTICLES}, {LISTED}, p as (select * from a join places on contains(whole, place))
select place, null as category, count(*) as n from p group by place union all select place, category, count(*) from p join words on contains(lower(whole), lower(keyword)) group by place, category""")
def a4_place_distribution(spark, sf_dir):
    return analysis.place_distribution(articles(spark, sf_dir), [F.col("title"), F.col("content")], PLACES, WORDS)


@query("with c as (select lang, count(*) as n from documents group by lang), t as (select sum(n)::bigint as total from c) select lang, n, total from c, t where n * 100 > total * 20")
def g10_concentrated(spark, sf_dir):
    counts = table(spark, sf_dir, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return analysis.concentrated(counts, "lang", 20)
