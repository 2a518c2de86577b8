"""Text, date, number and URL functions as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space in the sense of Unicode; the JVM's \s knows ASCII only.
WS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
WORD = r"[\p{L}\p{N}_]"
CJK = r"[\u4e00-\u9fff]"

# Fixed values.
ENTITIES = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "))
REGION_NAMES = (("北京市", "北京"), ("上海市", "上海"), ("天津市", "天津"), ("重庆市", "重庆"), ("香港特别行政区", "香港"), ("澳门特别行政区", "澳门"), ("台湾省", "台湾"))
REGION_SUFFIXES = ("省", "市", "区", "县", "自治区", "特别行政区")
PROVINCES = ("北京", "上海", "广东", "浙江", "江苏", "山东", "河南", "湖北", "湖南", "四川")
CATEGORIES = (("疫情播报", ("疫情", "传染病", "病例", "确诊")), ("政策文件", ("政策", "通知", "公告", "规定")), ("新闻动态", ("新闻", "动态", "会议")), ("统计数据", ("统计", "数据", "报告")))
TAGS = (("新冠疫情", ("新冠", "covid", "肺炎")), ("疫苗接种", ("疫苗", "接种")), ("疫情防控", ("防控", "防疫")), ("健康医疗", ("健康", "医疗", "卫生")), ("医疗服务", ("医院", "诊疗")))
CASE_PATTERNS = {
    "confirmed": (r"确诊病例(\d+)例", r"确诊(\d+)例", r"新增确诊病例(\d+)例"),
    "death": (r"死亡病例(\d+)例", r"死亡(\d+)例", r"新增死亡病例(\d+)例"),
    "recovered": (r"治愈出院病例(\d+)例", r"治愈(\d+)例", r"出院病例(\d+)例"),
}
SOURCE_NOISE = (r"发布时间\s*[:：].*", r"发布\s*时间\s*[:：].*", r"浏览次数.*", r"分享到.*", r"微信\s*微博.*", r"作者\s*[:：].*", r"审稿\s*[:：].*", r"来源\s*[:：]\s*", r"新闻来源\s*[:：]\s*", r"发布时间为.*")
SOURCE_NAMES = (
    ("内蒙古自治区卫生健康委员会", "内蒙古自治区卫生健康委员会"), ("职业卫生所-市疾控中心", "职业卫生所-市疾控中心"), ("中国新闻网", "中国新闻网"),
    ("省卫生健康委网站|省卫健委网站", "省卫生健康委网站"), ("卫生健康委|卫健委", "卫生健康委"), ("疾控中心|疾控|CDC", "疾控中心"),
)
SOURCE_ENDS = (r"\s+作者.*", r"\s+审稿.*", r"\s+发布时间.*", r"\s+来源.*", r"\s+分享.*")


#: A bare CSS rule left in text, with the white space before it.
CSS_RULE = rf"(?:^(?:{WS}|[\ufeff\u200b])*|{WS})[.#][\p{{L}}\p{{N}}_\-]+[^{{}}]{{0,80}}\{{[^{{}}]*\}}"


def strip(col: Column) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(col, f"^{WS}+|{WS}+$", "")


def has_text(col: Column) -> Column:
    """Whether some character is no white space; looks no further than the first one."""
    return col.rlike(f"[^{WS[1:-1]}]")


def first_match(col: Column, pattern: str, group: int = 1) -> Column:
    """Null instead of an empty string if nothing matches."""
    return F.nullif(F.regexp_extract(col, pattern, group), F.lit(""))


def collapse(col: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.btrim(F.regexp_replace(col, f"{WS}+", " "))


def contains_any(col: Column, words: Sequence[str]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | F.contains(col, F.lit(w))
    return found


def clean_html(col: Column) -> Column:
    out = F.coalesce(col, F.lit(""))
    for block in (r"(?is)<script[^>]*>.*?</script>", r"(?is)<style[^>]*>.*?</style>", r"(?s)<!--.*?-->", r"<[^>]+>"):
        out = F.regexp_replace(out, block, " ")
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    # most texts have no brace
    return collapse(F.when(F.contains(out, F.lit("{")), F.regexp_replace(out, CSS_RULE, " ")).otherwise(out))


def clean_text(col: Column, min_length: int = 0, max_length: int | None = None, remove_special: bool = False) -> Column:
    out = clean_html(col)
    if remove_special:
        out = F.regexp_replace(out, rf"[^\p{{L}}\p{{N}}_{WS[1:-1]}]", "")
    if max_length:
        out = F.substring(out, 1, max_length)
    return F.when(col.isNotNull() & (F.length(out) >= max(1, min_length)), out)


def clean_number(col: Column, low: float | None = None, high: float | None = None) -> Column:
    value = first_match(F.regexp_replace(col, "[,，]", ""), r"(-?\d+\.?\d*)").try_cast("double")
    if low is not None:
        value = F.when(value >= low, value)
    return F.when(value <= high, value) if high is not None else value


def clean_integer(col: Column, low: float | None = None, high: float | None = None) -> Column:
    """As ``clean_number``, cut to a whole number; null beyond 64 bits."""
    return clean_number(col, low, high).try_cast("long")


def clean_date(col: Column) -> Column:
    """yyyy-MM-dd from ISO, dotted, compact and Chinese dates; null for partial dates, which would depend on the clock."""
    t = F.regexp_replace(F.regexp_replace(col, "[年月]", "-"), "日", "")
    t = F.regexp_replace(t, r"[^\d\-\s:.+TZtz]", "")
    parts = F.regexp_extract(t, r"(\d{4})[-.](\d{1,2})[-.](\d{1,2})", 0)
    compact = F.regexp_extract(t, r"(?:^|\D)(\d{4})(\d{2})(\d{2})(?:\D|$)", 0)
    dashed = F.regexp_replace(parts, r"\.", "-")
    digits = F.regexp_replace(compact, r"\D", "")
    return F.date_format(F.coalesce(F.try_to_date(F.nullif(dashed, F.lit("")), "yyyy-M-d"), F.try_to_date(F.nullif(digits, F.lit("")), "yyyyMMdd")), "yyyy-MM-dd")


def clean_region(col: Column) -> Column:
    out = strip(col)
    for name, short in REGION_NAMES:
        out = F.replace(out, F.lit(name), F.lit(short))
    for end in REGION_SUFFIXES:
        # only if something else stands before it
        out = F.regexp_replace(out, f"(?<=.){end}$", "")
    return out


def clean_url(col: Column, remove_params: bool = False) -> Column:
    t = strip(col)
    return F.when(t.rlike(r'^https?://[^\s<>"{}|\\^`\[\]]+'), F.substring_index(t, "?", 1) if remove_params else t)


def clean_email(col: Column) -> Column:
    t = F.lower(strip(col))
    return F.when(t.rlike(r"^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$"), t)


def clean_phone(col: Column) -> Column:
    d = F.regexp_replace(col, r"[^0-9]", "")
    return F.when(((F.length(d) == 11) & F.startswith(d, F.lit("1"))) | (F.length(d) >= 7), d)


def clean_source(col: Column, allowed: Sequence[str] = (), names: Mapping[str, str] | None = None) -> Column:
    plain = clean_html(col)
    stated = first_match(plain, r"(?:新闻来源|来源|发布机构)\s*[:：]\s*(\S+)")
    rest = plain
    for noise in SOURCE_NOISE:
        rest = F.regexp_replace(rest, f"(?i){noise}", "")
    rest = strip(rest)
    known = [F.when(F.contains(rest, F.lit(a)), F.lit(a)) for a in allowed]
    known += [F.when(rest.rlike(p), F.lit(n)) for p, n in (*SOURCE_NAMES, *(names or {}).items())]
    short = rest
    for end in SOURCE_ENDS:
        short = F.regexp_replace(short, end, "")
    short = strip(short)
    return F.when(col.isNotNull() & (stated.isNotNull() | (rest != "")), F.coalesce(stated, *known, F.when(F.length(short).between(1, 30), short)))


def title_slug(col: Column) -> Column:
    out = strip(F.regexp_replace(col, r"<[^>]+>", ""))
    for prefix in ("tdclasshanggao", "class", "style"):
        out = F.regexp_replace(out, f"(?i)^{prefix}{WORD}+", "")
    out = F.coalesce(first_match(out, f"(?s)({CJK}.*)$"), out)
    out = F.regexp_replace(out, rf"[^\p{{L}}\p{{N}}_\-]", "")
    return F.substring(F.regexp_replace(out, "^-+|-+$", ""), 1, 60)


def article_id(url: Column) -> Column:
    return F.when(url != "", F.substring(F.sha1(url), 1, 16))


def content_fingerprint(content: Column) -> Column:
    return F.sha2(F.regexp_replace(F.coalesce(content, F.lit("")), f"{WS}+", ""), 256)


def item_fingerprint(*parts: Column) -> Column:
    """md5 of the parts joined by bars; a null part reads None."""
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts]))


def cjk_count(col: Column) -> Column:
    return F.regexp_count(F.coalesce(col, F.lit("")), F.lit(CJK)).cast("long")


def first_numbers(col: Column, n: int = 10) -> Column:
    return F.slice(F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(r"(\d+)"), F.lit(1)), 1, n)


def category_of(title: Column) -> Column:
    low = F.lower(F.coalesce(title, F.lit("")))
    return F.coalesce(*[F.when(contains_any(low, words), F.lit(name)) for name, words in CATEGORIES], F.lit("其他"))


def tags_of(content: Column) -> Column:
    low = F.lower(F.coalesce(content, F.lit("")))
    return F.array_compact(F.array(*[F.when(contains_any(low, words), F.lit(name)) for name, words in TAGS]))


def region_of(content: Column) -> Column:
    return F.coalesce(*[F.when(F.contains(content, F.lit(p)), F.lit(p)) for p in PROVINCES], F.lit("全国"))


def case_count(content: Column, kind: str) -> Column:
    return F.coalesce(*[first_match(content, p).try_cast("long") for p in CASE_PATTERNS[kind]], F.lit(0).cast("long"))


def digits_number(col: Column) -> Column:
    """All digits of the text as one number; 0 without any."""
    return F.coalesce(F.nullif(F.regexp_replace(col, "[^0-9]", ""), F.lit("")).try_cast("long"), F.lit(0).cast("long"))


def loader_date(col: Column) -> Column:
    ymd = F.try_to_date(first_match(col, r"(\d{4}-\d{1,2}-\d{1,2})"), "yyyy-M-d")
    cn = F.try_to_date(F.regexp_replace(first_match(col, r"(\d{4}年\d{1,2}月\d{1,2})日"), "[年月]", "-"), "yyyy-M-d")
    mdy = F.try_to_date(first_match(col, r"(\d{2}/\d{1,2}/\d{4})"), "M/d/yyyy")
    return F.date_format(F.coalesce(ymd, cn, mdy), "yyyy-MM-dd")


def api_date(col: Column) -> Column:
    """The date of an ISO time (compact ones too); else the first ten characters of what begins like a date, with dashes; else the text."""
    ten = F.substring(col, 1, 10)
    compact = F.date_format(F.try_to_date(first_match(col, r"^(\d{8})(?:T.*)?$"), "yyyyMMdd"), "yyyy-MM-dd")
    return F.coalesce(compact, F.when(F.substring(col, 5, 1).isin("-", "/", "."), F.replace(ten, F.lit("/"), F.lit("-"))).otherwise(col))


def tight_dashes(col: Column) -> Column:
    return strip(F.regexp_replace(col, f"{WS}*-{WS}*", "-"))


def date_in_text(col: Column) -> Column:
    return tight_dashes(F.coalesce(first_match(col, r"(\d{4}[-/年]\d{1,2}[-/月]\d{1,2}日?)"), col))


def next_page(url: Column) -> Column:
    """The URL of the list page that follows; null for other URLs."""
    page = first_match(url, r"list_(\d+)\.shtml").try_cast("long")
    here, there = (F.concat(F.lit("list_"), p.cast("string"), F.lit(".shtml")) for p in (page, page + 1))
    return F.when(F.endswith(url, F.lit("list.shtml")), F.replace(url, F.lit("list.shtml"), F.lit("list_2.shtml"))).when(F.endswith(url, F.lit(".shtml")) & page.isNotNull(), F.replace(url, here, there))


def loader_text(col: Column) -> Column:
    """Without tags, white space collapsed."""
    return collapse(F.regexp_replace(col, r"<[^>]+>", ""))


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def url_extension(url: Column) -> Column:
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))


def page_type(url: Column, n_items: Column | None = None, content: Column | None = None) -> Column:
    """By the URL, else by the number of list rows and the length of the content."""
    u = F.lower(F.coalesce(url, F.lit("")))
    out = F.when(u.rlike("list|index|category|列表"), "list_page").when(u.rlike(r"/\d+\.s?html$|detail|article"), "detail_page")
    if n_items is not None:
        out = out.when(n_items >= 3, "list_page")
    if content is not None:
        out = out.when(F.length(strip(content)) > 50, "detail_page")
    return out.otherwise("unknown_page")


def safe_name(col: Column) -> Column:
    return F.btrim(F.regexp_replace(col, r"[^\p{L}\p{N}\-_.]", "_"), F.lit("._"))


def title_from_html(html: Column) -> Column:
    return strip(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))
