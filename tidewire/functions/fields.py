"""Functions over the fields of crawled records: names, fallbacks, routing, media, paths; and the registry of cleaners."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as fn

# Fixed values.
RENAMES = {"source_url": "url", "page_title": "title", "page_content": "content", "publish_time": "publish_date", "create_time": "crawl_timestamp"}
HTML_SOURCES = ("raw_html", "content", "article_content", "full_content", "text")
REQUIRED = {"article": ("url", "title", "crawl_time"), "epidemic": ("source_url", "title", "crawl_time"), "policy": ("url", "title", "crawl_time"), "statistics": ("source_url", "crawl_time")}
EPIDEMIC_WORDS = ("疫情", "传染病", "病例", "确诊", "死亡", "治愈", "新冠", "covid", "肺炎", "感染", "防控")
FILE_EXTENSIONS = ("pdf", "doc", "docx", "xls", "xlsx", "ppt", "pptx", "csv", "txt", "zip", "rar", "7z", "gz", "tar", "xml", "json")
CONTENT_TYPES = {
    "application/pdf": "pdf", "application/msword": "doc", "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "docx", "application/vnd.ms-excel": "xls",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": "xlsx", "application/vnd.ms-powerpoint": "ppt", "application/vnd.openxmlformats-officedocument.presentationml.presentation": "pptx",
    "text/csv": "csv", "text/plain": "txt", "application/zip": "zip", "application/x-rar-compressed": "rar", "application/x-7z-compressed": "7z", "application/gzip": "gz", "application/x-tar": "tar",
    "application/xml": "xml", "text/xml": "xml", "application/json": "json",
}
NOISE = ("分享到", "来源：", "责任编辑：")
MEDIA_FIELDS = ("image_urls", "file_urls", "images", "files", "cover_image")
FIELD_KINDS = {"publish_date": "date", "pub_date": "date", "date": "date", "source": "source", "news_source": "source", "来源": "source", "url": "url", "link": "url"}

#: Cleaner name -> Column -> Column; add to it to make a kind known.
CLEANERS: dict[str, Callable[[Column], Column]] = {
    "text": fn.clean_text, "number": fn.clean_number, "integer": fn.clean_integer, "date": fn.clean_date, "region": fn.clean_region, "url": fn.clean_url,
    "email": fn.clean_email, "phone": fn.clean_phone, "source": fn.clean_source, "html": fn.clean_html,
}


def renamed(df: DataFrame, names: Mapping[str, str] = RENAMES) -> DataFrame:
    """Old names give way to new ones; where both are columns, the new one's null is filled."""
    for old, new in names.items():
        if old in df.columns:
            df = df.withColumn(new, F.coalesce(new, old)).drop(old) if new in df.columns else df.withColumnRenamed(old, new)
    return df


def joined_parts(col: Column) -> Column:
    """The parts of a list, stripped, without blanks, joined by spaces; null for none."""
    parts = F.filter(F.transform(col, fn.strip), lambda x: x != "")
    return F.nullif(F.array_join(parts, " "), F.lit(""))


def first_filled(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def restored(clean: Column, before: Column) -> Column:
    """The cleaned value, or what it was before if nothing is left of it."""
    return F.coalesce(F.nullif(clean, F.lit("")), before)


def drop_reason(kind: Column, columns: Sequence[str]) -> Column:
    """Why a record goes: the first required field of its kind that is empty, or a URL that is no web address; null if it stays."""
    empty = lambda f: F.coalesce(F.col(f), F.lit("")) == "" if f in columns else F.lit(True)
    out = F.lit(None).cast("string")
    for name, fields in REQUIRED.items():
        missing = F.coalesce(*[F.when(empty(f), F.lit(f"missing_{f}")) for f in fields])
        out = F.when(kind == name, missing).otherwise(out)
    out = F.when(~F.coalesce(kind.isin(list(REQUIRED)), F.lit(False)), F.when(empty("crawl_time"), F.lit("missing_crawl_time"))).otherwise(out)
    url = first_filled(F.col("url"), F.col("source_url"))
    return F.coalesce(out, F.when(url.isNotNull() & ~url.rlike("^https?://"), F.lit("bad_url")))


def drop_counts(df: DataFrame, reason: str = "drop_reason") -> DataFrame:
    """How many records go for each reason, and how many stay (kept)."""
    return df.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def is_epidemic(title: Column, content: Column, words: Sequence[str] = EPIDEMIC_WORDS) -> Column:
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    return fn.contains_any(low(title), words) | fn.contains_any(low(content), words)


def direct_file(url: Column, content_type: Column) -> Column:
    """The file kind by extension or, else, content type; null for pages."""
    ext = fn.url_extension(url)
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    out = F.when(ext.isin(list(FILE_EXTENSIONS)), ext)
    for name, short in CONTENT_TYPES.items():
        out = out.when(F.contains(kind, F.lit(name)), short)
    return out.when(F.contains(kind, F.lit("application/octet-stream")), F.nullif(ext, F.lit("")))


def queries_of(places: DataFrame, topics: Sequence[str]) -> DataFrame:
    """A search text for each place (``place``) and topic, each once."""
    return places.select(F.explode(F.transform(F.array(*map(F.lit, topics)), lambda t: F.concat(F.col("place"), F.lit(" "), t))).alias("query")).distinct()


def field_kind(name: str, config: Mapping[str, str] | None = None) -> str | None:
    """The cleaner of a field by configuration or name; null for media and kept HTML."""
    if name in MEDIA_FIELDS or name == "content_html":
        return None
    return (config or {}).get(name) or FIELD_KINDS.get(name, "text")


def cleaned(df: DataFrame, config: Mapping[str, str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Every text column cleaned by its kind; lists, structs, other types and ``keep`` stay."""
    out = []
    for f in df.schema.fields:
        kind = field_kind(f.name, config)
        col = F.col(f"`{f.name}`")
        out.append(CLEANERS[kind](col).alias(f.name) if f.dataType.simpleString() == "string" and kind and f.name not in keep else col)
    return df.select(*out)


def without_words(col: Column, words: Sequence[str]) -> Column:
    """Tokens between white space, less some words."""
    return F.array_join(F.filter(F.split(fn.collapse(col), " "), lambda w: ~w.isin(list(words))), " ")


def post_clean_faults(url: Column, title: Column, content: Column) -> Column:
    """Fields that cleaning must leave, and a warning for short content."""
    return F.array_compact(F.array(*[F.when(c.isNull(), F.lit(n)) for n, c in (("url", url), ("title", title), ("content", content))], F.when(F.length(content) < 10, "content_short")))


def content_type(existing: Column, file_urls: Column, url: Column, image_urls: Column, n_cjk: Column) -> Column:
    pdf = lambda u: F.endswith(F.lower(u), F.lit(".pdf"))
    return (
        F.when(F.coalesce(existing, F.lit("")) != "", existing).when(F.size(file_urls) > 0, F.when(F.exists(file_urls, pdf), "pdf").otherwise("file"))
        .when(pdf(F.coalesce(url, F.lit(""))), "pdf").when((F.size(image_urls) > 0) & (F.coalesce(n_cjk, F.lit(0)) < 20), "image_gallery").otherwise("rich_text")
    )


def text_list(col: Column) -> Column:
    """A list written as text: JSON, or the same with single quotes; any other text is a list of itself."""
    t = fn.strip(col)
    parsed = F.coalesce(F.from_json(t, "array<string>"), F.from_json(F.replace(t, F.lit("'"), F.lit('"')), "array<string>"))
    return F.when(t.isNull(), F.array().cast("array<string>")).when(F.startswith(t, F.lit("[")) & F.endswith(t, F.lit("]")) & parsed.isNotNull(), parsed).otherwise(F.array(t))


def tidy_path(path: Column) -> Column:
    """A path without dot segments."""
    parts = F.split(path, "/")
    folded = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, p: F.when(p == ".", acc).when(p == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc)).otherwise(F.array_append(acc, p)))
    open_end = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.array_join(folded, "/"), open_end)


def absolute(url: Column, base: Column) -> Column:
    """``url`` seen from ``base``: absolute, ``//host``, ``/path``, ``?query``, ``#part`` or relative, with dot segments."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)//", 1)
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"^(.*/)", 1))
    own = F.regexp_extract(url, r"^([^?#]*)", 1)
    rest = F.regexp_extract(url, r"^[^?#]*(.*)$", 1)
    return (
        F.when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), url).when(F.startswith(url, F.lit("//")), F.concat(scheme, url))
        .when(F.startswith(url, F.lit("/")), F.concat(site, tidy_path(own), rest)).when(url == "", base)
        .when(own == "", F.concat(site, path, F.when(F.startswith(rest, F.lit("#")), F.regexp_extract(base, r"(\?[^#]*)", 1)).otherwise(F.lit("")), rest))
        .otherwise(F.concat(site, tidy_path(F.concat(folder, own)), rest))
    )


def media_urls(urls: Column, base: Column) -> Column:
    """Web addresses of a list, absolute, each once in order."""
    trimmed = F.filter(F.transform(urls, lambda u: F.btrim(F.btrim(fn.strip(u), F.lit('"')), F.lit("'"))), lambda u: u != "")
    return F.array_distinct(F.filter(F.transform(trimmed, lambda u: absolute(u, base)), lambda u: u.rlike("^https?://")))


def without_noise(content: Column, title: Column) -> Column:
    """Content of over 50 characters less noise phrases; else the title."""
    text = fn.strip(content)
    clean = text
    for n in NOISE:
        clean = F.replace(clean, F.lit(n), F.lit(""))
    return F.when(F.length(text) > 50, clean).otherwise(F.concat(F.lit("标题: "), F.coalesce(title, F.lit(""))))


def safe_slug(col: Column) -> Column:
    """Letters, digits, hyphens; at most 60 characters, ``untitled`` for none."""
    out = F.regexp_replace(fn.strip(F.coalesce(col, F.lit(""))), r"[^\p{L}\p{N}_\-]", "")
    return F.coalesce(F.nullif(F.substring(F.btrim(out, F.lit("-")), 1, 60), F.lit("")), F.lit("untitled"))


def safe_date(col: Column, today: Column) -> Column:
    """yyyy-MM-dd of a text that begins with a date; else ``today``."""
    part = lambda i: F.regexp_extract(col, r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})", i)
    return F.when(part(1) != "", F.concat_ws("-", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0"))).when((F.length(col) >= 10) & F.substring(col, 5, 1).isin("-", "/", "."), F.replace(F.substring(col, 1, 10), F.lit("/"), F.lit("-"))).otherwise(today)


def short_hash(col: Column, n: int = 10) -> Column:
    return F.substring(F.sha1(col), 1, n)


def file_path(site: Column, date: Column, title: Column, url: Column) -> Column:
    """site/date/files/extension/slug-hash.extension."""
    ext = F.coalesce(F.nullif(fn.url_extension(url), F.lit("")), F.lit("bin"))
    return F.concat(site, F.lit("/"), date, F.lit("/files/"), ext, F.lit("/"), safe_slug(title), F.lit("-"), short_hash(url), F.lit("."), ext)


def image_path(site: Column, date: Column, title: Column, url: Column, number: Column) -> Column:
    ext = F.coalesce(F.nullif(fn.url_extension(url), F.lit("")), F.lit("jpg"))
    return F.concat(site, F.lit("/"), date, F.lit("/images/"), safe_slug(title), F.lit("-"), F.lpad(number.cast("string"), 2, "0"), F.lit("-"), short_hash(url), F.lit("."), ext)


def media_results(urls: Column, paths: Column) -> Column:
    """What became of each URL, by place: its path, or failed."""
    return F.transform(urls, lambda u, i: F.struct(u.alias("original_url"), F.get(paths, i).alias("path"), F.when(F.get(paths, i).isNull(), "failed").otherwise("ok").alias("status")))


def report_name(site: Column, at: Column, body: Column, extension: str, taken: Column) -> Column:
    """site_report_time_hash.extension, with _vN if ``taken`` reports of that name exist."""
    stem = F.concat(fn.safe_name(site), F.lit("_report_"), F.date_format(at, "yyyyMMdd_HHmmss"), F.lit("_"), short_hash(body, 8))
    return F.concat(stem, F.when(taken > 0, F.concat(F.lit("_v"), (taken + 1).cast("string"))).otherwise(F.lit("")), F.lit(f".{extension}"))
