"""Adapters from the stored tables to the shapes that the operators take, and readers of files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.extract import list_rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The time at which the adapted tables are looked at.
NOW = "2024-02-01 00:00:00"


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as articles: URL from source, language and id, title from the first line, dates and an author from the id."""
    d = table(spark, sf_dir, "documents")
    crawled = F.date_format(F.timestamp_seconds(F.unix_timestamp(F.lit(NOW).cast("timestamp")) - F.col("doc_id") % 400 * 3600), "yyyy-MM-dd'T'HH:mm:ss")
    return d.select(
        "doc_id",
        F.concat(F.lit("https://"), "source", F.lit(".example.org/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".html")).alias("url"),
        F.substring(F.substring_index("text", "\n", 1), 1, 200).alias("title"),
        F.col("text").alias("content"),
        F.col("source").alias("site"),
        "lang",
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")), "yyyy-MM-dd").alias("publish_date"),
        F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("author "), (F.col("doc_id") % 50).cast("string"))).alias("author"),
        F.when(F.col("doc_id") % 9 > 0, F.concat(crawled, F.when(F.col("doc_id") % 10 == 0, "Z").otherwise(""))).alias("crawl_time"),
    )


def one_of(key: str, values: Sequence[str | None]) -> Column:
    """A value for each row, in turn."""
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), (F.col(key) % len(values)).cast("int"))


def crawled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``articles`` as spiders leave them: fields under old names, missing, blank or as lists."""
    c = F.col
    k = c("doc_id")
    a = articles(spark, sf_dir)
    return a.select(
        "doc_id", "site", "lang",
        one_of("doc_id", ("article", "epidemic", "policy", "statistics", "other")).alias("item_type"),
        F.when(k % 5 > 0, F.when(k % 17 == 0, F.concat(F.lit("ftp://x/"), k.cast("string"))).otherwise(c("url"))).alias("url"),
        F.when((k % 5 == 0) | (k % 10 == 1), c("url")).alias("source_url"),
        F.when(k % 7 > 0, F.when(k % 11 == 0, "").otherwise(c("title"))).alias("title"),
        F.when(k % 7 == 0, c("title")).alias("page_title"),
        F.when(k % 3 > 0, c("content")).alias("content"),
        F.when(k % 3 == 0, F.array(F.substring(c("content"), 1, 40), F.lit("\t "), F.expr("substring(content, 41)"))).alias("article_content"),
        F.when(k % 4 > 0, c("publish_date")).alias("publish_date"),
        F.when(k % 4 == 0, c("publish_date")).alias("publish_time"),
        "crawl_time",
    )


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as versions of twenty URLs per site, in the order of their ids."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("seq"), F.col("source").alias("site"), F.concat("source", F.lit("/"), (F.col("doc_id") % 20).cast("string")).alias("url"), F.col("text").alias("content"))


def task_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as task runs."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("task_id"),
        (F.col("user_id") % 16).alias("worker_id"),
        F.col("ts").cast("timestamp").alias("start_time"),
        F.col("value").cast("decimal(18,4)").alias("duration"),
        F.when(F.col("event_type") == "error", "failed").otherwise("completed").alias("status"),
        F.get_json_object("props", "$.k").cast("long").alias("items"),
        (F.col("user_id") % 8).alias("site"),
        F.col("event_type").alias("spider"),
        (F.col("event_id") % 7).alias("pages"),
    )


def scan(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """A stored collection, or its first rows."""
    found = spark.read.parquet(path)
    return found if limit is None else found.limit(limit)


def json_lines(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """JSON lines; ``strict`` fails on the first bad one, otherwise bad ones stand in ``_corrupt_record``."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").json(path)


def text_list(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a text file, less blank lines and comments."""
    return spark.read.text(path).select(F.btrim("value").alias("entry")).where(~F.col("entry").rlike(r"^(#|$)"))


def json_configs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One configuration a file (JSON, which YAML includes), named by the file's stem."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.[A-Za-z]+$", 1).alias("name"), F.from_json("value", schema).alias("c"))
    return whole.select("name", "c.*")


TASK_SCHEMA = "url string, spider string, priority string, site string, max_retries int"


def batch_tasks(lines: DataFrame, column: str = "value") -> DataFrame:
    """Tasks from whole texts: a JSON array of tasks, or URLs line by line; defaults fill what is not said."""
    t = lines.select(F.col(column).alias("v"), F.from_json(column, f"array<struct<{', '.join(x.replace(' ', ': ') for x in TASK_SCHEMA.split(', '))}>>").alias("a"))
    urls = F.transform(F.filter(F.transform(F.split("v", "\n"), lambda u: F.btrim(u)), lambda u: ~u.rlike("^(#|$)")), lambda u: F.struct(u.alias("url"), *[F.lit(None).cast(k).alias(n) for n, k in (x.split() for x in TASK_SCHEMA.split(", ")[1:])]))
    each = t.select(F.explode(F.coalesce("a", urls)).alias("t")).select("t.*").where("url is not null")
    return each.select("url", F.coalesce("spider", F.lit("adaptive")).alias("spider"), F.coalesce("priority", F.lit("normal")).alias("priority"), F.coalesce("site", F.lit("")).alias("site"), F.coalesce("max_retries", F.lit(3)).alias("max_retries"))


def seeds(messages: DataFrame, column: str = "value") -> DataFrame:
    """(url, site, callback) of queue messages: JSON with ``url`` or ``u``, or a bare URL. Blank messages are none. Batch or stream."""
    v = F.btrim(F.col(column))
    of = lambda p: F.get_json_object(v, f"$.{p}")
    is_json = F.startswith(v, F.lit("{"))
    found = messages.select(F.when(is_json, F.coalesce(of("url"), of("u"))).otherwise(v).alias("url"), F.when(is_json, of("site")).alias("site"), F.when(is_json, of("callback")).alias("callback"))
    return found.where(F.col("url") != "")


def list_api(responses: DataFrame, keep: Sequence[str], path: str, fields: Mapping[str, str], url_template: str, body: str = "body") -> DataFrame:
    """Rows of the array at a dotted path of an answer, with fields by dotted paths; ``url_template`` takes them in braces."""
    rows = responses.select(*keep, F.posexplode(F.from_json(F.get_json_object(body, f"$.{path}"), "array<string>")).alias("index", "__o"))
    rows = rows.select(*keep, (F.col("index") + 1).alias("index"), *[F.get_json_object("__o", f"$.{p}").alias(f) for f, p in fields.items()])
    url = F.lit(url_template)
    for f in fields:
        url = F.replace(url, F.lit("{" + f + "}"), F.coalesce(F.col(f), F.lit("")))
    return rows.withColumn("url", url)


#: Where list elements stand in an HTML answer, unless a site says otherwise (a fixed value).
LIST_ITEMS = "div.page-content ul li"


def list_answers(responses: DataFrame, keep: Sequence[str], config: Mapping, body: str = "body") -> DataFrame:
    """``keep`` columns and (title, url, date, index) of a list API's answers, as a site's ``config`` describes them.

    {response_type: json (default) or html, json_path, field_mappings: {title, url, date}, url_template,
    json_html_field, html_item_selector}. A JSON answer is an array at ``json_path``, whose objects have the
    fields mapped (``{url}`` in the template stands for the URL); where there is no array, the text at ``json_html_field``
    is HTML. HTML elements give the first link's title attribute, or else its text, its address, and the first
    ISO date in the element's text. ``index`` counts all elements from 1; those without a URL go, and so do
    answers that cannot be read.
    """
    at = lambda p: "$" + "".join(f"['{x}']" for x in (p or "").split(".") if x)
    columns = [*keep, "title", "url", "date", "index"]

    def of_html(df: DataFrame, html: Column) -> DataFrame:
        say = {"title": {"selector": ["a::attr(title)", "a::text"]}, "url": {"selector": "a::attr(href)"}, "__text": {"selector": ""}}
        rows = list_rows(df.select(*keep, html.alias("__html")), keep, (config.get("html_item_selector") or LIST_ITEMS).strip(), say, "__html", None, ("url",))
        return rows.withColumn("date", F.nullif(F.regexp_extract("__text", r"\d{4}-\d{2}-\d{2}", 0), F.lit(""))).select(columns)

    if (config.get("response_type") or "json").lower() != "json":
        return of_html(responses, F.col(body))
    objects = F.from_json(F.get_json_object(body, at((config.get("json_path") or "").strip())), "array<string>")
    names = config.get("field_mappings") or {}
    each = responses.withColumn("__list", objects).where(F.col("__list").isNotNull()).select(*keep, F.posexplode("__list").alias("at", "__o"))
    fields = {f: F.get_json_object("__o", at(names.get(f, f))) for f in ("title", "url", "date")}
    url = F.nullif(fields["url"], F.lit(""))
    if config.get("url_template"):
        url = F.replace(F.lit(config["url_template"]), F.lit("{url}"), url)
    out = each.select(*keep, fields["title"].alias("title"), url.alias("url"), fields["date"].alias("date"), (F.col("at") + 1).alias("index")).where(F.col("url").isNotNull())
    if not (config.get("json_html_field") or "").strip():
        return out
    rest = responses.where(objects.isNull())
    return out.unionByName(of_html(rest, F.get_json_object(body, at(config["json_html_field"].strip()))))


def proxies_of(lines: DataFrame, column: str = "value") -> DataFrame:
    """(ip, port, protocol) of lines ``ip:port`` or JSON arrays of objects; each once."""
    v = F.col(column)
    objects = F.transform(F.from_json(v, "array<struct<ip: string, port: string, protocol: string>>"), lambda o: F.struct(o["ip"].alias("ip"), o["port"].try_cast("int").alias("port"), F.coalesce(o["protocol"], F.lit("http")).alias("protocol")))
    pattern = r"(\d{1,3}(?:\.\d{1,3}){3}):(\d{1,5})"
    pairs = F.transform(F.regexp_extract_all(v, F.lit(pattern), F.lit(0)), lambda m: F.struct(F.substring_index(m, ":", 1).alias("ip"), F.substring_index(m, ":", -1).try_cast("int").alias("port"), F.lit("http").alias("protocol")))
    each = lines.select(F.explode(F.when(F.startswith(F.btrim(v), F.lit("[")), objects).otherwise(pairs)).alias("p")).select("p.*")
    return each.where(F.col("ip").isNotNull() & F.col("port").between(1, 65535)).distinct()


def log_counters(lines: DataFrame, by: str, order: str, column: str = "value") -> DataFrame:
    """For each log its last item and response counts, and how many lines hold ERROR."""
    count = lambda name: F.nullif(F.regexp_extract(column, rf"{name}'?\"?\s*[:=]\s*(\d+)", 1), F.lit("")).try_cast("bigint")
    last = lambda name: F.max_by(count(name), F.when(count(name).isNotNull(), F.col(order)))
    return lines.groupBy(by).agg(last("item_scraped_count").alias("items"), last("response_received_count").alias("responses"), F.count_if(F.contains(column, F.lit("ERROR"))).alias("errors"))


def seed_tasks(sites: DataFrame, site: str = "all") -> DataFrame:
    """A task for each start URL of one site or of all."""
    chosen = sites if site == "all" else sites.where(F.col("site") == site)
    return chosen.select("site", F.explode("start_urls").alias("url")).where(F.coalesce("url", F.lit("")) != "")


def system_status(**parts: DataFrame) -> DataFrame:
    """One row of one-row tables, each as a struct."""
    out = None
    for name, df in parts.items():
        one = df.select(F.struct("*").alias(name))
        out = one if out is None else out.join(F.broadcast(one))
    return out


def between_dates(docs: DataFrame, first: str, last: str, column: str = "publish_date") -> DataFrame:
    """ISO dates as strings compare as dates do."""
    return docs.where(F.col(column).between(first, last))


def search_hits(responses: DataFrame, body: str = "body") -> DataFrame:
    """Rows of search-API answers with code 200; the title is the name, or else the snippet."""
    schema = "code int, data struct<webPages: struct<value: array<struct<url: string, name: string, snippet: string, siteName: string, datePublished: string>>>>"
    hits = responses.select(F.from_json(body, schema).alias("r")).where("r.code = 200").select(F.explode("r.data.webPages.value").alias("h"))
    return hits.select("h.url", F.coalesce(F.nullif("h.name", F.lit("")), "h.snippet").alias("title"), F.col("h.siteName").alias("source"), F.col("h.datePublished").alias("published"))


def write_by_site(docs: DataFrame, path: str) -> None:
    """Append, a folder for each site."""
    docs.write.mode("append").partitionBy("site").parquet(path)


def stream_by_site(docs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """As ``write_by_site``, batch by batch of a stream; takes what there is and ends."""
    return docs.writeStream.foreachBatch(lambda batch, _: write_by_site(batch, path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def write_json_lines(docs: DataFrame, path: str, empty: bool = True) -> bool:
    """JSON lines; whether anything was written (nothing for no rows, unless ``empty``)."""
    if not empty and docs.isEmpty():
        return False
    docs.write.mode("append").json(path)
    return True


def as_report(summary: DataFrame, name: str = "report") -> DataFrame:
    """A one-row summary as one JSON object."""
    return summary.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias(name))


def write_unique(docs: DataFrame, path: str, key: str) -> None:
    """Append rows whose key the store lacks, each once."""
    spark = docs.sparkSession
    fresh = docs.dropDuplicates([key])
    try:
        known = spark.read.parquet(path).select(F.col(key).alias("__k"))
        fresh = fresh.join(known, F.col(key) == F.col("__k"), "left_anti")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    fresh.write.mode("append").parquet(path)
