"""Validation rules and quality scores; scores are whole hundredths, so that thresholds are exact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WS, contains_any, has_text

# Thresholds, weights, levels and tokens.
ERROR_PAGE = ("404", "not found", "页面不存在", "访问错误")
ERROR_TOKENS = ("404", "not found", "页面不存在", "访问错误", "error")
LEVELS = (("优秀", 90), ("良好", 80), ("中等", 70), ("较差", 60))
LOWEST_LEVEL = "很差"


def present(col: Column) -> Column:
    return col.isNotNull() & has_text(col)


def validation_errors(url: Column, title: Column, content: Column) -> Column:
    """Messages of the predefined rules: URL required and well-formed, title 1 to 500, content at least 10 characters."""
    return F.array_compact(
        F.array(
            F.when(~present(F.coalesce(url, F.lit(""))), "url:required"),
            F.when(url.isNotNull() & ~url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+"), "url:format"),
            F.when(title.isNotNull() & ~F.length(title).between(1, 500), "title:length"),
            F.when(content.isNotNull() & (F.length(content) < 10), "content:length"),
            F.when(contains_any(F.lower(content), ERROR_PAGE), "content:error_page"),
        )
    )


def completeness(title: Column, content: Column, url: Column, date: Column, author: Column, source: Column) -> Column:
    parts = ((title, 30), (content, 40), (url, 10), (date, 10), (author, 5), (source, 5))
    total = F.lit(0)
    for col, weight in parts:
        total = total + F.when(present(F.coalesce(col, F.lit(""))), weight).otherwise(0)
    return total


def accuracy(url: Column, date: Column, content: Column, title: Column) -> Column:
    """Empty values lose nothing here; they are a matter of completeness."""
    filled = lambda c: c.isNotNull() & (c != "")
    n, t = F.length(content), F.length(title)
    lost = F.when(filled(url) & ~url.rlike(r'^https?://[^\s<>"{}|\\^`\[\]]'), 10).otherwise(0)
    lost += F.when(filled(date) & ~date.rlike(r"\d{4}(-\d{2}-|/\d{2}/|\.\d{2}\.)\d{2}"), 10).otherwise(0)
    lost += F.when(~filled(content), 0).when(n < 50, 20).when(n > 100000, 10).otherwise(0)
    lost += F.when(~filled(title), 0).when((t < 5) | (t > 200), 10).otherwise(0)
    return 100 - lost


def validity(url: Column, content: Column) -> Column:
    words = F.regexp_count(content, F.lit(f"[^{WS[1:-1]}]+"))
    tags = F.regexp_count(content, F.lit("<[^>]+>"))
    lost = F.when(~present(F.coalesce(url, F.lit(""))), 30).when(~url.rlike("^https?://"), 20).otherwise(0)
    lost += F.when(contains_any(F.lower(content), ERROR_TOKENS), 40).otherwise(0)
    # counting makes an array of all words, so it is left out for texts without a tag
    lost += F.when(F.contains(content, F.lit("<")) & (tags * 10 > words * 3), 20).otherwise(0)
    return F.greatest(F.lit(0), 100 - lost)


def naming_styles(names: Column) -> Column:
    """The largest number of names of one style: snake case, camel case (a capital after the first letter) or Pascal case."""
    count = lambda test: F.size(F.filter(names, test))
    snake = count(lambda n: F.contains(n, F.lit("_")) & (n == F.lower(n)) & (F.lower(n) != F.upper(n)))
    return F.greatest(snake, count(lambda n: F.substring(n, 2, 10_000).rlike(r"\p{Lu}")), count(lambda n: n.rlike(r"^\p{Lu}")))


def consistency(names: Column, kinds_differ: Column | None = None) -> Column:
    """Less than 0.8 of the field names in one style, and content and title of different types, lose 10 each."""
    mixed = (F.size(names) > 0) & (naming_styles(names) * 10 < F.size(names) * 8)
    lost = F.when(mixed, 10).otherwise(0)
    return 100 - (lost if kinds_differ is None else lost + F.when(kinds_differ, 10).otherwise(0))


def timeliness(age_hours: Column) -> Column:
    return F.when(age_hours.isNull(), 80).when(age_hours > 168, 70).when(age_hours > 24, 90).otherwise(100)


#: Year, month, day, hour, minute, second, fraction; then a zone.
ISO = r"^(\d{4})-?(\d{2})-?(\d{2})(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(\.\d{1,6})?\d*)?)?(?:Z|[+-]\d{2}(?::?\d{2})?)?)?$"


def age_hours(now: Column, *times: Column) -> Column:
    """Hours since the first of several ISO times that can be read, as it is written (its zone is not looked at); null if none can."""
    at = F.coalesce(*[written_time(t) for t in times])
    return (F.unix_timestamp(now) - F.unix_timestamp(at)) / 3600


def written_time(col: Column) -> Column:
    """The time an ISO text states (with dashes and colons or without), less its zone; null if it is none."""
    part = lambda i: F.regexp_extract(col, ISO, i)
    clock = F.concat(F.when(part(4) != "", part(4)).otherwise("00"), F.lit(":"), F.when(part(5) != "", part(5)).otherwise("00"), F.lit(":"), F.when(part(6) != "", part(6)).otherwise("00"), part(7))
    return F.when(col.rlike(ISO), F.try_to_timestamp(F.concat(part(1), F.lit("-"), part(2), F.lit("-"), part(3), F.lit(" "), clock)))


def issues(url: Column, title: Column, content: Column) -> Column:
    """What is wrong with a record, in words."""
    missing = lambda c: F.coalesce(c, F.lit("")) == ""
    count = lambda mark: F.length(content) - F.length(F.replace(content, F.lit(mark), F.lit("")))
    return F.array_compact(F.array(
        *[F.when(missing(c), f"缺少重要字段: {n}") for n, c in (("title", title), ("content", content), ("url", url))],
        F.when(~missing(content) & (F.length(content) < 100), "内容过短"),
        F.when(~missing(content) & (count("<") * 10 > count(" ")), "内容包含过多HTML标签"),
        F.when(~missing(title) & (F.length(title) < 10), "标题过短"),
        F.when(~missing(title) & (title == F.upper(title)) & title.rlike(r"\p{Lu}"), "标题全为大写"),
    ))


def recommendations(found: Column) -> Column:
    """Advice that follows from the issues."""
    some = lambda mark: F.exists(found, lambda x: F.contains(x, F.lit(mark)))
    advice = F.array_compact(F.array(
        F.when(some("缺少"), "完善数据提取规则，确保重要字段的提取"), F.when(some("内容过短"), "检查内容提取选择器，可能需要提取更多内容"),
        F.when(some("HTML标签"), "增强HTML清洗规则，移除多余的标签"), F.when(some("标题"), "优化标题提取规则，确保标题的完整性和格式"),
    ))
    return F.when(F.size(advice) > 0, advice).otherwise(F.array(F.lit("数据质量良好，建议定期监控和维护")))


def level(score: Column) -> Column:
    """``score`` in ten-thousandths."""
    out = F.when(score >= LEVELS[0][1] * 100, LEVELS[0][0])
    for name, least in LEVELS[1:]:
        out = out.when(score >= least * 100, name)
    return out.otherwise(LOWEST_LEVEL)


#: Field names of an article record as it is scored.
ARTICLE_FIELDS = ("url", "title", "content", "publish_date", "author", "source", "crawl_time")


#: Where an article's time is looked for, in this order.
TIME_FIELDS = ("crawl_time", "extraction_time", "timestamp")


def score_articles(articles: DataFrame, now: Column, fields: tuple[str, ...] = ARTICLE_FIELDS) -> DataFrame:
    """Adds the five dimensions (hundredths), the overall score (ten-thousandths) and its level. Takes url, title, content, publish_date, author, site and what there is of TIME_FIELDS."""
    c = F.col
    out = articles.withColumns({
        "completeness": completeness(c("title"), c("content"), c("url"), c("publish_date"), c("author"), c("site")),
        "accuracy": accuracy(c("url"), c("publish_date"), c("content"), c("title")),
        "consistency": consistency(F.array(*map(F.lit, fields))),
        "timeliness": timeliness(age_hours(now, *[c(t).cast("string") for t in TIME_FIELDS if t in articles.columns])),
        "validity": validity(c("url"), c("content")),
    })
    out = out.withColumn("overall", c("completeness") * 25 + c("accuracy") * 25 + c("consistency") * 20 + c("timeliness") * 15 + c("validity") * 15)
    return out.withColumn("level", level(c("overall")))


def quality_summary(scored: DataFrame, by: str) -> DataFrame:
    return scored.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("overall").alias("total"),
        F.min("overall").alias("least"),
        F.max("overall").alias("most"),
        F.expr("sum(overall) div (10 * count(*))").alias("mean_milli"),
        *[F.count_if(F.col("level") == name).alias(f"n_{k}") for k, name in enumerate([*[n for n, _ in LEVELS], LOWEST_LEVEL])],
        F.count_if(F.col("level").isin("较差", "很差")).alias("n_poor"),
    )


def summary_advice(mean_milli: Column, n: Column, n_poor: Column) -> Column:
    """Advice from the mean (thousandths) and the share of poor records."""
    return F.array_compact(F.array(
        F.when(mean_milli < 700, "low_mean").when(mean_milli < 800, "fair_mean"), F.when(n_poor * 5 > n, "many_poor"),
    ))


def running_mean(scored: DataFrame, by: str, order: str) -> DataFrame:
    """``mean`` (ten-thousandths, cut) of each record and all before it of its group."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return scored.withColumn("mean", F.floor(F.sum("overall").over(w) / F.count("overall").over(w)).cast("long"))


def quality_trend(scored: DataFrame, by: str, order: str) -> DataFrame:
    """The last ten scores against the ten before (or what there is), per group: sums and counts, and the direction."""
    w = Window.partitionBy(by).orderBy(F.col(order).desc())
    r = scored.withColumn("r", F.row_number().over(w)).where("r <= 20").groupBy(by).agg(
        F.sum(F.when(F.col("r") <= 10, F.col("overall"))).alias("late"), F.count_if(F.col("r") <= 10).alias("n_late"),
        F.sum(F.when(F.col("r") > 10, F.col("overall"))).alias("early"), F.count_if(F.col("r") > 10).alias("n_early"),
    )
    # means compared without division: a difference of 0.05 is 500 ten-thousandths
    change = F.col("late") * F.col("n_early") - F.col("early") * F.col("n_late")
    bound = F.col("n_late") * F.col("n_early") * 500
    return r.withColumn("trend", F.when((F.col("n_late") < 10) | (F.col("n_early") == 0), "数据不足").when(change > bound, "上升").when(change < -bound, "下降").otherwise("稳定"))
