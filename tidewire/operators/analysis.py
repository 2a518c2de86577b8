"""Keyword, time and place aggregates over documents, and alert rules over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
DISEASES: Mapping[str, Sequence[str]] = {
    "呼吸道疾病": ("流感", "新冠", "COVID", "肺炎", "咳嗽", "发热", "感冒", "哮喘"),
    "消化道疾病": ("腹泻", "诺如", "轮状", "食物中毒", "肠炎", "胃炎"),
    "传染病": ("结核", "艾滋", "HIV", "肝炎", "手足口", "麻疹", "水痘", "流脑"),
    "慢性病": ("糖尿病", "高血压", "心脏病", "癌症", "肿瘤", "慢病"),
    "疫苗相关": ("疫苗", "接种", "免疫", "预防接种"),
    "公共卫生": ("监测", "预警", "防控", "消毒", "隔离", "应急", "卫生"),
}
DISTRICTS = ("朝阳", "海淀", "丰台", "石景山", "门头沟", "房山", "通州", "顺义", "昌平", "大兴", "怀柔", "平谷", "密云", "延庆", "东城", "西城")


def keyword_hits(docs: DataFrame, text: Column, words: Mapping[str, Sequence[str]] = DISEASES) -> DataFrame:
    """A row (category, keyword) for each document and keyword whose text holds it, case-insensitively. No join: the list is part of the plan."""
    pairs = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(w).alias("keyword")) for c, ws in words.items() for w in ws])
    low = docs.withColumn("__low", F.lower(F.coalesce(text, F.lit(""))))
    return low.withColumn("__h", F.explode(F.filter(pairs, lambda p: F.contains(F.col("__low"), F.lower(p["keyword"]))))).select(*docs.columns, "__h.*")


def together(texts: Sequence[Column]) -> Column:
    """Texts one after another, with nothing between; null ones are left out."""
    return F.concat(*[F.coalesce(t, F.lit("")) for t in texts])


def _categories(low: Column, words: Mapping[str, Sequence[str]]) -> Column:
    """The category of each keyword that a text in lower case holds, and first a null, which stands for the document itself."""
    pairs = F.array(*[F.struct(F.lit(c).alias("category"), F.lower(F.lit(w)).alias("keyword")) for c, ws in words.items() for w in ws])
    hits = F.filter(pairs, lambda p: F.contains(low, p["keyword"]))
    return F.concat(F.array(F.lit(None).cast("string")), F.transform(hits, lambda p: p["category"]))


def trends(docs: DataFrame, dates: Sequence[Column], titles: Sequence[Column], words: Mapping[str, Sequence[str]] = DISEASES) -> DataFrame:
    """(day, category, n): for each day its documents (category null) and the keywords of each category that titles hold.

    The day is the first date stated, without brackets; one that has no ten characters and a dash is none.
    """
    day = F.regexp_replace(F.coalesce(*[F.nullif(d, F.lit("")) for d in dates]), r"[【】\[\]]", "")
    d = docs.select(day.alias("day"), F.lower(together(titles)).alias("low")).where((F.length("day") == 10) & F.contains("day", F.lit("-")))
    return d.select("day", F.explode(_categories(F.col("low"), words)).alias("category")).groupBy("day", "category").agg(F.count(F.lit(1)).alias("n"))


def distribution(docs: DataFrame, texts: Sequence[Column], words: Mapping[str, Sequence[str]] = DISEASES) -> DataFrame:
    """(kind, name, n): keywords found of each category, and documents that hold each keyword, in all texts together."""
    hits = keyword_hits(docs.select(together(texts).alias("whole")), F.col("whole"), words)
    pairs = hits.groupBy("category", "keyword").agg(F.count(F.lit(1)).alias("n"))
    # at most a row for each listed keyword goes on
    both = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("name")) for k in ("category", "keyword")]))
    return pairs.select("n", both.alias("b")).groupBy("b.kind", "b.name").agg(F.sum("n").alias("n"))


def place_distribution(docs: DataFrame, texts: Sequence[Column], places: Sequence[str] = DISTRICTS, words: Mapping[str, Sequence[str]] = DISEASES) -> DataFrame:
    """(place, category, n): for each place the documents that name it (category null), and the keywords of each category in them."""
    d = docs.select(together(texts).alias("whole")).withColumn("low", F.lower("whole"))
    d = place_hits(d.select("whole", _categories(F.col("low"), words).alias("categories")), F.col("whole"), places)
    return d.select("place", F.explode("categories").alias("category")).groupBy("place", "category").agg(F.count(F.lit(1)).alias("n"))


def day_of(*dates: Column) -> Column:
    """The first ten characters of the first date that is stated."""
    return F.coalesce(*[F.substring(F.nullif(d, F.lit("")), 1, 10) for d in dates])


def daily_counts(docs: DataFrame, *dates: str) -> DataFrame:
    """Documents of each day; a text counts as day if, less its brackets, it has ten characters and a dash."""
    day = F.regexp_replace(F.coalesce(*[F.nullif(F.col(d), F.lit("")) for d in dates or ("publish_date",)]), r"[【】\[\]]", "")
    return docs.select(day.alias("day")).where((F.length("day") == 10) & F.contains("day", F.lit("-"))).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


def category_by_day(hits: DataFrame) -> DataFrame:
    return hits.groupBy(F.col("publish_date").alias("day"), "category").agg(F.count(F.lit(1)).alias("n"))


def place_hits(docs: DataFrame, text: Column, places: Sequence[str] = DISTRICTS) -> DataFrame:
    names = F.array(*map(F.lit, places))
    return docs.withColumn("place", F.explode(F.filter(names, lambda p: F.contains(text, p))))


def content_profile(docs: DataFrame, relevant: Column | None = None) -> DataFrame:
    """One row: how many documents have what, mean lengths in thousandths (0 for none) and the share that is relevant in millionths."""
    has = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    mean = lambda c: F.expr(f"coalesce(cast(try_divide(1000 * sum(case when {c} <> '' then length({c}) end), count_if({c} <> '')) as bigint), 0)")
    relevant = F.lit(False) if relevant is None else F.coalesce(relevant, F.lit(False))
    return docs.withColumn("__r", relevant).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(has("title")).alias("with_title"), F.count_if(has("content")).alias("with_content"), F.count_if(has("publish_date")).alias("with_date"),
        F.count_if("__r").alias("with_keywords"), mean("title").alias("title_milli"), mean("content").alias("content_milli"),
        F.expr("coalesce(cast(try_divide(1000000 * count_if(__r), count(*)) as bigint), 0)").alias("relevance_ppm"),
    )


def insight(relevance_ppm: Column) -> Column:
    return F.when(relevance_ppm > 800_000, "high").when(relevance_ppm > 500_000, "medium").otherwise("low")


def top_name(counts: DataFrame, name: str, count: str = "n") -> DataFrame:
    """One row: the name with the largest count (of equal ones the first in order), N/A for none."""
    best = counts.agg(F.min(F.struct((-F.col(count)).alias("n"), F.col(name).alias("name"))).alias("m"))
    return best.select(F.coalesce("m.name", F.lit("N/A")).alias("name"))


def duplicate_groups(docs: DataFrame, key: str) -> DataFrame:
    """One row: keys that occur more than once, and the rows that have them. Null keys aside."""
    groups = docs.where(F.col(key).isNotNull()).groupBy(F.xxhash64(key).alias("__h"), F.col(key).alias("__k")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return groups.agg(F.count(F.lit(1)).alias("n_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


def emptiness(docs: DataFrame, by: str, order: str, columns: Sequence[str]) -> DataFrame:
    """For each group its rows, how many have each column null or empty, and the latest row's order value."""
    empty = [F.count_if(F.coalesce(F.col(c), F.lit("")) == "").alias(f"no_{c}") for c in columns]
    return docs.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *empty, F.max(order).alias("latest"))


def report_text(docs: DataFrame, by: str, order: str, most: int = 800) -> DataFrame:
    """For each group the title, start of the content and link of its documents, in order, line by line."""
    part = F.concat(F.lit("标题: "), F.coalesce("title", F.lit("")), F.lit("\n内容摘要: "), F.substring(F.coalesce("content", F.lit("")), 1, most), F.lit("\n链接: "), F.coalesce("url", F.lit("")))
    return docs.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), part.alias("p")))).alias("r")).select(by, F.array_join(F.transform("r", lambda x: x["p"]), "\n").alias("report"))


def top_k(counts: DataFrame, count: str, tie: str, k: int) -> DataFrame:
    return counts.orderBy(F.col(count).desc(), F.col(tie)).limit(k)


def spikes(daily: DataFrame, factor: int = 2, least_days: int = 3) -> DataFrame:
    """Days whose count is over ``factor`` times the mean of all days before. One row a day: the window's input is small."""
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    d = daily.withColumns({"before": F.sum("n").over(w), "days": F.count("n").over(w)})
    return d.where((F.col("days") + 1 >= least_days) & (F.col("n") * F.col("days") > F.col("before") * factor)).select("day", "n")


def keyword_surges(hits: DataFrame, first: str, last: str, before: str, factor: int = 3, least_new: int = 5) -> DataFrame:
    """Keywords whose count between two days is over ``factor`` times that of the disjoint period before, or new with at least ``least_new``."""
    day = F.col("publish_date")
    c = hits.groupBy("keyword").agg(F.count_if(day.between(first, last)).alias("now"), F.count_if((day >= before) & (day < first)).alias("was"))
    kind = F.when((F.col("was") > 0) & (F.col("now") > F.col("was") * factor), "surge").when((F.col("was") == 0) & (F.col("now") >= least_new), "new")
    return c.withColumn("kind", kind).where(kind.isNotNull())


def concentrated(counts: DataFrame, key: str, percent: int = 70) -> DataFrame:
    """Keys with over ``percent`` of all counts."""
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).where(F.col("n") * 100 > F.col("total") * percent).select(key, "n", "total")
