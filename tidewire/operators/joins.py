"""Look-ups as joins: sites by host, seen URLs, metadata carried from list rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_loaded(sites: DataFrame, order: str) -> DataFrame:
    """One site for each domain: the one loaded last."""
    return sites.groupBy("domain").agg(F.max_by("site", order).alias("site"))


def site_of_host(pages: DataFrame, sites: DataFrame, host: str = "host", aligned: bool = True) -> DataFrame:
    """The site with the longest domain that ends the host; null if none does.

    Each distinct host asks for its suffixes (``aligned``: only those that begin at a label), so the
    join is an equi-join of any size; it asks for none that is longer than the longest domain.
    """
    hosts = pages.select(F.col(host).alias("__h")).distinct()
    labels = F.split("__h", r"\.")
    if aligned:
        parts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    else:
        parts = F.transform(F.sequence(F.lit(1), F.greatest(F.length("__h"), F.lit(1))), lambda i: F.substring("__h", i, 1_000_000))
    suffixes = hosts.select("__h", F.explode(parts).alias("__d"))
    found = suffixes.join(sites.select(F.col("domain").alias("__domain"), "site"), F.col("__d") == F.col("__domain")).groupBy("__h").agg(F.max_by("site", F.length("__d")).alias("site"))
    return pages.join(found, F.col(host) == F.col("__h"), "left").drop("__h")


def any_pattern(host: Column, patterns: Sequence[str]) -> Column:
    """Whether a host holds one of the patterns."""
    return F.exists(F.array(*map(F.lit, patterns)), lambda p: F.contains(host, p))


def rules_of_page(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page columns, field, rule): for each field the rule of the page's type, or else the site's own (null type)."""
    g = rules.where(F.col("page_type").isNull()).select(F.col("site").alias("__s"), "field", F.col("rule").alias("__global"))
    t = rules.where(F.col("page_type").isNotNull()).select(F.col("site").alias("__s2"), F.col("page_type").alias("__t"), F.col("field").alias("__f"), F.col("rule").alias("__own"))
    fields = g.select("__s", "field").union(t.select("__s2", "__f")).distinct()
    each = pages.join(fields, F.col("site") == F.col("__s")).drop("__s")
    each = each.join(t, (F.col("site") == F.col("__s2")) & (F.col("page_type") == F.col("__t")) & (F.col("field") == F.col("__f")), "left").drop("__s2", "__t", "__f")
    each = each.join(g.withColumnRenamed("field", "__f"), (F.col("site") == F.col("__s")) & (F.col("field") == F.col("__f")), "left")
    return each.withColumn("rule", F.coalesce("__own", "__global")).where("rule is not null").drop("__own", "__global", "__s", "__f")


def config_diff(one: DataFrame, two: DataFrame, key: str, field: str) -> DataFrame:
    """(key, common, only_one, only_two): sorted field names of two configurations."""
    a = one.groupBy(key).agg(F.array_sort(F.collect_set(field)).alias("a"))
    b = two.groupBy(F.col(key).alias("__k")).agg(F.array_sort(F.collect_set(field)).alias("b"))
    none = F.array().cast("array<string>")
    both = a.join(b, F.col(key) == F.col("__k"), "full").select(F.coalesce(key, "__k").alias(key), F.coalesce("a", none).alias("a"), F.coalesce("b", none).alias("b"))
    return both.select(key, F.array_intersect("a", "b").alias("common"), F.array_except("a", "b").alias("only_one"), F.array_except("b", "a").alias("only_two"))


def unseen(links: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    return links.join(seen.select(F.col(key).alias("__k")), F.col(key) == F.col("__k"), "left_anti")


def carry(details: DataFrame, rows: DataFrame, key: str, column: str) -> DataFrame:
    """``column`` of the detail, or else of its list row."""
    r = rows.select(F.col(key).alias("__k"), F.col(column).alias("__c"))
    return details.join(r, F.col(key) == F.col("__k"), "left").withColumn(column, F.coalesce(column, "__c")).drop("__k", "__c")
