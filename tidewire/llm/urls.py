"""URL filters as a temporal join: lists change over time, and a capture is judged by the list of its day.

Dated list entries become validity intervals. A capture's host suffixes and path prefixes are keys;
an as-of join finds the entries whose interval holds the fetch time. No Python workers take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LIST_SCHEMA = "entry string, category string, action string, dated timestamp"


def host(url: Column) -> Column:
    """Lower-case host without user, port and trailing dot; empty for null and for URLs without one."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#\s]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"\.?(:[0-9]*)?$", ""))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]*(/[^?#\s]*)", 1)


def keys(url: Column, labels: int, parts: int) -> Column:
    """What entries may name: host suffixes (``b.c`` covers ``a.b.c``) of up to ``labels`` labels, and the whole host with path prefixes (``a.b.c/x``) of up to ``parts`` parts.

    The bounds are those of the list, so long hosts and paths give no more keys than it can match.
    """
    own = F.split(host(url), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(own), F.lit(labels))), lambda i: F.array_join(F.slice(own, F.size(own) - i + 1, i), "."))
    steps = F.slice(F.filter(F.split(path(url), "/"), lambda s: s != ""), 1, parts)
    none = F.array().cast("array<string>")
    # for lack of parts the sequence would run downwards
    prefixes = F.when(F.size(steps) > 0, F.transform(F.sequence(F.lit(1), F.greatest(F.size(steps), F.lit(1))), lambda i: F.concat(host(url), F.lit("/"), F.array_join(F.slice(steps, 1, i), "/")))).otherwise(none)
    return F.when(host(url) != "", F.array_distinct(F.concat(suffixes, prefixes))).otherwise(none)


def intervals(entries: DataFrame) -> DataFrame:
    """(entry, category, valid_from, valid_to): from an ``add`` to the next event of the same entry and category, null if open.

    Of events at one instant a removal counts last. Entries are compared without case, null ones and
    those without a date are ignored; repeated ones have no effect.
    """
    e = entries.select(F.lower(F.btrim("entry")).alias("entry"), "category", F.lower("action").alias("action"), "dated").where(F.col("entry").isNotNull() & F.col("dated").isNotNull())
    at = e.groupBy("entry", "category", "dated").agg(F.min(F.col("action") == "add").alias("added"))
    w = Window.partitionBy("entry", "category").orderBy("dated")
    return at.withColumn("valid_to", F.lead("dated").over(w)).where("added").select("entry", "category", F.col("dated").alias("valid_from"), "valid_to")


def filter_captures(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """``captures`` with ``blocked``, ``matched`` (entries, sorted) and ``categories`` (sorted), by the list as of ``fetched``.

    Null URLs, URLs without a host and captures without a time are not blocked. Equal captures share
    one look-up; rows are kept as they are. Columns of the input named like a result are replaced.
    """
    # rows are packed, so that no column of theirs can clash with one of ours
    names = [c for c in captures.columns if c not in ("blocked", "matched", "categories")]
    rows = captures.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    u, f = F.col("row")[url], F.col("row")[fetched]
    asked = rows.select(u.alias("__url"), f.alias("__at")).where(F.col("__url").isNotNull() & F.col("__at").isNotNull()).distinct()
    valid = intervals(entries)
    entry_parts = F.split("entry", "/")
    labels, parts = valid.agg(F.coalesce(F.max(F.size(F.split(F.get(entry_parts, F.lit(0)), r"\."))), F.lit(1)), F.coalesce(F.max(F.size(entry_parts)), F.lit(1))).first()
    each = asked.select("__url", "__at", F.explode(keys(F.col("__url"), labels, max(1, parts - 1))).alias("__key"))
    asof = each.join(valid, (F.col("__key") == F.col("entry")) & (F.col("__at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("__at") < F.col("valid_to"))))
    found = asof.groupBy("__url", "__at").agg(F.array_sort(F.collect_set("entry")).alias("matched"), F.array_sort(F.collect_set("category")).alias("categories"))
    out = rows.join(found, (u == F.col("__url")) & (f == F.col("__at")), "left")
    none = F.array().cast("array<string>")
    return out.select(*[F.col("row")[c].alias(c) for c in names], F.coalesce("matched", none).alias("matched"), F.coalesce("categories", none).alias("categories"), F.col("matched").isNotNull().alias("blocked"))
