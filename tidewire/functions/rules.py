"""Composable validation rules: each is a test of a Column with a message, and passes null unless it says otherwise."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import contains_any, has_text, strip

#: Tokens of error pages (fixed values).
ERROR_PAGE = ("404", "not found", "页面不存在", "访问错误")


@dataclass(frozen=True)
class Rule:
    message: str
    #: True where the value is good; null counts as bad
    holds: Callable[[Column], Column]


def nullable(test: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda c: c.isNull() | F.coalesce(test(c), F.lit(False))


def required() -> Rule:
    """Neither null nor blank."""
    return Rule("required", lambda c: c.isNotNull() & has_text(c.cast("string")))


def of_type(kind: str) -> Rule:
    """A text that reads as ``kind`` (a Spark type), or a value of a column that has it."""
    return Rule("type", nullable(lambda c: c.try_cast(kind).isNotNull()))


def length(least: int = 0, most: int | None = None) -> Rule:
    return Rule("length", nullable(lambda c: (F.length(c) >= least) & (F.lit(True) if most is None else F.length(c) <= most)))


def matches(pattern: str) -> Rule:
    """The pattern stands at the start of the text."""
    return Rule("pattern", nullable(lambda c: c.rlike(f"^(?:{pattern})")))


def is_url() -> Rule:
    return Rule("url", nullable(lambda c: c.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+")))


def is_email() -> Rule:
    return Rule("email", nullable(lambda c: c.rlike(r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$")))


def within(least: float | None = None, most: float | None = None) -> Rule:
    """A number within bounds; what is no number is bad."""
    low = lambda x: F.lit(True) if least is None else x >= least
    high = lambda x: F.lit(True) if most is None else x <= most
    return Rule("range", nullable(lambda c: low(c.try_cast("double")) & high(c.try_cast("double"))))


def custom(message: str, test: Callable[[Column], Column]) -> Rule:
    return Rule(message, lambda c: F.coalesce(test(c), F.lit(False)))


#: The rules that every article is held to.
PREDEFINED: Mapping[str, Sequence[Rule]] = {"url": (required(), is_url()), "title": (length(1, 500),), "content": (length(10),)}


def compiled(schema: Mapping[str, Mapping], base: Mapping[str, Sequence[Rule]] = PREDEFINED) -> dict[str, tuple[Rule, ...]]:
    """Rules of a declarative schema (field -> type, required, min_length, max_length, pattern, minimum, maximum), added to ``base``."""
    kinds = {"string": "string", "integer": "bigint", "number": "double", "boolean": "boolean"}
    out = {f: tuple(rs) for f, rs in base.items()}
    for field, say in schema.items():
        more = []
        if say.get("required"):
            more.append(required())
        if "type" in say:
            more.append(of_type(kinds[say["type"]]))
        if "min_length" in say or "max_length" in say:
            more.append(length(say.get("min_length", 0), say.get("max_length")))
        if "pattern" in say:
            more.append(matches(say["pattern"]))
        if "minimum" in say or "maximum" in say:
            more.append(within(say.get("minimum"), say.get("maximum")))
        out[field] = (*out.get(field, ()), *more)
    return out


def field_errors(rules: Mapping[str, Sequence[Rule]]) -> Column:
    """An array of ``field:message`` for each rule that a row breaks, in the order of the rules."""
    return F.array_compact(F.array(*[F.when(~r.holds(F.col(f)), F.lit(f"{f}:{r.message}")) for f, rs in rules.items() for r in rs]))


def field_results(rules: Mapping[str, Sequence[Rule]]) -> Column:
    """A map from each field to whether it keeps its rules."""
    entries = []
    for f, rs in rules.items():
        good = F.lit(True)
        for r in rs:
            good = good & r.holds(F.col(f))
        entries += [F.lit(f), good]
    return F.create_map(*entries)


def business_errors(date: Column, content: Column, this_year: int) -> Column:
    """Dates in the future or before 1900 (by the first four digits), and pages that show an error."""
    year = F.nullif(F.regexp_extract(date, r"(\d{4})", 1), F.lit("")).cast("int")
    return F.array_compact(F.array(
        F.when(year > this_year, "date:future").when(year < 1900, "date:past"),
        F.when(contains_any(F.lower(content), ERROR_PAGE), "content:error_page"),
    ))


def business_warnings(title: Column, content: Column) -> Column:
    """The title does not stand in the content (null reads none), or over 0.3 of the content's characters would be tags."""
    low = lambda c: F.lower(F.coalesce(c, F.lit("none")))
    return F.array_compact(F.array(
        F.when((low(title) != "") & (low(content) != "") & ~F.contains(low(content), low(title)), "consistency"),
        F.when(F.regexp_count(content, F.lit("<[^>]+>")) * 10 > F.length(content) * 3, "content:tags"),
    ))


def merged(errors: Column, business: Column) -> Column:
    """Business errors replace a field's other errors."""
    field = lambda e: F.substring_index(e, ":", 1)
    return F.concat(F.filter(errors, lambda e: ~F.exists(business, lambda b: field(b) == field(e))), business)


def validation_summary(checked: DataFrame, errors: str = "errors", k: int = 10) -> tuple[DataFrame, DataFrame]:
    """(field, invalid rows, rate in millionths) and the ``k`` most common messages."""
    total = checked.agg(F.count(F.lit(1)).alias("total"))
    each = checked.select(F.explode(F.array_distinct(F.transform(errors, lambda e: F.substring_index(e, ":", 1)))).alias("field"))
    rates = each.groupBy("field").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(total)).select("field", "n", F.expr("1000000 * n div total").alias("rate_ppm"))
    common = checked.select(F.explode(errors).alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "error").limit(k)
    return rates, common


def validation_stats(checked: DataFrame, errors: str = "errors") -> DataFrame:
    """One row: total, valid, invalid, both rates in millionths (0 without rows)."""
    ok = F.size(errors) == 0
    t = checked.agg(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("valid"))
    return t.select("total", "valid", (F.col("total") - F.col("valid")).alias("invalid"), F.expr("1000000 * valid div greatest(total, 1)").alias("valid_ppm"), F.expr("1000000 * (total - valid) div greatest(total, 1)").alias("invalid_ppm"))


def violations(df: DataFrame, checks: Mapping[str, Column], unique: Sequence[str] = ()) -> DataFrame:
    """(constraint, n): rows that break each check (null keeps it), and rows beyond the first of a key that must be unique (null keys aside)."""
    counted = df.agg(*[F.count_if(~c).alias(n) for n, c in checks.items()])
    out = counted.select(F.explode(F.array(*[F.struct(F.lit(n).alias("constraint"), F.col(n).alias("n")) for n in checks])).alias("r")).select("r.*")
    if unique:
        present = df.where(F.coalesce(*[F.col(c).cast("string") for c in unique]).isNotNull())
        again = present.groupBy(*unique).agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        out = out.unionByName(again.select(F.lit("unique").alias("constraint"), "n"))
    return out


def _readable(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        good = []
        for p in batch.to_pylist():
            try:
                good.append(p is None or bool(re.compile(p)))
            except re.error:
                good.append(False)
        yield pa.array(good, pa.bool_())


#: Columns of a table of rules; all but the first two may be missing or null.
RULE_COLUMNS = {"site": "string", "field": "string", "required": "boolean", "kind": "string", "min_length": "int", "max_length": "int", "pattern": "string", "minimum": "double", "maximum": "double"}
KINDS = {"string": "string", "integer": "bigint", "number": "double", "boolean": "boolean"}


def errors_by_table(records: DataFrame, rules: DataFrame, site: str, fields: Sequence[str], output: str = "errors") -> DataFrame:
    """``records`` with an array of ``field:message`` by the rules of their site, which stand in a table.

    ``rules`` has the columns RULE_COLUMNS; rows without a site hold for all. Sites with different rules
    need one plan: a site's rules (a few rows for each field) become one array, records are joined
    with it, and higher-order functions test each rule. Errors go by field and within it as
    required, type, length, pattern, range. Records without a site, or of one without rules, are held
    to the rules for all. A null value breaks no rule but ``required``, nor does a field that records
    lack; a pattern that cannot be read and a type that is not known are broken by every value.
    """
    have = [F.col(c) if c in rules.columns else F.lit(None) for c in RULE_COLUMNS]
    said = rules.select(*[h.cast(k).alias(c) for h, (c, k) in zip(have, RULE_COLUMNS.items(), strict=True)]).where(F.col("field").isNotNull())
    said = said.withColumn("readable", F.arrow_udf(_readable, "boolean")(F.col("pattern")))
    one = F.struct("field", *[c for c in (*RULE_COLUMNS, "readable") if c not in ("site", "field")])
    of_all = said.where(F.col("site").isNull()).agg(F.sort_array(F.collect_list(one)).alias("__all"))
    of_site = said.where(F.col("site").isNotNull()).groupBy(F.col("site").alias("__site")).agg(F.sort_array(F.collect_list(one)).alias("__own"))
    given = F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*[F.col(f"`{f}`").cast("string") for f in fields]))
    joined = records.withColumn("__values", given).join(of_site, F.col(site) == F.col("__site"), "left").join(F.broadcast(of_all))

    def broken(r: Column) -> Column:
        v = F.col("__values")[r["field"]]
        kinds = F.lit(False)
        for name, kind in KINDS.items():
            kinds = F.when(r["kind"] == name, v.try_cast(kind).isNull()).otherwise(kinds)
        known = r["kind"].isNull() | r["kind"].isin(*KINDS)
        number = v.try_cast("double")
        tests = (
            ("required", F.coalesce(r["required"], F.lit(False)) & (F.coalesce(strip(v), F.lit("")) == "")),
            ("type", v.isNotNull() & (~known | kinds)),
            ("length", v.isNotNull() & ((F.length(v) < r["min_length"]) | (F.length(v) > r["max_length"]))),
            ("pattern", v.isNotNull() & r["pattern"].isNotNull() & (~r["readable"] | ~F.rlike(v, F.when(r["readable"], F.concat(F.lit("^(?:"), r["pattern"], F.lit(")")))))),
            ("range", v.isNotNull() & (r["minimum"].isNotNull() | r["maximum"].isNotNull()) & (number.isNull() | (number < r["minimum"]) | (number > r["maximum"]))),
        )
        return F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.concat(r["field"], F.lit(f":{m}"))) for m, t in tests]))

    both = F.sort_array(F.concat(F.col("__all"), F.coalesce("__own", F.array().cast(joined.schema["__all"].dataType))))
    return joined.select(*[f"`{c}`" for c in records.columns if c != output], F.array_distinct(F.flatten(F.transform(both, broken))).alias(output))
