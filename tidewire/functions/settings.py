"""Checks of deployment settings and of site configurations, as Columns over tables of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Settings that must be there, passwords, keys, ranges that are advised, and sections of configurations.
REQUIRED = ("ENVIRONMENT", "MONGODB_ROOT_USERNAME", "MONGODB_ROOT_PASSWORD", "MONGODB_DATABASE", "SECRET_KEY", "API_TOKEN", "JWT_SECRET")
PASSWORDS = ("MONGODB_ROOT_PASSWORD", "REDIS_PASSWORD", "MONGO_EXPRESS_PASSWORD", "MINIO_ROOT_PASSWORD")
MAY_BE_EMPTY = ("REDIS_PASSWORD",)
KEYS = ("SECRET_KEY", "API_TOKEN", "JWT_SECRET")
RANGES: Mapping[str, tuple[int, int]] = {"CONCURRENT_REQUESTS": (1, 100), "DOWNLOAD_DELAY": (0, 10), "PROXY_POOL_SIZE": (1, 1000), "RETRY_TIMES": (1, 10)}
STORE = ("MONGODB_DATABASE", "MONGODB_ROOT_USERNAME", "MONGODB_ROOT_PASSWORD")
WITH_DEFAULTS = ("MONGODB_HOST", "MONGODB_PORT", "REDIS_HOST", "REDIS_PORT")
MAIL = ("SMTP_HOST", "SMTP_PORT", "SMTP_USERNAME", "SMTP_PASSWORD")
WEBHOOK, WEBHOOK_START = "SLACK_WEBHOOK_URL", "https://hooks.slack.com/"
SPECIAL = "!@#$%^&*()_+-=[]{}|;:,.<>?"
NEW_SECTIONS = ("site_info", "target_pages", "browser_config", "selectors", "crawling_strategy")
OLD_SECTIONS = ("name", "base_url", "fields")

NAMES = tuple(dict.fromkeys((*REQUIRED, *PASSWORDS, *KEYS, *RANGES, *STORE, *WITH_DEFAULTS, *MAIL, WEBHOOK)))
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def password_faults(password: Column) -> Column:
    """What a password lacks: short, no_upper, no_lower, no_digit, no_special; empty for a strong one, null for null."""
    special = F.translate(password, SPECIAL, "") == password
    tests = {"short": F.length(password) < 8, "no_upper": ~password.rlike(r"\p{Lu}"), "no_lower": ~password.rlike(r"\p{Ll}"), "no_digit": ~password.rlike(r"\p{Nd}"), "no_special": special}
    return F.when(password.isNotNull(), F.array_compact(F.array(*[F.when(t, F.lit(name)) for name, t in tests.items()])))


def key_fault(key: Column) -> Column:
    """empty, short (under 32 characters), default_value, or null for a good key."""
    return F.when(F.coalesce(key, F.lit("")) == "", "empty").when(F.length(key) < 32, "short").when(F.startswith(key, F.lit("your-")) | F.contains(key, F.lit("change-this")), "default_value")


def range_fault(value: Column, least: float, most: float) -> Column:
    """unset, not_a_number, out_of_range, or null for a number within the bounds."""
    number = F.when(value.rlike(NUMBER), F.btrim(value).try_cast("double"))
    return F.when(F.coalesce(value, F.lit("")) == "", "unset").when(number.isNull(), "not_a_number").when(~number.between(least, most), "out_of_range")


def _problem(level: Column | str, name: str, problem: Column) -> Column:
    level = F.lit(level) if isinstance(level, str) else level
    return F.when(problem.isNotNull(), F.struct(level.alias("level"), F.lit(name).alias("name"), problem.alias("problem")))


def setting_problems(settings: DataFrame, scope: str = "scope", name: str = "name", value: str = "value") -> DataFrame:
    """(scope, level, name, problem) of deployments whose settings stand as rows (scope, name, value).

    ``level`` is error or warning. A setting without a row is unset; of repeated ones the largest value
    counts; unknown names have no effect, but a scope with no others lacks all that is required. Null
    values are unset, a null scope is a scope. One shuffle by scope, pre-aggregated.
    """
    said = F.col(f"`{value}`").cast("string")
    wide = settings.groupBy(F.col(f"`{scope}`").alias(scope)).agg(*[F.max(F.when(F.col(f"`{name}`") == n, said)).alias(f"v_{n}") for n in NAMES])
    v = lambda n: F.col(f"v_{n}")
    unset = lambda n: F.coalesce(v(n), F.lit("")) == ""
    found = [_problem("error", n, F.when(unset(n), F.lit("missing"))) for n in REQUIRED]
    for n in PASSWORDS:
        found.append(_problem("warning" if n in MAY_BE_EMPTY else "error", n, F.when(unset(n), F.lit("empty"))))
        faults = password_faults(v(n))
        found.append(_problem("warning", n, F.when(~unset(n) & (F.size(faults) > 0), F.concat(F.lit("weak: "), F.array_join(faults, ",")))))
    for n in KEYS:
        fault = key_fault(v(n))
        found.append(_problem(F.when(fault == "short", "warning").otherwise("error"), n, fault))
    found += [_problem("error", n, F.when(unset(n), F.lit("incomplete"))) for n in STORE]
    # these have defaults, which only an empty value takes away
    found += [_problem("error", n, F.when(v(n) == "", F.lit("incomplete"))) for n in WITH_DEFAULTS]
    for n, (least, most) in RANGES.items():
        fault = range_fault(v(n), least, most)
        found.append(_problem(F.when(fault == "not_a_number", "error").otherwise("warning"), n, fault))
    some = ~unset(MAIL[0])
    for n in MAIL[1:]:
        some = some | ~unset(n)
    found += [_problem("warning", n, F.when(some & unset(n), F.lit("incomplete"))) for n in MAIL]
    found.append(_problem("warning", WEBHOOK, F.when(~unset(WEBHOOK) & ~F.startswith(v(WEBHOOK), F.lit(WEBHOOK_START)), F.lit("bad_url"))))
    return wide.select(scope, F.explode(F.array_compact(F.array(*found))).alias("p")).select(scope, "p.*")


def config_format(json: Column) -> Column:
    """new, old or unknown, by the sections of a configuration in JSON; unknown for null and for what is no object."""
    has = lambda n: F.coalesce(F.array_contains(F.json_object_keys(json), n), F.lit(False))
    is_object = F.startswith(F.coalesce(F.get_json_object(json, "$.fields"), F.lit("")), F.lit("{"))
    return F.when(has("site_info") & has("target_pages"), "new").when(has("fields") & is_object, "old").otherwise("unknown")


def missing_sections(json: Column, sections: Sequence[str]) -> Column:
    """Sections that a configuration in JSON lacks, in the order given; all of them for null and for what is no object."""
    keys = F.coalesce(F.json_object_keys(json), F.array().cast("array<string>"))
    return F.array_except(F.array(*map(F.lit, sections)), keys)


def checked_configs(configs: DataFrame, json: str = "json") -> DataFrame:
    """``configs`` with ``format``, ``missing`` (sections of that format; null for an unknown one) and ``valid``; columns of these names are replaced."""
    text = F.col(f"`{json}`")
    out = configs.withColumn("format", config_format(text))
    out = out.withColumn("missing", F.when(F.col("format") == "new", missing_sections(text, NEW_SECTIONS)).when(F.col("format") == "old", missing_sections(text, OLD_SECTIONS)))
    return out.withColumn("valid", F.coalesce(F.size("missing") == 0, F.lit(False)))
