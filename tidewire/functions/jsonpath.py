"""JSON paths with wildcards, slices and descent, through Variant columns.

A path is read into steps on the driver. Steps over names, places, slices and all members are Columns over
arrays of variants; a path with a descent (``..``), whose depth only the value knows, is walked in
Arrow batches. Members of an object come in the order of their names, as Variant keeps them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = re.compile(r"""(?P<deep>\.\.(?=[\w*\[]))?(?:(?(deep)|\.)(?P<name>[^\s.\[\]'"*:,|()?@$]+)|(?(deep)|\.)(?P<star>\*)|\[\s*(?P<inside>(?:'[^']*'|"[^"]*"|[^\[\]'"])*)\])""")


class PathError(ValueError):
    """The path cannot be read."""


class Step(NamedTuple):
    deep: bool
    #: names, places, slices; an empty tuple is all members
    options: tuple[str | int | slice, ...]


def steps(path: str) -> tuple[Step, ...]:
    """``$.a['b'][0][-1][1:3][*].*..c['d','e']``; the dollar and the first dot may be missing."""
    text = path.strip()
    text = text[1:] if text.startswith("$") else text if text[:1] in (".", "[") else f".{text}"
    out, at = [], 0
    while at < len(text):
        m = TOKEN.match(text, at)
        if not m:
            raise PathError(f"unreadable at {text[at:at + 20]!r} in {path!r}")
        at = m.end()
        if m["name"] is not None:
            options: tuple = (m["name"],)
        elif m["star"] or m["inside"].strip() == "*":
            options = ()
        else:
            options = tuple(_option(o.strip(), path) for o in re.findall(r"'[^']*'|\"[^\"]*\"|[^,'\"]+", m["inside"]) if o.strip())
            if not options:
                raise PathError(f"nothing in brackets in {path!r}")
        out.append(Step(bool(m["deep"]), options))
    return tuple(out)


def _option(text: str, path: str) -> str | int | slice:
    if text[0] in "'\"":
        return text[1:-1]
    if re.fullmatch(r"-?\d+", text):
        return int(text)
    if m := re.fullmatch(r"(-?\d+)?\s*:\s*(-?\d+)?(?:\s*:\s*(\d+)?)?", text):
        every = int(m[3] or 1)
        if every < 1:
            raise PathError(f"a slice's step is at least 1 in {path!r}")
        return slice(*(int(x) if x else None for x in m.groups()[:2]), every)
    raise PathError(f"{text!r} is neither a name, a place nor a slice in {path!r}")


def members(value) -> list:
    return [value[k] for k in sorted(value)] if isinstance(value, dict) else value if isinstance(value, list) else []


def walked(values: list, path: tuple[Step, ...]) -> list:
    """The plain form: what the steps lead to from parsed values."""
    for deep, options in path:
        if deep:
            every, todo = [], values[::-1]
            while todo:
                if below := members(v := todo.pop()):  # no step leads on from the others
                    every.append(v)
                    todo += below[::-1]
            values = every
        found = []
        for v in values:
            if not options:
                found += members(v)
            for o in options:
                if isinstance(o, str):
                    found += [v[o]] if isinstance(v, dict) and o in v else []
                elif isinstance(v, list):
                    found += v[o] if isinstance(o, slice) else [v[o]] if -len(v) <= o < len(v) else []
        values = found
    return values


def shown(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"), sort_keys=True)


def _arrow(path: tuple[Step, ...]):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for text in batch.to_pylist():
                try:
                    out.append(None if text is None else [shown(v) for v in walked([json.loads(text)], path)])
                except (ValueError, RecursionError):
                    out.append(None)
            yield pa.array(out, pa.list_(pa.string()))

    return run


def _one(v: Column, option: str | int | slice) -> Column:
    """The variants that one option leads to from one variant."""
    if isinstance(option, str):
        return F.array(F.try_variant_get(v, f"$['{option}']", "variant"))
    whole = F.try_variant_get(v, "$", "array<variant>")
    if isinstance(option, int):
        return F.array(F.get(whole, F.lit(option)) if option >= 0 else F.get(whole, F.size(whole) + option))
    n = F.size(whole)
    bound = lambda x, default: F.lit(default) if x is None else F.least(F.lit(x), n) if x >= 0 else F.greatest(n + x, F.lit(0))
    first, last = bound(option.start, 0), n if option.stop is None else bound(option.stop, 0)
    part = F.slice(whole, first + 1, F.greatest(last - first, F.lit(0)))
    return part if option.step == 1 else F.filter(part, lambda _, i: i % option.step == 0)


def _plain(step: Step) -> str | None:
    """A step to one name or to one place from the front, as a part of a Variant path; None for others."""
    option = step.options[0] if len(step.options) == 1 else None
    return f"['{option}']" if isinstance(option, str) else f"[{option}]" if isinstance(option, int) and option >= 0 else None


def json_values(col: Column, path: str, parsed: Column | None = None) -> Column:
    """All values at a path of a JSON text, as texts (objects and arrays as JSON, JSON's null as null); null for what is no JSON.

    ``parsed`` is the text's Variant where several paths share one.
    """
    read = steps(path)
    if any(s.deep or any(isinstance(o, str) and "'" in o for o in s.options) for s in read):
        return F.arrow_udf(_arrow(read), "array<string>")(col)
    doc = F.try_parse_json(col) if parsed is None else parsed
    now = F.array(doc)
    for plain, run in groupby(read, lambda s: _plain(s) is not None):
        if plain:  # one look-up for all steps of the run
            now = _looked_up(now, "$" + "".join(map(_plain, run)))
        else:
            now = _led_on(now, run)
    return F.when(doc.isNotNull(), F.transform(now, lambda v: v.cast("string")))


def _looked_up(now: Column, at: str) -> Column:
    return F.filter(F.transform(now, lambda v: F.try_variant_get(v, at, "variant")), lambda v: v.isNotNull())


def _led_on(now: Column, run: Iterator[Step]) -> Column:
    for _, options in run:
        if options:
            now = F.flatten(F.transform(now, _all_of(options)))
        else:
            now = F.flatten(F.transform(now, lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.map_values(F.try_variant_get(v, "$", "map<string,variant>")), F.array().cast("array<variant>"))))
        now = F.filter(now, lambda v: v.isNotNull())
    return now


def _all_of(options: tuple):
    return lambda v: F.concat(*[F.coalesce(_one(v, o), F.array().cast("array<variant>")) for o in options])


def json_value(col: Column, path: str, parsed: Column | None = None) -> Column:
    """The first value at a path; null if there is none."""
    return F.get(json_values(col, path, parsed), F.lit(0))


def reshaped(config: Column) -> Column:
    """An old flat site configuration (JSON text) in the nested form, as JSON text; null for what is no JSON.

    XPath fields become lists of selectors, the required ones of them are named, start URLs become target
    pages; what is not stated takes its default (fixed values).
    """
    url = "struct<url: string, description: string, type: string>"
    field = "struct<method: string, selector: string, required: boolean>"
    old = F.from_json(config, f"name string, base_url string, request_settings struct<delay: double, random_delay: boolean, retry_times: int, retry_delay: double>, follow struct<allow: array<string>, deny: array<string>>, start_urls array<{url}>, fields map<string, {field}>")
    or_else = lambda c, v: F.coalesce(c, F.lit(v))
    texts, name, ask = F.array().cast("array<string>"), or_else(old["name"], ""), old["request_settings"]
    pages = F.transform(F.coalesce(old["start_urls"], F.array().cast(f"array<{url}>")), lambda u: F.struct(u["url"].alias("url"), or_else(u["description"], "").alias("name"), or_else(u["type"], "list_page").alias("type")))
    paths = F.filter(F.map_entries(F.coalesce(old["fields"], F.create_map().cast(f"map<string, {field}>"))), lambda e: e["value"]["method"] == "xpath")
    selectors = F.map_from_entries(F.transform(paths, lambda e: F.struct(F.concat(e["key"], F.lit("_selectors")), F.array(e["value"]["selector"]))))
    needed = F.transform(F.filter(paths, lambda e: or_else(e["value"]["required"], False)), lambda e: e["key"])
    new = F.struct(
        F.struct(name.alias("name"), or_else(old["base_url"], "").alias("base_url"), F.concat(name, F.lit("数据爬取")).alias("description")).alias("site_info"),
        pages.alias("target_pages"),
        F.struct(F.lit("requests").alias("type"), F.lit(True).alias("headless"), F.struct(F.lit(30).alias("page_load"), F.lit(150).alias("explicit_wait")).alias("timeouts")).alias("browser_config"),
        selectors.alias("selectors"),
        F.struct(
            F.struct(or_else(ask["delay"], 2.0).alias("between_requests"), or_else(ask["random_delay"], True).alias("random_delay")).alias("delays"),
            F.struct(F.lit(10).alias("max_pages"), F.lit(30).alias("max_items_per_page")).alias("limits"),
            F.struct(or_else(ask["retry_times"], 3).alias("max_attempts"), or_else(ask["retry_delay"], 5.0).alias("retry_delay")).alias("retry"),
        ).alias("crawling_strategy"),
        F.struct(needed.alias("required_fields"), F.create_map().cast("map<string,string>").alias("cleaning_rules")).alias("data_extraction"),
        F.struct(F.coalesce(old["follow"]["allow"], texts).alias("allow"), F.coalesce(old["follow"]["deny"], texts).alias("deny")).alias("follow_rules"),
        F.struct(F.struct(F.lit("texts").alias("texts"), F.lit("data").alias("data"), F.lit("debug").alias("debug")).alias("directories"), F.lit("utf-8").alias("encoding")).alias("file_storage"),
    )
    return F.when(F.try_parse_json(config).isNotNull(), F.to_json(new))
