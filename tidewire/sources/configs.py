"""Site configurations: YAML or JSON files under a folder as a table, and the rules in them as rows.

The YAML read is what configurations are written in: block and flow maps and lists, quoted and plain
scalars, literal and folded texts, comments. Anchors, tags and several documents in a file are faults.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = re.compile(r"""(?:"((?:[^"\\]|\\.)*)"|'((?:[^']|'')*)'|([^\s\[\]{},"'#&*!|>%@`-][^#:]*?(?:[#:][^\s:#][^#:]*?)*|-[^\s:][^:]*?))\s*:(?=\s|$)""")
ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "0": "\0", "\\": "\\", '"': '"', "/": "/", " ": " ", "a": "\a", "b": "\b", "e": "\x1b", "f": "\f", "v": "\v"}
WORDS = {"": None, "~": None} | {w: v for word, v in (("null", None), ("true", True), ("false", False), ("yes", True), ("no", False), ("on", True), ("off", False)) for w in (word, word.capitalize(), word.upper())}


class YamlError(ValueError):
    """The text is not in the YAML that is read."""


def unquoted(text: str, single: bool) -> str:
    if single:
        return text.replace("''", "'")

    def one(m: re.Match) -> str:
        code = m[1]
        if code[0] in "xuU" and len(code) > 1:
            return chr(int(code[1:], 16))
        if code not in ESCAPES:
            raise YamlError(f"escape \\{code} is not known")
        return ESCAPES[code]

    return re.sub(r"(?s)\\(x[0-9A-Fa-f]{2}|u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", one, text)


def scalar(text: str):
    """What a plain scalar stands for: null, a truth value, a number or itself."""
    if text in WORDS:
        return WORDS[text]
    if re.fullmatch(r"[+-]?(0|[1-9][0-9_]*)", text):
        return int(text.replace("_", ""))
    if re.fullmatch(r"0x[0-9a-fA-F]+", text):
        return int(text, 16)
    if re.fullmatch(r"[+-]?([0-9][0-9_]*\.[0-9_]*|\.[0-9]+)([eE][+-]?[0-9]+)?", text):
        return float(text.replace("_", ""))
    if text[:1] in ("&", "*", "!", "%", "@", "`"):
        raise YamlError(f"{text[:20]!r}: anchors, aliases, tags and directives are not read")
    return text


def bare(line: str) -> str:
    """A line less its comment, which begins at a # after white space and outside quotes."""
    quote = ""
    for i, c in enumerate(line):
        if quote:
            # within double quotes a backslash takes the next character's meaning away
            if c == quote and not (quote == '"' and (len(line[:i]) - len(line[:i].rstrip("\\"))) % 2):
                quote = ""
        elif c in "\"'" and (i == 0 or line[i - 1] in " \t[{,:-"):
            quote = c
        elif c == "#" and (i == 0 or line[i - 1] in " \t"):
            return line[:i].rstrip()
    return line.rstrip()


class Flow:
    """Maps and lists in brackets, which may go over lines."""

    def __init__(self, text: str) -> None:
        self.text, self.at = text, 0

    def skip(self) -> str:
        while self.at < len(self.text) and self.text[self.at] in " \t\n":
            self.at += 1
        return self.text[self.at : self.at + 1]

    def value(self, ends: str):
        c = self.skip()
        if c in ("[", "{"):
            return self.items(c)
        if c in ("'", '"'):
            m = re.compile(r"'((?:[^']|'')*)'|\"((?:[^\"\\]|\\.)*)\"", re.DOTALL).match(self.text, self.at)
            if not m:
                raise YamlError(f"a quote is not closed: {self.text[self.at:self.at + 30]!r}")
            self.at = m.end()
            return unquoted(m[1] if m[1] is not None else m[2], m[1] is not None)
        m = re.compile(rf"(?:[^{re.escape(ends)}:]|:(?=[^\s{re.escape(ends)}]))*").match(self.text, self.at)
        self.at = m.end()
        return scalar(" ".join(m.group().split()))

    def items(self, opening: str):
        closing = {"[": "]", "{": "}"}[opening]
        self.at += 1
        out: list = []
        while True:
            c = self.skip()
            if c == "":
                raise YamlError(f"{opening} is not closed")
            if c == closing:
                self.at += 1
                return out if opening == "[" else dict(out)
            if out or c == ",":
                if c != ",":
                    raise YamlError(f"a comma expected before {self.text[self.at:self.at + 20]!r}")
                self.at += 1
                if self.skip() == closing:
                    continue
            one = self.value(",]}")
            if self.skip() == ":":
                self.at += 1
                pair = (_name(one), None if self.skip() in (",", closing) else self.value(",]}"))
                out.append(pair if opening == "{" else dict([pair]))
            else:
                out.append((_name(one), None) if opening == "{" else one)


def _name(key) -> str:
    return key if isinstance(key, str) else json.dumps(key)


class Block:
    """Lines with their indents, read as maps, lists and scalars."""

    def __init__(self, text: str) -> None:
        self.raw = text.expandtabs(8).replace("\r\n", "\n").split("\n")
        self.at = 0
        self.lines: list[tuple[int, str, int]] = []
        for n, line in enumerate(self.raw):
            content = bare(line)
            if content.strip() and not (content.startswith("---") and not content[3:].strip() and not self.lines):
                if content.startswith(("---", "...")):
                    raise YamlError("several documents")
                self.lines.append((len(content) - len(content.lstrip()), content.strip(), n))

    def now(self) -> tuple[int, str, int]:
        return self.lines[self.at] if self.at < len(self.lines) else (-1, "", len(self.raw))

    def whole(self):
        if not self.lines:
            return None
        out = self.node(self.now()[0])
        if self.at < len(self.lines):
            raise YamlError(f"line {self.now()[2] + 1}: {self.now()[1][:40]!r} does not fit in")
        return out

    def node(self, indent: int):
        content = self.now()[1]
        if content == "-" or content.startswith("- "):
            return self.sequence(indent)
        if content[0] not in "[{" and KEY.match(content):
            return self.mapping(indent)
        self.at += 1
        return self.value(content, indent - 1)

    def sequence(self, indent: int) -> list:
        out = []
        while self.now()[0] == indent and (self.now()[1] == "-" or self.now()[1].startswith("- ")):
            _, content, n = self.now()
            rest = content[1:].lstrip()
            if rest:
                inner = indent + len(content) - len(rest)
                self.lines[self.at] = (inner, rest, n)
                out.append(self.node(inner))
            else:
                self.at += 1
                out.append(self.node(self.now()[0]) if self.now()[0] > indent else None)
        return out

    def mapping(self, indent: int) -> dict:
        out = {}
        while self.now()[0] == indent:
            content = self.now()[1]
            m = KEY.match(content)
            if not m:
                raise YamlError(f"line {self.now()[2] + 1}: a key expected in {content[:40]!r}")
            key = unquoted(m[1], False) if m[1] is not None else unquoted(m[2], True) if m[2] is not None else m[3].strip()
            rest = content[m.end() :].strip()
            self.at += 1
            if rest:
                out[key] = self.value(rest, indent)
            elif self.now()[0] > indent or self.now()[0] == indent and (self.now()[1] == "-" or self.now()[1].startswith("- ")):
                out[key] = self.node(self.now()[0])
            else:
                out[key] = None
        if self.now()[0] > indent:
            raise YamlError(f"line {self.now()[2] + 1}: {self.now()[1][:40]!r} is too far in")
        return out

    def value(self, text: str, indent: int):
        """A value that begins in the line before the current one, within ``indent``."""
        if m := re.fullmatch(r"([|>])([+-]?)\d*", text):
            return self.text(m[1] == "|", m[2], indent)
        if text[0] in "[{'\"":
            while True:
                flow = Flow(text)
                try:
                    out = flow.value("")
                    break
                except YamlError:
                    if self.now()[0] < 0:
                        raise
                    text, self.at = f"{text}\n{self.now()[1]}", self.at + 1
            if flow.skip():
                raise YamlError(f"{text[flow.at:flow.at + 20]!r} not expected after a value")
            return out
        while self.now()[0] > indent and self.at < len(self.lines):
            text, self.at = f"{text} {self.now()[1]}", self.at + 1
        if re.search(r":(\s|$)", text):
            raise YamlError(f"a map cannot stand in a line's value: {text[:40]!r}")
        return scalar(text)

    def text(self, literal: bool, end: str, indent: int) -> str:
        first = self.lines[self.at - 1][2] + 1
        last = first
        while last < len(self.raw) and (not self.raw[last].strip() or len(self.raw[last]) - len(self.raw[last].lstrip()) > indent):
            last += 1
        while self.at < len(self.lines) and self.lines[self.at][2] < last:
            self.at += 1
        rows = self.raw[first:last]
        margin = min((len(r) - len(r.lstrip()) for r in rows if r.strip()), default=0)
        body = "\n".join(r[margin:].rstrip() if not r.strip() else r[margin:] for r in rows)
        tail = body[len(body.rstrip("\n")) :]
        body = body.rstrip("\n")
        if not literal:
            body = re.sub(r"(?<=\S)\n(?=\S)", " ", body)
            body = re.sub(r"\n\n+", lambda m: m.group()[1:], body)
        return body + ("" if end == "-" else "\n" + tail if end == "+" else "\n" if body else "")


def yaml_value(text: str):
    """What a YAML text (or a JSON one) stands for."""
    return Block(text.removeprefix("﻿")).whole()


def _as_json(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        found, why = [], []
        for text in batch.to_pylist():
            value, fault = None, None
            try:
                value = None if text is None else json.dumps(yaml_value(text), ensure_ascii=False)
            except (ValueError, RecursionError) as e:
                fault = str(e)[:300]
            found.append(value)
            why.append(fault)
        yield pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array(why, pa.string())], ["json", "error"])


def site_configs(spark: SparkSession, path: str) -> DataFrame:
    """(site, path, json, error): each YAML or JSON file under a folder, however deep, named by its stem.

    A file that cannot be read has a null ``json`` and the reason; the others stand. Empty files are none.
    """
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{yaml,yml,json}").text(path, wholetext=True)
    read = files.select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.[A-Za-z]+$", 1).alias("site"), F.input_file_name().alias("path"), "value")
    parsed = read.select("site", "path", F.arrow_udf(_as_json, "json string, error string").asNondeterministic()(F.col("value")).alias("c"))
    return parsed.select(F.url_decode("site").alias("site"), "path", "c.json", "c.error")


_FIELD = "map<string, struct<method: string, selector: string, attr: string, type: string, multiple: boolean, required: boolean>>"


def field_rules(configs: DataFrame) -> DataFrame:
    """(site, page_type, field, method, selector, attr, kind, multiple, required) of configurations; page_type is null for what holds on all pages."""
    pages = f"struct<fields: {_FIELD}, list_items: struct<container: string, max_items: int, fields: {_FIELD}>>"
    c = configs.where(F.col("json").isNotNull()).select("site", F.from_json("json", f"extraction struct<fields: {_FIELD}, list_page: {pages}, detail_page: {pages}>").alias("c"))
    parts = [(None, "c.extraction.fields"), *((p, f"c.extraction.{p}.fields") for p in ("list_page", "detail_page")), ("list_item", "c.extraction.list_page.list_items.fields")]
    every = F.flatten(F.array(*[_entries(page, at) for page, at in parts]))
    rows = c.select("site", F.explode(every).alias("r")).select("site", "r.page_type", "r.field", "r.v.*")
    return rows.select("site", "page_type", "field", F.coalesce("method", F.lit("xpath")).alias("method"), "selector", "attr", F.coalesce("type", F.lit("string")).alias("kind"), F.coalesce("multiple", F.lit(False)).alias("multiple"), F.coalesce("required", F.lit(False)).alias("required"))


def _entries(page: str | None, at: str):
    return F.transform(F.map_entries(F.coalesce(F.col(at), F.create_map().cast(_FIELD))), lambda e: F.struct(F.lit(page).cast("string").alias("page_type"), e["key"].alias("field"), e["value"].alias("v")))


def validation_rules(configs: DataFrame) -> DataFrame:
    """(site, field, required, kind, min_length, max_length, pattern, minimum, maximum): the rules that configurations state, as ``rules.errors_by_table`` takes them."""
    kind = "struct<type: string, min_length: int, max_length: int, pattern: string, minimum: double, maximum: double>"
    c = configs.where(F.col("json").isNotNull()).select("site", F.from_json("json", f"validation struct<required_fields: array<string>, field_rules: map<string, {kind}>>").alias("c"))
    c = c.select("site", F.coalesce("c.validation.required_fields", F.array().cast("array<string>")).alias("needed"), F.coalesce("c.validation.field_rules", F.create_map().cast(f"map<string, {kind}>")).alias("said"))
    names = F.array_union("needed", F.map_keys("said"))
    rows = c.select("site", "needed", "said", F.explode(names).alias("field"))
    r = F.try_element_at("said", F.col("field"))
    return rows.select("site", "field", F.array_contains("needed", F.col("field")).alias("required"), r["type"].alias("kind"), *[r[k].alias(k) for k in ("min_length", "max_length", "pattern", "minimum", "maximum")])
