"""Field extraction by rules: regular expressions, JSON paths and typed casts as Columns; selectors over HTML in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, MapType, StringType, StructField, StructType

from .dates import any_date
from .selectors import Node, SelectorError, Tree, compiled, select, values
from .text import strip, tight_dashes

# Signs of a redirect by script, and content types that are text.
REDIRECTS = (r"window\.location", r"document\.location", r"location\.href", r"location\.replace", r"meta.*refresh")
TEXT_TYPES = ("text/html", "text/plain", "application/xhtml+xml", "application/xml", "application/json")


def by_pattern(col: Column, pattern: str, group: int = 1) -> Column:
    """All matches of a pattern whose dots stand for line feeds too."""
    return F.regexp_extract_all(col, F.lit(f"(?s){pattern}"), F.lit(group))


def by_path(col: Column, path: str) -> Column:
    """The value at a dotted path of JSON objects; null if there is none."""
    return F.get_json_object(col, "$." + path)


def cast_value(col: Column, kind: str) -> Column:
    """A text as string (stripped), integer (its first digits, or 0), float (its first number, or 0), date or list (of itself).

    A date is one in any of the known forms, as yyyy-MM-ddTHH:mm:ss and the offset it states (midnight
    without a time); a text without one stays as it is.
    """
    if kind == "date":
        part = lambda g: F.regexp_extract(col, r"(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\.\d+)?\s*(Z|[+-]\d{2}:?\d{2}(?!\d))?", g)
        time = F.concat_ws(":", *[F.lpad(part(g), 2, "0") for g in (1, 2, 3)])
        offset = F.regexp_replace(F.when(part(4) == "Z", "+00:00").otherwise(part(4)), r"^([+-]\d{2})(\d{2})$", "$1:$2")
        return F.coalesce(F.concat(any_date(col).cast("string"), F.lit("T"), time, offset), col)
    if kind == "integer":
        return F.coalesce(F.nullif(F.regexp_extract(col, r"\d+", 0), F.lit("")).try_cast("bigint"), F.when(col.isNotNull(), F.lit(0).cast("bigint")))
    if kind == "float":
        return F.coalesce(F.nullif(F.regexp_extract(col, r"\d+\.?\d*", 0), F.lit("")).try_cast("double"), F.when(col.isNotNull(), F.lit(0.0)))
    if kind == "list":
        return F.when(col.isNotNull(), F.array(col))
    return strip(col)


def strict_value(col: Column, kind: str) -> Column:
    """A text that reads as the kind as a whole; else null."""
    return strip(col).try_cast({"integer": "bigint", "float": "double"}[kind]) if kind in ("integer", "float") else strip(col)


def first_filled(*cols: Column) -> Column:
    """The first of several fallbacks that is not blank, stripped."""
    return F.coalesce(*[F.nullif(strip(c), F.lit("")) for c in cols])


def opening(col: Column, n: int = 1000) -> Column:
    return F.substring(col, 1, n)


def is_text(content_type: Column) -> Column:
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    out = F.lit(False)
    for t in TEXT_TYPES:
        out = out | F.contains(kind, F.lit(t))
    return out


def _gbk(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    def text(data: bytes) -> str:
        try:
            return data.decode("gbk")
        except UnicodeDecodeError:
            return data.decode("latin-1")

    for batch in batches:
        yield pa.array([None if d is None else text(d) for d in batch.to_pylist()], pa.string())


def decoded(data: Column) -> Column:
    """Bytes as UTF-8; only those that are none go to Python and are read as GBK or, failing that, Latin-1."""
    plain_text = data.cast("string")
    valid = F.is_valid_utf8(plain_text)
    return F.when(valid, plain_text).otherwise(F.arrow_udf(_gbk, StringType())(F.when(~valid, data)))


def redirects_by_script(status: Column, content_type: Column, body: Column) -> Column:
    low, out = F.lower(body), F.lit(False)
    for p in REDIRECTS:
        out = out | low.rlike(f"(?d){p}")
    return (status == 200) & F.contains(content_type, F.lit("text/html")) & out


def count_tags(html: Column, tag: str, attribute: str = "") -> Column:
    """Opening tags of a kind, with an attribute if one is named."""
    return F.regexp_count(html, F.lit(rf"(?i)<{tag}\s[^>]*{attribute}" if attribute else rf"(?i)<{tag}[\s>]")).cast("long")


def page_features(html: Column) -> dict[str, Column]:
    return {
        "n_chars": F.length(html).cast("long"), "n_links": count_tags(html, "a", "href"), "n_images": count_tags(html, "img", "src"), "n_paragraphs": count_tags(html, "p"),
        "has_form": count_tags(html, "form") > 0, "has_table": count_tags(html, "table") > 0, "has_nav": count_tags(html, "nav") > 0,
        "has_aside": count_tags(html, "aside") > 0, "has_footer": count_tags(html, "footer") > 0, "has_header": count_tags(html, "header") > 0,
        "main": F.when(count_tags(html, "main") > 0, "main").when(count_tags(html, "article") > 0, "article"),
    }


def plain(html: Column) -> Column:
    """Text between tags."""
    return F.regexp_replace(html, r"<[^>]+>", "")


def looks_like_list(html: Column) -> Column:
    """At least five links and at least three list links or three dates."""
    listed = F.regexp_count(html, F.lit(r"(?is)<li[^>]*>\s*<a[\s>]")) >= 3
    dates = F.regexp_count(plain(html), F.lit(r"\d{4}[-/年]\d{1,2}[-/月]\d{1,2}")) >= 3
    return (count_tags(html, "a", "href") >= 5) & (listed | dates)


def looks_like_detail(html: Column) -> Column:
    """An article of over 200 characters, or over 1000 characters and a heading."""
    article = F.regexp_extract(html, r"(?is)<article[^>]*>(.*?)</article>", 1)
    return (F.length(plain(article)) > 200) | ((F.length(plain(html)) > 1000) & ((count_tags(html, "h1") > 0) | (count_tags(html, "h2") > 0)))


def page_class(url: Column, html: Column) -> Column:
    """list_page, detail_page or unknown_page, by URL words and content together, else by content."""
    u, lists, details = F.lower(url), looks_like_list(html), looks_like_detail(html)
    return (
        F.when(u.rlike("list|index|category|列表") & lists, "list_page").when(u.rlike("detail|article|news|详情|新闻") & details, "detail_page")
        .when(lists, "list_page").when(details, "detail_page").otherwise("unknown_page")
    )


def classified(url: Column, features: Mapping[str, Column], rules: Mapping[str, Mapping]) -> Column:
    """The first type whose rules hold: ``url`` patterns (any), ``least`` features (all). Null if none does."""
    out = F.lit(None).cast("string")
    for name, rule in reversed(rules.items()):
        any_url = F.lit(False)
        for p in rule.get("url", ()):
            any_url = any_url | url.rlike(p)
        least = F.lit(bool(rule.get("least")))
        for f, n in rule.get("least", {}).items():
            least = least & (features[f] >= n)
        out = F.when(any_url | least, name).otherwise(out)
    return out


def _sources(several: str | Sequence[str]) -> list[str]:
    return [several] if isinstance(several, str) else list(several)


def _cannot(f: str, field: Mapping) -> str | None:
    """Why a field's selectors cannot be read; None if they can."""
    try:
        for one in _sources(field["selector"]):
            compiled(one, field.get("method"))
    except (SelectorError, KeyError) as e:
        return f"{f}: {e}"
    return None


def only_references(html: Column, names: Sequence[str]) -> Column:
    """``html`` in which all but the named character references (with their semicolon) stand for themselves."""
    return F.regexp_replace(html, f"&(?!(?:{'|'.join(names)});)", "&amp;")


def select_fields(pages: DataFrame, keep: Sequence[str], fields: Mapping[str, Mapping], html: str = "html", errors: str | None = None, references: Sequence[str] | None = None) -> DataFrame:
    """``keep`` columns and, for each field, an array of the values that its selector finds.

    A field is {selector, attr (text, if not stated), method (css or xpath, if it is not to be told
    from the selector)}; alternatives of ``selector`` given as a list are tried in order until one
    finds something. Null pages have null fields. A page is parsed once for all fields. Without
    ``errors`` a selector that cannot be read is an error of the call; with it, such a field is
    null, as is one that fails on a page, and the column of that name maps the field to the reason.
    ``references`` names the character references that are read (None: all of HTML's, with or without semicolon).
    """
    problems = {f: why for f, say in fields.items() if (why := _cannot(f, say))}
    if problems and errors is None:
        raise SelectorError("; ".join(problems.values()))
    good = {f: say for f, say in fields.items() if f not in problems}

    def of(root: Node, field: Mapping) -> list[str]:
        for one in _sources(field["selector"]):
            if found := [v for v in values(root, one, field.get("attr"), field.get("method")) if v]:
                return found
        return []

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kinds = [*[pa.list_(pa.string())] * len(good), pa.map_(pa.string(), pa.string())]
        for batch in batches:
            columns: list[list] = [[] for _ in kinds]
            for h in batch.to_pylist():
                root, failed = None if h is None else Tree(h).root, dict(problems)
                for out, (f, say) in zip(columns, good.items(), strict=False):
                    try:
                        out.append(None if root is None else of(root, say))
                    except Exception as e:  # whatever a page does to one field, the others stand
                        out.append(None)
                        failed[f] = f"{f}: {e}"
                columns[-1].append(list(failed.items()))
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*(f"f{i}" for i in range(len(good))), "errors"])

    schema = StructType([*(StructField(f"f{i}", ArrayType(StringType())) for i in range(len(good))), StructField("errors", MapType(StringType(), StringType()))])
    read = F.col(html) if references is None else only_references(F.col(html), references)
    found = F.arrow_udf(run, schema).asNondeterministic()(read)
    at, none = {f: f"__f.f{i}" for i, f in enumerate(good)}, F.lit(None).cast("array<string>")
    columns = [(F.col(at[f]) if f in at else none).alias(f) for f in fields]
    return pages.select(*keep, found.alias("__f")).select(*keep, *columns, *([F.col("__f.errors").alias(errors)] if errors else []))


def list_rows(pages: DataFrame, keep: Sequence[str], container: str, fields: Mapping[str, Mapping], html: str = "html", most: int | None = 50, needed: Sequence[str] = (), base_url: Column | str | None = None, links: Sequence[str] = ("url",)) -> DataFrame:
    """``keep`` columns, ``index`` (from 1) and the fields of each list element, at most ``most`` a page (None: all); only those with some field, and all of ``needed``.

    Dates lose the white space around their dashes. With ``base_url``, site-relative ``links`` (from /) get it in front.
    """
    for f, say in fields.items():
        for one in _sources(say.get("selector", "")):
            if one and (why := _cannot(f, {"selector": one})):
                raise SelectorError(why)

    def rows_of(root: Node) -> list[dict]:
        out = []
        for i, node in enumerate(select(root, container)[:most], 1):
            row = {}
            for f, say in fields.items():
                for one in _sources(say.get("selector", "")):
                    got = values(node, one or ".", say.get("attr"))
                    if found := [v for v in got if v and (not say.get("holds") or re.search(say["holds"], v))]:
                        row[f] = found[0]
                        break
            if row and all(row.get(f) for f in needed):
                out.append({"index": i, **{f: row.get(f) for f in fields}})
        return out

    compiled(container)
    kind = pa.list_(pa.struct([("index", pa.int32()), *((f, pa.string()) for f in fields)]))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([[] if h is None else rows_of(Tree(h).root) for h in batch.to_pylist()], kind)

    schema = "array<struct<index: int, " + ", ".join(f"{f}: string" for f in fields) + ">>"
    base = None if base_url is None else F.rtrim(base_url if isinstance(base_url, Column) else F.lit(base_url), F.lit("/"))
    rows = pages.select(*keep, *([] if base is None else [base.alias("__base")]), F.explode(F.arrow_udf(run, schema).asNondeterministic()(F.col(html))).alias("__r")).select(*keep, *([] if base is None else ["__base"]), "__r.*")
    if base is not None:
        for link in links:
            if link in fields:
                rows = rows.withColumn(link, F.when(F.startswith(link, F.lit("/")) & ~F.startswith(link, F.lit("//")), F.concat("__base", link)).otherwise(F.col(link)))
        rows = rows.drop("__base")
    return rows.withColumn("date", tight_dashes(F.col("date"))) if "date" in fields else rows


def _pattern_error(spark, pattern: str) -> str | None:
    """Why Spark cannot read a pattern; None if it can. Asked of one literal, without a job over data."""
    try:
        spark.sql("select regexp_count('', :p)", args={"p": f"(?s){pattern}"}).collect()
    except Exception as e:
        return str(e).split("\n")[0][:200]
    return None


def groups_of(pattern: str) -> int:
    """Capturing groups of a pattern: opening brackets that are neither escaped nor in a class nor of another kind."""
    bare = re.sub(r"\\Q.*?(?:\\E|$)|\\.", "", pattern, flags=re.DOTALL)
    bare = re.sub(r"\[\^?\]?[^\]]*\]", "", bare)
    return len(re.findall(r"\((?!\?)|\(\?<(?![=!])", bare))


METHODS = ("css", "xpath", "regex", "json", "text")


def rule_values(pages: DataFrame, keep: Sequence[str], rules: Mapping[str, Mapping], html: str = "html", errors: str | None = None, references: Sequence[str] | None = None) -> DataFrame:
    """``keep`` columns and a value for each field by its rule: {method: css, xpath, regex, json, text; selector; attr; type; multiple}.

    A value that is not found is null, whatever the other fields give. A field whose rule cannot be
    read (an unknown method, a selector or pattern with a fault) or fails on a page is null too and
    costs the others nothing; ``errors`` names a column that maps each such field to the reason.
    ``multiple`` gives all values as an array, or with the type string as one text, joined by spaces.
    A pattern with several groups gives its groups joined by tabs. ``references`` names the character
    references that css and xpath read (None: all of HTML's).
    """
    problems: dict[str, str] = {}
    chosen = {}
    for f, r in rules.items():
        method = r.get("method", "xpath")
        if method not in METHODS:
            problems[f] = f"{f}: method {method!r} is not known"
        elif method != "text" and not r.get("selector"):
            problems[f] = f"{f}: no selector"
        elif method == "regex" and (why := _pattern_error(pages.sparkSession, r["selector"])):
            problems[f] = f"{f}: {why}"
        elif method in ("css", "xpath"):
            chosen[f] = {**r, "method": method}
    own = errors or "__errors"
    base = select_fields(pages, [*keep, html], {f"__v{i}": r for i, r in enumerate(chosen.values())}, html, own, references) if chosen else pages.select(*keep, html, F.create_map().cast("map<string,string>").alias(own))
    at = {f: f"__v{i}" for i, f in enumerate(chosen)}
    out = []
    for f, r in rules.items():
        method = r.get("method", "xpath")
        if f in problems:
            out.append(F.lit(None).cast("array<string>" if r.get("multiple") else "string").alias(f))
            continue
        if f in at:
            found = F.col(at[f])
        elif method == "regex":
            n = groups_of(r["selector"])
            groups = [by_pattern(F.col(html), r["selector"], g) for g in range(min(n, 1), n + 1)]
            found = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: F.concat_ws("\t", x, y)), groups)
        elif method == "json":
            found = F.array_compact(F.array(by_path(F.col(html), r["selector"])))
        else:
            found = F.array(strip(plain(F.col(html))))
        kind = r.get("type", "string")
        many = F.transform(found, strip)
        joined = strip(F.array_join(F.nullif(many, F.array().cast("array<string>")), " ")) if r.get("type") == "string" else many
        one = joined if r.get("multiple") else cast_value(F.get(found, F.lit(0)), kind)
        out.append(one.alias(f))
    if errors is None:
        return base.select(*keep, *out)
    back = F.create_map(*[x for f, v in at.items() for x in (F.lit(v), F.lit(f))]) if at else None
    met = F.col(own) if back is None else F.map_from_entries(F.transform(F.map_entries(own), lambda e: F.struct(back[e["key"]].alias("key"), F.concat(back[e["key"]], F.lit(": "), F.regexp_replace(e["value"], "^__v[0-9]+: ", "")).alias("value"))))
    stated = F.create_map(*[F.lit(x) for kv in problems.items() for x in kv]) if problems else None
    return base.select(*keep, *out, (F.map_concat(met, stated) if stated is not None else met).alias(errors))


def classify_pages(pages: DataFrame, types: Mapping[str, Mapping], url: str = "url", html: str = "html", output: str = "page_type") -> DataFrame:
    """``pages`` with the first type whose rules hold, else the type that URL words and content suggest.

    A type's rules are {url_patterns: [...], content_features: {min_links, keywords, min_content_length},
    structure_features: {required_selectors: [...], min_elements: {selector: n}}}. It holds if any
    pattern is found in the lower-case URL, or if all its content features do, or all its structure
    features. A type with a fault (a selector or pattern that cannot be read) holds only by what
    comes before the fault in that order. Selectors are counted in one pass over a page, the rest is Columns.
    """
    wanted: dict[str, None] = {}
    for say in types.values():
        features = say.get("structure_features") or {}
        if not any(_cannot("", {"selector": s}) for s in (*features.get("required_selectors", ()), *features.get("min_elements", ()))):
            wanted |= dict.fromkeys((*features.get("required_selectors", ()), *features.get("min_elements", ())))
    names = list(wanted)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([None if h is None else _counts(Tree(h).root, names) for h in batch.to_pylist()], pa.list_(pa.int64()))

    counts = F.arrow_udf(run, ArrayType(LongType())).asNondeterministic()(F.col(html)) if names else F.array().cast("array<bigint>")
    low, text = F.lower(F.coalesce(F.col(url), F.lit(""))), F.lower(F.col(html))
    out = page_class(F.col(url), F.col(html))
    for name, say in reversed(types.items()):
        holds = F.lit(False)
        broken = False
        for p in say.get("url_patterns") or ():
            broken = broken or _pattern_error(pages.sparkSession, p) is not None
            holds = holds if broken else holds | low.rlike(p)
        if (content := say.get("content_features")) and not broken:
            least = F.lit(True)
            if content.get("min_links", 0) > 0:
                least = least & (count_tags(F.col(html), "a", "href") >= content["min_links"])
            for k in content.get("keywords") or ():
                least = least & F.contains(text, F.lit(k.lower()))
            if content.get("min_content_length", 0) > 0:
                least = least & (F.length(html) >= content["min_content_length"])
            holds = holds | least
        structure = {} if broken else say.get("structure_features") or {}
        needs = [*((s, 1) for s in structure.get("required_selectors") or ()), *(structure.get("min_elements") or {}).items()]
        if needs and all(s in wanted for s, _ in needs):
            every = F.lit(True)
            for s, n in needs:
                every = every & (F.col("__counts")[names.index(s)] >= n)
            holds = holds | every
        out = F.when(holds, name).otherwise(out)
    kept = [F.col(f"`{c}`") for c in pages.columns if c != output]
    return pages.withColumn("__counts", counts).select(*kept, out.alias(output))


def _counts(root: Node, names: Sequence[str]) -> list[int]:
    out = []
    for s in names:
        try:
            out.append(len(select(root, s)))
        except SelectorError:  # a call that gives no nodes: counts as found if it gives something
            out.append(int(bool(values(root, s)[0])))
    return out
