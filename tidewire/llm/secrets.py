"""Secret scans over content-addressed versions.

Every historical version of a file is named by the SHA-256 of its text. A ledger holds, for each
blob, the pairs of rule and version that were scanned, with what they found; only pairs it lacks are
scanned, each text once however many paths hold it, and findings are joined back to all paths. No
Python workers take part.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_path, written


class Rule(NamedTuple):
    """Leftmost non-overlapping matches of ``pattern``; those shorter than ``least`` (whole match, or its ``value`` group) are dropped."""

    kind: str
    pattern: str
    least: int = 1
    value: int = 0
    #: a literal that every match holds; texts without it need no search
    literal: str = ""
    version: int = 1


BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16, 0, "AKIA"),
    # runs of 32 and more are the matches of [0-9a-f]+ that are long enough
    Rule("hex", r"[0-9a-f]{32,}", 32),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 40, 0, "gh"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 15, 0, "xox"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}", 39, 0, "AIza"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{5,}\.eyJ[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]+", 20, 0, "eyJ"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 20, 0, "PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES
#: One row for each blob and scan: the pairs ("kind@version") scanned and their findings, written together.
LEDGER_SCHEMA = "blob string, pairs array<string>, findings array<struct<start: int, end: int, kind: string, version: int>>"
#: Findings and blobs with findings (about 100 bytes each) that may be broadcast.
BROADCAST_FINDINGS = 100_000


def blob_id(text: str = "text") -> Column:
    return F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256)


def blobs(docs: DataFrame, text: str = "text") -> DataFrame:
    """(blob, content): each distinct text once; copies within a task are dropped before the shuffle."""
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.sha2(content, 256).alias("blob"), content.alias("content")).groupBy("blob").agg(F.first("content").alias("content"))


def pair(rule: Rule) -> str:
    return f"{rule.kind}@{rule.version}"


def unseen(found: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``found`` blobs that lack a pair of rule and version in the ledger, with the pairs ``due``."""
    wanted = F.array(*[F.lit(pair(r)) for r in rules])
    # at most one element for each rule and version
    done = ledger.select(F.col("blob").alias("__blob"), F.explode("pairs").alias("pair")).groupBy("__blob").agg(F.collect_set("pair").alias("__done"))
    due = F.array_except(wanted, F.coalesce(F.col("__done"), F.array().cast("array<string>")))
    return found.join(done, F.col("blob") == F.col("__blob"), "left").withColumn("due", due).where(F.size("due") > 0).drop("__blob", "__done")


def scan(due: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings (blob, start, end, kind, kind_order) of the rules that are due; code points, end exclusive."""
    content = F.col("content")
    matched = []
    for r in rules:
        wanted = F.array_contains("due", pair(r))
        if r.literal:
            wanted &= F.contains(content, F.lit(r.literal))
        matched.append(F.when(wanted, F.regexp_extract_all(content, F.lit(r.pattern), F.lit(0))).alias(r.kind))
    some = F.lit(False)
    for r in rules:
        some = some | (F.size(r.kind) > 0)
    hits = due.select("blob", "content", *matched).where(some)

    def rows(order: int, r: Rule) -> Column:
        # the pieces between the matches give the matches' places
        pieces = F.split(content, r.pattern, -1)
        value = lambda m: F.regexp_extract(m, r.pattern, r.value) if r.value else m
        row = lambda m, i: F.struct(F.lit(order).alias("kind_order"), F.lit(r.kind).alias("kind"), i.alias("i"), F.length(m["p"]).alias("gap"), F.length(m["m"]).alias("size"), (F.length(value(m["m"])) >= r.least).alias("ok"))
        return F.when(F.size(r.kind) > 0, F.transform(F.arrays_zip(F.slice(pieces, 1, F.size(r.kind)).alias("p"), F.col(r.kind).alias("m")), row)).otherwise(F.array())

    each = hits.select("blob", F.explode(F.concat(*[rows(k, r) for k, r in enumerate(rules)])).alias("r")).select("blob", "r.*")
    up_to = Window.partitionBy("blob", "kind_order").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(up_to).cast("int"))
    return placed.where("ok").select("blob", (F.col("end") - F.col("size")).alias("start"), "end", "kind", "kind_order")


def ledger_entries(due: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """What scanning ``due`` adds to the ledger: every blob, clean ones too, with its pairs and findings."""
    version = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.version)])
    finding = F.struct("start", "end", "kind", version[F.col("kind")].alias("version"))
    found = scan(due, rules).groupBy(F.col("blob").alias("__blob")).agg(F.collect_list(finding).alias("findings"))
    none = F.array().cast("array<struct<start: int, end: int, kind: string, version: int>>")
    return due.select("blob", F.col("due").alias("pairs")).join(found, F.col("blob") == F.col("__blob"), "left").select("blob", "pairs", F.coalesce("findings", none).alias("findings"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger under ``path``; empty where none was written yet."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def spans_by_blob(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(__blob, spans) for blobs with findings of these rule versions: the findings in order of start, then rule. Repeated entries count once."""
    order = F.create_map(*[F.lit(x) for k, r in enumerate(rules) for x in (pair(r), k)])
    each = ledger.where(F.size("findings") > 0).select("blob", F.explode("findings").alias("f"))
    each = each.select("blob", "f.*", order[F.concat_ws("@", "f.kind", "f.version")].alias("kind_order")).where(F.col("kind_order").isNotNull())
    return each.groupBy(F.col("blob").alias("__blob")).agg(F.sort_array(F.collect_set(F.struct("start", "kind_order", "kind", "end"))).alias("spans"))


def scan_documents(docs: DataFrame, text: str = "text", ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``blob`` and ``spans`` (null if nothing was found; ``blob`` and ``spans`` of the input are replaced).

    ``ledger`` is the folder of the ledger, which this call extends (none: one of this call alone).
    Blobs and pairs that it holds are not scanned again; their findings come from it. Null texts
    count as empty. Repeated rows, null keys and extra columns stay as they are; an empty table gives
    none. ``docs`` is read more than once.
    """
    spark = docs.sparkSession
    ledger = ledger or fresh_path(spark, "ledger")
    due = unseen(blobs(docs, text), read_ledger(spark, ledger), rules)
    ledger_entries(due, rules).write.mode("append").parquet(ledger)
    spans = written(spans_by_blob(read_ledger(spark, ledger), rules), "spans")
    n = spans.agg(F.coalesce(F.sum(F.size("spans")), F.lit(0)), F.count(F.lit(1))).first()
    if n[0] + n[1] <= BROADCAST_FINDINGS:
        spans = F.broadcast(spans)
    # rows are packed, so that no column of theirs can clash with one of ours
    names = [c for c in docs.columns if c not in ("blob", "spans")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), blob_id(text).alias("blob"))
    return rows.join(spans, F.col("blob") == F.col("__blob"), "left").select(*[F.col("row")[c].alias(c) for c in names], "blob", "spans")


def rendered(spans: Column) -> Column:
    """kind:start:end, comma-joined; empty if there are none."""
    return F.coalesce(F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","), F.lit(""))


def of_base(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind_order"] < len(BASE_RULES))


def count_of(spans: Column, kind: str) -> Column:
    return F.coalesce(F.size(F.filter(spans, lambda s: s["kind"] == kind)), F.lit(0)).cast("long")


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by ``<kind>``; of overlapping spans the first stays, widened to their union."""
    merged = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("<"), s["kind"], F.lit(">")).alias("out"), s["end"].alias("at"))).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))),
    )
    return F.when(F.size(spans) > 0, F.concat(merged["out"], F.substring(text, merged["at"] + 1, F.length(text)))).otherwise(text)
