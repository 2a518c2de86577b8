"""A corpus pipeline over ``documents``: rules, near-duplicates, decontamination, secrets, tokens.

Each stage works on all rows its predecessor kept. Rows are packed into a struct where an operator
adds columns, so columns of the input may have any names but doc_id, text, lang, source and n_chars,
which mean what they mean in ``documents``.

Every stage takes null texts as empty, judges or keeps repeated rows each (near_duplicates keeps one
of them), and gives an empty table for an empty one; null ids, languages and sources stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from threading import get_ident

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import bpe, near, rules, secrets, winnow
from tidewire.llm.common import fresh_path, made, release, table
from tidewire.llm.queries import RANKS


#: (thread, input, stage) -> tables of that stage, which nothing reads once a later stage of the same input begins.
_spent: dict[tuple[int, str, int], list[str]] = {}


def stage(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage begins when its predecessor's result is written, so the tables that made that result can go.

    Runs over other inputs or in other threads are left alone; two runs over one input in one thread
    must not take turns.
    """

    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        own, at = (get_ident(), sf_dir), [n for n, _ in STAGES].index(f.__name__)
        for key in [k for k in _spent if k[:2] == own and k[2] < at]:
            release(spark, _spent.pop(key))
        before = set(made())
        out = f(spark, docs, sf_dir)
        _spent[*own, at] = [p for p in made() if p not in before]
        return out

    return run_stage


def packed(docs: DataFrame, *names: str) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), *names)


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep. Labels with null keys count for nothing; null languages are a stratum of their own; texts without words go."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    judged = rules.apply_rules(packed(docs, "doc_id", "lang", "text"), good, ["__doc"])
    return judged.where("kept").select("__doc.*")


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id (null ids last; of equal ids one), of each group linked at a Jaccard similarity of 0.8 or more over five words. Texts without words are one group."""
    return near.one_of_each(docs)


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage. Items without a key or without words are ignored."""
    judged = winnow.decontaminate(packed(docs, "text"), table(spark, sf_dir, "benchmark"), ["__doc"])
    return judged.where(~F.col("contaminated")).select("__doc.*")


@stage
def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced by its kind (of overlapping ones the first); n_chars follows. A null text stays null."""
    found = secrets.scan_documents(packed(docs, "text")).select("__doc", "spans")
    doc = F.col("__doc")
    text = F.when(F.size("spans") > 0, secrets.redact(doc["text"], F.col("spans"))).otherwise(doc["text"])
    found = found.select("__doc", text.alias("__clean"))
    changed = {"text": F.col("__clean"), "n_chars": F.length("__clean").cast("long")}
    return found.select(*[changed.get(c, doc[c]).alias(c) for c in docs.columns])


@stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids (little-endian unsigned 32-bit), their number, and whether they decode to the text."""
    ranks = public_tokenizers.path(RANKS)
    named = docs.select("doc_id", "lang", "source", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    coded = bpe.round_trip_documents(named, ranks, public_tokenizers.PATTERN, ["doc_id", "lang", "source", "text_sha256"])
    return coded.select("doc_id", "lang", "source", bpe.token_count().alias("n_tokens"), "token_ids", (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("tokens", tokens),
]

#: Fingerprints (XXH64) and token merges have no SQL; tests/llm/test_pipeline.py holds each stage and all of them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole table, each written and read again; a stage's result goes once its successor's is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, apply in STAGES:
        out = apply(spark, docs, sf_dir)
        path = fresh_path(spark, name)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            release(spark, [before])
        before = path
    return docs
