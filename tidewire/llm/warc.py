"""WARC archives: writing with revisit records, reading back, and a globally ordered capture index.

Each record is a gzip member of its own, so an index entry's offset and length suffice to read it.

The index is an external merge: each archive file gives a run of captures sorted by URL key and
time; ranges of that order are dealt to tasks, each of which merges its slices of all runs with a
loser tree.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator, Sequence
from datetime import UTC, datetime
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import fresh_path, small_batches, written

#: Payloads of fewer bytes are always stored; records and, by the mean payload, bytes aimed at in one archive file.
LEAST_PAYLOAD, FILE_RECORDS, FILE_BYTES = 0, 10_000, 64 << 20
#: Packed bytes that are unpacked at a time.
STEP = 1 << 14
#: Index rows aimed at in one range of the merge.
RANGE_ROWS = 100_000
#: Time of the first capture where a table has none; later ones follow by their id in seconds.
FIRST_CAPTURE = "2024-01-01 00:00:00"
CRLF = b"\r\n"
INDEX_SCHEMA = "run string, pos long, urlkey string, captured timestamp, url string, page_id long, record_type string, refers_to long, payload_digest string, payload_bytes long, offset long, length long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str) -> str:
    """Sort-friendly form: host labels reversed, then path and query, lower-cased. A text that is no URL is its own key."""
    try:
        parts = urlsplit(url.strip())
        host = parts.hostname
    except ValueError:
        host = None
    if not host:
        return url.strip().lower()
    labels = host.removeprefix("www.").split(".")[::-1]
    return f"{','.join(labels)}){parts.path or '/'}{'?' + parts.query if parts.query else ''}".lower()


def _header(value: str) -> str:
    """Header values stay on one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, captured: datetime, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    name = lambda i: "<urn:page:" + ("none" if i is None else str(i)) + ">"
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}"]
    lines += [f"WARC-Date: {captured.strftime('%Y-%m-%dT%H:%M:%S.%fZ' if captured.microsecond else '%Y-%m-%dT%H:%M:%SZ')}"]
    if url is not None:
        lines += [f"WARC-Target-URI: {_header(url)}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + CRLF + CRLF + block + CRLF + CRLF


def member(data: bytes) -> bytes:
    """``data`` as a gzip member whose last byte is zero: one of 16 MB or more is followed by an empty member."""
    packed = gzip.compress(data, 6, mtime=0)
    return packed if packed[-1] == 0 else packed + gzip.compress(b"", 6, mtime=0)


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each member that is not empty, one unpacked at a time."""
    at, whole = 0, memoryview(data)
    while at < len(data):
        unpack, content, fed = zlib.decompressobj(31), [], at
        while not unpack.eof:
            if fed >= len(data):
                raise ValueError(f"the member at byte {at} is cut off")
            # by small steps, as what follows a member is copied
            content.append(unpack.decompress(whole[fed : fed + STEP]))
            fed += STEP
        end = min(fed, len(data)) - len(unpack.unused_data)
        if any(content):
            yield at, end - at, b"".join(content)
        at = end


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record, by the length that the headers state."""
    head = data.index(CRLF + CRLF)
    first, *lines = data[:head].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no record")
    headers = dict(x.split(": ", 1) for x in lines)
    end = head + 4 + int(headers["Content-Length"])
    if data[end:] != CRLF + CRLF:
        raise ValueError("the record does not end as it states")
    return headers, data[head + 4 : end]


def with_payloads(pages: DataFrame, key: str, url: str, html: str, captured: str | None) -> DataFrame:
    when = F.col(f"`{captured}`").cast("timestamp") if captured else F.timestamp_seconds(F.unix_timestamp(F.lit(FIRST_CAPTURE).cast("timestamp")) + F.pmod(F.coalesce(F.col(f"`{key}`"), F.lit(0)), F.lit(86400 * 365)))
    html = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    return pages.select(F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), F.coalesce(when, F.lit(FIRST_CAPTURE).cast("timestamp")).alias("captured"), html.cast("binary").alias("payload")).withColumns({"sha": F.sha1("payload"), "same": F.sha2("payload", 256)})


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", captured: str | None = None) -> None:
    """Write a record for each row under ``path``: of equal payloads the one with the largest key is stored, others revisit it.

    Null html is an empty payload. Rows that share the largest key are all stored. Rows with a null
    key revisit the largest key there is, and are stored if there is none. A null URL gives a record without
    target. Extra columns are ignored; an empty table gives archives without records.
    """
    spark = pages.sparkSession
    small_batches(spark)
    rows = with_payloads(pages, key, url, html, captured)
    # equal payloads meet by their SHA-256, as SHA-1 collisions can be made; a common one is split by the skew join, and texts move once
    stored = rows.groupBy(F.col("same").alias("__same")).agg(F.max("page_id").alias("refers_to"))
    dealt = rows.join(stored, F.col("same") == F.col("__same")).drop("__same")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, size = 0, 0, 0
        for batch in batches:
            out, parts = [], []
            for page_id, target, when, payload, sha, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "captured", "payload", "sha", "refers_to")), strict=True):
                revisit = len(payload) >= LEAST_PAYLOAD and page_id != refers_to
                one = record(page_id, target, when.astimezone(UTC), payload, base64.b32encode(bytes.fromhex(sha)).decode(), refers_to, revisit)
                packed = member(one)[:-1]
                # a file ends by its bytes as by its records, wherever long pages lie together
                if n and (n >= FILE_RECORDS or size + len(packed) > FILE_BYTES):
                    part, n, size = part + 1, 0, 0
                n, size = n + 1, size + len(packed) + 1
                out.append(packed)
                parts.append(part)
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(out, pa.binary())], names=["part", "record"])

    # Spark's text writer puts bytes as they are and, as line end, the zero that each member ends with; its commits survive lost executors
    written_records = dealt.mapInArrow(run, "part int, record binary").select("part", F.col("record").cast("string"))
    written_records.write.partitionBy("part").option("lineSep", "\0").text(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The records under ``path``, each file a run sorted by URL key, time and page.

    Offset and length are those of the record's gzip member. Payload bytes and digest come from the
    stored payload; a revisit's from its HTTP and WARC headers. Records are unpacked one at a time.
    """
    small_batches(spark)
    files = spark.read.format("binaryFile").load(path).where(F.col("length") > 0).select("path", "content")
    names = [x.split()[0] for x in INDEX_SCHEMA.split(", ")]

    def page(name: str) -> int | None:
        value = name.removeprefix("<urn:page:").removesuffix(">")
        return None if value == "none" else int(value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1), strict=True):
                found = []
                for offset, length, content in members(data.as_py()):
                    headers, block = parsed(content)
                    head, _, payload = block.partition(CRLF + CRLF)
                    stated = int(head.decode().split("Content-Length: ", 1)[1].split("\r\n", 1)[0])
                    digest, target = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers.get("WARC-Target-URI")
                    response = headers["WARC-Type"] == "response"
                    if response and (len(payload) != stated or base32_sha1(payload) != digest):
                        raise ValueError(f"payload at byte {offset} is not what its headers state")
                    when = datetime.fromisoformat(headers["WARC-Date"])
                    refers = None if response else page(headers["WARC-Refers-To"])
                    found.append((url_key(target or ""), when, page(headers["WARC-Record-ID"]), target, headers["WARC-Type"], refers, digest, len(payload) if response else stated, offset, length))
                if not found:
                    continue
                found.sort(key=lambda r: (r[0], r[1], r[2] is not None, r[2] or 0))
                cols = list(zip(*found, strict=True))
                key, when, pid, target, kind, refers, digest, size, offset, length = (list(c) for c in cols)
                ts = pa.timestamp("us", "UTC")
                arrays = [pa.array([name.as_py()] * len(found)), pa.array(range(len(found)), pa.int64()), pa.array(key), pa.array(when, ts), pa.array(target, pa.string()), pa.array(pid, pa.int64()), pa.array(kind), pa.array(refers, pa.int64()), pa.array(digest), pa.array(size, pa.int64()), pa.array(offset, pa.int64()), pa.array(length, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return files.mapInArrow(run, INDEX_SCHEMA)


class LoserTree:
    """Merges sorted runs. Inner nodes keep the run that lost there, so each step replays one path to the root."""

    def __init__(self, runs: Sequence[Iterator]) -> None:
        self.runs, k = list(runs), max(1, len(runs))
        self.heads = [next(r, None) for r in self.runs]
        self.tree = [-1] * k
        for r in range(len(self.runs)):
            self._replay(r, building=True)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        # an ended run loses to all; equal heads come in the order of their runs
        return y is None or (x is not None and (x, a) < (y, b))

    def _replay(self, run: int, building: bool = False) -> None:
        node = (run + len(self.tree)) // 2
        while node > 0:
            other = self.tree[node]
            if other < 0:
                if building:
                    self.tree[node] = run
                    return
            elif self._beats(other, run):
                self.tree[node], run = run, other
            node //= 2
        self.tree[0] = run

    def __iter__(self):
        while self.runs and self.heads[w := self.tree[0]] is not None:
            yield self.heads[w]
            self.heads[w] = next(self.runs[w], None)
            self._replay(w)


def merge_runs(index: DataFrame) -> DataFrame:
    """The captures of all runs in global order of URL key, time and page; ``place`` is the number in that order.

    Ranges come from sampled bounds over the whole key, so a URL with very many captures is split too.
    """
    ranges = max(1, -(-index.count() // RANGE_ROWS))
    # shuffling loses the runs' order within a range; this brings each run's slice back
    dealt = index.repartitionByRange(ranges, "urlkey", "captured", "page_id").sortWithinPartitions("run", "pos")
    schema = StructType([*dealt.schema.fields, StructField("__range", IntegerType()), StructField("__place", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rows = pa.Table.from_batches(got).combine_chunks()
        runs, keys = rows.column("run").to_pylist(), (rows.column(c).to_pylist() for c in ("urlkey", "captured", "page_id"))
        keys = [(k, t, p is not None, p or 0, i) for i, (k, t, p) in enumerate(zip(*keys, strict=True))]
        starts = [i for i in range(len(runs)) if not i or runs[i] != runs[i - 1]] + [len(runs)]
        order = [k[-1] for k in LoserTree([iter(keys[a:b]) for a, b in zip(starts, starts[1:], strict=False)])]
        out = rows.take(pa.array(order, pa.int64()))
        out = out.append_column("__range", pa.array([TaskContext.get().partitionId()] * len(order), pa.int32())).append_column("__place", pa.array(range(len(order)), pa.int64()))
        yield from out.to_batches(max_chunksize=10_000)

    merged = written(dealt.mapInArrow(run, schema), "merged")
    # a row for each range: how many captures stand before it
    sizes = merged.groupBy(F.col("__range").alias("__r")).agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__r", (F.sum("__n").over(Window.orderBy("__r")) - F.col("__n")).alias("__before"))
    return merged.join(F.broadcast(before), F.col("__range") == F.col("__r")).withColumn("place", F.col("__before") + F.col("__place")).drop("__range", "__place", "__r", "__before")


def capture_index(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", captured: str | None = None, path: str | None = None) -> DataFrame:
    """Write archives, read them back and merge their runs: a row for each record, in global order."""
    spark = pages.sparkSession
    path = path or fresh_path(spark, "warc")
    write_archives(pages, path, key, url, html, captured)
    return merge_runs(written(read_index(spark, path), "runs"))

