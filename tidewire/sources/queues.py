"""A queue of messages as a data source, and what its messages say.

A queue is a folder of segments, files to which producers append lines; a segment is read up to its
last whole line. Offsets are bytes of each segment, kept by Spark with each micro-batch, so a batch that
failed is read again exactly as it was; lines already read are never looked at again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

#: Bytes of a segment that one task reads, and bytes looked through at a time for the end of a line.
PIECE, LOOK = 32 << 20, 1 << 16


class Piece(InputPartition):
    """The lines of a segment that begin from ``first`` to before ``end``."""

    def __init__(self, segment: str, first: int, end: int) -> None:
        self.segment, self.first, self.end = segment, first, end


class Segments:
    """Segments of a folder, on any file system that Arrow knows by its address."""

    def __init__(self, path: str, piece: int = PIECE) -> None:
        self.path, self.piece = path, piece

    def _at(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)

    def ends(self) -> dict[str, int]:
        """Bytes of each segment up to its last whole line."""
        system, folder = self._at()
        found = {}
        for info in system.get_file_info(fs.FileSelector(folder, recursive=False, allow_not_found=True)):
            if info.is_file and not info.base_name.startswith((".", "_")):
                with system.open_input_file(info.path) as f:
                    end = at = f.size()
                    while at > 0:
                        begin = max(0, at - LOOK)
                        f.seek(begin)
                        cut = f.read(at - begin).rfind(b"\n")
                        if cut >= 0:
                            end = begin + cut + 1
                            break
                        at = end = begin
                    found[info.base_name] = end
        return found

    def pieces(self, start: dict[str, int], end: dict[str, int]) -> list[Piece]:
        out = []
        for segment, last in sorted(end.items()):
            first = start.get(segment, 0)
            out += [Piece(segment, a, min(a + self.piece, last)) for a in range(first, last, self.piece)]
        return out

    def lines(self, piece: Piece) -> Iterator[tuple[str, int, str]]:
        """(segment, offset, line): a line that begins in the piece is its own, however far it goes."""
        system, folder = self._at()
        with system.open_input_file(f"{folder.rstrip('/')}/{piece.segment}") as f:
            at = piece.first
            if at > 0:  # on to the first line that begins here
                f.seek(at - 1)
                at += len(_line(f)) - 1
            f.seek(at)
            while at < piece.end:
                line = _line(f)
                if not line:
                    return
                yield piece.segment, at, line.rstrip(b"\r\n").decode("utf-8", "replace")
                at += len(line)


def _line(f) -> bytes:
    """The bytes up to and with the next end of a line."""
    start, parts = f.tell(), []
    while chunk := f.read(LOOK):
        cut = chunk.find(b"\n")
        if cut >= 0:
            parts.append(chunk[: cut + 1])
            break
        parts.append(chunk)
    line = b"".join(parts)
    f.seek(start + len(line))
    return line


class QueueSource(DataSource):
    """``spark.read`` or ``readStream`` of format ``message_queue``; options: path (the folder), piece (bytes a task reads)."""

    @classmethod
    def name(cls) -> str:
        return "message_queue"

    def schema(self) -> str:
        return "segment string, offset long, value string"

    def _segments(self) -> Segments:
        if "path" not in self.options:
            raise ValueError("message_queue needs the option path")
        return Segments(self.options["path"], int(self.options.get("piece", PIECE)))

    def reader(self, schema) -> DataSourceReader:
        return QueueReader(self._segments())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return QueueStream(self._segments())


class QueueReader(DataSourceReader):
    def __init__(self, segments: Segments) -> None:
        self.segments = segments

    def partitions(self) -> list[Piece]:
        return self.segments.pieces({}, self.segments.ends()) or [Piece("", 0, 0)]

    def read(self, partition: Piece) -> Iterator[tuple]:
        yield from self.segments.lines(partition) if partition.segment else ()


class QueueStream(DataSourceStreamReader):
    def __init__(self, segments: Segments) -> None:
        self.segments = segments

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self.segments.ends()

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        return self.segments.pieces(start, end)

    def read(self, partition: Piece) -> Iterator[tuple]:
        yield from self.segments.lines(partition)

    def commit(self, end: dict) -> None:
        pass


def queue(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    """(segment, offset, value) of a queue's messages so far, or without end."""
    spark.dataSource.register(QueueSource)
    return (spark.readStream if stream else spark.read).format("message_queue").options(path=path, **options).load()


def requests(messages: DataFrame, column: str = "value", target: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns and (url, site, callback, meta, headers) of queue messages. Batch or stream.

    A message is a JSON object with ``url`` or ``u``, or a bare URL; one that begins like an object but
    cannot be read, or has no URL, is taken for a bare URL as it stands, and blank ones are none. ``meta`` and ``headers``
    are maps of texts (empty, if not stated). The site is ``target`` where that is stated, unless ``meta`` has one; else
    that of ``meta`` or, failing that, of the message; ``meta`` holds it too.
    """
    v = F.btrim(F.col(column))
    of = lambda p: F.get_json_object(v, f"$.{p}")
    texts = lambda p: F.coalesce(F.from_json(of(p), "map<string,string>"), F.create_map().cast("map<string,string>"))
    stated = F.coalesce(F.nullif(of("url"), F.lit("")), F.nullif(of("u"), F.lit("")))
    is_json = F.startswith(v, F.lit("{")) & stated.isNotNull()
    none = F.create_map().cast("map<string,string>")
    found = messages.select(*keep, F.when(is_json, stated).otherwise(v).alias("url"), F.when(is_json, of("callback")).alias("callback"), F.when(is_json, texts("meta")).otherwise(none).alias("meta"), F.when(is_json, texts("headers")).otherwise(none).alias("headers"), F.when(is_json, of("site")).alias("said"), (F.lit(None).cast("string") if target is None else target).alias("target"))
    site = F.coalesce(F.try_element_at("meta", F.lit("site")), "target", "said")
    meta = F.when(site.isNull() | F.map_contains_key("meta", "site"), F.col("meta")).otherwise(F.map_concat("meta", F.create_map(F.lit("site"), site)))
    return found.where(F.coalesce("url", F.lit("")) != "").select(*keep, "url", site.alias("site"), "callback", meta.alias("meta"), "headers")
