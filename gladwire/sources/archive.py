"""Feed archives as a Spark data source, for batches and streams.

An archive is a folder of files, each with any number of feed documents: a header line
with the key of the source, a tab and the length of the document in bytes, then the document
and a line feed. Documents may hold line feeds, so no reader of lines can split them.

``register(spark)`` makes the format ``feed_archive`` known to a session:

    spark.read.format("feed_archive").load("hdfs:///feeds")
    spark.readStream.format("feed_archive").load("s3://bucket/feeds")

A partition is one file, or several small ones up to ``partition_bytes`` together. It is read as a stream and
handed on in Arrow batches of at most ``BATCH_BYTES``. Files and folders whose names begin with
``_`` or ``.`` are left out. A document that is cut off ends its file; a malformed header is an error,
unless the option ``mode`` is ``dropmalformed``: then the rest of the file is left out.
A stream takes a file once, also one that is moved into the folder up to ``lateness`` seconds (an hour) after
others that were changed later; its offsets name the files changed within that time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "feed_archive"
SCHEMA = "source_id string, xml string, file string"
PARTITION_BYTES = 32 << 20
BATCH_BYTES = 8 << 20
_ARROW = pa.schema([("source_id", pa.string()), ("xml", pa.string()), ("file", pa.string())])


@dataclass
class Files(InputPartition):
    """Files that one task reads."""

    paths: tuple[str, ...]


@dataclass(frozen=True)
class _Found:
    path: str
    size: int
    changed: int


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":" in path else (pafs.LocalFileSystem(), path)


def _listed(path: str) -> list[_Found]:
    """The files of a folder, the oldest first."""
    system, base = _filesystem(path)
    infos = system.get_file_info(pafs.FileSelector(base, recursive=True))
    files = [
        _Found(i.path, i.size or 0, i.mtime_ns or 0) for i in infos
        if i.type == pafs.FileType.File and not any(p[:1] in "._" for p in i.path[len(base):].split("/") if p)
    ]
    return sorted(files, key=lambda f: (f.changed, f.path))


def _dealt(files: list[_Found], most: int) -> list[Files]:
    """Small files together, up to ``most`` bytes."""
    dealt, own, size = [], [], 0
    for file in files:
        if own and size + file.size > most:
            dealt.append(Files(tuple(own)))
            own, size = [], 0
        own.append(file.path)
        size += file.size
    return [*dealt, Files(tuple(own))] if own else dealt


def documents(stream, lenient: bool = False) -> Iterator[tuple[str, bytes]]:
    """Key and document of each record of an open file."""
    while header := stream.readline():
        key, tab, length = header.rstrip(b"\n").rpartition(b"\t")
        if not tab or not length.isdigit():
            if lenient:
                return
            raise ValueError(f"not a header of a feed archive: {header[:80]!r}")
        document = stream.read(int(length))
        if len(document) < int(length):
            return
        stream.read(1)
        yield key.decode("utf-8", "replace"), document


class _Read:
    """What batches and streams share."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.lenient = options.get("mode", "").lower() == "dropmalformed"
        self.most = int(options.get("partition_bytes", PARTITION_BYTES))

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = _filesystem(self.path)
        for path in partition.paths:
            rows, size = [], 0
            with system.open_input_stream(path, buffer_size=1 << 20) as raw:
                for key, document in documents(_Lines(raw), self.lenient):
                    rows.append((key, document.decode("utf-8", "replace"), path))
                    size += len(document)
                    if size > BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
            if rows:
                yield _batch(rows)


class _Lines:
    """``readline`` for a stream of bytes."""

    def __init__(self, raw, step: int = 1 << 16):
        self.raw, self.step, self.rest = raw, step, b""

    def read(self, n: int) -> bytes:
        if len(self.rest) < n:
            self.rest += self.raw.read(n - len(self.rest))
        out, self.rest = self.rest[:n], self.rest[n:]
        return out

    def readline(self) -> bytes:
        while (at := self.rest.find(b"\n")) < 0:
            more = self.raw.read(self.step)
            if not more:
                out, self.rest = self.rest, b""
                return out
            self.rest += more
        out, self.rest = self.rest[: at + 1], self.rest[at + 1 :]
        return out


def _batch(rows: list[tuple[str, str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], schema=_ARROW)


class _Reader(_Read, DataSourceReader):
    def partitions(self):
        return _dealt(_listed(self.path), self.most)


class _StreamReader(_Read, DataSourceStreamReader):
    """An offset is the newest change, and the files changed not long before it that were there.

    Of files changed earlier than that all count as taken.
    """

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.lateness = int(float(options.get("lateness", 3600)) * 1e9)

    def initialOffset(self):
        return {"newest": -1, "recent": []}

    def latestOffset(self):
        files = _listed(self.path)
        if not files:
            return self.initialOffset()
        newest = files[-1].changed
        return {"newest": newest, "recent": sorted(f.path for f in files if f.changed > newest - self.lateness)}

    def partitions(self, start, end):
        before, after = (self._taken(o) for o in (start, end))
        return _dealt([f for f in _listed(self.path) if after(f) and not before(f)], self.most)

    def _taken(self, offset):
        recent, earlier = set(offset["recent"]), offset["newest"] - self.lateness
        return lambda file: file.path in recent or (offset["newest"] >= 0 and file.changed <= earlier)


class FeedArchive(DataSource):
    """The format ``feed_archive``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)

    def streamReader(self, schema):
        return _StreamReader(self.options)


def register(spark: SparkSession) -> SparkSession:
    """Make the format known to the session."""
    spark.dataSource.register(FeedArchive)
    return spark


def write_archive(feeds: DataFrame, path: str, mode: str = "append") -> None:
    """Write ``source_id, xml`` rows as an archive; rows without document are left out."""
    length = F.octet_length("xml").cast("string")
    record = F.concat(F.coalesce("source_id", F.lit("")), F.lit("\t"), length, F.lit("\n"), "xml")
    feeds.filter(F.col("xml").isNotNull()).select(record.alias("value")).write.mode(mode).text(path)
