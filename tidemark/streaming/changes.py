"""Streams of changes in JSON lines, with admission control: at most `limit` changes a batch, resumed by byte offset.

A log is a file that grows (a last line without a line end is still being written), or a folder to
which whole files are added, in the order of their names. The driver only
looks for line ends, from where the last batch ended; tasks read and parse byte ranges. A slot beside
the log keeps what has been planned and what has been committed, as a replication slot does: a query
that starts again goes on there, and nothing is read from the start.
"""

from __future__ import annotations

import base64
import json
import time
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "seq bigint, lsn string, xid string, data binary"
DOCUMENT_CHANGE = "seq bigint, operation_type string, collection string, document_key string, full_document string"
BLOCK = 1 << 20


def peek(changes: DataFrame, after: int, limit: int, seq: str = "seq") -> DataFrame:
    """The next changes of a log, without consuming them; the limit is the feature."""
    return changes.filter(F.col(seq) > after).orderBy(seq).limit(limit)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


class Log:
    """The files of a log. An offset is {"file": name, "byte": n}; names sort in the order of the log."""

    def __init__(self, path: str):
        self.files, self.path = _store(path.rstrip("/"))
        self.is_folder = self.files.get_file_info(self.path).type == fs.FileType.Directory

    def list(self) -> list[tuple[str, str, int]]:
        """(name, path, size) of its files."""
        info = self.files.get_file_info(self.path)
        if info.type == fs.FileType.File:
            return [(info.base_name, info.path, info.size)]
        if info.type == fs.FileType.NotFound:
            return []
        own = self.files.get_file_info(fs.FileSelector(self.path))
        return sorted((x.base_name, x.path, x.size) for x in own if x.type == fs.FileType.File and x.base_name[0] not in "._" and not x.base_name.endswith(".slot"))

    def advance(self, start: dict, limit: int, millis: float) -> dict:
        """The offset after at most limit whole lines from start, or what was seen within that time."""
        until, at = time.monotonic() + millis / 1000, dict(start)
        for name, path, size in self.list():
            if name < at["file"]:
                continue
            byte = at["byte"] if name == at["file"] else 0
            with self.files.open_input_file(path) as f:
                while byte < size and limit > 0 and time.monotonic() < until:
                    block = f.read_at(min(BLOCK, size - byte), byte)
                    lines = block.count(b"\n")
                    if not lines:  # a line longer than a block, or one that is still being written
                        block = f.read_at(size - byte, byte)
                        lines = block.count(b"\n")
                        if not lines and not self.is_folder:
                            return at
                        if not lines:
                            byte, limit = size, limit - 1
                            at = {"file": name, "byte": byte}
                            break
                    if lines > limit:
                        end = -1
                        for _ in range(limit):
                            end = block.index(b"\n", end + 1)
                    else:
                        end = block.rindex(b"\n")
                    byte, limit = byte + end + 1, limit - min(lines, limit)
                    at = {"file": name, "byte": byte}
            if byte < size:
                return at
        return at

    def ranges(self, start: dict, end: dict) -> list[tuple[str, int, int]]:
        """Byte ranges of whole lines, of about BLOCK each, between two offsets."""
        out = []
        for name, path, size in self.list():
            if start["file"] <= name <= end["file"]:
                a = start["byte"] if name == start["file"] else 0
                b = end["byte"] if name == end["file"] else size
                with self.files.open_input_file(path) as f:
                    while a < b:
                        cut = min(b, a + BLOCK)
                        while cut < b:
                            block = f.read_at(min(BLOCK, b - cut), cut)
                            line_end = block.find(b"\n")
                            cut += len(block) if line_end < 0 else line_end + 1
                            if line_end >= 0:
                                break
                        out.append((path, a, cut))
                        a = cut
        return out


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.limit = options["path"], int(options.get("limit", 65536))
        self.timeout, self.idle = float(options.get("timeout_millis", 5000)), float(options.get("idle_millis", 0))
        self.slot = options.get("slot") or self.path.rstrip("/") + ".slot"

    def _state(self) -> dict:
        files, path = _store(self.slot)
        if files.get_file_info(path).type != fs.FileType.File:
            return {"planned": self._zero(), "committed": self._zero()}
        with files.open_input_stream(path) as f:
            return json.loads(f.read())

    def _keep(self, **changes: dict) -> None:
        files, path = _store(self.slot)
        state = self._state() | changes
        with files.open_output_stream(path + ".new") as f:
            f.write(json.dumps(state).encode())
        files.move(path + ".new", path)

    @staticmethod
    def _zero() -> dict:
        return {"file": "", "byte": 0}

    def initialOffset(self) -> dict:
        """For a query without a checkpoint: the log from its start. With an old slot, its first batch holds all that was planned."""
        return self._zero()

    def latestOffset(self) -> dict:
        before = self._state()["planned"]
        after = Log(self.path).advance(before, self.limit, self.timeout)
        if after != before:
            # Kept before Spark plans with it: after a failure this is never behind the checkpoint.
            self._keep(planned=after)
        elif self.idle:
            time.sleep(self.idle / 1000)
        return after

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Range(*x) for x in Log(self.path).ranges(start, end)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        files = _store(self.path)[0]
        with files.open_input_file(partition.path) as f:
            body = f.read_at(partition.end - partition.start, partition.start)
        for line in body.splitlines():
            yield self.row(json.loads(line))

    def commit(self, end: dict) -> None:
        """What is applied: the log may be cut up to here."""
        self._keep(committed=end)


class _Changes(_Reader):
    @staticmethod
    def row(x: dict) -> tuple:
        return x["seq"], x.get("lsn"), x.get("xid"), base64.b64decode(x["data"])


class _DocumentChanges(_Reader):
    @staticmethod
    def row(x: dict) -> tuple:
        return tuple(x.get(name) for name in ("seq", "operation_type", "collection", "document_key", "full_document"))


class ChangeLog(DataSource):
    """spark.readStream.format("tidemark_changes") with the options path, limit, timeout_millis, idle_millis, slot."""

    @classmethod
    def name(cls) -> str:
        return "tidemark_changes"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Changes(self.options)


class DocumentLog(ChangeLog):
    """The same for changes of documents."""

    @classmethod
    def name(cls) -> str:
        return "tidemark_document_changes"

    def schema(self) -> str:
        return DOCUMENT_CHANGE

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _DocumentChanges(self.options)


def _stream(spark: SparkSession, source: type[DataSource], path: str, **options) -> DataFrame:
    spark.dataSource.register(source)
    return spark.readStream.format(source.name()).option("path", path).options(**options).load()


def read_changes(spark: SparkSession, path: str, limit: int = 65536, **options) -> DataFrame:
    return _stream(spark, ChangeLog, path, limit=limit, **options)


def read_document_changes(spark: SparkSession, path: str, limit: int = 65536, **options) -> DataFrame:
    return _stream(spark, DocumentLog, path, limit=limit, **options)
