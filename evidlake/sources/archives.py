"""Archives and SQLite tables as sources that split: no archive, table or large member is ever one row or on the driver.

Planning reads a zip's central directory, or a table's smallest and largest row number, and nothing else; tasks then read their
own members, or their own range of rows, from a path that all machines see (a mounted folder, or any address that
``pyarrow.fs`` opens). A member larger than ``chunk`` bytes comes in several rows, in order, and is never held whole.

    archives.register(spark)
    spark.read.format("zip_members").load("/shared/landing")          # archive, member, part, last, content
    spark.read.format("sqlite_rows").option("table", "t").load(path)  # the table's columns, as text
"""

from __future__ import annotations

import sqlite3
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Compressed bytes of the members of one task, and bytes of one row.
TASK, CHUNK = 64 << 20, 16 << 20
#: Row numbers of one task of a SQLite table, and rows of one batch.
ROWS, BATCH = 250_000, 10_000


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path within it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def archives_below(path: str) -> list[str]:
    """The zip archives below a folder, or the archive itself, in order."""
    system, at = _place(path)
    info = system.get_file_info(at)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(at, recursive=True))
    prefix = path[: len(path) - len(at)] if "://" in path else ""
    return sorted(prefix + x.path for x in found if x.type == fs.FileType.File and x.path.lower().endswith(".zip"))


class Members(InputPartition):
    def __init__(self, archive: str, names: list[str]):
        self.archive, self.names = archive, names


class ZipReader(DataSourceReader):
    def __init__(self, path: str, task: int, chunk: int):
        self.path, self.task, self.chunk = path, task, chunk

    def partitions(self) -> list[Members]:
        out = []
        for archive in archives_below(self.path):
            system, at = _place(archive)
            with system.open_input_file(at) as f, zipfile.ZipFile(f) as z:
                names, size = [], 0
                for info in z.infolist():
                    if info.is_dir():
                        continue
                    if names and size + info.compress_size > self.task:
                        out.append(Members(archive, names))
                        names, size = [], 0
                    names.append(info.filename)
                    size += info.compress_size
                if names:
                    out.append(Members(archive, names))
        return out

    def read(self, partition: Members) -> Iterator[tuple]:
        if partition is None or not isinstance(partition, Members):  # nothing was found
            return
        system, at = _place(partition.archive)
        with system.open_input_file(at) as f, zipfile.ZipFile(f) as z:
            for name in partition.names:
                with z.open(name) as member:
                    part, held = 0, member.read(self.chunk)
                    while True:
                        more = member.read(self.chunk) if len(held) == self.chunk else b""
                        yield partition.archive, name, part, not more, held
                        if not more:
                            break
                        part, held = part + 1, more


class ZipMembers(DataSource):
    """Options: ``path``; ``task`` and ``chunk`` in bytes."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return "archive string, member string, part int, last boolean, content binary"

    def reader(self, schema) -> ZipReader:
        return ZipReader(self.options["path"], int(self.options.get("task", TASK)), int(self.options.get("chunk", CHUNK)))


class Range(InputPartition):
    """Row numbers from ``low`` to below ``high``; both null: the whole table, which has no row numbers."""

    def __init__(self, low: int | None, high: int | None):
        self.low, self.high = low, high


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path.removeprefix('file:')}?mode=ro", uri=True)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class SqliteReader(DataSourceReader):
    def __init__(self, path: str, table: str, columns: list[str], rows: int):
        self.path, self.table, self.columns, self.rows = path, table, columns, rows

    def partitions(self) -> list[Range]:
        with _open(self.path) as db:
            try:
                low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.table)}").fetchone()
            except sqlite3.OperationalError:  # a table without row numbers
                return [Range(None, None)]
        return [] if low is None else [Range(at, min(at + self.rows, high + 1)) for at in range(low, high + 1, self.rows)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, Range):
            return
        where, values = ("", ()) if partition.low is None else (" WHERE rowid >= ? AND rowid < ?", (partition.low, partition.high))
        db = _open(self.path)
        try:
            rows = db.execute(f"SELECT {', '.join(f'CAST({_quoted(c)} AS TEXT)' for c in self.columns)} FROM {_quoted(self.table)}{where}", values)
            while batch := rows.fetchmany(BATCH):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*batch, strict=True)], self.columns)
        finally:
            db.close()


class SqliteRows(DataSource):
    """Options: ``path``, ``table``; ``rows``: row numbers of one task."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_rows"

    def _columns(self) -> list[str]:
        with _open(self.options["path"]) as db:
            return [r[1] for r in db.execute(f"PRAGMA table_info({_quoted(self.options['table'])})")]

    def schema(self) -> str:
        return ", ".join(f"`{c}` string" for c in self._columns())

    def reader(self, schema) -> SqliteReader:
        return SqliteReader(self.options["path"], self.options["table"], [f.name for f in schema.fields], int(self.options.get("rows", ROWS)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ZipMembers)
    spark.dataSource.register(SqliteRows)


def zip_members(spark: SparkSession, path: str, **options: int) -> DataFrame:
    """(archive, member, part, last, content) of all zip archives at or below a path."""
    register(spark)
    return spark.read.format("zip_members").options(**options).load(path)


def sqlite_table(spark: SparkSession, path: str, table: str, **options: int) -> DataFrame:
    """All rows of a SQLite table, every column as text."""
    register(spark)
    return spark.read.format("sqlite_rows").options(table=table, **options).load(path)
