"""A Python data source for CSV files in ZIP archives: one partition for each member, its rows streamed from the file system."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Rows of a member that are in memory at once.
CHUNK_ROWS = 20_000
SCHEMA = "archive string, member string, ordinal long, fields map<string,string>"
_ARROW = pa.schema([("archive", pa.string()), ("member", pa.string()), ("ordinal", pa.int64()), ("fields", pa.map_(pa.string(), pa.string()))])


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or local path, and the path in it; ``ValueError`` for a scheme that only the cluster's own readers know."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    try:
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    except pa.ArrowInvalid as unknown:
        raise ValueError(str(unknown)) from unknown


def archives_below(path: str) -> list[tuple[str, int]]:
    """ZIP archives at or below a path and their sizes, in the order of their names."""
    system, at = file_system(path)
    found = system.get_file_info(at)
    files = [found] if found.type == fs.FileType.File else system.get_file_info(fs.FileSelector(at, recursive=True))
    return sorted((f.path, f.size) for f in files if f.type == fs.FileType.File and f.path.lower().endswith(".zip"))


class _Opened(io.RawIOBase):
    """A file of a file system for the archive reader, which expects ``OSError`` where a place is not in it."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        return self.file.readinto(into)

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, to: int, whence: int = 0) -> int:
        try:
            self.file.seek(to, whence)
        except pa.ArrowInvalid as outside:
            raise OSError(str(outside)) from outside
        return self.file.tell()

    def close(self) -> None:
        self.file.close()
        super().close()


def _opened(system: fs.FileSystem, path: str) -> zipfile.ZipFile:
    return zipfile.ZipFile(io.BufferedReader(_Opened(system.open_input_file(path)), 1 << 18))


class Member(InputPartition):
    def __init__(self, archive: str, member: str) -> None:
        self.archive, self.member = archive, member


class ArchiveReader(DataSourceReader):
    def __init__(self, path: str, suffix: str) -> None:
        self.path, self.suffix = path, suffix

    def partitions(self) -> list[Member]:
        """Members by the tables of contents at the archives' ends; nothing is unpacked."""
        system, _ = file_system(self.path)
        out = []
        for archive, _ in archives_below(self.path):
            with _opened(system, archive) as z:
                out += [Member(archive, i.filename) for i in sorted(z.infolist(), key=lambda i: i.filename) if i.filename.lower().endswith(self.suffix)]
        return out

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no member at all
            return
        system, _ = file_system(self.path)
        name = partition.member.rsplit("/", 1)[-1]
        with _opened(system, partition.archive) as z, z.open(partition.member) as f:
            try:
                parts = pd.read_csv(io.BufferedReader(f, 1 << 20), dtype=str, keep_default_na=False, encoding="utf-8-sig", chunksize=CHUNK_ROWS)
            except pd.errors.EmptyDataError:
                return
            at = 0
            for part in parts:
                names = list(part.columns)
                rows = [list(zip(names, values)) for values in part.itertuples(index=False, name=None)]
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(partition.archive), len(rows)), pa.repeat(pa.scalar(name), len(rows)), pa.array(range(at, at + len(rows)), pa.int64()), pa.array(rows, _ARROW.field("fields").type)], schema=_ARROW)
                at += len(rows)


class ArchiveSource(DataSource):
    """``spark.read.format("zip_csv")`` with option path, and suffix of the members (.csv): rows (archive, member, ordinal, fields), ``fields`` mapping column to text.

    A member is unpacked as it is read, so memory holds some rows of it, whatever its size. A leading byte-order mark is dropped, and members without a line have no rows.
    """

    @classmethod
    def name(cls) -> str:
        return "zip_csv"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return ArchiveReader(self.options["path"], self.options.get("suffix", ".csv").lower())
