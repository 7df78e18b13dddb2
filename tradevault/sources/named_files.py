"""Text files under names taken from the rows, written by a Spark data source with a two-phase commit.

Rows (name, line) come grouped by name and in the order of the file. A task writes its files into a folder of its own attempt
below ``_pending`` and reports their names, sizes and checksums. Only when every task has succeeded does the driver move
each file to its final name, in one rename, and write the list of files last; a failed or repeated task leaves nothing behind.
"""

from __future__ import annotations

import bz2
import hashlib
import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "named_lines"
LIST = "files.list"

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package


@dataclass
class Written(WriterCommitMessage):
    """Files of one task: name -> (place, bytes of text, lines, checksum of the text)."""

    files: dict[str, tuple[str, int, int, str]] = field(default_factory=dict)


def place(uri: str):
    """(file system, path) of a folder, on whatever store its address names."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    return FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (LocalFileSystem(), uri)


class NamedWriter(DataSourceWriter):
    def __init__(self, path: str) -> None:
        self.path = path.rstrip("/")
        self.pending = f"{self.path}/_pending/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> Written:
        """Write the files of one task. A file's lines must stand together."""
        from pyspark import TaskContext

        fs, base = place(self.pending)
        task = TaskContext.get()
        folder = f"{base}/{task.partitionId()}-{task.taskAttemptId()}"
        fs.create_dir(folder, recursive=True)
        done, now, out = Written(), None, None
        for row in iterator:
            name, line = row[0], row[1]
            if name != now:
                if out is not None:
                    done.files[now] = out.close()
                if not name or "/" in name or name.startswith(("_", ".")) or name in done.files:
                    raise ValueError(f"{name!r} is no file name, or its lines do not stand together")
                now, out = name, Packed(fs, f"{folder}/{name}")
            out.add(line)
        if out is not None:
            done.files[now] = out.close()
        return done

    def commit(self, messages: list[Written | None]) -> None:
        fs, base = place(self.path)
        files: dict[str, tuple[str, int, int, str]] = {}
        for m in messages:
            for name, found in (m.files if m else {}).items():
                if name in files:
                    raise ValueError(f"two tasks wrote {name}")
                files[name] = found
        for name, (at, *_) in files.items():
            fs.move(at, f"{base}/{name}")
        listed = [{"file_name": n, "file_size_bytes": b, "record_count": k, "sha256_checksum": h} for n, (_, b, k, h) in sorted(files.items())]
        with fs.open_output_stream(f"{base}/{LIST}") as f:
            f.write("\n".join(json.dumps(x) for x in listed).encode())
        self.clean()

    def abort(self, messages: list[Written | None]) -> None:
        self.clean()

    def clean(self) -> None:
        from pyarrow.fs import FileType

        fs, base = place(self.pending)
        above = base.rsplit("/", 1)[0]
        for folder in (base, above):
            info = fs.get_file_info(folder)
            if info.type == FileType.Directory and (folder == base or not fs.get_file_info(selector(folder))):
                fs.delete_dir(folder)


def selector(folder: str):
    from pyarrow.fs import FileSelector

    return FileSelector(folder)


class Packed:
    """One bzip2 file; the checksum is over its text, each line ended by a newline. Memory is one compression block."""

    def __init__(self, fs, path: str) -> None:
        self.path, self.out = path, fs.open_output_stream(path, compression=None)
        self.pack, self.hash, self.size, self.lines = bz2.BZ2Compressor(), hashlib.sha256(), 0, 0

    def add(self, line: str) -> None:
        raw = line.encode() + b"\n"
        self.hash.update(raw)
        self.size += len(raw)
        self.lines += 1
        self.out.write(self.pack.compress(raw))

    def close(self) -> tuple[str, int, int, str]:
        self.out.write(self.pack.flush())
        self.out.close()
        return self.path, self.size, self.lines, self.hash.hexdigest()


class NamedLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> NamedWriter:
        if overwrite:
            raise ValueError("files are added under their names; nothing is replaced")
        return NamedWriter(self.options["path"])


def write_named(df: DataFrame, name: str, order: str, line: str, path: str) -> None:
    """One bzip2 file per value of ``name`` in ``path``, its lines in the order of ``order``. One task writes a file, so
    the caller bounds files; a file that is there under the same name is replaced."""
    df.sparkSession.dataSource.register(NamedLines)
    rows = df.select(name, order, line).repartition(name).sortWithinPartitions(name, order).select(name, line)
    rows.write.format(FORMAT).mode("append").option("path", path).save()


def written_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, file_size_bytes, record_count, sha256_checksum) of the last completed write to ``path``."""
    return spark.read.schema("file_name string, file_size_bytes long, record_count long, sha256_checksum string").json(f"{path.rstrip('/')}/{LIST}")
