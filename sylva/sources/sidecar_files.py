"""Sidecar files as a Python data source: ``spark.read / df.write.format("sylva_sidecar")``.

Writing stages every file under ``<path>/_temporary/<job>``; the driver's commit
step moves the staged files to ``<path>/<model_id><suffix>`` when all tasks are
done, and an aborted job removes its staging folder, so readers never see a
part of a write. Only the driver makes that folder: a task that is still running
when its job is aborted fails and does not make it anew. Reading gives one row
per file (path, model_id, content).

Files are reached through ``pyarrow.fs`` (local paths and ``file:`` URIs, hdfs,
s3, gs, abfs), the same way on the driver and on the executors. A file system
that pyarrow does not know is refused; keep the packed table as Parquet there
(``read_sidecar_table`` reads it back).
"""

from __future__ import annotations

import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import Row, StructType

NAME = "sylva_sidecar"


def file_system(path: str):
    """(file system, path on it) of a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


@dataclass
class _File(InputPartition):
    path: str


@dataclass
class _Staged(WriterCommitMessage):
    files: list[tuple[str, str]]  # staged path, final name


class _Reader(DataSourceReader):
    def __init__(self, path: str, suffix: str):
        self.path, self.suffix = path, suffix

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, base = file_system(self.path)
        info = system.get_file_info(base)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(base))
        return [_File(f.path) for f in found if f.type == fs.FileType.File and f.path.endswith(self.suffix)] or [_File("")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.path:
            system, _ = file_system(self.path)
            with system.open_input_file(partition.path) as f:
                yield partition.path, posixpath.basename(partition.path).split(".")[0], f.read()


class _Writer(DataSourceWriter):
    def __init__(self, path: str, suffix: str, schema: StructType):
        missing = {"model_id", "sidecar"} - set(schema.names)
        if missing:
            raise ValueError(f"sidecar rows need the columns model_id and sidecar; missing: {sorted(missing)}")
        self.path, self.suffix, self.job = path, suffix, uuid.uuid4().hex
        system, base = file_system(path)
        system.create_dir(self._staging(base), recursive=True)

    def _staging(self, base: str) -> str:
        return posixpath.join(base, "_temporary", self.job)

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        system, base = file_system(self.path)
        folder = posixpath.join(self._staging(base), uuid.uuid4().hex)  # of this attempt
        files = []
        for row in iterator:
            if not row["model_id"] or "/" in row["model_id"]:
                raise ValueError(f"a file cannot be named after the model id {row['model_id']!r}")
            name = f"{row['model_id']}{self.suffix}"
            system.create_dir(folder, recursive=False)
            with system.open_output_stream(posixpath.join(folder, name)) as out:
                out.write(bytes(row["sidecar"]))
            files.append((posixpath.join(folder, name), name))
        return _Staged(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, base = file_system(self.path)
        files = [f for m in messages if m is not None for f in m.files]
        names = [name for _, name in files]
        if len(set(names)) < len(names):
            self.abort(messages)
            raise ValueError(f"two sidecars of one name: {sorted(n for n in set(names) if names.count(n) > 1)}")
        for staged, name in files:
            system.move(staged, posixpath.join(base, name))
        self.abort(messages)  # what is left of the staging folder

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        system, base = file_system(self.path)
        tries = 10
        while system.get_file_info(self._staging(base)).type == fs.FileType.Directory:
            try:
                system.delete_dir(self._staging(base))
            except OSError:  # a task that is still running put a file there meanwhile
                tries -= 1
                if not tries:
                    raise


class SidecarSource(DataSource):
    """Options: the path, and ``suffix`` of the files (".sidecar")."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "path string, model_id string, content binary"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("suffix", ".sidecar"))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("sidecars are added to a folder (mode 'append'); a file of the same name is replaced")
        return _Writer(self.options["path"], self.options.get("suffix", ".sidecar"), schema)


def register(spark) -> None:
    from ..session import ship_package

    ship_package(spark)
    spark.dataSource.register(SidecarSource)
