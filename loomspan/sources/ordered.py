"""A sink of ordered lines that knows its digest when it is done.

Sorted ranges of lines are written by a Python data source: each task hashes and counts
its lines while it writes them, to a file of its own attempt; the commit, on the driver,
puts the files of the attempts that count in their places, checks that ranges follow each
other, and writes the parts' digests and the digest over them beside the parts.  Nothing
is read a second time, so parts may be of any size.

Paths are what ``pyarrow.fs`` opens: local and mounted folders, HDFS, object stores.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

NAME = "loomspan_ordered_lines"
DIGEST = "_digest.json"


class OutOfOrder(ValueError):
    """Parts whose ranges don't follow each other."""


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def supported(path: str) -> bool:
    """Whether ``pyarrow.fs`` opens such a path."""
    try:
        opened(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


@dataclass
class Part(WriterCommitMessage):
    """What a task wrote: its number, file, lines, bytes, digest, first and last place."""

    number: int
    file: str
    lines: int
    bytes: int
    sha256: str
    first: int | None
    last: int | None


class OrderedLines(DataSource):
    """``place`` (long) and ``line`` (string) in sorted ranges, to the folder ``path``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: StructType, overwrite: bool) -> OrderedLinesWriter:
        if schema.fieldNames() != ["place", "line"]:
            raise ValueError(f"columns must be place and line, not {', '.join(schema.fieldNames())}")
        return OrderedLinesWriter(self.options["path"], overwrite)


class OrderedLinesWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.token = path.rstrip("/"), overwrite, uuid.uuid4().hex
        fs, root = opened(self.path)
        if not overwrite and fs.get_file_info(root).type != pafs.FileType.NotFound:
            raise FileExistsError(self.path)

    @property
    def attempts(self) -> str:
        return f"{opened(self.path)[1]}/_attempts-{self.token}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        context = TaskContext.get()
        fs, _ = opened(self.path)
        name = f"{self.attempts}/{context.partitionId():06d}-{context.taskAttemptId()}"
        fs.create_dir(self.attempts, recursive=True)
        sha, lines, size, first, last = hashlib.sha256(), 0, 0, None, None
        with fs.open_output_stream(name) as out:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                places = batch.column(0)
                data = ("\n".join(batch.column(1).to_pylist()) + "\n").encode()
                out.write(data)
                sha.update(data)
                lines, size = lines + batch.num_rows, size + len(data)
                first, last = places[0].as_py() if first is None else first, places[-1].as_py()
        return Part(context.partitionId(), name, lines, size, sha.hexdigest(), first, last)

    def commit(self, messages: list[Part | None]) -> None:
        fs, root = opened(self.path)
        parts = sorted((m for m in messages if m is not None and m.lines), key=lambda m: m.number)
        for a, b in zip(parts, parts[1:]):
            if a.last > b.first:
                raise OutOfOrder(f"part {b.number} begins at {b.first}, before the end of part {a.number} at {a.last}")
        if self.overwrite:
            for info in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
                if info.path.rstrip("/") != self.attempts.rstrip("/"):
                    fs.delete_dir(info.path) if info.type == pafs.FileType.Directory else fs.delete_file(info.path)
        fs.create_dir(root, recursive=True)
        said = []
        for k, m in enumerate(parts):
            name = f"part-{k:06d}.jsonl"
            fs.move(m.file, f"{root}/{name}")
            said.append({"name": name, "lines": m.lines, "bytes": m.bytes, "sha256": m.sha256})
        whole = {"sha256": hashlib.sha256("".join(p["sha256"] for p in said).encode()).hexdigest(), "lines": sum(p["lines"] for p in said), "bytes": sum(p["bytes"] for p in said), "parts": said}
        self._drop(fs)
        for name, data in ((DIGEST, json.dumps(whole, indent=2)), ("_SUCCESS", "")):
            with fs.open_output_stream(f"{root}/{name}") as out:
                out.write(data.encode())

    def abort(self, messages: list[Part | None]) -> None:
        self._drop(opened(self.path)[0])

    def _drop(self, fs: pafs.FileSystem) -> None:
        if fs.get_file_info(self.attempts).type == pafs.FileType.Directory:
            fs.delete_dir(self.attempts)


def write_lines(lines: DataFrame, place: str, line: str, path: str, mode: str = "append") -> dict:
    """Writes ``line`` in the order of ``place``; returns the digests.  A folder that is
    there is an error unless ``mode`` is ``overwrite``."""
    lines.sparkSession.dataSource.register(OrderedLines)
    ordered = lines.selectExpr(f"cast(`{place}` as long) AS place", f"`{line}` AS line").repartitionByRange("place").sortWithinPartitions("place")
    ordered.write.format(NAME).mode(mode).option("path", path).save()
    return read_digest(path)


def read_digest(path: str) -> dict:
    """The digests that a finished write left."""
    fs, root = opened(path.rstrip("/"))
    with fs.open_input_stream(f"{root}/{DIGEST}") as f:
        return json.loads(f.read())
