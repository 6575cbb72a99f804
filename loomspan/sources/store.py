"""Small files and folders on whatever file system a path names, through Hadoop's API.

Spark reads and writes its tables there itself; this is for what lies beside them:
checkpoints, claims, manifests, reports.  The one primitive that ordering between writers
rests on is ``put_new``, which makes a file only if none is there.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class AlreadyThere(FileExistsError):
    """Somebody else made the file first."""


def join(*parts: str) -> str:
    """A path from its parts."""
    return "/".join([parts[0].rstrip("/"), *(p.strip("/") for p in parts[1:])])


def name_of(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


class Store:
    """Files by path."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def is_folder(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p) and fs.getFileStatus(p).isDirectory()

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none where there is no folder."""
        fs, p = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def size(self, path: str) -> int:
        """Bytes of a file, or of all files in a folder."""
        fs, p = self._at(path)
        return fs.getContentSummary(p).getLength() if fs.exists(p) else 0

    def delete(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p) and fs.delete(p, True)

    def read(self, path: str) -> bytes:
        """A small file, whole."""
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def read_json(self, path: str) -> object:
        return json.loads(self.read(path))

    def _write(self, path: str, data: bytes, over: bool) -> None:
        fs, p = self._at(path)
        stream = fs.create(p, over)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()

    def put_new(self, path: str, data: bytes) -> None:
        """Makes a file where none is: of several writers one wins, the others get
        ``AlreadyThere``.  A writer that dies in between may leave a torn file, which
        readers must take for none."""
        try:
            self._write(path, data, over=False)
        except Exception as e:
            if self.exists(path):
                raise AlreadyThere(path) from e
            raise

    def put(self, path: str, data: bytes) -> None:
        """Makes or replaces a file; readers see the old one or the new one or, for a
        moment, none, but never a part."""
        fs, p = self._at(path)
        whole = f"{path}.tmp"
        self._write(whole, data, over=True)
        self.delete(path)
        if not fs.rename(self._at(whole)[1], p):
            raise OSError(f"{whole} could not be renamed to {path}")

    def put_json(self, path: str, document: object, *, new: bool = False) -> None:
        data = json.dumps(document, indent=2, sort_keys=True, ensure_ascii=False).encode()
        (self.put_new if new else self.put)(path, data)

    def move_folder(self, source: str, destination: str) -> None:
        """Renames a folder to a place where nothing is."""
        fs, p = self._at(destination)
        if fs.exists(p):
            raise AlreadyThere(destination)
        parent = p.getParent()
        if parent is not None and not fs.exists(parent):
            fs.mkdirs(parent)
        if not fs.rename(self._at(source)[1], p):
            raise OSError(f"{source} could not be renamed to {destination}")


def publish(store: Store, staging: str, destination: str, owner: str, *, gate_passed: bool) -> None:
    """Puts a staged folder in its place, once: the claim beside the destination names its
    owner and stays, so of two writers one wins, and the winner may go on after a crash.

    Refused without a passed gate."""
    if not gate_passed:
        raise PermissionError("the gate was not passed")
    claim = f"{destination}.owner"
    if store.exists(destination) and not store.exists(claim):
        raise AlreadyThere(destination)
    try:
        store.put_new(claim, owner.encode())
    except AlreadyThere:
        if store.read(claim).decode() != owner:
            raise AlreadyThere(destination) from None
    if store.exists(destination):
        # this run's own, from before a crash
        store.delete(staging)
        return
    store.move_folder(staging, destination)


def parts_sha256(spark: SparkSession, folder: str) -> str | None:
    """SHA-256 over the SHA-256 of the folder's parts, in the order of names, each made by
    the task that reads the part.  A single file is the one part it is.  None where
    nothing is there."""
    store = Store(spark)
    if not store.exists(folder):
        return None
    found: DataFrame = spark.read.format("binaryFile").load(folder)
    if not store.is_folder(folder):
        return found.select(F.sha2("content", 256)).first()[0]
    parts = found.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha")).where("name like 'part-%'")
    return hashlib.sha256("".join(r["sha"] for r in parts.orderBy("name").collect()).encode()).hexdigest()
