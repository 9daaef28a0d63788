"""Small files in any store that Spark writes to, through Hadoop's file system: read, write at once, move, look."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share (``spark.checkpoint.dir``); single-machine sessions
    that have none use a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="tracewell-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Store:
    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def qualified(self, path: str) -> str:
        """The path as Spark's readers name it."""
        fs, p = self._path(path)
        return fs.makeQualified(p).toString()

    def exists(self, path: str) -> bool:
        fs, p = self._path(path)
        return fs.exists(p)

    def children(self, path: str) -> list[str]:
        fs, p = self._path(path)
        return [s.getPath().toString() for s in fs.listStatus(p)] if fs.exists(p) else []

    def delete(self, path: str) -> None:
        fs, p = self._path(path)
        fs.delete(p, True)

    def move(self, source: str, target: str) -> None:
        """Rename; the target must not exist (a rename into an existing folder would nest)."""
        fs, p = self._path(source)
        if self.exists(target) or not fs.rename(p, self._jvm.org.apache.hadoop.fs.Path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def write_bytes(self, path: str, data: bytes) -> None:
        """Write a new small file."""
        fs, p = self._path(path)
        out = fs.create(p, False)
        try:
            out.write(bytearray(data))
        finally:
            out.close()

    def write_text(self, path: str, text: str) -> None:
        """Write beside the target and move into place, so that readers see all or nothing."""
        fs, p = self._path(path)
        part = self._jvm.org.apache.hadoop.fs.Path(f"{path}.part")
        try:
            out = fs.create(part, True)
            out.write(bytearray(text.encode()))
            out.close()
            if fs.exists(p):
                fs.delete(p, False)
            if not fs.rename(part, p):
                raise OSError(f"cannot move {path}.part into place")
        finally:
            fs.delete(part, False)

    def read_text(self, path: str) -> str:
        fs, p = self._path(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
