"""NumPy archives as a Spark data source that reads only what is asked for.

``spark.read.format("npz").schema(...)`` over folders topo_<k>/*.npz: the schema names the members, and a task reads of
each archive the directory at its end and those members, by seeking; a 0-d member is a value, others are arrays. Next
to members a schema may name ``path``, ``topo_dir``, ``iter_idx``, ``names`` (all members) and ``<member>_rows`` (the
length of a member's first axis, from its header alone).

Partitions are chunks of archives with about the same bytes. Filters on topo_dir and iter_idx (equality, IN and
comparisons) are pushed down where the session has ``spark.sql.python.filterPushdown.enabled``: archives they exclude
are neither dealt out nor opened.

Options: ``roots`` (a JSON list; or the path to load), ``glob`` of the file names, ``chunk_bytes`` and ``chunk_files``.
Stores are those that pyarrow can seek in; ``ranged`` tells which. Others are read whole by Spark's binary reader
(``npz``).
"""

from __future__ import annotations

import ast
import fnmatch
import json
import os
import re
import struct
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

SCHEMES = ("", "file", "hdfs", "s3", "gs", "abfs", "abfss")
CHUNK_BYTES, CHUNK_FILES = 64 << 20, 256
OWN = ("path", "topo_dir", "iter_idx", "names")


def scheme(path: str) -> str:
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    return found.group(1).lower() if found else ""


def ranged(roots: Sequence[str]) -> bool:
    """Whether tasks can seek in the files of these folders."""
    return all(scheme(r) in SCHEMES for r in roots)


def _local(path: str) -> str | None:
    return re.sub(r"^file:(//)?(?=/)", "", path) if scheme(path) in ("", "file") else None


def filesystem(path: str) -> tuple[Any, str]:
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def children(path: str) -> Iterator[tuple[str, int | None]]:
    """Name and size of what lies in a folder; folders have none."""
    if (local := _local(path)) is not None:
        with os.scandir(local) as found:
            yield from ((e.name, None if e.is_dir() else e.stat().st_size) for e in found)
        return
    from pyarrow import fs

    store, base = filesystem(path)
    yield from ((f.base_name, None if f.type == fs.FileType.Directory else f.size) for f in store.get_file_info(fs.FileSelector(base)))


def opened(path: str) -> Any:
    """A file that can be sought in; a context manager."""
    if (local := _local(path)) is not None:
        return open(local, "rb")
    store, place = filesystem(path)
    return store.open_input_file(place)


class Counted:
    """A seekable file that counts the bytes read from it."""

    def __init__(self, file: Any):
        self.file, self.n = file, 0

    def read(self, size: int = -1) -> bytes:
        out = self.file.read() if size is None or size < 0 else self.file.read(size)
        self.n += len(out)
        return out

    def seek(self, at: int, whence: int = 0) -> int:
        self.file.seek(at, whence)
        return self.file.tell()

    def tell(self) -> int:
        return self.file.tell()

    def seekable(self) -> bool:
        return True


def _header(fp: Any) -> tuple[tuple[int, ...], bool, np.dtype]:
    """Shape, order and type of a .npy stream, which stands at its data afterwards."""
    magic = fp.read(8)
    if magic[:6] != b"\x93NUMPY":
        raise ValueError("a member is no NumPy array")
    size = struct.unpack("<H", fp.read(2))[0] if magic[6] == 1 else struct.unpack("<I", fp.read(4))[0]
    head = ast.literal_eval(fp.read(size).decode("latin1"))
    kind = np.dtype(head["descr"])
    if kind.hasobject:
        raise ValueError("a member holds Python objects")
    return head["shape"], head["fortran_order"], kind


def read_members(file: Any, wanted: Iterable[str]) -> tuple[list[str], dict[str, Any]]:
    """All member names of an archive, and the wanted ones that it has: arrays, or for ``<member>_rows`` a length."""
    with zipfile.ZipFile(file) as z:
        names = [n[:-4] for n in z.namelist() if n.endswith(".npy")]
        out: dict[str, Any] = {}
        for want in wanted:
            length = want not in names and want.endswith("_rows")
            name = want[:-5] if length else want
            if name not in names:
                continue
            with z.open(f"{name}.npy") as fp:
                shape, fortran, kind = _header(fp)
                if length:
                    out[want] = int(shape[0]) if shape else 1
                    continue
                count = int(np.prod(shape, dtype=np.int64))
                data = np.frombuffer(fp.read(count * kind.itemsize), kind, count)
                out[want] = data.reshape(shape, order="F" if fortran else "C")
        return sorted(names), out


@dataclass
class Chunk(InputPartition):
    paths: list[str]


class NpzSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "npz"

    def schema(self) -> str:
        return "path string, topo_dir string, iter_idx long, names array<string>"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        options = dict(self.options)
        return (FilteringReader if options.get("push") == "true" else NpzReader)(schema, options)


def archives(spark: SparkSession, roots: Sequence[str], schema: str, glob: str = "*.npz", **options: Any) -> DataFrame:
    """The archives below some folders with the members that the schema names."""
    spark.dataSource.register(NpzSource)
    push = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false").lower()
    return spark.read.format("npz").schema(schema).options(glob=glob, roots=json.dumps(list(roots)), push=push, **options).load()


def _parts(path: str) -> dict[str, Any]:
    """Folder and number of a file, from its path."""
    folder, name = path.rstrip("/").split("/")[-2:]
    runs = re.findall(r"\d+", name)
    return {"topo_dir": folder, "iter_idx": int(runs[-1]) if runs else None}


class NpzReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema_, self.options = schema, options
        self.filters: list[Filter] = []

    def _holds(self, path: str) -> bool:
        at = _parts(path)
        for f in self.filters:
            v = at[f.attribute[0]]
            if v is None:
                return False
            if isinstance(f, In):
                ok = v in f.value
            else:
                ok = {EqualTo: v == f.value, GreaterThan: v > f.value, GreaterThanOrEqual: v >= f.value, LessThan: v < f.value, LessThanOrEqual: v <= f.value}[type(f)]
            if not ok:
                return False
        return True

    def listed(self) -> list[tuple[str, int]]:
        """Path and size of the archives that the filters leave, in order of their paths."""
        roots = json.loads(self.options["roots"]) if "roots" in self.options else [self.options["path"]]
        glob, found = self.options.get("glob", "*.npz"), {}
        for root in roots:
            base = root.rstrip("/") if _local(root) is None else f"file:{os.path.abspath(_local(root))}"
            for folder, size in children(base):
                if size is None and fnmatch.fnmatchcase(folder, "topo_*"):
                    for name, n in children(f"{base}/{folder}"):
                        path = f"{base}/{folder}/{name}"
                        if n is not None and fnmatch.fnmatchcase(name, glob) and name[0] not in "_." and self._holds(path):
                            found[path] = n
        return sorted(found.items())

    def partitions(self) -> Sequence[InputPartition]:
        most, files = int(self.options.get("chunk_bytes", CHUNK_BYTES)), int(self.options.get("chunk_files", CHUNK_FILES))
        chunks: list[list[str]] = []
        size = 0
        for path, n in self.listed():
            if not chunks or size + n > most or len(chunks[-1]) >= files:
                chunks.append([])
                size = 0
            chunks[-1].append(path)
            size += n
        return [Chunk(c) for c in chunks]

    def read(self, partition: Chunk | None) -> Iterator[pa.RecordBatch]:
        fields = self.schema_.fields
        members = [f.name for f in fields if f.name not in OWN]
        kinds = {T.DoubleType(): pa.float64(), T.FloatType(): pa.float32(), T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.StringType(): pa.string()}
        kind = lambda t: pa.list_(kinds[t.elementType]) if isinstance(t, T.ArrayType) else kinds[t]
        schema = pa.schema([(f.name, kind(f.dataType)) for f in fields])
        for at in range(0, len(partition.paths) if partition else 0, 16):
            rows: list[list[Any]] = []
            for path in partition.paths[at : at + 16]:
                try:
                    with opened(path) as file:
                        names, held = read_members(Counted(file), members)
                except (OSError, ValueError, zipfile.BadZipFile, SyntaxError) as x:
                    raise ValueError(f"{path} cannot be read as a NumPy archive: {x}") from x
                own = {"path": path, "names": names, **_parts(path)}
                row = []
                for f in fields:
                    v = own[f.name] if f.name in OWN else held.get(f.name)
                    if isinstance(v, np.ndarray):
                        v = v.ravel() if isinstance(f.dataType, T.ArrayType) else v.item()
                    row.append(v)
                rows.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) if not pa.types.is_list(f.type) or f.name == "names" else pa.array([None if r[i] is None else np.asarray(r[i], f.type.value_type.to_pandas_dtype()) for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


class FilteringReader(NpzReader):
    """The reader where the session pushes filters down (Spark refuses one that could where it doesn't)."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes those on topo_dir and iter_idx; Spark applies the others."""
        for f in filters:
            column = getattr(f, "attribute", ())
            if isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and column in (("topo_dir",), ("iter_idx",)):
                self.filters.append(f)
            else:
                yield f
