"""NumPy archives as tables. Files come through Spark's binary reader, so any store that Spark reads will do; each
task opens the archives in its rows and decodes only the members it needs.

Detections: topo_<k>/mea_iter_<n>.npz. Connectivity: topo_<k>/iter_<n>.npz.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions.expr import parent_name, trailing_index
from tracewell.operators.registry import TOPOLOGY_AXES
from tracewell.sources.archive_source import archives, ranged

DETECTION_GLOB, TOPOLOGY_GLOB = "mea_iter_*.npz", "iter_*.npz"
REQUIRED = ("det_t", "det_ch", "theta")
#: Archives that a worker holds decoded at a time, and paths that are read by name rather than met in a join.
SLICE, FEW = 16, 1_000
_RAW = "path string, det_t array<double>, det_ch array<bigint>, theta array<double>, params array<double>, topo_raw bigint, seed_raw bigint, centers bigint, problem string"


def _files(spark: SparkSession, roots: str | list[str], pattern: str) -> DataFrame:
    """Files two levels below the roots: topo_*/pattern."""
    roots = [roots] if isinstance(roots, str) else roots
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load([f"{r.rstrip('/')}/topo_*" for r in roots])


def listed(spark: SparkSession, roots: str | list[str], pattern: str = DETECTION_GLOB) -> DataFrame:
    """path, topo_dir and iter_idx of the files, from the listing alone: no file is opened."""
    return _files(spark, roots, pattern).select("path", parent_name(F.col("path")).alias("topo_dir"), trailing_index(F.col("path")).alias("iter_idx"))


def first_files(files: DataFrame, n: int) -> DataFrame:
    """The first n rows by ``path``, as text: 10 comes before 2."""
    return files.orderBy("path").limit(n)


def lacking(keys: Column, needed: Sequence[str]) -> Column:
    """What is needed and not among the keys, in order."""
    return F.array_except(F.array(*[F.lit(k) for k in needed]), keys)


def _members(content: bytes, names: tuple[str, ...], path: str) -> dict[str, np.ndarray]:
    try:
        with np.load(io.BytesIO(content), allow_pickle=False) as z:
            return {n: np.asarray(z[n]) for n in names if n in z.files}
    except Exception as x:
        raise ValueError(f"{path} cannot be read as a NumPy archive: {x}") from x


def read_detections(spark: SparkSession, roots: str | list[str], n_electrodes: int | None = None, max_records: int | None = None) -> DataFrame:
    """One row a file: path, topo_dir, topo_idx, iter_idx, seed_run, n_electrodes, det_t, det_ch, theta, params.

    topo_idx falls back on the folder's number, seed_run on -1, the number of electrodes on the rows of the stored
    centres unless it is given. ``max_records`` takes the first files by path (0 takes none) before any is opened.
    """
    files = _files(spark, roots, DETECTION_GLOB)
    if max_records is not None:
        first = first_files(listed(spark, roots).select("path"), max_records)
        few = [r["path"] for r in first.limit(FEW + 1).collect()]
        if len(few) <= FEW and not any(c in p for p in few for c in "*?[]{}"):  # so that only these are opened
            files = spark.read.format("binaryFile").load(few) if few else files.filter(F.lit(False))
        else:
            files = files.join(first, "path", "left_semi")

    rows = decoded(files)
    n = F.lit(n_electrodes).cast("bigint") if n_electrodes is not None else F.coalesce("centers", F.raise_error(F.concat("path", F.lit(" has no electrode centres; give n_electrodes"))).cast("bigint"))
    return rows.select("path", "topo_dir", "topo_idx", "iter_idx", "seed_run", n.alias("n_electrodes"), "det_t", "det_ch", "theta", "params")


def decoded(files: DataFrame, strict: bool = True) -> DataFrame:
    """Archives (path, content) as rows: path, topo_dir, topo_idx, iter_idx, seed_run, centers (stored electrodes, or null),
    det_t, det_ch, theta, params and problem. A file that can't be read or lacks a member stops the job, or, unless
    ``strict``, gives a row that says so in ``problem``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doubles, longs = pa.list_(pa.float64()), pa.list_(pa.int64())
        types = {"path": pa.string(), "det_t": doubles, "det_ch": longs, "theta": doubles, "params": doubles, "topo_raw": pa.int64(), "seed_raw": pa.int64(), "centers": pa.int64(), "problem": pa.string()}
        for b in (whole.slice(at, SLICE) for whole in batches for at in range(0, whole.num_rows, SLICE)):
            rows = []
            for path, content in zip(b.column("path").to_pylist(), b.column("content")):
                try:
                    m = _members(content.as_py(), (*REQUIRED, "params", "topo_idx", "seed_run", "electrode_centers"), path)
                    if lacking := [k for k in REQUIRED if k not in m]:
                        raise KeyError(f"{path} lacks {lacking}")
                except (KeyError, ValueError) as x:
                    if strict:
                        raise
                    rows.append({k: path if k == "path" else x.args[0] if k == "problem" else None for k in types})
                    continue
                whole = lambda k: int(m[k]) if k in m else None  # noqa: B023, E731
                rows.append({
                    "path": path, "det_t": m["det_t"].astype(np.float64).ravel(), "det_ch": m["det_ch"].astype(np.int64).ravel(), "theta": m["theta"].astype(np.float64).ravel(),
                    "params": m["params"].astype(np.float64).ravel() if "params" in m else None, "topo_raw": whole("topo_idx"), "seed_raw": whole("seed_run"),
                    "centers": len(m["electrode_centers"]) if "electrode_centers" in m else None, "problem": None,
                })
            if rows:
                yield pa.RecordBatch.from_pydict({k: pa.array([r[k] for r in rows], t) for k, t in types.items()})

    raw, topo_dir = files.select("path", "content").mapInArrow(run, _RAW), parent_name(F.col("path"))
    topo = F.coalesce("topo_raw", trailing_index(topo_dir)).alias("topo_idx")
    return raw.select("path", topo_dir.alias("topo_dir"), topo, trailing_index(F.col("path")).alias("iter_idx"), F.coalesce("seed_raw", F.lit(-1)).cast("long").alias("seed_run"), "centers", "det_t", "det_ch", "theta", "params", "problem")


def read_topology(spark: SparkSession, roots: str | list[str], with_path: bool = False) -> DataFrame:
    """One row a sweep file: topo_dir, iter_idx and the four connectivity values (null where a file lacks one). Where
    tasks can seek in the store, only the directory and these members of an archive are read (``archive_source``)."""
    roots = [roots] if isinstance(roots, str) else roots
    if ranged(roots):
        members = ", ".join(f"{a} double" for a in TOPOLOGY_AXES)
        raw = archives(spark, roots, f"path string, topo_dir string, iter_idx long, {members}", TOPOLOGY_GLOB)
        return raw if with_path else raw.drop("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(at, SLICE) for whole in batches for at in range(0, whole.num_rows, SLICE)):
            found = [_members(c.as_py(), TOPOLOGY_AXES, p) for p, c in zip(b.column("path").to_pylist(), b.column("content"))]
            yield pa.RecordBatch.from_arrays([b.column("path"), *(pa.array([float(m[a]) if a in m else None for m in found], pa.float64()) for a in TOPOLOGY_AXES)], ["path", *TOPOLOGY_AXES])

    raw = _files(spark, roots, TOPOLOGY_GLOB).select("path", "content").mapInArrow(run, "path string, " + ", ".join(f"{a} double" for a in TOPOLOGY_AXES))
    return raw.select(*(["path"] if with_path else []), parent_name(F.col("path")).alias("topo_dir"), trailing_index(F.col("path")).alias("iter_idx"), *TOPOLOGY_AXES)


def described(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, sorted member names, width of theta and number of electrodes of single archives; values aren't decoded
    beyond these. A file that is no archive has null names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(at, SLICE) for whole in batches for at in range(0, whole.num_rows, SLICE)):
            names, widths, electrodes = [], [], []
            for content in b.column("content"):
                try:
                    with np.load(io.BytesIO(content.as_py()), allow_pickle=False) as z:
                        have = sorted(z.files)
                        width, members = (z["theta"].size if "theta" in have else None), (len(z["electrode_centers"]) if "electrode_centers" in have else None)
                except (ValueError, OSError, zipfile.BadZipFile):
                    have = width = members = None
                names.append(have)
                widths.append(width)
                electrodes.append(members)
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(names, pa.list_(pa.string())), pa.array(widths, pa.int64()), pa.array(electrodes, pa.int64())], ["path", "names", "theta_width", "n_electrodes"])

    schema = "path string, names array<string>, theta_width long, n_electrodes long"
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInArrow(run, schema)
