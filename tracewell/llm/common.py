"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a maximal run of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
#: The fold that no model learns from.
FOLDS, HELD_OUT = 4, 2
#: Folders that ``materialize`` has written for the innermost ``workspace``; None outside of any.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` if the session has it, else
    (single-machine sessions such as the tests) a fresh temporary folder that is remembered in the session."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("tracewell.shared.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tracewell-")
        spark.conf.set("tracewell.shared.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again: lineage is cut there, and a lost
    executor costs no more than a reread. The folder belongs to the ``workspace`` around the call; without one it
    stays, as its reader may be a result that is computed later."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def workspace(spark: SparkSession) -> Iterator[None]:
    """What is materialised inside, and only that, is deleted at the end, also after a failure: results that read it must
    have been written by then. Workspaces of other calls, threads or pipelines are left alone."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        delete(spark, *made)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """Whether a document lies in the held-out fold; a null id does, so that nothing is learned from it."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(True))


def small(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that a worker holds the Python objects of few texts at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's function that gives Arrow's free memory back at its end: workers live on and would keep it."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return whole


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The whole texts of a batch; null counts as empty."""
    return ["" if x is None else x for x in batch.column(name).to_pylist()]


def text_edges(texts: pa.Array) -> np.ndarray:
    """Where each text of a string array begins in its buffer of bytes, and where the last one ends."""
    if not len(texts):
        return np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    return np.frombuffer(texts.buffers()[1], width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


#: Bits of the sieve; 2^26 bits are 8 MB, which bounds what is broadcast.
SIEVE_BITS = 26


def sieve(rows: DataFrame, wanted: DataFrame, on: str = "key") -> DataFrame:
    """``rows`` with __hit: false only where ``on`` is for certain none of the wanted ones (column ``key``). The sieve
    is one bitmap of fixed size, so it is broadcast whatever the number of keys."""
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << SIEVE_BITS)) + 1
    bits = wanted.select(slot("key").alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("__bits"))
    at = F.bitmap_bit_position(slot(on)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.pmod(F.floor(byte / F.pow(F.lit(2), at % 8)), F.lit(2)) == 1, F.lit(False))
    return rows.withColumn("__bucket", F.bitmap_bucket_number(slot(on))).join(F.broadcast(bits), "__bucket", "left").withColumn("__hit", hit).drop("__bucket", "__bits")


def bitmap(wanted: Column, of: DataFrame, bits: int = SIEVE_BITS) -> Broadcast:
    """The sieve for Python tasks: one bit for each value of 2^bits that the low bits of the (well mixed, long) column
    take. Its size is fixed, so the driver assembles and broadcasts it whatever the number of rows."""
    slot = of.select((F.pmod(wanted, F.lit(1 << bits)) + 1).alias("slot"))
    parts = slot.groupBy(F.bitmap_bucket_number("slot").alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("set")).collect()
    out = np.zeros(max(1, (1 << bits) >> 15) << 12, np.uint8)
    for r in parts:
        out[(r["at"] - 1) << 12 : r["at"] << 12] = np.frombuffer(r["set"], np.uint8)
    return of.sparkSession.sparkContext.broadcast(out)


def marked(sieve_bits: np.ndarray, keys: np.ndarray, bits: int = SIEVE_BITS) -> np.ndarray:
    """False only where a key is for certain none of those that ``bitmap`` has seen."""
    at = keys.view(np.uint64) & np.uint64((1 << bits) - 1)
    return (sieve_bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
