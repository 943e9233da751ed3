"""What the operators of this package share: the query list, the shared folder, row batches, hashes."""

from __future__ import annotations

import ctypes
import functools
import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Words of a worker's hash table are forgotten beyond this number; only speed depends on it.
_KEPT_WORDS = 300_000


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL twin if SQL can say it."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Workers keep word tables between tasks, so their functions must be imported and not shipped by
    value. A cluster that does not share this path has the package installed, or gets it as a zip.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below `spark.checkpoint.dir`, or else below the session's checkpoint folder.

    Driver and executors must all reach it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


# Buffers of a Parquet writer; the default of 128 MB is a lot where several tasks share a small executor.
_ROW_GROUP = 32 << 20
_ROWS_A_TASK = 100_000


def stored(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The rows, written to the shared folder and read back.

    Used where a later step must see one fixed version of the rows, or where a join needs a
    plain scan on this side so that adaptive execution may split a skewed partition. With `rows`, about
    how many there are, the last stage has a task for each 100,000 of them, if not fewer already.
    """
    folder = shared_folder(df.sparkSession)
    kept = df if rows is None else df.coalesce(rows // _ROWS_A_TASK + 1)
    kept.write.option("parquet.block.size", _ROW_GROUP).parquet(folder)
    out = df.sparkSession.read.schema(df.schema).parquet(folder)
    out.__dict__["stored_in"] = folder
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the files of stored rows that nothing needs any more: all that was made of them is stored itself."""
    for frame in frames:
        folder = frame.__dict__.pop("stored_in", None)
        if folder:
            spark = frame.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_parts(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, so that what is made of one slice stays small."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def whole_text(text: str = "text") -> Column:
    """The text; a null text counts as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def with_fields(schema: T.StructType, **fields: str) -> T.StructType:
    """The schema with more columns; `schema` itself stays as it is."""
    more = T.StructType()
    for name, kind in fields.items():
        more.add(name, kind)
    return T.StructType([*schema.fields, *more.fields])


def as_bytes(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes, without decoding."""
    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.binary()).to_pylist()


@functools.cache
def _malloc_trim() -> Callable[[int], int] | None:
    """The C library's call that hands free pages back; None where there is none."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Hand memory that is free but still held by the allocators back to the system.

    Freed arrays of some megabytes otherwise stay with the worker, which lives on from job to job.
    """
    pa.default_memory_pool().release_unused()
    trim = _malloc_trim()
    if trim:
        trim(0)


_CACHES: dict[str, Callable[[], None]] = {}


def cached(name: str, clear: Callable[[], None]) -> None:
    """Name a table that workers keep between tasks, and how to empty it."""
    _CACHES[name] = clear


def claim(name: str) -> None:
    """Empty the tables that other operators have left in this worker: it lives on from job to job."""
    for other, clear in _CACHES.items():
        if other != name:
            clear()
    release()


class WordHashes(dict):
    """64-bit hashes of words, remembered while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


WORD_HASHES = WordHashes()
cached("words", WORD_HASHES.clear)


def powers(n: int, base: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)[:n]


_WINDOW_BASE = 0x9E3779B97F4A7C15


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for every run of n neighbouring values."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for j, factor in enumerate(powers(n, _WINDOW_BASE)):
        out += hashes[j : j + count] * factor
    return mixed(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values, so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching [start, end) runs joined, in order."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def rows_out(schema: pa.Schema, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows as one record batch of the given schema."""
    if rows:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)
