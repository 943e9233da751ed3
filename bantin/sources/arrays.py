"""Large JSON arrays of records, read by many tasks at once.

A record cannot be found by looking at one place of a file: a brace may be in a string, or belong to a
record inside a record. So a file is cut into byte ranges and gone through twice. The first pass tells
of each range, for both cases of its start (inside a string or not), whether it ends inside one and by how
much it goes down or up in nesting; put together in order, this gives the state at every border. In
the second pass each range knows its state, and cuts out the records that start in it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bantin.sources.workspace import materialise, new_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANGE_BYTES = 32 << 20
_QUOTE, _BACKSLASH = b'"\\'
_OPENS, _CLOSES = np.frombuffer(b"[{", np.uint8), np.frombuffer(b"]}", np.uint8)
_SPACE = np.frombuffer(b" \t\r\n", np.uint8)


def _open(path: str):
    # Spark writes local paths with one slash.
    system, place = fs.FileSystem.from_uri(path if "://" in path else path.replace(":/", ":///", 1))
    return system.open_input_file(place)


def _escaped(data: np.ndarray, before: int) -> np.ndarray:
    """Whether each byte follows an odd run of backslashes; `before` are those just before the data."""
    slash = data == _BACKSLASH
    at = np.arange(len(data))
    last_other = np.maximum.accumulate(np.where(slash, -1, at)) if len(data) else at
    # Length of the run of backslashes that ends at each byte; a run at the start goes on from before.
    run = np.where(slash, at - last_other + np.where(last_other < 0, before, 0), 0)
    return np.concatenate([[before % 2 == 1], run[:-1] % 2 == 1]) if len(data) else np.zeros(0, bool)


def _scan(data: np.ndarray, before: int, in_string: bool) -> tuple[np.ndarray, bool]:
    """The change of depth that each byte makes, and whether the data ends inside a string."""
    quote = (data == _QUOTE) & ~_escaped(data, before)
    inside = (np.cumsum(quote) + in_string) % 2 == 1
    step = np.isin(data, _OPENS).astype(np.int64) - np.isin(data, _CLOSES)
    return np.where(inside | quote, 0, step), bool(inside[-1]) if len(data) else in_string


def _slashes_before(file, at: int) -> int:
    """Length of the run of backslashes that ends just before a place."""
    n, step = 0, 64
    while at > 0:
        take = min(step, at)
        file.seek(at - take)
        part = file.read(take)
        rest = len(part) - len(part.rstrip(b"\\"))
        n += rest
        if rest < take:
            break
        at -= take
        step *= 2
    return n


def _ranges(spark: SparkSession, path: str, range_bytes: int) -> DataFrame:
    """file, number and bounds of each range, one after another."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    last = F.greatest(F.floor((F.col("length") - 1) / range_bytes), F.lit(0))
    cut = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("number"))
    start = F.col("number") * range_bytes
    return cut.select("path", "number", start.alias("start"), F.least(start + range_bytes, "length").alias("end"))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each range does to the state, from either start, and the first byte in it that is not white space."""
    for batch in batches:
        for path, number, start, end in zip(*(batch[c].to_pylist() for c in ("path", "number", "start", "end"))):
            with _open(path) as file:
                before = _slashes_before(file, start)
                file.seek(start)
                data = np.frombuffer(file.read(end - start), np.uint8)
            outside, flips = _scan(data, before, False)
            inside, _ = _scan(data, before, True)
            filled = data[~np.isin(data, _SPACE)]
            row = [path, number, int(flips), int(outside.sum()), int(inside.sum()), int(filled[0]) if len(filled) else None]
            types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], ["path", "number", "flips", "outside", "inside", "first"])


def _records(block: int):
    """The records that start in each range, each as JSON text on one line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end, in_string, depth, base in zip(*(batch[c].to_pylist() for c in ("path", "start", "end", "in_string", "depth", "base"))):
                with _open(path) as file:
                    for found in _cut(file, start, end, in_string, depth, base, block):
                        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["value"])

    return run


def _cut(file, start: int, end: int, in_string: bool, depth: int, base: int, block: int) -> Iterator[list[str]]:
    """Lists of records. A record begins where the depth leaves `base`, and ends where it is back there."""
    before, at, held, begun = _slashes_before(file, start), start, b"", None
    file.seek(start)
    while at < end or begun is not None:
        raw = file.read(min(block, end - at) if at < end else block)
        if not raw:
            break
        step, now_in_string = _scan(np.frombuffer(raw, np.uint8), before, in_string)
        level = depth + np.cumsum(step)
        begins = (np.flatnonzero((step == 1) & (level == base + 1)) + at).tolist()
        ends = (np.flatnonzero((step == -1) & (level == base)) + at).tolist()
        whole, origin = held + raw, at - len(held)
        if begun is not None:
            begins.insert(0, begun)
        if ends and (not begins or ends[0] < begins[0]):
            del ends[0]  # of a record that began in the range before
        found = [whole[a - origin : b + 1 - origin] for a, b in zip(begins, ends) if a < end]
        if found:
            yield [f.replace(b"\r", b" ").replace(b"\n", b" ").decode() for f in found]
        begun = begins[-1] if len(begins) > len(ends) and begins[-1] < end else None
        held = b"" if begun is None else whole[begun - origin :]
        slashes = len(raw) - len(raw.rstrip(b"\\"))
        before = slashes if slashes < len(raw) else before + slashes
        in_string, depth, at = now_in_string, int(level[-1]), at + len(raw)


def record_lines(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, block: int = 4 << 20) -> DataFrame:
    """`value`: the records of JSON files as lines of text; a file holds one array of records, or records one after another.

    Items that are neither objects nor arrays are left out. Files are read by Arrow's file systems, so
    paths must be of a kind they know (local, HDFS, S3, GCS, ABFS).
    """
    ranges = materialise(_ranges(spark, path, range_bytes))
    # A range is a task's work, however small its row.
    dealt = ranges.repartition(max(1, min(ranges.count(), 10_000)), "path", "number")
    told = materialise(dealt.mapInArrow(_summaries, "path string, number long, flips int, outside long, inside long, first int"))
    earlier = Window.partitionBy("path").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy("path").orderBy("number").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    state = told.withColumn("in_string", F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2 == 1)
    down = F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))
    state = state.withColumn("down", down).select(
        "path", "number", "in_string", F.coalesce(F.sum("down").over(earlier), F.lit(0)).alias("depth"),
        F.when(F.first("first", ignorenulls=True).over(all_) == ord("["), 1).otherwise(0).alias("base"),
    )
    # One short row for each range of RANGE_BYTES: Spark broadcasts it where that is small.
    known = dealt.join(materialise(state), ["path", "number"])
    return known.select("path", "start", "end", "in_string", "depth", "base").mapInArrow(_records(block), "value string")


def read_record_arrays(spark: SparkSession, path: str, schema: T.StructType | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of JSON arrays of any size as rows. They are written as lines first, which Spark can split and infer."""
    folder = new_folder(spark, "lines")
    record_lines(spark, path, range_bytes).write.text(folder)
    return (spark.read.schema(schema) if schema is not None else spark.read).json(folder)
