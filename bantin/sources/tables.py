"""Article tables on a shared file system."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bantin.operators.envelope import encode_messages
from bantin.operators.merge import CLEARED, fold_alone, fold_updates, keep_last, upsert_merge, upsert_replace
from bantin.sources.connectors import KAFKA, kafka_sink_options
from bantin.sources.workspace import materialise


def write_append(df: DataFrame, path: str, partition_by: Sequence[str] = ("journal",), mode: str = "append") -> None:
    """Add rows to a Parquet table. `mode="error"` refuses a table that is already there."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_article_files(df: DataFrame, path: str, key: str = "id", order: Sequence[str] = ("crawled",)) -> None:
    """The last record per key as JSON lines, one folder per journal.

    One file per article would drown the file system; the key stays a field of the record.
    """
    keep_last(df, key, order).write.mode("overwrite").partitionBy("journal").json(path)


def publish(df: DataFrame, servers: str, topic: str | None = None, key: str = "id") -> None:
    """Send rows to a queue; without a topic each goes to its journal's."""
    records = encode_messages(df, key, None if topic else F.col("journal"))
    records.write.format(KAFKA).options(**kafka_sink_options(servers, topic)).save()


def route(
    df: DataFrame,
    queue: Callable[[DataFrame], None] | None = None,
    store: Callable[[DataFrame], None] | None = None,
    files: Callable[[DataFrame], None] | None = None,
) -> str:
    """Hand rows to the first sink that is configured: queue, then store, then files."""
    for name, sink in (("queue", queue), ("store", store), ("files", files)):
        if sink is not None:
            sink(df)
            return name
    raise ValueError("no sink configured")


class State(NamedTuple):
    """A committed state of a document table: which version of each bucket counts."""

    version: int
    buckets: int
    held: dict[int, int]
    schema: T.StructType
    note: str | None


_COMMIT = "version long, buckets int, held array<struct<bucket:int,version:long>>, schema string, note string"
_BUCKETS, _BUCKET, _VERSION, _PART = "store_buckets", "store_bucket", "store_version", "store_part"


class DocumentTable:
    """A keyed table in buckets by the hash of the key; a batch rewrites only the buckets its keys fall into.

    A batch is folded to one update per key and merged into the documents of its buckets. Scalars and
    the lists in `replace` take the last version, other lists gain items; with `whole` the last
    version replaces the document.

    `rows` has a folder for each version of a bucket. `commits` has one line for each batch, written
    when its rows are complete, that names the versions which count: readers and the next batch go by
    the last line, so they never see half a batch, and a table goes on where it stood, whoever
    wrote it before. Merging a batch a second time changes nothing, so a batch that failed is simply run
    again. There must be one writer at a time.

    `buckets` counts for a new table; choose it so that a bucket is a task's work, or `rebucket` later.
    `vacuum` deletes what no kept state needs.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str | Sequence[str] = "id",
        order: Sequence[str] = ("crawled",),
        unset_nulls: bool = True,
        replace: Sequence[str] = ("content",),
        buckets: int = 64,
        whole: bool = False,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key, self.order, self.unset_nulls, self.replace = key, list(order), unset_nulls, tuple(replace)
        self.buckets, self.whole = buckets, whole

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_COMMIT).json(f"{self.path}/commits")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def state(self, version: int | None = None) -> State | None:
        """The last committed state, or that of a version that is still there; None for a new table."""
        commits = self._commits()
        if commits is None:
            return None
        chosen = commits if version is None else commits.where(F.col("version") == version)
        last = chosen.orderBy(F.desc("version")).first()
        if last is None:
            if version is None:
                return None
            raise ValueError(f"{self.path} has no version {version}")
        held = {h.bucket: h.version for h in last.held}
        return State(last.version, last.buckets, held, T.StructType.fromJson(json.loads(last.schema)), last.note)

    def _of(self, state: State, buckets: Sequence[int]) -> DataFrame:
        """The documents of some buckets."""
        root = f"{self.path}/rows"
        folders = [f"{root}/{_BUCKETS}={state.buckets}/{_BUCKET}={b}/{_VERSION}={state.held[b]}" for b in buckets if b in state.held]
        if not folders:
            return self.spark.createDataFrame([], state.schema)
        return self.spark.read.schema(state.schema).option("basePath", root).parquet(*folders).select(*state.schema.names)

    def _bucket(self, buckets: int) -> Column:
        keys = [self.key] if isinstance(self.key, str) else self.key
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def _places(self, buckets: int, touched: int) -> dict[str, Column]:
        """The bucket of a row and its part of the bucket, so that a large bucket is the work of many tasks."""
        keys = [self.key] if isinstance(self.key, str) else self.key
        parts = -(-int(self.spark.conf.get("spark.sql.shuffle.partitions")) // max(touched, 1))
        return {_BUCKET: self._bucket(buckets), _PART: F.pmod(F.hash(*keys), F.lit(parts))}

    def _write(self, rows: DataFrame, buckets: int, version: int) -> None:
        """Rows to their buckets; with a column of parts they are dealt by bucket already."""
        placed = rows.withColumns({_BUCKETS: F.lit(buckets), _BUCKET: self._bucket(buckets), _VERSION: F.lit(version)})
        # Few files a bucket; a bucket that is too large for one task is shared out by Spark.
        dealt = placed.drop(_PART) if _PART in rows.columns else placed.hint("rebalance", _BUCKET)
        dealt.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy(_BUCKETS, _BUCKET, _VERSION).parquet(f"{self.path}/rows")

    def _commit(self, state: State) -> int:
        held = [(b, v) for b, v in sorted(state.held.items())]
        line = (state.version, state.buckets, held, json.dumps(state.schema.jsonValue()), state.note)
        self.spark.createDataFrame([line], _COMMIT).coalesce(1).write.mode("append").json(f"{self.path}/commits")
        return state.version

    def upsert(self, changes: DataFrame, epoch: int | None = None, note: str | None = None, folded: bool = False) -> int:
        """Merge a batch and return the version it made. `note` is kept with the state.

        With `folded` the caller vouches that each key stands once in the changes and that reading
        them again gives the same rows: they are not shuffled for the fold nor stored again. The table must
        have each key once as well, as all batches leave it; stored and new documents then meet in the
        shuffle that writes them, by parts of buckets, as many in all as the session has shuffle partitions.

        `epoch`, the batch's number in its stream, does not matter: a new stream starts again from 0,
        and a repeated batch is merged to no effect.
        """
        before = self.state()
        buckets = before.buckets if before else self.buckets
        if self.whole:
            updates = changes if folded else materialise(keep_last(changes, self.key, self.order))
        elif folded:
            updates = fold_alone(changes, self.key, self.order, self.unset_nulls, self.replace)
        else:
            updates = materialise(fold_updates(changes, self.key, self.order, self.unset_nulls, self.replace))
        touched = sorted(r[0] for r in updates.select(self._bucket(buckets)).distinct().collect())
        stored = self._of(before, touched) if before else updates.drop(CLEARED).limit(0)  # a plain scan of nothing, which Spark does not join
        if self.whole:
            merged = upsert_replace(stored, updates, self.key, rewrite=True)
        else:
            places = self._places(buckets, len(touched)) if folded and before else None
            merged = upsert_merge(stored, updates, self.key, self.unset_nulls, rewrite=True, replace=self.replace, places=places)
        version = before.version + 1 if before else 0
        if touched:
            self._write(merged, buckets, version)
        merged = merged.drop(_BUCKET, _PART)
        held = {**(before.held if before else {}), **dict.fromkeys(touched, version)}
        return self._commit(State(version, buckets, held, merged.schema, note))

    def read(self, version: int | None = None) -> DataFrame:
        """The documents as last committed, or as of a version."""
        state = self.state(version)
        if state is None:
            raise ValueError(f"{self.path} is not a document table yet")
        return self._of(state, list(state.held))

    def rebucket(self, buckets: int) -> int:
        """Deal all documents to another number of buckets; a batch of its own."""
        before = self.state()
        if before is None:
            raise ValueError(f"{self.path} is not a document table yet")
        version = before.version + 1
        rows = materialise(self._of(before, list(before.held)))
        self._write(rows, buckets, version)
        there = [r[0] for r in rows.select(self._bucket(buckets)).distinct().collect()]
        return self._commit(State(version, buckets, dict.fromkeys(there, version), before.schema, before.note))

    def vacuum(self, keep: int = 1) -> int:
        """Delete what only states before the last `keep` need; returns the number of folders and files deleted.

        Readers of older states fail from then on, so keep as many as a reader may be behind.
        """
        commits = self._commits()
        if commits is None:
            return 0
        lines = commits.select("version", "buckets", "held", F.col("_metadata.file_path").alias("file")).orderBy(F.desc("version")).collect()
        needed = {(r.buckets, h.bucket, h.version) for r in lines[:keep] for h in r.held}
        kept_files = {r.file for r in lines[:keep]}
        old = {r.file for r in lines[keep:]} - kept_files
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        rows = hadoop.Path(f"{self.path}/rows")
        files = rows.getFileSystem(self.spark._jsc.hadoopConfiguration())
        # First the lines, so that none ever names rows that are gone.
        gone = [hadoop.Path(self.spark._jvm.java.net.URI(f)) for f in sorted(old)]
        for found in files.globStatus(hadoop.Path(rows, f"{_BUCKETS}=*/{_BUCKET}=*/{_VERSION}=*")) or []:
            place = tuple(int(part.split("=")[1]) for part in found.getPath().toString().split("/")[-3:])
            # What is newer than the last line may belong to a batch that is being written.
            if place not in needed and place[2] <= lines[0].version:
                gone.append(found.getPath())
        return sum(bool(files.delete(path, True)) for path in gone)
