"""The streaming jobs: queue to index, queue to document store, store to index."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from bantin.functions.dates import parse_date
from bantin.operators.envelope import bad_messages, decode_payload, good_messages, project_article, stamp_ingest, to_index_key
from bantin.operators.filters import crawled_since, only_journals
from bantin.operators.merge import keep_last, upsert_replace
from bantin.sources.connectors import read_kafka_stream
from bantin.sources.tables import DocumentTable
from bantin.sources.workspace import materialise
from bantin.streaming.fold import fold_stream

_MESSAGE = T.StructType([T.StructField("value", T.StringType()), T.StructField("topic", T.StringType())])
_DEDUP_SPREAD = 64
# What a stored document has of its message.
_STORED = ["id", "title", "type", "journal", "attract", "author", "date", "content", "tags"]


def read_article_stream(
    spark: SparkSession,
    topics: str | Sequence[str] | None = None,
    servers: str | None = None,
    starting: str | None = "earliest",
    path: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Messages (value, topic) from the queue, or from a folder of JSON lines of that form."""
    if path is None:
        return read_kafka_stream(spark, topics, servers, starting)
    reader = spark.readStream.schema(_MESSAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def checkpoint_path(root: str, topic: str, target: str) -> str:
    """One checkpoint per topic and target: two queries must never share one."""
    return f"{root.rstrip('/')}/{topic}/{target}"


def _trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """A period such as `10 seconds`, or None: take what is there, then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def index_records(messages: DataFrame) -> DataFrame:
    """Messages to index records: decode, keep the good ones, read the date, project."""
    articles = good_messages(decode_payload(messages.select("value")))
    return project_article(articles.withColumn("date", parse_date("journal", "date", "stream")))


ARRIVAL = "_arrival"


def with_arrival(messages: DataFrame) -> DataFrame:
    """Add `_arrival`, by which messages of one batch are ordered.

    The queue numbers the messages of a partition, and one article always goes to one partition.
    Messages from files come in the order in which they are read.
    """
    if {"partition", "offset"} <= set(messages.columns):
        return messages.withColumn(ARRIVAL, F.struct("offset", "partition"))
    return messages.withColumn(ARRIVAL, F.struct(F.monotonically_increasing_id().alias("offset"), F.lit(0).alias("partition")))


def store_records(messages: DataFrame) -> DataFrame:
    """Messages to stored documents: decode and stamp; the date stays text, the arrival is kept."""
    kept = [c for c in (ARRIVAL,) if c in messages.columns]
    articles = good_messages(decode_payload(messages.select("value", *kept)))
    return stamp_ingest(articles.select(*_STORED, *kept))


def quarantine(messages: DataFrame) -> DataFrame:
    """Messages that could not be decoded."""
    body = messages.select(F.col("value").cast("string").alias("raw"), "value")
    return bad_messages(decode_payload(body))


def start_index_stream(messages: DataFrame, target: str, checkpoint: str, every: str | None = None, partition_by: Sequence[str] = ("journal",)) -> StreamingQuery:
    """Queue to index table: stateless, append only; broken messages go to `<target>_rejected`.

    Each batch is decoded once and has a folder of its own in both tables (`batch=<number>`), which
    it writes over when it runs again: so every message is in one of them exactly once.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        raw = F.col("value").cast("string").alias("raw")
        decoded = decode_payload(batch.select(raw, "value")).persist()
        good = project_article(good_messages(decoded).withColumn("date", parse_date("journal", "date", "stream")))
        good.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{target}/batch={epoch}")
        bad_messages(decoded).write.mode("overwrite").parquet(f"{target}_rejected/batch={epoch}")
        decoded.unpersist()

    writer = messages.writeStream.option("checkpointLocation", checkpoint)
    return _trigger(writer.foreachBatch(write), every).start()


def start_document_stream(messages: DataFrame, table: DocumentTable, checkpoint: str, every: str | None = "10 seconds") -> StreamingQuery:
    """Queue to document table: each micro-batch rewrites the buckets it touches, the last arrival wins.

    A table that is there already goes on, also under a new checkpoint. Broken messages go to
    `<table>_rejected`, a folder per stream and batch. A batch that is run again after a failure is
    merged to no effect and writes its rejects again.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        raw = F.col("value").cast("string").alias("raw")
        # Decoded once; one stamp and one numbering for all that the fold reads.
        decoded = stamp_ingest(decode_payload(with_arrival(batch).select(raw, "value", ARRIVAL))).persist()
        table.upsert(good_messages(decoded).select(*_STORED, ARRIVAL, "crawled"), epoch)
        rejected = bad_messages(decoded).select("raw")
        rejected.write.mode("overwrite").parquet(f"{table.path}_rejected/stream={stream}/batch={epoch}")
        decoded.unpersist()

    writer = messages.writeStream.queryName("documents").option("checkpointLocation", checkpoint)
    return _trigger(writer.foreachBatch(write), every).start()


def start_folded_stream(
    messages: DataFrame, table: DocumentTable, checkpoint: str, every: str | None = "10 seconds", idle_ms: int | None = None
) -> StreamingQuery:
    """Queue to document table through state: a micro-batch hands on the whole documents its messages made.

    Messages need the queue's `partition` and `offset`. Merging whole documents a second time changes
    nothing, so a batch may run again. See `fold_stream` for the state and `idle_ms`.
    """
    if not {"partition", "offset"} <= set(messages.columns):
        raise ValueError("a folded stream needs the queue's partition and offset")
    if idle_ms is not None and every is None:
        raise ValueError("timers need a period: a stream that takes what is there would wait for them without end")
    documents = store_records(with_arrival(messages))
    folded = fold_stream(documents, table.key, table.order, table.unset_nulls, table.replace, idle_ms)

    def write(batch: DataFrame, epoch: int) -> None:
        table.upsert(materialise(batch), epoch, folded=True)  # state is read once, and has one document a key

    writer = folded.writeStream.queryName("folded").outputMode("update").option("checkpointLocation", checkpoint)
    return _trigger(writer.foreachBatch(write), every).start()


def split_by_journal(messages: DataFrame, journals: Sequence[str]) -> dict[str, DataFrame]:
    """One stream per journal from one subscription; unknown journals are left out."""
    return {j: only_journals(messages.withColumn("journal", F.col("topic")), [j]) for j in journals}


def start_fan_out(messages: DataFrame, journals: Sequence[str], root: str, checkpoint_root: str, every: str | None = None) -> StreamingQuery:
    """All journals in one query, one partition folder each: one job reads the queue once."""
    known = only_journals(messages.withColumn("journal", F.col("topic")), journals)
    return start_index_stream(known, f"{root}/news", checkpoint_path(checkpoint_root, "all", "news"), every)


def drop_republished(articles: DataFrame, within: str = "2 hours", key: str = "id", time: str = "crawled") -> DataFrame:
    """Let an article pass once per `within`, however often it is published again.

    Two steps: copies are first dropped by (key, reading task), so that an article that makes
    up much of the stream is not sent to one task; the few that are left are dropped by key.
    """
    spread = F.pmod(F.spark_partition_id(), F.lit(_DEDUP_SPREAD))
    return (
        articles.withColumn("_part", spread)
        .withWatermark(time, within)
        .dropDuplicatesWithinWatermark([key, "_part"])
        .dropDuplicatesWithinWatermark([key])
        .drop("_part")
    )


def incremental_export(stored: DataFrame, index: DataFrame | None, since) -> DataFrame:
    """One run of store to index: documents crawled after `since`, dated by day, upserted by id."""
    fresh = crawled_since(stored, since)
    if "_id" in fresh.columns:
        fresh = to_index_key(fresh)
    latest = keep_last(fresh, "id", ["crawled"])
    records = project_article(latest.withColumn("date", parse_date("journal", "date", "store")))
    return records if index is None else upsert_replace(index, records)


def _export_table(spark: SparkSession, root: str) -> DocumentTable:
    return DocumentTable(spark, f"{root}/index", "id", ["crawled"], whole=True)


def read_export(spark: SparkSession, root: str) -> tuple[int, DataFrame | None, object]:
    """Number of finished export runs, the index after the last, and the crawl time it went up to."""
    index = _export_table(spark, root)
    state = index.state()
    if state is None:
        return 0, None, None
    return state.version + 1, index.read(state.version), datetime.datetime.fromisoformat(state.note)


def run_export(stored: DataFrame, root: str, since=None, until=None, overlap: str | None = "1 hour") -> bool:
    """One run of store to index: documents crawled in (since, until], upserted by id.

    The window is fixed before its rows are read: `since` is where the last run ended (for the first run
    the given value, or none), `until` the given time, or the newest crawl time there is. Documents may
    come late, or with a stamp equal to `since`: each run looks again at those of the `overlap` before
    its window (None: at all) and takes what the index lacks or has in an older version. The index and
    the end of the window are committed at once; a run that failed is simply done again. Only buckets
    with new documents are rewritten. Returns whether there was anything to write.
    """
    spark = stored.sparkSession
    index = _export_table(spark, root)
    runs, known, ended = read_export(spark, root)
    if until is None:
        until = stored.agg(F.max("crawled").cast("timestamp").alias("until")).first().until
    else:
        until = spark.range(1).select(F.lit(until).cast("timestamp").alias("until")).first().until
    if until is None:
        return False
    window = stored.where(F.col("crawled").cast("timestamp") <= F.lit(until))
    if ended is None:
        window = window if since is None else crawled_since(window, since)
    elif overlap is not None:
        window = window.where(F.col("crawled").cast("timestamp") > F.lit(ended) - F.expr(f"interval {overlap}"))
    if "_id" in window.columns:
        window = to_index_key(window)
    if known is not None:
        exported = known.select(F.col("id").alias("_known"), F.col("crawled").alias("_at"))
        newer = (F.col("id") == F.col("_known")) & (F.col("_at") >= F.col("crawled").cast("timestamp"))
        window = window.join(exported, newer, "left_anti")
    latest = materialise(keep_last(window, "id", ["crawled"]))
    if latest.isEmpty():
        return False
    dated = latest.withColumn("date", parse_date("journal", "date", "store"))
    records = dated.select(*project_article(dated).columns, F.col("crawled").cast("timestamp").alias("crawled"))
    index.upsert(records, note=max(until, ended or until).isoformat(), folded=True)  # kept last and stored above
    return True


def next_watermark(stored: DataFrame, since) -> DataFrame:
    """The `since` of the next run: the newest crawl time seen, or the old value."""
    return stored.agg(F.greatest(F.max("crawled"), F.lit(since).cast("timestamp")).alias("since"))
