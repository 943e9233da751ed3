"""Streaming queries: each runs a stream over a test table to its end and shows the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from bantin.plans import views
from bantin.plans.registry import SQL, query
from bantin.plans.views import ARTICLES, with_views
from bantin.sources.tables import DocumentTable
from bantin.sources.workspace import new_folder
from bantin.streaming import jobs
from bantin.streaming.fold import STATE_STORE

_INDEXED = """SELECT id, journal, title, md5(array_to_string(content, chr(10))) AS body,
  CASE WHEN journal = 'dantri' THEN NULL ELSE strftime(crawled, '%Y-%m-%d %H:%M:%S') END AS date
FROM articles WHERE doc_id % 13 <> 0"""


def _stream(spark, sf_dir, name):
    """One test table as a stream, be it a file or a folder of files."""
    schema = views.table(spark, sf_dir, name).schema
    # A pattern of this name alone: by its plain name a stream takes folders only.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def _message_stream(spark, sf_dir):
    return views.message_columns(views.article_columns(_stream(spark, sf_dir, "documents"))).select("topic", "value")


def _indexed(rows):
    return rows.select(
        "id", "journal", "title", F.md5(F.array_join("content", "\n")).alias("body"),
        F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"),
    )


@query(with_views(_INDEXED, ARTICLES))
def index_stream(spark, sf_dir):
    root = new_folder(spark, "index")
    target = f"{root}/news"
    jobs.start_index_stream(
        _message_stream(spark, sf_dir), target, jobs.checkpoint_path(f"{root}/checkpoints", "articles", "news")
    ).awaitTermination()
    return _indexed(spark.read.parquet(target))


@query(with_views(_INDEXED, ARTICLES))
def stream_recovery(spark, sf_dir):
    """A stream that stops after half of its files and goes on from its checkpoint: each row once."""
    root = new_folder(spark, "recovery")
    messages = views.messages(spark, sf_dir)
    for half in (0, 1, 2):  # the last run finds nothing new
        messages.where(F.col("doc_id") % 2 == half).select("value", "topic").write.mode("append").json(f"{root}/in")
        jobs.start_index_stream(
            jobs.read_article_stream(spark, path=f"{root}/in"), f"{root}/news", jobs.checkpoint_path(f"{root}/checkpoints", "articles", "news")
        ).awaitTermination()
    return _indexed(spark.read.parquet(f"{root}/news"))


@query(with_views("""SELECT count(*) FILTER (doc_id % 13 <> 0) AS n_good, count(*) FILTER (doc_id % 13 = 0) AS n_rejected,
  count(DISTINCT doc_id) FILTER (doc_id % 13 = 0) AS n_texts FROM articles""", ARTICLES))
def stream_rejects(spark, sf_dir):
    """Good and rejected messages of one stream add up to all of them."""
    root = new_folder(spark, "rejects")
    jobs.start_index_stream(
        _message_stream(spark, sf_dir), f"{root}/news", jobs.checkpoint_path(f"{root}/checkpoints", "articles", "news")
    ).awaitTermination()
    good = spark.read.parquet(f"{root}/news").agg(F.count("*").alias("n_good"))
    bad = spark.read.parquet(f"{root}/news_rejected").agg(F.count("*").alias("n_rejected"), F.count_distinct("raw").alias("n_texts"))
    return good.join(bad)


def _shown(documents):
    return documents.read().select(
        "id", "journal", "title", F.md5(F.array_join("content", "\n")).alias("body"),
        F.array_join(F.sort_array("tags"), " ").alias("tags"), F.col("crawled").isNotNull().alias("stamped"),
    )


def _stored(spark, messages):
    """The document table after a stream of messages has run to its end."""
    root = new_folder(spark, "store")
    documents = DocumentTable(spark, f"{root}/documents", "id", ["crawled", jobs.ARRIVAL])
    jobs.start_document_stream(
        messages, documents, jobs.checkpoint_path(f"{root}/checkpoints", "articles", "documents"), None
    ).awaitTermination()
    return _shown(documents)


_TAGS = "array_to_string(list_sort(list_filter(list_distinct({}), lambda t: t <> '')), ' ') AS tags"


@query(with_views(f"""SELECT id, journal, title, md5(array_to_string(content, chr(10))) AS body, {_TAGS.format('tags')},
  true AS stamped FROM articles WHERE doc_id % 13 <> 0""", ARTICLES))
def document_stream(spark, sf_dir):
    return _stored(spark, _message_stream(spark, sf_dir))


@query(with_views(f"""SELECT id, journal, 'aaa ' || title AS title,
  md5(array_to_string(list_concat(content, ['', content[1]]), chr(10))) AS body, {_TAGS.format("list_concat(tags, ['first', 'last'])")},
  true AS stamped FROM articles WHERE doc_id % 13 <> 0""", ARTICLES))
def document_stream_duplicates(spark, sf_dir):
    """Two messages for each article in one batch; the later one has repeated and empty paragraphs."""
    rows = views.article_columns(_stream(spark, sf_dir, "documents"))
    first = F.struct(F.concat(F.lit("zzz "), "title").alias("title"), F.array(F.lit("gone")).alias("content"), F.array_append("tags", F.lit("first")).alias("tags"))
    later = F.concat("content", F.array(F.lit(""), F.element_at("content", 1)))
    last = F.struct(F.concat(F.lit("aaa "), "title").alias("title"), later.alias("content"), F.array_append("tags", F.lit("last")).alias("tags"))
    versions = rows.withColumn("v", F.explode(F.array(first, last)))
    messages = views.message_columns(versions.withColumns({c: F.col("v")[c] for c in ("title", "content", "tags")}))
    return _stored(spark, messages.select("topic", "value"))


@query(SQL["document_stream_duplicates"])
def document_stream_state(spark, sf_dir):
    """The same messages through state, with a stop between the first and the second of each article."""
    root = new_folder(spark, "state")
    rows = views.article_columns(views.table(spark, sf_dir, "documents"))
    first = {"title": F.concat(F.lit("zzz "), "title"), "content": F.array(F.lit("gone")), "tags": F.array_append("tags", F.lit("first"))}
    later = F.concat("content", F.array(F.lit(""), F.element_at("content", 1)))
    last = {"title": F.concat(F.lit("aaa "), "title"), "content": later, "tags": F.array_append("tags", F.lit("last"))}
    documents = DocumentTable(spark, f"{root}/documents", "id", ["crawled", jobs.ARRIVAL])
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, STATE_STORE)
    try:
        for offset, part in enumerate((first, last)):
            sent = views.message_columns(rows.withColumns(part)).select("value", "topic", F.lit(0).alias("partition"), F.lit(offset).cast("long").alias("offset"))
            sent.write.mode("append").option("compression", "gzip").json(f"{root}/in")
            messages = spark.readStream.schema("value string, topic string, partition int, offset long").json(f"{root}/in")
            jobs.start_folded_stream(messages, documents, f"{root}/checkpoint", None).awaitTermination()
    finally:
        spark.conf.set(provider, before)
    return _shown(documents)


@query(with_views(f"""SELECT id, journal, CASE WHEN doc_id % 3 = 1 THEN 'new ' || title ELSE title END AS title,
  md5(array_to_string(content, chr(10))) AS body,
  {_TAGS.format("CASE WHEN doc_id % 3 = 1 THEN list_append(tags, 'again') ELSE tags END")}, true AS stamped
FROM articles WHERE doc_id % 13 <> 0""", ARTICLES))
def document_stream_restart(spark, sf_dir):
    """A second stream, with a checkpoint of its own, goes on with the table that the first one left."""
    root = new_folder(spark, "restart")
    documents = DocumentTable(spark, f"{root}/documents", "id", ["crawled", jobs.ARRIVAL])
    rows = views.article_columns(views.table(spark, sf_dir, "documents"))
    again = F.col("doc_id") % 3 == 1
    later = rows.where(F.col("doc_id") % 3 != 0).withColumns({
        "title": F.when(again, F.concat(F.lit("new "), "title")).otherwise(F.col("title")),
        "tags": F.when(again, F.array_append("tags", F.lit("again"))).otherwise(F.col("tags")),
    })
    for run, part in enumerate([rows.where(F.col("doc_id") % 3 != 2), later]):
        views.message_columns(part).select("value", "topic").write.option("compression", "gzip").json(f"{root}/in-{run}")
        jobs.start_document_stream(
            jobs.read_article_stream(spark, path=f"{root}/in-{run}"), documents, jobs.checkpoint_path(f"{root}/checkpoints", f"run-{run}", "documents"), None
        ).awaitTermination()
    documents.vacuum()
    return _shown(documents)


@query(with_views(_INDEXED + " AND journal IN ('vtc', 'vneconomy', 'dantri')", ARTICLES))
def journal_fan_out(spark, sf_dir):
    root = new_folder(spark, "fanout")
    jobs.start_fan_out(
        _message_stream(spark, sf_dir), ["vtc", "vneconomy", "dantri", "nosuch"], root, f"{root}/checkpoints"
    ).awaitTermination()
    return _indexed(spark.read.parquet(f"{root}/news"))


@query("SELECT event_id AS id, user_id FROM events")
def republished_stream(spark, sf_dir):
    """Every event is published three times within an hour; each passes once."""
    root = new_folder(spark, "dedup")
    copies = _stream(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), "user_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("copy"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
    crawled = F.timestamp_add("MINUTE", F.col("copy") * 20, F.col("ts"))
    once = jobs.drop_republished(copies.select("id", "user_id", crawled.alias("crawled")))
    writer = once.writeStream.format("parquet").option("path", f"{root}/out")
    writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out").select("id", "user_id")


@query(with_views("""SELECT id, journal, title, CASE WHEN journal = 'dantri' THEN NULL
  ELSE strftime(date_trunc('day', crawled), '%Y-%m-%d') END AS day, 2 AS runs FROM articles""", ARTICLES))
def export_runs(spark, sf_dir):
    """A run over the older half, one over all, and one that finds nothing new."""
    root = new_folder(spark, "export")
    rows = views.articles(spark, sf_dir).withColumn("ts", F.col("crawled"))
    stored = rows.withColumn("date", views.raw_date()).withColumn("crawled", F.col("crawled").cast("timestamp")).drop("ts", "doc_id")
    halves = [stored.where("crawled < timestamp'2024-01-01 05:00:00'"), stored, stored]
    wrote = [jobs.run_export(half.withColumnRenamed("id", "_id"), root, "2023-12-31") for half in halves]
    runs, index, _ = jobs.read_export(spark, root)
    assert wrote == [True, True, False]
    return index.select("id", "journal", "title", F.date_format("date", "yyyy-MM-dd").alias("day"), F.lit(runs).alias("runs"))


@query(with_views("""SELECT id, journal, title, CASE WHEN journal = 'dantri' THEN NULL
  ELSE strftime(date_trunc('day', crawled), '%Y-%m-%d') END AS day FROM articles""", ARTICLES))
def export_late_rows(spark, sf_dir):
    """Documents that reach the store between runs: some late, some with a stamp that a run has ended at."""
    root = new_folder(spark, "late")
    rows = views.articles(spark, sf_dir).withColumn("crawled", F.date_trunc("hour", F.col("crawled").cast("timestamp"))).withColumn("ts", F.col("crawled"))
    stored = rows.withColumn("date", views.raw_date()).withColumnRenamed("id", "_id").drop("ts")
    for there in (F.col("doc_id") % 4 == 0, F.col("doc_id") % 4 != 3, F.lit(True)):
        jobs.run_export(stored.where(there).drop("doc_id"), root, overlap=None)
    _, index, _ = jobs.read_export(spark, root)
    return index.select("id", "journal", "title", F.date_format("date", "yyyy-MM-dd").alias("day"))


@query(with_views("""SELECT id, journal, title,
  CASE WHEN crawled <= TIMESTAMP '2024-01-01 03:00:00' THEN NULL WHEN journal = 'dantri' THEN NULL
       ELSE strftime(date_trunc('day', crawled), '%Y-%m-%d') END AS day FROM articles""", ARTICLES))
def incremental_export(spark, sf_dir):
    """The index holds all articles without a date; one run dates those crawled since 03:00."""
    rows = views.articles(spark, sf_dir).withColumn("ts", F.col("crawled"))
    stored = rows.withColumn("date", views.raw_date()).withColumnRenamed("id", "_id").drop("ts", "doc_id")
    index = rows.withColumn("date", F.lit(None).cast("timestamp")).select(*jobs.project_article(
        rows.withColumn("date", F.lit(None).cast("timestamp"))).columns)
    fresh = jobs.incremental_export(stored, index, F.expr("timestamp_ntz'2024-01-01 03:00:00'"))
    return fresh.select("id", "journal", "title", F.date_format("date", "yyyy-MM-dd").alias("day"))
