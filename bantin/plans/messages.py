"""Message, list, map and nested-document queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bantin.functions import documents as D
from bantin.operators import envelope, nested
from bantin.plans import views
from bantin.plans.registry import query
from bantin.plans.views import ARTICLES, with_views
from bantin.schema import RAW_MESSAGE_SCHEMA
from bantin.sources.files import split_csv_payload

@query(with_views("""SELECT doc_id, id, journal, title, len(content) AS n_paragraphs,
  md5(array_to_string(content, chr(10))) AS body FROM articles WHERE doc_id % 13 <> 0""", ARTICLES))
def decode_payload(spark, sf_dir):
    decoded = envelope.decode_payload(views.messages(spark, sf_dir).drop("topic"))
    return envelope.good_messages(decoded).select(
        "doc_id", "id", "journal", "title",
        F.size("content").cast("long").alias("n_paragraphs"),
        F.md5(F.array_join("content", "\n")).alias("body"),
    )


@query("SELECT doc_id FROM documents WHERE doc_id % 13 = 0")
def quarantine_messages(spark, sf_dir):
    decoded = envelope.decode_payload(views.messages(spark, sf_dir).drop("topic"))
    return envelope.bad_messages(decoded).select("doc_id")


@query(with_views("""SELECT doc_id, id, journal, title, attract, CAST(NULL AS VARCHAR) AS image FROM articles""", ARTICLES))
def extract_fields(spark, sf_dir):
    mapped = envelope.decode_map(views.messages(spark, sf_dir, broken_every=None).drop("topic")).drop("value")
    return envelope.extract_fields(mapped, ["id", "journal", "title", "attract", "image"])


@query(with_views("""SELECT doc_id, len(parts) AS n, md5(array_to_string(parts, '|')) AS body
FROM (SELECT doc_id, string_split(array_to_string(content, ', '), ', ') AS parts FROM articles)""", ARTICLES))
def split_list_string(spark, sf_dir):
    text = F.concat(F.lit("["), F.array_join("content", ", "), F.lit("]"))
    parts = views.articles(spark, sf_dir).select("doc_id", D.split_list_string(text).alias("parts"))
    return parts.select("doc_id", F.size("parts").cast("long").alias("n"), F.md5(F.array_join("parts", "|")).alias("body"))


@query(with_views("""SELECT doc_id, i AS pos, 'https://img.example/' || id || '/' || i AS url, journal || ' ' || i AS title
FROM articles, (VALUES (0), (1)) AS t(i)""", ARTICLES))
def image_list(spark, sf_dir):
    rows = views.articles(spark, sf_dir)
    images = F.array(*[
        F.struct(
            F.concat(F.lit("https://img.example/"), "id", F.lit(f"/{i}")).alias("url"),
            F.concat("journal", F.lit(f" {i}")).alias("title"),
        )
        for i in (0, 1)
    ])
    as_map_text = F.concat(
        F.lit("["),
        F.array_join(F.transform(images, lambda x: F.concat(F.lit("{url="), x["url"], F.lit(", title="), x["title"], F.lit("}"))), ", "),
        F.lit("]"),
    )
    text = F.when(F.col("doc_id") % 2 == 0, F.to_json(images)).otherwise(as_map_text)
    parsed = rows.select("doc_id", F.posexplode(D.parse_image_list(text)).alias("pos", "image"))
    return parsed.select("doc_id", "pos", "image.url", "image.title")


@query(with_views("""SELECT id, title, type, journal, attract, author,
  strftime(crawled, '%Y-%m-%d %H:%M:%S') AS date, md5(array_to_string(content, chr(10))) AS content,
  array_to_string(list_sort(tags), ' ') AS tags FROM articles""", ARTICLES))
def project_articles(spark, sf_dir):
    rows = views.articles(spark, sf_dir).withColumn("date", F.date_format("crawled", "yyyy-MM-dd HH:mm:ss"))
    return envelope.project_article(rows).withColumns({
        "content": F.md5(F.array_join("content", "\n")),
        "tags": F.array_join(F.sort_array("tags"), " "),
    })


@query(with_views("SELECT id AS _id, journal, title FROM articles", ARTICLES))
def rename_key(spark, sf_dir):
    stored = envelope.to_store_key(views.articles(spark, sf_dir))
    return envelope.to_store_key(envelope.to_index_key(stored)).select("_id", "journal", "title")


@query("""SELECT event_id, user_id, event_type, CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS value,
  event_type || '+' || user_id AS tags FROM events""")
def split_csv_payload_events(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    value = F.when(F.col("event_id") % 17 == 0, F.lit("x")).otherwise(F.col("value").cast("string"))
    text = F.concat_ws(",", "event_id", "user_id", "event_type", value, F.concat_ws(";", "event_type", "user_id"))
    schema = T.StructType([
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ])
    parsed = split_csv_payload(events.select(text.alias("value")), schema)
    return parsed.withColumn("tags", F.array_join("tags", "+"))


@query(with_views("""SELECT id AS key, journal AS topic, title, md5(array_to_string(content, chr(10))) AS body,
  array_to_string(list_sort(tags), ' ') AS tags FROM articles""", ARTICLES))
def publish_round_trip(spark, sf_dir):
    rows = views.articles(spark, sf_dir).select("id", "journal", "title", "content", "tags")
    records = envelope.encode_messages(rows, "id", "journal")
    decoded = envelope.good_messages(envelope.decode_payload(records, RAW_MESSAGE_SCHEMA))
    return decoded.select(
        "key", "topic", "title",
        F.md5(F.array_join("content", "\n")).alias("body"),
        F.array_join(F.sort_array("tags"), " ").alias("tags"),
    )


def _article_maps(spark, sf_dir):
    names = ["title", "attract", "author", "journal"]
    pairs = [x for n in names for x in (F.lit(n), F.col(n))]
    return views.articles(spark, sf_dir).select("doc_id", F.create_map(*pairs).alias("m"))


@query(with_views("""SELECT doc_id, CASE WHEN attract IS NULL THEN 'journal title' ELSE 'attract journal title' END AS keys
FROM articles""", ARTICLES))
def drop_null_entries(spark, sf_dir):
    kept = _article_maps(spark, sf_dir).select("doc_id", D.drop_null_entries("m").alias("m"))
    return kept.select("doc_id", F.array_join(F.sort_array(F.map_keys("m")), " ").alias("keys"))


@query(with_views("SELECT doc_id, 'journal title' AS keys, title FROM articles", ARTICLES))
def keep_keys(spark, sf_dir):
    kept = _article_maps(spark, sf_dir).select("doc_id", D.keep_keys("m", ["title", "journal", "nowhere"]).alias("m"))
    return kept.select(
        "doc_id", F.array_join(F.sort_array(F.map_keys("m")), " ").alias("keys"), F.element_at("m", "title").alias("title")
    )


@query("SELECT doc_id, CAST(n_chars + 1 AS DOUBLE) AS a, CAST(doc_id + n_chars AS DOUBLE) AS b, 2 AS n FROM documents")
def add_maps(spark, sf_dir):
    number = lambda c: F.col(c).cast("double")
    first = F.create_map(F.lit("a"), number("n_chars"), F.lit("b"), number("doc_id"))
    second = F.create_map(F.lit("a"), F.lit(1.0), F.lit("b"), number("n_chars"), F.lit("c"), F.lit(5.0))
    sums = views.table(spark, sf_dir, "documents").select("doc_id", D.add_maps(first, second).alias("m"))
    return sums.select("doc_id", F.element_at("m", "a").alias("a"), F.element_at("m", "b").alias("b"), F.size("m").alias("n"))


def _nested_articles(spark, sf_dir):
    meta = F.struct("journal", "attract", F.struct("type", "author").alias("more"))
    parts = F.transform("content", lambda line, i: F.struct(
        F.when(i % 2 == 0, line).alias("even"), i.alias("no"),
    ))
    return views.articles(spark, sf_dir).select("doc_id", "title", meta.alias("meta"), parts.alias("parts"), "tags")


@query(with_views("""SELECT doc_id, title, journal AS meta__journal, attract AS meta__attract, type AS meta__more__type,
  author AS meta__more__author, content[CASE WHEN len(content) % 2 = 1 THEN len(content) ELSE len(content) - 1 END] AS parts__even,
  CAST(len(content) - 1 AS INTEGER) AS parts__no, array_to_string(list_sort(tags), ' ') AS tags FROM articles""", ARTICLES))
def flatten_documents(spark, sf_dir):
    flat = nested.flatten(_nested_articles(spark, sf_dir))
    flat = flat.toDF(*[c.replace(".", "__") for c in flat.columns])
    return flat.withColumn("tags", F.array_join(F.sort_array("tags"), " "))


@query(with_views("SELECT doc_id, title, journal, attract, type FROM articles", ARTICLES))
def unflatten_documents(spark, sf_dir):
    flat = nested.flatten(_nested_articles(spark, sf_dir).select("doc_id", "title", "meta"))
    return nested.unflatten(flat).select(
        "doc_id", "title", F.col("meta.journal"), F.col("meta.attract"), F.col("meta.more.type")
    )


@query(with_views("""SELECT doc_id, 'doc_id extra meta parts tags title' AS keys,
  CASE WHEN attract IS NULL THEN 'journal more' ELSE 'attract journal more' END AS meta_keys,
  CASE WHEN attract IS NULL THEN 'title' ELSE 'attract title' END AS extra_keys,
  len(content) AS n_parts FROM articles""", ARTICLES))
def drop_nulls_deep(spark, sf_dir):
    rows = _nested_articles(spark, sf_dir)
    extra = F.create_map(F.lit("title"), F.col("title"), F.lit("attract"), F.col("meta.attract"))
    docs = nested.compact_json(rows.withColumn("extra", extra))

    def keys(path: str):
        part = F.col("doc") if path == "$" else F.get_json_object("doc", path)
        return F.array_join(F.sort_array(F.json_object_keys(part)), " ")

    return docs.select(
        F.get_json_object("doc", "$.doc_id").cast("long").alias("doc_id"),
        keys("$").alias("keys"),
        keys("$.meta").alias("meta_keys"),
        keys("$.extra").alias("extra_keys"),
        F.json_array_length(F.get_json_object("doc", "$.parts")).cast("long").alias("n_parts"),
    )
