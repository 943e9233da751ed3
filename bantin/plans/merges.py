"""Upsert queries: documents are the table, updates come from the labelled documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from bantin.operators import merge
from bantin.plans import views
from bantin.plans.registry import query
from bantin.plans.views import ARTICLES, UPDATES, with_views
from bantin.sources.files import load_records as read_records
from bantin.sources.files import read_articles_json, read_collection
from bantin.sources.tables import DocumentTable, route, write_append, write_article_files
from bantin.sources.workspace import new_folder

_STORED = "stored AS (SELECT id, title, journal, tags, len(content) AS n_content FROM articles)"
_TAGS = "array_to_string(list_sort({}), ' ')"
# Ids, and so at most as many records, that share a file; files get more with the table, not larger.
_RECORDS_A_FILE = 1000


def _stored(spark, sf_dir):
    return views.articles(spark, sf_dir).select(
        "id", "title", "journal", "tags", F.size("content").cast("long").alias("n_content")
    )


def _shown(df):
    return df.withColumn("tags", F.array_join(F.sort_array("tags"), " "))


@query(with_views(f"""SELECT id, CASE WHEN title IS NULL THEN 'title' ELSE '' END AS unset, title AS set_title,
  {_TAGS.format("list_filter(tags, lambda t: t <> '')")} AS add_tags FROM updates""", ARTICLES, UPDATES))
def classify_update(spark, sf_dir):
    plan = merge.classify_update(views.updates(spark, sf_dir))
    return plan.select(
        "id", F.array_join("unset", " ").alias("unset"), F.col("set.title").alias("set_title"),
        F.array_join("add_to_set.tags", " ").alias("add_tags"),
    )


_MERGED = """SELECT coalesce(s.id, u.id) AS id,
  CASE WHEN u.id IS NOT NULL THEN u.title ELSE s.title END AS title, s.journal AS journal,
  array_to_string(list_sort(CASE WHEN u.id IS NULL THEN s.tags
    ELSE list_concat(coalesce(s.tags, []), list_filter(u.tags, lambda t: t <> '' AND NOT list_contains(coalesce(s.tags, []), t))) END), ' ') AS tags,
  s.n_content AS n_content
FROM stored s FULL OUTER JOIN updates u ON s.id = u.id"""


@query(with_views(_MERGED, ARTICLES, UPDATES, _STORED))
def upsert_merge(spark, sf_dir):
    return _shown(merge.upsert_merge(_stored(spark, sf_dir), views.updates(spark, sf_dir)))


@query(with_views("""SELECT coalesce(s.id, u.id) AS id,
  CASE WHEN u.id IS NOT NULL THEN u.title ELSE s.title END AS title, s.journal AS journal,
  array_to_string(list_sort(CASE WHEN u.id IS NOT NULL THEN u.tags ELSE s.tags END), ' ') AS tags,
  s.n_content AS n_content FROM stored s FULL OUTER JOIN updates u ON s.id = u.id""", ARTICLES, UPDATES, _STORED))
def upsert_replace(spark, sf_dir):
    return _shown(merge.upsert_replace(_stored(spark, sf_dir), views.updates(spark, sf_dir)))


@query(with_views("""SELECT coalesce(s.id, u.id) AS id, coalesce(u.title, s.title) AS title, s.journal AS journal,
  array_to_string(list_sort(coalesce(u.tags, s.tags)), ' ') AS tags,
  s.n_content AS n_content FROM stored s FULL OUTER JOIN updates u ON s.id = u.id""", ARTICLES, UPDATES, _STORED))
def upsert_shallow(spark, sf_dir):
    return _shown(merge.upsert_shallow(_stored(spark, sf_dir), views.updates(spark, sf_dir)))


@query(with_views("""SELECT coalesce(s.id, u.id) AS id, coalesce(s.journal, u.journal) AS journal,
  CASE WHEN u.id IS NOT NULL THEN u.title ELSE s.title END AS title, s.n_content AS n_content
FROM stored s FULL OUTER JOIN (
  SELECT id, title, CASE WHEN title LIKE 'T%' THEN 'vtc' ELSE 'laodong' END AS journal FROM updates) u
ON s.id = u.id AND s.journal = u.journal""", ARTICLES, UPDATES, _STORED))
def upsert_composite_key(spark, sf_dir):
    journal = F.when(F.col("title").startswith("T"), F.lit("vtc")).otherwise(F.lit("laodong"))
    updates = views.updates(spark, sf_dir).select("id", journal.alias("journal"), "title")
    return merge.upsert_merge(_stored(spark, sf_dir).drop("tags"), updates, ["id", "journal"])


def _user_updates(spark, sf_dir):
    """Each event as an update of its user: the same user comes many times."""
    events = views.table(spark, sf_dir, "events")
    slot = F.concat(F.lit("v"), (F.floor("value") % 7).cast("string"))
    return events.select(
        "user_id",
        "event_id",
        "event_type",
        F.when(F.col("event_id") % 6 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 97 != 0, F.array("event_type", slot, F.lit(""))).alias("tags"),
    )


_FOLDED = """ups AS (
  SELECT user_id, event_id, event_type, CASE WHEN event_id % 6 <> 0 THEN value END AS value,
    CASE WHEN event_id % 97 <> 0 THEN [event_type, 'v' || (CAST(floor(value) AS BIGINT) % 7), ''] END AS tags FROM events),
last_unset AS (SELECT user_id, max(event_id) AS at FROM ups WHERE tags IS NULL GROUP BY user_id),
items AS (
  SELECT user_id, item, min(event_id * 10 + pos) AS first FROM (
    SELECT u.user_id, u.event_id, unnest(u.tags) AS item, unnest(range(0, len(u.tags))) AS pos
    FROM ups u LEFT JOIN last_unset l ON u.user_id = l.user_id WHERE u.tags IS NOT NULL AND (l.at IS NULL OR u.event_id > l.at))
  GROUP BY user_id, item),
lists AS (SELECT user_id, string_agg(item, '|' ORDER BY first) AS tags FROM items GROUP BY user_id),
scalars AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM ups) WHERE rn = 1)"""


@query(with_views("""SELECT s.user_id, s.event_id, s.event_type, s.value, l.tags,
  CASE WHEN x.at IS NULL THEN '' ELSE 'tags' END AS cleared
FROM scalars s LEFT JOIN lists l ON s.user_id = l.user_id LEFT JOIN last_unset x ON s.user_id = x.user_id""", _FOLDED))
def fold_updates(spark, sf_dir):
    folded = merge.fold_updates(_user_updates(spark, sf_dir), "user_id", ["event_id"])
    return folded.select(
        "user_id", "event_id", "event_type", "value", F.array_join("tags", "|").alias("tags"),
        F.array_join(merge.CLEARED, " ").alias("cleared"),
    )


@query("""SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def keep_last(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").drop("props")
    return merge.keep_last(events, "user_id", ["ts", "event_id"]).drop("ts")


@query(with_views(_MERGED,
                  ARTICLES, UPDATES,
                  """stored AS (SELECT id, title, journal, list_filter(tags, lambda t: t <> '') AS tags,
                  len(content) AS n_content FROM articles)"""))
def document_table(spark, sf_dir):
    """Two batches, each making a snapshot."""
    documents = DocumentTable(spark, new_folder(spark, "documents"), "id", ["at"])
    documents.upsert(_stored(spark, sf_dir).withColumn("at", F.lit(0)), 0)
    documents.upsert(views.updates(spark, sf_dir).withColumn("at", F.lit(1)), 1)
    return _shown(documents.read().drop("at"))


@query(with_views("SELECT id, title, CAST(doc_id % 3 AS INTEGER) AS version, len(content) AS n_content FROM articles", ARTICLES))
def article_files(spark, sf_dir):
    """Three versions of some articles are written to files; the last one stays."""
    rows = views.articles(spark, sf_dir)
    versions = F.explode(F.sequence(F.lit(0), (F.col("doc_id") % 3).cast("int")))
    copies = rows.select("id", "journal", "title", "content", versions.alias("version"))
    path = new_folder(spark, "files")
    write_article_files(copies, path, "id", ["version"])
    stored = spark.read.schema("id string, title string, version int, content array<string>, journal string").json(path)
    return stored.select("id", "title", "version", F.size("content").cast("long").alias("n_content"))


@query(with_views("""SELECT id, journal, title, CAST(NULL AS VARCHAR) AS author, len(content) AS n_content,
  array_to_string(list_sort(tags), ' ') AS tags FROM articles""", ARTICLES))
def article_json(spark, sf_dir):
    """Articles written as JSON lines with a key too many, read back by the fixed schema."""
    rows = views.articles(spark, sf_dir).select("id", "journal", "title", "content", "tags", F.lit(1).alias("unknown"))
    path = new_folder(spark, "json")
    rows.write.json(path)
    stored = read_articles_json(spark, path, one_per_file=False)
    return _shown(stored.select("id", "journal", "title", "author", F.size("content").cast("long").alias("n_content"), "tags"))


@query(with_views("SELECT id, title, journal, type FROM articles", ARTICLES))
def load_records(spark, sf_dir):
    """Files that each hold one JSON array of nested records, as flat rows."""
    about = F.struct("journal", "type").alias("about")
    part = F.expr(f"doc_id div {_RECORDS_A_FILE}").alias("part")
    rows = views.articles(spark, sf_dir).select(part, F.struct("id", "title", about).alias("r"))
    path = new_folder(spark, "records")
    rows.groupBy("part").agg(F.to_json(F.collect_list("r")).alias("value")).write.partitionBy("part").text(path)
    flat = read_records(spark, path)
    return flat.select("id", "title", F.col("`about.journal`").alias("journal"), F.col("`about.type`").alias("type"))


@query(with_views("SELECT id, journal, title, 'store' AS sink FROM articles", ARTICLES))
def route_to_store(spark, sf_dir):
    """Rows go to the first sink there is, here the table."""
    path = new_folder(spark, "routed")
    rows = views.articles(spark, sf_dir).select("id", "journal", "title")
    sink = route(rows, store=lambda df: write_append(df, path), files=lambda df: write_article_files(df, path))
    return read_collection(spark, path).select("id", "journal", "title", F.lit(sink).alias("sink"))


@query(with_views("""SELECT id, journal, title FROM articles WHERE journal = 'dantri'
UNION ALL SELECT id, journal, title FROM articles WHERE journal = 'dantri' AND type = 'en'""", ARTICLES))
def append_table(spark, sf_dir):
    """Two appends to a table by journal, then one journal read back."""
    rows = views.articles(spark, sf_dir).select("id", "journal", "title", "type")
    path = new_folder(spark, "appended")
    write_append(rows, path, mode="error")
    write_append(rows.where("type = 'en'"), path)
    return read_collection(spark, path, "dantri").select("id", "journal", "title")
