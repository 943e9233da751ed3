"""Find, delete and filter queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from bantin.functions.text import body_paragraphs, drop_empty_paragraphs
from bantin.operators import filters, lookup
from bantin.plans import views
from bantin.plans.registry import query
from bantin.plans.views import ARTICLES, KEYWORDED, with_views


@query("""SELECT doc_id, lang, n_chars FROM documents
WHERE lang = 'en' AND doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def find_by_keys(spark, sf_dir):
    keys = views.table(spark, sf_dir, "labels").where("toxic = 1")
    docs = views.table(spark, sf_dir, "documents")
    return lookup.find(docs, keys, F.col("lang") == "en", ["lang", "n_chars"], key="doc_id")


@query("SELECT doc_id, source FROM documents WHERE lang = 'fr' AND n_chars > 500 ORDER BY doc_id LIMIT 1")
def find_one(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents")
    condition = (F.col("lang") == "fr") & (F.col("n_chars") > 500)
    return lookup.find_one(docs, None, condition, ["source"], key="doc_id")


@query("SELECT page_id, url FROM pages WHERE page_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def find_in(spark, sf_dir):
    keys = views.table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("page_id"))
    return lookup.find_in(spark, sf_dir, "pages.parquet", keys, None, ["url"], key="page_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)")
def delete_by_keys(spark, sf_dir):
    keys = views.table(spark, sf_dir, "labels").where("quality = 0")
    return lookup.delete_by_keys(views.table(spark, sf_dir, "documents"), keys, "doc_id").select("doc_id", "lang")


@query(with_views("SELECT id, attract FROM articles WHERE attract IS NULL OR NOT starts_with(attract, 'The')", ARTICLES))
def delete_where(spark, sf_dir):
    rows = views.articles(spark, sf_dir)
    return lookup.delete_where(rows, F.col("attract").startswith("The")).select("id", "attract")


@query(with_views("SELECT id, journal FROM articles WHERE crawled > TIMESTAMP '2024-01-01 05:00:00'", ARTICLES))
def crawled_since(spark, sf_dir):
    since = F.expr("timestamp_ntz'2024-01-01 05:00:00'")
    return filters.crawled_since(views.articles(spark, sf_dir), since).select("id", "journal")


@query(with_views("SELECT id, journal FROM articles WHERE journal IN ('vtc', 'laodong')", ARTICLES))
def only_journals(spark, sf_dir):
    return filters.only_journals(views.articles(spark, sf_dir), ["vtc", "laodong", "nosuch"]).select("id", "journal")


_HREF = """CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN '/a/' || event_id
  WHEN 2 THEN 'https://vtc.vn/a/' || event_id WHEN 3 THEN 'https://www.doisongphapluat.com/a/' || event_id
  ELSE 'https://laodong.vn/tien-te/' || event_id END"""


@query(with_views(f"""SELECT event_id, journal, href FROM (SELECT event_id, journal, {_HREF} AS href FROM dated)
WHERE href <> '' AND CASE journal WHEN 'vtc' THEN href NOT LIKE '%https://vtc.vn%'
  WHEN 'phapluatdoisong' THEN href NOT LIKE '%https://www.doisongphapluat.com%'
  WHEN 'laodong' THEN href LIKE '%https://laodong.vn/tien-te%' ELSE true END""",
                  f"dated AS (SELECT event_id, {views.sql_journal('event_id // 7')} AS journal FROM events)"))
def keep_links(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").withColumn("slot", F.floor(F.col("event_id") / 7))
    links = events.select(
        "event_id", views.journal_of("slot").alias("journal"), F.expr(_HREF).alias("href")
    ).withColumn("section_url", F.lit("https://laodong.vn/tien-te"))
    return filters.keep_links(links, "href", "section_url").drop("section_url")


@query(with_views("SELECT id, attract FROM articles WHERE attract IS NOT NULL", ARTICLES))
def required_columns(spark, sf_dir):
    rows = views.articles(spark, sf_dir).select("id", "attract")
    return filters.with_required_columns(rows, ["id", "attract"])


@query(with_views("""SELECT doc_id, array_to_string(list_transform(
  list_filter(keywords, lambda k: <kept>), lambda k: k.keyword), '|') AS kept
FROM keyworded""".replace("<kept>", views.KEPT_KEYWORD), ARTICLES, KEYWORDED))
def keyword_filter(spark, sf_dir):
    rows = views.keyworded(spark, sf_dir)
    return rows.select("doc_id", F.array_join(filters.keyword_filter("keywords"), "|").alias("kept"))


@query(with_views("""SELECT doc_id, len(list_filter(content, lambda p: p <> '')) AS n,
  md5(array_to_string(list_filter(content, lambda p: p <> ''), chr(10))) AS body FROM articles""", ARTICLES))
def drop_empty(spark, sf_dir):
    kept = views.articles(spark, sf_dir).select("doc_id", drop_empty_paragraphs("content").alias("content"))
    return kept.select("doc_id", F.size("content").cast("long").alias("n"), F.md5(F.array_join("content", "\n")).alias("body"))


@query(with_views("""SELECT doc_id, journal, md5(array_to_string(CASE
    WHEN journal = 'phapluatdoisong' THEN content[1:greatest(len(content) - 2, 0)]
    WHEN journal IN ('vneconomy', 'diendandoanhnghiep', 'nhipcaudautu', 'saigontimes') THEN list_filter(content, lambda p: p <> '')
    ELSE content END, chr(10))) AS body FROM articles""", ARTICLES))
def body_paragraphs_by_journal(spark, sf_dir):
    rows = views.articles(spark, sf_dir)
    return rows.select("doc_id", "journal", F.md5(F.array_join(body_paragraphs("journal", "content"), "\n")).alias("body"))
