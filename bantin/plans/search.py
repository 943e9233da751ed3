"""Index queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from bantin.functions.dates import parse_date_any
from bantin.functions.text import drop_empty_paragraphs
from bantin.operators import search
from bantin.operators.envelope import project_article
from bantin.operators.keywords import refine_keywords
from bantin.plans import views
from bantin.plans.registry import query
from bantin.plans.views import ARTICLES, DATED, KEYWORDED, with_views

_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+')"


@query(with_views("SELECT journal, type, count(*) AS n FROM articles GROUP BY journal, type", ARTICLES))
def terms_by_type(spark, sf_dir):
    rows = views.articles(spark, sf_dir).withColumns({"date": F.col("crawled"), "content": drop_empty_paragraphs("content")})
    return search.terms(project_article(rows), ["journal", "type"])


@query(with_views("""SELECT tags, count(*) AS n FROM (SELECT unnest(tags) AS tags FROM articles)
GROUP BY tags ORDER BY n DESC, tags LIMIT 20""", ARTICLES))
def terms_tags_topk(spark, sf_dir):
    return search.terms(views.articles(spark, sf_dir), "tags", 20)


@query(with_views("""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, journal, count(*) AS n
FROM dated GROUP BY ALL""", DATED))
def date_histogram(spark, sf_dir):
    rows = views.dated(spark, sf_dir).withColumn("date", parse_date_any("raw_date"))
    counts = search.date_histogram(rows, "day", by=["journal"])
    return counts.select(F.date_format("bucket", "yyyy-MM-dd").alias("day"), "journal", "n")


@query(f"SELECT doc_id, lang FROM documents WHERE list_has_all({_WORDS}, ['the', 'and', 'this'])")
def match_all_words(spark, sf_dir):
    return search.match(views.spread_documents(spark, sf_dir), "text", ["the", "and", "This"], "and").select("doc_id", "lang")


@query(f"SELECT doc_id, lang FROM documents WHERE list_has_any({_WORDS}, ['markt', 'und', 'avec'])")
def match_any_word(spark, sf_dir):
    return search.match(views.spread_documents(spark, sf_dir), "text", ["markt", "und", "avec"]).select("doc_id", "lang")


@query(with_views("""SELECT id, journal, type, title FROM articles WHERE journal = 'vtc' AND type = 'en'
ORDER BY crawled DESC, id LIMIT 10""", ARTICLES))
def latest_articles(spark, sf_dir):
    newest = search.latest(views.articles(spark, sf_dir), 10, "vtc", "en", date="crawled")
    return newest.select("id", "journal", "type", "title")


@query(with_views("""SELECT type, id, rank FROM (
  SELECT type, id, row_number() OVER (PARTITION BY type ORDER BY crawled DESC, id) AS rank FROM articles)
WHERE rank <= 5""", ARTICLES))
def latest_by_type(spark, sf_dir):
    newest = search.latest_per(views.articles(spark, sf_dir), "type", 5, date="crawled")
    return newest.select("type", "id", F.col("rank").cast("long").alias("rank"))


@query(with_views("""SELECT year_month, phrase, n, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY year_month ORDER BY n DESC, phrase) AS rank FROM (
    SELECT year_month, phrase, count(*) AS n FROM (
      SELECT strftime(date, '%Y-%m') AS year_month, unnest(list_distinct(list_transform(
        list_filter(keywords, lambda k: <kept>), lambda k: k.keyword))) AS phrase
      FROM keyworded)
    GROUP BY ALL))
WHERE rank <= 10""".replace("<kept>", views.KEPT_KEYWORD), ARTICLES, KEYWORDED))
def keyword_trend(spark, sf_dir):
    refined = refine_keywords(views.keyworded(spark, sf_dir))
    trend = search.keyword_trend(refined, k=10)
    return trend.withColumn("rank", F.col("rank").cast("long"))
