"""Page, link and frontier queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from bantin.catalogue import IMAGE_HOSTS, LISTING_SUFFIX, SECTIONS
from bantin.functions import dom
from bantin.functions import text as TX
from bantin.functions import urls as U
from bantin.operators import extraction as X
from bantin.operators import frontier
from bantin.plans import views
from bantin.plans.registry import query
from bantin.plans.views import ARTICLES, DATED, SQL_CLEAN_DATE, with_views
from bantin.sources.seen import SeenSet
from bantin.sources.workspace import materialise, new_folder

_UNESCAPED = "replace(replace(replace({0}, '&quot;', '\"'), '&lt;', '<'), '&amp;', '&')"


@query(f"""SELECT page_id, trim({_UNESCAPED.format("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")}) AS title FROM pages""")
def page_titles(spark, sf_dir):
    parsed = X.parse_pages(views.spread_pages(spark, sf_dir))
    title = F.expr(dom.node_text("dom.text", dom.find("dom.nodes", tag="h1")))
    return parsed.select("page_id", TX.clean_text(title).alias("title"))


@query("""SELECT page_id, CAST((length(a) - length(replace(a, '<p>', ''))) / 3 AS BIGINT) AS n_paragraphs
FROM (SELECT page_id, regexp_extract(html, '<article>(.*?)(</article>|$)', 1, 's') AS a FROM pages)""")
def page_paragraphs(spark, sf_dir):
    parsed = X.parse_pages(views.spread_pages(spark, sf_dir))
    parsed = parsed.withColumn("article", F.expr(dom.find("dom.nodes", tag="article")))
    paragraphs = F.expr(dom.find_all("dom.nodes", tag="p", within="article"))
    return parsed.select("page_id", F.size(paragraphs).cast("long").alias("n_paragraphs"))


@query("""SELECT page_id, CAST(pos AS INTEGER) AS pos, href FROM (
  SELECT page_id, unnest(links) AS href, unnest(range(0, len(links))) AS pos FROM (
    SELECT page_id, regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), '<a href="([^"]+)"', 1) AS links FROM pages))""")
def page_links(spark, sf_dir):
    return X.page_links(views.spread_pages(spark, sf_dir)).select("page_id", "pos", "href")


@query("""SELECT DISTINCT page_id, href FROM (
  SELECT page_id, unnest(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), '<a href="([^"]+)"', 1)) AS href FROM pages)""")
def distinct_links(spark, sf_dir):
    links = X.page_links(views.spread_pages(spark, sf_dir)).drop("url")
    return frontier.distinct_links(links).select("page_id", "href")


_LINKS = """links AS (
  SELECT page_id, url LIKE 'https://www.%' AS visited,
    unnest(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), '<a href="([^"]+)"', 1)) AS url FROM pages)"""


@query(with_views("""SELECT url, min(page_id) AS page_id FROM links
WHERE url NOT IN (SELECT url FROM links WHERE visited) GROUP BY url""", _LINKS))
def unseen_links(spark, sf_dir):
    """Links of all pages that no page of a https://www. site has."""
    links = materialise(X.page_links(views.spread_pages(spark, sf_dir)))  # pages are parsed once
    seen = links.where(F.col("url").startswith("https://www.")).select(F.col("href").alias("url"))
    return frontier.unseen_links(links.select(F.col("href").alias("url"), "page_id"), seen)


@query(with_views("SELECT url, min(page_id % 3)::BIGINT AS crawl FROM links GROUP BY url", _LINKS))
def seen_set_links(spark, sf_dir):
    """Three crawls, each of a third of the pages: the links that each is the first to find."""
    links = materialise(X.page_links(views.table(spark, sf_dir, "pages")).select(F.col("href").alias("url"), "page_id"))
    seen, found = SeenSet(spark, new_folder(spark, "seen"), expected=100_000), []
    for crawl in range(3):
        own = links.where(F.col("page_id") % 3 == crawl)
        found.append(seen.unseen(own).select("url", F.lit(crawl).cast("long").alias("crawl")))
        if crawl < 2:
            seen.add(own)
    return found[0].unionByName(found[1]).unionByName(found[2])


_AUTHOR = "'Author ' || (doc_id % 50)"
_PARAGRAPHS = """CASE
  WHEN journal IN ('vneconomy', 'nhipcaudautu', 'saigontimes') THEN
    list_filter(list_transform(content, lambda p: trim(p)), lambda p: p <> '')
  WHEN journal = 'diendandoanhnghiep' THEN
    list_append(list_filter(list_transform(content, lambda p: trim(p)), lambda p: p <> ''), 'Photo ' || doc_id)
  WHEN journal = 'vietnamnet' THEN list_append(list_transform(content, lambda p: trim(p)), 'Author ' || (doc_id % 50))
  ELSE list_transform(content, lambda p: trim(p)) END"""
_TAG_LIST = """CASE
  WHEN journal = 'baodautu' THEN list_transform(list_filter(list_transform(tags, lambda t: trim(t)), lambda t: t <> ''), lambda t: trim(replace(t, '#', '')))
  WHEN journal IN ('vneconomy', 'saigontimes', 'diendandoanhnghiep', 'nhipcaudautu') THEN list_filter(list_transform(tags, lambda t: trim(t)), lambda t: t <> '')
  ELSE list_transform(tags, lambda t: trim(t)) END"""
# Text read from a page is trimmed before the site rule; a leading space left by the rule stays.
_EXTRACTED = f"""SELECT CASE journal
    WHEN 'nhipcaudautu' THEN 'nhipcaudautu_' || id || '.html'
    WHEN 'saigontimes' THEN 'saigontimes_' || id ELSE journal || '_index' END AS id,
  doc_id, journal, trim(title) AS title, trim(coalesce(attract, '')) AS attract, {_AUTHOR} AS author,
  {SQL_CLEAN_DATE} AS date_text, md5(array_to_string({_PARAGRAPHS}, chr(10))) AS body,
  len({_PARAGRAPHS}) AS n_paragraphs, array_to_string(list_sort({_TAG_LIST}), '|') AS tags
FROM (SELECT *, crawled AS ts FROM articles)"""


def _extracted(spark, sf_dir):
    return X.extract_articles(views.news_pages(spark, sf_dir))


@query(with_views(_EXTRACTED + " WHERE doc_id % 17 <> 0", ARTICLES))
def extract_articles(spark, sf_dir):
    return X.require_nodes(_extracted(spark, sf_dir)).select(
        "id", "doc_id", "journal", "title", "attract", "author", "date_text",
        F.md5(F.array_join("content", "\n")).alias("body"),
        F.size("content").cast("long").alias("n_paragraphs"),
        F.array_join(F.sort_array("tags"), "|").alias("tags"),
    )


@query(with_views("""SELECT 'https://site.example/news/' || id || '.html/index.htm' AS url, journal,
  true AS has_reason FROM articles WHERE doc_id % 17 = 0""", ARTICLES))
def rejected_pages(spark, sf_dir):
    rejected = X.rejected_pages(_extracted(spark, sf_dir))
    return rejected.select("url", "journal", F.col("reject_reason").startswith("missing ").alias("has_reason"))


_IMAGE_HOST = "CASE journal " + " ".join(f"WHEN '{j}' THEN '{h}'" for j, h in IMAGE_HOSTS.items()) + " ELSE '' END"


@query(with_views(f"""SELECT doc_id, 0 AS pos, {_IMAGE_HOST} || '/img/' || doc_id || '.png' AS image_url,
  'Photo ' || doc_id AS image_title FROM articles""", ARTICLES))
def image_refs(spark, sf_dir):
    extracted = _extracted(spark, sf_dir).withColumn("id", F.col("doc_id"))
    return X.image_refs(extracted).withColumnRenamed("id", "doc_id")


_LISTED = """listed AS (SELECT doc_id, journal, unnest(range(0, len(content))) AS i, unnest(content) AS line FROM articles)"""


@query(with_views("""SELECT doc_id, journal, CAST(i AS INTEGER) AS pos, CASE journal
    WHEN 'vneconomy' THEN 'https://vneconomy.vn' WHEN 'nhipcaudautu' THEN 'https://nhipcaudautu.vn'
    WHEN 'dantri' THEN 'https://dantri.com.vn' WHEN 'vietnamnet' THEN 'https://vietnamnet.vn'
    WHEN 'phapluatdoisong' THEN 'https://www.doisongphapluat.com' WHEN 'vtc' THEN 'https://vtc.vn'
    WHEN 'laodong' THEN 'https://laodong.vn' ELSE '' END || '/' || md5(line) AS link FROM listed""", ARTICLES, _LISTED))
def listing_links(spark, sf_dir):
    """A listing page for each document, with a link for each line of its text."""
    return X.extract_links(views.listing_pages(spark, sf_dir)).select("doc_id", "journal", "pos", "link")


@query(with_views("""SELECT doc_id, journal, NULL AS reason FROM listed WHERE doc_id % 9 <> 0
UNION ALL SELECT doc_id, 'nosuch', 'no rules for nosuch' FROM articles WHERE doc_id % 9 = 0""", ARTICLES, _LISTED))
def listing_rejects(spark, sf_dir):
    """Links of the known journals, and the listings of unknown ones with the reason."""
    journal = F.when(F.col("doc_id") % 9 == 0, F.lit("nosuch")).otherwise(F.col("journal"))
    listings = views.listing_pages(spark, sf_dir).withColumn("journal", journal)
    links = X.extract_links(listings).select("doc_id", "journal", F.lit(None).cast("string").alias("reason"))
    return links.unionByName(X.rejected_listings(listings).select("doc_id", "journal", F.col("reject_reason").alias("reason")))


@query("SELECT doc_id, md5(trim(text, ' ' || chr(9) || chr(10) || chr(13))) AS body FROM documents")
def clean_text(spark, sf_dir):
    """Whole texts read with the wrong encoding and padded with no-break spaces, put right."""
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    padded = F.concat(F.lit(" Â "), broken, F.lit("Â \t"))
    return views.spread_documents(spark, sf_dir).select("doc_id", F.md5(TX.clean_text(padded)).alias("body"))


@query(with_views("""SELECT doc_id, journal, CASE journal WHEN 'vneconomy' THEN 'By ' || type
  WHEN 'diendandoanhnghiep' THEN 'By ' || type || ' -' WHEN 'vietnamnet' THEN content[len(content)]
  ELSE 'By ' || type || ' - | Desk' END AS author FROM articles""", ARTICLES))
def clean_author(spark, sf_dir):
    shown = F.when(F.col("journal") == "vneconomy", F.concat(F.lit("By "), "type", F.lit(" -"))).otherwise(
        F.concat(F.lit("By "), "type", F.lit(" - | Desk"))
    )
    return views.articles(spark, sf_dir).select("doc_id", "journal", TX.clean_author("journal", shown, "content").alias("author"))


@query(with_views("""SELECT doc_id, journal, array_to_string(CASE journal
    WHEN 'baodautu' THEN ['one', type] WHEN 'vneconomy' THEN ['#one', '# ' || type] WHEN 'saigontimes' THEN ['#one', '# ' || type]
    WHEN 'diendandoanhnghiep' THEN ['#one', '# ' || type] WHEN 'nhipcaudautu' THEN ['#one', '# ' || type]
    ELSE ['#one', '', '# ' || type] END, '|') AS tags FROM articles""", ARTICLES))
def clean_tags(spark, sf_dir):
    shown = F.array(F.lit("#one"), F.lit(""), F.concat(F.lit("# "), "type"))
    return views.articles(spark, sf_dir).select(
        "doc_id", "journal", F.array_join(TX.clean_tags("journal", shown), "|").alias("tags")
    )


@query(f"""SELECT event_id, journal, CASE
    WHEN journal = 'vietnamnet' AND event_id % 2 = 0 THEN 'https://vietnamnet.vn/x/' || event_id
    ELSE CASE journal WHEN 'vneconomy' THEN 'https://vneconomy.vn' WHEN 'nhipcaudautu' THEN 'https://nhipcaudautu.vn'
      WHEN 'dantri' THEN 'https://dantri.com.vn' WHEN 'vietnamnet' THEN 'https://vietnamnet.vn'
      WHEN 'phapluatdoisong' THEN 'https://www.doisongphapluat.com' WHEN 'vtc' THEN 'https://vtc.vn' ELSE '' END
      || CASE WHEN event_id % 2 = 0 THEN 'https://vietnamnet.vn' ELSE '' END || '/x/' || event_id END AS link
FROM (SELECT event_id, {views.sql_journal("event_id // 3")} AS journal FROM events)""")
def absolute_urls(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").withColumn("slot", F.floor(F.col("event_id") / 3))
    host = F.when(F.col("event_id") % 2 == 0, F.lit("https://vietnamnet.vn")).otherwise(F.lit(""))
    href = F.concat(host, F.lit("/x/"), F.col("event_id").cast("string"))
    rows = events.select("event_id", views.journal_of("slot").alias("journal"), href.alias("href"))
    return rows.select("event_id", "journal", U.absolute_url("journal", "href").alias("link"))


@query(f"""SELECT page_id, url, journal || '_' || CASE journal WHEN 'saigontimes' THEN split_part(split_part(url, '/', -2), '.', 1)
  WHEN 'nhipcaudautu' THEN split_part(url, '/', -2) ELSE split_part(split_part(url, '/', -1), '.', 1) END AS key
FROM (SELECT page_id, url, {views.sql_journal('page_id')} AS journal FROM pages)""")
def article_keys(spark, sf_dir):
    pages = views.table(spark, sf_dir, "pages").select("page_id", "url", views.journal_of("page_id").alias("journal"))
    return pages.select("page_id", "url", U.article_key("journal", "url").alias("key"))


_SUFFIX = "CASE journal " + " ".join(
    "WHEN '{}' THEN '{}' || page || '{}'".format(j, *s.split("{n}")) for j, s in LISTING_SUFFIX.items()
    if j != "diendandoanhnghiep"
) + " ELSE CASE WHEN page = 1 THEN '/' ELSE '/trang-' || page || '/' END END"


@query(with_views(f"""SELECT event_id, page, 'https://s.example/' || user_id || {_SUFFIX} AS listing_url FROM (
  SELECT event_id, user_id, journal, unnest(range(first, CASE WHEN stop = 0 THEN first + 3 ELSE stop END)) AS page FROM (
    SELECT e.event_id, e.user_id, d.journal, 1 + e.event_id % 3 AS first, e.event_id % 7 AS stop
    FROM events e JOIN dated d ON e.event_id = d.event_id))""", DATED))
def page_frontier(spark, sf_dir):
    sections = views.table(spark, sf_dir, "events").select(
        "event_id",
        views.journal_of("event_id").alias("journal"),
        F.concat(F.lit("https://s.example/"), F.col("user_id").cast("string")).alias("section_url"),
        (F.col("event_id") % 3 + 1).alias("start"),
        (F.col("event_id") % 7).alias("end"),
    )
    return frontier.page_frontier(sections, cap=3).select("event_id", "page", "listing_url")


_LISTINGS = f"""listings AS (
  SELECT user_id AS section, {views.sql_journal('user_id')} AS journal, event_id AS page,
    CASE WHEN event_id % 211 = 0 THEN [] WHEN event_id % 97 = 0 THEN ['one']
      ELSE [event_type, event_type || CAST(floor(value / 40) AS BIGINT)] END AS urls FROM events),
before AS (SELECT *, lag(urls) OVER (PARTITION BY section ORDER BY page) AS prev FROM listings)"""


def _listings(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    urls = (
        F.when(F.col("event_id") % 211 == 0, F.array().cast("array<string>"))
        .when(F.col("event_id") % 97 == 0, F.array(F.lit("one")))
        .otherwise(F.array("event_type", F.concat("event_type", F.floor(F.col("value") / 40).cast("string"))))
    )
    return events.select(
        F.col("user_id").alias("section"), views.journal_of("user_id").alias("journal"),
        F.col("event_id").alias("page"), urls.alias("urls"),
    )


@query(with_views("""SELECT b.section, b.page FROM before b LEFT JOIN (
  SELECT section, min(page) AS stop FROM before WHERE len(urls) < 2 OR coalesce(urls = prev, false) GROUP BY section) s
ON b.section = s.section WHERE s.stop IS NULL OR b.page < s.stop""", _LISTINGS))
def stop_at_repeat(spark, sf_dir):
    return frontier.stop_at_repeat(_listings(spark, sf_dir), min_links=2).select("section", "page")


@query(with_views("""SELECT b.section, b.page FROM before b LEFT JOIN (
  SELECT section, min(page) AS stop FROM before WHERE len(urls) < 1
    OR (journal IN ('baodautu', 'saigontimes') AND len(urls) < 2)
    OR (journal IN ('vtc', 'phapluatdoisong', 'laodong') AND coalesce(urls = prev, false)) GROUP BY section) s
ON b.section = s.section WHERE s.stop IS NULL OR b.page < s.stop""", _LISTINGS))
def stop_by_journal(spark, sf_dir):
    return frontier.stop_at_repeat(_listings(spark, sf_dir), journal="journal").select("section", "page")


_SECTION_ROWS = ", ".join(f"({i}, '{j}', '{u}', '{t}')" for i, (j, u, t) in enumerate(SECTIONS))


@query(with_views(f"""SELECT a.id, s.journal, s.type FROM articles a
LEFT JOIN (VALUES {_SECTION_ROWS}) AS s(n, journal, section_url, type) ON a.doc_id % 25 = s.n""", ARTICLES))
def label_sections(spark, sf_dir):
    """Three of 25 articles come from no known section and keep a NULL type."""
    names = F.array(*[F.struct(F.lit(j).alias("journal"), F.lit(u).alias("section_url")) for j, u, _ in SECTIONS])
    rows = views.articles(spark, sf_dir).select("id", F.get(names, (F.col("doc_id") % 25).cast("int")).alias("s"))
    return X.label_sections(rows.select("id", "s.journal", "s.section_url")).select("id", "journal", "type")
