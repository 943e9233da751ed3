"""News tables derived from the test tables, in Spark and, for the oracle, in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bantin.catalogue import DOMAIN_STOP_WORDS, JOURNALS
from bantin.functions.columns import case_of, string_array
from bantin.site_rules import ARTICLE_SELECTORS, LISTING_SELECTORS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages for work that is heavy per row; a test table is one file that cannot be split."""
    return table(spark, sf_dir, "pages").repartition("page_id")


def spread_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for work that is heavy per row; a test table is one file that cannot be split."""
    return table(spark, sf_dir, "documents").repartition("doc_id")


def journal_of(number) -> Column:
    return F.element_at(string_array(JOURNALS), (F.col(number) % 10 + 1).cast("int"))


def sql_journal(number: str) -> str:
    return f"([{', '.join(repr(j) for j in JOURNALS)}])[{number} % 10 + 1]"


# --- articles -------------------------------------------------------------------------

def article_columns(documents: DataFrame) -> DataFrame:
    """Also works on a stream of documents."""
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    minutes = F.make_dt_interval(mins=F.col("doc_id").cast("int"))
    return documents.select(
        "doc_id",
        F.concat("source", F.lit("_"), F.col("doc_id").cast("string")).alias("id"),
        journal_of("doc_id").alias("journal"),
        F.col("lang").alias("type"),
        title.alias("title"),
        F.nullif(F.split_part("text", F.lit("\n"), F.lit(2)), F.lit("")).alias("attract"),
        F.lit(None).cast("string").alias("author"),
        F.split("text", "\n").alias("content"),
        F.array_distinct(F.split(F.lower(title), " ")).alias("tags"),
        (F.expr("timestamp_ntz'2024-01-01 00:00:00'") + minutes).alias("crawled"),
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return article_columns(table(spark, sf_dir, "documents"))


ARTICLES = f"""articles AS (
  SELECT doc_id, source || '_' || doc_id AS id, {sql_journal('doc_id')} AS journal, lang AS type,
    split_part(text, chr(10), 1) AS title,
    nullif(split_part(text, chr(10), 2), '') AS attract,
    CAST(NULL AS VARCHAR) AS author,
    string_split(text, chr(10)) AS content,
    list_distinct(string_split(lower(split_part(text, chr(10), 1)), ' ')) AS tags,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS crawled
  FROM documents)"""


# --- updates --------------------------------------------------------------------------

def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-crawled articles: a changed or removed title, new tags, some new articles."""
    joined = articles(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    new_id = F.concat(F.lit("new_"), (F.col("doc_id") + 1000000).cast("string"))
    return joined.select(
        F.when(F.col("doc_id") % 7 == 0, new_id).otherwise(F.col("id")).alias("id"),
        F.when(F.col("toxic") != 1, F.concat("title", F.lit("!"))).alias("title"),
        F.array(F.concat(F.lit("q"), F.col("quality").cast("string")), F.lit("")).alias("tags"),
    )


UPDATES = """updates AS (
  SELECT CASE WHEN a.doc_id % 7 = 0 THEN 'new_' || (a.doc_id + 1000000) ELSE a.id END AS id,
    CASE WHEN l.toxic = 1 THEN NULL ELSE a.title || '!' END AS title,
    ['q' || l.quality, ''] AS tags
  FROM articles a JOIN labels l ON a.doc_id = l.doc_id)"""


# --- dates as the sites write them ----------------------------------------------------

def _clock(pattern: str) -> Column:
    return F.date_format("ts", pattern)


def raw_date() -> Column:
    """`ts` in the journal's own style."""
    return case_of("journal", [
        (["dantri"], _clock("yyyy-MM-dd HH:mm")),
        (["vtc"], F.concat(_clock("dd/MM/yyyy HH:mm:ss"), F.lit(" +07:00"))),
        (["saigontimes"], F.concat(_clock("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00"))),
        (["diendandoanhnghiep"], _clock("dd/MM/yyyy HH:mm:ss")),
        (["laodong"], _clock("d/M/yyyy H:mm")),
        (["vneconomy"], F.concat(_clock("dd/MM/yyyy HH:mm"), F.lit(" (GMT+07:00)"))),
    ], otherwise=_clock("dd/MM/yyyy HH:mm"))


def dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", journal_of("event_id").alias("journal"))
    return events.withColumn("raw_date", raw_date())


DATED = f"dated AS (SELECT event_id, ts, {sql_journal('event_id')} AS journal FROM events)"


def decorated_date() -> Column:
    """`ts` as it stands in the page, with the site's decoration; `clean_date_text` undoes it."""
    minute = F.concat(_clock("dd/MM/yyyy"), F.lit("{}"), _clock("HH:mm"))

    def with_gap(gap: str) -> Column:
        return F.replace(minute, F.lit("{}"), F.lit(gap))

    return case_of("journal", [
        (["baodautu"], with_gap(" - ")),
        (["vietnamnet"], F.concat(F.lit("Wednesday, "), with_gap(" - "))),
        (["vneconomy"], F.concat(_clock("HH:mm"), F.lit(" "), _clock("dd/MM/yyyy"))),
        (["saigontimes"], F.concat(F.lit(" "), _clock("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00 "))),
        (["diendandoanhnghiep"], F.concat(_clock("dd/MM/yyyy"), F.lit(", "), _clock("HH:mm:ss"))),
        (["nhipcaudautu"], F.concat(F.lit("Desk | "), with_gap(" "), F.lit(" "))),
        (["dantri"], _clock("yyyy-MM-dd HH:mm")),
        (["phapluatdoisong"], F.concat(F.lit("Wed, "), with_gap(" | "))),
        (["vtc"], F.concat(F.lit("Wed, "), _clock("dd/MM/yyyy HH:mm:ss"), F.lit(" +07:00"))),
    ], otherwise=F.concat(F.lit("Wed, "), with_gap(" ")))


SQL_CLEAN_DATE = """CASE journal
    WHEN 'saigontimes' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+07:00'
    WHEN 'diendandoanhnghiep' THEN strftime(ts, '%d/%m/%Y %H:%M:%S')
    WHEN 'dantri' THEN strftime(ts, '%Y-%m-%d %H:%M')
    WHEN 'vtc' THEN ' ' || strftime(ts, '%d/%m/%Y %H:%M:%S') || ' +07:00'
    WHEN 'vietnamnet' THEN ' ' || strftime(ts, '%d/%m/%Y %H:%M')
    WHEN 'phapluatdoisong' THEN ' ' || strftime(ts, '%d/%m/%Y %H:%M')
    WHEN 'laodong' THEN ' ' || strftime(ts, '%d/%m/%Y %H:%M')
    ELSE strftime(ts, '%d/%m/%Y %H:%M') END"""


# --- messages -------------------------------------------------------------------------

def message_columns(rows: DataFrame, broken_every: int | None = 13) -> DataFrame:
    """Articles as queue messages (doc_id, topic, value); some messages are cut short."""
    style = rows.withColumn("ts", F.col("crawled")).withColumn("date", raw_date())
    body = F.to_json(F.struct("id", "journal", "type", "title", "attract", "author", "date", "content", "tags"))
    value = body
    if broken_every:
        value = F.when(F.col("doc_id") % broken_every == 0, F.left(body, F.lit(20))).otherwise(body)
    return style.select("doc_id", F.col("journal").alias("topic"), value.alias("value"))


def messages(spark: SparkSession, sf_dir: str, broken_every: int | None = 13) -> DataFrame:
    return message_columns(article_columns(spread_documents(spark, sf_dir)), broken_every)


# --- keyworded articles ---------------------------------------------------------------

def keyworded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles that carry scored keywords and a date text in one of several styles."""
    day = F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")
    month = F.lpad((F.col("doc_id") % 12 + 1).cast("string"), 2, "0")
    usual = F.concat(day, F.lit("/"), month, F.lit("/2024 10:30"))
    date = (
        F.when(F.col("doc_id") % 11 == 0, F.lit("no date"))
        .when(F.col("doc_id") % 7 == 0, (F.col("doc_id") * 3600 + 1700000000).cast("string"))
        .when(F.col("doc_id") % 5 == 0, F.concat(F.replace(usual, F.lit(" "), F.lit("   ")), F.lit(" (GMT+07:00)")))
        .otherwise(usual)
    )

    words = F.flatten(F.transform("content", lambda line: F.split(line, " ")))

    def keyword(word: Column, i: Column) -> Column:
        return F.struct(
            F.when(i % 5 == 0, F.lit("market")).when(i % 5 == 1, F.lit("Market")).otherwise(F.lower(word)).alias("keyword"),
            (((F.col("doc_id") + i * 3) % 11).cast("double") / F.lit(10.0)).alias("score"),
        )

    return articles(spark, sf_dir).select("doc_id", "id", "journal", date.alias("date"), F.transform(words, keyword).alias("keywords"))


KEYWORDED = """keyworded AS (
  SELECT doc_id, id, journal,
    CASE WHEN doc_id % 11 = 0 THEN NULL
         WHEN doc_id % 7 = 0 THEN TIMESTAMP '1970-01-01' + to_seconds(doc_id * 3600 + 1700000000)
         ELSE make_timestamp(2024, doc_id % 12 + 1, doc_id % 28 + 1, 10, 30, 0) END AS date,
    list_transform(range(0, len(words)), lambda i: {
      'keyword': CASE WHEN i % 5 = 0 THEN 'market' WHEN i % 5 = 1 THEN 'Market'
                      ELSE lower(words[i + 1]) END,
      'score': CAST((doc_id + i * 3) % 11 AS DOUBLE) / 10}) AS keywords
  FROM (SELECT *, flatten(list_transform(content, lambda line: string_split(line, ' '))) AS words FROM articles))"""


KEPT_KEYWORD = "k.score > 0.5::DOUBLE AND k.keyword NOT IN ({})".format(", ".join(f"'{w}'" for w in DOMAIN_STOP_WORDS))


# --- pages of the news sites ----------------------------------------------------------

def _escape(text: Column) -> Column:
    amp = F.replace(text, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(amp, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _element(selector: str, inner: str, attributes: str = "") -> str:
    """Markup that the selector finds."""
    outer, _, own = selector.partition("@")[0].rpartition(" > ")
    mark, tag = "", own
    for sign, attribute in (("#", "id"), (".", "class")):
        if sign in own:
            tag, name = own.split(sign, 1)
            mark = f' {attribute}="{name}"'
            break
    made = f"<{tag or 'div'}{mark}{attributes}>{inner}</{tag or 'div'}>"
    return _element(outer, made) if outer and outer != "article" else made


def _page_template(name: str) -> str:
    """A page of the site with a place for each part, such as {title}."""
    rule = ARTICLE_SELECTORS[name]
    shown = {"vneconomy": "{author} -", "diendandoanhnghiep": "{author} | Desk"}.get(name, "{author}")
    picture = f'<img {rule["image_attribute"]}="/img/{{number}}.png">'
    if rule["caption"] == "td":
        figure = _element(rule["image"], f"<td>{picture}</td><td>Photo {{number}}</td>")
    else:
        figure = _element(rule["image"], picture + _element(rule["caption"], "Photo {number}"))
    signed = {"vietnamnet": "<p>{author}</p>", "phapluatdoisong": "<p><strong>{author}</strong></p><p>End</p>"}.get(name, "")
    lead_in_body = name == "saigontimes"
    body = (_element("h6", "{attract}") if lead_in_body else "") + "{paragraphs}" + signed + figure
    parts = [_element(rule["title"], "{title}")]
    if not lead_in_body:
        parts.append(_element(rule["attract"], "{attract}"))
    parts.append("{dated}")
    if rule["author"]:
        parts.append(_element(rule["author"], shown))
    tags = _element(rule["tags"], "{tags}")
    if name == "laodong":
        page = f"<article>{''.join(parts)}{body}</article>{tags}"
    else:
        page = "".join(parts) + _element(rule["body"], body) + tags
    return f"<!DOCTYPE html><html><body>{page}</body></html>"


def _date_template(name: str) -> str:
    selector = ARTICLE_SELECTORS[name]["date"]
    return _element(selector, "", ' datetime="{date}"') if "@" in selector else _element(selector, "{date}")


def _by_journal(template) -> Column:
    return F.element_at(string_array([template(j) for j in JOURNALS]), (F.col("doc_id") % 10 + 1).cast("int"))


def _fill(template: Column, parts: dict[str, Column]) -> Column:
    for name, value in parts.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template


def news_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every article as a page of its site; each 17th page lacks its date."""
    rows = article_columns(spread_documents(spark, sf_dir)).withColumn("ts", F.col("crawled"))
    dated = F.when(F.col("doc_id") % 17 == 0, F.lit("")).otherwise(
        _fill(_by_journal(_date_template), {"date": _escape(decorated_date())})
    )
    rows = rows.withColumn("tag", _by_journal(lambda j: _element(ARTICLE_SELECTORS[j]["tag"], "{tag}")))
    paragraphs = F.transform("content", lambda p: F.concat(F.lit("<p>"), _escape(p), F.lit("</p>")))
    tags = F.transform("tags", lambda t: F.replace("tag", F.lit("{tag}"), _escape(t)))
    html = _fill(_by_journal(_page_template), {
        "dated": dated,
        "author": F.concat(F.lit("Author "), (F.col("doc_id") % 50).cast("string")),
        "number": F.col("doc_id").cast("string"),
        "title": _escape(F.col("title")),
        "attract": _escape(F.coalesce("attract", F.lit(""))),
        "tags": F.array_join(tags, ""),
        "paragraphs": F.array_join(paragraphs, ""),
    })
    url = F.concat(F.lit("https://site.example/news/"), "id", F.lit(".html/index.htm"))
    return rows.select("doc_id", "journal", url.alias("url"), html.alias("html"))


def _listing_item(name: str) -> str:
    rule = LISTING_SELECTORS[name]
    host = "https://laodong.vn" if name == "laodong" else ""
    item = _element(rule["item"], f'<a href="{host}/{{link}}">{{text}}</a>')
    return _element(rule["group"], item) if rule["group"] else item


def _listing_template(name: str) -> str:
    root = LISTING_SELECTORS[name]["root"]
    return _element(root, "{items}") if root else "{items}"


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every article as a listing page: a link /<md5 of the line> for each line of its text, which is the link's text."""
    rows = article_columns(spread_documents(spark, sf_dir)).withColumn("item", _by_journal(_listing_item))
    items = F.transform("content", lambda p: _fill(F.col("item"), {"link": F.md5(p), "text": _escape(p)}))
    html = _fill(_by_journal(_listing_template), {"items": F.array_join(items, "")})
    return rows.select("doc_id", "journal", html.alias("html"))


def with_views(body: str, *views: str) -> str:
    """SQL text that defines the views a query uses, then the query."""
    return "WITH " + ",\n".join(views) + "\n" + body
