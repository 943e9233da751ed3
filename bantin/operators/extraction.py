"""Articles and links out of fetched HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bantin.catalogue import section_catalogue
from bantin.functions import dom
from bantin.functions.columns import case_of
from bantin.functions.dates import clean_date_text
from bantin.functions.text import body_paragraphs, clean_author, clean_tags, clean_text
from bantin.functions.urls import absolute_image_url, absolute_url, article_key, keep_link
from bantin.operators.once import explode_rows, with_computed
from bantin.site_rules import article_selectors, listing_selectors

_NODES = "dom.nodes"

# Sites whose articles may lack a date.
DATE_OPTIONAL = ["cafef", "cafebiz", "vietstock"]


def parse_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace the HTML column by `dom` = struct<text, nodes>."""
    return pages.withColumn("dom", dom.page_nodes(html)).drop(html)


def extract_articles(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per page (journal, url, html): the article fields, or why the page is rejected.

    The page never leaves its row: there is no shuffle, and the selector table is a constant.
    `reject_reason` is NULL for good articles; see `require_nodes`.
    """
    rules = article_selectors(pages.sparkSession).select("journal", F.struct("*").dropFields("journal").alias("rule"))
    found = parse_pages(pages, html).join(F.broadcast(rules), "journal", "left")
    found = found.withColumn("_bytes", F.col("dom.text").cast("binary"))
    fields = ["title", "attract", "author", "date", "body", "tags"]
    found = found.withColumns({f"_{f}": F.expr(dom.find_path(_NODES, f"rule.{f}")) for f in fields})
    found = found.withColumns({
        "_ps": F.expr(f"if(_body is null, null, {dom.find_all(_NODES, tag='p', within='_body')})"),
        "_tag_nodes": F.expr(f"if(_tags is null, null, {dom.find_all(_NODES, 'rule.tag.step', within='_tags')})"),
        "_missing": F.expr(f"get(filter(rule.required, r -> isnull({dom.find_path(_NODES, 'r.path')})), 0).name"),
    })
    signature = dom.find(_NODES, tag="strong", within="p")
    raw = found.withColumns({
        "_paragraphs": _texts("_ps"),
        "_tag_texts": F.coalesce(_texts("_tag_nodes"), F.array().cast("array<string>")),
        "_date_text": F.when(F.expr("rule.date.attribute is not null"), F.col("_date.datetime")).otherwise(_text("_date")),
        "_author_text": case_of(
            "journal",
            [(["phapluatdoisong"], _text(f"get(transform(array(try_element_at(_ps, -2)), p -> {signature}), 0)"))],
            otherwise=_text("_author"),
        ),
    })
    journal = F.col("journal")
    date_text = clean_date_text(journal, F.col("_date_text"))
    reason = (
        F.when(F.col("rule").isNull(), F.lit("unknown journal"))
        .when(F.col("_missing").isNotNull(), F.concat(F.lit("missing "), F.col("_missing")))
        .when(~journal.isin(*DATE_OPTIONAL) & date_text.isNull(), F.lit("no date in text"))
        .when((journal == "phapluatdoisong") & (F.size("_ps") < 2), F.lit("fewer than two paragraphs"))
    )
    kept = [c for c in pages.columns if c not in (html, "journal", "url")]
    columns = {
        "id": article_key("journal", "url"),
        "title": _text("_title"),
        "attract": _text("_attract"),
        "author": clean_author("journal", "_author_text", "_paragraphs"),
        "date_text": date_text,
        "content": body_paragraphs("journal", "_paragraphs"),
        "image": _images(),
        "tags": clean_tags("journal", "_tag_texts"),
        "reject_reason": reason,
    }
    articles = with_computed(raw, columns, ["journal", "url", *kept])
    return articles.select("id", "journal", "url", *kept, *[c for c in columns if c != "id"])


def _text(node: str) -> Column:
    return clean_text(F.expr(dom.node_text("_bytes", node)))


def _texts(nodes: str) -> Column:
    return F.transform(F.expr(f"transform({nodes}, m -> {dom.node_text('_bytes', 'm')})"), lambda t: clean_text(t))


def _images() -> Column:
    """array<struct<url, title>> of the images in the body; image bytes are not fetched.

    A caption in a table is the second cell, otherwise the first node the caption rule finds.
    """
    blocks = dom.find_all(_NODES, "rule.image.step", within="_body")
    captions = dom.find_all(_NODES, "rule.caption.step", within="b")
    caption = f"get({captions}, if(rule.caption.step.tag = 'td', 1, 0))"
    picture = dom.find(_NODES, tag="img", within="b")
    link = f"get(transform(array({picture}), i -> if(rule.image_attribute = 'data-src', i.data_src, i.src)), 0)"
    found = F.expr(
        f"transform(if(_body is null, array(), {blocks}),"
        f" b -> struct({link} as link, {dom.node_text('_bytes', caption)} as caption))"
    )
    return F.transform(
        F.filter(found, lambda i: i["link"].isNotNull()),
        lambda i: F.struct(
            absolute_image_url("journal", i["link"]).alias("url"),
            F.coalesce(clean_text(i["caption"]), F.lit("")).alias("title"),
        ),
    )


def image_refs(articles: DataFrame) -> DataFrame:
    """One row per image of an article."""
    return explode_rows(articles, ["id"], F.col("image"), "image", "pos").select(
        "id", "pos", F.col("image.url").alias("image_url"), F.col("image.title").alias("image_title")
    )


def require_nodes(extracted: DataFrame) -> DataFrame:
    """Articles with every required node."""
    return extracted.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_pages(extracted: DataFrame) -> DataFrame:
    """Pages dropped by `require_nodes`, with the reason."""
    return extracted.where(F.col("reject_reason").isNotNull()).select("journal", "url", "reject_reason")


def extract_links(listings: DataFrame, html: str = "html") -> DataFrame:
    """One row per article link of a listing page (journal, html), in page order.

    Pages of journals without rules are in `rejected_listings`.
    With a `section_url` column the in-section rule of laodong is applied.
    """
    rules = listing_selectors(listings.sparkSession).select(
        "journal", F.struct("*").dropFields("journal").alias("rule")
    )
    found = parse_pages(listings, html).join(F.broadcast(rules), "journal")
    found = found.withColumn("_root", F.expr(dom.find(_NODES, "rule.root")))
    # Of a group (a box per article) sites take every item, or only the first one.
    in_group = dom.find_all(_NODES, "rule.item", within="g")
    of_group = f"if(journal = 'saigontimes', slice({in_group}, 1, 1), {in_group})"

    def in_root(step: str) -> str:
        return f"if(rule.root is null, {dom.find_all(_NODES, step)}, {dom.find_all(_NODES, step, within='_root')})"

    items = (
        f"if(rule.`group` is null, {in_root('rule.item')},"
        f" flatten(transform({in_root('rule.`group`')}, g -> {of_group})))"
    )
    links = F.expr(f"transform({items}, i -> {dom.find(_NODES, tag='a', within='i')}.href)")
    kept = [c for c in listings.columns if c != html]
    section = "section_url" if "section_url" in listings.columns else None
    out = explode_rows(found, kept, links, "href", "pos")
    return out.where(keep_link("journal", "href", section)).select(
        *kept, "pos", absolute_url("journal", "href").alias("link")
    )


def rejected_listings(listings: DataFrame, html: str = "html") -> DataFrame:
    """Listing pages of journals without rules, which `extract_links` cannot read, with the reason."""
    known = listing_selectors(listings.sparkSession).select("journal")
    reason = F.concat(F.lit("no rules for "), F.coalesce("journal", F.lit("NULL")))
    return listings.drop(html).join(F.broadcast(known), "journal", "left_anti").withColumn("reject_reason", reason)


def page_links(pages: DataFrame, container: str = "nav", html: str = "html") -> DataFrame:
    """One row per link below the first `container` tag of any page."""
    box = dom.find(_NODES, tag=container)
    parsed = parse_pages(pages, html).withColumn("_box", F.expr(box))
    anchors = dom.find_all(_NODES, tag="a", within="_box")
    links = F.expr(f"filter(transform({anchors}, a -> a.href), h -> h is not null and h <> '')")
    kept = [c for c in pages.columns if c != html]
    return explode_rows(parsed, kept, links, "href", "pos")


def label_sections(articles: DataFrame) -> DataFrame:
    """Set `type` by (journal, section_url), NULL where the section is not known.

    The section catalogue is a fixed small table.
    """
    sections = section_catalogue(articles.sparkSession)
    return articles.drop("type").join(F.broadcast(sections), ["journal", "section_url"], "left")
