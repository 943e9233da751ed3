"""Where each site keeps the parts of an article and the links of a listing page.

A selector reads `tag.class`, `tag#id` or `.class`; `a > b` means the first b below the first a;
`@name` reads an attribute in place of the text. A class with spaces must equal the whole
class attribute; one without may be any of its words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bantin.functions.dom import STEP, step_of

# Selectors of article pages.
ARTICLE_SELECTORS = {
    "baodautu": {
        "title": "div.title-detail",
        "attract": "div.sapo_detail",
        "author": "a.author",
        "date": "span.post-time",
        "body": "div#content_detail_news",
        "tags": "div.tag_detail",
        "tag": "a.tag_detail_item",
        "image": "tbody",
        "image_attribute": "src",
        "caption": "td",
        "required": ["span.post-time", "div#content_detail_news"],
    },
    "vietnamnet": {
        "title": "h1.content-detail-title",
        "attract": "h2.content-detail-sapo",
        "author": None,
        "date": "div.bread-crumb-detail__time",
        "body": "div.main-content",
        "tags": "div.tag-cotnent",
        "tag": "a",
        "image": "figure.image",
        "image_attribute": "src",
        "caption": "figcaption",
        "required": ["div.bread-crumb-detail__time", "div.main-content > p"],
    },
    "vneconomy": {
        "title": "h1.detail__title",
        "attract": "h2.detail__summary",
        "author": "div.detail__author",
        "date": "div.detail__meta",
        "body": "div.detail__content",
        "tags": "div.detail__tag",
        "tag": "a.tag-item",
        "image": "figure",
        "image_attribute": "src",
        "caption": "figcaption",
        "required": ["div.detail__meta", "div.detail__content"],
    },
    "saigontimes": {
        "title": "h1.tdb-title-text",
        "attract": "div.td-post-content > h6",
        "author": "a.tdb-author-name",
        "date": "time@datetime",
        "body": "div.td-post-content",
        "tags": "ul.tdb-tags",
        "tag": "a",
        "image": "figure",
        "image_attribute": "src",
        "caption": "figcaption",
        "required": ["time", "div.td-post-content", "ul.tdb-tags"],
    },
    "diendandoanhnghiep": {
        "title": "h1.title",
        "attract": "div.summary > strong",
        "author": "div.author-time > b",
        "date": "span.published-time",
        "body": "div.description",
        "tags": "div.tags-new",
        "tag": "a",
        "image": "div.image_center_wp",
        "image_attribute": "src",
        "caption": "p.image_caption",
        "required": ["div.summary", "div.author-time", "span.published-time", "div.description"],
    },
    "nhipcaudautu": {
        "title": "h1.post-detail-title",
        "attract": "div.des-small",
        "author": "span.user-post",
        "date": "span.date-post",
        "body": "div.content-detail",
        "tags": "div.post-tags",
        "tag": "b",
        "image": "tbody",
        "image_attribute": "src",
        "caption": "td",
        "required": ["span.date-post", "div.content-detail"],
    },
    "dantri": {
        "title": "h1.title-page detail",
        "attract": "h2.singular-sapo",
        "author": "div.author-name",
        "date": "time.author-time@datetime",
        "body": "div.singular-content",
        "tags": "ul.tags-wrap",
        "tag": "a",
        "image": "figure.image",
        "image_attribute": "data-src",
        "caption": "figcaption",
        "required": ["time.author-time", "div.singular-content"],
    },
    "phapluatdoisong": {
        "title": "h1.title",
        "attract": "h2.sapo",
        "author": None,
        "date": "div.datetime",
        "body": "section.article-content",
        "tags": "ul.tags",
        "tag": "a",
        "image": "figure.image",
        "image_attribute": "src",
        "caption": "figcaption",
        "required": ["div.datetime", "section.article-content"],
    },
    "vtc": {
        "title": "h1.font28 bold lh-1-3",
        "attract": "h2.font18 bold inline-nb",
        "author": "div.author-make",
        "date": "span.time-update mr10 align-super",
        "body": "div.edittor-content",
        "tags": "ul.keylink font13",
        "tag": "a",
        "image": "figure",
        "image_attribute": "data-src",
        "caption": "figcaption",
        "required": ["span.time-update mr10 align-super", "div.edittor-content"],
    },
    "laodong": {
        "title": "article > .title",
        "attract": "article > .chappeau",
        "author": "article > span",
        "date": "article > .time",
        "body": "article",
        "tags": "div.lst-tags",
        "tag": "a",
        "image": "figure.insert-center-image",
        "image_attribute": "src",
        "caption": "figcaption",
        "required": [
            "article", "article > .title", "article > .chappeau", "article > span", "article > .time",
        ],
    },
    "cafef": {
        "title": "h1.title",
        "attract": "h2.sapo",
        "author": "p.author",
        "date": "span.pdate",
        "body": "div.detail-content",
        "tags": "div.tags-detail",
        "tag": "a",
        "image": "figure",
        "image_attribute": "src",
        "caption": "figcaption",
        "required": ["div.detail-content", "div.tags-detail"],
    },
    "cafebiz": {
        "title": "h1.title",
        "attract": "h2.sapo",
        "author": "strong.detail-author",
        "date": "span.time",
        "body": "div.detail-content",
        "tags": "span.tags-item",
        "tag": "a",
        "image": "figure",
        "image_attribute": "src",
        "caption": "figcaption",
        "required": ["div.detail-content", "span.tags-item"],
    },
    "vietstock": {
        "title": "h1.article-title",
        "attract": "p.pHead",
        "author": "p.pAuthor",
        "date": "span.date",
        "body": "div#vst_detail",
        "tags": "div.tags",
        "tag": "a",
        "image": "tbody",
        "image_attribute": "src",
        "caption": "div.pCaption",
        "required": ["div#vst_detail", "div.tags"],
    },
}

# Selectors of listing pages. The first link below each item is taken.
LISTING_SELECTORS = {
    "baodautu": {"root": None, "group": None, "item": "div.desc_list_news_home"},
    "vietnamnet": {"root": "div.main", "group": "div.container", "item": "h3"},
    "vneconomy": {"root": None, "group": None, "item": "header.story__header"},
    "saigontimes": {"root": None, "group": "div.td-module-meta-info", "item": "h3"},
    "diendandoanhnghiep": {"root": "div.list-new-cat", "group": None, "item": "h2.heading"},
    "nhipcaudautu": {
        "root": "div.col-xs-12 col-sm-12 col-md-12 col-lg-12", "group": None, "item": "p.entry-title",
    },
    "dantri": {"root": "div.article list", "group": None, "item": "h3.article-title"},
    "phapluatdoisong": {"root": "section.more-articles", "group": None, "item": "h3.title"},
    "vtc": {"root": None, "group": None, "item": "h3"},
    "laodong": {"root": ".body-content", "group": None, "item": "article"},
    "cafef": {"root": None, "group": None, "item": "h3"},
    "cafebiz": {"root": None, "group": None, "item": ".item"},
    "vietstock": {"root": None, "group": None, "item": "h4"},
}

_PATH = f"struct<outer:{STEP},step:{STEP},attribute:string>"


def _step(text: str):
    if "#" in text:
        tag, name = text.split("#", 1)
        return step_of(tag or None, ident=name)
    tag, _, name = text.partition(".")
    return step_of(tag or None, name or None)


def _path(text: str | None):
    if text is None:
        return None
    text, _, attribute = text.partition("@")
    outer, _, inner = text.rpartition(" > ")
    return (_step(outer) if outer else None, _step(inner), attribute or None)


def article_selectors(spark: SparkSession) -> DataFrame:
    """One row per journal; a fixed dimension, so it may always be broadcast."""
    paths = ["title", "attract", "author", "date", "body", "tags", "tag", "image", "caption"]
    rows = [
        (name, *[_path(s[p]) for p in paths], s["image_attribute"], [(_path(r), r) for r in s["required"]])
        for name, s in ARTICLE_SELECTORS.items()
    ]
    columns = ", ".join(f"{p} {_PATH}" for p in paths)
    return spark.createDataFrame(
        rows,
        f"journal string, {columns}, image_attribute string, "
        f"required array<struct<path:{_PATH},name:string>>",
    )


def listing_selectors(spark: SparkSession) -> DataFrame:
    """One row per journal; a fixed dimension, so it may always be broadcast."""
    rows = [
        (name, *[_step(s[p]) if s[p] else None for p in ("root", "group", "item")])
        for name, s in LISTING_SELECTORS.items()
    ]
    return spark.createDataFrame(rows, f"journal string, root {STEP}, `group` {STEP}, item {STEP}")
