"""Schemas of the article record and its messages."""

from __future__ import annotations

from pyspark.sql import types as T

_IMAGE = T.ArrayType(
    T.StructType([T.StructField("url", T.StringType()), T.StructField("title", T.StringType())])
)

# The article table.
ARTICLE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("journal", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("attract", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("date", T.TimestampType()),
    T.StructField("content", T.ArrayType(T.StringType())),
    T.StructField("image", _IMAGE),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("url", T.StringType()),
    T.StructField("crawled", T.TimestampType()),
])

# The raw JSON message: the date is still text, `crawled` is not stamped yet.
RAW_MESSAGE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("journal", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("attract", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("content", T.ArrayType(T.StringType())),
    T.StructField("image", _IMAGE),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("url", T.StringType()),
])

# The stored document: keyed by `_id`, date as text.
STORED_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("journal", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("attract", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("content", T.ArrayType(T.StringType())),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("crawled", T.TimestampType()),
])

# Column order of the index record; `image`, `url` and `crawled` stay out.
INDEX_COLUMNS = ["id", "title", "type", "journal", "attract", "author", "date", "content", "tags"]

# Columns an article may not lack.
REQUIRED_COLUMNS = ["id", "journal", "type", "title"]

KEYWORDS_TYPE = "array<struct<keyword:string,score:double>>"
