"""Messages: decode, pick fields, project, encode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bantin.functions.columns import as_column
from bantin.functions.documents import split_list_string
from bantin.operators.once import with_computed
from bantin.schema import INDEX_COLUMNS, RAW_MESSAGE_SCHEMA

_CORRUPT = "_corrupt_record"


def decode_payload(messages: DataFrame, schema: T.StructType = RAW_MESSAGE_SCHEMA, value: str = "value") -> DataFrame:
    """JSON messages to columns; a broken message becomes a row with `_corrupt_record` set.

    Payloads are data only. Serialised Python objects are never loaded: that would run them.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    body = F.from_json(
        F.col(value).cast("string"), with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    kept = [c for c in messages.columns if c != value]
    decoded = with_computed(messages, {"_body": body}, kept)
    return decoded.select(*kept, "_body.*")


def good_messages(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(_CORRUPT).isNull()).drop(_CORRUPT)


def bad_messages(decoded: DataFrame) -> DataFrame:
    """The quarantine: broken messages as they came."""
    kept = [c for c in decoded.columns if c not in RAW_MESSAGE_SCHEMA.fieldNames()]
    return decoded.where(F.col(_CORRUPT).isNotNull()).select(*kept)


def decode_map(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON messages to a map<string,string> column `map`."""
    return messages.withColumn("map", F.from_json(F.col(value).cast("string"), "map<string,string>"))


def extract_fields(mapped: DataFrame, keys: Sequence[str], column: str = "map") -> DataFrame:
    """One column per key; a missing key is NULL."""
    kept = [c for c in mapped.columns if c != column]
    return mapped.select(*kept, *[F.try_element_at(F.col(column), F.lit(k)).alias(k) for k in keys])


def split_list_columns(articles: DataFrame, columns: Sequence[str] = ("content", "tags")) -> DataFrame:
    """Lists that came as `[a, b]` text."""
    return articles.withColumns({c: split_list_string(c) for c in columns})


def project_article(articles: DataFrame) -> DataFrame:
    """The index record: fixed column order, no images."""
    return articles.select(*INDEX_COLUMNS)


def to_store_key(articles: DataFrame) -> DataFrame:
    return articles.withColumnRenamed("id", "_id")


def to_index_key(articles: DataFrame) -> DataFrame:
    return articles.withColumnRenamed("_id", "id")


def stamp_ingest(articles: DataFrame, column: str = "crawled") -> DataFrame:
    """The time of ingest: one value per batch or micro-batch."""
    return articles.withColumn(column, F.current_timestamp())


def encode_messages(articles: DataFrame, key: str = "id", topic: Column | str | None = None) -> DataFrame:
    """Rows as queue records: key, JSON value and, when given, the topic."""
    columns = [F.col(key).cast("string").alias("key"), F.to_json(F.struct(*articles.columns)).alias("value")]
    if topic is not None:
        columns.append(as_column(topic).alias("topic"))
    return articles.select(*columns)
