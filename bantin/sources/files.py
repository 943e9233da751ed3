"""Batch readers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bantin.operators.nested import flatten
from bantin.schema import RAW_MESSAGE_SCHEMA, STORED_SCHEMA
from bantin.sources.arrays import read_record_arrays


def read_articles_json(
    spark: SparkSession, path: str, schema: T.StructType = RAW_MESSAGE_SCHEMA, one_per_file: bool = True
) -> DataFrame:
    """Article files with a fixed schema; unknown keys are ignored, missing ones are NULL.

    With `one_per_file` a file holds one object over many lines, and one task reads a whole
    file; line-delimited files (`one_per_file=False`) can be split between tasks.
    """
    return spark.read.schema(schema).option("multiLine", one_per_file).json(path)


def read_collection(
    spark: SparkSession, root: str, journal: str | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Stored articles: a Parquet table partitioned by journal; one journal reads one partition."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    table = reader.parquet(root)
    return table if journal is None else table.where(F.col("journal") == journal)


def load_records(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON arrays of nested records as flat rows with dotted column names; many tasks read one array."""
    return flatten(read_record_arrays(spark, path, schema))


def split_csv_payload(messages: DataFrame, schema: T.StructType = STORED_SCHEMA, value: str = "value", list_sep: str = ";") -> DataFrame:
    """Comma-separated messages to typed columns by position; list fields are split on `list_sep`.

    Text that does not fit its type, and fields past the end of the message, become NULL.
    """
    parts = F.split(F.col(value).cast("string"), ",")

    def field(i: int, dtype: T.DataType) -> Column:
        raw = F.get(parts, F.lit(i))
        if isinstance(dtype, T.ArrayType):
            return F.split(raw, re.escape(list_sep)).cast(dtype)
        return raw if isinstance(dtype, T.StringType) else raw.try_cast(dtype)

    return messages.select(*[field(i, f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def result_name(input_name: str, suffix: str) -> str:
    """`news.json` and `_keywords` give `news_keywords.json`."""
    return input_name.removesuffix(".json") + suffix + ".json"
