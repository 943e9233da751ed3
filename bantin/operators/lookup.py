"""Finding and deleting documents of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _as_keys(table: DataFrame, keys, key: str) -> DataFrame:
    if isinstance(keys, DataFrame):
        return keys.select(key).distinct()
    field = T.StructField(key, table.schema[key].dataType)
    return table.sparkSession.createDataFrame([(k,) for k in dict.fromkeys(keys)], T.StructType([field]))


def find(
    table: DataFrame,
    keys: DataFrame | Sequence[str] | None = None,
    condition: Column | None = None,
    projection: Sequence[str] | None = None,
    key: str = "id",
    condition_names_key: bool = False,
) -> DataFrame:
    """Documents whose key is listed and that meet the condition.

    No keys (None or an empty list) means no key filter. A condition that itself names the
    key column replaces the key list (`condition_names_key`). The key column is always kept.
    Listed keys have the type of the key column and are joined: Spark broadcasts it when its measured size allows, else shuffles.
    """
    found = table
    no_keys = keys is None or (not isinstance(keys, DataFrame) and len(keys) == 0)
    if not no_keys and not condition_names_key:
        found = found.join(_as_keys(table, keys, key), key, "left_semi")
    if condition is not None:
        found = found.where(condition)
    if projection:
        found = found.select(key, *[c for c in projection if c != key])
    return found


def find_one(
    table: DataFrame,
    key_value: str | None = None,
    condition: Column | None = None,
    projection: Sequence[str] | None = None,
    key: str = "id",
) -> DataFrame:
    """One such document at most; the one with the smallest key, so the answer is stable."""
    if key_value:
        table = table.where(F.col(key) == F.lit(key_value))
    return find(table, None, condition, projection, key).orderBy(key).limit(1)


def find_in(
    spark: SparkSession,
    database: str,
    collection: str,
    keys: DataFrame | Sequence[str] | None = None,
    condition: Column | None = None,
    projection: Sequence[str] | None = None,
    key: str = "id",
) -> DataFrame:
    """`find` in any database: a folder of Parquet collections, or a catalog database."""
    if "/" in database:
        table = spark.read.parquet(f"{database.rstrip('/')}/{collection}")
    else:
        table = spark.table(f"{database}.{collection}")
    return find(table, keys, condition, projection, key)


def delete_by_keys(table: DataFrame, keys: DataFrame | Sequence[str], key: str = "id") -> DataFrame:
    """What is left after deleting the listed keys."""
    if not isinstance(keys, DataFrame) and len(keys) == 0:
        return table
    return table.join(_as_keys(table, keys, key), key, "left_anti")


def delete_where(table: DataFrame, condition: Column) -> DataFrame:
    """What is left after deleting the rows where the condition is true; NULL is not true."""
    return table.where(~F.coalesce(condition, F.lit(False)))
