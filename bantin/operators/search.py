"""Questions a news index answers: terms, histograms, word matches, latest articles, trends."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bantin.functions.columns import as_column, string_array
from bantin.functions.text import tokens


def terms(
    articles: DataFrame, fields: str | Sequence[str], k: int | None = None, ignore_above: int | None = None
) -> DataFrame:
    """Article counts per exact value, most frequent first when `k` is given.

    A list field counts each of its different values once per article. NULL is no value. An index
    that does not keep values longer than `ignore_above` characters does not count them.
    """
    names = [fields] if isinstance(fields, str) else list(fields)
    rows = articles
    for name in names:
        if isinstance(articles.schema[name].dataType, T.ArrayType):
            rows = rows.withColumn(name, F.explode(F.array_distinct(name)))
        rows = rows.where(F.col(name).isNotNull() if ignore_above is None else F.length(name) <= ignore_above)
    counts = rows.groupBy(*names).agg(F.count("*").alias("n"))
    return counts if k is None else counts.orderBy(F.desc("n"), *names).limit(k)


def date_histogram(articles: DataFrame, interval: str = "day", date: str = "date", by: Sequence[str] = ()) -> DataFrame:
    """Article counts per calendar interval; articles without a date are left out."""
    buckets = articles.groupBy(F.date_trunc(interval, date).alias("bucket"), *by)
    # Counting dates and dropping zero counts reads the date once; a filter would read it twice.
    return buckets.agg(F.count(date).alias("n")).where(F.col("n") > 0)


def has_words(text, words: Sequence[str], operator: str = "or") -> Column:
    """Whether the text holds any (`or`) or all (`and`) of the words.

    Only a text that has the letters of the words is split into its own words.
    """
    names = list(dict.fromkeys(w.lower() for w in words))
    wanted = string_array(names)
    lowered, found = F.lower(as_column(text)), tokens(text)
    letters = [F.contains(lowered, F.lit(w)) for w in names]
    if operator == "and":
        return reduce(and_, letters, F.lit(True)) & (F.size(F.array_except(wanted, found)) == 0)
    return reduce(or_, letters, F.lit(False)) & F.arrays_overlap(wanted, found)


def match(articles: DataFrame, field: str, words: Sequence[str], operator: str = "or") -> DataFrame:
    """Articles whose text field (or list of texts) holds the words; there is no ranking."""
    text = F.col(field)
    if isinstance(articles.schema[field].dataType, T.ArrayType):
        text = F.array_join(text, " ")
    return articles.where(has_words(text, words, operator))


def latest(
    articles: DataFrame,
    n: int,
    journal: str | None = None,
    type_: str | None = None,
    date: str = "date",
    key: str = "id",
) -> DataFrame:
    """The n newest articles of a journal and type."""
    found = articles
    if journal is not None:
        found = found.where(F.col("journal") == journal)
    if type_ is not None:
        found = found.where(F.col("type") == type_)
    return found.orderBy(F.desc_nulls_last(date), key).limit(n)


def latest_per(articles: DataFrame, by: str, n: int, date: str = "date", key: str = "id") -> DataFrame:
    """The n newest articles of each group, with `rank`."""
    newest = W.partitionBy(by).orderBy(F.desc_nulls_last(date), key)
    return articles.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= n)


def keyword_trend(articles: DataFrame, keywords: str = "filtered_keywords", month: str = "year_month", k: int | None = None) -> DataFrame:
    """Article counts per month and phrase; with `k` the k most frequent per month, ranked."""
    phrases = articles.select(month, F.explode(F.array_distinct(keywords)).alias("phrase"))
    counts = phrases.groupBy(month, "phrase").agg(F.count("*").alias("n"))
    if k is None:
        return counts
    ranked = W.partitionBy(month).orderBy(F.desc("n"), "phrase")
    return counts.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
