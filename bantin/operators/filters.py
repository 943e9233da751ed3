"""Row filters on article tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bantin.catalogue import DOMAIN_STOP_WORDS, JOURNALS
from bantin.functions.columns import as_column
from bantin.functions.urls import keep_link
from bantin.schema import REQUIRED_COLUMNS


def crawled_since(articles: DataFrame, since, column: str = "crawled") -> DataFrame:
    """Articles crawled strictly after `since`."""
    return articles.where(F.col(column) > (since if isinstance(since, Column) else F.lit(since)))


def only_journals(articles: DataFrame, names: Sequence[str]) -> DataFrame:
    """Articles of the named journals; unknown names are ignored."""
    known = [n for n in names if n in JOURNALS]
    return articles.where(F.col("journal").isin(*known) if known else F.lit(False))


def keep_links(links: DataFrame, href: str = "href", section_url: str | None = None) -> DataFrame:
    """Listing links that the journal's rule takes."""
    return links.where(keep_link("journal", href, section_url))


def with_required_columns(articles: DataFrame, columns: Sequence[str] = tuple(REQUIRED_COLUMNS)) -> DataFrame:
    """Rows whose required columns are all present: file reads do not enforce this."""
    return articles.dropna("any", subset=list(columns))


def without_required_columns(articles: DataFrame, columns: Sequence[str] = tuple(REQUIRED_COLUMNS)) -> DataFrame:
    """The rows `with_required_columns` leaves out."""
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    return articles.where(missing)


def keyword_filter(keywords, min_score: float = 0.5, stop_phrases: Sequence[str] = tuple(DOMAIN_STOP_WORDS)) -> Column:
    """Phrases scored strictly above `min_score` that are not, letter for letter, stop phrases."""
    # The score first, as it is cheap; a membership test, which Spark makes a set of, not a search of an array.
    stop = list(stop_phrases)
    good = F.filter(as_column(keywords), lambda k: (k["score"] > min_score) & ~k["keyword"].isin(stop))
    return F.transform(good, lambda k: k["keyword"])
