"""Costly expressions, computed once per row.

Catalyst pushes filters below projections by copying the expression they test, and infers a
size filter for every exploded array. For a cheap column that is welcome; for a parsed message
or a page it doubles the work. A generator is a border such copies do not cross.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, columns: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """The kept columns (default all) and the given ones; later filters do not recompute these."""
    kept = df.columns if keep is None else keep
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*kept, F.inline_outer(F.array(row)).alias(*columns))


def explode_rows(df: DataFrame, keep: list[str], array: Column, item: str, pos: str | None = None) -> DataFrame:
    """One row per array item (with its position); no row for an empty or NULL array."""
    place = pos or "_pos"
    rows = df.select(*keep, F.posexplode_outer(array).alias(place, item)).where(F.col(place).isNotNull())
    return rows if pos else rows.drop(place)
