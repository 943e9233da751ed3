"""Small helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and hand it to `body`, however often `body` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def string_array(values: Sequence[str]) -> Column:
    """A constant array of strings, also when `values` is empty."""
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def empty_strings() -> Column:
    return F.array().cast("array<string>")


def case_of(key, branches: Sequence[tuple[Sequence[str], Column]], otherwise: Column | None = None) -> Column:
    """CASE over a key column: the first branch whose names hold the key."""
    key = as_column(key)
    case = None
    for names, value in branches:
        test = key.isin(*names)
        case = F.when(test, value) if case is None else case.when(test, value)
    if case is None:
        return otherwise if otherwise is not None else F.lit(None)
    return case if otherwise is None else case.otherwise(otherwise)
