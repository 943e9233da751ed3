"""Nested documents to dotted columns and back."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bantin.functions.documents import drop_nulls_deep


Reach = Callable[[Column], Column]


def _field_of(reach: Reach, name: str) -> Reach:
    return lambda v: reach(v).getField(name)


def _last_of(reach: Reach, item_reach: Reach) -> Reach:
    return lambda v: F.try_element_at(
        F.filter(F.transform(reach(v), lambda x: item_reach(x)), lambda x: x.isNotNull()), F.lit(-1)
    )


def _leaves(name: str, reach: Reach, dtype: T.DataType) -> Iterator[tuple[str, Reach]]:
    """(dotted name, how to reach it from the outer value) of every leaf."""
    if isinstance(dtype, T.StructType):
        for field in dtype.fields:
            yield from _leaves(f"{name}.{field.name}", _field_of(reach, field.name), field.dataType)
    elif isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        # A list of documents: per sub-field the last document that has it wins.
        for leaf, item_reach in _leaves(name, lambda x: x, dtype.elementType):
            yield leaf, _last_of(reach, item_reach)
    elif isinstance(dtype, T.ArrayType):
        # An empty list leaves no trace.
        yield name, lambda v: F.when(F.size(reach(v)) > 0, reach(v))
    else:
        yield name, reach


def flatten(df: DataFrame) -> DataFrame:
    """Structs become dotted columns; lists of structs keep, per sub-field, their last value."""
    columns = []
    for field in df.schema.fields:
        for name, reach in _leaves(field.name, lambda v: v, field.dataType):
            columns.append(reach(F.col(f"`{field.name}`")).alias(name))
    return df.select(*columns)


def unflatten(df: DataFrame) -> DataFrame:
    """Dotted columns become nested structs, in order of first appearance."""
    tree: dict = {}
    for name in df.columns:
        *parents, leaf = name.split(".")
        node = tree
        for parent in parents:
            node = node.setdefault(parent, {})
        node[leaf] = name

    def build(node) -> Column:
        if isinstance(node, str):
            return F.col(f"`{node}`")
        return F.struct(*[build(child).alias(k) for k, child in node.items()])

    return df.select(*[build(node).alias(k) for k, node in tree.items()])


def compact_json(df: DataFrame, column: str = "doc") -> DataFrame:
    """Each row as one JSON document without NULL fields at any depth; NULL list items stay."""
    fields = [drop_nulls_deep(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*fields)).alias(column))
