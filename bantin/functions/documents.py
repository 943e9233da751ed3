"""List, map and nested-document functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bantin.functions.columns import as_column, string_array

IMAGES = "array<struct<url:string,title:string>>"


def split_list_string(text) -> Column:
    """Read a list written as `[a, b]`. Lossy: kept for old messages; typed arrays are the main way."""
    return F.split(F.regexp_replace(as_column(text), r"(^\[)|(\]$)", ""), ", ")


def parse_image_list(text) -> Column:
    """Images from real JSON, or from map text such as `[{url=a, title=b}]`; NULL otherwise."""
    raw = as_column(text)
    from_map_text = F.transform(
        F.regexp_extract_all(raw, F.lit(r"\{(url=.*?, title=.*?)\}(?=, \{|\]$)"), F.lit(1)),
        lambda one: F.struct(
            F.regexp_extract(one, "^url=(.*?), title=", 1).alias("url"),
            F.regexp_extract(one, "^url=.*?, title=(.*)$", 1).alias("title"),
        ),
    )
    return F.when(raw.startswith("[{url="), from_map_text).otherwise(F.from_json(raw, IMAGES))


def drop_null_entries(mapping) -> Column:
    return F.map_filter(as_column(mapping), lambda _, v: v.isNotNull())


def keep_keys(mapping, keys: list[str] | None) -> Column:
    """Entries whose key is listed; `None` keeps the map as it is."""
    if keys is None:
        return as_column(mapping)
    wanted = string_array(keys)
    return F.map_filter(as_column(mapping), lambda k, _: F.array_contains(wanted, k))


def add_maps(first, second) -> Column:
    """Value sums over the keys of `first`; a key missing in `second` is an error."""
    a, b = as_column(first), as_column(second)
    return F.transform_values(
        a,
        lambda k, v: v + F.when(F.map_contains_key(b, k), F.try_element_at(b, k)).otherwise(
            F.raise_error(F.concat(F.lit("key missing in second map: "), k.cast("string"))).cast("double")
        ),
    )


def _is_document_list(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)


def drop_nulls_deep(value: Column, dtype: T.DataType) -> Column:
    """Drop NULL map entries at every depth, following structs and lists of structs.

    NULL struct fields need no work: JSON output leaves them out. NULL list items stay.
    """
    if isinstance(dtype, T.MapType):
        kept = F.map_filter(value, lambda _, v: v.isNotNull())
        if isinstance(dtype.valueType, (T.StructType, T.MapType)) or _is_document_list(dtype.valueType):
            return F.transform_values(kept, lambda _, v: drop_nulls_deep(v, dtype.valueType))
        return kept
    if isinstance(dtype, T.StructType):
        fields = [drop_nulls_deep(value.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if _is_document_list(dtype):
        return F.transform(value, lambda x: drop_nulls_deep(x, dtype.elementType))
    return value


def truthy(value: Column, dtype: T.DataType) -> Column:
    """Whether a list item counts: not NULL, empty, zero or false."""
    if isinstance(dtype, T.StringType):
        return value.isNotNull() & (value != "")
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(value, F.lit(False))
    if isinstance(dtype, T.NumericType):
        return value.isNotNull() & (value != 0)
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return value.isNotNull() & (F.size(value) > 0)
    return value.isNotNull()
