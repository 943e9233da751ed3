"""Keyed tables: fold repeated updates, then merge them into the stored documents.

Every table here holds each key once. Updates that may repeat a key go through
`fold_updates` first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bantin.functions.documents import truthy
from bantin.sources.workspace import materialise

CLEARED = "_cleared"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def classify_update(updates: DataFrame, key: str | Sequence[str] = "id") -> DataFrame:
    """What each update does: the fields it unsets, the scalars it sets, the list items it adds."""
    keys = _keys(key)
    fields = [f for f in updates.schema.fields if f.name not in keys]
    lists = [f for f in fields if isinstance(f.dataType, T.ArrayType)]
    scalars = [f for f in fields if f not in lists]
    nulls = F.array(*[F.when(F.col(f.name).isNull(), F.lit(f.name)) for f in fields]).cast("array<string>")
    return updates.select(
        *keys,
        F.array_compact(nulls).alias("unset"),
        F.struct(*[F.col(f.name) for f in scalars]).alias("set"),
        F.struct(*[_items(F.col(f.name), f.dataType).alias(f.name) for f in lists]).alias("add_to_set"),
    )


def _items(values: Column, dtype: T.ArrayType) -> Column:
    return F.filter(values, lambda x: truthy(x, dtype.elementType))


def _add_to_set(stored: Column, given: Column, dtype: T.ArrayType) -> Column:
    """Stored items first, repeats kept; then each new item once, in order."""
    held = F.coalesce(stored, F.array().cast(dtype))
    return F.concat(held, F.array_except(_items(given, dtype), held))


def _stored(c: str) -> Column:
    return F.col(f"`_t_{c}`")


def _given(c: str) -> Column:
    return F.col(f"`_u_{c}`")


def _join_updates(
    target: DataFrame, updates: DataFrame, keys: list[str], merged: dict[str, Column], rewrite: bool, places: dict[str, Column] | None = None
) -> DataFrame:
    """`merged` per stored row (left join), plus the updates whose key is not stored yet.

    With `places`, columns made of the key, both sides meet in one shuffle by these and the result is left
    there, with them: rows that are written by place need no shuffle of their own.

    A left join, not a full outer join: Spark can broadcast small updates and leave the
    stored table where it is. Only the key columns of the stored table are read twice, but
    the updates three times; `rewrite` shuffles both sides and reads each once.
    """
    u_cols = [c for c in updates.columns if c not in keys]
    t_cols = [c for c in target.columns if c not in keys]
    given = updates.select(*keys, F.lit(True).alias("_is_given"), *[F.col(f"`{c}`").alias(f"_u_{c}") for c in u_cols])
    stored = target.select(*keys, *[F.col(f"`{c}`").alias(f"_t_{c}") for c in t_cols])
    columns = [*target.columns, *[c for c in u_cols if c not in t_cols and c != CLEARED]]
    result = [F.col(c) if c in keys else merged[c].alias(c) for c in columns]
    if places:
        return _met(stored, given, keys, places).select(*result, *places)
    if rewrite:
        return stored.join(given, keys, "full_outer").select(*result)
    both = stored.join(given, keys, "left")
    stored_keys = updates.select(*keys).join(target.select(*keys), keys, "left_semi")
    nothing_stored = [F.lit(None).cast(target.schema[c].dataType).alias(f"_t_{c}") for c in t_cols]
    new = given.join(stored_keys, keys, "left_anti").select("*", *nothing_stored)
    return both.unionByName(new).select(*result)


def _met(stored: DataFrame, given: DataFrame, keys: list[str], places: dict[str, Column]) -> DataFrame:
    """A full outer join by the key, of sides that have each key once, dealt by `places`.

    Spark would shuffle both sides of a join again by the whole key, so this is a grouping. Rows
    with a NULL in the key may be many and meet no row, as in a join.
    """
    sides = []
    no_key = F.expr(" or ".join(f"`{k}` is null" for k in keys))
    for name, side in (("_t", stored), ("_u", given)):
        rest = F.struct(*[F.col(f"`{c}`") for c in side.columns if c not in keys])
        alone = F.when(no_key, F.concat(F.lit(name), F.monotonically_increasing_id().cast("string")))
        sides.append(side.select(*keys, alone.alias("_alone"), rest.alias(name)))
    both = sides[0].unionByName(sides[1], allowMissingColumns=True).withColumns(places).repartition(*places)
    found = both.groupBy(*places, *keys, "_alone").agg(F.first("_t", True).alias("_t"), F.first("_u", True).alias("_u"))
    return found.select(*places, *keys, "_t.*", "_u.*")


def upsert_merge(
    target: DataFrame,
    updates: DataFrame,
    key: str | Sequence[str] = "id",
    unset_nulls: bool = True,
    rewrite: bool = True,
    replace: Sequence[str] = (),
    places: dict[str, Column] | None = None,
) -> DataFrame:
    """Merge updates into the table: scalars are set, lists gain new items, NULLs unset.

    Lists named in `replace` are set whole, like scalars.

    A typed row cannot tell NULL from missing; with `unset_nulls=False` a NULL means missing
    and leaves the stored value. New keys are inserted, new columns are added. Each side is read
    once and shuffled. `rewrite=False` is for small, cheap updates of a large table: it reads them three
    times, but can broadcast them and leave the table where it is. `places` as in `_join_updates`.
    """
    keys = _keys(key)
    types = {f.name: f.dataType for f in [*updates.schema.fields, *target.schema.fields]}
    given = F.col("_is_given").isNotNull()
    has_cleared = CLEARED in updates.columns
    merged: dict[str, Column] = {}
    for c in dict.fromkeys([*target.columns, *updates.columns]):
        if c in keys or c == CLEARED:
            continue
        stored = _stored(c) if c in target.columns else F.lit(None).cast(types[c])
        if c not in updates.columns:
            merged[c] = stored
            continue
        new = _given(c)
        on_null = F.lit(None).cast(types[c]) if unset_nulls else stored
        if isinstance(types[c], T.ArrayType) and c not in replace:
            base = stored
            if has_cleared:
                base = F.when(~F.array_contains(_given(CLEARED), c), stored)
            value = (
                F.when(new.isNull(), on_null)
                .when(F.size(new) == 0, stored)
                .otherwise(_add_to_set(base, new, types[c]))
            )
        else:
            value = F.when(new.isNull(), on_null).otherwise(new)
        merged[c] = F.when(given, value).otherwise(stored)
    return _join_updates(target, updates, keys, merged, rewrite, places)


def upsert_replace(
    target: DataFrame, updates: DataFrame, key: str | Sequence[str] = "id", merge: bool = False, keep_none: bool = False, rewrite: bool = False
) -> DataFrame:
    """Every column the updates name is overwritten whole, lists and structs too.

    With `keep_none` NULLs are stored, without it the field is unset; in a typed table both
    read as NULL. Merging and keeping NULLs at once has no meaning and is refused. `rewrite` as in `upsert_merge`.
    """
    if merge and keep_none:
        raise ValueError("merge=True with keep_none=True would write nothing")
    if merge:
        return upsert_merge(target, updates, key)
    return _overwrite(target, updates, _keys(key), null_is_missing=False, rewrite=rewrite)


def upsert_shallow(target: DataFrame, updates: DataFrame, key: str | Sequence[str] = "id", null_is_missing: bool = True) -> DataFrame:
    """Top-level overwrite of the fields a document names; fields it does not name stay.

    A NULL counts as not named unless `null_is_missing=False`.
    """
    return _overwrite(target, updates, _keys(key), null_is_missing)


def _overwrite(target: DataFrame, updates: DataFrame, keys: list[str], null_is_missing: bool, rewrite: bool = False) -> DataFrame:
    types = {f.name: f.dataType for f in [*updates.schema.fields, *target.schema.fields]}
    merged = {}
    for c in dict.fromkeys([*target.columns, *updates.columns]):
        if c in keys:
            continue
        stored = _stored(c) if c in target.columns else F.lit(None).cast(types[c])
        if c not in updates.columns:
            merged[c] = stored
            continue
        new = _given(c)
        value = F.coalesce(new, stored) if null_is_missing else new
        merged[c] = F.when(F.col("_is_given").isNotNull(), value).otherwise(stored)
    return _join_updates(target, updates, keys, merged, rewrite)


def keep_last(rows: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key; ties are settled by the row itself, so retries agree.

    A maximum, not a window: each task first reduces its own copies of a hot key to one row.
    """
    keys = _keys(key)
    rest = [c for c in rows.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_last")
    return rows.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col("_last")[c].alias(c) for c in rows.columns]
    )


def fold_alone(updates: DataFrame, key: str | Sequence[str], order: Sequence[str], unset_nulls: bool = True, replace: Sequence[str] = ()) -> DataFrame:
    """`fold_updates` for updates that have each key once: every row is folded where it is."""
    keys = _keys(key)
    lists = [f.name for f in updates.schema.fields if isinstance(f.dataType, T.ArrayType) and f.name not in (*keys, *order, *replace)]
    gone = {c: F.col(c).isNull() if unset_nulls else F.lit(False) for c in lists}
    cleared = F.array(*[F.when(gone[c], F.lit(c)) for c in lists]).cast("array<string>")
    nothing = {c: F.lit(None) if unset_nulls else F.array() for c in lists}
    folded = {c: F.coalesce(F.array_distinct(c), nothing[c].cast(updates.schema[c].dataType)) for c in lists}
    return updates.select(*[folded[c].alias(c) if c in folded else F.col(c) for c in updates.columns], F.array_compact(cleared).alias(CLEARED))


def fold_updates(
    updates: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    unset_nulls: bool = True,
    replace: Sequence[str] = (),
) -> DataFrame:
    """One update per key with the effect of applying all of them in `order`.

    Scalars: the last one wins (the last non-NULL one with `unset_nulls=False`). Lists: the
    items in order of first arrival; an update that unsets a list drops the items before it
    and names the list in `_cleared`. Lists named in `replace` count as scalars. All groups are reduced in parts before the shuffle:
    lists are aggregated by (key, item), so a hot key is spread by its items. Whole updates are shuffled once; what the
    items are held against is a narrow table. The updates are read for each list and once or twice more.
    """
    keys = _keys(key)
    fields = [f for f in updates.schema.fields if f.name not in keys and f.name not in order]
    lists = [f.name for f in fields if isinstance(f.dataType, T.ArrayType) and f.name not in replace]
    scalars = [f.name for f in fields if f.name not in lists]
    arrival = F.struct(*[F.col(o) for o in order])

    aggregates = [F.max(arrival).alias("_arrival")]
    if scalars and unset_nulls:
        aggregates.append(F.max(F.struct(arrival.alias("at"), *scalars)).alias("_scalars"))
    elif scalars:
        aggregates += [
            F.max(F.when(F.col(s).isNotNull(), F.struct(arrival.alias("at"), F.col(s)))).alias(f"_s_{s}")
            for s in scalars
        ]
    packed = F.struct(*keys)
    cleared_at = []
    for name in lists:
        gone = F.col(name).isNull() if unset_nulls else F.lit(False)
        cleared_at.append(F.max(F.when(gone, arrival)).alias(f"_unset_{name}"))
    if lists and unset_nulls:
        # Read by the items. Stored, Spark knows its size: it is broadcast if small, else a hot key's join is split.
        unsets = materialise(updates.where(" or ".join(f"`{n}` is null" for n in lists)).groupBy(packed.alias("_key")).agg(*cleared_at))
    folded = updates.groupBy(packed.alias("_key")).agg(*aggregates, *cleared_at)

    for name in lists:
        items = updates.where(F.size(name) > 0).select(
            *keys, arrival.alias("_at"), F.posexplode(name).alias("_pos", "_item")
        )
        if unset_nulls:
            unset = unsets.where(F.col(f"_unset_{name}").isNotNull()).select("_key", F.col(f"_unset_{name}").alias("_unset"))
            items = items.join(unset, packed == F.col("_key"), "left")
            items = items.where(F.col("_unset").isNull() | (F.col("_at") > F.col("_unset"))).drop("_key", "_unset")
        first = items.groupBy(*keys, "_item").agg(F.min(F.struct("_at", "_pos")).alias("_first"))
        ordered = first.groupBy(packed.alias("_key")).agg(
            F.sort_array(F.collect_list(F.struct("_first", "_item"))).alias("_items")
        )
        column = F.transform("_items", lambda x: x["_item"]).alias(f"_l_{name}")
        # By the key that both sides are grouped by: neither is shuffled again.
        folded = folded.join(ordered.select("_key", column), "_key", "left")

    columns = []
    for c in updates.columns:
        if c in keys:
            columns.append(F.col("_key")[c].alias(c))
        elif c in order:
            columns.append(F.col("_arrival")[c].alias(c))
        elif c in scalars:
            columns.append((F.col("_scalars")[c] if unset_nulls else F.col(f"_s_{c}")[c]).alias(c))
        else:
            dtype = updates.schema[c].dataType
            columns.append(
                F.when(F.col(f"_l_{c}").isNotNull(), F.col(f"_l_{c}"))
                .when(F.col(f"_unset_{c}").isNull(), F.array().cast(dtype))
                .alias(c)
            )
    cleared = F.array(*[F.when(F.col(f"_unset_{c}").isNotNull(), F.lit(c)) for c in lists]).cast("array<string>")
    return folded.select(*columns, F.array_compact(cleared).alias(CLEARED))

