"""A lookup join that stays even when a few keys hold much of the big side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# At most this many keys can each hold more than 1/HOT_KEYS of the rows, so the broadcast
# table of hot keys below never exceeds this many rows, whatever the data.
HOT_KEYS = 5_000
_SALTS = 256


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    key: str,
    count_column: str | None = None,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Left join of `big` with `lookup`, which holds each key at most once.

    Keys with more than 1/hot_keys of all rows are answered from a broadcast table (there
    can be no more than `hot_keys` of them); their rows are then spread over the shuffle by
    a salt that matches nothing. All other keys go through an ordinary shuffle join.
    `count_column` names a lookup column that already holds the number of rows per key; keys
    the lookup lacks then count as rare. Without it the rows are counted here.

    AQE alone is not enough here: it splits a skewed join partition only when both join
    inputs are plain shuffles, and a lookup made by groupBy has an aggregate in between.
    """
    values = [c for c in lookup.columns if c != key]
    if count_column is not None:
        counted, n = lookup, F.col(count_column)
    else:
        counted, n = big.groupBy(key).agg(F.count("*").alias("_n")), F.col("_n")
    total = counted.agg(F.coalesce(F.sum(n), F.lit(0)).alias("total")).scalar()
    hot = counted.where(n * F.lit(hot_keys) > total)
    if count_column is None:
        # Hot keys the lookup lacks are kept as well: their rows must be spread too.
        hot = hot.select(key).join(lookup, key, "left")
    hot_values = hot.select(F.col(key).alias("_hot_key"), F.struct(*values).alias("_hot"))
    marked = big.join(F.broadcast(hot_values), F.col(key).eqNullSafe(F.col("_hot_key")), "left")
    is_hot = F.col("_hot").isNotNull()
    spread = F.when(is_hot, F.lit(1) + F.pmod(F.spark_partition_id(), F.lit(_SALTS))).otherwise(F.lit(0))
    # Always 0, but not a constant to the optimizer: the salt must stay part of the join key.
    no_salt = F.pmod(F.hash(F.col(key)), F.lit(1))
    cold_values = lookup.select(F.col(key), no_salt.alias("_salt"), F.struct(*values).alias("_cold"))
    # A lookup made from exploded text is far larger than Spark's estimate, which goes by file
    # size: without the hint it could be broadcast whole.
    joined = marked.withColumn("_salt", spread).join(cold_values.hint("merge"), [key, "_salt"], "left")
    found = F.coalesce(F.col("_hot"), F.col("_cold"))
    return joined.select(*big.columns, *[found[v].alias(v) for v in values])
