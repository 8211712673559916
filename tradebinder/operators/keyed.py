"""Newest-row-per-key and keyed upsert, the two building blocks of every load.

Both are one grouped aggregate.  Rows of one key are reduced inside each task before the
shuffle, so a key that holds a third of all rows costs one row per task, and no window
ever gathers a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def newest_values(df: DataFrame, values: list[str], order: str) -> tuple[list[Column], list[Column]]:
    """Aggregates picking ``values`` from the row with the highest ``order`` and the
    projection that unfolds them.

    Fixed-width values are picked one by one, which lets Spark aggregate by hash in
    generated code; as soon as text is involved one struct is cheaper to carry.
    """
    types = {field.name: field.dataType for field in df.schema.fields}
    if all(isinstance(types[name], _FIXED_WIDTH) for name in [*values, order]):
        return [F.max_by(name, order).alias(name) for name in values], [F.col(n) for n in values]
    picked = F.max_by(F.struct(*values), order).alias("_newest")
    return [picked], [F.col(f"_newest.{name}").alias(name) for name in values]


def newest_per_key(df: DataFrame, keys: list[str], order: str, values: list[str] | None = None) -> DataFrame:
    """Last writer wins: the row with the highest order per key.  Orders must be unique
    within a key."""
    if values is None:
        values = [c for c in df.columns if c not in keys]
    aggregates, unfolded = newest_values(df, values, order)
    return df.groupBy(*keys).agg(*aggregates).select(*keys, *unfolded)


def keyed_upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    order: str,
    values: list[str],
    first: list[str] = (),
) -> DataFrame:
    """Upsert as one aggregate over target and batch together.

    ``batch`` and ``target`` both have keys, values and the ``first`` columns; ``batch``
    has in addition a non-negative record order.  Per key the newest batch row gives the
    values (the target row if there is no batch row), and the ``first`` columns keep what
    the oldest row had.  Extra columns tell where the key occurred: in_target, in_batch.
    """
    columns = [*keys, *values, *first]
    old = target.select(*columns, F.lit(-1).cast("long").alias("_order"))
    new = batch.select(*columns, F.col(order).cast("long").alias("_order"))
    both = old.unionByName(new)
    aggregates, unfolded = newest_values(both, list(values), "_order")
    kept = [F.min_by(name, "_order").alias(name) for name in first]
    return (
        both.groupBy(*keys)
        .agg(
            *aggregates,
            *kept,
            F.min("_order").alias("_lowest"),
            F.max("_order").alias("_highest"),
        )
        .select(
            *keys,
            *unfolded,
            *first,
            (F.col("_lowest") < 0).alias("in_target"),
            (F.col("_highest") >= 0).alias("in_batch"),
        )
    )
