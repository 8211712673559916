"""Joining a large, possibly skewed side to a table that is unique on the key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 4


def by_shuffle(table: DataFrame) -> DataFrame:
    """The table as one side of a merge join, never broadcast from an estimated size."""
    return table.hint("merge")


def spread_join(
    facts: DataFrame, table: DataFrame, keys: list[str], how: str, spread_by: list[str], salts: int = SALTS
) -> DataFrame:
    """facts JOIN table, with every key of the facts spread over ``salts`` partitions.

    One product, expansion or name may hold a third of the facts.  The facts get a salt
    from a hash of their row id (the same on every retry), and the lookup table, unique on
    the keys, is repeated once per salt.  Null keys of an outer join are spread the same
    way.  The salt is part of the join key, so both inputs are plain shuffles even when the
    lookup table is an aggregate on the key; only then can adaptive execution split a
    partition that is still too large, however large it is.

    The join is always a merge join.  Spark judges a table by its compressed files and does
    not count the copies, so a lookup table estimated at some MB can be hundreds of MB once
    the driver has collected it for a broadcast; callers that know a table to be small
    broadcast it themselves.
    """
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(by_shuffle(copies), [*keys, "_salt"], how).drop("_salt")
