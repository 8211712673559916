"""Connected groups of a graph that is never gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradebinder.llm.common import stored
from tradebinder.operators.lookup import spread_join


def connected_components(links: DataFrame) -> DataFrame:
    """node and root (smallest node of its group) of every node that has a link.

    ``links`` has columns a and b (long).  Every round points the larger neighbours of a node,
    then all of its smaller neighbours, at the smallest of them; the number of rounds grows
    with the logarithm of the group size.  Minima are combined before the shuffle and hubs are
    spread over salts.  Each round is a written table.  Null ends and loops are ignored.
    """
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    usable = F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    star = stored(links.where(usable).select(high, low).distinct())
    seen = None
    while True:
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = spread_join(both, nearest, ["u"], "inner", ["v"]).where("v > u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = stored(small.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct())
        state = star.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            break
        seen = state
    ends = star.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return ends.unionByName(star.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def joined_components(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``connected_components`` of the links behind ``roots`` and more ``links``, from the groups that are known.

    Only the roots are joined; the smallest node of a joined group is the smallest of its roots.
    """
    ends = stored(links)
    for end in ("a", "b"):
        known = roots.select(F.col("node").alias(end), F.col("root").alias("_root"))
        ends = spread_join(ends, known, [end], "left", ["a", "b"]).withColumn(end, F.coalesce("_root", end)).drop("_root")
    above = connected_components(ends).withColumnRenamed("root", "top")
    own = spread_join(roots, above.withColumnRenamed("node", "root"), ["root"], "left", ["node"]).select("node", F.coalesce("top", "root").alias("root"))
    alone = above.join(roots.select("node"), "node", "left_anti").select("node", F.col("top").alias("root"))
    return own.unionByName(alone)
