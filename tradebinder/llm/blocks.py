"""Meeting places for 64-bit fingerprints that differ in few bits.

The 64 bits are cut into b blocks.  Two fingerprints that differ in at most r bits agree in at
least b - r whole blocks, so one of the choices of b - r blocks gives both the same key.  A
key that more rows share than ``chunk`` is dealt over chunks; every pair of its chunks is a
cell of its own, so no cell holds more than about two chunks and no pair of rows is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradebinder.llm.common import BROADCAST_ROWS, partitions, stored
from tradebinder.operators.lookup import spread_join

CELL = ["choice", "part", "i", "j"]


def masks(radius: int, blocks: int) -> list[int]:
    """One signed 64-bit mask per choice of blocks that must agree."""
    if not 0 < radius < blocks <= 64:
        raise ValueError("radius must be positive and below the number of blocks")
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    out = []
    for kept in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << (cuts[k + 1] - cuts[k])) - 1) << cuts[k] for k in kept)
        out.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return out


def cells(rows: DataFrame, radius: int, blocks: int, chunk: int) -> DataFrame:
    """Rows (with columns node and fp) dealt to the cells of their masked fingerprints."""
    keys = F.array(*[F.struct(F.lit(n).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for n, m in enumerate(masks(radius, blocks))])
    return dealt_cells(rows, keys, chunk)


def dealt_cells(rows: DataFrame, keys: Column, chunk: int) -> DataFrame:
    """Rows (with a column node) dealt to cells by an array of (choice, part), sorted by cell inside each partition.

    Adds choice, part (the key of the choice), i, j (the two chunks that meet) and own (the
    chunk of the row).  Rows that meet nobody are left out where a list of the shared keys is
    small enough to be sent to all tasks; otherwise they pass, and link to nothing.
    """
    spark = rows.sparkSession
    dealt = rows.select("*", F.explode(keys).alias("_key")).select(*rows.columns, "_key.choice", "_key.part")
    shared = stored(dealt.groupBy("choice", "part").agg(F.count("*").alias("n")).where("n > 1"))
    hot = shared.where(F.col("n") > chunk)
    if shared.count() <= BROADCAST_ROWS:
        met = dealt.join(F.broadcast(shared), ["choice", "part"])
    elif hot.count() <= BROADCAST_ROWS:
        met = dealt.join(F.broadcast(hot), ["choice", "part"], "left")
    else:
        met = spread_join(dealt, hot, ["choice", "part"], "left", ["node"])
    chunks = F.ceil(F.coalesce("n", F.lit(1)) / F.lit(chunk)).cast("int")
    met = met.withColumn("own", F.pmod(F.xxhash64("node"), chunks).cast("int"))
    met = met.withColumn("_other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    met = met.withColumn("i", F.least("own", "_other")).withColumn("j", F.greatest("own", "_other"))
    met = met.drop("_other", "n")
    return met.repartition(partitions(spark), *CELL).sortWithinPartitions(*CELL, "node")


def whole_cells(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Batches that hold whole cells only, each with the row at which every cell starts."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        if not len(batch):
            continue
        starts = _starts(batch)
        rest = batch.iloc[starts[-1] :]
        if len(starts) > 1:
            yield batch.iloc[: starts[-1]].reset_index(drop=True), starts[:-1]
    if rest is not None and len(rest):
        yield rest.reset_index(drop=True), np.zeros(1, np.int64)


def _starts(batch: pd.DataFrame) -> np.ndarray:
    change = np.zeros(len(batch), bool)
    change[0] = True
    for column in CELL:
        values = batch[column].to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def iterate_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of one cell at a time, cells with several rows only."""
    for batch, starts in whole_cells(batches):
        ends = np.r_[starts[1:], len(batch)]
        for k in np.flatnonzero(ends - starts > 1):
            yield batch.iloc[starts[k] : ends[k]]


class Groups:
    """Union-find over the rows of one cell."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether the two were apart."""
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True
