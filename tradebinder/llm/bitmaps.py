"""Sets of 64-bit ids as bitmaps of a fixed size, which travel to every task; a wrong hit is possible, a missing one not."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bits of a bitmap, 16 MB; Spark's bitmap functions cut it into buckets.
BITS = 1 << 27
BUCKET = 1 << 15


def bitmap(ids: DataFrame) -> np.ndarray:
    """The bits of the ids (a column id), whose low bits are their places; built bucket by bucket in Spark."""
    place = F.pmod("id", F.lit(BITS))
    parts = ids.select((place / BUCKET).cast("int").alias("bucket"), (place % BUCKET).alias("bit"))
    parts = parts.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toArrow()
    out = np.zeros((BITS // BUCKET, BUCKET // 8), np.uint8)
    for bucket, bits in zip(parts["bucket"].to_pylist(), parts["bits"].to_pylist(), strict=True):
        out[bucket] = np.frombuffer(bits, np.uint8)
    return out.reshape(-1)


def has(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether the bit of each id is set."""
    place = ids.view(np.uint64) % np.uint64(BITS)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def in_bitmap(bits):
    """Function of an id column: whether the broadcast bitmap has its bit."""

    @F.pandas_udf("boolean")
    def known(ids: pd.Series) -> pd.Series:
        return pd.Series(has(bits.value, np.ascontiguousarray(ids.to_numpy(np.int64))))

    return known
