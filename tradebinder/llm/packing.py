"""Training sequences in length buckets with the least padding, in batches of a token budget."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradebinder.llm.common import partitions, stored
from tradebinder.llm.tokens import encoder


def best_boundaries(counts: np.ndarray, buckets: int) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets with the least padding in total.

    ``counts[n]`` sequences have length n.  The cost of one bucket from a (exclusive) to b is
    b x (their number) - (their tokens); the best cost of the lengths up to b with k buckets is
    the least over a of the best cost up to a with k - 1 buckets plus that.
    """
    lengths = np.flatnonzero(counts)
    if not len(lengths):
        return []
    number = np.r_[0, np.cumsum(counts[lengths])].astype(np.int64)
    tokens = np.r_[0, np.cumsum(counts[lengths] * lengths)].astype(np.int64)
    n, buckets = len(lengths), min(buckets, len(lengths))
    best = np.full(n + 1, np.iinfo(np.int64).max // 4)
    best[0] = 0
    choice = np.zeros((buckets + 1, n + 1), np.int64)
    for k in range(1, buckets + 1):
        new = np.full(n + 1, np.iinfo(np.int64).max // 4)
        for b in range(1, n + 1):
            cost = best[:b] + lengths[b - 1] * (number[b] - number[:b]) - (tokens[b] - tokens[:b])
            choice[k, b] = cost.argmin()
            new[b] = cost[choice[k, b]]
        best = new
    out, b = [], n
    for k in range(buckets, 0, -1):
        out.append(int(lengths[b - 1]))
        b = int(choice[k, b])
    return sorted(set(out))


def token_counts(documents: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, tie (hash of the text) and n_tokens of each row, the end of the document included."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series(encoder(tokenizer).counts([t or b"" for t in texts]) + 1)

    body = F.col("text").cast("binary")
    return documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tie"), count(body).alias("n_tokens"))


def pack(
    documents: DataFrame, tokenizer: str, longest: int = 4096, buckets: int = 16, budget: int = 65_536
) -> DataFrame:
    """One row per training sequence of ``documents`` (doc_id, text).

    A document is one sequence, or several if it is longer than ``longest`` tokens: piece n
    holds its tokens from ``first_token`` on.  The histogram of all lengths (at most
    ``longest`` rows) decides the bucket limits.  Inside a bucket, sequences follow by doc_id,
    and each ``budget // bucket_length`` of them are a batch, so that a padded batch keeps
    within the budget and only the last batch of a bucket is not full.

    Returns doc_id, piece, first_token, n_tokens, bucket_length, batch (numbered inside its
    bucket) and slot.  Null or empty text is a sequence of the end id alone; rows without a
    doc_id come first; repeated rows are sequences of their own; empty input gives no rows;
    other columns are ignored.
    """
    if not 0 < longest <= budget:
        raise ValueError("the longest sequence has to fit the budget")
    spark = documents.sparkSession
    sizes = token_counts(documents, tokenizer)
    pieces = F.sequence(F.lit(0), F.ceil(F.col("n_tokens") / longest).cast("int") - 1)
    cut = sizes.select("doc_id", "tie", "n_tokens", F.explode(pieces).alias("piece"))
    first = F.col("piece").cast("long") * longest
    cut = stored(cut.select("doc_id", "tie", "piece", first.alias("first_token"), F.least(F.lit(longest), F.col("n_tokens") - first).alias("n_tokens")))
    histogram = cut.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()
    counts = np.zeros(longest + 1, np.int64)
    for r in histogram:
        counts[r.n_tokens] = r.n
    limits = best_boundaries(counts, buckets)
    fits = F.filter(F.array(*[F.lit(x) for x in limits]), lambda x: x >= F.col("n_tokens")) if limits else F.array(F.lit(longest))
    placed = cut.withColumn("bucket_length", F.element_at(fits, 1).cast("int"))
    # Places in a bucket: ranges of (bucket, doc_id) are counted, then each adds what lies before it.
    order = ["bucket_length", "doc_id", "tie", "piece"]
    dealt = placed.repartitionByRange(partitions(spark), *order).withColumn("part", F.spark_partition_id())
    dealt = stored(dealt)
    parts = dealt.groupBy("part", "bucket_length").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("bucket_length").orderBy("part")
    parts = parts.select("part", "bucket_length", (F.sum("n").over(ahead) - F.col("n")).alias("ahead"))
    inside = Window.partitionBy("part", "bucket_length").orderBy("doc_id", "tie", "piece")
    numbered = dealt.withColumn("place", F.row_number().over(inside).cast("long") - 1)
    numbered = numbered.join(F.broadcast(parts), ["part", "bucket_length"])
    place, room = F.col("place") + F.col("ahead"), F.floor(F.lit(budget) / F.col("bucket_length"))
    return numbered.select(
        "doc_id", "piece", "first_token", "n_tokens", "bucket_length",
        F.floor(place / room).alias("batch"), (place % room).cast("int").alias("slot"),
    )
