"""Quality score of a document: boosted trees over statistics of its whole text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradebinder.llm.common import held_out, stored, training_labels
from tradebinder.llm.trees import Forest, fit_forest

FEATURES = 20
_CLASS = np.zeros(256, dtype=np.int64)
for _bytes, _kind in (
    (range(ord("a"), ord("z") + 1), 1),
    (range(ord("A"), ord("Z") + 1), 2),
    (range(ord("0"), ord("9") + 1), 3),
    (b"#*$%&|<>", 4),
    (b".,;:!?", 5),
    (b" \t\r\x0b\x0c", 6),
    (b"\n", 7),
    (range(128, 256), 8),
):
    for _b in _bytes:
        _CLASS[_b] = _kind


def statistics(text: bytes) -> list[float]:
    """Document statistics; an empty text gives zeros."""
    if not text:
        return [0.0] * FEATURES
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kind = np.bincount(_CLASS, weights=count, minlength=9) / len(text)
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    windows = max(1, len(words) - 2)
    common = Counter(words).most_common(1)[0][1] if words else 0
    n_lines = max(1, len(lines))
    return [
        float(np.log1p(len(text))),
        float(np.log1p(len(words))),
        float(sizes.mean()),
        float(sizes.max()),
        *(float(x) for x in kind[1:9]),
        len(set(words)) / n,
        len(set(zip(words, words[1:], words[2:]))) / windows,
        1 - len(set(lines)) / n_lines,
        sum(x.rstrip()[-1:] in b".!?\"" for x in lines) / n_lines,
        common / n,
        float((sizes <= 3).mean()),
        count[ord("!")] / n,
        float(count.max()) / len(text),
    ]


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        stats = [statistics(x if x is not None else b"") for x in batch["body"]]
        yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "stats": stats})


def document_statistics(documents: DataFrame) -> DataFrame:
    """doc_id and stats (array of float) of every row; null text counts as empty."""
    body = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("body"))
    return body.mapInPandas(_measure, "doc_id long, stats array<float>")


def fit(stats: DataFrame, labels: DataFrame, train_rows: int) -> Forest:
    """Trees from at most ``train_rows`` labelled rows, chosen by a hash of their id."""
    rows = stats.where(F.col("doc_id").isNotNull()).join(training_labels(labels, "quality"), "doc_id")
    sample = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "stats").limit(train_rows).select("stats", "label").collect()
    matrix = np.array([r.stats for r in sample], dtype=np.float64).reshape(len(sample), FEATURES)
    return fit_forest(matrix, np.array([r.label for r in sample], dtype=float))


def score_quality(
    documents: DataFrame,
    labels: DataFrame,
    train_rows: int = 40_000,
    divisor: int = 5,
    remainder: int = 0,
    threshold: float = 0.3,
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``documents`` (doc_id, text).

    The statistics of every whole text are computed once and kept in the shared folder.  The
    trees are fitted on at most ``train_rows`` labelled rows outside the held-out fold (the
    documented bound of the fit) and travel to the tasks as five small arrays.

    Null or empty text has statistics of zero and gets a score like any other; a null doc_id
    is scored and not held out; repeated rows are scored each; without labels every score is
    0.5; empty input gives no rows; other columns are ignored.
    """
    spark = documents.sparkSession
    stats = stored(document_statistics(documents))
    fold = held_out(F.col("doc_id"), divisor, remainder)
    forest = spark.sparkContext.broadcast(fit(stats.where(~fold), labels, train_rows))

    @F.pandas_udf("double")
    def probability(values: pd.Series) -> pd.Series:
        matrix = np.array(values.tolist(), dtype=np.float64).reshape(len(values), FEATURES)
        return pd.Series(forest.value.probability(matrix))

    scored = stats.select("doc_id", fold.alias("held_out"), probability("stats").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
