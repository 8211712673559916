"""Toxicity of a document: class-conditional Kneser-Ney models over word pairs.

A toxic and an ordinary model are interpolated bigram models.  As Kneser and Ney have it, the
lower order counts the different words a word was seen after, so that copies of a text add
nothing; below it both classes back off to one shared distribution, the contexts of either
class.  An expression rare in a class thus gets nearly the same probability from both models
and says little.

The counts cover every labelled row outside the held-out fold; words are 40-bit hashes there.
Pairs that the corpus holds once are not kept, as usual for such models: their mass stays with
the lower order.  All that is kept is exact and grows with the corpus.  Where the kept counts are
few enough (``send_counts``) they go to all tasks, in pieces that the tasks build and the driver
holds one at a time; otherwise the different words and pairs of each document are joined with
them, which gives the same scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradebinder.llm.bitmaps import bitmap, in_bitmap
from tradebinder.llm.common import BROADCAST_ROWS, held_out, partitions, stored, training_labels
from tradebinder.llm.trees import fit_forest
from tradebinder.operators.lookup import by_shuffle, spread_join

# Counts that may be sent to every task, about 10 bytes each, and how many of them at a time.
SEND_COUNTS = 40_000_000
PIECE = 1 << 19
# Words that are looked up together.
WORDS_AT_ONCE = 1 << 15
# Pairs that occur fewer times, in both classes together, are left to the lower order.
LEAST_PAIRS = 2
DISCOUNT = 0.75
# Ordinary weight that every context gives to the lower order.
STRENGTH = 100.0
WINDOWS = (1, 4, 12)
MEASURES = ["low_mean", *(f"low_{w}" for w in WINDOWS), "mean", f"worst_{WINDOWS[-1]}"]
_CUT = bytes(32 if (b < 48 or 57 < b < 65 or 90 < b < 97 or 122 < b < 128) else b for b in range(256))
_CLASSES = ("toxic", "plain")


def word_ids(text: str | None) -> np.ndarray:
    """Number of every word of the lower-cased text; a zero in front stands for the start."""
    words = (text or "").lower().encode().translate(_CUT).split()
    out = np.zeros(len(words) + 1, np.uint64)
    out[1:] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    return (out >> np.uint64(24)).view(np.int64)


def pair_ids(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Positive 63-bit number of each pair of words."""
    x = v.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + w.astype(np.uint64)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(1)).view(np.int64)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pair counts of each batch, so that the shuffle gets a pair once per batch and class."""
    for batch in batches:
        for label, texts in batch.groupby("label")["text"]:
            ids = [word_ids(t) for t in texts]
            v, w = (np.concatenate([np.zeros(0, np.int64), *own]) for own in ([i[:-1] for i in ids], [i[1:] for i in ids]))
            order = np.lexsort((w, v))
            v, w = v[order], w[order]
            new = np.ones(len(v), bool)
            new[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
            first = np.flatnonzero(new)
            out = pd.DataFrame({"v": v[first], "w": w[first]})
            n = np.diff(np.r_[first, len(v)])
            out["toxic"], out["plain"] = (n, 0) if label else (0, n)
            yield out


# Counts of a word (contexts of either class, of each), of a context (total, followers of each class), of a pair.
SIZES = (3, 6, 2)


class Counts:
    """Counts by number: words, contexts, pairs.

    Each is a sorted array of numbers and a row of counts per class.
    """

    def __init__(self, *tables: tuple) -> None:
        self.tables = tables

    def of(self, kind: int, ids: np.ndarray) -> np.ndarray:
        """A column of counts per id, zeros where it is not known."""
        known, values = self.tables[kind]
        if not len(known):
            return np.zeros((len(values), len(ids)))
        at = np.minimum(np.searchsorted(known, ids), len(known) - 1)
        return np.where(known[at] == ids, values[:, at], 0).astype(np.float64)


class SentCounts:
    """``Counts`` in pieces of one kind and a range of numbers each, which were sent to all tasks."""

    def __init__(self, pieces: list[tuple[int, int, int, Broadcast]]) -> None:
        self.pieces = pieces

    def of(self, kind: int, ids: np.ndarray) -> np.ndarray:
        """A column of counts per id, zeros where it is not known; the ids are sorted."""
        out = np.zeros((SIZES[kind], len(ids)))
        for own, first, last, piece in self.pieces:
            low, high = np.searchsorted(ids, (first, last + 1)) if own == kind else (0, 0)
            if low < high:
                known, values, large, counts = piece.value
                wanted = ids[low:high]
                at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
                met = np.flatnonzero(known[at] == wanted)
                at = at[met]
                found = values[:, at].astype(np.float64)
                # What a byte does not hold.
                for n in range(len(found)):
                    more = np.flatnonzero(found[n] == 255)
                    found[n, more] = counts[np.searchsorted(large, n * len(known) + at[more])]
                out[:, low + met] = found
        return out


@dataclass
class Models:
    """Sums over all counts, from which both models take their probabilities."""

    words: int
    seen_sum: float
    own_sum: list[float]
    rest: list[float]

    def ratios(self, text: str | None, counts: Counts | SentCounts) -> tuple[np.ndarray, np.ndarray]:
        """Per word the log of toxic over ordinary probability, lower order and whole model."""
        ids = word_ids(text)
        return self._ratios(ids[:-1], ids[1:], counts)

    def _ratios(self, v: np.ndarray, w: np.ndarray, counts: Counts | SentCounts) -> tuple[np.ndarray, np.ndarray]:
        # Of equal words and pairs one is looked up.
        word, word_at = np.unique(w, return_inverse=True)
        context, context_at = np.unique(v, return_inverse=True)
        pair, pair_at = np.unique(pair_ids(v, w), return_inverse=True)
        seen, *own = counts.of(0, word)[:, word_at]
        totals = counts.of(1, context)[:, context_at]
        pairs = counts.of(2, pair)[:, pair_at]
        # One place more for the words never met.
        shared = (seen + 0.5) / (self.seen_sum + 0.5 * (self.words + 1))
        low, whole = [], []
        for c in (0, 1):
            low.append(np.maximum(own[c] - DISCOUNT, 0) / self.own_sum[c] + self.rest[c] * shared)
            total, kept, held = totals[3 * c], totals[3 * c + 1], totals[3 * c + 2]
            # What the discounts and the pairs that are not kept leave to the lower order.
            left = DISCOUNT * kept + (total - held)
            whole.append((np.maximum(pairs[c] - DISCOUNT, 0) + (STRENGTH + left) * low[c]) / (total + STRENGTH))
        return np.log(low[0] / low[1]), np.log(whole[0] / whole[1])

    def measures(self, texts: list[str | None], counts: Counts | SentCounts) -> list[list[float]]:
        """Of each text the length-normalised log ratios of the whole and of its most toxic windows."""
        out, ids, held = [], [], 0
        for text in texts:
            ids.append(word_ids(text))
            held += len(ids[-1]) - 1
            if held >= WORDS_AT_ONCE:
                out += self._measures(ids, counts)
                ids, held = [], 0
        return out + self._measures(ids, counts) if ids else out

    def _measures(self, ids: list[np.ndarray], counts: Counts | SentCounts) -> list[list[float]]:
        low, whole = self._ratios(np.concatenate([i[:-1] for i in ids]), np.concatenate([i[1:] for i in ids]), counts)

        def worst(sums: np.ndarray, width: int) -> float:
            size = min(width, len(sums) - 1)
            return float((sums[size:] - sums[:-size]).max()) / width

        out, at = [], 0
        for i in ids:
            n = len(i) - 1
            if not n:
                out.append([0.0] * len(MEASURES))
                continue
            own = low[at : at + n], whole[at : at + n]
            sums = [np.r_[0.0, np.cumsum(r, dtype=np.float64)] for r in own]
            out.append([float(own[0].mean()), *(worst(sums[0], w) for w in WINDOWS), float(own[1].mean()), worst(sums[1], WINDOWS[-1])])
            at += n
        return out


def fit_models(rows: DataFrame) -> tuple[Models, DataFrame]:
    """Both models from every row of (text, label), and the counts they need.

    The counts are rows of id, kind (0 word, 1 context, 2 pair) and c0 to c5.
    """
    spark = rows.sparkSession
    counted = rows.mapInPandas(_count, "v long, w long, toxic long, plain long")
    # Dealt by the second word: pairs and words come from one shuffle, which the plan reuses.
    pairs = counted.repartition(partitions(spark), "w").groupBy("v", "w").agg(*[F.sum(c).alias(c) for c in _CLASSES])
    contexts = [F.count_if(F.col(c) > 0).alias(f"{c}_contexts") for c in _CLASSES]
    words = pairs.groupBy("w").agg(F.count("*").alias("contexts"), *contexts)
    kept = F.col("toxic") + F.col("plain") >= LEAST_PAIRS
    of_class = []
    for c in _CLASSES:
        of_class += [F.sum(c), F.count_if(kept & (F.col(c) > 0)), F.coalesce(F.sum(F.when(kept, F.col(c))), F.lit(0))]
    before = pairs.groupBy("v").agg(*[x.alias(f"c{n}") for n, x in enumerate(of_class)])

    @F.pandas_udf("long")
    def number(v: pd.Series, w: pd.Series) -> pd.Series:
        return pd.Series(pair_ids(v.to_numpy(np.int64), w.to_numpy(np.int64)))

    none = [F.lit(0).cast("long").alias(f"c{n}") for n in range(6)]
    tables = [
        words.select(F.col("w").alias("id"), F.lit(0).alias("kind"), F.col("contexts").alias("c0"),
                     F.col("toxic_contexts").alias("c1"), F.col("plain_contexts").alias("c2"), *none[3:]),
        before.select(F.col("v").alias("id"), F.lit(1).alias("kind"), *[f"c{n}" for n in range(6)]),
        pairs.where(kept).select(number("v", "w").alias("id"), F.lit(2).alias("kind"), F.col("toxic").alias("c0"), F.col("plain").alias("c1"), *none[2:]),
    ]
    table = stored(reduce(DataFrame.unionByName, tables))
    least = [F.sum(F.least(F.col(c), F.lit(DISCOUNT))) for c in ("c1", "c2")]
    sums = table.where("kind = 0").agg(F.count("*"), *[F.sum(c) for c in ("c0", "c1", "c2")], *least).first()
    own = [max(1.0, float(sums[2 + c] or 0)) for c in (0, 1)]
    rest = [float(sums[4 + c] or 0) / own[c] if own[c] > 1 else 1.0 for c in (0, 1)]
    return Models(int(sums[0]), float(sums[1] or 0), own, rest), table


def counts_of(kind: np.ndarray, ids: np.ndarray, columns: list[np.ndarray]) -> Counts:
    """Counts from their rows."""
    parts = []
    for n, size in enumerate(SIZES):
        own = np.flatnonzero(kind == n)
        own = own[np.argsort(ids[own], kind="stable")]
        parts.append((ids[own], np.stack([c[own] for c in columns[:size]])))
    return Counts(*parts)


def _packed(rows: pd.DataFrame) -> pd.DataFrame:
    """One row of a piece: its numbers in order, a byte per count, and the places and values of larger counts."""
    rows = rows.sort_values("id")
    kind, ids = int(rows["kind"].iloc[0]), rows["id"].to_numpy()
    values = np.stack([rows[f"c{n}"].to_numpy() for n in range(SIZES[kind])])
    large = np.flatnonzero(values.reshape(-1) >= 255)
    parts = {"ids": ids, "few": np.minimum(values, 255).astype(np.uint8), "large": large, "counts": values.reshape(-1)[large]}
    return pd.DataFrame({"kind": [kind], **{name: [part.tobytes()] for name, part in parts.items()}})


def sent_counts(table: DataFrame) -> SentCounts:
    """All counts, sent to all tasks; the driver takes one piece after the other."""
    context = table.sparkSession.sparkContext
    numbers = {r["kind"]: r["n"] for r in table.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    # The numbers are hashes of 40 and 63 bits.
    piece = F.lit(0)
    for kind, bits in enumerate((40, 40, 63)):
        most = max(1, -(-numbers.get(kind, 0) // PIECE))
        # A power of two, so that a piece is a range of numbers.
        piece = F.when(F.col("kind") == kind, F.shiftright("id", bits - (most - 1).bit_length()).cast("int")).otherwise(piece)
    typed = "kind int, ids binary, few binary, large binary, counts binary"
    pieces = []
    # Written, so that the driver reads files of some pieces, not every partition of a shuffle.
    for row in stored(table.groupBy("kind", piece.alias("piece")).applyInPandas(_packed, typed)).toLocalIterator():
        ids, large, counts = (np.frombuffer(row[c], np.int64) for c in ("ids", "large", "counts"))
        few = np.frombuffer(row["few"], np.uint8).reshape(SIZES[row["kind"]], len(ids))
        pieces.append((row["kind"], int(ids[0]), int(ids[-1]), context.broadcast((ids, few, large, counts))))
    return SentCounts(pieces)


def _wanted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The different words, contexts and pairs of every row."""
    for batch in batches:
        for row, text in zip(batch["row"], batch["text"], strict=True):
            ids = word_ids(text)
            parts = [np.unique(x) for x in (ids[1:], ids[:-1], pair_ids(ids[:-1], ids[1:]))]
            kind = np.repeat([0, 1, 2], [len(p) for p in parts]).astype(np.int32)
            yield pd.DataFrame({"row": row, "id": np.concatenate(parts), "kind": kind})


def measured(docs: DataFrame, models: Models, table: DataFrame, sent: SentCounts | None) -> DataFrame:
    """``docs`` (with a column text) and their measures in a column m, from the counts sent or else joined."""
    typed = ", ".join(f"{m} double" for m in MEASURES)
    if sent is not None:

        @F.pandas_udf(typed)
        def measure(texts: pd.Series) -> pd.DataFrame:
            return pd.DataFrame(models.measures(texts, sent), columns=MEASURES, dtype=float)

        return docs.withColumn("m", measure("text"))
    # Written, so that every row keeps its number.
    docs = stored(docs.withColumn("row", F.monotonically_increasing_id()))
    wanted = docs.select("row", "text").mapInPandas(_wanted, "row long, id long, kind int")
    values = [F.col(f"c{n}") for n in range(max(SIZES))]
    met = spread_join(wanted, table, ["id", "kind"], "inner", ["row"])
    met = met.groupBy("row").agg(F.collect_list(F.struct("kind", "id", F.array(*values).alias("c"))).alias("counts"))

    @F.pandas_udf(typed)
    def measure_own(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = []
        for text, rows in zip(texts, found, strict=True):
            rows = [] if rows is None else rows
            kind, ids = (np.array([r[c] for r in rows], np.int64) for c in ("kind", "id"))
            columns = np.array([list(r["c"]) for r in rows], np.int64).reshape(-1, max(SIZES)).T
            out += models.measures([text], counts_of(kind, ids, list(columns)))
        return pd.DataFrame(out, columns=MEASURES, dtype=float)

    return docs.join(met, "row", "left").withColumn("m", measure_own("text", "counts")).drop("row", "counts")


def labelled(docs: DataFrame, known: DataFrame) -> DataFrame:
    """text and label of the rows of ``docs`` whose doc_id is ``known``; of many known ids a bitmap keeps most other rows out of the join."""
    if known.count() <= BROADCAST_ROWS:
        return docs.join(F.broadcast(known), "doc_id").select("text", "label")
    place = F.xxhash64(F.col("doc_id").cast("long"))
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(known.select(place.alias("id"))))
    return docs.where(in_bitmap(bits)(place)).join(by_shuffle(known), "doc_id").select("text", "label")


def score_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    calibration_rows: int = 20_000,
    divisor: int = 3,
    remainder: int = 1,
    threshold: float = 0.7,
    send_counts: int = SEND_COUNTS,
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``documents`` (doc_id, text).

    Outside the held-out fold four fifths of the labelled rows train the models; at most
    ``calibration_rows`` ids and different rows of the last fifth calibrate: small boosted trees turn the
    length-normalised log ratios (whole text and worst windows) into a probability.

    Null or empty text has ratios of zero and gets a score like any other; a null doc_id is
    scored and not held out; repeated rows are scored each (and counted each in training);
    without labels every score is 0.5; empty input gives no rows; other columns are ignored.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long"), "text")
    fold = held_out(F.col("doc_id"), divisor, remainder)
    known = training_labels(labels, "toxic").where(~held_out(F.col("doc_id"), divisor, remainder))
    known = stored(known.withColumn("calibrates", F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0))
    models, table = fit_models(labelled(docs, known.where("not calibrates").select("doc_id", "label")))
    # Sent once for both uses below: every executor keeps what it is sent on disk.
    sent = sent_counts(table) if table.count() <= send_counts else None
    chosen = known.where("calibrates").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(calibration_rows)
    sample = docs.join(F.broadcast(chosen.select("doc_id", "label")), "doc_id")
    # Equal rows count by weight, so that the rows the driver gets are bounded, not only their ids.
    sample = sample.groupBy("doc_id", "text", "label").agg(F.count("*").alias("weight"))
    sample = sample.orderBy(F.xxhash64("doc_id", "text", F.lit(1)), "doc_id").limit(calibration_rows)
    sample = measured(sample, models, table, sent).select("m.*", "label", "weight").toArrow().to_pandas()
    curve = fit_forest(
        sample[MEASURES].to_numpy(float), sample["label"].to_numpy(float), sample["weight"].to_numpy(float), trees=40, depth=2, rate=0.2, bins=32
    )
    curve = spark.sparkContext.broadcast(curve)

    @F.pandas_udf("double")
    def probability(rows: pd.DataFrame) -> pd.Series:
        return pd.Series(curve.value.probability(rows[MEASURES].to_numpy(float)))

    docs = measured(docs.select("doc_id", fold.alias("held_out"), "text"), models, table, sent)
    scored = docs.select("doc_id", "held_out", probability("m").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
