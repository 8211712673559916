"""Benchmark passages in documents: BM25 over an inverted index of the test items.

Every window of every document is a query.  Scores are divided by the score an item gives
itself, so one threshold means the same share of an item's weight for all items.  Retrieval is
exact: a window is left out only if the words it shares with an item's rarest ones cannot
carry the item to the threshold, and inside a window block-max WAND skips only items that
cannot reach it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradebinder.llm.common import stored
from tradebinder.operators.lookup import spread_join

K1, B = 1.2, 0.75
BLOCK = 32
SHINGLE = 5
# Texts of test items that one index (and one pass over the documents) may hold.
INDEX_BYTES = 16 << 20
_CUT = bytes(32 if (b < 48 or 57 < b < 65 or 90 < b < 97 or 122 < b < 128) else b for b in range(256))
FOUND = "array<struct<item_id: long, score: double, question_overlap: double, answer_overlap: double>>"


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased words; ASCII punctuation separates."""
    return (text or "").lower().encode().translate(_CUT).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The answer is the last line of several, else the last sentence of several, else the last quarter."""
    lines = [x for x in text.split("\n") if plain_words(x)]
    if len(lines) < 2:
        lines = [x for x in text.replace("? ", "?\n").replace(". ", ".\n").split("\n") if plain_words(x)]
    if len(lines) > 1:
        head = plain_words("\n".join(lines[:-1]))
        return head, plain_words(lines[-1])
    words = plain_words(text)
    cut = len(words) - max(1, len(words) // 4)
    return words[:cut], words[cut:]


def shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
    if not words:
        return set()
    return {tuple(words[k : k + SHINGLE]) for k in range(max(1, len(words) - SHINGLE + 1))}


def overlap(part: list[bytes], words: list[bytes]) -> float:
    """Share of the part's shingles (or of its one short run) in the words; 1 for an empty part."""
    wanted = shingles(part)
    if not wanted:
        return 1.0
    size = min(SHINGLE, len(part))
    there = set(zip(*(words[k:] for k in range(size)), strict=False))
    return len(wanted & there) / len(wanted)


@dataclass
class Statistics:
    """Of all items: their number, their mean length, and in how many each word is (the words of an index at least)."""

    items: int
    mean: float
    df: dict[bytes, int]


def statistics(items: list[tuple[int, str]]) -> Statistics:
    """Statistics of items that are all at hand."""
    words = [w for w in (plain_words(t) for _, t in items) if w]
    return Statistics(len(words), sum(map(len, words)) / max(1, len(words)), Counter(t for w in words for t in set(w)))


class Index:
    """Postings of one class of items of similar length, in item order, in blocks with their maxima.

    Weights come from the statistics of all items, so an item scores the same in any index.
    """

    def __init__(self, items: list[tuple[int, str]], threshold: float, known: Statistics) -> None:
        self.threshold = threshold
        self.ids = [i for i, _ in items]
        self.parts = [question_and_answer(t) for _, t in items]
        words = [plain_words(t) for _, t in items]
        self.longest = max(map(len, words))
        df = known.df
        postings: dict[bytes, list[tuple[int, float]]] = {}
        for n, w in enumerate(words):
            norm = K1 * (1 - B + B * len(w) / known.mean)
            impact = {
                t: log(1 + (known.items - df[t] + 0.5) / (df[t] + 0.5)) * c * (K1 + 1) / (c + norm)
                for t, c in Counter(w).items()
            }
            total = sum(impact.values())
            for t, x in impact.items():
                postings.setdefault(t, []).append((n, x / total))
        self.term = {t: k for k, t in enumerate(postings)}
        self.items = [np.array([n for n, _ in p]) for p in postings.values()]
        self.impacts = [np.array([x for _, x in p]) for p in postings.values()]
        self.block_max = [np.maximum.reduceat(x, np.arange(0, len(x), BLOCK)) for x in self.impacts]
        self.largest = np.array([x.max() for x in self.impacts] + [0.0])
        self._essential(threshold)

    def _essential(self, threshold: float) -> None:
        """Of each item the rarest terms, until all others together weigh half the threshold at most.

        A window that reaches the threshold thus holds essential terms of the item with at
        least the rest of it; ``rest`` is what the others can add.
        """
        own: list[list[tuple[int, int, float]]] = [[] for _ in self.ids]
        for t, (items, impacts) in enumerate(zip(self.items, self.impacts, strict=True)):
            for n, x in zip(items.tolist(), impacts.tolist(), strict=True):
                own[n].append((len(items), t, x))
        self.rest = np.zeros(len(own))
        kept: list[list[tuple[int, float]]] = [[] for _ in self.items]
        for n, terms in enumerate(own):
            left = sum(x for _, _, x in terms)
            for _, t, x in sorted(terms):
                if left <= threshold / 2:
                    break
                kept[t].append((n, x))
                left -= x
            self.rest[n] = left
        self.count = np.array([len(k) for k in kept] + [0])
        self.start = np.r_[0, np.cumsum(self.count)]
        self.of_item = np.array([n for k in kept for n, _ in k], np.int64)
        self.weight = np.array([x for k in kept for _, x in k], float)

    def windows(self, places: np.ndarray, terms: np.ndarray, step: int) -> list[int]:
        """Windows in which the essential terms let some item reach the threshold.

        ``terms`` are the known terms of a text, at ``places``; window k starts at word k x step
        and is two steps long.
        """
        n = self.count[terms]
        total = int(n.sum())
        if not total:
            return []
        ends = np.cumsum(n)
        at = np.arange(total) + np.repeat(self.start[terms] - (ends - n), n)
        window, item, weight = np.repeat(places // step, n), self.of_item[at], self.weight[at]
        # Each word lies in two windows.
        size = len(self.ids)
        key = np.r_[window * size + item, (window - 1) * size + item]
        key, which = np.unique(key, return_inverse=True)
        reach = np.bincount(which, np.r_[weight, weight]) + self.rest[key % size]
        found = np.unique(key[reach >= self.threshold - 1e-9] // size)
        return found[found >= 0].tolist()

    def retrieve(self, terms: list[int]) -> list[tuple[int, float]]:
        """Items and scores at or above the threshold, by block-max WAND."""
        least = self.threshold - 1e-9
        at = {t: 0 for t in terms}
        found = []
        while True:
            live = sorted((int(self.items[t][p]), t) for t, p in at.items() if p < len(self.items[t]))
            total, pivot = 0.0, -1
            for n, (_, t) in enumerate(live):
                total += self.largest[t]
                if total >= least:
                    pivot = n
                    break
            if pivot < 0:
                return found
            item = live[pivot][0]
            while pivot + 1 < len(live) and live[pivot + 1][0] == item:
                pivot += 1
            ahead = [t for _, t in live[: pivot + 1]]
            for t in ahead:
                at[t] += int(np.searchsorted(self.items[t][at[t] :], item))
            inside = [t for t in ahead if at[t] < len(self.items[t])]
            if sum(self.block_max[t][at[t] // BLOCK] for t in inside) < least:
                # No item up to the end of the nearest block can reach the threshold.
                ends = [int(self.items[t][min(len(self.items[t]), (at[t] // BLOCK + 1) * BLOCK) - 1]) for t in inside]
                beyond = [live[pivot + 1][0] - 1] if pivot + 1 < len(live) else []
                skip = max(item, min(ends + beyond)) if inside else item
                for t in inside:
                    at[t] += int(np.searchsorted(self.items[t][at[t] :], skip, side="right"))
                continue
            score = 0.0
            for t in inside:
                if self.items[t][at[t]] == item:
                    score += float(self.impacts[t][at[t]])
                    at[t] += 1
            if score >= least:
                found.append((item, score))


def length_classes(items: list[tuple[int, str]], threshold: float, known: Statistics | None = None) -> list[Index]:
    """One index per power of two of item length, so that windows suit the items."""
    known = known or statistics(items)
    classes: dict[int, list[tuple[int, str]]] = {}
    for item_id, text in items:
        n = len(plain_words(text))
        if n:
            classes.setdefault((n - 1).bit_length(), []).append((item_id, text))
    return [Index(sorted(own, key=lambda x: x[0]), threshold, known) for _, own in sorted(classes.items())]


def passages_found(text: str | None, indexes: list[Index], verify: float) -> list[dict]:
    """The items that a text holds, each once with its best score.

    Windows are twice as long as the longest item of the class and overlap by half, so an
    occurrence lies whole in at least one.
    """
    words = plain_words(text)
    best: dict[int, dict] = {}
    for index in indexes:
        terms = np.fromiter(map(index.term.get, words, repeat(-1)), np.int64, len(words))
        places = np.flatnonzero(terms >= 0)
        step = index.longest
        for k in index.windows(places, terms[places], step):
            window = words[k * step : (k + 2) * step]
            own = np.unique(terms[k * step : (k + 2) * step])
            for n, score in index.retrieve(own[own >= 0].tolist()):
                question, answer = (overlap(p, window) for p in index.parts[n])
                if question >= verify and answer >= verify and score > best.get(index.ids[n], {"score": -1})["score"]:
                    best[index.ids[n]] = {
                        "item_id": index.ids[n], "score": score, "question_overlap": question, "answer_overlap": answer,
                    }
    return [best[i] for i in sorted(best)]


def _finder(indexes, verify: float):
    @F.pandas_udf(FOUND)
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([passages_found(t, indexes.value, verify) for t in texts])

    return find


def _terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every item with its length and its different words."""
    for batch in batches:
        words = [plain_words(t) for t in batch["text"]]
        yield batch.assign(size=[len(w) for w in words], terms=[sorted(set(w)) for w in words])


def _finders(benchmark: DataFrame, threshold: float, verify: float):
    """A column function per share of the items; a share fits one index.

    How many items there are, how long, and how many hold each word is counted over all of them
    in Spark; a share comes with the counts of its own words.
    """
    spark = benchmark.sparkSession
    items = benchmark.where("item_id is not null and text is not null")
    items = items.select(F.col("item_id").cast("long"), "text").distinct()
    items = stored(items.mapInPandas(_terms, "item_id long, text string, size int, terms array<binary>").where("size > 0"))
    total = items.agg(F.sum(F.octet_length("text")), F.count("*"), F.avg("size")).first()
    shares = max(1, -(-int(total[0] or 0) // INDEX_BYTES))
    single = items.select("item_id", "text", F.explode("terms").alias("term"))
    df = stored(single.groupBy("term").agg(F.count("*").alias("df")))
    met = spread_join(single, df, ["term"], "inner", ["item_id", "text"]).groupBy("item_id", "text")
    items = stored(met.agg(F.collect_list(F.struct("term", "df")).alias("terms")))
    for share in range(shares):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(shares)) == share).collect()
        known = Statistics(total[1], total[2] or 1.0, {bytes(t.term): t.df for r in own for t in r.terms})
        indexes = spark.sparkContext.broadcast(length_classes([(r.item_id, r.text) for r in own], threshold, known))
        yield _finder(indexes, verify)


def contaminated(documents: DataFrame, benchmark: DataFrame, threshold: float = 0.6, verify: float = 0.8) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap of every document that holds an item.

    ``documents`` (doc_id, text) is read once per share of 16 MB of ``benchmark`` (item_id,
    text).  An item counts as held if a window scores at least ``threshold`` of the item's own
    BM25 score and holds at least ``verify`` of the five-word shingles of its question and of
    its answer.

    Null or empty texts and items without a word match nothing; items without an id are
    ignored, items that share an id are one item if their texts agree, otherwise each is looked
    for and the best score counts; a null doc_id stays null; repeated rows are reported each;
    other columns are ignored.
    """
    docs, out = documents.select(F.col("doc_id").cast("long"), "text"), None
    for find in _finders(benchmark, threshold, verify):
        part = docs.select("doc_id", F.explode(find("text")).alias("m")).select("doc_id", "m.*")
        out = part if out is None else out.unionByName(part)
    return out


def keep_clean(documents: DataFrame, benchmark: DataFrame, threshold: float = 0.6, verify: float = 0.8) -> DataFrame:
    """The documents, all columns as given, that hold no item.

    Null and empty texts hold none; a null doc_id, repeated rows and other columns stay as they are.
    """
    for find in _finders(benchmark, threshold, verify):
        documents = documents.where(F.size(find("text")) == 0)
    return documents
