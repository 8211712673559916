"""Near-duplicate documents by SimHash, searched with BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradebinder.llm.blocks import Groups, cells, iterate_cells
from tradebinder.llm.common import free_name, stored
from tradebinder.llm.components import connected_components
from tradebinder.operators.lookup import spread_join

_SIGNED = np.dtype("<i8")


def shingle_hashes(text: bytes, size: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every run of ``size`` lower-cased words, repeats included.

    bytes.lower changes A-Z only and bytes.split cuts at the six ASCII white-space bytes.
    """
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    runs = map(joined.__getitem__, map(slice, starts, (e - 1 for e in starts[size:])))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(r, seed) for r in runs), np.uint64, len(words) - size + 1)


def majority(hashes: np.ndarray) -> int:
    """Signed fingerprint whose bits are set in over half of the hashes; 0 for none."""
    n = len(hashes)
    if not n:
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(_SIGNED)[0])


def fingerprint(size: int):
    """Pandas UDF from binary text to the signed 64-bit fingerprint."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([majority(shingle_hashes(t, size)) if t else 0 for t in texts], dtype="int64")

    return simhash


class BKTree:
    """Metric tree over 64-bit integers: children are keyed by their distance to the parent."""

    def __init__(self) -> None:
        self.points: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, point: int) -> None:
        self.points.append(point)
        self.children.append({})
        new, at = len(self.points) - 1, 0
        while new:
            d = (point ^ self.points[at]).bit_count()
            below = self.children[at].get(d)
            if below is None:
                self.children[at][d] = new
                return
            at = below

    def near(self, point: int, radius: int) -> list[int]:
        """Numbers of the points within the radius; only edges that can lead there are followed."""
        found, todo = [], [0] if self.points else []
        points, children = self.points, self.children
        while todo:
            at = todo.pop()
            d = (point ^ points[at]).bit_count()
            if d <= radius:
                found.append(at)
            low, high = d - radius, d + radius
            todo += [c for e, c in children[at].items() if low <= e <= high]
        return found


def _tree_links(radius: int):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cell in iterate_cells(batches):
            nodes = cell["node"].to_numpy()
            points = [int(x) & 0xFFFFFFFFFFFFFFFF for x in cell["fp"].to_numpy()]
            own, first, second = cell["own"].to_numpy(), cell["i"].iat[0], cell["j"].iat[0]
            groups, tree, numbers, links = Groups(len(cell)), BKTree(), [], []
            for n, point in enumerate(points):
                if first == second:
                    hits = tree.near(point, radius)
                if first == second or own[n] == first:
                    tree.add(point)
                    numbers.append(n)
                if first == second:
                    links += [(nodes[numbers[h]], nodes[n]) for h in hits if groups.join(numbers[h], n)]
            if first != second:
                for n in np.flatnonzero(own == second):
                    hits = tree.near(points[n], radius)
                    links += [(nodes[numbers[h]], nodes[n]) for h in hits if groups.join(numbers[h], int(n))]
            if links:
                yield pd.DataFrame(links, columns=["a", "b"])

    return search


def fingerprint_links(points: DataFrame, radius: int, blocks: int, chunk: int) -> DataFrame:
    """a, b: a spanning forest, per cell, of the links between distinct fingerprints.

    ``points`` has distinct fingerprints in node and fp.  Every pair within the radius meets in
    at least one cell, whose shard tree is searched there; of the links inside a cell that
    close a circle none is returned, as the groups stay the same.
    """
    dealt = cells(points, radius, blocks, chunk)
    return dealt.mapInPandas(_tree_links(radius), "a long, b long")


def near_duplicates(
    documents: DataFrame, size: int = 4, radius: int = 4, blocks: int = 6, chunk: int = 4096
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Copies share a fingerprint, so the search runs over distinct fingerprints, dealt by blocks
    of bits (see ``blocks``) to shards; each shard is one BK-tree.  Groups come from an
    iterative join, never from one task.

    Null, empty or blank text has fingerprint zero and links like any other.  A null doc_id
    is never the smallest; a group of only such rows has a null component_id.  Repeated rows
    are returned each.  Empty input gives no rows; other columns are ignored.
    """
    body = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("body"))
    marked = stored(body.select("doc_id", fingerprint(size)("body").alias("fp")))
    points = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")).withColumn("node", F.col("fp")))
    roots = connected_components(fingerprint_links(points.select("node", "fp"), radius, blocks, chunk))
    placed = points.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = stored(placed.select("fp", "first_id", "root"))
    smallest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    groups = spread_join(placed.select("fp", "root"), smallest, ["root"], "inner", ["fp"]).drop("root")
    out = spread_join(marked, groups, ["fp"], "inner", ["doc_id"])
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(documents: DataFrame, **options) -> DataFrame:
    """The documents with the smallest id of their group, all columns as given.

    Rows that share a doc_id count as one document and stay or go together; rows without a
    doc_id stay.
    """
    found = near_duplicates(documents, **options)
    lost = free_name(documents, "lost_id")
    gone = found.where("component_id is not null and doc_id != component_id").select(F.col("doc_id").alias(lost))
    gone = stored(gone.distinct())
    return documents.join(gone, documents["doc_id"] == gone[lost], "left_anti")
