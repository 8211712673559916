"""Token ids as binary files, compressed by a grammar per shard (Re-Pair).

Frequent pairs of neighbouring ids are replaced, round by round, by new symbols.  A shard is
one frame of a file:

    magic "TBRP" and version, seven unsigned 32-bit numbers (documents, token ids as low and
    high word, first new symbol, rules, symbols, task), then arrays, all little-endian:
    document ids (int64), whether there is an id (uint8), ids per document (uint64),
    rules (two uint16 each), expansion lengths of the rules (uint32), symbols (uint16)

The expansion lengths let a reader find the symbols of any range of ids without expanding
what lies before.  Symbols are 16 bits wide, which bounds the rules of a shard.  Frames are
followed by a line feed, the record separator of the writer that carries them to any store.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradebinder.llm.common import partitions, scratch_path, stored
from tradebinder.llm.tokens import encoder as encoder_of

MAGIC = b"TBRP\x01"
HEAD = struct.Struct("<7I")
SHARD_IDS = 1 << 20
SYMBOLS = 1 << 16
END_ID = 1
LEAST = 16
TASK_BYTES = 32 << 20
_PLACES = 18
# Pairs a round replaces: a share of the numbers that are left, and no fewer than this.
SHARE, ROUND_PAIRS = 4, 256


def replace_frequent(seq: np.ndarray, symbol: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """One round: the ``most`` most frequent pairs become symbol, symbol + 1, ...

    Returns the new sequence and the pairs (first << 16 | second) in the order of their
    symbols.  All pairs are counted exactly.  Where occurrences overlap, every other one of a
    run is taken, from the left.
    """
    pair = seq[:-1].astype(np.uint32) << np.uint32(16) | seq[1:]
    ordered = np.sort(pair)
    # A pair that occurs n times is found again LEAST - 1 places on n - LEAST + 1 times.
    often = ordered[: max(0, len(ordered) - LEAST + 1)]
    often = often[often == ordered[LEAST - 1 :]]
    if not len(often):
        return seq, np.zeros(0, np.uint32)
    first = np.r_[0, np.flatnonzero(often[1:] != often[:-1]) + 1]
    n = np.diff(np.r_[first, len(often)])
    chosen = often[first[np.sort(np.argsort(-n, kind="stable")[:most])]]

    def place_of(x: np.ndarray) -> np.ndarray:
        return (x * np.uint32(0x9E3779B1)) >> np.uint32(32 - _PLACES)

    # Positions that share a place with a chosen pair; where that is not the pair a place names,
    # they are looked up among the chosen ones.
    named = np.full(1 << _PLACES, -1, np.int32)
    named[place_of(chosen)] = np.arange(len(chosen))
    k = named[place_of(pair)]
    at = np.flatnonzero(k >= 0)
    k, own = k[at], pair[at]
    other = np.flatnonzero(chosen[k] != own)
    found = np.minimum(np.searchsorted(chosen, own[other]), len(chosen) - 1)
    k[other] = np.where(chosen[found] == own[other], found, -1)
    at, k = at[k >= 0], k[k >= 0]
    place = np.arange(len(at))
    place -= np.maximum.accumulate(np.where(np.r_[True, np.diff(at) > 1], place, 0))
    even = np.flatnonzero(place & 1 == 0)
    at, k = at[even], k[even]
    taken = np.bincount(k, minlength=len(chosen)) > 0
    used, rank = np.flatnonzero(taken), (np.cumsum(taken) - 1)[k]
    out = seq.copy()
    out[at] = (symbol + rank).astype(np.uint16)
    keep = np.ones(len(seq), bool)
    keep[at + 1] = False
    return out[keep], chosen[used]


def compress(ids: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """rules (n x 2) and symbols; ids and rules share the numbers below 65,536.

    Ends when no pair occurs ``LEAST`` times or the numbers are used up.
    """
    if len(ids) and int(ids.max()) >= base:
        raise ValueError("id beyond the vocabulary")
    seq, rules = ids.astype(np.uint16), np.zeros((0, 2), np.uint16)
    while (room := SYMBOLS - base - len(rules)) > 0 and len(seq) > 1:
        seq, pairs = replace_frequent(seq, base + len(rules), min(room, max(ROUND_PAIRS, room // SHARE)))
        if not len(pairs):
            break
        new = np.stack([pairs >> np.uint32(16), pairs & np.uint32(0xFFFF)], axis=1).astype(np.uint16)
        rules = np.concatenate([rules, new])
    return rules, seq


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    size = np.ones(base + len(rules), np.int64)
    for k, (a, b) in enumerate(rules.tolist()):
        size[base + k] = size[a] + size[b]
    return size[base:]


class Shard:
    """Random access to the ids of one frame."""

    def __init__(self, rules: np.ndarray, lengths: np.ndarray, symbols: np.ndarray, base: int) -> None:
        self.base, self.symbols = base, symbols
        self.size = np.ones(base + len(rules), np.int64)
        self.size[base:] = lengths
        self.at = np.r_[0, np.cumsum(self.size)]
        self.flat = np.empty(self.at[-1], np.uint16)
        self.flat[:base] = np.arange(base)
        for k, (a, b) in enumerate(rules.tolist()):
            n = self.at[base + k]
            self.flat[n : n + self.size[a]] = self.flat[self.at[a] : self.at[a + 1]]
            self.flat[n + self.size[a] : self.at[base + k + 1]] = self.flat[self.at[b] : self.at[b + 1]]
        self.starts = np.r_[0, np.cumsum(self.size[symbols])]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from start to stop, of the symbols that hold them only."""
        if start >= stop:
            return np.zeros(0, "<u4")
        a = int(np.searchsorted(self.starts, start, side="right")) - 1
        b = int(np.searchsorted(self.starts, stop, side="left"))
        symbols = self.symbols[a:b]
        size = self.size[symbols]
        ends = np.cumsum(size)
        places = np.arange(ends[-1]) + np.repeat(self.at[symbols] - (ends - size), size)
        first = int(self.starts[a])
        return self.flat[places][start - first : stop - first].astype("<u4")


def pack_frame(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, base: int, task: int) -> bytes:
    rules, symbols = compress(ids, base)
    lengths = expansion_lengths(rules, base)
    head = HEAD.pack(len(doc_ids), len(ids) & 0xFFFFFFFF, len(ids) >> 32, base, len(rules), len(symbols), task)
    arrays = (
        np.array([0 if i is None else i for i in doc_ids], "<i8"), np.array([i is not None for i in doc_ids], "u1"),
        np.array(counts, "<u8"), rules.astype("<u2"), lengths.astype("<u4"), symbols.astype("<u2"),
    )
    return MAGIC + HEAD.pack(*HEAD.unpack(head)) + b"".join(a.tobytes() for a in arrays)


def unpack_frames(data: bytes) -> Iterator[tuple[list[int | None], np.ndarray, Shard, int]]:
    """doc ids, ids per document, shard and task of every frame of a file."""
    at = 0
    while at < len(data):
        if data[at : at + len(MAGIC)] != MAGIC:
            raise ValueError("no frame")
        at += len(MAGIC)
        docs, _, _, base, n_rules, n_symbols, task = HEAD.unpack_from(data, at)
        at += HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        numbers, known, counts = take("<i8", docs), take("u1", docs), take("<u8", docs)
        rules, lengths, symbols = take("<u2", 2 * n_rules).reshape(-1, 2), take("<u4", n_rules), take("<u2", n_symbols)
        at += 1
        ids = [int(i) if k else None for i, k in zip(numbers, known, strict=True)]
        yield ids, counts.astype(np.int64), Shard(rules, lengths, symbols, base), task


def _write(path: str, base: int, shard_ids: int):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, task = encoder_of(path), TaskContext.get().partitionId()
        end = np.array([END_ID], "<u4").tobytes()
        doc_ids, counts, parts, total = [], [], [], 0

        def frame() -> pd.DataFrame:
            ids = np.frombuffer(b"".join(parts), "<u4")
            return pd.DataFrame({"value": [pack_frame(doc_ids, counts, ids, base, task)]})

        for batch in batches:
            bodies = [body or b"" for body in batch["body"]]
            for doc_id, encoded in zip(batch["doc_id"], encoder.ids(bodies), strict=True):
                encoded += end
                doc_ids.append(None if pd.isna(doc_id) else int(doc_id))
                counts.append(len(encoded) // 4)
                parts.append(encoded)
                total += counts[-1]
                if total >= shard_ids:
                    yield frame()
                    doc_ids, counts, parts, total = [], [], [], 0
        if doc_ids:
            yield frame()

    return write


def write_tokens(documents: DataFrame, path: str, tokenizer: str, vocabulary: int, shard_ids: int = SHARD_IDS) -> None:
    """Encode every text, close each with the end id, and write frames in ascending doc_id order.

    Documents are dealt to tasks by ranges of doc_id (rows without one first, rows of one id by
    a hash of their text), about ``TASK_BYTES`` of text each; task n writes file n.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("body"))
    rows = rows.withColumn("tie", F.xxhash64("body"))
    total = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    tasks = max(partitions(spark), -(-int(total) // TASK_BYTES))
    dealt = rows.repartitionByRange(tasks, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    frames = dealt.mapInPandas(_write(tokenizer, vocabulary, shard_ids), "value binary")
    frames.select(F.col("value").cast("string")).write.option("lineSep", "\n").text(path)


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for data in batch["content"]:
            before = 0
            for doc_ids, counts, shard, task in unpack_frames(data):
                starts = np.r_[0, np.cumsum(counts)]
                ids = shard.ids(0, int(starts[-1]))
                sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts[:-1], starts[1:], strict=True)]
                out = pd.DataFrame({"doc_id": pd.array(doc_ids, "Int64"), "task": task, "start": before + starts[:-1], "n_tokens": counts, "ids_crc32": sums})
                before += int(starts[-1])
                yield out


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 of every document in the files."""
    files = spark.read.format("binaryFile").load(path).select("content")
    rows = stored(files.mapInPandas(_read, "doc_id long, task int, start long, n_tokens long, ids_crc32 long"))
    # One row per file; the running sum is over files, not documents.
    sizes = rows.groupBy("task").agg(F.sum("n_tokens").alias("n"))
    from pyspark.sql import Window

    before = sizes.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("before"))
    out = rows.join(before, "task")
    return out.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def tokens_through_files(documents: DataFrame, tokenizer: str, vocabulary: int = 49408, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the ids of every whole text of ``documents`` (doc_id, text), then read the files back.

    Null or empty text has the end id only; rows without a doc_id come first; repeated rows
    are documents of their own, in an order fixed by their text; an empty table gives no rows;
    other columns are ignored.
    """
    spark = documents.sparkSession
    path = scratch_path(spark)
    write_tokens(documents, path, tokenizer, vocabulary, shard_ids)
    return read_tokens(spark, path)
