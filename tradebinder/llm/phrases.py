"""Phrase collocations by vertical partitioning of the words' suffixes.

The suffixes of all pieces, cut after ``depth`` words, are dealt to groups by their first words.
A prefix that is more frequent than the memory budget is extended by a word, then by another,
so that no group has to hold more than about a budget of suffixes; the others are put together
until a group is worth building.  Each group sorts its suffixes and builds its part of the
suffix tree on its own: a run of equal prefixes is a node, and its count is the sum of the
leaves below.  Nodes above a group's prefixes were counted when the prefixes were extended.

Words are 64-bit hashes that hold the language too.  All different words are compared: should
two share a hash, the whole is done again with other hashes.  What travels to every task are
bitmaps of a fixed size: of the words that are frequent enough to be in a phrase (any other
word ends a suffix, as no phrase with it can be frequent) and of the prefixes to be extended.
A wrong hit in a bitmap costs some rows and changes no count.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradebinder.llm.bitmaps import bitmap, has, in_bitmap
from tradebinder.llm.common import arrow_batches, partitions, stored
from tradebinder.operators.lookup import spread_join

DEPTH = 4
W = [f"w{k}" for k in range(1, DEPTH + 1)]
# Bytes of text of one language whose words are numbered together.
PORTION = 2 << 20
# Bytes of portions that are written, read and handed to Python together.  Parquet would look at the
# size of its pages and row groups only every hundred rows, which here are hundreds of MB.
HELD = 8 << 20
_IN_PARTS = {f"parquet.{part}.size.row.check.{end}": "1" for part in ("page", "block") for end in ("min", "max")}
# A-Z become a-z, every mark that ends a piece a full stop, a tab a blank.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else 46 if b in b".,;:!?" or 10 <= b <= 13 else 32 if b == 9 else b for b in range(256))
_PORTION_ROW = "lang string, words array<string>, ids array<long>, counts array<long>, codes binary"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_codes(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The different words of the texts, and the word number at every place (-1 where a piece ends)."""
    data = b".".join(texts).translate(_PLAIN).replace(b".", b" . ")
    runs = pc.ascii_split_whitespace(pa.array([data], pa.large_string())).values.dictionary_encode()
    words = runs.dictionary.cast(pa.large_binary()).to_pylist()
    number = np.arange(len(words))
    for mark in (b".", b""):
        if mark in words:
            number[words.index(mark)] = -1
    kept = np.flatnonzero(number >= 0)
    number[kept] = np.arange(len(kept))
    return [words[k] for k in kept], number[runs.indices.to_numpy()].astype(np.int32)


def word_ids(lang: str, words: list[bytes], seed: int) -> np.ndarray:
    """Signed hash of every word in its language; zero stands for no word."""
    digest, own = xxhash.xxh64_intdigest, xxhash.xxh64_intdigest(lang.encode(), seed)
    ids = np.fromiter((digest(w, own) for w in words), np.uint64, len(words)).view(np.int64)
    return np.where(ids == 0, 1, ids)


def _portions(seed: int):
    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def portion(lang: str) -> pd.DataFrame:
            words, codes = word_codes(waiting.pop(lang))
            del size[lang]
            ids = word_ids(lang, words, seed)
            times = np.bincount(codes[codes >= 0], minlength=len(words))
            texts = [w.decode() for w in words]
            return pd.DataFrame({"lang": [lang], "words": [texts], "ids": [ids], "counts": [times], "codes": [codes.astype("<i4").tobytes()]})

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                body = text.encode()
                waiting.setdefault(lang, []).append(body)
                size[lang] = size.get(lang, 0) + len(body) + 1
                if size[lang] >= PORTION:
                    yield portion(lang)
                elif sum(size.values()) >= 4 * PORTION:
                    yield portion(max(size, key=size.get))
        for lang in list(waiting):
            yield portion(lang)

    return split


def prefix_hash(ids: np.ndarray) -> np.ndarray:
    """Hash of each row of word ids; of one word the id itself."""
    out = ids[:, 0].view(np.uint64).copy()
    for k in range(1, ids.shape[1]):
        out = (out ^ out >> np.uint64(31)) * _MIX ^ ids[:, k].view(np.uint64)
    return out.view(np.int64)


def portion_paths(ids: np.ndarray, codes: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different suffixes of two words or more as rows of ids (zero: ended), and how often each is there."""
    kept = has(frequent, ids) if len(ids) else np.zeros(0, bool)
    # Number 0 is no word; a word that is not frequent ends the suffix.
    number = np.r_[0, np.where(kept, np.arange(1, len(ids) + 1), 0)]
    at = np.r_[number[codes + 1], np.zeros(DEPTH, np.int64)].astype(np.uint64)
    columns = [at[k : len(codes) + k] for k in range(DEPTH)]
    for k in range(1, DEPTH):
        columns[k] = np.where(columns[k - 1] > 0, columns[k], 0)
    rows = columns[1] > 0
    high, low = (columns[k][rows] << np.uint64(32) | columns[k + 1][rows] for k in (0, 2))
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    new = np.ones(len(order), bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.r_[first, len(order)])
    known = np.r_[np.int64(0), ids]
    words = [part >> np.uint64(shift) & np.uint64(0xFFFFFFFF) for part in (high[first], low[first]) for shift in (32, 0)]
    return np.stack([known[w.astype(np.int64)] for w in words], axis=1).reshape(-1, DEPTH), times


def subtree(paths: list[np.ndarray], times: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Nodes of the tree over sorted suffixes (a column per word): per depth a row below each node and its count."""
    new = np.zeros(len(times), bool)
    new[:1] = True
    for depth, words in enumerate(paths, 1):
        new[1:] |= words[1:] != words[:-1]
        first = np.flatnonzero(new)
        total = np.add.reduceat(times, first) if len(first) else times
        inside = words[first] != 0
        yield depth, first[inside], total[inside]


def _paths_of(batch: pa.RecordBatch, frequent: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    # Portions are read where they lie in the batch.
    for ids, codes in zip(batch.column("ids"), batch.column("codes"), strict=True):
        paths, times = portion_paths(ids.values.to_numpy(), np.frombuffer(codes.as_buffer(), "<i4"), frequent)
        if len(paths):
            yield paths, times


def _extended(level: int, frequent, heavy: list):
    """Counts of the prefixes of ``level`` words whose shorter prefix has to be extended."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for paths, times in _paths_of(batch, frequent.value):
                rows = paths[:, level - 1] != 0
                for shorter, bits in enumerate(heavy, 1):
                    rows &= has(bits.value, prefix_hash(paths[:, :shorter]))
                paths, own = paths[rows, :level], times[rows]
                if len(paths):
                    # Equal prefixes are neighbours, as the suffixes are sorted by number.
                    new = np.ones(len(paths), bool)
                    new[1:] = (paths[1:] != paths[:-1]).any(axis=1)
                    first = np.flatnonzero(new)
                    out = {c: paths[first, k] for k, c in enumerate(W[:level])}
                    yield pa.RecordBatch.from_pydict(out | {"id": prefix_hash(paths[first]), "n": np.add.reduceat(own, first)})

    return scan


def _cut(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """The values as bytes, a row from each of the places on."""
    ends = (np.r_[first, len(values)] * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def _joined(rows: pa.ChunkedArray, kind: str) -> np.ndarray:
    """The values of all rows of bytes, copied once."""
    return np.concatenate([np.frombuffer(row.as_buffer(), kind) for row in rows])


def _dealt(groups: int, frequent, heavy: list):
    """The suffixes of a portion by group, as sorted columns, which a shuffle compresses well.

    With each suffix goes the length of its prefix; the group is that of the prefix.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for paths, times in _paths_of(batch, frequent.value):
                length, prefix = np.ones(len(paths), np.int8), prefix_hash(paths[:, :1])
                longer = np.ones(len(paths), bool)
                for shorter, bits in enumerate(heavy, 1):
                    longer &= has(bits.value, prefix) if shorter == 1 else has(bits.value, prefix_hash(paths[:, :shorter]))
                    length[longer] = shorter + 1
                    prefix = np.where(longer, prefix_hash(paths[:, : shorter + 1]), prefix)
                mixed = prefix.view(np.uint64) * _MIX >> np.uint64(20)
                group = (mixed % np.uint64(groups)).astype(np.int64)
                # Equal first words are neighbours already and stay so.
                order = np.argsort(group, kind="stable")
                group = group[order]
                first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
                columns = {c: _cut(paths[order, k], first) for k, c in enumerate(W)}
                columns |= {"n": _cut(times[order].astype("<i4"), first), "prefix": _cut(length[order], first)}
                yield pa.RecordBatch.from_pydict({"grp": group[first], **columns})

    return deal


def _nodes(least: int):
    def build(part: pa.Table) -> pa.Table:
        """Frequent nodes of one group, from its prefixes downwards."""
        # One column after the other, as a group has up to about a budget of suffixes and each column many bytes.
        paths = [_joined(part.column(c), "<i8") for c in W]
        order = np.lexsort(paths[::-1])
        for k in range(DEPTH):
            paths[k] = paths[k][order]
        times, length = (_joined(part.column(c), kind)[order] for c, kind in (("n", "<i4"), ("prefix", np.int8)))
        del order
        out = {c: [] for c in [*W, "f"]}
        for depth, row, total in subtree(paths, times.astype(np.int64)):
            kept = (total >= least) & (length[row] <= depth)
            if depth > 1:
                row = row[kept]
                for k, c in enumerate(W):
                    out[c].append(paths[k][row] if k < depth else np.zeros(len(row), np.int64))
                out["f"].append(total[kept])
        return pa.table({c: np.concatenate(x) for c, x in out.items()})

    return build


def counted_phrases(documents: DataFrame, least: int, budget: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words (lang, word, id, f), words of each language (lang, n), frequent phrases (w1 to w4, f).

    Phrases of one word are among them; zeros stand behind shorter ones.
    """
    spark = documents.sparkSession
    docs = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    for seed in count():
        cut = stored(docs.mapInPandas(_portions(seed), _PORTION_ROW), **_IN_PARTS, **{"parquet.block.size": str(HELD)})
        words = cut.select("lang", F.inline(F.arrays_zip("words", "ids", "counts")))
        words = words.select("lang", F.col("words").alias("word"), F.col("ids").alias("id"), F.col("counts").alias("n"))
        words = stored(words.repartition(partitions(spark), "id").groupBy("id", "lang", "word").agg(F.sum("n").alias("f")))
        if words.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            break
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    common = stored(words.where(F.col("f") >= least))
    send = spark.sparkContext.broadcast
    frequent = send(bitmap(common.select("id")))
    total = common.agg(F.sum("f")).first()[0] or 0
    heavy = [send(bitmap(common.where(F.col("f") > budget).select("id")))]
    # Words stay behind: as Python strings they would fill the workers' memory.
    paths = cut.select("ids", "codes")
    none = [F.lit(0).cast("long").alias(c) for c in W]
    phrases = common.select(F.col("id").alias("w1"), *none[1:], "f")
    # A prefix of all words is a leaf: its rows are summed, it needs no longer one.
    for level in range(2, DEPTH):
        columns = ", ".join(f"{c} long" for c in [*W[:level], "id", "n"])
        longer = paths.mapInArrow(_extended(level, frequent, heavy), columns)
        longer = stored(longer.groupBy(*W[:level], "id").agg(F.sum("n").alias("f")).where(F.col("f") >= min(least, budget + 1)))
        above = longer.where(F.col("f") > budget)
        if above.isEmpty():
            break
        heavy.append(send(bitmap(above.select("id"))))
        # Whatever shares a bit with a prefix to be extended is extended too: its count comes from here.
        known = in_bitmap(heavy[-1])
        phrases = phrases.unionByName(longer.where((F.col("f") >= least) & known("id")).select(*W[:level], *none[level:], "f"))
    groups = max(partitions(spark), -(-2 * total // budget))
    dealt = paths.mapInArrow(_dealt(groups, frequent, heavy), "grp long, " + ", ".join(f"{c} binary" for c in [*W, "n", "prefix"]))
    columns = ", ".join(f"{c} long" for c in [*W, "f"])
    found = dealt.groupBy("grp").applyInArrow(_nodes(least), columns)
    return common, sizes, stored(phrases.unionByName(found))


def _phrase(words: list[Column]) -> list[Column]:
    """The key columns of a phrase of the given words."""
    filled = [*words, *[F.lit(0).cast("long")] * (DEPTH - len(words))]
    return [c.alias(n) for c, n in zip(filled, W, strict=True)]


def collocations(documents: DataFrame, least: int = 30, top: int = 2000, covered: int = 80, scale: int = 2_000_000, budget: int = 1_000_000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of two to four words of each language.

    ``documents`` has columns lang and text.  a is the count of the phrase, l and r are the
    counts of its two parts at the lowest-scoring cut, n the words of the language, score
    floor(scale * a / (l + r)).  Phrases with fewer than ``least`` occurrences, and those inside
    a longer frequent one that has at least ``covered`` percent of their occurrences, are left
    out.  ``budget`` is the number of suffixes a group may hold before its prefix is extended.

    A null text is empty, a null language ``und``; empty and blank texts have no words;
    repeated rows count each; a text of any length is read whole; ties go by phrase; an empty
    table gives no rows; other columns are ignored.
    """
    with arrow_batches(documents.sparkSession, HELD):
        common, sizes, phrases = counted_phrases(documents, least, budget)
    words = [F.col(c) for c in W]
    size = sum((F.when(c != 0, 1).otherwise(0) for c in words), F.lit(0))
    own = phrases.where("w2 != 0").withColumn("size", size)
    # Both parts of every cut look up their counts as phrases.
    parts, inside = [], []
    for n in range(2, DEPTH + 1):
        for k in range(1, n):
            for left, part in ((1, words[:k]), (0, words[k:n])):
                parts.append((n, F.struct(F.lit(k).alias("k"), F.lit(left).alias("left"), F.struct(*_phrase(part)).alias("part"))))
        for m in range(2, n):
            inside += [(n, F.struct(*_phrase(words[at : at + m]))) for at in range(n - m + 1)]

    def of_size(entries: list) -> Column:
        return F.filter(F.array(*[F.when(F.col("size") == n, e) for n, e in entries]), lambda e: e.isNotNull())

    cuts = own.select(*W, "f", F.explode(of_size(parts)).alias("cut"))
    cuts = cuts.select(*[F.col(c).alias(f"p{c}") for c in W], F.col("f").alias("a"), "cut.k", "cut.left", "cut.part.*")
    found = spread_join(cuts, phrases, W, "inner", [f"p{c}" for c in W])
    sides = found.groupBy(*[f"p{c}" for c in W], "a", "k").agg(
        F.max(F.when(F.col("left") == 1, F.col("f"))).alias("l"), F.max(F.when(F.col("left") == 0, F.col("f"))).alias("r")
    )
    whole = F.lit(scale).cast("decimal(18,0)") * F.col("a").cast("decimal(19,0)")
    both = F.col("l").cast("decimal(19,0)") + F.col("r").cast("decimal(19,0)")
    sides = sides.withColumn("whole", whole).withColumn("both", both).withColumn("score", F.expr("whole div both"))
    best = sides.groupBy(*[f"p{c}" for c in W], "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    longer = own.where("size > 2").select("f", F.explode(of_size(inside)).alias("part"))
    longer = longer.select("f", "part.*").groupBy(*W).agg(F.max("f").alias("longer"))
    best = best.select(*[F.col(f"p{c}").alias(c) for c in W], "a", "cut.score", "cut.l", "cut.r").join(longer, W, "left")
    free = F.col("longer").isNull() | (100 * F.col("longer").cast("decimal(20,0)") < covered * F.col("a").cast("decimal(20,0)"))
    best = best.where(free).join(common.select(F.col("id").alias("w1"), "lang"), "w1").drop("longer")
    # Words are looked up only for what can be among the first: ties in score and count all stay.
    order = [F.desc("score"), F.desc("a")]
    best = best.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= top).drop("place")
    spelled = best.select("*", F.posexplode(F.array(*words)).alias("at", "id")).where("id != 0")
    spelled = spread_join(spelled, common.select("id", "word"), ["id"], "inner", W)
    spelled = spelled.groupBy("lang", *W, "a", "l", "r", "score").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    spelled = spelled.withColumn("phrase", F.array_join(F.transform("words", lambda x: x["word"]), " "))
    ranked = spelled.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))).where(F.col("rank") <= top)
    out = ranked.join(sizes, "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
