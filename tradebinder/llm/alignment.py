"""Alignment of the tokens of two tokenizers by coalescing their byte intervals.

Every token is an interval of the bytes of a text.  The intervals of both tokenizers are sorted
by start; a group ends where a start reaches the largest end so far.  Inside a group each pair
of overlapping intervals is a link.  Texts are laid end to end, so that a portion of many texts
is aligned by the same few array operations as one.

How many documents hold a pair of ids linked is counted over the corpus in Spark.  The counts
go to all tasks where they are few enough (``send_pairs``); otherwise every document's pairs
are joined with them, which gives the same sums.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradebinder.llm.common import stored
from tradebinder.llm.tokens import byte_characters
from tradebinder.operators.lookup import spread_join

# Bytes and number of texts that are aligned together.
PORTION = 2 << 20
PORTION_TEXTS = 4096
# Pairs whose counts may be sent to every task, 16 bytes each.
SEND_PAIRS = 4_000_000
# Letters that every library's character classes know alike; other texts go to the slower one.
_OLD = regex.compile(r"[\x00-ɏ‐-‧€]*")
_LONG_RUN = regex.compile(r"[^\s]{2000}|\s{2000}")
# The pre-tokenizer pattern that a byte-level tokenizer implies (a fixed value).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_sides: dict[str, object] = {}


class ByteLevel:
    """A byte-level tokenizer's file; special tokens are ordinary text, a blank stands in front."""

    lead = b" "

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = {c: b for b, c in byte_characters().items()}
        vocabulary = spec["model"]["vocab"]
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, number in vocabulary.items():
            if all(c in back for c in entry):
                self.bytes[number] = bytes(map(back.__getitem__, entry))
        for token in spec.get("added_tokens", []):
            if token["id"] < len(self.bytes):
                self.bytes[token["id"]] = b""
        self.fast = self._ranked(spec)

    def _ranked(self, spec: dict):
        """The same merges by rank, much faster; None unless the ids are in the order of the merges."""
        import tiktoken

        parts, model = spec.get("pre_tokenizer") or {}, spec["model"]
        usual = parts.get("type") == "ByteLevel" and parts.get("use_regex", True) and not parts.get("add_prefix_space")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model.get("merges", [])]
        numbers = [model["vocab"].get(a + b, -1) for a, b in merges]
        plain = not spec.get("normalizer") and not model.get("ignore_merges") and not model.get("dropout")
        in_order = all(x < y for x, y in zip(numbers, numbers[1:], strict=False)) and (not numbers or numbers[0] == 256)
        if not (usual and plain and in_order):
            return None
        ranks = {b: n for n, b in enumerate(self.bytes) if b}
        return tiktoken.Encoding("byte-level", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        slow = []
        for n, text in enumerate(texts):
            if self.fast and _OLD.fullmatch(text) and not _LONG_RUN.search(text):
                out[n] = np.array(self.fast.encode_ordinary(" " + text), np.int64)
            else:
                slow.append(n)
        found = self.tokenizer.encode_batch_fast([" " + texts[n] for n in slow], add_special_tokens=False) if slow else []
        for n, e in zip(slow, found, strict=True):
            out[n] = np.array(e.ids, np.int64)
        return out


class Pieces:
    """A model of pieces, which puts a blank in front itself."""

    lead = b" "

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(n) for n in range(self.model.piece_size())]

    def _bytes(self, number: int) -> bytes:
        if self.model.is_control(number) or self.model.is_unknown(number):
            return b""
        piece = self.model.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(number) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)] if texts else []


def side(path: str):
    """The process's tokenizer for a file."""
    if path not in _sides:
        _sides[path] = Pieces(path) if path.endswith(".model") else ByteLevel(path)
    return _sides[path]


def groups(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Group number of every interval, in order of the starts."""
    order = np.lexsort((ends, starts))
    reached = np.maximum.accumulate(ends[order])
    new = np.zeros(len(order), np.int64)
    new[1:] = starts[order][1:] >= reached[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def overlaps(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the intervals of a and b that share a byte; both are sorted and without gaps."""
    first = np.searchsorted(ends_b, starts_a, "right")
    n = np.searchsorted(starts_b, ends_a, "left") - first
    a = np.repeat(np.arange(len(starts_a)), n)
    return a, np.arange(len(a)) + np.repeat(first - (np.cumsum(n) - n), n)


class Aligner:
    """Both tokenizers, the lengths of their tokens and the strings of their ids."""

    def __init__(self, a: str, b: str) -> None:
        self.sides = (side(a), side(b))
        self.sizes = [np.array(list(map(len, s.bytes)), np.int64) for s in self.sides]
        self.span = len(self.sides[1].bytes)
        if len(self.sides[0].bytes) * self.span > 1 << 44:
            raise ValueError("the vocabularies are too large for one number per pair")
        most = max(len(s.bytes) for s in self.sides)
        self.names = np.array([f"{n}{mark}" for mark in (",", "|", ";", "") for n in range(most)], object)
        self.most = most

    def encoded(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both tokenizers; None where the bytes of either differ from blank and text, or a text is empty."""
        out = []
        for text, a, b in zip(texts, *(s.encode(texts) for s in self.sides), strict=True):
            same = bool(text) and all(
                b"".join(map(s.bytes.__getitem__, ids.tolist())) == s.lead + text.encode() for s, ids in zip(self.sides, (a, b), strict=True)
            )
            out.append((a, b) if same else None)
        return out

    def rows(self, texts: list[str]) -> pd.DataFrame:
        """n_a, n_b, n_groups, n_links, groups_sha256, pairs and times (different links and their numbers) of each text."""
        found = self.encoded(texts)
        kept = [n for n, ids in enumerate(found) if ids is not None]
        counts = np.zeros((len(texts), 4), np.int64)
        digest, pairs, times = [""] * len(texts), [b""] * len(texts), [b""] * len(texts)
        if kept:
            n_a, n_b = (np.array([len(found[n][k]) for n in kept]) for k in (0, 1))
            a, b = (np.concatenate([found[n][k] for n in kept]) for k in (0, 1))
            ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
            starts_a, starts_b = ends_a - self.sizes[0][a], ends_b - self.sizes[1][b]
            group = groups(np.r_[starts_a, starts_b], np.r_[ends_a, ends_b])
            left, right = overlaps(starts_a, ends_a, starts_b, ends_b)
            text = np.repeat(np.arange(len(kept)), n_a)
            text_b = np.repeat(np.arange(len(kept)), n_b)
            # No group reaches into the next text, as both tokenizers end there.
            last = np.r_[0, group[np.cumsum(n_a) - 1] + 1]
            counts[kept] = np.stack([n_a, n_b, np.diff(last), np.bincount(text[left], minlength=len(kept))], 1)
            for n, d in zip(kept, self._digests(a, b, group, n_a + n_b, np.r_[text, text_b]), strict=True):
                digest[n] = d
            key, n = np.unique(text[left] << 44 | a[left] * self.span + b[right], return_counts=True)
            cuts = np.searchsorted(key, np.arange(len(kept) + 1) << 44)
            key &= (1 << 44) - 1
            for k, at in enumerate(kept):
                pairs[at] = key[cuts[k] : cuts[k + 1]].astype("<u8").tobytes()
                times[at] = n[cuts[k] : cuts[k + 1]].astype("<u4").tobytes()
        out = pd.DataFrame(counts, columns=["n_a", "n_b", "n_groups", "n_links"])
        out["groups_sha256"], out["pairs"], out["times"] = digest, pairs, times
        return out

    def _digests(self, a: np.ndarray, b: np.ndarray, group: np.ndarray, sizes: np.ndarray, text: np.ndarray) -> Iterator[str]:
        """SHA-256 of a1,a2|b1;a3|b2 for each text."""
        place = group * 2
        place[len(a) :] += 1
        order = np.argsort(place, kind="stable")
        place, text = place[order], text[order]
        # Mark behind a token: comma in its half of a group, bar between the halves, semicolon between groups.
        step = np.minimum(np.diff(place >> 1) * 2 + (np.diff(place) == 1), 2)
        mark = np.r_[np.where(step == 0, 0, np.where(np.diff(place >> 1) == 0, 1, 2)), 3]
        ends = np.cumsum(sizes)
        mark[ends - 1] = 3
        names = self.names[mark * self.most + np.r_[a, b][order]].tolist()
        for end, size in zip(ends.tolist(), sizes.tolist(), strict=True):
            yield hashlib.sha256("".join(names[end - size : end]).encode()).hexdigest()


_ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def _aligned(a: str, b: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = _aligners.setdefault((a, b), None) or Aligner(a, b)
        _aligners[a, b] = aligner
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and size < PORTION and end - at < PORTION_TEXTS:
                    size += len(texts[end])
                    end += 1
                out = aligner.rows(texts[at:end])
                out.insert(0, "row", np.arange(row, row + end - at))
                out.insert(1, "doc_id", batch["doc_id"].iloc[at:end].to_numpy())
                yield out
                row += end - at
                at = end

    return run


_aligners: dict = {}


def _documents_of_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many documents of a batch hold each pair."""
    for batch in batches:
        pair, n = np.unique(np.frombuffer(b"".join(batch["pairs"]), "<u8"), return_counts=True)
        yield pd.DataFrame({"pair": pair.astype(np.int64), "documents": n})


def _single_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = np.repeat(batch["row"].to_numpy(), [len(p) // 8 for p in batch["pairs"]])
        pair = np.frombuffer(b"".join(batch["pairs"]), "<u8").astype(np.int64)
        yield pd.DataFrame({"row": rows, "pair": pair, "times": np.frombuffer(b"".join(batch["times"]), "<u4").astype(np.int64)})


def _summed(sent):
    """n_best and count_sum of every document from the counts of all pairs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, documents, best = sent.value
        for batch in batches:
            sizes = np.array([len(p) // 8 for p in batch["pairs"]])
            at = np.searchsorted(known, np.frombuffer(b"".join(batch["pairs"]), "<u8").astype(np.int64))
            times = np.frombuffer(b"".join(batch["times"]), "<u4").astype(np.int64)
            cuts = np.r_[0, np.cumsum(sizes)]
            out = batch.drop(columns=["row", "pairs", "times"])
            for name, value in (("n_best", times * best[at]), ("count_sum", times * documents[at])):
                total = np.r_[0, np.cumsum(value)]
                out[name] = np.diff(total[cuts])
            yield out

    return run


def align_documents(documents: DataFrame, a: str, b: str, send_pairs: int = SEND_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of (doc_id, text).

    ``a`` is the file of a byte-level tokenizer, ``b`` that of a model of pieces.  A pair's
    count is the number of rows that hold it linked; n_best counts the links whose pair has the
    highest count of its a id, count_sum adds the counts of all links.

    Null and empty texts, and texts that a tokenizer does not give back byte for byte, have no
    tokens: zeros and an empty digest.  Repeated rows count as documents each; a null doc_id is
    kept; a text of any length is aligned whole; an empty table gives no rows; other columns
    are ignored.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long"), "text")
    aligned = stored(docs.mapInPandas(_aligned(a, b), _ALIGNED))
    counted = aligned.select("pairs").mapInPandas(_documents_of_pairs, "pair long, documents long")
    counted = stored(counted.groupBy("pair").agg(F.sum("documents").alias("documents")))
    span = len(side(b).bytes)
    first = F.expr(f"pair div {span}")
    # One row per id of a: never more than its vocabulary.
    most = counted.groupBy(first.alias("a_id")).agg(F.max("documents").alias("most"))
    counts = counted.withColumn("a_id", first).join(F.broadcast(most), "a_id")
    counts = counts.select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))
    shown = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if counted.count() <= send_pairs:
        table = counts.orderBy("pair").toArrow()
        columns = [table[c].to_numpy() for c in ("pair", "documents")]
        sent = spark.sparkContext.broadcast((*columns, table["best"].to_numpy().astype(bool)))
        typed = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
        return aligned.mapInPandas(_summed(sent), typed).select(shown)
    single = aligned.select("row", "pairs", "times").mapInPandas(_single_pairs, "row long, pair long, times long")
    met = spread_join(single, counts, ["pair"], "inner", ["row"])
    n_best, total = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)), F.sum(F.col("times") * F.col("documents"))
    sums = met.groupBy("row").agg(n_best.alias("n_best"), total.alias("count_sum"))
    out = aligned.drop("pairs", "times").join(sums, "row", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_best", "count_sum")}).select(shown)
