"""Token ids of whole texts from a public tokenizer's file."""

from __future__ import annotations

import json
from array import array
from codecs import charmap_decode
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words of a generation: beyond it the words met since then are the older ones, those before them go.
CACHED_WORDS = 400_000
# Texts whose words are looked up together, in bytes.
GROUP_BYTES = 4 << 20
_TAIL = b".,;:!?#$%&*|<>()"
_LETTERS = frozenset(range(ord("a"), ord("z") + 1))
_encoders: dict[str, Encoder] = {}


def byte_characters() -> dict[int, str]:
    """The printable character that byte-level tokenizers write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}


_BYTES = byte_characters()
_SPELLED = "".join(_BYTES[b] for b in range(256))


def encoder(path: str) -> Encoder:
    """The process's encoder for a file, with the words it has met so far."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    """ids(texts) as the library's encode_batch gives them, without special tokens added.

    A tokenizer that drops white space treats each run between blanks alone, so the different
    runs of a group of texts are encoded once and remembered, and the ids are put together
    by number of run; any other tokenizer gets whole texts.  Only the six ASCII blanks
    separate runs.  A run that ends in symbols after a letter a-z is looked up in two
    parts, as such a tokenizer always cuts there.  All else is left to the library.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.by_word = drops_blanks(json.load(f))
        self.known: dict[bytes, bytes] = {b"": b""}
        self.older: dict[bytes, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _groups(self, texts: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
        """Per group of texts: where the runs of each text end, the number of each run, ids by number."""
        at = 0
        while at < len(texts):
            own, size = [], 0
            while at < len(texts) and size < GROUP_BYTES:
                text = texts[at]
                # The tokenizer lower-cases too; names of special tokens must stay as they are.
                own.append(text if b"<|" in text else text.lower())
                size += len(text)
                at += 1
            runs = pc.ascii_split_whitespace(pa.array(own, pa.large_string()))
            numbered = runs.values.dictionary_encode()
            words = numbered.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
            if len(self.known) > CACHED_WORDS:
                self.known, self.older = {b"": b""}, self.known
            ids = list(map(self.known.get, words))
            missing = [n for n, found in enumerate(ids) if found is None]
            self._learn([words[n] for n in missing])
            for n in missing:
                ids[n] = self.known[words[n]]
            yield runs.offsets.to_numpy()[1:], numbered.indices.to_numpy(), ids

    def counts(self, texts: Sequence[bytes]) -> np.ndarray:
        """Number of ids of each UTF-8 text."""
        if not self.by_word:
            return np.array([len(x) // 4 for x in self._encode([t.decode() for t in texts])], np.int64)
        out = [np.zeros(0, np.int64)]
        for ends, runs, ids in self._groups(texts):
            size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            out.append(np.diff(np.r_[0, np.cumsum(size[runs])][np.r_[0, ends]]))
        return np.concatenate(out)

    def ids(self, texts: Sequence[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each UTF-8 text."""
        if not self.by_word:
            return self._encode([t.decode() for t in texts])
        out = []
        for ends, runs, ids in self._groups(texts):
            size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            first = np.cumsum(size) - size
            size, first = size[runs], first[runs]
            stop = np.cumsum(size)
            total = int(stop[-1]) if len(stop) else 0
            places = np.arange(total) + np.repeat(first - (stop - size), size)
            data = np.frombuffer(b"".join(ids), "<u4")[places].tobytes()
            cuts = (4 * np.r_[0, stop][np.r_[0, ends]]).tolist()
            out += [data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return out

    def _pieces(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word; for letters up to U+00FF the merges alone are left to do.

        Such letters have one normal form and one lower-case letter each, and a run of them is
        one piece for the tokenizer.
        """
        out, others = [], []
        tokenize = self.tokenizer.model.tokenize
        for n, w in enumerate(words):
            text = w.decode()
            if text.isalpha() and (text.isascii() or max(text) <= "\xff"):
                # Texts with names of special tokens come as they are.
                text = text.lower()
                spelled = text if text.isascii() else charmap_decode(text.encode(), "strict", _SPELLED)[0]
                out.append(array("I", [t.id for t in tokenize(spelled)]).tobytes())
            else:
                others.append(n)
                out.append(b"")
        for n, ids in zip(others, self._encode([words[n].decode() for n in others]), strict=True):
            out[n] = ids
        return out

    def _learn(self, new: list[bytes]) -> None:
        """Adds words to those known: older ones as they are, the others by their parts."""
        known, older, whole, cut = self.known, self.older, set(), []
        for w in new:
            found = older.get(w)
            if found is not None:
                known[w] = found
                continue
            stem = w.rstrip(_TAIL) if w[-1] in _TAIL else w
            if 0 < len(stem) < len(w) and stem[-1] in _LETTERS and b"<|" not in w:
                tail = w[len(stem) :]
                cut.append((w, stem, tail))
                whole.add(stem)
                whole.add(tail)
            else:
                whole.add(w)
        missing = []
        for w in whole:
            if w not in known:
                found = older.get(w)
                if found is None:
                    missing.append(w)
                else:
                    known[w] = found
        known.update(zip(missing, self._pieces(missing), strict=True))
        for w, stem, tail in cut:
            known[w] = known[stem] + known[tail]


def drops_blanks(spec: dict) -> bool:
    """Whether the tokenizer splits at blanks before anything else and drops them."""
    parts = spec.get("pre_tokenizer") or {}
    first = (parts.get("pretokenizers") or [parts])[0]
    normalizers = spec.get("normalizer") or {}
    kinds = {n.get("type") for n in normalizers.get("normalizers", [normalizers])}
    kept = "[^\\s\\p{L}\\p{N}]+"
    pattern = (first.get("pattern") or {}).get("Regex", "")
    removed = first.get("behavior") == "Removed" and first.get("invert") is True
    plain = all(not t["lstrip"] and not t["rstrip"] and not t["single_word"] for t in spec.get("added_tokens", []))
    # Every alternative of the pattern but the last is letters, digits or an apostrophe form.
    local = pattern.endswith(kept) and "\\s" not in pattern[: -len(kept)]
    merges = spec.get("model", {}).get("type") == "BPE" and parts.get("pretokenizers", [{}])[-1].get("type") == "ByteLevel"
    return removed and local and plain and merges and kinds <= {"NFC", "Replace", "Lowercase"}
