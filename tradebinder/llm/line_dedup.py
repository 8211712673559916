"""Near-duplicate lines across documents: shared keys, SimHash, edit similarity.

A normalised line has a 128-bit SimHash of its byte 8-grams (3-grams where it is short) and
eight keys, each made of two smallest hashes of such grams (one where it is very short).  Lines
that share a key meet in a cell; of these, lines of fitting length whose SimHashes are close may
be similar, under the first key they share only.  In a cell a spanning forest of such pairs is
compared by edit distance first; only where one of its pairs is not similar, the pairs that are
not connected by then are compared, too.  So a group of n copies costs about n comparisons.

The keys stand where blocks of the SimHash would: of the pairs with edit similarity 0.8, 90 %
are within 30 and 99 % within 40 of the 128 bits, but a pigeonhole over 40 bits leaves blocks of
three bits, which nearly all lines share.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradebinder.llm.bitmaps import bitmap, has
from tradebinder.llm.blocks import Groups
from tradebinder.llm.common import BROADCAST_ROWS, free_name, partitions, stored
from tradebinder.llm.components import connected_components, joined_components
from tradebinder.operators.lookup import by_shuffle, spread_join

# SimHash bits (of 128) that lines from so many characters on may differ in and be compared: 98 %
# of the similar ones differ in fewer, 95 % of the others in more.
RADIUS = ((0, 128), (32, 54), (64, 38))
# Pairs that are so many bits closer are the first to connect a group.
CLOSER = 16
CHUNK = 2048
CELL = ["part", "i", "j"]
# Keys of a line, in two sets: below so many bytes a key is one smallest hash, from there on two;
# from the second limit on the grams are long.  The limits of the sets are so far apart that
# lines similar to 0.8 agree in the kind of one of them.
BANDS = ((16, 32, 5), (24, 50, 3))
# Bytes of a gram, and whether one hash is a key.
KINDS = ((3, True), (3, False), (8, False))
KEYS = [f"k{n}" for n in range(sum(n for *_, n in BANDS))]
MARKS = {"size": "int", "low": "long", "high": "long", **dict.fromkeys(KEYS, "int")}
# Bytes of lines whose grams are hashed at a time.
GRAM_BYTES = 1 << 18
# Lines that are handed on together, at least.
PART_LINES = 1 << 16
# From so many characters on, the parts between anchors are compared first.
LONG_LINE = 640
# Pairs that are chosen and that are compared at a time, how many per word of 64 bits are quicker so
# than one by one, up to which length, and the words that their table may take.
TOGETHER, AT_A_TIME, FEW, WIDE, TABLE = 512, 1024, 16, 2560, 1 << 22
# Columns after which pairs that need more edits than allowed are left out.
EACH = 32
# Characters that must agree behind an edit, and how far away they are looked for.
BRIDGE, SPAN = 12, 256
# Pairs of two groups that are compared before it is seen whether they are one by then; each time twice as many.
AT_ONCE = 4
# While few of the pairs turn out similar, so many wait for each other, of so many characters.
WAITING, WAITING_CHARS = 32 * TOGETHER, 1 << 23
# Pairs that come to wait at a time.
PORTION = 256
# Cells of more lines are searched in blocks of so many lines, sorted by length, by so many others.
SMALL_CELL, BLOCK, ACROSS = 64, 64, 1024
# Pairs of lines below so many characters must first agree in the counts of their characters and of
# pairs of characters, each in so many buckets.
COUNTED, BUCKETS = 64, 128
_ODD = [np.uint32(xxhash.xxh32_intdigest(b"gram", n) | 1) for n in range(2 * len(KEYS))]
# The lowest bit of each of eight counters of a byte.
_ONES = np.uint64(0x0101010101010101)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def sketches(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of normalised lines, none of them empty: 32-bit keys (one row per key), characters, SimHashes (two rows of 64 bits)."""
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    data = np.frombuffer(b"".join(lines), np.uint8)
    chars = np.add.reduceat((data & 0xC0) != 0x80, np.cumsum(size) - size, dtype=np.int64)
    keys, prints = np.zeros((len(KEYS), len(lines)), np.uint32), np.zeros((len(lines), 2), np.int64)
    at, before = 0, np.full(len(lines), -1)
    for *limits, bands in BANDS:
        kind = sum((size >= limit).astype(int) for limit in limits)
        own = slice(at, at + bands) if at else slice(None)
        for number in range(len(limits) + 1):
            # In the second set only the lines between the limits differ from the first.
            rows = np.flatnonzero((kind == number) & (before != number))
            if len(rows):
                found, own_prints = _marks([lines[k] for k in rows], *KINDS[number])
                keys[own, rows] = found[own]
                if not at:
                    prints[rows] = own_prints
        at, before = at + bands, kind
    return keys.view(np.int32), chars, prints.T


def _marks(lines: list[bytes], gram: int, single: bool) -> tuple[np.ndarray, np.ndarray]:
    """All keys and both SimHashes from grams of one size; zeros fill a line that is shorter."""
    lines = [line.ljust(gram, b"\0") for line in lines]
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    data = b"".join(lines) + bytes(8)
    n = int(size.sum()) - gram + 1
    hashes = np.ndarray((n,), "<u8", data, strides=(1,)) & np.uint64((1 << 8 * gram) - 1)
    hashes = _mixed(hashes)
    first = np.cumsum(size) - size
    # Every second run is the grams that reach into the next line.
    runs = np.stack([first, first + size - gram + 1], axis=1).reshape(-1)[:-1]
    half = (hashes >> np.uint64(32)).astype(np.uint32)
    keys = []
    for k in range(0, len(_ODD), 2):
        # Products with an odd number are permutations of the 32-bit hashes.
        a, b = (np.minimum.reduceat(half * odd, runs)[::2].astype(np.uint64) for odd in _ODD[k : k + 2])
        b = np.zeros_like(b) if single else b
        # Lines of different kinds never share a key.
        keys.append((_mixed((a << np.uint64(32) | b) ^ np.uint64(2 * gram + single)) >> np.uint64(32)).astype(np.uint32))
    second = (hashes ^ hashes >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15)
    return np.stack(keys), np.stack([_majority(h, first, size - gram + 1) for h in (hashes, second)], axis=1)


def _majority(hashes: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Signed 64-bit SimHash of each run of n hashes from ``first`` on: the bits set in over half of them.

    The last run ends with the hashes.
    """
    # A counter of one byte holds 255; longer runs are added up in blocks.
    blocks = -(-n // 255)
    head = np.cumsum(blocks) - blocks
    begin = np.repeat(first, blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(head, blocks))
    runs = np.stack([begin, np.minimum(begin + 255, np.repeat(first + n, blocks))], axis=1).reshape(-1)[:-1]
    # Counter b of lane k counts bit 8 * b + k.
    lanes = [np.add.reduceat(hashes >> np.uint64(k) & _ONES, runs)[::2] for k in range(8)]
    ones = np.stack(lanes, axis=1).view(np.uint8).reshape(-1, 8, 8).transpose(0, 2, 1).reshape(-1, 64)
    ones = np.add.reduceat(ones, head, axis=0, dtype=np.int32)
    return np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view("<i8").reshape(-1)


def _lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """doc_id, tie, position, node (hash of the normalised line) and marks of every line that is not blank."""
    for batch in batches:
        doc, position, number, lines, found, held = [], [], [], [], [], 0
        # Of lines that are met again in a part, one is sketched.
        met: dict[bytes, int] = {}

        def sketched() -> None:
            nodes = np.fromiter((xxhash.xxh64_intdigest(x) for x in lines), np.uint64, len(lines))  # noqa: B023
            found.append((nodes, *sketches(lines)))  # noqa: B023
            lines.clear()  # noqa: B023

        def part() -> pd.DataFrame:
            nodes, keys, chars, prints = (np.concatenate(x, axis=-1) for x in zip(*found, strict=True))  # noqa: B023
            marks = {"size": chars.astype(np.int32), "low": prints[0], "high": prints[1], **dict(zip(KEYS, keys, strict=True))}
            own, which = np.array(doc), np.array(number)  # noqa: B023
            out = {c: batch[c].to_numpy()[own] for c in ("doc_id", "tie")}  # noqa: B023
            out |= {"position": np.array(position, np.int32), "node": nodes.view(np.int64)[which]}  # noqa: B023
            return pd.DataFrame({**out, **{c: x[which] for c, x in marks.items()}})

        for k, text in enumerate(batch["text"]):
            for at, line in enumerate(text.lower().encode().split(b"\n")):
                line = b" ".join(line.split())
                if line:
                    doc.append(k)
                    position.append(at)
                    n = met.get(line)
                    if n is None:
                        n = met[line] = len(met)
                        lines.append(line)
                        held += len(line)
                    number.append(n)
                    if held >= GRAM_BYTES:
                        sketched()
                        held = 0
            if len(found) >= 32 or len(doc) >= PART_LINES:
                if lines:
                    sketched()
                    held = 0
                yield part()
                doc, position, number, found = [], [], [], []
                met.clear()
        if lines:
            sketched()
        if found:
            yield part()


def normalized(line: str) -> str:
    """Lower-cased words between the six ASCII blanks, one blank apart."""
    return b" ".join(line.lower().encode().split()).decode()


def trimmed(a: str, b: str) -> tuple[str, str]:
    """Both without their common start and end, which no edit needs to touch."""
    for _ in range(2):
        low, high = 0, min(len(a), len(b))
        while low < high:
            middle = (low + high + 1) // 2
            if a[low:middle] == b[low:middle]:
                low = middle
            else:
                high = middle - 1
        a, b = a[low:][::-1], b[low:][::-1]
    return a, b


def edit_distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance, or most + 1 if it is larger (Myers' bit vectors in one integer)."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    a, b = trimmed(a, b)
    if not a or not b:
        return min(len(a) + len(b), most + 1)
    if len(a) < len(b):
        a, b = b, a
    places: dict[str, int] = {}
    for k, c in enumerate(b):
        places[c] = places.get(c, 0) | 1 << k
    full, last = (1 << len(b)) - 1, 1 << (len(b) - 1)
    up, down, distance = full, 0, len(b)
    for seen, c in enumerate(a, 1):
        eq = places.get(c, 0)
        either = eq | down
        across = (((eq & up) + up) ^ up) | eq
        plus = down | (full & ~(across | up))
        minus = up & across
        distance += bool(plus & last) - bool(minus & last)
        if distance - (len(a) - seen) > most:
            return most + 1
        plus = (plus << 1 | 1) & full
        up = (minus << 1 & full) | (full & ~(either | plus))
        down = plus & either
    return min(distance, most + 1)


def edit_distances(pairs: list[tuple[str, str]], most: np.ndarray | None = None) -> np.ndarray:
    """Levenshtein distances of many pairs of similar size, column by column over all of them.

    The bit vectors of ``edit_distance`` in words of 64 bits; what a word carries over goes to
    the next.  With ``most`` only the words are computed that a path of so many edits can
    touch: up to most a distance is exact, above it no less than the true one.  Pairs of which a
    column shows that they need more, or that have ended, are left out from there on.
    """
    rows = np.arange(len(pairs))
    shorter, longer = zip(*(sorted(p, key=len) for p in pairs), strict=True)
    sizes = [np.array([len(t) for t in side]) for side in (shorter, longer)]
    points = [np.frombuffer("".join(side).encode("utf-32-le", "surrogatepass"), "<u4") for side in (shorter, longer)]
    number = np.zeros(int(max(p.max(initial=0) for p in points)) + 1, np.int64)
    for p in points:
        number[p] = 1
    alphabet = int(number.sum()) + 1
    words = max(1, -(-int(sizes[0].max(initial=0)) // 64))
    if len(pairs) > 1 and len(pairs) * alphabet * words > TABLE:
        half = len(pairs) // 2
        return np.concatenate([edit_distances(pairs[own], None if most is None else most[own]) for own in (slice(half), slice(half, None))])
    number = np.cumsum(number) * number
    table = []
    for p, size in zip(points, sizes, strict=True):
        cells = np.zeros((len(pairs), int(size.max(initial=0))), np.int32)
        cells[np.arange(cells.shape[1]) < size[:, None]] = number[p]
        table.append(cells)
    pattern, text = table
    equal = np.zeros((len(pairs), alphabet, words), np.uint64)
    for i in range(pattern.shape[1]):
        equal[rows, pattern[:, i], i >> 6] |= np.uint64(1 << (i & 63))
    equal[:, 0] = 0
    reach = 64 * words + text.shape[1] if most is None else int(max(most.max(), (sizes[1] - sizes[0]).max()))
    up = np.full((words, len(pairs)), ~np.uint64(0))
    down = np.zeros((words, len(pairs)), np.uint64)
    last_word, last_bit = np.maximum(sizes[0] - 1, 0) >> 6, (np.maximum(sizes[0] - 1, 0) & 63).astype(np.uint64)
    one, top = np.uint64(1), np.uint64(63)
    # The distance in the last row of the lowest word reached so far; a word is entered by deletions only.
    distance, lowest, followed = np.zeros(len(pairs), np.int64), -1, None
    short, long, out = sizes[0], sizes[1], np.maximum(sizes[0], sizes[1])
    for j in range(text.shape[1]):
        if most is not None and j and j % EACH == 0:
            # No way is shorter than from that row up to any other and from there to the end.
            least = distance - (np.minimum(short, 64 * (lowest + 1)) - j) + short - long
            ended = (j >= long) | (short == 0)
            kept = np.flatnonzero((least <= most) & ~ended)
            if 4 * len(kept) <= 3 * len(rows):
                out[rows[ended]] = np.where(short == 0, long, distance)[ended]
                rows, text, most, short, long, distance, last_word, last_bit = (
                    x[kept] for x in (rows, text, most, short, long, distance, last_word, last_bit)
                )
                up, down, followed = up[:, kept], down[:, kept], None
        if not len(rows):
            break
        while lowest < min(words - 1, (j + reach) >> 6):
            lowest += 1
            distance += np.clip(short - 64 * lowest, 0, 64)
            followed = None
        if followed is None:
            followed = np.minimum(last_word, lowest)
            in_word = [np.flatnonzero(followed == w) for w in range(lowest + 1)]
            bits = np.where(last_word <= lowest, last_bit, top)
        lower = max(0, j - reach) >> 6
        eq_all = equal[rows, text[:, j], lower : lowest + 1]
        plus_in, minus_in = np.full(len(rows), one), np.zeros(len(rows), np.uint64)
        active = j < long
        for w in range(lower, lowest + 1):
            pv, mv = up[w], down[w]
            eq = eq_all[:, w - lower]
            either = eq | mv
            eq = eq | minus_in
            across = (((eq & pv) + pv) ^ pv) | eq
            plus, minus = mv | ~(across | pv), pv & across
            own = in_word[w]
            if len(own):
                bit = bits[own]
                step = (plus[own] >> bit & one).astype(np.int64) - (minus[own] >> bit & one).astype(np.int64)
                distance[own] += step * active[own]
            plus_out, minus_out = plus >> top, minus >> top
            plus, minus = plus << one | plus_in, minus << one | minus_in
            up[w], down[w] = minus | ~(either | plus), plus & either
            plus_in, minus_in = plus_out, minus_out
    out[rows] = np.where(short == 0, long, distance)
    return out


def bridged_distance(a: str, b: str, most: int) -> int:
    """No less than the edit distance, read off one way through both; more than most where it finds none.

    From one difference it goes on at the next characters of ``a`` that ``b`` has nearby.
    """
    x = y = total = 0
    while total <= most:
        low, high = 0, min(len(a) - x, len(b) - y)
        while low < high:
            middle = (low + high + 1) // 2
            if a[x + low : x + middle] == b[y + low : y + middle]:
                low = middle
            else:
                high = middle - 1
        x, y = x + low, y + low
        if max(len(a) - x, len(b) - y) <= most - total:
            return total + max(len(a) - x, len(b) - y)
        for k in range(x, min(x + SPAN, len(a) - BRIDGE + 1), BRIDGE // 2):
            at = b.find(a[k : k + BRIDGE], y, y + SPAN + BRIDGE)
            if at >= 0:
                total += edit_distance(a[x:k], b[y:at], SPAN)
                x, y = k, at
                break
        else:
            return most + 1
    return total


def anchored_distance(a: str, b: str, gram: int = 32) -> int:
    """No less than the edit distance: the parts between common rare grams, taken in order, are edited one by one."""
    place = {}
    for k in range(len(b) - gram + 1):
        g = b[k : k + gram]
        place[g] = -1 if g in place else k
    seen: dict[str, int] = {}
    for k in range(len(a) - gram + 1):
        g = a[k : k + gram]
        if place.get(g, -1) >= 0:
            seen[g] = -1 if g in seen else k
    met = [(k, place[g]) for g, k in seen.items() if k >= 0]
    # The longest run of anchors that rise in both.
    ends, at, before = [], [], []
    for n, (_, y) in enumerate(met):
        k = bisect_left(ends, y)
        ends[k:], at[k:] = [y], [*at[k : k], n]
        before.append(at[k - 1] if k else -1)
    chain, n = [], at[-1] if at else -1
    while n >= 0:
        chain.append(met[n])
        n = before[n]
    total = x = y = 0
    for i, j in [*reversed(chain), (len(a), len(b))]:
        if i >= x and j >= y:
            left, right = a[x:i], b[y:j]
            small = max(len(left), len(right)) <= 2 * LONG_LINE
            total += edit_distance(left, right, len(left) + len(right)) if small else max(len(left), len(right))
            x, y = min(i + gram, len(a)), min(j + gram, len(b))
    return total


def similar(a: str, b: str, similarity: float) -> bool:
    """Whether 1 - distance / longer length reaches the similarity."""
    most = allowed(max(len(a), len(b)), similarity)
    if abs(len(a) - len(b)) > most:
        return False
    a, b = trimmed(a, b)
    if max(len(a), len(b)) <= most or max(len(a), len(b)) >= LONG_LINE and anchored_distance(a, b) <= most:
        return True
    return edit_distance(a, b, most) <= most


def allowed(longer: int, similarity: float) -> int:
    """Edits that leave a line of this length similar."""
    return int((1 - similarity) * longer + 1e-9)


def similar_pairs(pairs: list[tuple[str, str]], similarity: float, likely: bool = True, may: np.ndarray | None = None) -> np.ndarray:
    """``similar`` of many pairs; where that is ``likely``, a bound settles most long ones first.

    Pairs that are known to need too many edits are marked in ``may`` by false.
    """
    out = np.zeros(len(pairs), bool)
    if may is not None:
        chosen = np.flatnonzero(may)
        pairs, whole, out = [pairs[k] for k in chosen.tolist()], out, np.zeros(len(chosen), bool)
    most = np.array([allowed(max(len(a), len(b)), similarity) for a, b in pairs], np.int64)
    cores = [trimmed(a, b) for a, b in pairs]
    longer = np.array([max(len(a), len(b)) for a, b in cores], np.int64)
    fits = np.array([abs(len(a) - len(b)) for a, b in cores], np.int64) <= most
    out[longer <= most] = True
    order = np.argsort(longer, kind="stable")
    order = order[fits[order] & ~out[order]]
    # Most that are similar differ in few places.
    for k in order[longer[order] >= 64] if likely else ():
        out[k] = bridged_distance(*cores[k], int(most[k])) <= most[k]
    order = order[~out[order]]
    short = order[longer[order] < WIDE]
    at = 0
    while at < len(short):
        part = short[at : at + AT_A_TIME]
        # The bit vectors of all are as long as the longest needs.
        part = part[longer[part] <= longer[part[0]] * 3 // 2 + 32]
        at += len(part)
        # So many words of a column are computed at a time.
        words = min(longer[part[-1]], 2 * most[part].max()) // 64 + 1
        if len(part) >= FEW * words:
            out[part] = edit_distances([cores[k] for k in part], most[part]) <= most[part]
        else:
            out[part] = [edit_distance(*cores[k], most[k]) <= most[k] for k in part]
    for k in order[len(short) :]:
        out[k] = anchored_distance(*cores[k]) <= most[k] or edit_distance(*cores[k], most[k]) <= most[k]
    if may is not None:
        whole[chosen] = out
        return whole
    return out


def whole_cells(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Batches that hold whole cells only, each with the row at which every cell starts."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        if not len(batch):
            continue
        change = np.zeros(len(batch), bool)
        change[0] = True
        for column in CELL:
            values = batch[column].to_numpy()
            change[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(change)
        rest = batch.iloc[starts[-1] :]
        if len(starts) > 1:
            yield batch.iloc[: starts[-1]].reset_index(drop=True), starts[:-1]
    if rest is not None and len(rest):
        yield rest.reset_index(drop=True), np.zeros(1, np.int64)


def sharing_pairs(batch: pd.DataFrame, starts: np.ndarray, similarity: float, closer: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows n, m of one cell that may be similar, every pair once, in portions.

    Their lengths and SimHashes allow it, and the cell's key is the first they share.  The lines of
    a large cell are sorted by length, so that a block of them meets those of fitting length only;
    of small cells the pairs are taken over all cells: all that are 1 apart, 2 apart, ...
    """
    size, own = batch["size"].to_numpy(), batch["own"].to_numpy()
    prints = [batch[c].to_numpy().view(np.uint64) for c in ("low", "high")]
    keys = batch[KEYS].to_numpy()
    choice = batch["part"].to_numpy() >> 32
    across = batch["i"].to_numpy() != batch["j"].to_numpy()
    lines = np.diff(np.r_[starts, len(batch)])
    ends = np.repeat(starts + lines, lines)
    limits = np.array([limit for _, limit in RADIUS]) - closer
    limits = limits[np.searchsorted([least for least, _ in RADIUS], size, "right") - 1]
    most = (1 - similarity) * size + 1e-9

    def met(n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs whose cell is the one in which they meet first."""
        apart = ~across[n] | (own[n] != own[m])
        n, m = n[apart], m[apart]
        first = (keys[n] == keys[m]).argmax(axis=1) == choice[n]
        return n[first], m[first]

    for start, count in zip(starts[lines > SMALL_CELL].tolist(), lines[lines > SMALL_CELL].tolist(), strict=True):
        order = start + np.argsort(size[start : start + count], kind="stable")
        sizes, low, high, allows, edits = (x[order] for x in (size, *prints, limits, most))
        # The last line that fits each; what a line allows to be shorter grows more slowly than the line.
        reach = np.searchsorted(sizes - edits, sizes, "right")
        for at in range(0, count, BLOCK):
            here = slice(at, min(at + BLOCK, count))
            for there in range(at + 1, int(reach[here].max()), ACROSS):
                to = slice(there, min(there + ACROSS, int(reach[here].max())))
                near = sizes[None, to] - sizes[here, None] <= edits[None, to]
                differ = np.bitwise_count(low[here, None] ^ low[None, to])
                differ += np.bitwise_count(high[here, None] ^ high[None, to])
                near &= differ <= allows[None, to]
                near &= np.arange(to.start, to.stop)[None] > np.arange(here.start, here.stop)[:, None]
                x, y = np.nonzero(near)
                if len(x):
                    n, m = met(order[x + at], order[y + there])
                    if len(n):
                        yield n, m
    rows = np.flatnonzero(np.repeat(lines <= SMALL_CELL, lines))
    apart = 1
    while len(rows := rows[rows + apart < ends[rows]]):
        n, m = rows, rows + apart
        longer = np.where(size[n] < size[m], m, n)
        near = np.abs(size[n] - size[m]) <= most[longer]
        n, m, longer = n[near], m[near], longer[near]
        differ = sum(np.bitwise_count(p[n] ^ p[m]).astype(np.int16) for p in prints)
        near = differ <= limits[longer]
        n, m = met(n[near], m[near])
        if len(n):
            yield n, m
        apart += 1


class Labels:
    """Groups of rows whose pairs are looked up many at a time."""

    def __init__(self, n: int) -> None:
        self.groups, self.label, self.joined = Groups(n), np.arange(n), []

    def join(self, x: int, y: int) -> bool:
        """Whether the two were apart."""
        new = self.groups.join(x, y)
        if new:
            self.joined += (x, y)
        return new

    def apart(self, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Which pairs are not in one group."""
        if self.joined:
            # Only labels of rows that were joined have moved.
            moved = np.unique(self.label[self.joined])
            self.label[moved] = [self.groups.root(x) for x in moved.tolist()]
            self.label = self.label[self.label]
            self.joined = []
        return self.label[n] != self.label[m]


def _forest(similarity: float):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Per cell a spanning forest of the pairs that may be similar, the closer ones first."""
        for batch, starts in whole_cells(batches):
            nodes, groups, links = batch["node"].to_numpy(), Labels(len(batch)), []
            for closer in (CLOSER, 0):
                for n, m in sharing_pairs(batch, starts, similarity, closer):
                    open_ = groups.apart(n, m)
                    links += [(x, y) for x, y in zip(n[open_].tolist(), m[open_].tolist(), strict=True) if groups.join(x, y)]
            if links:
                left, right = np.array(links).T
                yield batch[CELL].iloc[left].assign(a=nodes[left], b=nodes[right])

    return search


def counted(texts: list[str]) -> np.ndarray:
    """Per text the counts of its characters, then of its pairs of neighbours, in ``BUCKETS`` each; 255 stands for more, too."""
    out = np.zeros((len(texts), 2 * BUCKETS), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), size)
    single = _mixed(points + np.uint64(1)) % np.uint64(BUCKETS)
    inside = row[1:] == row[:-1]
    double = _mixed(points[:-1] << np.uint64(32) | points[1:])[inside] % np.uint64(BUCKETS)
    cells = np.r_[row * 2 * BUCKETS + single.astype(np.int64), row[1:][inside] * 2 * BUCKETS + BUCKETS + double.astype(np.int64)]
    where, n = np.unique(cells, return_counts=True)
    out.reshape(-1)[where] = np.minimum(n, 255)
    return out


def countable(counts: np.ndarray, n: np.ndarray, m: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which pairs of rows may be within ``most`` edits: one changes at most two counts of characters and four of pairs by one."""
    out = np.zeros(len(n), bool)
    for at in range(0, len(n), 1 << 13):
        own = slice(at, at + (1 << 13))
        a, b = counts[n[own]], counts[m[own]]
        differ = np.add.reduceat(np.maximum(a, b) - np.minimum(a, b), (0, BUCKETS), axis=1, dtype=np.int32)
        out[own] = (differ <= np.array((2, 4)) * most[own, None]).all(axis=1)
    return out


def _settled(similarity: float):
    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Links between rows that are not connected yet; of two groups a few pairs are compared at a time."""
        for batch, starts in whole_cells(batches):
            nodes, texts = batch["node"].to_numpy(), [normalized(x) for x in batch["line"]]
            groups, links, first = Labels(len(batch)), [], {}
            for n, root in enumerate(batch["root"].to_numpy().tolist()):
                groups.join(first.setdefault(root, n), n)
            size = batch["size"].to_numpy()
            brief = np.flatnonzero(size < COUNTED)
            counts, row = counted([texts[k] for k in brief]), np.zeros(len(batch), np.int64)
            row[brief] = np.arange(len(brief))
            waiting: list[tuple[int, int]] = []

            def compare() -> bool:
                """Whether few of the pairs that waited are similar."""
                at_once, tried, before = AT_ONCE, 0, len(links)  # noqa: B023
                while waiting:  # noqa: B023
                    chosen, later, taken = [], [], Counter()
                    for x, y in waiting:  # noqa: B023
                        a, b = groups.groups.root(x), groups.groups.root(y)  # noqa: B023
                        if a != b:
                            taken[a, b] += 1
                            (chosen if taken[a, b] <= at_once else later).append((x, y))
                    n, m = np.array(chosen, np.int64).reshape(-1, 2).T
                    longer, may = np.maximum(size[n], size[m]), np.ones(len(n), bool)  # noqa: B023
                    short = np.flatnonzero(longer < COUNTED)
                    edits = ((1 - similarity) * longer[short] + 1e-9).astype(np.int64)
                    may[short] = countable(counts, row[n[short]], row[m[short]], edits)  # noqa: B023
                    found = similar_pairs([(texts[x], texts[y]) for x, y in chosen], similarity, likely=False, may=may)  # noqa: B023
                    for (x, y), same in zip(chosen, found.tolist(), strict=True):
                        if same and groups.join(x, y):  # noqa: B023
                            links.append((nodes[x], nodes[y]))  # noqa: B023
                    waiting[:] = later  # noqa: B023
                    at_once, tried = 2 * at_once, tried + len(chosen)
                return 8 * (len(links) - before) <= tried  # noqa: B023

            limit, chars = 2 * TOGETHER, 0
            for n, m in sharing_pairs(batch, starts, similarity):
                for at in range(0, len(n), PORTION):
                    # What those that waited have connected is not compared any more.
                    x, y = n[at : at + PORTION], m[at : at + PORTION]
                    open_ = groups.apart(x, y)
                    x, y = x[open_], y[open_]
                    waiting += zip(x.tolist(), y.tolist(), strict=True)
                    chars += int((size[x] + size[y]).sum())
                    if len(waiting) >= limit or len(waiting) >= 2 * TOGETHER and chars >= WAITING_CHARS:
                        limit = min(2 * limit, WAITING) if compare() else 2 * TOGETHER
                        chars = 0
            compare()
            if links:
                yield pd.DataFrame(links, columns=["a", "b"])

    return settle


def _checked(similarity: float):
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The pairs whose edit similarity is high enough."""
        for batch in batches:
            texts = zip(map(normalized, batch["left"]), map(normalized, batch["right"]), strict=True)
            yield batch.loc[similar_pairs(list(texts), similarity), ["a", "b"]]

    return check


def _key(n: int, keys: np.ndarray) -> np.ndarray:
    """Number and value of a key in one."""
    return np.int64(n << 32) | keys.astype(np.int64) & np.int64(0xFFFFFFFF)


def _mixed_ids(ids: np.ndarray) -> np.ndarray:
    """Places of keys in a bitmap: their low bits alone are no hash of both parts."""
    return _mixed(ids.view(np.uint64)).view(np.int64)


def _spread_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id (place in a bitmap) of every part."""
    for batch in batches:
        part = batch.column("part").to_numpy()
        yield pa.RecordBatch.from_pydict({"id": _mixed_ids(part)})


def _met(bits):
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A line, with the part, for every key that the bitmap has."""
        for batch in batches:
            for n, c in enumerate(KEYS):
                part = _key(n, batch.column(c).to_numpy())
                rows = np.flatnonzero(has(bits.value, _mixed_ids(part)))
                if len(rows):
                    lines = batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([*lines.columns, pa.array(part[rows])], [*lines.schema.names, "part"])

    return meet


def cells(found: DataFrame) -> DataFrame:
    """Every line (node and marks) with part (number and value of a shared key), own, i, j, for each key that it shares.

    A bitmap tells most keys that are not shared; a line that passes wrongly is alone in its cell.
    A key of more than ``CHUNK`` lines is dealt over chunks, every two of which meet in a cell of their own.
    """
    key = F.array(*[F.lit(n << 32) + F.col(c).cast("long").bitwiseAND(F.lit(0xFFFFFFFF)) for n, c in enumerate(KEYS)])
    dealt = found.select(F.explode(key).alias("part"))
    shared = stored(dealt.groupBy("part").agg(F.count("*").alias("n")).where("n > 1"))
    if shared.count() <= BROADCAST_ROWS:
        met = found.withColumn("part", F.explode(key)).join(F.broadcast(shared), "part")
    else:
        bits = found.sparkSession.sparkContext.broadcast(bitmap(shared.select("part").mapInArrow(_spread_keys, "id long")))
        typed = ", ".join(f"{c} {t}" for c, t in found.dtypes)
        met = found.mapInArrow(_met(bits), f"{typed}, part long")
        hot = shared.where(F.col("n") > CHUNK)
        if hot.count() <= BROADCAST_ROWS:
            met = met.join(F.broadcast(hot), "part", "left")
        else:
            met = spread_join(met, hot, ["part"], "left", ["node"])
    chunks = F.ceil(F.coalesce("n", F.lit(1)) / F.lit(CHUNK)).cast("int")
    met = met.withColumn("own", F.pmod(F.xxhash64("node"), chunks).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    return met.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other", "n")


def _texts_of(bits):
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """node and line of every line that the bitmap has, once a batch."""
        for batch in batches:
            found: dict[int, str] = {}
            for text in batch["text"]:
                lines = text.split("\n")
                # The same lines as in ``_lines``: lower case never makes or takes a line feed.
                norm = [b" ".join(line.split()) for line in text.lower().encode().split(b"\n")]
                nodes = np.fromiter((xxhash.xxh64_intdigest(x) for x in norm), np.uint64, len(norm)).view(np.int64)
                for k in np.flatnonzero(has(bits.value, nodes)):
                    if norm[k]:
                        found.setdefault(int(nodes[k]), lines[k])
            if found:
                yield pd.DataFrame({"node": list(found), "line": list(found.values())})

    return find


def surplus_lines(documents: DataFrame, similarity: float = 0.8) -> DataFrame:
    """doc_id, tie (hash of the text) and position of every line that repeats another, exactly or nearly.

    Lines are linked if they are equal when normalised, or share a key, have SimHashes within
    the radius and an edit similarity of at least ``similarity``.  Of each connected group the
    line with the smallest (doc_id, tie, position) is not returned.
    """
    spark = documents.sparkSession
    docs = documents.where("doc_id is not null and text is not null")
    docs = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tie"), "text")
    typed = ", ".join(f"{c} {t}" for c, t in MARKS.items())
    own = stored(docs.mapInPandas(_lines, f"doc_id long, tie long, position int, node long, {typed}"))
    place = F.struct("doc_id", "tie", "position")
    # Columns of fixed width only, so that equal lines are combined by hash, without a sort.
    found = stored(own.groupBy("node").agg(F.count("*").alias("n"), *[F.min(c).alias(c) for c in MARKS]))

    def gathered(rows: DataFrame) -> DataFrame:
        return rows.repartition(partitions(spark), *CELL).sortWithinPartitions(*CELL, "node")

    met = stored(cells(found.select("node", *MARKS)))
    maybe = stored(gathered(met).mapInPandas(_forest(similarity), "a long, b long, part long, i int, j int"))
    # Only lines that may be similar to another meet their texts again; a bitmap tells most others.
    wanted = stored(maybe.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    bits = spark.sparkContext.broadcast(bitmap(wanted.select(F.col("node").alias("id"))))
    lines = docs.select("text").mapInPandas(_texts_of(bits), "node long, line string")
    lines = stored(by_shuffle(lines.dropDuplicates(["node"])).join(wanted, "node", "left_semi"))

    def linked(pairs: DataFrame) -> DataFrame:
        left, right = (lines.select(F.col("node").alias(n), F.col("line").alias(side)) for n, side in (("a", "left"), ("b", "right")))
        return stored(pairs.select("a", "b").join(left, "a").join(right, "b").mapInPandas(_checked(similarity), "a long, b long"))

    links = linked(maybe)
    roots = connected_components(links)
    # A forest can stand on a pair that is not similar; what it left unconnected is compared pair by pair.
    failed = stored(maybe.join(links, ["a", "b"], "left_anti").select(*CELL).distinct())
    if not failed.isEmpty():
        known = met.join(failed, CELL, "left_semi").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        more = stored(gathered(known.join(lines, "node")).mapInPandas(_settled(similarity), "a long, b long"))
        roots = joined_components(roots, more)
    # What is alone and there once repeats nothing.
    placed = found.select("node", "n").join(roots, "node", "left").where("root is not null or n > 1")
    placed = placed.select("node", F.coalesce("root", "node").alias("root"))
    members = stored(spread_join(own.drop(*MARKS), placed, ["node"], "inner", ["doc_id", "tie", "position"]).drop("node"))
    heads = members.groupBy("root").agg(F.min(place).alias("head"))
    repeated = spread_join(members, heads, ["root"], "inner", ["doc_id", "tie", "position"])
    return repeated.where(place != F.col("head")).select("doc_id", "tie", "position")


def distinct_lines(documents: DataFrame, similarity: float = 0.8, emptied: bool = True) -> DataFrame:
    """The documents, all columns as given, without surplus lines; n_chars follows the text.

    Blank lines, documents without an id, and null or empty texts stay as they are.  Rows that
    repeat a doc_id and its text are one document and keep or lose the same lines.  A document
    of which only blank lines are left stays with them if ``emptied``, else it goes.  A line of
    any length is compared whole.  Empty input gives no rows.
    """
    gone = surplus_lines(documents.select("doc_id", "text"), similarity)
    key, tie, lost = (free_name(documents, n) for n in ("lost_of", "lost_tie", "lost"))
    # Written, so that the join below is one of plain tables and a hot document can be split.
    gone = stored(gone.groupBy("doc_id", "tie").agg(F.collect_set("position").alias(lost)))
    gone = gone.withColumnRenamed("doc_id", key).withColumnRenamed("tie", tie)
    same = (documents["doc_id"] == gone[key]) & (F.xxhash64(documents["text"]) == gone[tie])
    met = documents.join(gone, same, "left").drop(key, tie)
    stay = F.filter(F.split("text", "\n"), lambda line, n: ~F.array_contains(F.col(lost), n))
    text = F.when(F.col(lost).isNull(), F.col("text")).otherwise(F.array_join(stay, "\n"))
    new = {"text": text}
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col(lost).isNull(), F.col("n_chars")).otherwise(F.length(text)).cast(kind)
    out = met.select(*[new[c].alias(c) if c in new else F.col(c) for c in documents.columns], lost)
    if not emptied:
        out = out.where(F.col(lost).isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return out.drop(lost)
