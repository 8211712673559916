"""Language of a document by a byte convolutional network.

Bytes are embedded, filters of several widths slide over a fixed-length window, the largest
answer of each filter goes to a softmax over the languages.  All filters are rows of one matrix
over the widest filter's bytes, the narrower ones with zeros behind, so that a batch of windows
is one matrix product.  The network is trained in numpy (Adam, cross entropy) on windows of a
bounded sample of labelled rows; every window of a text is scored, and the answers are averaged
with the number of letters in each window as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradebinder.llm.common import held_out

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 16
EMBEDDING = 8
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Bytes of a letter: a-z (texts are lower-cased first) and all bytes beyond ASCII.
_IS_LETTER = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])
# Windows whose bytes are multiplied at a time.
_BLOCK = 32


def windows(text: bytes) -> np.ndarray:
    """The bytes of a text in rows of one window, zeros behind the last.

    Rows overlap by the widest filter less one, so that no filter misses a place.
    """
    step = WINDOW - max(WIDTHS) + 1
    data = np.frombuffer(text.translate(_LOWER), np.uint8)
    n = max(1, -(-(len(data) - WINDOW + step) // step)) if len(data) else 0
    padded = np.zeros(step * max(n - 1, 0) + WINDOW, np.uint8)
    padded[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::step][:n]


@dataclass
class Network:
    """embed (256, E), filters (width * E, F), bias (F), out (F, languages), out_bias; languages by name."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    languages: list[str]

    def places(self, rows: np.ndarray) -> np.ndarray:
        """The embedded bytes under the widest filter at every place of every window."""
        width = max(WIDTHS)
        inside = np.zeros((len(rows), WINDOW + width - 1, EMBEDDING), np.float32)
        inside[:, :WINDOW] = self.embed[rows]
        seen = np.lib.stride_tricks.sliding_window_view(inside, width, axis=1)
        return np.ascontiguousarray(seen.transpose(0, 1, 3, 2)).reshape(len(rows) * WINDOW, width * EMBEDDING)

    def pooled(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Largest answer of each filter per window, where it is, and the embedded places."""
        seen = self.places(rows)
        answers = (seen @ self.filters).reshape(len(rows), WINDOW, -1)
        at = answers.argmax(axis=1)
        return np.take_along_axis(answers, at[:, None, :], axis=1)[:, 0] + self.bias, at, seen

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        out = []
        for k in range(0, len(rows), _BLOCK):
            part = rows[k : k + _BLOCK]
            best = (self.places(part) @ self.filters).reshape(len(part), WINDOW, -1).max(axis=1) + self.bias
            out.append(softmax(np.maximum(best, 0) @ self.out + self.out_bias))
        return np.concatenate(out) if out else np.zeros((0, len(self.languages)), np.float32)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and its probability; ``und`` and 0 without a letter."""
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        known = [n for n, t in enumerate(texts) if t and self.languages and _LETTER.search(t)]
        for n in known:
            rows = windows(texts[n].encode())
            weight = _IS_LETTER[rows].sum(axis=1) + 1e-3
            # Portions bound the memory of a very long text.
            total = np.zeros(len(self.languages))
            for k in range(0, len(rows), 1 << 12):
                total += weight[k : k + (1 << 12)] @ self.probabilities(rows[k : k + (1 << 12)])
            total /= weight.sum()
            best = int(total.argmax())
            names[n], scores[n] = self.languages[best], min(1.0, float(total[best]))
        return names, scores


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def width_mask() -> np.ndarray:
    """1 where a filter has a weight: its own width, from the left."""
    mask = np.zeros((max(WIDTHS), EMBEDDING, len(WIDTHS) * FILTERS), np.float32)
    for k, width in enumerate(WIDTHS):
        mask[:width, :, k * FILTERS : (k + 1) * FILTERS] = 1
    return mask.reshape(-1, mask.shape[-1])


def train(rows: np.ndarray, label: np.ndarray, languages: list[str], epochs: int = 6, batch: int = 64, rate: float = 3e-3) -> Network:
    """A network fitted to windows and the numbers of their languages."""
    random = np.random.default_rng(12)
    mask = width_mask()
    n_filters = mask.shape[1]
    net = Network(
        random.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        (random.normal(0, 0.3, mask.shape) * mask).astype(np.float32),
        np.zeros(n_filters, np.float32),
        random.normal(0, 0.1, (n_filters, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
        languages,
    )
    names = ("embed", "filters", "bias", "out", "out_bias")
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for k in range(0, len(order), batch):
            own = order[k : k + batch]
            step += 1
            for name, slope in gradients(net, rows[own], label[own], mask).items():
                first[name] += 0.1 * (slope - first[name])
                second[name] += 0.001 * (slope**2 - second[name])
                change = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                setattr(net, name, (getattr(net, name) - rate * change).astype(np.float32))
    return net


def gradients(net: Network, rows: np.ndarray, label: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
    """Slopes of the mean cross entropy; of each filter only the place of its largest answer counts."""
    pooled, at, seen = net.pooled(rows)
    active = np.maximum(pooled, 0)
    error = softmax(active @ net.out + net.out_bias)
    error[np.arange(len(rows)), label] -= 1
    error /= len(rows)
    back = (error @ net.out.T) * (pooled > 0)
    place = np.arange(len(rows))[:, None] * WINDOW + at
    filters = np.einsum("nf,nfd->df", back, seen[place]) * mask
    # Bytes below each chosen place; beyond the window there are none.
    width = max(WIDTHS)
    under = at[:, :, None] + np.arange(width)
    value = np.where(under < WINDOW, rows[np.arange(len(rows))[:, None, None], np.minimum(under, WINDOW - 1)], 0)
    shares = back[:, :, None, None] * net.filters.T.reshape(1, -1, width, EMBEDDING)
    shares *= (under < WINDOW)[..., None]
    embed = np.zeros_like(net.embed)
    flat = value.reshape(-1)
    for d in range(EMBEDDING):
        embed[:, d] = np.bincount(flat, shares[..., d].reshape(-1), minlength=256)
    return {"embed": embed, "filters": filters, "bias": back.sum(axis=0), "out": active.T @ error, "out_bias": error.sum(axis=0)}


def _training_windows(most: int):
    """At most ``most`` windows of each text, spread evenly over it."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lang, found = [], []
            for name, text in zip(batch["lang"], batch["text"], strict=True):
                rows = windows(text.encode())
                rows = rows[_IS_LETTER[rows].any(axis=1)]
                for k in np.unique(np.linspace(0, len(rows) - 1, most).astype(int)) if len(rows) else []:
                    lang.append(name)
                    found.append(rows[k].tobytes())
            yield pd.DataFrame({"lang": lang, "bytes": found}, dtype=object)

    return cut


def fit_network(rows: DataFrame, train_rows: int, windows_per_text: int, most_languages: int) -> Network:
    """A network from (doc_id, text, lang) without nulls.

    Each of the ``most_languages`` most frequent languages gives the same number of rows, chosen
    by hash, ``train_rows`` together; what reaches the driver is bounded by these parameters.
    """
    spoken = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages).collect()}
    languages = sorted(spoken)
    if not languages:
        return Network(*[np.zeros((0, 0), np.float32)] * 5, [])
    share = max(1, train_rows // len(languages))
    # About twice the rows that are needed, by hash, so that no task has to sort a whole language.
    pick = F.xxhash64("doc_id", "text")
    rate = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, (2 * share + 20) / spoken[lang]))])
    some = rows.where(F.pmod(pick, F.lit(1 << 20)) < F.try_element_at(rate, F.col("lang")) * (1 << 20))
    order = Window.partitionBy("lang").orderBy(pick, "doc_id")
    chosen = some.withColumn("place", F.row_number().over(order)).where(F.col("place") <= share)
    table = chosen.select("lang", "text").mapInPandas(_training_windows(windows_per_text), "lang string, bytes binary").toArrow()
    # The order that rows arrive in depends on the cluster; the sample's own order does not.
    pairs = sorted(zip(table["lang"].to_pylist(), table["bytes"].to_pylist(), strict=True))
    data = np.frombuffer(b"".join(b for _, b in pairs), np.uint8).reshape(-1, WINDOW)
    number = {name: n for n, name in enumerate(languages)}
    return train(data, np.array([number[name] for name, _ in pairs], np.int64), languages)


def predict_language(
    documents: DataFrame,
    train_rows: int = 4000,
    windows_per_text: int = 3,
    most_languages: int = 200,
    divisor: int = 5,
    remainder: int = 0,
) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``documents`` (doc_id, text, lang).

    Only text and language of rows outside the held-out fold are learned from; the language is
    no input of a prediction.  A text that is null or has no letter is ``und`` with score 0, as
    is every text when there is nothing to learn from.  A null language teaches nothing; a row
    without a doc_id is predicted and teaches nothing; repeated rows are predicted each; a
    text of any length is scored whole; an empty table gives no rows; other columns are ignored.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string"))
    fold = held_out(F.col("doc_id"), divisor, remainder)
    known = docs.where(~fold & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (F.length("text") > 0))
    network = spark.sparkContext.broadcast(fit_network(known, train_rows, windows_per_text, most_languages))

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        names, scores = network.value.predict(texts.tolist())
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return docs.select("doc_id", fold.alias("held_out"), predict("text").alias("p")).select("doc_id", "held_out", "p.*")
