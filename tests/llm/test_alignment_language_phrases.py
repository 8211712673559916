"""Token alignment, language and phrases against brute force, and on hostile rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradebinder.llm import alignment, language, phrases
from tradebinder.llm.tokens import byte_characters

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
DOCUMENT = "doc_id long, text string, lang string"
HOSTILE = [
    (1, None, "en"), (2, "", None), (3, " \n\t", "en"), (3, " \n\t", "en"), (None, "Hello wörld<|endoftext|> <s>x</s>", "de"),
    (4, "▁odd▁", "fr"), (5, "naïve café 東京 😀 á", None), (6, "a" * 5000 + " " * 3000 + "b", "en"), (7, "x. y " * 4000, "en"),
]


def frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, DOCUMENT)
    if extra:
        for name in ("row", "pairs", "score", "held_out", "n_a", "w1", "f", "place", "rank", "id"):
            df = df.withColumn(name, F.lit("x"))
    return df


# ---------------------------------------------------------------- alignment

_LIBRARY = Tokenizer.from_file(A)
_LIBRARY.encode_special_tokens = True
_MODEL = sentencepiece.SentencePieceProcessor(model_file=B)


def tokens_of(text):
    """(id, start, end) of both tokenizers, or None where the bytes differ."""
    back = {c: b for b, c in byte_characters().items()}
    ids = _LIBRARY.encode(" " + text, add_special_tokens=False).ids
    left = [(i, bytes(back[c] for c in _LIBRARY.id_to_token(i))) for i in ids]
    right = []
    for i in _MODEL.encode(text):
        piece = _MODEL.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if _MODEL.is_byte(i) else piece.replace("▁", " ").encode()))
    out = []
    for side in (left, right):
        if not text or b"".join(b for _, b in side) != b" " + text.encode():
            return None
        at, spans = 0, []
        for i, b in side:
            spans.append((i, at, at + len(b)))
            at += len(b)
        out.append(spans)
    return out


def brute_alignment(texts):
    links, rows = [], []
    for text in texts:
        found = tokens_of(text or "")
        if found is None:
            rows.append((0, 0, 0, ""))
            links.append([])
            continue
        a, b = found
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        shown, start = [], 0
        for cut in cuts:
            shown.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= cut) for side in (a, b)))
            start = cut
        links.append([(i, j) for i, s, e in a for j, t, f in b if s < f and t < e])
        rows.append((len(a), len(b), len(cuts), hashlib.sha256(";".join(shown).encode()).hexdigest()))
    n = Counter(p for x in links for p in set(x))
    best = {}
    for (i, _), k in n.items():
        best[i] = max(best.get(i, 0), k)
    return [(r[0], r[1], r[2], len(x), sum(n[p] == best[p[0]] for p in x), sum(n[p] for p in x), r[3]) for r, x in zip(rows, links, strict=True)]


@pytest.mark.parametrize("send_pairs", [alignment.SEND_PAIRS, 0])
def test_alignment_is_the_brute_force_one(spark, send_pairs):
    rng = random.Random(1)
    words = "the of naïve Straße x1 2024 ... don't we'll  \n\t café 日本 😀 unbelievable tokenization".split(" ")
    rows = [(100 + n, "".join(rng.choice(words) + rng.choice(" \n  ") for _ in range(rng.randint(0, 60))), "en") for n in range(60)]
    rows = [r for r in HOSTILE if len(r[1] or "") < 9000] + rows
    got = alignment.align_documents(frame(spark, rows).repartition(3), A, B, send_pairs=send_pairs).collect()
    want = brute_alignment([r[1] for r in rows])
    key = lambda x: tuple(map(str, x))
    assert sorted((tuple(r) for r in got), key=key) == sorted(((r[0], *w) for r, w in zip(rows, want, strict=True)), key=key)
    assert [r for r in got if r.doc_id == 4][0].n_a == 0  # the mark of the model is no blank of the text


def test_alignment_of_nothing(spark):
    assert alignment.align_documents(frame(spark, []), A, B).count() == 0


_SIDE = alignment.side(A)


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet=st.characters(max_codepoint=0x24F), max_size=60), st.text(alphabet=" \n\t\x0b\x1c\x85\xa0'sStlL9,.!ªº²¼", max_size=40)))
def test_byte_level_ids_are_the_library_s(text):
    assert _SIDE.fast is not None
    assert _SIDE.encode([text])[0].tolist() == _LIBRARY.encode(" " + text, add_special_tokens=False).ids


def test_groups_coalesce_intervals_with_gaps_and_overlaps():
    starts, ends = np.array([0, 2, 9, 1, 5]), np.array([2, 5, 12, 4, 7])
    assert alignment.groups(starts, ends).tolist() == [0, 0, 2, 0, 1]


# ----------------------------------------------------------------- language

SPEECH = {"aa": "bab lal nanu mima oru tolan", "bb": "ßtrix çorz këln ðusk vyx", "cc": "Zzyx qwer plok hjkl mnbv"}


def speech(rng, lang, n=60):
    return " ".join(rng.choice(SPEECH[lang].split()) for _ in range(n))


def test_language_of_held_out_texts(spark):
    rng = random.Random(4)
    rows = [(n, speech(rng, lang := rng.choice(list(SPEECH))), lang) for n in range(400)]
    wrong = [(1000 + n, speech(rng, "aa"), None) for n in range(20)]
    df = frame(spark, rows + wrong + HOSTILE)
    got = language.predict_language(df).collect()
    assert len(got) == len(rows) + len(wrong) + len(HOSTILE)
    by = {r.doc_id: r for r in got if r.doc_id is not None and r.doc_id >= 10}
    held = [r for r in rows if r[0] >= 10 and by[r[0]].held_out]
    assert 50 < len(held) < 120 and sum(by[i].lang_pred == lang for i, _, lang in held) >= 0.97 * len(held)
    assert all(by[r[0]].lang_pred == "aa" for r in wrong)
    assert {(r.lang_pred, r.score) for r in got if r.doc_id in (2, 3)} >= {("und", 0.0)}
    assert all(0 <= r.score <= 1 for r in got)


def test_language_ignores_the_column_and_the_held_out_fold(spark):
    rng = random.Random(5)
    rows = [(n, speech(rng, "aa" if n % 2 else "bb"), "aa" if n % 2 else "bb") for n in range(120)]
    first = {r.doc_id: r for r in language.predict_language(frame(spark, rows)).collect()}
    lied = [(i, t, "zz" if first[i].held_out else lang) for i, t, lang in rows]
    second = {r.doc_id: r for r in language.predict_language(frame(spark, lied)).collect()}
    assert all(first[i].lang_pred == second[i].lang_pred and abs(first[i].score - second[i].score) < 1e-6 for i in first)


def test_language_with_nothing_to_learn(spark):
    got = language.predict_language(frame(spark, [(1, "words here", None), (2, None, "en")])).collect()
    assert {(r.doc_id, r.lang_pred, r.score) for r in got} == {(1, "und", 0.0), (2, "und", 0.0)}
    assert language.predict_language(frame(spark, [])).count() == 0


def test_gradients_are_the_numeric_ones():
    rng = np.random.default_rng(0)
    rows = rng.integers(97, 103, (3, language.WINDOW)).astype(np.uint8)
    label, mask = np.array([0, 1, 1]), language.width_mask()
    net = language.train(rows, label, ["x", "y"], epochs=1)
    for name in ("embed", "filters", "bias", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    slopes = language.gradients(net, rows, label, mask)

    def loss():
        pooled, _, _ = net.pooled(rows)
        p = language.softmax(np.maximum(pooled, 0) @ net.out + net.out_bias)
        return -np.log(p[np.arange(3), label]).mean()

    for name, at in (("embed", (98, 3)), ("filters", (1, 5)), ("bias", (7,)), ("out", (9, 1)), ("out_bias", (0,))):
        value, h = getattr(net, name), 1e-4
        value[at] += h
        up = loss()
        value[at] -= 2 * h
        down = loss()
        value[at] += h
        assert abs((up - down) / (2 * h) - slopes[name][at]) < 2e-3 + 0.02 * abs(slopes[name][at]), name


@given(st.integers(0, 2000))
def test_windows_cover_every_place_of_every_filter(n):
    text = bytes(random.Random(n).choices(range(97, 123), k=n))
    width = max(language.WIDTHS)
    seen = {bytes(r[k : k + width]) for r in language.windows(text) for k in range(language.WINDOW - width + 1)}
    assert all(text[k : k + width] in seen for k in range(n - width + 1))


# ------------------------------------------------------------------ phrases

def brute_phrases(rows, least, top, covered=80, scale=2_000_000):
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    f, n = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        often = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        gone = set()
        for p, c in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * c >= covered * counts[p[i : i + k]]:
                        gone.add(p[i : i + k])
        rows = []
        for p, a in often.items():
            if p not in gone:
                score, _, left, right = min((scale * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                rows.append((lang, " ".join(p), a, left, right, n[lang], score))
        rows.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], k, *r[1:]) for k, r in enumerate(rows[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("budget", [1_000_000, 40, 3])
def test_phrases_are_the_brute_force_ones(spark, budget):
    rng = random.Random(7)
    words = "The of cat DOG é ß # new york city a1 rare% zz".split()
    weights = [30, 20, 8, 8, 3, 3, 2, 6, 6, 5, 1, 1, 1]
    rows = []
    for n in range(120):
        text = "".join(rng.choices(words, weights)[0] + rng.choice(["  ", " ", " ", " ", "\t", ". ", "\n", "\x0b", "!"]) for _ in range(rng.randint(0, 120)))
        rows.append((n, text, rng.choice(["en", "en", "de", None, "und"])))
    rows += HOSTILE + [(900, "New York city of the cat, " * 30, "en")] * 3
    got = phrases.collocations(frame(spark, rows).repartition(4), least=5, top=40, budget=budget)
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(rows, 5, 40)


def test_phrases_of_nothing(spark):
    assert phrases.collocations(frame(spark, [])).count() == 0
    assert phrases.collocations(frame(spark, [(1, None, None), (2, " . ", "en")])).count() == 0


def test_phrases_survive_words_that_share_a_hash(spark, monkeypatch):
    seeds, real = [], phrases._portions

    def colliding(batches):
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"lang": ["en"], "words": [["a", "b"]], "ids": [[5, 5]], "counts": [[1, 1]], "codes": [b""]})

    def portions(seed):
        seeds.append(seed)
        return colliding if seed == 0 else real(seed)

    monkeypatch.setattr(phrases, "_portions", portions)
    rows = [(n, "a b c", "en") for n in range(40)]
    got = phrases.collocations(frame(spark, rows, extra=False))
    assert seeds == [0, 1] and [r.phrase for r in got.collect()] == ["a b c"]


def test_phrases_hold_few_portions_and_no_copies_of_a_group(spark, monkeypatch, tmp_path):
    import tracemalloc

    import pyarrow as pa
    import pyarrow.parquet as pq

    # Portions are written, and handed to Python, a few at a time, however large a task is.
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, held, files, real = spark.conf.get(name), [], [], phrases.stored

    def stored(df, **options):
        held.append(spark.conf.get(name))
        out = real(df, **options)
        if "codes" in out.columns:
            files.extend(out.inputFiles())
        return out

    monkeypatch.setattr(phrases, "stored", stored)
    monkeypatch.setattr(phrases, "PORTION", 1 << 12)
    monkeypatch.setattr(phrases, "HELD", 1 << 16)
    rng = random.Random(3)
    rows = [(n, " ".join(str(rng.randint(1, 5000)) for _ in range(900)), "en") for n in range(120)]
    phrases.counted_phrases(frame(spark, rows, extra=False).coalesce(1), 5, 40)
    groups = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in files]
    assert sum(m.num_rows for m in groups) > 100
    assert max(m.row_group(k).num_rows for m in groups for k in range(m.num_row_groups)) < 40
    phrases.collocations(frame(spark, rows, extra=False), least=5)
    assert str(1 << 16) in held and spark.conf.get(name) == before
    # A group is built within little more than twice its own bytes.
    words = np.random.default_rng(1).integers(1, 50, (400_000, 4))
    columns = {c: [x.astype("<i8").tobytes() for x in np.array_split(words[:, k], 300)] for k, c in enumerate(phrases.W)}
    columns |= {"n": [np.ones(len(x), "<i4").tobytes() for x in np.array_split(words, 300)], "prefix": [np.ones(len(x), np.int8).tobytes() for x in np.array_split(words, 300)]}
    part = pa.table({c: pa.array(x, pa.binary()) for c, x in columns.items()})
    del columns
    tracemalloc.start()
    found = phrases._nodes(30)(part)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2.5 * part.nbytes
    counts = Counter(map(tuple, words[:, :2].tolist()))
    got = {(r["w1"], r["w2"]): r["f"] for r in found.to_pylist() if r["w3"] == 0}
    assert got == {p: n for p, n in counts.items() if n >= 30}
