"""Importance resampling next to plain counting."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import bytewords
from tidemark.llm.resample import BUCKETS, INSIDE, LOWER, _as_planes, gain_planes, gain_sums, resampled

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(lowered)
    return w, [zlib.crc32(f.encode()) % BUCKETS for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute(docs, target, percent=25, least=20):
    found = [(i, *features(x)) for i, x in docs]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for x in target for b in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + BUCKETS) / ((s[b] + 1) * (T + BUCKETS))))
    out = {}
    for i, w, f in found:
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        out[i] = [len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))]
    able = sorted((i for i, w, _ in found if len(w) >= least), key=lambda i: (-out[i][2], i))
    rank = {i: n + 1 for n, i in enumerate(able[: percent * len(able) // 100])}
    return {i: (*v, rank.get(i)) for i, v in out.items()}


def corpus(seed, n=80):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "naïve", "Ärger", "x1", "日本", "a" * 90, "it's", "..", "\x7f", "Z"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return list(enumerate([*texts, None, "", "same " * 5000, "...", "same " * 5000]))


def test_next_to_brute_force(spark):
    docs, target = corpus(1), ["the the naïve it's", None, "日本 x1 日本"]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = resampled(frame, spark.createDataFrame([(t,) for t in target], "text string")).collect()
    got = {r.doc_id: (r.n_features, r.weight, r.score, r.rank) for r in found}
    assert got == brute(docs, target)


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert resampled(empty, empty).count() == 0
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(None, words, 1, "p"), (None, words, 2, "q"), (3, words, 3, "r"), (3, words, 3, "r"), (4, None, 0, None)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, row long, planes string")
    found = resampled(odd, empty, percent=100).collect()
    assert sorted(r.rank for r in found if r.rank is not None) == [1, 2, 3, 4]
    assert [(r.n_features, r.weight, r.rank) for r in found if r.doc_id == 4] == [(0, 0, None)]


@pytest.mark.parametrize("size", [3, 7, 50])
def test_parts_of_a_long_text_lose_nothing(monkeypatch, size):
    texts = ["one two  three,four", "", "a" * 120 + " b", ",,, ,,", "x " * 40, "é" * 30 + "," * 30 + "é z"]
    column = pa.array(texts)
    whole = next(iter(_as_planes([pa.RecordBatch.from_arrays([column], ["text"])])))
    monkeypatch.setattr(bytewords, "PIECE_BYTES", size)
    parts = pa.Table.from_batches(list(_as_planes([pa.RecordBatch.from_arrays([column], ["text"])])))
    assert parts.column("planes").to_pylist() == whole.column("planes").to_pylist()
    assert parts.column("n_words").to_pylist() == [len(features(t)[0]) for t in texts]


def test_crc_of_words():
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abé9") for _ in range(rng.choice([1, 5, 63, 64, 65, 200]))) for _ in range(300))
    (piece,) = bytewords.pieces(pa.array([text]), INSIDE)
    _, start, length = bytewords.words(piece, INSIDE)
    got = bytewords.crc32(LOWER[piece.data], start, length)
    assert got.tolist() == [zlib.crc32(w.encode()) for w in text.split(" ")]


def test_bit_planes_sum_exactly():
    rng = np.random.default_rng(3)
    gains = rng.integers(-9000, 9000, BUCKETS)
    text = " ".join(str(int(x)) for x in rng.integers(0, 50, 3000))
    (batch,) = _as_planes([pa.RecordBatch.from_arrays([pa.array([text])], ["text"])])
    assert gain_sums(batch.column("planes"), gain_planes(gains)).tolist() == [sum(gains[b] for b in features(text)[1])]
