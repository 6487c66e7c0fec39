"""Toxicity on labelled rows that the model has not seen."""

from __future__ import annotations

import random
import zlib

import numpy as np

from tidemark.llm.boosting import fit_isotonic, fit_trees
from tidemark.llm.toxicity import toxicity_scores

BAD = ["grumbletoad", "skunkwort", "mudbrain"]


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    plain = [f"word{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(plain) for _ in range(rng.randint(5, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(2):
                text.insert(rng.randrange(len(text)), rng.choice(BAD))
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return docs, labels


def unseen(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def scored(spark, docs, labels):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    return {r.doc_id: r for r in toxicity_scores(frame, marks).collect()}


def test_held_out_rows(spark):
    docs, labels = corpus()
    long_text = "word1 " * 400_000
    docs += [(5000, None), (5001, ""), (5002, long_text), (5003, long_text + "grumbletoad mudbrain " * 40)]
    docs += [(5004, "well you GrumbleToad, word3 word4 skunkwort"), (5005, "word5 gr.umbl.et0ad word7 mudbr@in")]
    got = scored(spark, docs, labels)
    assert {i for i, _ in docs} == set(got)
    assert all(got[i].held_out == unseen(i) for i in got)
    held = [(i, y) for i, y in labels if unseen(i)]
    assert sum(got[i].predicted == y for i, y in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert [got[i].predicted for i in (5000, 5001, 5002)] == [0, 0, 0]
    assert got[5004].predicted == 1 and got[5003].score > got[5002].score and got[5005].score > got[5002].score
    flipped = [(i, 1 - y if unseen(i) else y) for i, y in labels]
    again = scored(spark, docs, flipped)
    assert {i: r.score for i, r in got.items()} == {i: r.score for i, r in again.items()}


def test_edges(spark):
    docs = [(1, "a b"), (1, "a b"), (None, None)]
    frame = spark.createDataFrame([(*d, "en", 1.0) for d in docs], "doc_id long, text string, label string, fold double")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity_scores(frame, none).collect()] == [0.0] * 3
    ones = spark.createDataFrame([(i, 1) for i in (1, 2, 3, 4)] + [(1, None), (None, 0)], "doc_id long, toxic int")
    assert [r.score for r in toxicity_scores(frame, ones).collect()] == [1.0] * 3
    assert toxicity_scores(frame.limit(0), none).count() == 0


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 5))
    y = ((x[:, 0] > 0.5) & (x[:, 3] < 0.3)).astype(float)
    margins = fit_trees(x[:1500], y[:1500], np.ones(1500)).margins(x[1500:])
    assert ((margins > 0) == (y[1500:] == 1)).mean() > 0.98


def test_isotonic_rises_and_fits_the_shares():
    rng = np.random.default_rng(2)
    margins = rng.normal(size=3000)
    y = (rng.random(3000) < 1 / (1 + np.exp(-3 * margins))).astype(float)
    curve = fit_isotonic(margins, y, np.ones(3000))
    at = np.linspace(-3, 3, 50)
    assert (np.diff(curve(at)) >= 0).all()
    assert np.abs(curve(at) - 1 / (1 + np.exp(-3 * at))).max() < 0.12
