"""Decontamination finds an item wherever one word is changed or put in, at every length."""

from __future__ import annotations

import numpy as np
import pytest

from tests.llm.test_operators import docs_of
from tidemark.llm.decontaminate import SLACK, Index, Item, contaminated, window_size

SIMILARITY = 0.8


def edited(w, new):
    """All texts with one word changed, with one put in, or with the first and last changed."""
    for at in range(len(w)):
        yield np.concatenate([w[:at], new[:1], w[at + 1 :]])
        yield np.concatenate([w[:at], new[:1], w[at:]])
    yield np.concatenate([new[:1], w[1:-1], new[1:2]])


@pytest.mark.parametrize("n", range(5, 61))
def test_one_edit_at_every_place(n):
    rng = np.random.default_rng(n)
    w = rng.integers(1, 1 << 62, n, np.int64).view(np.uint64)
    if n % 3 == 0:
        w[1::5] = w[1]  # shingles of unlike weight
    item, index = Item.of(0, w, SIMILARITY), Index([(0, w.view(np.int64).tolist())], SIMILARITY)
    parts, offsets, want = [], [0], set()
    for new in edited(w, rng.integers(1, 1 << 62, 2, np.int64).view(np.uint64)):
        if item.similarity(new) >= SIMILARITY - 1e-9:
            want.add((len(offsets) - 1, 0))
        parts.append(np.concatenate([rng.integers(1, 1 << 62, 9, np.int64).view(np.uint64), new]))
        offsets.append(offsets[-1] + len(parts[-1]))
    got = index.matches(np.concatenate(parts), np.array(offsets))
    assert set(got) == want


def least_broken(n, size):
    """By force: fewest broken shingles of edits that leave no ``size`` words together."""
    best = {0: 0}  # end of the words that are left together: most shingles kept
    for at in range(1, n + 1):
        best[at] = max(best[at - r] + max(0, r - 4) for r in range(1, min(size - 1, at) + 1))
    return n - 4 - best[n]


@pytest.mark.parametrize("n", range(5, 200))
def test_windows_are_sure_to_be_whole(n):
    size = window_size(n, SIMILARITY)
    assert size == 4 or least_broken(n, size) > 0.2 * (n - 4) + 1e-6
    assert 2 * size > n or least_broken(n, 2 * size) <= 0.2 * (n - 4) + 1e-6


def test_several_words_put_in(spark):
    w = [f"w{i}" for i in range(150)]
    text = ["before"] * 20
    for at in range(0, 150, 30):
        text += [*w[at : at + 30], "new", "words", "here"]
    bench = spark.createDataFrame([(7, " ".join(w))], "item_id long, text string")
    got = contaminated(docs_of(spark, [" ".join(text)]), bench).collect()
    assert [(r.item_id, round(r.similarity, 3)) for r in got] == [(7, round(130 / 146, 3))]
    assert abs(got[0].start_word - 20) <= SLACK
