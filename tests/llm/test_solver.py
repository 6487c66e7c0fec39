"""The hinge-loss solver of the quality classifier next to plain projected gradients."""

from __future__ import annotations

import numpy as np
import pytest

from tidemark.llm.quality import BITS, COST, SLOPE, fit, log_count_ratios


def solved(sets, labels):
    """Weights and bias of the same problem: its dual by projected gradient steps on a dense matrix."""
    scale = log_count_ratios(sets, labels)
    x = np.zeros((len(sets), (1 << BITS) + 1))
    for row, s in zip(x, sets):
        row[s] = scale[s] / np.sqrt((scale[s] ** 2).sum())
        row[-1] = 1.0
    sign = 2.0 * labels - 1
    signed = x * sign[:, None]
    gram = signed @ signed.T
    most = COST * len(labels) / (2 * np.bincount(labels))[labels]
    step, dual = 1 / np.linalg.eigvalsh(gram)[-1], np.zeros(len(sets))
    for _ in range(50_000):
        dual = np.clip(dual - step * (gram @ dual - 1), 0, most)
    return x @ (signed.T @ dual)


@pytest.mark.parametrize("seed,good", [(1, 12), (2, 5), (3, 20)])
def test_margins_next_to_projected_gradients(seed, good):
    rng = np.random.default_rng(seed)
    labels = np.array([1] * good + [0] * (24 - good))
    # The classes draw from ranges that overlap, so that some rows lie on the wrong side.
    sets = [np.unique(rng.integers(20 * label, 60 + 20 * label, 15)).astype(np.int32) for label in labels]
    model = fit(sets, labels)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    score = model.scores(row, np.concatenate(sets), len(sets))
    margin = np.log(score / (1 - score)) / SLOPE
    assert np.abs(margin - solved(sets, labels)).max() < 0.03
