"""Text quality by naive-Bayes support vectors.

Each document is the set of its word and word-pair indicators. An indicator is scaled by
the log ratio of its smoothed shares in the two classes, rows are brought to unit length,
and a linear hinge-loss model is fitted by dual coordinate descent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hashes
from tidemark.llm.near_dup import mixed

BITS = 18  # indicators are hashed to 2**BITS features
SAMPLE_A_CLASS = 4000  # labelled rows the model is fitted on, at most, per class
COST, EPOCHS, SLOPE = 1.0, 20, 4.0
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"


def tokens(text: Column) -> Column:
    """Runs of letters and digits, and runs of signs, in their own case."""
    return hashes(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0)))


def features(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) of word and word-pair indicators, sorted by row."""
    h = mixed(flat.view(np.uint64))
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint64), np.diff(offsets))
    pairs = mixed(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
    same = row[:-1] == row[1:]
    shift = np.uint64(64 - BITS)
    key = np.concatenate(
        [row << np.uint64(BITS) | h >> shift, row[:-1][same] << np.uint64(BITS) | pairs[same] >> shift]
    )
    key = np.unique(key)
    return (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64((1 << BITS) - 1)).astype(np.int32)


def _pieces(batch: pa.RecordBatch, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``limit`` tokens: first row, last row, tokens, offsets."""
    lists = batch.column("tokens")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat, first = lists.values.to_numpy(), 0
    while first < len(lists):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, len(lists))
        yield first, last, flat[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, flat, offsets in _pieces(batch):
            row, feature = features(flat, offsets)
            bounds = np.searchsorted(row, np.arange(last - first + 1))
            sets = [feature[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            labels = batch.column("label").slice(first, last - first)
            yield pa.RecordBatch.from_arrays([labels, pa.array(sets, pa.binary())], ["label", "features"])


@dataclass
class Model:
    value: np.ndarray  # weight times scale of each feature
    square: np.ndarray  # squared scale of each feature
    bias: float
    fixed: float | None = None  # score of all documents where a class has no rows

    def scores(self, row: np.ndarray, feature: np.ndarray, rows: int) -> np.ndarray:
        if self.fixed is not None:
            return np.full(rows, self.fixed)
        total = np.bincount(row, self.value[feature], rows)
        norm = np.sqrt(np.bincount(row, self.square[feature], rows))
        margin = total / np.where(norm > 0, norm, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(SLOPE * margin, -50, 50)))


def log_count_ratios(sets: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    counts = np.ones((2, 1 << BITS))
    for s, label in zip(sets, labels):
        counts[label, s] += 1
    shares = np.log(counts / counts.sum(axis=1, keepdims=True))
    return shares[1] - shares[0]


def fit(sets: list[np.ndarray], labels: np.ndarray) -> Model:
    """Dual coordinate descent for hinge loss on the scaled indicators.

    A class's cost is inverse to its number of rows, so that both weigh the same.
    """
    zero = np.zeros(1 << BITS)
    if len(set(labels.tolist())) < 2:
        # Nothing speaks against any document, or nothing for one.
        return Model(zero, zero, 0.0, float(labels[0]) if len(labels) else 1.0)
    scale = log_count_ratios(sets, labels)
    sign = 2.0 * labels - 1
    cost = COST * len(labels) / (2 * np.bincount(labels))[labels]
    norms = [max(1e-12, float(np.sqrt((scale[s] ** 2).sum()))) for s in sets]
    rows = [scale[s] / n for s, n in zip(sets, norms)]
    weight, bias, dual = np.zeros(1 << BITS), 0.0, np.zeros(len(sets))
    rng = np.random.default_rng(8)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in rng.permutation(len(sets)):
            s, x = sets[i], rows[i]
            gradient = sign[i] * (weight[s] @ x + bias) - 1
            # The constant input 1 stands for the bias: a unit row has squared length 2.
            new = min(max(dual[i] - gradient / 2, 0.0), cost[i])
            step = (new - dual[i]) * sign[i]
            if step:
                weight[s] += step * x
                bias += step
                moved = max(moved, abs(step))
                dual[i] = new
        if moved < 1e-3:
            break
    return Model(weight * scale, scale**2, bias)


def held_out() -> Column:
    """Rows whose label is never learned; a null doc_id is none of them."""
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    return F.coalesce(remainder == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_A_CLASS) -> Model:
    """Fits on at most ``most`` labelled rows of each class, those of smallest hash.

    Null labels count as none; where a document has several, their mean decides.
    """
    known = (
        labels.where("quality is not null and doc_id is not null")
        .groupBy(F.col("doc_id").cast("long"))
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
        .where(~held_out())
    )
    order = F.xxhash64("doc_id")
    sample = known.where("label = 1").orderBy(order, "doc_id").limit(most).unionAll(
        known.where("label = 0").orderBy(order, "doc_id").limit(most)
    )
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(sample), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = rows.orderBy(order, "doc_id").select("label", tokens(F.col("text")).alias("tokens"))
    found = rows.mapInArrow(_featured, "label int, features binary").collect()
    sets = [np.frombuffer(r.features, np.int32) for r in found]
    return fit(sets, np.array([r.label for r in found], np.int64))


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n != "tokens"]
            for first, last, flat, offsets in _pieces(batch):
                row, feature = features(flat, offsets)
                score = model.scores(row, feature, last - first)
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(score)], [*names, "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    The score reads the text alone, and the whole of it; null and empty texts have no
    indicators and get the score of the bias. Without labels of either class every score is
    1.0, with one class its label. Rows that repeat a doc_id are scored each for itself.
    Other columns are not looked at. The model's size is fixed by ``BITS``.
    """
    model = train(docs, labels)
    text = docs.select(F.col("doc_id").cast("long"), tokens(F.col("text")).alias("tokens"))
    scored = text.mapInArrow(_scored(model), "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
