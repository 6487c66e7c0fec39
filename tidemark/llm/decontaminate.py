"""Benchmark passages in documents: SimHash windows, Hamming blocks, exact similarity.

A window of an item is as long as the largest power of two that the item is sure to hold
without an edit while it keeps ``similarity`` of its shingles' weight. All windows of
the items and of the documents get a 64-bit SimHash of their words. The fingerprint is cut
into ``radius`` + 1 blocks: two fingerprints within ``radius`` bits agree in one block at
least, so looking up each block finds all of them. A hit aligns the item in the document;
there, as far as its hits reach, the item's distinct shingles are weighed exactly.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import NOT_WORD, hashes, stored, words
from tidemark.llm.near_dup import mixed

SHINGLE = 5
RADIUS = 3  # four blocks of 16 bits
SLACK = 4  # words around an aligned item that also count as its region
PASS_WORDS = 200_000  # benchmark words held at a time
CHUNK = 1 << 17  # document words fingerprinted at a time


def broken_shingles(n: int, size: int) -> int:
    """Fewest of the shingles of ``n`` words that edits break if no ``size`` words stay together.

    Edits leave runs of fewer than ``size`` words, of which one of r words keeps r - 4
    shingles. Most stay if the runs are as long as they may be and no word is lost between
    them, as with words inserted; an edit at the ends is a short last run.
    """
    full, last = divmod(n, size - 1)
    return n - SHINGLE + 1 - full * max(0, size - SHINGLE) - max(0, last - SHINGLE + 1)


def window_size(
    n: int, similarity: float, weights: list[int] | None = None, total: int | None = None
) -> int:
    """Longest power of two of ``n`` words that stay together at that similarity.

    ``weights`` are those of the item's shingles in order, 0 for one that stands elsewhere in
    the item too, and ``total`` is what the distinct ones weigh; without them all weigh the
    same. The lightest shingles are taken as those that break. One whole shingle at least is
    found, so four words always stay together.
    """
    each = np.ones(n - SHINGLE + 1) if weights is None else np.sort(np.array(weights, np.float64))
    whole = each.sum() if total is None else total
    size = 1 << (n.bit_length() - 1)
    while size >= SHINGLE and whole - each[: broken_shingles(n, size)].sum() >= (similarity - 1e-9) * whole:
        size //= 2
    return size


def fingerprints(h: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """SimHash of every window of each size (powers of two, ascending) over word hashes.

    Ones per bit are added up by doubling: a window is the sum of its halves.
    """
    counts = np.unpackbits(mixed(h).view(np.uint8).reshape(-1, 8), axis=1)
    width = 1
    while True:
        if width in sizes:
            ones = counts > width // 2
            yield width, np.packbits(ones, axis=1).view(np.uint64).ravel()
        if width >= sizes[-1] or len(counts) <= width:
            return
        if width == 128:  # 256 ones do not fit a byte
            counts = counts.astype(np.uint32)
        counts = counts[:-width] + counts[width:]
        width *= 2


def shingle_hashes(w: np.ndarray) -> np.ndarray:
    h = np.zeros(max(0, len(w) - SHINGLE + 1), np.uint64)
    for i in range(SHINGLE):
        h = mixed(h ^ w[i : len(h) + i]) * np.uint64(0x9E3779B97F4A7C15)
    return h


@dataclass
class Item:
    item_id: int | None
    size: int
    weights: dict[int, int]  # shingle to its number of distinct words
    window: int

    @classmethod
    def of(cls, item_id: int | None, w: np.ndarray, similarity: float) -> Item:
        shingles = shingle_hashes(w).tolist()
        weights = {s: len(set(w[i : i + SHINGLE].tolist())) for i, s in enumerate(shingles)}
        times = Counter(shingles)
        once = [weights[s] if times[s] == 1 else 0 for s in shingles]
        return cls(item_id, len(w), weights, window_size(len(w), similarity, once, sum(weights.values())))

    def similarity(self, region: np.ndarray) -> float:
        """Weight share of the item's distinct shingles that lie in the region."""
        found = self.weights.keys() & set(shingle_hashes(region).tolist())
        return sum(self.weights[s] for s in found) / sum(self.weights.values())


class Index:
    """Windows of a bounded number of items, looked up by blocks of their fingerprint."""

    def __init__(self, items: list[tuple[int | None, list[int]]], similarity: float) -> None:
        self.similarity, self.items = similarity, []
        prints: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for number, (item_id, w) in enumerate(items):
            h = np.array(w, np.int64).view(np.uint64)
            self.items.append(Item.of(item_id, h, similarity))
            for size, fp in fingerprints(h, [self.items[-1].window]):
                prints.setdefault(size, []).append((fp, np.full(len(fp), number), np.arange(len(fp))))
        self.sizes = sorted(prints)
        self.windows = {s: tuple(map(np.concatenate, zip(*p))) for s, p in prints.items()}
        self.blocks = {s: [self._block(p[0], b) for b in range(RADIUS + 1)] for s, p in self.windows.items()}

    @staticmethod
    def _block(fp: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
        value = fp.view(np.uint16).reshape(-1, RADIUS + 1)[:, b]
        order = np.argsort(value, kind="stable")
        return order, np.searchsorted(value[order], np.arange(65537))

    def hits(self, size: int, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (place in ``fp``, window of the index) within the radius."""
        known, cut = self.windows[size][0], fp.view(np.uint16).reshape(-1, RADIUS + 1)
        places, found = [], []
        for b, (order, start) in enumerate(self.blocks[size]):
            value = cut[:, b]
            at = np.nonzero((np.diff(start) > 0)[value])[0]
            for part in np.array_split(at, len(at) // 65536 + 1):
                v = value[part].astype(np.int64)
                n = start[v + 1] - start[v]
                place = np.repeat(part, n)
                rank = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)
                window = order[np.repeat(start[v], n) + rank]
                near = np.bitwise_count(fp[place] ^ known[window]) <= RADIUS
                places.append(place[near])
                found.append(window[near])
        return np.concatenate(places), np.concatenate(found)

    def matches(self, flat: np.ndarray, offsets: np.ndarray) -> dict[tuple[int, int], tuple[float, int]]:
        """Best (similarity, first word) of each document and item with a match."""
        best: dict[tuple[int, int], tuple[float, int]] = {}
        if not self.sizes or not len(flat):
            return best
        overlap = self.sizes[-1] - 1
        starts: dict[tuple[int, int], set[int]] = {}
        for base in range(0, len(flat), CHUNK):
            for size, fp in fingerprints(flat[base : base + CHUNK + overlap], self.sizes):
                place, window = self.hits(size, fp)
                place = place + base
                doc = np.searchsorted(offsets, place, "right") - 1
                inside = place + size <= offsets[doc + 1]
                number, inner = self.windows[size][1][window], self.windows[size][2][window]
                aligned = np.stack([doc, number, place - inner])[:, inside]
                for d, i, start in zip(*np.unique(aligned, axis=1).tolist()):
                    starts.setdefault((d, i), set()).add(start)
        for (d, i), found in starts.items():
            item, low, high, ordered = self.items[i], int(offsets[d]), int(offsets[d + 1]), sorted(found)
            moved = SLACK + int((1 - self.similarity) * item.size)
            for start in ordered:
                # Words put in or left out move the windows behind them: the region goes on to those.
                last = ordered[bisect_right(ordered, start + moved) - 1]
                region = flat[max(low, start - SLACK) : min(high, last + item.size + SLACK)]
                value = item.similarity(region)
                if value >= self.similarity - 1e-9:
                    best[d, i] = max(best.get((d, i), (0.0, -high)), (value, low - start))
        return {k: (v, max(0, -negative)) for k, (v, negative) in best.items()}


def _scan(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("words")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values.to_numpy()[offsets[0] : offsets[-1]].view(np.uint64)
            found = index.matches(flat, offsets - offsets[0])
            rows = pa.array([d for d, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(rows),
                    pa.array([index.items[i].item_id for _, i in found], pa.int64()),
                    pa.array([v for v, _ in found.values()], pa.float64()),
                    pa.array([s for _, s in found.values()], pa.int64()),
                ],
                ["doc_id", "item_id", "similarity", "start_word"],
            )

    return run


def _passes(items: Iterator, limit: int) -> Iterator[list[tuple[int | None, list[int]]]]:
    held, size = [], 0
    for row in items:
        if held and size + len(row.words) > limit:
            yield held
            held, size = [], 0
        held.append((row.item_id, row.words))
        size += len(row.words)
    yield held


def contaminated(
    docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, pass_words: int = PASS_WORDS
) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, similarity, start_word.

    Words are runs of letters and digits, lower-cased; shingles are five words, each as heavy
    as it has distinct words. An item is found where a region of its own size (with ``SLACK``
    words around it, and as many more as words put in or left out have moved its windows, up to
    1 - ``similarity`` of its size) holds ``similarity`` of the weight of its shingles. Items of
    fewer than five words have no shingle and take no part; null texts have no words. Rows
    that repeat a doc_id or item_id are each matched; null ids stay null. Other columns are
    not looked at. The benchmark is read in passes of at most ``pass_words`` words (one item
    at least), and each pass reads all documents: what a task holds does not grow with it.
    """
    def worded(df: DataFrame, name: str) -> DataFrame:
        text = hashes(words(F.lower("text"), NOT_WORD)).alias("words")
        return df.select(F.col(name).cast("long"), text)

    items = worded(benchmark, "item_id").where(F.size("words") >= SHINGLE).distinct()
    text, result = worded(docs, "doc_id").where(F.size("words") >= SHINGLE), None
    schema = "doc_id long, item_id long, similarity double, start_word long"
    for held in _passes(items.toLocalIterator(), pass_words):
        found = text.mapInArrow(_scan(Index(held, similarity)), schema)
        result = found if result is None else result.unionByName(stored(found, "leaks"))
    return result
