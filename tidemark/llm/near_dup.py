"""Near-duplicate documents: banded MinHash, Bayesian pruning, exact verification.

1. Documents with the same shingle set are one class; its smallest doc_id stands for it.
2. Representatives that share a band of their signature join its smallest member; the
   connected components of these joins hold every banded candidate pair.
3. Within a component, representatives meet in chunk pairs of bounded size. There the
   signatures of banded candidates are compared a batch at a time. After n hashes with m
   equal ones the similarity has the posterior Beta(m+1, n-m+1) from a flat prior; a pair
   whose chance to reach the threshold is below ``miss`` is dropped. Survivors are verified
   on their whole sets, the most similar first, unless links found before connect them.
   A chunk pair gives a spanning forest of its links, so links grow as the documents.
4. Components of the links are the near-duplicate groups.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, hashes, lower_ascii, passes, sieve, stored, words

BANDS, ROWS, BATCH = 20, 5, 20
CHUNK_DOCS, CHUNK_SHINGLES = 512, 1_000_000
MISS = 1e-4
EMPTY = b""

_rng = np.random.default_rng(20)
MASKS = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
FACTORS = _rng.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (shift-multiply rounds)."""
    h = h.copy()
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def shingle_set(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; fewer words are one run."""
    n = len(word_hashes)
    if n == 0:
        return np.empty(0, np.uint64)
    w = word_hashes.view(np.uint64)
    take = min(width, n)
    h = np.full(n - take + 1, take, np.uint64)
    for i in range(take):
        h = mixed(h ^ w[i : n - take + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
    return np.unique(h)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Smallest value of each hash function over the set; long sets go in pieces.

    Each function is a bijection of 32-bit integers, applied to the shingles' upper half.
    """
    best = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    upper = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(upper), 2048):
        low = ((upper[at : at + 2048, None] ^ MASKS) * FACTORS).min(axis=0)
        np.minimum(best, low, out=best)
    return best


def band_keys(signs: np.ndarray) -> np.ndarray:
    """One 64-bit key for each row and band."""
    parts = signs.reshape(len(signs), BANDS, ROWS).astype(np.uint64)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * np.ones((len(signs), 1), np.uint64)
    for r in range(ROWS):
        keys = mixed(keys ^ parts[:, :, r]) * np.uint64(0x9E3779B97F4A7C15)
    return keys


def least_matches(threshold: float, miss: float) -> list[int]:
    """For each number of compared batches the fewest equal hashes that keep a pair."""
    kept = []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        tail, m = 0.0, 0
        for m in range(n + 1):  # P(Beta(m+1, n-m+1) >= t) = P(Binomial(n+1, t) <= m)
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= miss:
                break
        kept.append(m)
    return kept


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    for a, b in zip(offsets[:-1], offsets[1:]):
        yield flat[a:b]


def _fingerprint(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else EMPTY


def _binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def _sketches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, signs, bands = [], [], [], []
            for w in _lists(batch.column("words")):
                s = shingle_set(w, width)
                sizes.append(len(s))
                prints.append(_fingerprint(s))
                sign = signature(s)
                signs.append(sign.tobytes() if len(s) else EMPTY)
                bands.append(band_keys(sign[None])[0].view(np.int64) if len(s) else ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    _binary(prints),
                    _binary(signs),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "print", "sign", "bands"],
            )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(w, width) for w in _lists(batch.column("words"))]
            yield pa.RecordBatch.from_arrays(
                [_binary([_fingerprint(s) for s in sets]), _binary([s.tobytes() for s in sets])],
                ["print", "shingles"],
            )

    return run


def _agreeing(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows with an equal band."""
    a, b = band_keys(left), band_keys(right)
    shared = np.zeros((len(left), len(right)), bool)
    for k in range(BANDS):
        shared |= a[:, k, None] == b[None, :, k]
    return np.nonzero(shared)


class Forest:
    """Union-find over row numbers."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        self.parent[self.root(x)] = self.root(y)


def links_of_chunks(
    signs: np.ndarray, sets: list[np.ndarray], first: np.ndarray, second: np.ndarray, percent: int, keep: list[int]
) -> list[tuple[int, int]]:
    """A spanning forest of the links between the rows ``first`` and ``second``."""
    i, j = _agreeing(signs[first], signs[second])
    i, j = first[i], second[j]
    fresh = i < j if first is second else i != j
    i, j = i[fresh], j[fresh]
    sizes = np.array([len(s) for s in sets])
    near = 100 * np.minimum(sizes[i], sizes[j]) >= percent * np.maximum(sizes[i], sizes[j])
    i, j = i[near], j[near]
    equal = np.zeros(len(i), np.int32)
    for n, least in enumerate(keep):
        at = slice(n * BATCH, (n + 1) * BATCH)
        for a in range(0, len(i), 65536):
            b = slice(a, a + 65536)
            equal[b] += (signs[i[b], at] == signs[j[b], at]).sum(axis=1, dtype=np.int32)
        left = equal >= least
        i, j, equal = i[left], j[left], equal[left]
    forest, links = Forest(len(sets)), []
    for p in np.argsort(-equal, kind="stable"):
        x, y = int(i[p]), int(j[p])
        if forest.root(x) == forest.root(y):
            continue
        common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
        if 100 * common >= percent * (len(sets[x]) + len(sets[y]) - common):
            forest.join(x, y)
            links.append((x, y))
    return links


def _verify(percent: int, keep: list[int]):
    def run(group: pa.Table) -> pa.Table:
        prints = group.column("print").to_pylist()
        component = np.unique(group.column("comp").to_numpy(zero_copy_only=False), return_inverse=True)[1]
        side = group.column("side").to_numpy()
        signs = np.frombuffer(b"".join(group.column("sign").to_pylist()), np.uint32)
        signs = signs.reshape(len(prints), -1)
        sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        links = []
        order = np.argsort(component, kind="stable")
        for rows in np.split(order, np.nonzero(np.diff(component[order]))[0] + 1):
            first, second = rows[side[rows] == 0], rows[side[rows] == 1]
            pair = (first, second) if len(second) else (first, first)
            links += links_of_chunks(signs, sets, *pair, percent, keep)
        return pa.table([_binary([prints[x[n]] for x in links]) for n in (0, 1)], names=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, width: int = 3, percent: int = 85, miss: float = MISS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are lower-cased in A-Z and end at ASCII white space; shingles are ``width`` words,
    and fewer words are one shingle. Two documents are linked if 100 times their common
    shingles is at least ``percent`` times all of theirs. ``component_id`` is the smallest
    doc_id reachable over links. Documents without words have no shingles and no links.
    Rows that repeat a doc_id are judged row by row; a null doc_id is linked with nothing,
    has a null component and is kept. Other columns of ``docs`` are not looked at.
    """
    text = docs.select(F.col("doc_id").cast("long"), "text")
    worded = hashes(words(lower_ascii(F.col("text")))).alias("words")
    sketches = stored(
        text.select("doc_id", worded).mapInArrow(
            _sketches(width),
            "doc_id long, n_shingles long, print binary, sign binary, bands array<long>",
        ),
        "near-sketches",
    )
    classes = stored(
        sketches.where("n_shingles > 0 and doc_id is not null")
        .groupBy("print", "n_shingles", "sign", "bands")
        .agg(F.min("doc_id").alias("id")),
        "near-classes",
    )
    banded = classes.select("print", F.explode("bands").alias("band"))
    leaders = banded.groupBy("band").agg(F.min("print").alias("lead"), F.count("print").alias("n"))
    joins = banded.join(leaders.where("n > 1"), "band").where("print != lead")
    joins = joins.select(F.col("print").alias("a"), F.col("lead").alias("b")).distinct()
    coarse = components(joins, "near-coarse").toDF("print", "comp")
    members = stored(classes.drop("bands").join(coarse, "print"), "near-members")
    volume = members.groupBy("comp").agg(F.count("id").alias("m"), F.sum("n_shingles").alias("n"))
    chunks = F.ceil(F.greatest(F.col("m") / CHUNK_DOCS, F.col("n") / CHUNK_SHINGLES))
    volume = stored(volume.select("comp", chunks.alias("chunks")), "near-volume")
    # Components of one chunk share bins; larger ones have a bin for each chunk pair.
    bins = max(1, members.count() // CHUNK_DOCS)
    shared = F.struct(
        F.lit(None).cast("binary").alias("c"),
        F.pmod(F.xxhash64("comp"), F.lit(bins)).alias("i"),
        F.lit(0).cast("long").alias("j"),
    )
    meet = F.expr(
        "explode(transform(sequence(0L, chunks - 1), o -> struct(least(chunk, o) as i,"
        " greatest(chunk, o) as j, if(chunk <= o, 0, 1) as side)))"
    )
    dealt = (
        members.join(volume, "comp")
        .withColumn("chunk", F.pmod(F.xxhash64("print"), "chunks"))
        .withColumn("meet", meet)
        .withColumn("bin", F.when(F.col("chunks") == 1, shared).otherwise(F.struct(F.col("comp").alias("c"), "meet.i", "meet.j")))
        .select("print", "comp", "sign", "meet.side", "bin")
    )
    # The sets of those that meet are made again from their whole texts. The bitmap lets
    # through all of them and few others, which find no partner in the join below.
    again = text.where("doc_id is not null").where(passes(sieve(members, "id"), F.col("doc_id")))
    sets = again.select(worded).mapInArrow(_sets(width), "print binary, shingles binary")
    met = dealt.join(sets.dropDuplicates(["print"]), "print")
    keep = least_matches(percent / 100, miss)
    links = stored(met.groupBy("bin").applyInArrow(_verify(percent, keep), "a binary, b binary"), "near-links")
    rooted = classes.select("print", "id").join(components(links, "near-final").toDF("print", "root"), "print", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "print"))
    names = rooted.groupBy("root").agg(F.min("id").alias("component"))
    named = sketches.join(rooted.join(names, "root").select("print", "component"), "print", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return named.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
