"""Nearest neighbours by inner product over randomly rotated one-bit codes.

A vector is brought to unit length and turned by a fixed random rotation; the signs of its
components, packed, are its code. With the product <code, unit vector> and the length kept
as correction scalars, <code, query> / <code, unit vector> estimates the inner product
without bias, with an error whose size is known. Queries are quantised to bytes, so an
estimate is eight bit planes of AND and popcount. A vector is reranked with its original
components only if its estimate plus its error bound reaches the score of the k-th best
vector reranked before.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DATA_BLOCK, QUERY_BLOCK = 8192, 4096
PLANES = 8
SIGMAS = 2.5  # of the estimate's error that its bound allows


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same for every run."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def pack(bits: np.ndarray) -> np.ndarray:
    """Rows of 0/1 as 64-bit words, the last one filled with zeros."""
    packed = np.packbits(bits, axis=1)
    filled = np.zeros((len(bits), -(-bits.shape[1] // 64) * 8), np.uint8)
    filled[:, : packed.shape[1]] = packed
    return filled.view(np.uint64)


class Codes:
    """Codes and correction scalars of some vectors."""

    def __init__(self, vectors: np.ndarray, turn: np.ndarray) -> None:
        dim = vectors.shape[1]
        self.length = np.linalg.norm(vectors, axis=1)
        turned = (vectors / self.length[:, None]) @ turn
        bits = turned > 0
        self.words = pack(bits)
        self.ones = bits.sum(axis=1)
        # <code, unit vector>: the code's components are +-1/sqrt(dim).
        self.match = np.abs(turned).sum(axis=1) / np.sqrt(dim)
        spread = np.sqrt(np.maximum(0, 1 - self.match**2) / max(1, dim - 1))
        self.error = SIGMAS * spread / self.match * self.length
        self.factor = self.length / self.match / np.sqrt(dim)
        self.dim = dim

    def estimates(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products with one turned query, and how far off they may be."""
        low, high = float(query.min()), float(query.max())
        step = (high - low) / (2**PLANES - 1) or 1.0
        level = np.rint((query - low) / step).astype(np.uint8)
        total = np.zeros(len(self.words), np.int64)
        for plane in range(PLANES):
            bits = pack((level[None] >> plane) & 1)[0]
            for word in range(self.words.shape[1]):
                total += np.bitwise_count(self.words[:, word] & bits[word]).astype(np.int64) << plane
        # sum over +-1 of the quantised query, from sums over the ones of the code
        signed = 2 * (step * total + low * self.ones) - (step * int(level.sum()) + low * self.dim)
        slack = self.factor * (step / 2 * self.dim)
        return signed * self.factor, self.error * float(np.linalg.norm(query)) + slack


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, each row added up in the same way, so that equal rows tie."""
    return (vectors * query).sum(axis=1)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score first, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def _searched(k: int, dim: int):
    def run(queries: pa.Table, data: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(queries) and len(data):
            turn = rotation(dim)
            query_ids, wanted = _matrix(queries, dim)
            ids, vectors = _matrix(data, dim)
            codes, turned = Codes(vectors, turn), wanted @ turn
            for n, own in enumerate(query_ids):
                estimate, bound = codes.estimates(turned[n])
                other = ids != own
                estimate = np.where(other, estimate, -np.inf)
                first = np.argpartition(-estimate, min(k, len(ids) - 1))[:k]
                first = first[other[first]]
                exact = products(vectors[first], wanted[n])
                least = np.sort(exact)[-k] if len(first) >= k else -np.inf
                near = np.nonzero(other & (estimate + bound >= least))[0]
                near = np.union1d(near, first)
                exact = products(vectors[near], wanted[n])
                top = best_of(exact, ids[near], k)
                out.append((np.full(len(top), own), ids[near][top], exact[top]))
        columns = [np.concatenate(c) for c in zip(*out)] or [np.empty(0)] * 3
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "vec_id", "score"])

    return run


def _matrix(block: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a block; of rows that repeat an id the smallest vector."""
    lists = block.column("vector").combine_chunks()
    vectors = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)
    ids = block.column("vec_id").to_numpy()
    if len(np.unique(ids)) < len(ids):
        order = np.lexsort((*vectors.T[::-1], ids))
        rows = order[np.unique(ids[order], return_index=True)[1]]
        return ids[rows], vectors[rows]
    return ids, vectors


def usable(vector: Column) -> Column:
    """Not null, not all zero, every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, queries: Column, k: int = 20) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the ``k`` nearest found of each query.

    ``vectors`` has vec_id and embedding; ``queries`` is a condition on it. A row's own
    vec_id is no candidate of it. Score is the inner product in double precision, ties go to
    the smaller vec_id. Vectors that are null, zero, or hold null or non-finite components
    take no part, nor do null vec_ids or vectors of another length than the most frequent
    one (ties: the longest). Of rows that repeat a vec_id the one with the smallest
    components counts. Fewer candidates than ``k`` are all returned. Other columns are not looked at.

    Codes are made of every row, where its block meets a block of queries; a task holds one
    block of each. Each block pair passes on ``k`` rows a query.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"), queries.alias("asks")
    ).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("dim")).agg(
        F.count("*").alias("n"), F.count(F.when(F.col("asks"), 1)).alias("asked")
    )
    common = lengths.orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    dim, n, asked = common[0] if common else (1, 0, 0)
    rows = rows.where(F.size("vector") == dim).withColumn("vector", F.col("vector").cast("array<double>"))
    parts, asking = max(1, -(-n // DATA_BLOCK)), max(1, -(-asked // QUERY_BLOCK))
    numbers = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    block = lambda count: F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")
    data = rows.select("vec_id", "vector", block(parts).alias("d")).withColumn("q", numbers(asking))
    wanted = rows.where("asks").select("vec_id", "vector", block(asking).alias("q")).withColumn("d", numbers(parts))
    found = wanted.groupBy("q", "d").cogroup(data.groupBy("q", "d")).applyInArrow(
        _searched(k, dim), "query_id long, vec_id long, score double"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
