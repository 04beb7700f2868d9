"""Nearest neighbours by inner product from randomly rotated one-bit codes.

A vector is rotated at random and kept as the signs of its coordinates, with two scalars: its length
and how well the signs align with it. From them the inner product with any query is estimated
without bias, within a bound that holds with high probability. A vector is ranked again by its
original coordinates if its estimate plus the bound reaches the score a query already has.

Vectors and queries are packed into blocks; every block of queries meets every block of vectors, and
a task keeps only the best of each query over all the vectors it sees.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.session import materialise

SEED = 7

#: Half-width of the bounds in standard deviations of the estimate.
DEVIATIONS = 3.0

#: Vectors and queries in a block, and parts that the vectors are dealt to (each part hands on one
#: list per query).
VECTOR_ROWS, QUERY_ROWS, PARTS = 4096, 512, 8


@functools.lru_cache(maxsize=4)
def rotation(dimensions: int) -> np.ndarray:
    """A random orthogonal matrix, the same on every machine."""
    normal = np.random.default_rng(SEED).standard_normal((dimensions, dimensions))
    q, r = np.linalg.qr(normal)
    return (q * np.sign(np.diag(r))).astype(np.float32)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, lengths and alignments of the rows (float32, none zero)."""
    turned = vectors @ rotation(vectors.shape[1]).T
    length = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
    bits = turned > 0
    signs = np.where(bits, np.float32(1), np.float32(-1)) / np.sqrt(np.float32(turned.shape[1]))
    align = (turned * signs).sum(1) / length
    return np.packbits(bits, axis=1), length.astype(np.float32), align.astype(np.float32)


def estimate(
    codes: np.ndarray, length: np.ndarray, align: np.ndarray, queries: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (vectors by queries) and their bounds."""
    d = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=d).astype(np.float32) * 2 - 1
    turned = queries @ rotation(d).T
    scale = length / np.maximum(align, 1e-6) / np.sqrt(np.float32(d))
    spread = length * np.sqrt(np.maximum(0.0, 1 - align * align)) / np.maximum(align, 1e-6)
    size = np.sqrt((queries.astype(np.float64) ** 2).sum(1)).astype(np.float32)
    found = scale[:, None] * (signs @ turned.T)
    bound = DEVIATIONS / np.sqrt(max(1, d - 1)) * spread[:, None] * size[None, :]
    return found, bound + 1e-5 * np.abs(found)


def usable(arrays: pd.Series) -> np.ndarray:
    """Which entries are vectors without missing or infinite parts and not zero."""
    return np.array([
        a is not None and len(a) > 0 and bool(np.isfinite(np.asarray(a, np.float64)).all())
        and bool(np.any(np.asarray(a, np.float64))) for a in arrays], bool)


_BLOCK = "dim int, ids binary, vectors binary, codes binary, lengths binary, aligns binary"


def _pack(rows_per_block: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[int, tuple[list, list]] = {}

        def block(dim: int) -> pd.DataFrame:
            ids, vectors = waiting.pop(dim)
            v = np.array(vectors, np.float32)
            codes, length, align = encode(v)
            return pd.DataFrame([{
                "dim": dim, "ids": np.array(ids, np.int64).tobytes(), "vectors": v.tobytes(),
                "codes": codes.tobytes(), "lengths": length.tobytes(), "aligns": align.tobytes()}])

        for batch in batches:
            batch = batch[batch["id"].notna()]
            batch = batch[usable(batch["vector"])]
            for i, v in zip(batch["id"], batch["vector"]):
                ids, vectors = waiting.setdefault(len(v), ([], []))
                ids.append(int(i))
                vectors.append(np.asarray(v, np.float32))
                if len(ids) >= rows_per_block:
                    yield block(len(v))
        for dim in list(waiting):
            yield block(dim)

    return run


class _Best:
    """The k best of each query of a block so far: largest score, then smallest id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.exact = vectors.astype(np.float64)
        self.score = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), -1, np.int64)

    def see(self, ids, vectors, codes, length, align) -> None:
        guess, bound = estimate(codes, length, align, self.vectors)
        own = np.flatnonzero(np.isin(ids, self.ids))
        guess[own] = np.where(ids[own, None] == self.ids[None, :], -np.inf, guess[own])
        original = vectors.astype(np.float64)
        least = self.score[:, -1]
        few = 2 * self.k
        if len(ids) > few and np.isneginf(least).any():
            # the first block: the best by estimate give the queries a score to reach
            first = np.argpartition(guess, len(ids) - few, axis=0)[-few:]
            scores = np.stack([self._scores(original, first[:, q], q) for q in range(len(self.ids))])
            scores[np.isneginf(np.take_along_axis(guess, first, 0)).T] = -np.inf
            least = np.maximum(least, np.partition(scores, few - self.k, axis=1)[:, -self.k])
        # by query, so that a query is multiplied with all its vectors at once
        least = np.maximum(least, np.finfo(np.float64).min)  # a query's own row has no estimate
        guess += bound
        q, v = np.nonzero(np.ascontiguousarray((guess >= least[None, :]).T))
        cuts = np.searchsorted(q, np.arange(len(self.ids) + 1))
        scores = np.concatenate([np.zeros(0)] + [
            self._scores(original, v[a:b], i) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a])
        enough = scores >= least[q]
        q, scores, new = q[enough], scores[enough], ids[v[enough]]
        held_q, held_k = np.nonzero(np.isfinite(self.score))
        q = np.concatenate([held_q, q])
        scores = np.concatenate([self.score[held_q, held_k], scores])
        new = np.concatenate([self.found[held_q, held_k], new])
        order = np.lexsort((new, -scores, q))
        q, scores, new = q[order], scores[order], new[order]
        first = np.searchsorted(q, np.arange(len(self.ids)))
        rank = np.arange(len(q)) - first[q]
        keep = rank < self.k
        self.score[:], self.found[:] = -np.inf, -1
        self.score[q[keep], rank[keep]] = scores[keep]
        self.found[q[keep], rank[keep]] = new[keep]

    def _scores(self, original: np.ndarray, v: np.ndarray, q: int) -> np.ndarray:
        """Inner products in double precision; equal vectors get equal ones."""
        return np.einsum("ij,j->i", original[v], self.exact[q])

    def rows(self) -> pd.DataFrame:
        q, k = np.nonzero(np.isfinite(self.score))
        return pd.DataFrame({
            "query_id": self.ids[q], "vec_id": self.found[q, k], "score": self.score[q, k]})


def _search(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[bytes, _Best] = {}
        for batch in batches:
            for r in batch.itertuples(index=False):
                if r.dim != r.q_dim:
                    continue
                if r.q_ids not in best:
                    best[r.q_ids] = _Best(
                        np.frombuffer(r.q_ids, np.int64),
                        np.frombuffer(r.q_vectors, np.float32).reshape(-1, r.dim), k)
                best[r.q_ids].see(
                    np.frombuffer(r.ids, np.int64),
                    np.frombuffer(r.vectors, np.float32).reshape(-1, r.dim),
                    np.frombuffer(r.codes, np.uint8).reshape(-1, (r.dim + 7) // 8),
                    np.frombuffer(r.lengths, np.float32), np.frombuffer(r.aligns, np.float32))
        for b in best.values():
            yield b.rows()

    return run


def nearest(
    vectors: DataFrame, queries: Column, k: int, vector: str = "embedding", id_col: str = "vec_id",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of each row that ``queries`` selects.

    Candidates are all rows but those with the query's id. Rows without id and vectors that are
    missing, empty, zero or hold missing or non-finite parts take no part; vectors of different
    lengths do not meet. Scores are computed on the original vectors in double precision; ties go
    to the smaller id. Fewer candidates than ``k`` are all returned; an empty table gives no rows.
    Ids are meant to be unique; equal rows count once. The order of work is the number of queries
    times the number of vectors, in blocks; a task holds one block of vectors and its queries.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("vector"),
                          queries.alias("asked"))
    index = materialise(
        rows.select("id", "vector").mapInPandas(_pack(VECTOR_ROWS), _BLOCK), "codes")
    asked = materialise(
        rows.filter("asked").select("id", "vector").mapInPandas(_pack(QUERY_ROWS), _BLOCK)
        .select(F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"),
                F.col("vectors").alias("q_vectors")), "queries")
    met = index.repartition(PARTS).crossJoin(asked)  # blocks, not rows
    found = met.mapInPandas(
        _search(k), "query_id long, vec_id long, score double").distinct()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
