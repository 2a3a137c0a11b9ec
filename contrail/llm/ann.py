"""Nearest neighbours by cosine with collision-counting hashing.

Every block of vectors gets one sorted array for each of `projections` directions, which come as whole orthonormal
bases. A query opens a window around its own value in each array and widens all of them step by step (virtual rehashing:
a window of radius R is R times the basic width, so no array is built anew). Of two vectors at distance R a projection falls into a
window of radius R with one known chance; a vector that is met in nearly that share of the windows is verified on the original
vectors. A query is done with a block when its k-th verified neighbour lies within the radius that its windows have covered.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Half a window at radius 1, in standard deviations of the projection of a difference of length 1: the chance to be inside is 0.77.
WIDTH = 1.2
#: By how many standard deviations of a count the threshold lies below what is expected at a window's own radius.
MARGIN = 0.7
#: Bytes and rows of vectors in one index, and queries that are put to it at a time.
BLOCK_BYTES, BLOCK, QUERIES = 32 << 20, 1 << 14, 1 << 10
#: Coarse steps where few vectors are met, fine ones where most of the work is. The last radius covers whole arrays.
RADII = np.array([0.1 * 1.6**k for k in range(5)] + [0.8 * 1.06**k for k in range(17)] + [np.inf])


def bases(dim: int, n: int, seed: int) -> np.ndarray:
    """n directions in columns: orthonormal bases one after the other, the last one cut."""
    rng = np.random.default_rng(seed)
    return np.concatenate([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-n // dim))], axis=1)[:, :n]


def threshold(projections: int) -> int:
    chance = math.erf(WIDTH / math.sqrt(2))
    return max(1, math.ceil(projections * chance - MARGIN * math.sqrt(projections * chance * (1 - chance))))


class Vectors:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        self.vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])  # exact, and squares stay finite
        self.norms = np.sqrt((self.vectors**2).sum(axis=1))
        self.units = self.vectors / self.norms[:, None]


class Block(Vectors):
    """One index. verified: how many vectors were verified so far, for all queries together."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int, seed: int):
        super().__init__(ids, vectors)
        self.threshold, self.verified, self.repeated = threshold(projections), 0, len(np.unique(ids)) < len(ids)
        self.directions = bases(vectors.shape[1], projections, seed)
        values = self.units @ self.directions
        self.order = np.argsort(values, axis=0, kind="stable").T.astype(np.int32, order="C")
        self.sorted = np.take_along_axis(values.T, self.order, axis=1)

    def search(self, queries: Vectors, k: int):
        """(query id, ids, scores): at most k of this block for each query, nearest first, ties to smaller ids."""
        half = WIDTH * RADII / math.sqrt(self.vectors.shape[1])
        for first in range(0, len(queries.ids), QUERIES):
            part = slice(first, first + QUERIES)
            at = queries.units[part] @ self.directions
            low, high = (np.stack([np.searchsorted(s, (at[:, j, None] + sign * half).ravel(), side).reshape(-1, len(RADII)) for j, s in enumerate(self.sorted)], axis=2) for sign, side in ((-1, "left"), (1, "right")))
            for q in range(len(at)):
                yield from self._nearest(queries, first + q, low[q], high[q], k)

    def _nearest(self, queries: Vectors, q: int, low: np.ndarray, high: np.ndarray, k: int):
        found, cosines = self._near(queries, q, low, high, k)
        if not len(found):
            return
        # in full: rows that may still be among the k nearest, ties included
        least = -2 if self.repeated else np.partition(cosines, len(found) - min(k, len(found)))[len(found) - min(k, len(found))]
        found = found[cosines >= least - 1e-9]
        exact = (self.vectors[found] * queries.vectors[q]).sum(axis=1) / (self.norms[found] * queries.norms[q])
        order = np.lexsort((self.ids[found], -exact))
        _, first = np.unique(self.ids[found][order], return_index=True)
        best = np.sort(first)[:k]
        yield queries.ids[q], self.ids[found][order][best], exact[order][best]

    def _near(self, queries: Vectors, q: int, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The vectors that were verified, with their cosines. low, high: the windows' ends by radius and projection."""
        counts, done = np.zeros(len(self.ids), dtype=np.int64), self.ids == queries.ids[q]
        found, cosines = np.empty(0, dtype=np.int64), np.empty(0)
        before = [low[0].tolist(), low[0].tolist()]
        for r, radius in enumerate(RADII):
            a, b = low[r].tolist(), high[r].tolist()
            new = [o[x:y] for o, x, y in zip(self.order, a, before[0]) if x < y] + [o[x:y] for o, x, y in zip(self.order, before[1], b) if x < y]
            before = [a, b]
            if new:
                counts += np.bincount(np.concatenate(new), minlength=len(counts))
            fresh = np.flatnonzero((counts >= self.threshold) & ~done)
            if len(fresh):
                done[fresh] = True
                found, cosines = np.append(found, fresh), np.append(cosines, self.units[fresh] @ queries.units[q])
            best = self._best(found, cosines, k)
            if best is not None and math.sqrt(max(0.0, 2 - 2 * best)) <= radius:
                break
        self.verified += len(found)
        return found, cosines

    def _best(self, found: np.ndarray, cosines: np.ndarray, k: int) -> float | None:
        """The k-th largest cosine; an id counts once."""
        if self.repeated and len(found):
            order = np.argsort(-cosines, kind="stable")
            _, first = np.unique(self.ids[found][order], return_index=True)
            cosines = cosines[order][first]
        return np.partition(cosines, len(cosines) - k)[len(cosines) - k] if len(cosines) >= k else None


def usable(vector):
    """Neither null nor zero, all components present and finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def _matrices(table: pa.Table):
    """(ids, matrix) for each length of vectors."""
    held = table.column("v").combine_chunks()
    held = held.combine_chunks() if isinstance(held, pa.ChunkedArray) else held
    ids, ends = table.column("vec_id").to_numpy(), np.asarray(held.offsets)
    flat, sizes = held.values.to_numpy(zero_copy_only=False), np.diff(ends)
    for d in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == d)
        yield ids[at], flat[ends[at][:, None] + np.arange(d)]


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def nearest(
    vectors: DataFrame, is_query, k: int = 5, projections: int = 128, seed: int = 11, id_col: str = "vec_id", vector_col: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row where is_query holds its k nearest found among all
    rows with another id, by cosine of the original vectors in double precision, ties to smaller ids.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do null ids. Vectors of other length
    than the query's are no candidates. Of rows with one id the nearest counts once; as a query the least vector counts.
    Other columns are not read; no vectors or no queries, no rows. Vectors are dealt by a hash into blocks of about `block` rows and 32 MB, queries into slices of
    about QUERIES; each block meets each slice in a task of its own, and returns k rows for each query at most.
    """
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"), is_query.alias("q"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    asked = rows.where("q").groupBy("vec_id").agg(F.min("v").alias("v"))
    n, size, n_asked = rows.agg(F.count("*"), F.sum(F.size("v") * 8), F.count_distinct(F.when(F.col("q"), F.col("vec_id")))).first()
    blocks = max(-(-n // block), -(-(size or 0) // BLOCK_BYTES), 1)
    slices = max(-(-n_asked // QUERIES), 1)

    def all_of(name: str, number: int):
        return F.explode(F.sequence(F.lit(0), F.lit(number - 1))).alias(name)

    held = rows.select("vec_id", "v").distinct().select("vec_id", "v", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int").alias("block"), all_of("slice", slices))
    put = asked.select("vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.lit(slices)).cast("int").alias("slice"), all_of("block", blocks))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            queries = {m.shape[1]: Vectors(i, m) for i, m in _matrices(right)}
            for i, m in _matrices(left):
                if m.shape[1] in queries:
                    for query, near, scores in Block(i, m, projections, seed).search(queries[m.shape[1]], k):
                        out.append((np.full(len(near), query), near, scores))
        return pa.table([np.concatenate(x) for x in zip(*out)] if out else [[], [], []], schema=FOUND)

    found = held.groupBy("block", "slice").cogroup(put.groupBy("block", "slice")).applyInArrow(run, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
