"""Exact top-k inner products by columnar branch and bound.

Candidates are held in vertical layout: one row of the matrix per dimension.
For a block of queries, partial products are accumulated over one block of
dimensions after another.  After each block, what the remaining dimensions can
still add is at most the product of the norms of the rests (remaining mass);
candidates whose partial product plus that bound stays below the query's
current k-th best score are dropped and the surviving ones compacted.  Bounds
keep a slack of half a unit, so rounding never drops an integer score.

Queries are the stated query set.  They are dealt by hash into blocks of at
most about ``BLOCK_BYTES``, each broadcast to a scan of all candidates.  Each
task keeps k candidates a query; the final choice ranks these.

Vectors that are null, or hold null or non-finite components, take no part,
nor do rows without id.  Vectors of different lengths are not compared.
A repeated id is one candidate with its best score, and one query with the
best scores of its rows.  Ties go to the smaller id.  Fewer than k candidates:
all of them.  An empty table gives an empty result.  Scores must stay below
2**53 in magnitude.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BYTES = 8 << 20
DIMS = 16
CHUNK = 4096
QUERIES_AT_ONCE = 128


def quantised(vec: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, as doubles."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def usable(vec: Column) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(False))


class _Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores: list[np.ndarray] = [np.empty(0)] * n
        self.ids: list[np.ndarray] = [np.empty(0, np.int64)] * n
        self.least = np.full(n, -np.inf)

    def offer(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        s, i = np.concatenate([self.scores[q], scores]), np.concatenate([self.ids[q], ids])
        order = np.lexsort((i, -s))
        _, first = np.unique(i[order], return_index=True)
        order = order[np.sort(first)][:self.k]
        self.scores[q], self.ids[q] = s[order], i[order]
        if len(order) == self.k:
            self.least[q] = self.scores[q][-1]


def _rests(rows: np.ndarray, dims: int) -> np.ndarray:
    """Norm of what remains from the beginning of each block of dimensions; the last is 0."""
    mass = np.add.reduceat(rows * rows, np.arange(0, rows.shape[0], dims), axis=0)
    return np.sqrt(np.vstack([np.cumsum(mass[::-1], axis=0)[::-1], np.zeros(rows.shape[1])]))


def _scan(best: _Best, q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray) -> None:
    """Offer the candidates ``c`` (dimensions by candidates, in order of id) to the queries ``q``."""
    d = c.shape[0]
    q_rest, c_rest = _rests(q, DIMS), _rests(c, DIMS)
    for lo in range(0, q.shape[1], QUERIES_AT_ONCE):
        own = slice(lo, lo + QUERIES_AT_ONCE)
        part = q[:DIMS, own].T @ c[:DIMS]
        near = part + np.outer(q_rest[1, own], c_rest[1]) * (1 + 1e-9) + 0.5 >= best.least[own, None]
        near &= q_ids[own, None] != c_ids[None, :]
        for j in range(part.shape[0]):
            k = lo + j
            alive = np.flatnonzero(near[j])
            score = part[j, alive]
            for b, at in enumerate(range(DIMS, d, DIMS), 2):
                if not len(alive):
                    break
                score = score + q[at:at + DIMS, k] @ c[at:at + DIMS][:, alive]
                stay = score + q_rest[b, k] * c_rest[b, alive] * (1 + 1e-9) + 0.5 >= best.least[k]
                if not stay.all():
                    alive, score = alive[stay], score[stay]
            if len(alive) > 4 * best.k:
                # one best score per id, so that the bar is that of the k-th best id
                own_ids = c_ids[alive]
                first = np.flatnonzero(np.concatenate([[True], own_ids[1:] != own_ids[:-1]]))
                alive, score = alive[first], np.maximum.reduceat(score, first)
            if len(alive) > 4 * best.k:
                # all that tie with the k-th remain; ids decide later
                keep = score >= np.partition(score, len(score) - best.k)[len(score) - best.k]
                order = np.lexsort((c_ids[alive[keep]], -score[keep]))[:best.k]
                alive, score = alive[keep][order], score[keep][order]
            if len(alive):
                best.offer(k, score, c_ids[alive])


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # queries of one length of vector: ids, and dimensions by queries
        groups = {d: (ids, m, _Best(len(ids), k)) for d, (ids, m) in shared.value.items()}
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            vecs = b.column(1)
            lengths = np.diff(vecs.offsets.to_numpy())
            flat, first = vecs.values.to_numpy(zero_copy_only=False), vecs.offsets.to_numpy()
            for d, (q_ids, q, best) in groups.items():
                rows = np.flatnonzero(lengths == d)
                for lo in range(0, len(rows), CHUNK):
                    own = rows[lo:lo + CHUNK]
                    own = own[np.argsort(ids[own], kind="stable")]
                    if d == 0:
                        c = np.zeros((1, len(own)))
                    else:
                        c = np.ascontiguousarray(flat[first[own][:, None] + np.arange(d)].T)
                    _scan(best, q_ids, q, ids[own], c)
        for q_ids, _, best in groups.values():
            n = np.array([len(x) for x in best.ids])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(q_ids, n), pa.int64()),
                pa.array(np.concatenate([*best.ids, np.empty(0, np.int64)]), pa.int64()),
                pa.array(np.concatenate([*best.scores, np.empty(0)]).astype(np.int64), pa.int64())],
                names=["query_id", "vec_id", "score"])
    return run


def _matrix(rows: list) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    by_length: dict[int, list] = {}
    for r in rows:
        by_length.setdefault(len(r[1]), []).append(r)
    return {d: (np.array([r[0] for r in own], np.int64),
                np.ascontiguousarray(np.array([r[1] or [0.0] for r in own], float).T))
            for d, own in by_length.items()}


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "vec",
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_id, rank (from 1), ``vec_id``, score: the ``k`` rows of ``candidates`` of highest
    inner product for each row of ``queries``, its own id left out.  Vectors are arrays of
    doubles with integer values."""
    spark = candidates.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        return df.where(F.col(id_col).isNotNull() & usable(F.col(vec_col))).select(
            F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))

    own = clean(queries).distinct()
    size = own.agg(F.sum(F.size("vec") * 8 + 8)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    found = []
    for b in range(blocks):
        block = own.where(F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)) == b).collect()
        shared = spark.sparkContext.broadcast(_matrix(block))
        found.append(clean(candidates).mapInArrow(_search(shared, k), "query_id long, vec_id long, score long"))
    rows = reduce(DataFrame.unionByName, found)
    # rows of one id may lie in several tasks
    rows = rows.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (rows.select("query_id", F.row_number().over(w).alias("rank"), "vec_id", "score")
            .where(F.col("rank") <= k))
