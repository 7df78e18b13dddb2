"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Every component is quantised to floor(scale * x); the score is the integer inner product. Candidates are handled in blocks of
``block`` vectors. A block holds one list per dimension, sorted by value. For a query, the lists are read in step, from the end
that the sign of its component favours; vectors met are scored in full. At depth s no unseen vector can score more than
T(s) = sum over dimensions of component * value at depth s, so reading stops when T(s) is below the k-th best score so far (ties are
read on, because a smaller id wins). Lists are read in growing strides, and T is evaluated on whole strides at once. A task
carries its k-th best scores from block to block, so later blocks stop earlier.

Queries are a stated set, taken in blocks of at most ``QUERY_BLOCK`` by id hash; one block is broadcast at a time and meets all
candidates. Each task sends k rows per query; Spark ranks them, limiting groups before the shuffle.

Vectors that are NULL or hold a NULL or non-finite component take no part. A query meets only vectors of its own number of
dimensions. Candidates are all rows but the query's own: a row of the same vec_id is left out, also a repeated one. Repeated
candidate rows count as one vector if they are equal; ties go to the smaller vec_id. Rows without vec_id take no part. Fewer than
k candidates give fewer rows. Scores must fit into 64 bits.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tradevault.llm.columns import bounded_batches, named

K = 5
SCALE = 256
BLOCK = 16_384
QUERY_BLOCK = 4096
FIRST_DEPTH = 8


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, x) of the vectors that take part."""
    x = F.col("embedding")
    ok = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.col("vec_id").isNotNull()
    source = vectors.select(named(vectors, "vec_id").cast("long").alias("vec_id"), named(vectors, "embedding").cast("array<double>").alias("embedding"))
    return source.where(F.coalesce(ok, F.lit(False))).select("vec_id", F.transform(x, lambda v: F.floor(v * scale)).alias("x"))


def matrices(ids: np.ndarray, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) for each number of dimensions in a batch."""
    offs = np.asarray(column.offsets, np.int64)
    flat = np.asarray(column.values, np.int64)
    size = np.diff(offs)
    for d in np.unique(size).tolist():
        rows = np.flatnonzero(size == d)
        yield ids[rows], flat[offs[rows][:, None] + np.arange(d)]


def products(x: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; by doubles where every partial sum fits into 53 bits."""
    return (x @ q).astype(np.int64) if not exact else x.astype(np.int64) @ q.astype(np.int64)


class Best:
    """The k best (score, id) pairs of each query so far; ties to the smaller id."""

    def __init__(self, k: int) -> None:
        self.k, self.score, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        if len(self.score) == self.k and len(score):
            keep = score >= self.score[-1]
            score, ids = score[keep], ids[keep]
        if len(score):
            score, ids = np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
            order = np.lexsort((ids, -score))
            score, ids = score[order], ids[order]
            new = np.concatenate([[True], (np.diff(ids) != 0) | (np.diff(score) != 0)])
            self.score, self.ids = score[new][: self.k], ids[new][: self.k]

    @property
    def bound(self) -> int | None:
        return int(self.score[-1]) if len(self.score) == self.k else None


class Lists:
    """One block of candidates with its sorted per-dimension lists."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, largest: int) -> None:
        self.ids, d = ids, x.shape[1]
        self.exact = max(1, int(np.abs(x).max(initial=0))) * max(1, largest) * max(1, d) >= 1 << 53
        self.x = x if self.exact else x.astype(np.float64)
        self.order = np.argsort(x, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(self.x, self.order, axis=0)

    def search(self, own: int, q: np.ndarray, best: Best) -> None:
        n, d = self.x.shape
        if d == 0:
            keep = self.ids != own
            best.add(np.zeros(int(keep.sum()), np.int64), self.ids[keep])
            return
        q = q if self.exact else q.astype(np.float64)
        up = np.flatnonzero(q > 0)
        down = np.flatnonzero(q < 0)
        if not len(up) + len(down):
            up = np.array([0])
        seen = np.zeros(n, bool)
        depth, stride = 0, FIRST_DEPTH
        while depth < n:
            upto = min(n, depth + stride)
            fresh = np.zeros(n, bool)
            fresh[self.order[n - upto : n - depth][:, up]] = True
            fresh[self.order[depth:upto][:, down]] = True
            fresh &= ~seen
            seen |= fresh
            at = np.flatnonzero(fresh)
            at = at[self.ids[at] != own]
            best.add(products(self.x[at], q, self.exact), self.ids[at])
            depth = upto
            if depth < n and best.bound is not None:
                threshold = self.sorted[n - depth - 1, up] @ q[up] + self.sorted[depth, down] @ q[down]
                if threshold < best.bound:
                    break
            stride = min(2 * stride, 2048)


def search(candidates: DataFrame, queries: list[tuple[int, list[int]]], k: int, block: int) -> DataFrame:
    """Each task's k best (query_id, vec_id, score) of its candidates."""
    held = candidates.sparkSession.sparkContext.broadcast([(i, np.array(x, np.int64)) for i, x in queries])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = held.value
        best = [Best(k) for _ in wanted]
        waiting: dict[int, list] = defaultdict(list)
        rows: dict[int, int] = defaultdict(int)
        largest = max((int(np.abs(q).max(initial=0)) for _, q in wanted), default=0)

        def run(d: int) -> None:
            ids = np.concatenate([i for i, _ in waiting[d]])
            x = np.concatenate([m for _, m in waiting.pop(d)])
            rows.pop(d)
            for at in range(0, len(ids), block):
                lists = Lists(ids[at : at + block], x[at : at + block], largest)
                for (own, q), b in zip(wanted, best):
                    if len(q) == d:
                        lists.search(own, q, b)

        for batch in batches:
            for ids, x in matrices(batch.column(0).to_numpy(), batch.column(1)):
                d = x.shape[1]
                waiting[d].append((ids, x))
                rows[d] += len(ids)
                if rows[d] >= block:
                    run(d)
        for d in list(waiting):
            run(d)
        query = [own for (own, _), b in zip(wanted, best) for _ in b.ids]
        ids, score = (np.concatenate([getattr(b, f) for b in best]) if best else np.zeros(0, np.int64) for f in ("ids", "score"))
        yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(ids), pa.array(score)], ["query_id", "vec_id", "score"])

    return candidates.mapInArrow(work, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of every row for which ``is_query`` (over ``vec_id``) holds.

    A repeated query id with different vectors is searched once per vector and ranked together.
    """
    bounded_batches(vectors.sparkSession)
    x = quantised(vectors, scale)
    queries = x.where(is_query).distinct()
    n = queries.count()
    n_blocks = max(1, -(-n // query_block))
    out = None
    for b in range(n_blocks):
        part = queries if n_blocks == 1 else queries.where(F.pmod(F.xxhash64("vec_id", "x"), F.lit(n_blocks)) == b)
        found = search(x, [(r["vec_id"], r["x"]) for r in part.orderBy("vec_id").collect()], k, block)
        out = found if out is None else out.unionByName(found)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.distinct().withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
