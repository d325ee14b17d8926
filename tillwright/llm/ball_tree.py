"""Exact top-k search for the largest inner product: ball trees with branch and bound.

Components become whole numbers, floor(scale x), so scores are exact. Each block of vectors is a tree of balls. A query q can score at most
q c + |q| r in a ball of centre c and radius r; balls are opened in the order of that bound until it falls below the kth score so far.
A query first searches the block that holds its own id; the kth score found there goes with it to all other blocks, where
it prunes from the start. Equal scores are never pruned, since the smaller id wins.

Sums are taken in doubles where they stay below 2^53, else in 64-bit integers. Vectors so long that a score might not fit
64 bits (a norm above 2^31 after scaling) end the job with an error that names one of them.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import stored
from tillwright.llm.search import SIDE, blocks, matrix, meet, ranked, top, usable

LEAF = 128
LONGEST = 2.0**31
FOUND = pa.schema([("row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


class BallTree:
    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(x))
        spans, self.children = [(0, len(x))], []
        k = 0
        while k < len(spans):
            a, b = spans[k]
            rows = self.order[a:b]
            if b - a > leaf:
                values = x[rows]
                axis = int(values.var(axis=0).argmax())
                half = (b - a) // 2
                self.order[a:b] = rows[np.argpartition(values[:, axis], half)]
                self.children.append((len(spans), len(spans) + 1))
                spans += [(a, a + half), (a + half, b)]
            else:
                self.children.append(None)
            k += 1
        self.spans = spans
        self.centres = np.array([x[self.order[a:b]].mean(axis=0) for a, b in spans], dtype=float)
        self.radii = np.array([np.sqrt(((x[self.order[a:b]] - c) ** 2).sum(axis=1).max()) for (a, b), c in zip(spans, self.centres)])
        self.x = np.ascontiguousarray(x[self.order])

    def search(self, q: np.ndarray, k: int, least: float, ids: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (given in the tree's order) and scores of the k best that score ``least`` or more, without the place ``own`` of that order."""
        bounds = self.centres @ q + np.sqrt((q.astype(float) ** 2).sum()) * self.radii
        bounds += 1e-9 * np.abs(bounds) + 1e-3  # rounding
        heap = [(-bounds[0], 0)]
        best, scores = np.zeros(0, np.int64), np.zeros(0, self.x.dtype)
        while heap and -heap[0][0] >= least:
            _, node = heapq.heappop(heap)
            if pair := self.children[node]:
                for child in pair:
                    if bounds[child] >= least:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            a, b = self.spans[node]
            found = self.x[a:b] @ q
            good = np.flatnonzero(found >= least)
            if len(good):
                good = good[a + good != own]
                scores, best = np.concatenate([scores, found[good]]), np.concatenate([best, ids[a:b][good]])
                if len(best) >= k:
                    first = top(scores, best, k)
                    scores, best = scores[first], best[first]
                    least = max(least, scores[-1])
        return best, scores


def _search(k: int):
    def search(block: pa.Table, queries: pa.Table) -> pa.Table:
        if not block.num_rows or not queries.num_rows:
            return FOUND.empty_table()
        x, y = matrix(block), matrix(queries)
        if x.shape[1] * float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) < 2**53:
            x, y = x.astype(float), y.astype(float)
        tree = BallTree(x)
        ids = block.column("vec_id").to_numpy()[tree.order]
        place = dict(zip(block.column("row").to_numpy()[tree.order].tolist(), range(len(x))))
        least = queries.column("least").to_numpy(zero_copy_only=False) if "least" in queries.column_names else np.full(len(y), np.nan)
        asked, found = queries.column("row").to_numpy(), []
        for q, own, bound in zip(y, asked.tolist(), np.where(np.isnan(least.astype(float)), -np.inf, least.astype(float))):
            found.append(tree.search(q, k, bound, ids, place.get(own, -1)))
        counts = [len(i) for i, _ in found]
        columns = [np.repeat(asked, counts), np.repeat(queries.column("vec_id").to_numpy(), counts), np.concatenate([i for i, _ in found]), np.concatenate([s for _, s in found]).astype(np.int64)]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, FOUND)], schema=FOUND)

    return search


def best(vectors: DataFrame, every: int, k: int, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by ``every``, the k highest scores among all other rows."""
    schema = "row long, query_id long, vec_id long, score long"
    rows = usable(vectors, zero=True)
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + (v * scale) * (v * scale))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("most"), F.max_by("vec_id", square).alias("longest")).first()
    n = size["n"]
    if n and size["most"] >= LONGEST**2:
        raise ValueError(f"vec_id {size['longest']}: scores of so long a vector might not fit 64 bits")
    rows = rows.select("row", "vec_id", F.transform("x", lambda v: F.floor(v * scale)).alias("x"))
    n_blocks, n_sides = blocks(n), blocks(n // every, SIDE)
    queries = rows.filter(F.col("vec_id") % every == 0)
    near = stored(meet(rows, queries, n_blocks, n_sides, "only", _search(k), schema), "own-block")
    # the kth score so far; none if the block has fewer than k others
    kth = near.groupBy("row").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least"))
    asked = queries.join(kth, "row", "left").select("row", "vec_id", "x", "least")
    far = meet(rows, asked, n_blocks, n_sides, "not", _search(k), schema)
    return ranked(near.unionByName(far), k)
