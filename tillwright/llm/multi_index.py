"""Approximate nearest neighbours by multi-index hashing, for the largest inner product.

A vector is lengthened to a common norm by one more component, so that the inner product follows the angle, and coded by
the signs of learned rotations: principal axes, then the rotation that brings them closest to the corners of a cube
(several from different starts, until there are 64 bits). A code is split into eight substrings of eight bits, each with an index of the block. If two codes
differ in at most r = 8 q + a bits, some substring among the first a + 1 differs in at most q bits or one of the others in at most q - 1, so probing
the buckets within those distances finds every code within r. What is found and really lies within r is ranked by the inner product of
the original vectors, in double precision.

The rotations and r are fitted on at most ``SAMPLE`` vectors, those with the smallest hash: r is such that a share ``RECALL`` of the
sample's own nearest pairs lies within. Where a query finds fewer than k within r in a block, r grows there, up to all codes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.search import FOUND, blocks, matrix, meet, ranked, top, usable

SAMPLE = 8192
ASKED = 512
RECALL = 0.98
BITS, PARTS = 64, 8
GROWTH = 4

_DISTANCE = np.bitwise_count(np.arange(256, dtype=np.uint8))
_NEAR = [np.flatnonzero(_DISTANCE <= q).astype(np.uint8) for q in range(9)]


@dataclass
class Code:
    unit: float  # the largest component; codes are taken of vectors divided by it, so that no square overflows
    norm: float  # the largest length then
    mean: np.ndarray
    axes: np.ndarray  # (components + 1) x 64
    radius: int

    def encode(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Rows of eight bytes."""
        x = x / self.unit
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.norm**2 - (x**2).sum(1), 0))
        if query:
            with np.errstate(all="ignore"):  # a length of 0 beside much greater ones
                x = np.nan_to_num(x * (self.norm / np.linalg.norm(x, axis=1, keepdims=True)))
        return np.packbits((np.column_stack([x, more]) - self.mean) @ self.axes > 0, axis=1)


def learn(sample: np.ndarray, unit: float, norm: float, k: int, recall: float = RECALL, rounds: int = 30, seed: int = 7) -> Code:
    rng = np.random.default_rng(seed)
    scaled = sample / unit
    x = np.column_stack([scaled, np.sqrt(np.maximum(norm**2 - (scaled**2).sum(1), 0))])
    mean = x.mean(0)
    centred = x - mean
    _, vectors = np.linalg.eigh(centred.T @ centred)
    vectors = vectors[:, ::-1][:, : max(1, min(sample.shape[1], BITS))]
    projected, axes = centred @ vectors, []
    while sum(a.shape[1] for a in axes) < BITS:
        turn = np.linalg.qr(rng.normal(size=(vectors.shape[1],) * 2))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.where(projected @ turn > 0, 1.0, -1.0).T @ projected)
            turn = (u @ v).T
        axes.append(vectors @ turn)
    code = Code(unit, norm, mean, np.concatenate(axes, axis=1)[:, :BITS], BITS)
    asked = min(ASKED, len(sample))
    scores = scaled[:asked] @ scaled.T
    scores[np.arange(asked), np.arange(asked)] = -np.inf
    if len(sample) > k:
        best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        held, want = code.encode(sample, False), code.encode(sample[:asked], True)
        apart = np.bitwise_count(held[best] ^ want[:, None, :]).sum(2)
        code.radius = int(np.quantile(apart, recall, method="higher"))
    return code


class Index:
    """One block: for each substring, the rows by its value."""

    def __init__(self, codes: np.ndarray):
        self.codes = np.ascontiguousarray(codes).view(np.uint64).ravel()
        self.rows = [np.argsort(codes[:, p], kind="stable") for p in range(PARTS)]
        self.ends = [np.concatenate([[0], np.cumsum(np.bincount(codes[:, p], minlength=256))]).tolist() for p in range(PARTS)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code differs in at most ``radius`` bits."""
        seen = np.zeros(len(self.codes), bool)
        q, a = divmod(radius, PARTS)
        for p in range(PARTS):
            near = q if p <= a else q - 1
            if near >= 0:
                rows, ends = self.rows[p], self.ends[p]
                for value in (_NEAR[min(near, 8)] ^ code[p]).tolist():
                    seen[rows[ends[value] : ends[value + 1]]] = True
        rows = np.flatnonzero(seen)
        apart = np.bitwise_count(self.codes[rows] ^ code.view(np.uint64)[0])
        return rows[apart <= radius]


def _search(code: Code, k: int):
    def search(block: pa.Table, queries: pa.Table) -> pa.Table:
        if not block.num_rows or not queries.num_rows:
            return FOUND.empty_table()
        x, ids, numbers = matrix(block), block.column("vec_id").to_numpy(), block.column("row").to_numpy()
        y, asked = matrix(queries), queries.column("row").to_numpy()
        index, codes = Index(code.encode(x, False)), code.encode(y, True)
        out = []
        for q, own, vector in zip(codes, asked, y):
            radius = code.radius
            rows = index.within(q, radius)
            while radius < BITS and len(rows) <= k:
                radius = min(BITS, radius + GROWTH)
                rows = index.within(q, radius)
            rows = rows[numbers[rows] != own]
            # a sum over one row is the same wherever the row stands, so equal vectors have equal scores
            rough = x[rows] @ vector
            if len(rows) > k:
                slack = 1e-12 * np.abs(rough).max() + 1e-12 * np.linalg.norm(vector) * code.norm * code.unit
                rows = rows[~(rough < np.partition(rough, len(rows) - k)[len(rows) - k] - slack)]
            scores = (x[rows] * vector).sum(1)
            best = top(scores, ids[rows], k)
            out.append((ids[rows][best], scores[best]))
        counts = [len(i) for i, _ in out]
        of = [np.repeat(c, counts) for c in (asked, queries.column("vec_id").to_numpy())]
        columns = [*of, np.concatenate([i for i, _ in out]), np.concatenate([s for _, s in out])]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, FOUND)], schema=FOUND)

    return search


def nearest(vectors: DataFrame, every: int, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by ``every``, the k nearest found among all other rows."""
    rows = usable(vectors, zero=False)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.array_max(F.transform("x", F.abs))).alias("unit")).first()
    unit = size["unit"] or 1.0
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + (v / unit) * (v / unit))
    norm = float(np.sqrt(rows.agg(F.max(square)).first()[0] or 0.0))
    sample = [r["x"] for r in rows.orderBy(F.xxhash64("row")).limit(SAMPLE).select("x").collect()]
    code = learn(np.array(sample), unit, norm, k) if sample else None
    queries = rows.filter(F.col("vec_id") % every == 0)
    found = meet(rows, queries, blocks(size["n"]), blocks(size["n"] // every, 4096), "also", _search(code, k), "row long, query_id long, vec_id long, score double")
    return ranked(found, k)
