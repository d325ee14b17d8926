"""SimHash near-duplicates by pigeonhole blocks.

A text's fingerprint has 64 bits: of the XXH64 sums of its word shingles, a bit is set if more than half of them have
it. Two fingerprints link if few bits differ. The bits are cut into ``DISTANCE + KEPT`` blocks; two fingerprints within
``DISTANCE`` bits agree on ``KEPT`` whole blocks at least, so they meet in a join on some choice of so many blocks, where their
distance is verified. With 5 blocks and 2 kept a key has 25 or 26 bits, which keeps chance meetings rare.

Equal fingerprints are one row before the join, so copies are never paired. Fingerprints whose key holds many others
are the near copies themselves; a join that adaptive execution splits spreads them. No pair is left out.

Null and empty texts have fingerprint 0 and link like any other. Null doc_ids never are the smallest one; a component without
any other id has a null component_id. Repeated ids and equal rows each give a row. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tillwright.llm.common import free_names, ready, row_key, stored, text_slices
from tillwright.llm.graph import components

DISTANCE = 3
KEPT = 2
SHINGLE = 3
SEED = 42
#: Hashes whose bits are counted at a time.
COUNTED = 1 << 16


def fingerprint(text: str | None, words_in_shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint as a signed 64-bit number; ASCII case and white space make no difference."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    last = ends[min(words_in_shingle, len(words)) - 1 :]
    hashes = [xxh64_intdigest(joined[a : b - 1], seed) for a, b in zip(starts, last)]
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), COUNTED):
        data = np.array(hashes[k : k + COUNTED], dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(data, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def _fingerprints(words_in_shingle: int, seed: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in text_slices(batch, "text"):
                found = [fingerprint(t.as_py(), words_in_shingle, seed) for t in some.column("text")]
                kept = [c for c in some.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in kept), pa.array(found, pa.int64())], [*kept, "fp"])

    return rows


def fingerprints(docs: DataFrame, words_in_shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, row (hash of all columns), fp of every document; computed once and stored."""
    ready(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(docs, docs.columns).alias("row"), F.col("text").cast("string").alias("text"))
    return stored(source.mapInArrow(_fingerprints(words_in_shingle, seed), "doc_id long, row long, fp long"), "fingerprints")


def block_keys(fp: Column, distance: int = DISTANCE, kept: int = KEPT) -> list[Column]:
    """The fingerprint masked to each choice of ``kept`` out of ``distance + kept`` blocks."""
    n = distance + kept
    bounds = [64 * k // n for k in range(n + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(bounds[:-1], bounds[1:])]
    chosen = [reduce(int.__or__, some) for some in combinations(masks, kept)]
    return [fp.bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)) for m in chosen]


def links(fps: DataFrame, distance: int = DISTANCE, kept: int = KEPT) -> DataFrame:
    """a, b: every pair of different fingerprints at most ``distance`` bits apart."""
    keys = block_keys(F.col("fp"), distance, kept)
    distinct = fps.select("fp").distinct()
    keyed = distinct.select("fp", F.posexplode(F.array(*keys)).alias("choice", "key"))
    left, right = keyed.toDF("a", "choice", "key"), keyed.toDF("b", "choice", "key")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    # of all choices on which a pair agrees, the first one counts
    differ = F.col("a").bitwiseXOR(F.col("b"))
    first = F.array_position(F.array(*[k == 0 for k in block_keys(differ, distance, kept)]), True) - 1
    met = left.join(right, ["choice", "key"]).filter(near & (first == F.col("choice")))
    return met.select("a", "b")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, kept: int = KEPT) -> DataFrame:
    """doc_id, row, fp, cluster (smallest linked fingerprint) and component_id (smallest linked doc_id) of every document."""
    fps = fingerprints(docs)
    roots = components(links(fps, distance, kept))
    joined = fps.join(roots, fps["fp"] == roots["node"], "left")
    clustered = stored(joined.select("doc_id", "row", "fp", F.coalesce("root", "fp").alias("cluster")), "clusters")
    least = clustered.groupBy("cluster").agg(F.min("doc_id").alias("component_id"))
    return clustered.join(least, "cluster").select("doc_id", "row", "fp", "cluster", "component_id")


def joined(found: DataFrame, other: DataFrame) -> DataFrame:
    """doc_id, row and cluster of every document, where clusters that have a document in common in either grouping are one."""
    ids = ["doc_id", "row"]
    mine, others = found.select(*ids, F.col("cluster").alias("met")), other.select(*ids, "cluster")
    same = mine["doc_id"].eqNullSafe(others["doc_id"]) & (mine["row"] == others["row"])
    # equal rows are in the same clusters
    both = stored(mine.distinct().join(others, same).select(*[others[c] for c in ids], "met", "cluster"), "both")
    pairs = both.select("met", "cluster").distinct()
    least = pairs.groupBy("met").agg(F.min("cluster").alias("least"))
    roots = components(pairs.join(least, "met").select(F.col("cluster").alias("a"), F.col("least").alias("b")))
    return both.join(roots, F.col("cluster") == roots["node"], "left").select(*ids, F.coalesce("root", "cluster").alias("cluster"))


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Of every cluster, the document with the smallest id (null last; then the smallest row hash), once."""
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    hashed, of, row = free_names(["hashed", "of", "row"], docs.columns)
    kept = found.groupBy("cluster").agg(F.min(rank).alias("least")).select(F.col("least.id").alias(of), F.col("least.row").alias(row))
    rows = docs.withColumn(hashed, row_key(docs, docs.columns))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(of)) & (F.col(hashed) == F.col(row))
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", hashed]).select(*docs.columns)
