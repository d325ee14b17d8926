"""Near copies by Jaccard similarity of word shingles, candidates by MinHash bands and by rare shingles.

A text's set holds the XXH64 sums of its shingles (of fewer words, one shingle of all); ASCII case and white space make no difference. Texts
with equal sets are one row before anything is compared. Candidates come from two sides:

* Of each set ``ROWS`` minima under random orders make a band's key, for ``BANDS`` bands; sets meet if a key agrees, which two sets of similarity 0.8
  miss with a chance of 0.0001. Each set is compared with the centre of each of its keys, another one for every key, so a group of n near copies
  makes no more than n times ``BANDS`` pairs. This links large groups.
* Where many sets share most of their shingles but are not similar enough, a key's centre is a stranger to most. What tells pairs apart there is
  rare: of each set the ``SKETCH`` smallest sums are taken, and of these all sets that share one held by ``RARE`` sets at most are paired.

A pair is compared if neither size nor the sketches rule it out (the sketches of two sets of similarity 0.8 agree on less than half with a chance
below one in a million), and links if its exact similarity is ``SIMILAR`` or more. So a pair can be missed only if it shares
no rare sum among the smallest and neither set is the other's centre; such sets consist of frequent shingles almost wholly.

Texts stay where they were written, in buckets of their part; those that are compared are sent, one for each set.

Null and empty texts have the empty set and are copies of each other. Repeated ids and equal rows each give a row; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tillwright.llm.common import by_part, in_place, ready, row_key, stored, text_slices
from tillwright.llm.graph import components

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 24, 5
SKETCH, RARE = 64, 32
#: Shingles held by more than this share of the sets: SKETCH / FREQUENT of them at most, so their table can be broadcast.
FREQUENT = 0.01
SEED = 42
#: Rows of a part, as a power of two.
PART_BITS = 17
#: Hashes whose minima are taken at a time.
AT_ONCE = 1 << 14


def shingles(text: str | None, words_in_shingle: int = SHINGLE) -> np.ndarray:
    """The sums of a text's shingles, each once, ascending."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    last = ends[min(words_in_shingle, len(words)) - 1 :]
    return np.unique(np.array([xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip([0, *ends], last)], np.uint64))


def band_keys(found: np.ndarray) -> list[int]:
    """A signed 64-bit number for every band; none of the empty set."""
    if not len(found):
        return []
    factors = np.random.default_rng(SEED).integers(1, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(found), AT_ONCE):
        np.minimum(least, (factors[:, None] * found[None, k : k + AT_ONCE]).min(axis=1), out=least)
    keys = [xxh64_intdigest(part.tobytes(), k) for k, part in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def _hashed(words_in_shingle: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in text_slices(batch, "text"):
                sets, sizes, keys, sketches = [], [], [], []
                for text in some.column("text"):
                    found = shingles(text.as_py(), words_in_shingle)
                    sets.append(xxh64_intdigest(found.tobytes(), SEED))
                    sizes.append(len(found))
                    keys.append(band_keys(found))
                    sketches.append((found[:SKETCH] >> np.uint64(1)).view(np.int64))  # so that signed numbers sort the same
                lists = pa.list_(pa.int64())
                columns = [some.column("doc_id"), some.column("row"), some.column("text"), pa.array(np.array(sets, np.uint64).view(np.int64))]
                columns += [pa.array(sizes, pa.int64()), pa.array(keys, lists), pa.array(sketches, lists)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "text", "set", "size", "keys", "sketch"])

    return rows


def _verified(words_in_shingle: int, similar: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for k in range(batch.num_rows):
                one, other = (shingles(batch.column(c)[k].as_py(), words_in_shingle) for c in ("one", "other"))
                kept.append(similarity(one, other) >= similar)
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return rows


def _banded(sets: DataFrame) -> DataFrame:
    """Each set with the centres of its band keys."""
    keyed = sets.select("set", F.explode("keys").alias("key"))
    centre = F.min(F.struct(F.xxhash64("set", "key").alias("place"), F.col("set").alias("centre"))).alias("least")
    centres = keyed.groupBy("key").agg(centre, F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "least.centre")
    return keyed.join(centres, "key").filter("set <> centre").select(F.least("set", "centre").alias("a"), F.greatest("set", "centre").alias("b"))


def _sharing_rare(sets: DataFrame) -> DataFrame:
    """All pairs of sets that share a sum of their sketches which few sets hold."""
    held = sets.select("set", F.explode("sketch").alias("sum"))
    counts = stored(held.groupBy("sum").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "sums")
    frequent = counts.filter(F.col("n") > F.greatest(F.lit(RARE), F.lit(int(FREQUENT * sets.count())))).select("sum")
    rare = counts.filter(F.col("n") <= RARE).select("sum")
    # frequent sums match nothing below, and left in they would all be sent to one task
    few = held.join(F.broadcast(frequent), "sum", "left_anti").join(rare, "sum")
    met = few.toDF("sum", "a").join(few.toDF("sum", "b"), "sum").filter("a < b")
    return met.select("a", "b")


def _possible(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """Pairs that neither size nor sketch rules out."""
    side = lambda c: sets.select(F.col("set").alias(c), F.struct("size", "sketch").alias(f"{c}_"))
    both = pairs.distinct().join(side("a"), "a").join(side("b"), "b")
    small, large = F.least("a_.size", "b_.size"), F.greatest("a_.size", "b_.size")
    # of the smallest sums of both sets together, the share that both hold
    least = F.slice(F.array_sort(F.array_union("a_.sketch", "b_.sketch")), 1, SKETCH)
    common = F.size(F.array_intersect(least, F.array_intersect("a_.sketch", "b_.sketch")))
    return both.filter((small >= similar * large) & (common >= (similar - 0.3) * F.size(least))).select("a", "b")


def near_copies(docs: DataFrame, words_in_shingle: int = SHINGLE, similar: float = SIMILAR) -> DataFrame:
    """doc_id, row (hash of all columns) and cluster (smallest linked set) of every document."""
    ready(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(docs, docs.columns).alias("row"), F.col("text").cast("string").alias("text"))
    kinds = "doc_id long, row long, text string, set long, size long, keys array<long>, sketch array<long>"
    held = source.mapInArrow(_hashed(words_in_shingle), kinds).withColumn("id", F.monotonically_increasing_id())
    held = by_part(held.withColumn("part", F.shiftright("id", PART_BITS)), "shingles")
    first = F.min(F.struct("id", "part")).alias("first")
    sets = held.groupBy("set").agg(first, *[F.first(c).alias(c) for c in ("size", "keys", "sketch")]).filter("size > 0")
    sets = stored(sets.select("set", "first.*", "size", "keys", "sketch"), "sets")
    pairs = stored(_possible(_banded(sets).union(_sharing_rare(sets)), sets, similar), "pairs")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    needed = by_part(sets.select("set", "id", "part").join(needed, "set", "left_semi"), "needed").select("part", "id").hint("shuffle_hash")
    texts = held.select("part", "id", "set", "text").join(needed, ["part", "id"], "left_semi").select("set", "text")
    both = pairs.join(texts.toDF("a", "one"), "a").join(texts.toDF("b", "other"), "b")
    with in_place(docs.sparkSession):
        links = stored(both.mapInArrow(_verified(words_in_shingle, similar), "a long, b long"), "links")
    roots = components(links)
    joined = held.select("doc_id", "row", "set").join(roots, F.col("set") == roots["node"], "left")
    return stored(joined.select("doc_id", "row", F.coalesce("root", "set").alias("cluster")), "clusters")
