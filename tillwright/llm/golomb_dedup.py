"""Exact duplicates of texts by an exchange of Golomb-coded fingerprints.

Texts are equal when they are identical after lower-casing A-Z. The documents are written once, dealt to parts as they were read, into a table
that is bucketed by part; what follows works inside the parts and moves no text unless it is suspected of having a copy.

1. Each part sorts the fingerprints of its texts, each once, and sends every owner of a range of fingerprints those in its range, as Golomb codes
   (with powers of two for divisors) of the gaps between them. Fingerprints have ten bits more than the number of documents needs, so a code
   takes about 12 bits, and one text in a thousand is suspected without cause.
2. An owner finds the fingerprints that several parts sent and answers each part with a bitmap over what it sent. A text that a third of all rows
   hold comes once from each part.
3. Texts with a marked fingerprint, or one that their own part holds twice, are suspects. Each part folds its suspects by their SHA-256 and sends one
   text of each to where all of one sum meet; there the bytes are compared. Two texts with one sum end the job with an error.
4. What was found for a sum goes back to the parts that hold it, one row for a part, and on to their rows.

Bounds: a part has at most ``PART`` rows, an owner about ``OWNED`` fingerprints, whatever the size of the table.

Null counts as empty text. Of equal texts the row with the largest doc_id stays; a null id is smaller than any other; of several rows with that id the one
that was read first stays, so exactly one of a group is kept. Other columns play no part, nor do their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tillwright.llm.common import by_part, in_place, ready, text_slices

#: Rows of a part (as a power of two) and fingerprints of an owner, and bits beyond those that tell the documents apart.
PART_BITS = 17
OWNED = 1 << 22
SPARE_BITS = 10
SEED = 42
MESSAGE = "part long, owner long, n long, shift int, unary binary, rest binary"
ANSWER = "part long, owner long, repeated binary"


def encode(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """Golomb code of ascending different numbers: the divisor's logarithm, all quotients in unary, all remainders."""
    gaps = np.diff(values.astype(np.int64), prepend=-1) - 1
    mean = (int(values[-1]) + 1) / len(values)
    shift = max(0, math.floor(math.log2(max(1.0, mean * math.log(2)))))
    ends = np.cumsum((gaps >> shift) + 1)
    unary = np.zeros(int(ends[-1]), np.uint8)
    unary[ends - 1] = 1
    bits = np.unpackbits((gaps & ((1 << shift) - 1)).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return shift, np.packbits(unary).tobytes(), np.packbits(bits[:, 64 - shift :]).tobytes()


def decode(n: int, shift: int, unary: bytes, rest: bytes) -> np.ndarray:
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    gaps = np.diff(ends, prepend=-1) - 1
    if shift:
        bits = np.zeros((n, 64), np.uint8)
        bits[:, 64 - shift :] = np.unpackbits(np.frombuffer(rest, np.uint8), count=n * shift).reshape(n, shift)
        gaps = (gaps << shift) + np.packbits(bits, axis=1).view(">u8").ravel().astype(np.int64)
    return np.cumsum(gaps + 1) - 1


@dataclass(frozen=True)
class Ranges:
    """How a 64-bit hash is cut to a fingerprint, and the owners' ranges of it."""

    bits: int
    owner_bits: int

    @classmethod
    def of(cls, n: int) -> Ranges:
        return cls(min(62, max(1, n).bit_length() + SPARE_BITS), max(0, -(-max(1, n) // OWNED) - 1).bit_length())

    def fingerprints(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes.view(np.uint64) >> np.uint64(64 - self.bits)).astype(np.int64)

    def by_owner(self, prints: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Owner and its share of ascending fingerprints, as distances from the start of its range."""
        width = self.bits - self.owner_bits
        owners = prints >> width
        starts = np.flatnonzero(np.diff(owners, prepend=-1))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(prints)]):
            yield int(owners[a]), prints[a:b] & ((1 << width) - 1)

    def send(self, key: tuple, held: pa.Table) -> pa.Table:
        prints = np.unique(self.fingerprints(held.column("hash").to_numpy()))
        rows = [(key[0].as_py(), owner, len(values), *encode(values)) for owner, values in self.by_owner(prints)]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["part", "owner", "n", "shift", "unary", "rest"])

    def suspects(self, key: tuple, held: pa.Table, answers: pa.Table) -> pa.Table:
        """The part's hashes whose fingerprints are marked by an owner or repeated in the part itself."""
        hashes = held.column("hash").to_numpy()
        prints, place, counts = np.unique(self.fingerprints(hashes), return_inverse=True, return_counts=True)
        said = dict(zip(answers.column("owner").to_pylist(), answers.column("repeated").to_pylist()))
        parts = [np.unpackbits(np.frombuffer(said[owner], np.uint8), count=len(values)) for owner, values in self.by_owner(prints)]
        marked = (counts > 1) | (np.concatenate([*parts, np.zeros(0, np.uint8)]) == 1)
        found = np.unique(hashes[marked[place]])
        return pa.table([pa.array(np.full(len(found), key[0].as_py()), pa.int64()), pa.array(found, pa.int64())], ["part", "hash"])


def answer(key: tuple, messages: pa.Table) -> pa.Table:
    """A bitmap for each message: which of its fingerprints came in another message too."""
    columns = [messages.column(c).to_pylist() for c in ("n", "shift", "unary", "rest")]
    values = [decode(*row) for row in zip(*columns)]
    all_values, counts = np.unique(np.concatenate(values), return_counts=True)
    several = all_values[counts > 1]
    bitmaps = [np.packbits(np.isin(v, several, assume_unique=True)).tobytes() for v in values]
    return pa.table([messages.column("part"), messages.column("owner"), pa.array(bitmaps, pa.binary())], ["part", "owner", "repeated"])


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some in text_slices(batch, "text"):
            texts = [(t.as_py() or "").encode().lower() for t in some.column("text")]
            hashes = np.array([xxh64_intdigest(t, SEED) for t in texts], np.uint64).view(np.int64)
            sums = pa.array([sha256(t).digest() for t in texts], pa.binary())
            # bytes.lower() changes A-Z only, so the bytes are still UTF-8
            yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(hashes), sums, pa.array(texts, pa.binary())], ["doc_id", "hash", "sum", "text"])


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of ``docs`` (doc_id, text)."""
    ready(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = source.mapInArrow(_normalised, "doc_id long, hash long, sum binary, text binary").withColumn("row", F.monotonically_increasing_id())
    held = by_part(held.withColumn("part", F.shiftright("row", PART_BITS)), "held")
    ranges = Ranges.of(held.count())

    prints = held.select("part", "hash")
    messages = prints.groupBy("part").applyInArrow(lambda key, rows: ranges.send(key, rows), MESSAGE)
    answers = messages.groupBy("owner").applyInArrow(answer, ANSWER)
    both = prints.groupBy("part").cogroup(answers.groupBy("part"))
    suspects = both.applyInArrow(lambda key, rows, said: ranges.suspects(key, rows, said), "part long, hash long")
    suspects = by_part(suspects, "suspects").hint("shuffle_hash")

    rows = held.select("part", "row", "doc_id", "hash", "sum")
    best = F.max(F.struct("doc_id", (-F.col("row")).alias("before")))
    local = rows.join(suspects, ["part", "hash"], "left_semi").groupBy("part", "sum").agg(best.alias("best"), F.count(F.lit(1)).alias("n"))
    texts = held.select("part", "hash", "sum", "text").join(suspects, ["part", "hash"], "left_semi").select("part", "sum", "text").distinct()
    verified = texts.select("sum", "text").repartition("sum").distinct().groupBy("sum").agg(F.count(F.lit(1)).alias("texts"))
    groups = local.groupBy("sum").agg(F.max("best").alias("best"), F.sum("n").alias("n")).join(verified, "sum")
    unlike = F.raise_error(F.concat(F.lit("different texts have the SHA-256 "), F.hex("sum"))).cast("long")
    groups = groups.select("sum", "best", F.when(F.col("texts") == 1, F.col("n")).otherwise(unlike).alias("n"))
    with in_place(docs.sparkSession):
        verdicts = by_part(local.select("part", "sum").join(groups, "sum"), "verdicts")

    # the narrow rows may move; no sum has more rows under one key than its part has
    found = rows.join(verdicts, ["part", "sum"], "left")
    return found.select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("best.before") == -F.col("row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("sum")).alias("text_sha256"),
    )
