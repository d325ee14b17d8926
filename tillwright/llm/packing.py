"""Sum-of-squares packing of token sequences.

Documents are encoded whole and end with one id. Only a document longer than a sequence is cut: full pieces, and before
them one with the rest. Pieces are written once with a number of their own and dealt by a hash of it to shards of a bounded expected
size, so neither very long documents nor equal rows fill a shard; each shard takes its pieces longest first and puts each into the open sequence for which the sum of the squared counts of open
sequences per residual gap gets smallest (equal sums: the smaller gap). A sequence is opened only if none has room, which
keeps the number of sequences near the least possible; within a gap, the sequence opened last is taken.

Null texts count as empty and give a piece with the end id alone; null and repeated doc_ids and equal rows are
packed like any other; other columns play no part; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import stored, text_slices
from tillwright.llm.tokens import KEPT_BYTES, encoder

SEQUENCE = 2048
#: Pieces a shard holds on average.
SHARD_PIECES = 65_536

PIECE_COLUMNS = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cuts(n: int, size: int) -> list[int]:
    """Where the pieces of n ids begin, and n: the first piece may be shorter."""
    return [0, *range(n % size or size, n, size), n] if n > size else [0, n]


def _pieces(path: str, lower: bool, end_id: int, size: int, with_ids: bool, kept_bytes: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path, lower, kept_bytes).encode, np.array([end_id], dtype="<u4")
        for batch in batches:
            for some in text_slices(batch, "text"):
                of, piece, start, length, crc, kept = [], [], [], [], [], []
                for k, ids in enumerate(encode(some.column("text").to_pylist())):
                    ids = np.concatenate([ids, end])
                    at = cuts(len(ids), size)
                    for p, (a, b) in enumerate(zip(at[:-1], at[1:])):
                        of.append(k)
                        piece.append(p)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(ids[a:b]))
                        if with_ids:
                            kept.append(ids[a:b].astype(np.int32))
                columns = [some.column("doc_id").take(pa.array(of)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int, size: int = SEQUENCE, lower: bool = False, with_ids: bool = False, kept_bytes: int = KEPT_BYTES
) -> DataFrame:
    """One row per piece; ``with_ids`` adds the ids themselves as an array. ``kept_bytes``: known pieces of text that a worker's encoder keeps."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(_pieces(tokenizer, lower, end_id, size, with_ids, kept_bytes), PIECE_COLUMNS + ", ids array<int>" * with_ids)


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length (1 to size), placed in the given order."""
    count = np.zeros(size + 1, np.int64)  # open sequences with so large a gap
    open_by_gap: list[list[int]] = [[] for _ in range(size + 1)]
    sequence, offset, used = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for k, n in enumerate(lengths.tolist()):
        # what the sum of squares grows by, less 2, when gap g becomes g - n; a full sequence is not open
        change = 2 * (count[: size + 1 - n] - count[n:])
        change[0] = -2 * count[n] - 1
        best = int(np.where(count[n:] > 0, change, np.iinfo(np.int64).max).argmin()) + n
        if count[best] > 0:
            bin_ = open_by_gap[best].pop()
            count[best] -= 1
        else:
            best, bin_, used = size, used, used + 1
        sequence[k], offset[k] = bin_, size - best
        if best > n:
            open_by_gap[best - n].append(bin_)
            count[best - n] += 1
    return sequence, offset


def _shard(size: int):
    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "ids_crc32", "doc_id", "piece"], ascending=[False, True, True, True], kind="stable", ignore_index=True)
        sequence, frame["offset"] = sum_of_squares(frame["length"].to_numpy(), size)
        frame["sequence_id"] = (frame["shard"].to_numpy(np.int64) << 40) + sequence
        return frame.drop(columns=["shard", "number"])

    return pack


def pack(pieces_: DataFrame, size: int = SEQUENCE, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Add sequence_id and offset to pieces."""
    kinds = dict(pieces_.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in pieces_.columns) + ", offset long, sequence_id long"
    numbered = stored(pieces_.withColumn("number", F.monotonically_increasing_id()), "pieces")
    shards = max(1, -(-numbered.count() // shard_pieces))
    dealt = numbered.withColumn("shard", F.pmod(F.xxhash64("number"), F.lit(shards)))
    packed = dealt.groupBy("shard").applyInPandas(_shard(size), schema)
    return packed.select(*pieces_.columns, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves (pieces made with_ids): ids in place, and where each document begins."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    rows = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return rows.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"), F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("offsets"))
