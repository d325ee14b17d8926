"""Token ids in ORC: ascending document ids, run-length encoded integers, row indexes and Bloom filters.

Each file (``part``) holds a range of document ids. A row is one document: ``doc_id``, ``part``, ``pos``
(ids before it in its file), ``n`` and ``ids``. Stripes are read in parallel; a filter on ``doc_id`` skips
files, stripes and row groups by their ranges and Bloom filters. Since ``pos`` is stored, a reader of
any stripe knows where it is without reading what precedes.

Null texts count as empty, null ids come first, rows with equal ids are ordered by a hash of their text, equal
rows are kept. Other columns of the input play no part. An empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwright.llm.common import text_slices
from tillwright.llm.tokens import encoder

FILE_COLUMNS = "doc_id long, part int, pos long, n int, ids array<int>"
STRIPE_BYTES = 64 << 20
INDEX_ROWS = 1000


def _encoded(path: str, lower: bool, end_id: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, pos = encoder(path, lower).encode, TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            for some in text_slices(batch, "text"):
                found = encode(some.column("text").to_pylist())
                n = np.fromiter(map(len, found), np.int64, len(found)) + 1
                flat = np.concatenate([x for ids in found for x in (ids, end)]).astype(np.int32)
                ends = np.cumsum(n)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
                columns = [some.column("doc_id"), pa.array(np.full(len(n), part, np.int32)), pa.array(pos + ends - n), pa.array(n.astype(np.int32)), lists]
                pos += int(ends[-1])
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "pos", "n", "ids"])

    return rows


def write_token_orc(docs: DataFrame, path: str, tokenizer: str, end_id: int, lower: bool = False) -> None:
    """Encode whole texts and write them under ``path`` in ascending order of doc_id.

    Texts are dealt out by ranges of (doc_id, hash of text), so no repeated id fills one task.
    """
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("h", F.xxhash64("text"))
        .repartitionByRange("doc_id", "h")
        .sortWithinPartitions("doc_id", "h")
        .select("doc_id", "text")
    )
    writer = ordered.mapInArrow(_encoded(tokenizer, lower, end_id), FILE_COLUMNS).write
    options = {"orc.create.index": "true", "orc.row.index.stride": str(INDEX_ROWS), "orc.stripe.size": str(STRIPE_BYTES), "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "compression": "zstd"}
    writer.options(**options).orc(path)


def read_token_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_COLUMNS).orc(path)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        offsets = ids.offsets.to_numpy() - ids.offsets[0].as_py() if len(ids) else np.zeros(1, np.int32)
        data = memoryview(np.ascontiguousarray(ids.flatten().to_numpy(), dtype="<u4")).cast("B")
        bounds = (offsets.astype(np.int64) * 4).tolist()
        crc = [zlib.crc32(data[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        columns = [batch.column("doc_id"), batch.column("part"), batch.column("pos"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "pos", "n_tokens", "ids_crc32"])


def document_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document read back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    A file's ids are counted from two small columns; the running total over files has one row per file.
    """
    files = read_token_orc(spark, path)
    ends = files.groupBy("part").agg(F.max(F.col("pos") + F.col("n")).alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = ends.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    read = files.select("doc_id", "part", "pos", "ids").mapInArrow(_digests, "doc_id long, part int, pos long, n_tokens long, ids_crc32 long")
    return read.join(bases, "part").select("doc_id", (F.col("base") + F.col("pos")).alias("start"), "n_tokens", "ids_crc32")
