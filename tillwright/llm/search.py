"""What the two vector searches share: usable vectors, and queries meeting the index block by block.

The index is dealt to blocks of a fixed expected size by a hash of a row's number, the queries to sides of a fixed expected size, and
each (block, side) is one group, so no task holds more than one block and one side whatever the table's size.

Vectors that are null or hold null or non-finite components take no part (nor, if asked, zero ones). The dimension is the most frequent length
(the greater of equally frequent ones); vectors of another length take no part, nor do rows without a vec_id. Rows that share a vec_id are
rows of their own: a query leaves out its own row only, and each row asked about has a list of its own under its vec_id. Other columns
play no part; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.common import stored

BLOCK = 16_384
SIDE = 4_096
#: What a search returns: the number and vec_id of the query's row, vec_id and score of a row found.
FOUND = pa.schema([("row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def usable(vectors: DataFrame, zero: bool) -> DataFrame:
    """row (a number of its own) long, vec_id long, x array<double>, stored; ``zero``: whether zero vectors take part."""
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).filter("vec_id IS NOT NULL AND x IS NOT NULL")
    infinite = F.lit(float("inf"))
    rows = rows.filter(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < infinite)))
    if not zero:
        rows = rows.filter(F.exists("x", lambda v: v != 0))
    length = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    rows = rows.filter(F.size("x") == (length["n"] if length else 0))
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "x"), "vectors")


def matrix(table: pa.Table, column: str = "x") -> np.ndarray:
    """A column of equally long lists as a matrix."""
    flat = table.column(column).combine_chunks()
    flat = flat.flatten() if len(flat) else pa.array([], pa.float64())
    return flat.to_numpy().reshape(table.num_rows, -1)


def blocks(n: int, size: int = BLOCK) -> int:
    return max(1, -(-n // size))


def block_of(n: int):
    return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")


def meet(index: DataFrame, queries: DataFrame, n_blocks: int, n_sides: int, own: str, search: Callable, schema: str) -> DataFrame:
    """search(block, queries) -> table, for each block with each side of the queries.

    ``own``: "only" lets a query meet the block that holds its own row, "not" the others, "also" all.
    """
    index, queries = index.toDF(*index.columns), queries.toDF(*queries.columns)  # one table on both sides
    held = index.withColumn("block", block_of(n_blocks)).withColumn("side", F.explode(F.sequence(F.lit(0), F.lit(n_sides - 1))))
    home = block_of(n_blocks)
    asked = queries.withColumn("side", F.pmod(F.xxhash64(F.lit("side"), "row"), F.lit(n_sides)).cast("int"))
    if own == "only":
        asked = asked.withColumn("block", home)
    else:
        asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
        if own == "not":
            asked = asked.filter(F.col("block") != home)
    return held.groupBy("block", "side").cogroup(asked.groupBy("block", "side")).applyInArrow(search, schema)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query, ties to the smaller vec_id. A query has k rows from each block at most."""
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))][:k]
