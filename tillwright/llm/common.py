"""What the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.session import setting

#: The white space that separates words in all contracts: space and the five controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package even if the driver runs in another folder."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, or under the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and go on from the files: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_part(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder in buckets of its column ``part``.

    Groups by part read it in place, and so do, inside ``in_place``, joins and groups by part and other columns.
    """
    spark, named = df.sparkSession, f"llm_{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.bucketBy(buckets, "part").format("parquet").option("compression", "zstd")
    writer.option("path", shared_path(spark, name)).saveAsTable(named)
    rows = spark.read.table(named)
    spark.sql(f"DROP TABLE {named}")  # the name only; the files stay
    return rows


def in_place(spark: SparkSession):
    """While jobs run in this block, two tables in equal buckets are joined bucket by bucket also if the join has more columns than the buckets."""
    return setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


def free_names(wanted: list[str], taken: list[str]) -> list[str]:
    """Names for added columns: a name that is taken (in any case) gets underscores until it is free."""
    found: list[str] = []
    for name in wanted:
        while name.lower() in {c.lower() for c in [*taken, *found]}:
            name += "_"
        found.append(name)
    return found


def row_key(df: DataFrame, columns: list[str]) -> Column:
    """A hash of the named columns that exist, nulls included; equal rows have equal keys."""
    return F.xxhash64(*[F.col(c) for c in columns if c in df.columns])


def share(part: Column, whole: int) -> Column:
    return F.pmod(part, F.lit(int(whole)))


def text_slices(batch: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``limit`` bytes of text each, one row at least."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(sizes) // limit).astype(np.int64)
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
        yield batch.slice(a, b - a)
