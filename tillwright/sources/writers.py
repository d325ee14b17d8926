"""Table writers."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_table(
    df: DataFrame, path: str, partition: str | None = None, cluster: Sequence[str] = ()
) -> int:
    """Replace the table at ``path``; returns the number of rows. Empty input leaves the table as it is.

    The plan runs once: rows go to a folder beside the table, which takes the table's place if there were any. A partitioned table is rebalanced on its partition column: adaptive execution merges
    small dates and splits a hot one into several files, so no task has to write a whole
    hot date. Inside a file rows are sorted by the cluster columns, which makes the
    min/max statistics useful. The count is observed in the writing stage itself, so the
    source is not scanned a second time and a repeated map stage cannot inflate it.
    """
    return write_counted(df, path, partition, cluster)["rows"]


def write_counted(
    df: DataFrame, path: str, partition: str | None = None, cluster: Sequence[str] = (),
    counts: Mapping[str, Column] | None = None, without: Sequence[str] = (),
) -> dict[str, int]:
    """``write_table`` that gives back ``rows`` and further counts of the same pass.

    ``without`` names helper columns that the counts need and the table does not get.
    """
    counts = counts or {}
    if partition:
        df = df.hint("rebalance", partition)
    sort_by = [c for c in (partition, *cluster) if c]
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    seen = Observation()
    measures = [F.count(F.lit(1)).alias("_rows"), *[c.alias(name) for name, c in counts.items()]]
    writer = df.observe(seen, *measures).drop(*without).write.mode("overwrite")
    if partition:
        writer = writer.partitionBy(partition)
    beside = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    writer.parquet(beside)
    found = seen.get
    if found["_rows"]:
        _put_in_place(df.sparkSession, beside, path)
    else:
        _remove(df.sparkSession, beside)
    return {"rows": found["_rows"], **{name: found[name] or 0 for name in counts}}


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _remove(spark: SparkSession, path: str) -> None:
    files, place = _folder(spark, path)
    files.delete(place, True)


def _put_in_place(spark: SparkSession, new: str, path: str) -> None:
    """Let the folder ``new`` take the place of ``path``."""
    files, place = _folder(spark, path)
    files.delete(place, True)
    if not files.rename(_folder(spark, new)[1], place):
        raise OSError(f"{new} could not be renamed to {path}")


class DryRun(NamedTuple):
    rows: int
    schema: str
    preview: list


def dry_run(df: DataFrame, preview_rows: int = 5) -> DryRun:
    """What a load would write: row count, schema and a short preview. Nothing is written."""
    return DryRun(df.count(), df.schema.treeString(), df.limit(preview_rows).collect())


def audit_row(
    spark: SparkSession,
    bound: str | None,
    tables_loaded: int,
    run_id: str,
    job: str = "table_load",
    completed_at: datetime | None = None,
) -> DataFrame:
    """The one-row record of a finished load; write it with ``write_table`` to replace the last one."""
    now = F.lit(completed_at) if completed_at else F.current_timestamp()
    return spark.range(1).select(
        now.cast("timestamp").alias("migration_completed_at"),
        F.lit(bound).cast("timestamp").alias("frozen_watermark_w"),
        F.lit(tables_loaded).cast("bigint").alias("total_tables_loaded"),
        F.lit(job).alias("dag_id"),
        F.lit(run_id).alias("dag_run_id"),
    )
