"""Reconciliation and quality checks. Each check scans a table once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import ExitStack, contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.session import setting

PASS, FAIL, SKIPPED = "PASS", "FAIL", "SKIPPED"


def _verdict(actual: Column, expected: Column) -> Column:
    return F.when(expected.isNull(), SKIPPED).when(actual == expected, PASS).otherwise(FAIL)


def profile(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Row count and number of distinct partition values per table.

    The value of each entry is the (already bounded) table and its partition columns;
    without partition columns the partition count is null.
    """

    def one(name: str, df: DataFrame, parts: Sequence[str]) -> DataFrame:
        found = [F.col(p).isNotNull() for p in parts]
        # folding to distinct partition values first keeps the final count small
        if parts:
            folded = df.groupBy(*parts).agg(F.count(F.lit(1)).alias("n"))
            counted = folded.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                F.count_if(reduce(lambda a, b: a & b, found)).alias("partition_count"),
            )
        else:
            counted = df.agg(
                F.count(F.lit(1)).alias("row_count"), F.lit(None).cast("bigint").alias("partition_count")
            )
        return counted.select(F.lit(name).alias("table"), "row_count", "partition_count")

    return reduce(
        DataFrame.unionByName, [one(name, df, parts) for name, (df, parts) in tables.items()]
    )


#: Formats whose files say how many rows they hold.
COUNTED_FORMATS = ("parquet", "orc")


@contextmanager
def counts_from_footers(spark: SparkSession):
    """While this holds, counts of Parquet and ORC tables that are read and run inside are answered from file footers.

    Spark pushes aggregates down for its newer readers only, so those are chosen for both formats.
    """
    older = spark.conf.get("spark.sql.sources.useV1SourceList")
    with ExitStack() as held:
        rest = ",".join(x for x in older.split(",") if x not in COUNTED_FORMATS)
        held.enter_context(setting(spark, "spark.sql.sources.useV1SourceList", rest))
        for name in COUNTED_FORMATS:
            held.enter_context(setting(spark, f"spark.sql.{name}.aggregatePushdown", "true"))
        yield


def partition_counts(spark: SparkSession, path: str, kind: str, parts: Sequence[str]) -> DataFrame:
    """Rows of each partition of a stored table. Run inside ``counts_from_footers`` it reads no data of Parquet and ORC files."""
    return spark.read.format(kind).load(path).groupBy(*parts).agg(F.count(F.lit(1)).alias("row_count"))


def stored_profile(spark: SparkSession, tables: Mapping[str, tuple[str, str, Sequence[str]]]) -> DataFrame:
    """``profile`` of stored tables, given by path, format and partition columns: from footers and folder names where the format has them.

    Tables in text formats are scanned. The result has one row per table and is computed at once.
    """

    def one(path: str, kind: str, parts: Sequence[str]) -> tuple[int, int | None]:
        if not parts:
            return spark.read.format(kind).load(path).agg(F.count(F.lit(1))).first()[0], None
        named = [F.col(p).isNotNull() for p in parts]
        found = partition_counts(spark, path, kind, parts)
        # text: a folder name is all that Spark needs for the partition, but rows are counted by reading them
        row = found.agg(F.coalesce(F.sum("row_count"), F.lit(0)), F.count_if(reduce(lambda a, b: a & b, named))).first()
        return row[0], row[1]

    with counts_from_footers(spark):
        rows = [(name, *one(*place)) for name, place in tables.items()]
    return spark.createDataFrame(rows, "table string, row_count bigint, partition_count bigint")


def _compare(actual: DataFrame, expected: DataFrame, measure: str) -> DataFrame:
    want = expected.select(F.col("table"), F.col(measure).alias("expected"))
    have = actual.select(F.col("table"), F.col(measure).alias("actual"))
    return have.join(want, "table", "left").select(
        "table", "expected", "actual", _verdict(F.col("actual"), F.col("expected")).alias("status")
    )


def check_rows(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Exact row-count parity of two profiles; tables without an expectation are skipped."""
    return _compare(actual, expected, "row_count")


def check_partitions(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Exact partition-count parity; only tables that have partitions."""
    return _compare(actual.filter(F.col("partition_count").isNotNull()), expected, "partition_count")


def summary(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """One row per table that has an expected row count."""
    return check_rows(actual, expected).filter(F.col("expected").isNotNull())


def _unfold(one_row: DataFrame, names: Sequence[str], key: str, value: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(n).alias(key), F.col(n).alias(value)) for n in names])
    return one_row.select(F.inline(pairs))


def null_keys(
    df: DataFrame, columns: Sequence[str], expected: Mapping[str, int] | None = None
) -> DataFrame:
    """Nulls per key column against the expected number (0 unless given)."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    allowed = F.lit(0).cast("bigint")
    for name, count in (expected or {}).items():
        allowed = F.when(F.col("column") == name, F.lit(count).cast("bigint")).otherwise(allowed)
    return (
        _unfold(counted, columns, "column", "null_count")
        .withColumn("expected", allowed)
        .withColumn("status", _verdict(F.col("null_count"), F.col("expected")))
    )


def conformance(
    df: DataFrame, schema: T.StructType, json_columns: Sequence[str] = ()
) -> DataFrame:
    """Values per column that do not have the declared type: present, but null after the cast."""

    def bad(field: T.StructField) -> Column:
        c = F.col(field.name)
        if field.name in json_columns:
            typed = F.try_parse_json(c.cast("string"))
        else:
            typed = c.try_cast(field.dataType)
        return F.count_if(c.isNotNull() & typed.isNull()).alias(field.name)

    fields = [f for f in schema.fields if f.name in df.columns]
    counted = df.agg(*[bad(f) for f in fields])
    declared = F.create_map(*[F.lit(x) for f in fields for x in (f.name, f.dataType.simpleString())])
    return _unfold(counted, [f.name for f in fields], "column", "bad_values").select(
        "column",
        declared[F.col("column")].alias("declared_type"),
        "bad_values",
        _verdict(F.col("bad_values"), F.lit(0).cast("bigint")).alias("status"),
    )
