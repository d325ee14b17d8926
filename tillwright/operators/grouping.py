"""Grouping sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_blank_row(df: DataFrame, counter: str) -> DataFrame:
    """Add one row of nulls that counts as zero rows.

    Spark's rollups and cubes give nothing for empty input, while the grand total is due
    even then. The blank row brings it about; groups made of nothing else have a zero
    count and are filtered by the caller.
    """
    blank = df.sparkSession.range(1).select(
        *[
            (F.lit(0) if f.name == counter else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in df.schema.fields
        ]
    )
    return df.unionByName(blank)
