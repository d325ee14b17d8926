"""Slowly changing histories kept up to date by batches.

The table holds every state that was ever reported, also those that changed nothing, since a late state can turn them into
changes. It is partitioned by ``period``: open changes (those still valid) lie in one partition, a closed change lies in the
month of its end, and a state without change in its own month. So a batch of new states reads and writes
the open partition and its own months only, and a late one the months from its earliest state on that it really alters; a
partition in which no row changes is not touched.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwright.operators.ordered import next_row, previous_row, time_slot
from tillwright.session import scratch_dir

#: Names of periods that are no months; states without a time come before all others, and so does their period.
OPEN, UNDATED = "open", "0000"


@dataclass(frozen=True)
class History:
    """What makes a history: its key, the attributes whose change counts, and the order of states.

    ``changed`` is the time of a state, ``tie`` orders states of one time; ``carried`` columns come along with a change
    without being one. Two states of one key must differ in their place; equal rows count once.
    """

    key: str
    attributes: Sequence[str]
    changed: str
    tie: str | None = None
    carried: Sequence[str] = ()
    grain: str = "month"

    @property
    def order(self) -> list[str]:
        return [self.changed, *([self.tie] if self.tie else [])]

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys([self.key, *self.order, *self.attributes, *self.carried]))

    def slot(self) -> Column:
        return time_slot(self.changed, self.grain)


def attribute_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over the attributes; a null differs from an empty text."""
    parts = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in columns]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def _period(h: History) -> Column:
    at = F.when(F.col("is_change"), F.col("eff_to")).otherwise(F.col(h.changed))
    return F.when(F.col("_last"), F.lit(OPEN)).otherwise(F.coalesce(F.date_format(at, "yyyy-MM"), F.lit(UNDATED)))


def _chained(states: DataFrame, h: History) -> DataFrame:
    """States with is_change, initial, eff_to and period. Rows that were in the table keep what they were if nothing precedes them here."""
    hashed = states.withColumn("_hash", F.unhex(attribute_hash(h.attributes)))
    seen = previous_row(hashed, [h.key], h.order, ["_hash"], "_before", h.slot())
    first = F.col("_before").isNull()
    was = F.col("_was")
    seen = seen.withColumns(
        {
            "is_change": F.when(first, True).otherwise(~F.col("_before._hash").eqNullSafe(F.col("_hash"))),
            "initial": F.when(first & was.isNotNull(), F.col("_was.initial")).otherwise(first),
        }
    ).drop("_before", "_hash")
    # the next change of a state: only changes are looked at
    chained = next_row(seen.filter("is_change"), [h.key], h.order, [h.changed], "_after", h.slot())
    # of two changes without a time the first one is closed at an unknown time
    chained = chained.withColumns({"eff_to": F.col(f"_after.{h.changed}"), "_last": F.col("_after").isNull()}).drop("_after")
    none = F.lit(None).cast(chained.schema["eff_to"].dataType)
    same = seen.filter("NOT is_change").withColumns({"initial": F.lit(False), "eff_to": none, "_last": F.lit(False)})
    rows = chained.unionByName(same)
    return rows.withColumn("period", _period(h)).drop("_last")


def _table(spark: SparkSession, path: str, h: History, kinds: StructType) -> DataFrame:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds if f.name in h.columns)
    end = kinds[h.changed].dataType.simpleString()
    rows = spark.read.schema(f"{fields}, is_change boolean, initial boolean, eff_to {end}, period string").parquet(path)
    # a partition that a merge left without rows holds a row without a key
    return rows.filter("is_change IS NOT NULL")


def create(states: DataFrame, path: str, h: History) -> None:
    """Write the table of all states known so far."""
    kinds = {"initial": "boolean", "period": "string"}
    rows = states.select(*h.columns).distinct().withColumn("_was", F.lit(None).cast("struct<" + ",".join(f"{c}:{k}" for c, k in kinds.items()) + ">"))
    _chained(rows, h).drop("_was").hint("rebalance", "period").write.partitionBy("period").parquet(path)


def merge(batch: DataFrame, path: str, h: History) -> list[str]:
    """Bring a batch of states into the table, in whatever order batches come; returns the periods it rewrote.

    A batch that was merged before changes nothing, so a failed merge can be run again.
    """
    spark = batch.sparkSession
    batch = batch.select(*h.columns).distinct()
    # states without a time come before all others
    since = batch.agg(F.min(F.coalesce(F.date_format(h.changed, "yyyy-MM"), F.lit("")))).first()[0]
    if since is None:
        return []
    table = _table(spark, path, h, batch.schema)
    keys = batch.select(F.col(h.key).alias("_k")).distinct()
    of_batch = F.col(h.key).eqNullSafe(F.col("_k"))
    # whatever a state can alter ends at its time or later, so earlier periods need not be read
    reached = table.filter(F.col("period") >= since)
    known = reached.join(keys, of_batch, "left_semi")
    was = F.struct("initial", "period", "eff_to", "is_change")
    states = known.select(*h.columns, was.alias("_was"))
    fresh = batch.withColumn("_was", F.lit(None).cast(states.schema["_was"].dataType))
    # a state that is there already counts once; a merge that broke off may have left it in two periods
    place = Window.partitionBy(h.key, *h.order)
    states = states.unionByName(fresh).withColumn("_in", F.collect_set("_was.period").over(place))
    states = states.withColumn("_n", F.row_number().over(place.orderBy(F.col("_was").isNull()))).filter("_n = 1").drop("_n")
    # read twice below: for the periods that are altered and for their rows
    kept = scratch_dir(spark, "merged-states")
    now = _chained(states, h)
    now.write.parquet(kept)
    now = spark.read.schema(now.schema).parquet(kept)

    unlike = F.col("_was").isNull() | ~was.eqNullSafe(F.col("_was")) | (F.size("_in") > 1)
    altered = now.filter(unlike).select(F.explode(F.array_append("_in", F.col("period"))).alias("period")).distinct()
    touched = sorted(r["period"] for r in altered.collect())
    if not touched:
        return []
    mine = F.col("period").isin(touched)
    others = reached.filter(mine).join(keys, of_batch, "left_anti")
    marks = spark.createDataFrame([(p,) for p in touched], "period string")
    rows = now.filter(mine).drop("_was", "_in").unionByName(others).unionByName(marks, allowMissingColumns=True)
    writer = rows.hint("rebalance", "period").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("period").parquet(path)
    return touched


def changes(spark: SparkSession, path: str, h: History, kinds: StructType) -> DataFrame:
    """The history itself: a row per change, valid in ``[eff_from, eff_to)``. ``kinds`` is the schema of the states."""
    rows = _table(spark, path, h, kinds).filter("is_change")
    return rows.select(
        F.xxhash64(h.key, *h.order).alias("history_id"),
        h.key,
        *h.attributes,
        *h.carried,
        F.col(h.changed).alias("eff_from"),
        "eff_to",
        F.col("eff_to").isNull().alias("is_current"),
        F.when(F.col("initial"), "initial").otherwise("change").alias("change_reason"),
    )
