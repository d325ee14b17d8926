"""Streaming forms of click deduplication, sessions and the change-feed merge.

Every job folds each batch and keeps the result as a folder of a log, named by the batch, which it overwrites if the
batch is run again after a failure. Clicks and changes are merged when the log is read, and a log can be
compacted; sessions are folded as they come, so that a batch reads open sessions only. Neither late rows nor open sessions
are lost, in whatever order files arrive. Jobs restart from their checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillwright.operators.ordered import group_ordinal, latest_per_key, time_slot
from tillwright.plans.derived import SESSION_GAP_MINUTES, merged_returns_cdc

CLICK = ["user_id", "event_ts", "page_url"]
#: How long a session that has ended is still held open for clicks that come late; later ones open it again.
LATENESS_MINUTES = 60
def log_batches(stream: DataFrame, fold: Callable[[DataFrame], DataFrame], log: str, checkpoint: str) -> StreamingQuery:
    """Process what is there, one folder of ``fold(batch)`` per batch, and stop."""

    def write(batch: DataFrame, batch_id: int) -> None:
        fold(batch).write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _logged(spark: SparkSession, log: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).parquet(log).drop("batch_id")


def log_clicks(clicks: DataFrame, log: str, checkpoint: str) -> StreamingQuery:
    """Each click (user, time, page) of a batch once."""
    return log_batches(clicks.select(*CLICK), lambda batch: batch.dropDuplicates(CLICK), log, checkpoint)


def deduplicated_clicks(spark: SparkSession, log: str, schema: StructType | str) -> DataFrame:
    """Each click once, however late its repeats came."""
    return _logged(spark, log, schema).dropDuplicates(CLICK)


def compact_clicks(spark: SparkSession, log: str, new_log: str, schema: StructType | str) -> None:
    """Start a new log that holds each click once."""
    deduplicated_clicks(spark, log, schema).write.mode("overwrite").parquet(f"{new_log}/batch_id=-1")


#: Clicks of a user, folded: a session, or a part of one.
SESSION = "user_sk bigint, started_ts timestamp, last_event_ts timestamp, clicks bigint"
STORED = f"{SESSION}, closed boolean, day string"


def _minutes(n: int) -> Column:
    return F.make_dt_interval(mins=F.lit(n))


def fold_sessions(parts: DataFrame, gap_minutes: int) -> DataFrame:
    """Sessions made of parts of sessions: parts of a user that lie no further apart than the gap are one.

    A part stands for moments from its first to its last click, none further from the next than the gap, of which the
    first one carries its clicks; so a user with many parts is spread over slots of time as with single clicks.
    """
    first, last = F.col("started_ts"), F.col("last_event_ts")
    moments = F.array_distinct(F.concat(F.sequence(first, last, _minutes(gap_minutes)), F.array(last)))
    moments = F.when(first.isNull(), F.array(first)).when(first == last, F.array(first)).otherwise(moments)
    times = parts.select("user_sk", "started_ts", "clicks", F.explode(moments).alias("event_ts"))
    carried = F.when(F.col("event_ts").eqNullSafe(F.col("started_ts")), F.col("clicks")).otherwise(0)
    times = times.groupBy("user_sk", "event_ts").agg(F.sum(carried).alias("clicks"))
    gap = gap_minutes * 60 * 1_000_000
    numbered = group_ordinal(times, ["user_sk"], "event_ts", "clicks", gap, "_session", time_slot("event_ts"))
    return numbered.groupBy("user_sk", "_session").agg(
        F.min("event_ts").alias("started_ts"), F.max("event_ts").alias("last_event_ts"), F.sum("clicks").alias("clicks")
    ).drop("_session")


def _closed(spark: SparkSession, store: str, before: int) -> DataFrame:
    """Closed sessions of the batches before one, without those that late clicks have opened again."""
    sessions = spark.read.schema(f"{STORED}, gen int").parquet(f"{store}/sessions").filter(F.col("closed") & (F.col("gen") < before))
    gone = spark.read.schema("user_sk bigint, started_ts timestamp, of_gen int, gen int").parquet(f"{store}/reopened")
    gone = gone.filter(F.col("gen") < before).select(F.col("user_sk").alias("_u"), F.col("started_ts").alias("_s"), "of_gen")
    same = F.col("user_sk").eqNullSafe(F.col("_u")) & (F.col("started_ts") == F.col("_s")) & (F.col("gen") == F.col("of_gen"))
    return sessions.join(gone, same, "left_anti")


def _open(spark: SparkSession, store: str, gen: int) -> DataFrame:
    return spark.read.schema(STORED).parquet(f"{store}/sessions/gen={gen}").filter("NOT closed")


def take_clicks(batch: DataFrame, store: str, gen: int, gap_minutes: int, lateness_minutes: int) -> None:
    """Fold a batch of clicks into the sessions that are open, and put away those that have ended.

    A batch reads its clicks, the open sessions that the batch before left, and, only if some of its clicks are so late that
    they may belong to sessions put away, the closed sessions of those users and days. These are folded again and their
    old rows are named as reopened. Everything goes to folders of the batch's own, so it can be run again.
    """
    spark = batch.sparkSession
    at = "event_ts"
    fresh = batch.groupBy("user_sk", at).agg(F.count(F.lit(1)).alias("clicks"))
    fresh = fresh.select("user_sk", F.col(at).alias("started_ts"), F.col(at).alias("last_event_ts"), "clicks")
    latest, parts = None, fresh
    reopened = spark.createDataFrame([], f"{SESSION}, gen int")
    if gen:
        latest = spark.read.parquet(f"{store}/marks/gen={gen - 1}").first()["latest"]
        parts = parts.unionByName(_open(spark, store, gen - 1).select(*fresh.columns))
    if latest:
        late = fresh.filter(F.col("started_ts") < F.lit(latest) - _minutes(lateness_minutes))
        late = late.groupBy(F.col("user_sk").alias("_of")).agg(F.min("started_ts").alias("_from"), F.max("started_ts").alias("_to"))
        first = late.agg(F.date_format(F.min("_from") - _minutes(gap_minutes), "yyyy-MM-dd")).first()[0]
        if first:
            near = (F.col("last_event_ts") >= F.col("_from") - _minutes(gap_minutes)) & (F.col("started_ts") <= F.col("_to") + _minutes(gap_minutes))
            closed = _closed(spark, store, gen).filter(F.col("day") >= first)
            reopened = closed.join(late, F.col("user_sk").eqNullSafe(F.col("_of")) & near).select(*fresh.columns, "gen")
            parts = parts.unionByName(reopened.drop("gen"))
    named = reopened.select("user_sk", "started_ts", F.col("gen").alias("of_gen"))
    named.write.mode("overwrite").parquet(f"{store}/reopened/gen={gen}")
    seen = fresh.agg(F.max("started_ts")).first()[0]
    latest = max((x for x in (latest, seen) if x), default=None)
    ended = F.col("last_event_ts") + _minutes(gap_minutes + lateness_minutes) < F.lit(latest).cast("timestamp")
    sessions = fold_sessions(parts, gap_minutes).withColumn("closed", F.coalesce(ended, F.lit(False)))
    # the day of an open session may still change, so it has none
    day = F.when(F.col("closed"), F.date_format("last_event_ts", "yyyy-MM-dd")).otherwise("open")
    sessions.withColumn("day", day).write.mode("overwrite").partitionBy("closed", "day").parquet(f"{store}/sessions/gen={gen}")
    spark.createDataFrame([(latest,)], "latest timestamp").write.mode("overwrite").parquet(f"{store}/marks/gen={gen}")


def log_click_times(
    clicks: DataFrame, store: str, checkpoint: str, gap_minutes: int = SESSION_GAP_MINUTES, lateness_minutes: int = LATENESS_MINUTES
) -> StreamingQuery:
    """Process what is there into the sessions under ``store``, batch by batch, and stop."""

    def write(batch: DataFrame, batch_id: int) -> None:
        take_clicks(batch, store, batch_id, gap_minutes, lateness_minutes)

    writer = clicks.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def click_sessions(spark: SparkSession, store: str, gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """All sessions per user. ``is_open``: the latest click of all is no later than the gap, so more may follow."""
    mark = spark.read.schema("latest timestamp, gen int").parquet(f"{store}/marks").orderBy(F.desc("gen")).first()
    columns = ["user_sk", "started_ts", "last_event_ts", "clicks"]
    found = _closed(spark, store, mark["gen"] + 1).select(*columns).unionByName(_open(spark, store, mark["gen"]).select(*columns))
    reach = F.col("last_event_ts") + _minutes(gap_minutes)
    return found.withColumn("is_open", F.coalesce(reach >= F.lit(mark["latest"]).cast("timestamp"), F.lit(False)))


CHANGE_ORDER = ("snapshot_date", "return_ts")


def _newest_first():
    deleted = F.when(F.col("op") == "D", 1).otherwise(0)
    return [*[F.col(c).desc_nulls_last() for c in CHANGE_ORDER], deleted.desc()]


def log_changes(changes: DataFrame, log: str, checkpoint: str) -> StreamingQuery:
    """Append the latest change per return of every batch to a change log."""
    return log_batches(changes, lambda batch: latest_per_key(batch, ["return_id"], _newest_first()), log, checkpoint)


def current_returns(spark: SparkSession, log: str, schema: StructType) -> DataFrame:
    """Latest state of every return out of the change log."""
    return merged_returns_cdc(spark.read.schema(schema).parquet(log)).drop("batch_id")


def compact_changes(spark: SparkSession, log: str, new_log: str, schema: StructType) -> None:
    """Start a new log that holds one change per return."""
    changes = spark.read.schema(schema).parquet(log).drop("batch_id")
    latest = latest_per_key(changes, ["return_id"], _newest_first())
    latest.write.mode("overwrite").parquet(f"{new_log}/batch_id=-1")
